"""Sources: relational tables, header-row files and multi-part outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.csvbytes import CSV_WRITE_OPTIONS
from tally.session import scratch_path
from tally.sources.headers import PartHeaders


def read_table(spark: SparkSession, name: str | None = None, *, url: str | None = None, path: str | None = None,
               query: str | None = None, properties: dict | None = None, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A ledger table (or a query run inside the database) from JDBC, or a table from parquet.

    With JDBC, ``partition_column``/bounds split the read into ``num_partitions``
    range queries so no single connection streams the whole table; filters and
    column pruning from the plan are pushed into each query.  ``query`` sends a
    SELECT to the database as is (wrapped as a derived table when the read is
    range-partitioned, since Spark's ``query`` option cannot be partitioned).
    """
    if url is not None:
        reader = spark.read.format("jdbc").option("url", url)
        if query is not None and partition_column is None:
            reader = reader.option("query", query)
        elif query is not None:
            reader = reader.option("dbtable", f"({query}) q")
        else:
            reader = reader.option("dbtable", name)
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        if partition_column is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions or 64)))
        return reader.load()
    if path is None:
        raise ValueError("read_table needs url= or path=")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def template_schema(columns) -> T.StructType:
    """All-text schema for a header-row file: ids and tax numbers stay text (no inference)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _csv(spark: SparkSession, multi_line: bool):
    """A reader of header-row CSV.  Without ``multi_line`` a file is cut at lines and read by many tasks."""
    return spark.read.option("header", "true").option("encoding", "UTF-8") \
        .option("quote", '"').option("escape", '"').option("multiLine", str(multi_line).lower())


def read_sheet(spark: SparkSession, path: str, columns=None, fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """A header-row table file read with an explicit schema.

    CSV is read as text for every template column; a BOM on the header is
    dropped by the reader.  Parquet keeps its own types.  ``multi_line`` is for
    files whose quoted fields hold line breaks; such a file is read by one task.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = _csv(spark, multi_line).option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(template_schema(columns)).option("enforceSchema", "false")
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(path)


def has_column(df: DataFrame, name: str) -> bool:
    """Is the column present (schema lookup, no data read)."""
    return name in df.columns


def list_columns(df: DataFrame) -> list[str]:
    """Column names of a table."""
    return list(df.columns)


# Reports and full copies beside the parts: files by name, and folders as Spark writes them.
EXCLUDED = r"(^|/)erros_[^/]*$|_completo\.[a-z]+$|(^|/)[^/]*_completo/|(^|/)violations/"


def _relative(path_col, root: str):
    """A file's path below the folder that is read (so that a folder above it cannot match an exclusion)."""
    base = root.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_replace(path_col, "^.*/" + "\\Q" + base + "\\E/", "")


def read_parts(spark: SparkSession, path: str, columns=None, glob: str = "*.csv", excluded: str = EXCLUDED,
               recursive: bool = False, multi_line: bool = False, larger_than: float | None = None) -> DataFrame:
    """All part files under a folder as one DataFrame, columns matched by name.

    Files are grouped by their header; each group is read under its own
    header, and the groups are united by name, a column that a file lacks being
    null.  ``columns`` picks and orders the result's columns (all are text).
    Partition folders (``key=value``) come back as columns.  Every row carries
    ``_part_file`` and ``_part_size`` from the file metadata.  Reports and full
    copies are left out by name or folder; only ``glob`` matches are read.  With ``larger_than``, files up to so
    many bytes are left out of the scan by their listed size.
    """
    headers = part_headers(spark, path, glob, excluded)
    groups = [r["columns"] for r in headers.select("columns").distinct().collect()]     # a few distinct headers

    def one(header) -> DataFrame:
        reader = _csv(spark, multi_line)
        if len(groups) == 1:
            reader = reader.option("pathGlobFilter", glob)
            if recursive:
                reader = reader.option("recursiveFileLookup", "true")
            df = reader.schema(template_schema(header)).csv(path)
        else:       # the driver lists files in any read; here it passes on the lists of each group
            files = [r["_part_file"] for r in headers.where(F.col("columns") == F.array(*map(F.lit, header)))
                     .select("_part_file").collect()]
            reader = reader if recursive else reader.option("basePath", path)
            df = reader.schema(template_schema(header)).csv(files)
        df = df.withColumn("_part_file", F.col("_metadata.file_path")).withColumn("_part_size", F.col("_metadata.file_size")) \
               .withColumn("_part_start", F.col("_metadata.file_block_start"))
        if larger_than is not None:
            df = df.where(F.col("_metadata.file_size") > F.lit(int(larger_than)))
        return df.where(~_relative(F.col("_part_file"), path).rlike(excluded))

    if not groups:
        empty = template_schema([*(columns or []), "_part_file"]).add("_part_size", "long").add("_part_start", "long")
        return spark.createDataFrame([], empty)
    df = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [one(h) for h in groups])
    if columns is None:
        return df
    known = {c for h in groups for c in h}
    lacking = {c: F.lit(None).cast("string") for c in columns if c not in known}
    rest = [c for c in df.columns if c not in known and c not in columns]
    return df.withColumns(lacking).select(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`") for c in rest])


def read_once(parts: DataFrame, columns) -> DataFrame:
    """``columns`` of the rows of `read_parts` and their files, from a Parquet copy in the scratch folder.

    For several passes over many small files: each file is opened and parsed once, and the tasks of a pass
    follow the bytes, not the number of files.
    """
    spark = parts.sparkSession
    copy = scratch_path(spark, "read-back")
    rows = parts.select(*[F.col(f"`{c}`") for c in columns], "_part_file", "_part_size")
    rows.write.parquet(copy)
    return spark.read.schema(rows.schema).parquet(copy)


def part_name(path_col: str):
    """A part's name from its file's path: the file's name without ``.csv`` (and ``.gz``, ``.bz2``), or the folder's ``file_name=`` value."""
    folder = F.regexp_extract(F.col(path_col), r"(?:^|/)file_name=([^/]+)/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(F.col(path_col), r"([^/]+?)(?:\.csv(?:\.gz|\.bz2)?)?$", 1))


def part_headers(spark: SparkSession, path: str, glob: str = "*.csv", excluded: str = EXCLUDED) -> DataFrame:
    """U3 input: the header of every part file, as (_part_file, _part_size, columns array, bytes_read).

    A data source reads the first block of each file, whatever its size.
    """
    spark.dataSource.register(PartHeaders)
    return spark.read.format("tally_part_headers").options(path=path, glob=glob, excluded=excluded).load()


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard (reads at most one row)."""
    return df.isEmpty()


def empty_frame(spark: SparkSession, columns, kinds=None) -> DataFrame:
    """An empty dataset with the template's columns, typed by their ``kinds`` (text where none is given)."""
    types = {"money": T.DecimalType(22, 6), "int": T.IntegerType(), "flag": T.IntegerType()}
    kinds = kinds or {}
    return spark.createDataFrame([], T.StructType(
        [T.StructField(c, types.get(kinds.get(c), T.StringType()), True) for c in columns]))


__all__ = ["read_table", "read_sheet", "has_column", "list_columns", "read_parts", "read_once", "part_headers", "part_name",
           "is_empty", "empty_frame", "template_schema", "CSV_WRITE_OPTIONS"]
