"""Sinks: full dataset (K1), part files (K2-K4), BOM CSV (K5), violation reports (K6), measured parts (K7).

Part files: rows are hash-partitioned on the part keys and sorted by (keys,
order) inside each task, so each part lands in exactly one task.  Lines are made
by ``to_csv`` in generated code; the data source of ``partfiles`` writes them under flat names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally import schemas as S
from tally.functions.csvbytes import CSV_LINE_OPTIONS, CSV_WRITE_OPTIONS, header_line
from tally.sinks.partfiles import PartFiles


def with_bom_header(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """K5: prefix the first written column's name with U+FEFF, so the file starts EF BB BF."""
    cols = [c for c in df.columns if c not in exclude]
    if not cols:
        return df
    first = cols[0]
    return df.withColumnRenamed(first, S.CSV_BOM + first)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), bom: bool = True,
              mode: str = "overwrite") -> None:
    """K1/K5: header CSV with the fixed quoting options the byte estimates assume."""
    out = with_bom_header(df, partition_by) if bom else df
    w = out.write.mode(mode).options(**CSV_WRITE_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


# CSV bytes that a task of the part sink should write, where the rows' bytes are known.
TASK_BYTES = 256 << 20


def part_tasks(default: int, total_bytes: int | None) -> int:
    """Tasks of the part sink: the session's number of shuffle partitions, or more where the bytes ask for it."""
    return max(default, -(-(total_bytes or 0) // TASK_BYTES))


def write_parts(df: DataFrame, path: str, part_cols: Sequence[str], order_cols: Sequence[Column | str],
                columns: Sequence[str] | None = None, bom: bool = True, bytes_col: str = "_bytes",
                compression: str = "", limit: float = 0, fill: float = S.TEMPLATE_FILL) -> None:
    """K2/K3/K4: one CSV file per distinct ``part_cols`` value, rows in ``order_cols`` order.

    A part's file is ``<path>/<values joined by _>.csv``; ``path`` is replaced as a whole when all parts are written.
    ``bytes_col``, where ``df`` has it, sets the number of tasks by the bytes to write.  ``compression`` 'gzip' or
    'bz2' writes ``.csv.gz`` or ``.csv.bz2``.

    K7: with ``limit``, a file that turns out larger once it is written is divided by rows at ``fill * limit`` into
    ``<name>_parte1``, ``<name>_parte2``...; these are measured too.  Only single rows stay over the limit.  A part is
    measured in one task, so parts are to be bounded by their plain bytes before (``pipelines.split_measured``).
    """
    spark = df.sparkSession
    keep = list(columns or [c for c in df.columns if c not in part_cols])
    name = F.concat_ws("_", *[F.col(c).cast("string") for c in part_cols])
    total = df.agg(F.sum(bytes_col)).first()[0] if bytes_col in df.columns else None
    tasks = part_tasks(int(spark.conf.get("spark.sql.shuffle.partitions")), total)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in keep]), CSV_LINE_OPTIONS)
    parts = (df.withColumn("_file", name).repartition(tasks, "_file").sortWithinPartitions("_file", *order_cols)
               .select(F.col("_file").alias("file_name"), line.alias("line")))
    spark.dataSource.register(PartFiles)
    parts.write.format("tally_parts").mode("overwrite").options(
        header=header_line(keep, bom), compression=compression, limit=limit, fill=fill).save(path)


def write_full(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1: the complete (audited, imputed) dataset."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_violations(violations: DataFrame, path: str) -> None:
    """K6: violation reports, one folder per dataset and rule."""
    violations.write.mode("overwrite").partitionBy("dataset", "rule").parquet(path)
