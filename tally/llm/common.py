"""Shared helpers of the llm operators: table access, shared-folder staging, word expressions."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import ensure_checkpoint_dir, scratch_path

# White space of the word definition: space and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared checkpoint folder and read it back.

    This cuts lineage: a lost executor re-reads files instead of recomputing, and the
    rows are computed once however often they are used.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes of an Arrow batch that goes to Python.  Without it a batch is 10,000 texts, however long.
ARROW_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, where it has no smaller bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def ship(df: DataFrame) -> DataFrame:
    """Hand this package's source to the executors' Python (once a session); returns ``df``.

    Needed wherever a function of the package runs in Python tasks and the cluster has no
    installed copy of it.  The archive lies in the shared checkpoint folder.
    """
    sc = df.sparkSession.sparkContext
    bound_batches(df.sparkSession)
    if getattr(sc, "_tally_shipped", False):
        return df
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    ensure_checkpoint_dir(df.sparkSession)
    path = scratch_path(df.sparkSession, "source") + ".zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    sc.addPyFile(path)
    sc._tally_shipped = True
    return df


def words(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)), F.lit(0)).cast("long")


def unit_interval(*parts: Column) -> Column:
    """A uniform number in [0, 1) that depends only on ``parts`` (53 bits of a 64-bit hash)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns that clash with ``names`` renamed, and the renaming that brings them back."""
    used = {n.lower() for n in names}
    back: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in used:
            back[free_name([*df.columns, *names, *back], c)] = c
    return (df.withColumnsRenamed({c: n for n, c in back.items()}) if back else df), back


def free_name(df_columns: list[str], wanted: str) -> str:
    """``wanted``, or a variant of it that clashes with no given column."""
    taken = {c.lower() for c in df_columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name
