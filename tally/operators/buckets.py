"""Time bucketing (T1-T9) and the adaptive granularity choice.

Bucket sizes for all five levels come from one pass over the data: rows are
aggregated per day (partial aggregation map-side, so a hot day costs one row
per task), and the coarser levels are sums over that small daily table.  The
choice of level is the only driver round-trip: at most five rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally import schemas as S

LEVELS = ("5y", "year", "month", "week", "day")


def _day(d: Column) -> Column:
    return F.to_date(d)


def bucket_expr(d: Column, level: str, min_day: Column | None = None, min_year: Column | None = None):
    """(label, bucket start date) of a timestamp ``d`` at ``level``; null date -> ('sem_data', null).

    5y buckets start on 1 Jan of the earliest year (``min_year``), weeks on the
    earliest date (``min_day``); month, year and day are calendar buckets.
    """
    day = _day(d)
    if level == "5y":
        y = F.year(day)
        start_year = (min_year + F.floor((y - min_year) / 5) * 5).cast("int")
        label = F.concat(start_year.cast("string"), F.lit("-"), (start_year + 4).cast("string"))
        start = F.make_date(start_year, F.lit(1), F.lit(1))
    elif level == "year":
        label = F.date_format(day, "yyyy")
        start = F.trunc(day, "year")
    elif level == "month":
        label = F.date_format(day, "MM-yyyy")
        start = F.trunc(day, "month")
    elif level == "week":
        idx = F.floor(F.datediff(day, min_day) / 7).cast("int")
        start = F.date_add(min_day, idx * 7)
        label = F.concat(F.date_format(start, "dd-MM-yyyy"), F.lit("_a_"),
                         F.date_format(F.date_add(start, 7), "dd-MM-yyyy"))
    elif level == "day":
        label = F.date_format(day, "dd-MM-yyyy")
        start = day
    else:
        raise ValueError(level)
    return F.coalesce(label, F.lit(S.NO_DATE)), start


def daily_sizes(df: DataFrame, date_col: Column, bytes_col: str) -> DataFrame:
    """Rows and bytes per calendar day (null day kept as its own row)."""
    return df.groupBy(_day(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(bytes_col).alias("bytes"))


def merge_daily(*tables: DataFrame) -> DataFrame:
    """Daily tables added up: sizes are sums, so tables of disjoint rows merge in any order."""
    return reduce(DataFrame.unionByName, tables).groupBy("day").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def index_batch(df: DataFrame, date_col: Column, bytes_col: str, path: str, batch: str) -> None:
    """The batch's daily sizes into the size index at ``path``, one folder a batch.

    A batch that is written again replaces itself, so a retried job counts once.  The index holds one row a day and
    batch; ``compact_index`` brings it back to a row a day.
    """
    if not re.fullmatch(r"[A-Za-z0-9][-\w]*", batch):
        raise ValueError(f"a batch's name is a plain word: {batch!r}")
    daily_sizes(df, date_col, bytes_col).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def size_index(spark: SparkSession, path: str) -> DataFrame:
    """(day, rows, bytes) of all batches of the index: what ``daily_sizes`` gives for all their rows, without them."""
    stored = spark.read.schema("day date, rows long, bytes long, batch string").parquet(path)
    return merge_daily(stored.select("day", "rows", "bytes"))


def compact_index(spark: SparkSession, path: str, out_path: str, batch: str) -> None:
    """The index's sums as one batch of a new index at ``out_path``; later batches go there."""
    size_index(spark, path).coalesce(1).write.mode("overwrite").parquet(f"{out_path}/batch={batch}")


def level_sizes(daily: DataFrame, header_bytes: int) -> DataFrame:
    """(level, label, start, rows, bytes) for every level, from the daily table.

    Bytes include the header line and BOM each bucket file carries.  The
    anchors (earliest day and year) come from a window over the daily table,
    which holds one row per calendar day, never one per data row; the five
    levels are one ``explode`` over it, then one aggregation.
    """
    base = daily.where(F.col("day").isNotNull())
    base = base.withColumn("min_day", F.min("day").over(_all())).withColumn("min_year", F.year("min_day"))
    d = F.col("day").cast("timestamp_ntz")
    keys = []
    for level in LEVELS:
        label, start = bucket_expr(d, level, F.col("min_day"), F.col("min_year"))
        keys.append(F.struct(F.lit(level).alias("level"), label.alias("label"), start.alias("start")))
    x = base.select(F.explode(F.array(*keys)).alias("k"), "rows", "bytes")
    return x.groupBy(F.col("k.level").alias("level"), F.col("k.label").alias("label"),
                     F.col("k.start").alias("start")).agg(
        F.sum("rows").alias("rows"), (F.sum("bytes") + F.lit(header_bytes)).cast("long").alias("bytes"))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()


def choose_level(sizes: DataFrame, limit: float) -> str:
    """The coarsest level whose largest bucket fits ``limit``; 'day' when none does."""
    rows = sizes.groupBy("level").agg(F.max("bytes").alias("max_bytes")).collect()
    biggest = {r["level"]: r["max_bytes"] for r in rows}
    for level in LEVELS:
        if level in biggest and biggest[level] <= limit:
            return level
    return "day"


def level_summary(sizes: DataFrame, limit: float) -> DataFrame:
    """Per level: bucket count, largest bucket, whether it fits, and whether it is the chosen level.

    The choice (first fitting level, else 'day') is made in the plan over the
    five summary rows, so reporting it needs no driver round-trip.
    """
    rank = F.lit(len(LEVELS))
    for i, level in reversed(list(enumerate(LEVELS))):
        rank = F.when(F.col("level") == level, F.lit(i)).otherwise(rank)
    s = sizes.groupBy("level").agg(
        F.count(F.lit(1)).alias("buckets"), F.max("bytes").alias("max_bytes"),
        F.sum("rows").alias("rows")).withColumn("fits", F.col("max_bytes") <= F.lit(limit)) \
        .withColumn("_rank", rank)
    first_fit = F.coalesce(F.min(F.when(F.col("fits"), F.col("_rank"))).over(_all()), F.lit(len(LEVELS) - 1))
    return s.withColumn("chosen", F.col("_rank") == first_fit).drop("_rank")
