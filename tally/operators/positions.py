"""Dense row positions within groups, without a per-group window.

A ``row_number()`` over ``Window.partitionBy(group)`` sends each group to one
task; with one establishment-month (or one day) holding a third of the rows
that task would sort a third of the data.  Instead:

1. range-partition by (group, order) and sort inside each partition, so a
   large group spans many partitions and every partition holds an ordered run;
2. tag rows with ``monotonically_increasing_id`` (partition id in the high bits,
   in-partition index in the low 33 bits) and checkpoint to the shared
   checkpoint folder, which fixes the tags against recomputation and executor
   loss;
3. count rows per (partition, group) -- at most partitions + groups rows --
   and turn the counts into running offsets;
4. position = offset of (partition, group) + in-partition index - first index
   of the group in that partition + 1.

The offsets table has at most partitions + groups - 1 rows, never one per
data row; it is checkpointed, so its size is measured when the join is planned
and Spark broadcasts it or not by its bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.operators.sizing import table_bytes
from tally.session import ensure_checkpoint_dir, shuffle_partitions

LOW_BITS = 33
# Bytes that a range partition of an ordered step should hold (CSV bytes of its rows).
PARTITION_BYTES = 512 << 20
# Bytes of the offsets table up to which it is broadcast; beyond, the join is the planner's choice.
OFFSETS_MAX_BYTES = 64 << 20


def range_partitions(default: int, total_bytes: int | None) -> int:
    """Partitions of an ordered step: the session's number, or more where the bytes ask for it (AQE never splits them)."""
    return max(default, -(-(total_bytes or 0) // PARTITION_BYTES))


def ordered_checkpoint(df: DataFrame, keys: Sequence[Column | str], num_partitions: int | None = None,
                       total_bytes: int | None = None) -> DataFrame:
    """Range-partitioned, sorted, tagged and checkpointed copy of ``df``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or range_partitions(shuffle_partitions(spark), total_bytes)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return ranged.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)


def positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
              pos_col: str = "pos", num_partitions: int | None = None,
              size_col: str | None = None, total_bytes: int | None = None) -> DataFrame:
    """``df`` plus ``pos_col``: 1-based position of each row inside its group by ``order_cols``.

    ``order_cols`` should make the order total (end with unique columns);
    rows equal on every key get consecutive positions in an arbitrary order.
    With ``size_col`` the group's row count is added as well (from the same
    small table, no extra pass).  ``total_bytes``, where known, sets the number
    of range partitions.
    """
    group_cols = list(group_cols)
    keys = [*group_cols, *order_cols]
    tagged = ordered_checkpoint(df, keys, num_partitions, total_bytes)
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", LOW_BITS)) \
                   .withColumn("_idx", F.col("_mid").bitwiseAND((1 << LOW_BITS) - 1))
    stats = tagged.groupBy("_pid", *group_cols).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offsets = offsets.withColumn("_gn", F.sum("_n").over(Window.partitionBy(*group_cols))).drop("_n")
    offsets = offsets.checkpoint(eager=True)
    if table_bytes(offsets) <= OFFSETS_MAX_BYTES:
        offsets = F.broadcast(offsets)
    o = offsets.alias("o")
    t = tagged.alias("t")
    cond = F.col("t._pid") == F.col("o._pid")
    for g in group_cols:
        cond = cond & F.col(f"t.`{g}`").eqNullSafe(F.col(f"o.`{g}`"))
    extra = [F.col("o._gn").alias(size_col)] if size_col else []
    out = t.join(o, cond, "inner").select(
        "t.*", (F.col("o._before") + F.col("t._idx") - F.col("o._first") + 1).alias(pos_col), *extra)
    return out.drop("_mid", "_pid", "_idx")
