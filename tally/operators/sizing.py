"""Size-checked broadcast: a side is broadcast only after its bytes are proven few."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension that is broadcast has at most so many bytes (a city table with ~5,600 rows has some
# 500 KB, payment terms and collection types a few KB), and its check reads at most so many rows.
DIM_MAX_BYTES = 32 << 20
DIM_CHECK_ROWS = 200_000


def table_bytes(df: DataFrame) -> int:
    """Bytes of a table's rows as text, and 16 for each value: an upper estimate of what a broadcast holds."""
    text = F.octet_length(F.to_json(F.struct("*"))) + 16 * len(df.columns)
    return int(df.agg(F.coalesce(F.sum(text), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, max_bytes: int = DIM_MAX_BYTES) -> DataFrame:
    """Broadcast hint when ``df`` has at most ``max_bytes``, else leave the choice to the planner.

    The check reads at most ``DIM_CHECK_ROWS + 1`` rows (``limit`` before the sum); a table with
    more is not called small.  Above the bound the join falls back to a shuffle join (AQE may
    still broadcast it at run time from measured sizes).
    """
    if df.isLocal():  # literal rows held by the driver: their size is already known
        return F.broadcast(df)
    head = df.limit(DIM_CHECK_ROWS + 1)
    n = head.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16 * len(df.columns))).first()
    return F.broadcast(df) if n[0] <= DIM_CHECK_ROWS and (n[1] or 0) <= max_bytes else df
