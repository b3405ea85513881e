"""Declared-constraint audits (C-N1..C-N5): keys, references, NOT NULL, lengths, defaults.

The source database enforces these; a Spark copy does not, so they are
re-checked as jobs.  Key checks aggregate before any shuffle of rows (a hot
key costs one row per task), and references compare distinct keys only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally import schemas as S
from tally.sources.ledger_view import Ledger


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _key_text(cols) -> F.Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def pk_duplicates(t: Ledger) -> DataFrame:
    """C-N1: keys that occur more than once: (table, key, n)."""
    frames = []
    for table, pk in S.PRIMARY_KEYS.items():
        df = t.table(table)
        frames.append(df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                      .select(F.lit(table).alias("table"), _key_text(pk).alias("key"), "n"))
    return _union(frames)


def fk_orphans(t: Ledger) -> DataFrame:
    """C-N2: child key values with no parent row (null keys ignored): (child, column, parent, key, n).

    All references are stacked as (reference, key): each child table is read once for all its references,
    each parent's keys come as marks, and one aggregate with partial sums settles all of them.
    """
    refs = list(S.FOREIGN_KEYS)
    frames = []
    for table in dict.fromkeys(r[0] for r in refs):
        own = [(k, r[1]) for k, r in enumerate(refs) if r[0] == table]
        keys = F.array(*[F.struct(F.lit(k).alias("ref"), F.when(
            reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), _key_text(cols)).alias("key")) for k, cols in own])
        frames.append(t.table(table).select(F.explode(keys).alias("x")).select("x.ref", "x.key", F.lit(1).cast("long").alias("n")))
    for parent in dict.fromkeys((r[2], tuple(r[3])) for r in refs):
        own = [k for k, r in enumerate(refs) if (r[2], tuple(r[3])) == parent]
        marks = F.explode(F.array(*[F.lit(k) for k in own])).alias("ref")
        frames.append(t.table(parent[0]).select(marks, _key_text(parent[1]).alias("key"), F.lit(None).cast("long").alias("n")))
    # a key with a parent has a row without n
    met = _union(frames).where(F.col("key").isNotNull()).groupBy("ref", "key") \
        .agg(F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("parents")).where((F.col("parents") == 0))
    names = F.array(*[F.struct(F.lit(r[0]).alias("child"), F.lit(",".join(r[1])).alias("coluna"), F.lit(r[2]).alias("parent"))
                      for r in refs])
    return met.select(F.element_at(names, F.col("ref") + 1).alias("r"), "key", "n").select("r.*", "key", "n")


def not_null_violations(t: Ledger) -> DataFrame:
    """C-N3: nulls in NOT NULL columns, one aggregation pass per table: (table, coluna, n)."""
    frames = []
    for table in S.LEDGER_SCHEMAS:
        df = t.table(table)
        cols = [c for c in S.not_null_columns(table) if c in df.columns]
        if not cols:
            continue
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        frames.append(wide.selectExpr(f"stack({len(cols)}, {stack}) AS (coluna, n)")
                      .select(F.lit(table).alias("table"), "coluna", "n"))
    return _union(frames)


def length_violations(t: Ledger) -> DataFrame:
    """C-N4: values longer than the declared nvarchar(n): (table, coluna, max_len, n)."""
    frames = []
    for table, limits in S.LENGTH_LIMITS.items():
        df = t.table(table)
        cols = [c for c in limits if c in df.columns]
        if not cols:
            continue
        wide = df.agg(*[F.count_if(F.length(F.col(c)) > limits[c]).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', {limits[c]}, `{c}`" for c in cols)
        frames.append(wide.selectExpr(f"stack({len(cols)}, {stack}) AS (coluna, max_len, n)")
                      .select(F.lit(table).alias("table"), "coluna", F.col("max_len").cast("int"), "n"))
    return _union(frames)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """C-N5: declared column defaults replace nulls."""
    defaults = S.COLUMN_DEFAULTS.get(table, {})
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (F.coalesce(F.col(c), F.lit(defaults[c]).cast(types[c])).alias(c) if c in defaults else F.col(c))
        for c in df.columns
    ])
