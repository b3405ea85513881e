"""Split verification (V1-V6, J7, U1-U3): do the parts reproduce the original?

All checks are computed and reported together (no early return), as one
``checks`` DataFrame: (check, expected, actual, passed).  Counts and sums are
single aggregation passes; id sets are compared by digests of key ranges, and only ids of
ranges that differ as distinct keys with anti joins, so a hot id never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally import schemas as S

SUM_TYPE = "decimal(38,6)"


def _metrics(df: DataFrame, side: str, id_col: str, sum_cols: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).cast(SUM_TYPE).alias("row_count")]
    aggs += [F.sum(F.trim(F.col(f"`{c}`").cast("string")).try_cast(SUM_TYPE)).alias(f"sum:{c}")
             for c in sum_cols if c in df.columns]
    wide = df.agg(*aggs)
    names = [c for c in wide.columns]
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (check, value)").withColumn("side", F.lit(side))


# Key ranges whose digests are compared before any id is joined.
RANGES = 4096


def range_digests(df: DataFrame, id_col: str) -> DataFrame:
    """(range, n, one, two): for each range of id hashes the rows and two order-independent sums of their hashes."""
    text = F.col(f"`{id_col}`").cast("string")
    h = F.xxhash64(text)
    wide = "decimal(38,0)"
    return df.groupBy(F.pmod(h, F.lit(RANGES)).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast(wide)).alias("one"), F.sum(F.xxhash64(F.lit(1), text).cast(wide)).alias("two"))


def differing_ranges(original: DataFrame, parts: DataFrame, id_col: str, parts_id_col: str | None = None) -> DataFrame:
    """(range): the key ranges whose rows are not the same on both sides; ``RANGES`` rows at most."""
    a, b = (range_digests(df, c).select("range", F.struct("n", "one", "two").alias(x))
            for df, c, x in ((original, id_col, "a"), (parts, parts_id_col or id_col, "b")))
    return a.join(b, "range", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("range")


def id_differences(original: DataFrame, parts: DataFrame, id_col: str,
                   parts_id_col: str | None = None) -> DataFrame:
    """Ids missing from the parts and ids only in the parts: (kind, id).

    Only ids of ranges whose digests differ are made distinct and joined; equal sides move none.
    """
    ranges = F.broadcast(differing_ranges(original, parts, id_col, parts_id_col))

    def ids(df: DataFrame, c: str) -> DataFrame:
        text = F.col(f"`{c}`").cast("string").alias("id")
        own = df.select(text, F.pmod(F.xxhash64(text), F.lit(RANGES)).alias("range"))
        return own.join(ranges, "range", "left_semi").select("id").distinct()

    a, b = ids(original, id_col), ids(parts, parts_id_col or id_col)
    missing = a.join(b, "id", "left_anti").select(F.lit("missing").alias("kind"), "id")
    extra = b.join(a, "id", "left_anti").select(F.lit("extra").alias("kind"), "id")
    return missing.unionByName(extra)


def id_listing(original: DataFrame, parts: DataFrame, id_col: str, parts_id_col: str | None = None,
               at_most: int = 10) -> DataFrame:
    """L4: the differing ids (kind, id) of each kind that has no more than ``at_most`` of them."""
    diffs = id_differences(original, parts, id_col, parts_id_col)
    few = diffs.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= at_most).select("kind")
    return diffs.join(F.broadcast(few), "kind", "left_semi")     # two kinds at most


def verify(original: DataFrame, parts: DataFrame, id_col: str, sum_cols: Sequence[str] = (),
           parts_id_col: str | None = None, tolerance: float = S.SUM_TOLERANCE) -> DataFrame:
    """Checks table with row count (V1), missing/extra ids (V2), sums within tolerance (V3)."""
    m = _metrics(original, "expected", id_col, sum_cols).unionByName(
        _metrics(parts, "actual", parts_id_col or id_col, sum_cols))
    wide = m.groupBy("check").pivot("side", ["expected", "actual"]).agg(F.first("value"))
    tol = F.lit(tolerance).cast(SUM_TYPE)
    passed = F.when(F.col("check") == "row_count", F.col("expected") == F.col("actual")) \
              .otherwise(F.abs(F.coalesce(F.col("expected"), F.lit(0)) - F.coalesce(F.col("actual"), F.lit(0)))
                         <= tol)
    checks = wide.select("check", F.col("expected").cast("double").alias("expected"),
                         F.col("actual").cast("double").alias("actual"), passed.alias("passed"))
    diffs = id_differences(original, parts, id_col, parts_id_col).groupBy("kind").count()
    id_checks = diffs.select(F.concat(F.lit("ids_"), F.col("kind")).alias("check"), "count")
    zero = original.sparkSession.createDataFrame([("ids_missing",), ("ids_extra",)], "check string")
    id_checks = zero.join(id_checks, "check", "left").select(
        "check", F.lit(0.0).alias("expected"), F.coalesce(F.col("count"), F.lit(0)).cast("double").alias("actual"))
    id_checks = id_checks.withColumn("passed", F.col("actual") == 0)
    return checks.unionByName(id_checks)


def part_digests(df: DataFrame, part_cols: Sequence[str], id_col: str, sum_cols: Sequence[str] = ()) -> DataFrame:
    """One row per part: rows, two order-independent sums of id hashes, and the sum of each column (``sum:<column>``).

    Sums and digests are additive, so a hot part is aggregated before it is shuffled; parts merge by adding them.
    """
    text = F.col(f"`{id_col}`").cast("string")
    wide = "decimal(38,0)"
    sums = [F.sum(F.trim(F.col(f"`{c}`").cast("string")).try_cast(SUM_TYPE)).alias(f"sum:{c}") for c in sum_cols]
    return df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(text).cast(wide)).alias("ids_one"),
                                      F.sum(F.xxhash64(F.lit(1), text).cast(wide)).alias("ids_two"), *sums)


def check_parts(stored: DataFrame, found: DataFrame, part_cols: Sequence[str], sum_cols: Sequence[str] = (),
                tolerance: float = S.SUM_TOLERANCE) -> DataFrame:
    """V1/V3/V5: each part's stored digests against those of the rows read back; no row of the original is needed.

    (part columns, rows_expected, rows_actual, ids_equal, sums_equal, passed); a part that one side lacks has 0 rows there.
    """
    keys = list(part_cols)
    a, b = (df.select(*keys, F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys]).alias(x))
            for df, x in ((stored, "_a"), (found, "_b")))
    both = a.join(b, keys, "full")
    zero, tol = F.lit(0), F.lit(tolerance).cast(SUM_TYPE)

    def near(c: str) -> Column:
        return F.abs(F.coalesce(F.col("_a")[c], zero) - F.coalesce(F.col("_b")[c], zero)) <= tol

    rows = [F.coalesce(F.col(x)["rows"], zero).cast("long") for x in ("_a", "_b")]
    ids = F.col("_a")["ids_one"].eqNullSafe(F.col("_b")["ids_one"]) & F.col("_a")["ids_two"].eqNullSafe(F.col("_b")["ids_two"])
    sums = reduce(lambda x, y: x & y, [near(f"sum:{c}") for c in sum_cols], F.lit(True))
    return both.select(*keys, rows[0].alias("rows_expected"), rows[1].alias("rows_actual"), ids.alias("ids_equal"),
                       sums.alias("sums_equal")) \
        .withColumn("passed", (F.col("rows_expected") == F.col("rows_actual")) & F.col("ids_equal") & F.col("sums_equal"))


def column_checks(expected_columns: Sequence[str], headers: DataFrame) -> DataFrame:
    """Per part file, template columns it lacks and columns it adds."""
    exp = F.array(*[F.lit(c) for c in expected_columns])
    return headers.select(
        "_part_file",
        F.array_except(exp, F.col("columns")).alias("missing_columns"),
        F.array_except(F.col("columns"), exp).alias("extra_columns"),
    ).withColumn("passed", (F.size("missing_columns") == 0) & (F.size("extra_columns") == 0))


def overall(checks: DataFrame) -> DataFrame:
    """One row, all checks passed?"""
    return checks.agg(F.bool_and("passed").alias("passed"), F.count(F.lit(1)).alias("checks"),
                      F.count_if("passed").alias("passed_checks"))
