"""Size-bounded parts: equal-row parts (R1), recursive row split (R2), re-split (K7/K8), manifest (K9).

Sizes are exact CSV bytes (``tally.functions.csvbytes``), known before any
file is written, so "write, stat, delete, rewrite" becomes part-id refinement.
The recursion of the row split runs over slices, whose sizes are differences of
running totals; slices halve, so the rounds are at most log2 of the longest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally import schemas as S
from tally.operators.positions import positions

def _join_cond(left: str, right: str, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in cols])


def _join(a: DataFrame, b: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``cols`` keeping one copy of the key columns."""
    a2, b2 = a.alias("a"), b.alias("b")
    keep_b = [F.col(f"b.`{c}`") for c in b.columns if c not in cols]
    return a2.join(b2, _join_cond("a", "b", cols), how).select("a.*", *keep_b)


def rows_per_part(total_bytes: int, total_rows: int, limit: float, fill: float) -> int:
    """k = int(limit * fill / bytes_per_row), at least 1."""
    if total_rows <= 0 or total_bytes <= 0:
        return 1
    return max(1, int((limit * fill) / (total_bytes / total_rows)))


def equal_row_parts(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                    bytes_col: str, limit: float, header_bytes: int, fill: float = S.TEMPLATE_FILL,
                    part_col: str = "parte") -> DataFrame:
    """Per group, parts of k rows, k from the average CSV row size of all rows being split.

    Adds ``pos`` (position in group), ``part_col`` (1-based) and ``n_parts``.
    The only driver round-trip is one aggregate row (count, bytes), read from
    the ordered copy that the positions rest on.
    """
    g = list(group_cols)
    x = positions(df, g, order_cols, size_col="_gn")
    n, s = x.agg(F.count(F.lit(1)), F.coalesce(F.sum(bytes_col), F.lit(0))).first()
    k = rows_per_part(s + header_bytes, n, limit, fill)
    kg = F.least(F.lit(k).cast("long"), F.col("_gn"))
    return (x.withColumn("_k", F.greatest(F.lit(1).cast("long"), kg))
             .withColumn(part_col, (F.floor((F.col("pos") - 1) / F.col("_k")) + 1).cast("int"))
             .withColumn("n_parts", F.ceil(F.col("_gn") / F.col("_k")).cast("int"))
             .drop("_k", "_gn"))


# Rows per block of a running total: the windows order one block each, and the last one a row per block.
BLOCK = 16_384


def block_levels(n: int) -> int:
    """Levels of blocks above ``n`` rows until one block holds the rest."""
    levels = 0
    while n > BLOCK:
        n, levels = -(-n // BLOCK), levels + 1
    return levels


def running_total(df: DataFrame, g: Sequence[str], pos_col: str, value: str, out: str, levels: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` up to each row's position within its group (positions dense from 1).

    A tree of block sums: no window sees more than ``BLOCK`` rows.  Its depth follows the longest group.
    """
    g = list(g)
    if levels is None:
        levels = block_levels(df.agg(F.max(pos_col)).first()[0] or 0)
    if levels == 0:
        w = Window.partitionBy(*g).orderBy(pos_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(w))
    blk, upto = f"_blk{levels}", f"_upto{levels}"
    x = df.withColumn(blk, F.floor((F.col(pos_col) - 1) / BLOCK).cast("long") + 1)
    sums = x.groupBy(*g, blk).agg(F.sum(value).alias("_sum"))
    sums = running_total(sums, g, blk, "_sum", upto, levels - 1)
    before = sums.select(*g, blk, (F.col(upto) - F.col("_sum")).alias("_before"))
    w = Window.partitionBy(*g, blk).orderBy(pos_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn(out, F.sum(value).over(w))
    return _join(x, before, [*g, blk]).withColumn(out, F.col(out) + F.col("_before")).drop(blk, "_before")


def _k_expr(target: float, header_bytes: int) -> Column:
    """k = max(1, floor(limit*fill / bytes_per_row)), bytes_per_row counting the part's header."""
    return F.greatest(F.lit(1).cast("long"),
                      F.floor(F.lit(target) / ((F.lit(header_bytes) + F.col("_sb")) / F.col("_sn"))).cast("long"))


def _slice_bytes(slices: DataFrame, ends: DataFrame, g: list) -> DataFrame:
    """Slices (g, _st, _ln) plus ``_sz``: their bytes, from the running totals at their two borders."""
    def at(col: str, out: str) -> DataFrame:
        return ends.select(*g, F.col("_pos").alias(col), F.col("_cum").alias(out))

    x = slices.withColumns({"_en": F.col("_st") + F.col("_ln") - 1, "_pre": F.col("_st") - 1})
    x = _join(x, at("_en", "_c1"), [*g, "_en"])
    x = _join(x, at("_pre", "_c0"), [*g, "_pre"], "left")
    return x.withColumn("_sz", F.col("_c1") - F.coalesce(F.col("_c0"), F.lit(0))).select(*g, "_st", "_ln", "_sz")


def _halves(over: DataFrame, g: list) -> DataFrame:
    """The two halves of each slice (the first one rounded down)."""
    half = F.floor(F.col("_ln") / 2).cast("long")
    both = F.array(F.struct(F.col("_st").alias("_st"), half.alias("_ln")),
                   F.struct((F.col("_st") + half).alias("_st"), (F.col("_ln") - half).alias("_ln")))
    return over.select(*g, F.explode(both).alias("_h")).select(*g, "_h.*")


def recursive_parts(df: DataFrame, group_cols: Sequence[str], bytes_col: str, limit: float,
                    header_bytes: int, fill: float = S.ROW_SPLIT_FILL, pos_col: str = "pos",
                    part_col: str = "parte") -> DataFrame:
    """R2: row split whose slices are halved while over ``limit`` (single rows stay whole).

    Per segment: k = max(1, floor(limit*fill / bytes_per_row)), with
    bytes_per_row including the part's header; slices of k rows; a slice
    over the limit with more than one row is halved and each half split again.
    ``df`` must carry ``pos_col`` (1-based, dense within group).  Returns ``df``
    plus ``part_col`` (dense from 1 within each group).

    One table (group, position, running bytes) serves all rounds: a slice's
    size is the difference of two of its rows, so a round handles slices, not
    rows.  Rounds go on until no slice is over; a round whose slices do not
    shrink raises.  The part number of a row is the running count of part
    starts, joined to the wide rows once.
    """
    g = list(group_cols)
    target = float(limit) * float(fill)
    narrow = df.select(*g, F.col(pos_col).cast("long").alias("_pos"), F.col(bytes_col).alias("_b"))
    ends = running_total(narrow, g, "_pos", "_b", "_cum").select(*g, "_pos", "_cum").checkpoint(eager=True)

    # first round: a group is one segment; its slice ends are every k-th row and the last one
    segs = ends.groupBy(*g).agg(F.max("_pos").alias("_sn"), F.max("_cum").alias("_sb"))
    segs = segs.withColumn("_k", _k_expr(target, header_bytes)).checkpoint(eager=True)
    if g:
        x = _join(ends, segs, g)
    else:
        whole = segs.first()
        x = ends.withColumns({"_sn": F.lit(whole["_sn"]), "_k": F.lit(whole["_k"])})
    x = x.where((F.col("_pos") % F.col("_k") == 0) | (F.col("_pos") == F.col("_sn")))
    x = x.withColumns({"_i": F.floor((F.col("_pos") - 1) / F.col("_k")).cast("long")})
    x = x.withColumn("_st", F.col("_i") * F.col("_k") + 1).withColumn("_ln", F.col("_pos") - F.col("_st") + 1)
    x = x.select(*g, "_st", "_ln")
    done, longest = [], None
    while True:
        slices = _slice_bytes(x, ends, g).checkpoint(eager=True)
        over = ((F.col("_sz") + header_bytes) > F.lit(limit)) & (F.col("_ln") > 1)
        done.append(slices.where(~over).select(*g, "_st"))
        pending = slices.where(over)
        most = pending.agg(F.max("_ln")).first()[0]
        if most is None:
            break
        if longest is not None and most >= longest:
            raise RuntimeError(f"row split makes no progress: a slice of {most} rows after one of {longest}")
        longest = most
        segs = _slice_bytes(_halves(pending, g), ends, g).withColumnsRenamed({"_ln": "_sn", "_sz": "_sb"})
        segs = segs.withColumn("_k", _k_expr(target, header_bytes))
        i = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_sn") / F.col("_k")).cast("long") - 1))
        x = segs.withColumn("_i", i).select(
            *g, (F.col("_st") + F.col("_i") * F.col("_k")).alias("_st"),
            F.least(F.col("_k"), F.col("_sn") - F.col("_i") * F.col("_k")).alias("_ln"))
    starts = reduce(DataFrame.unionByName, done).select(*g, F.col("_st").alias("_pos"), F.lit(1).alias("_first"))
    marked = _join(ends.select(*g, "_pos"), starts, [*g, "_pos"], "left").withColumn("_first", F.coalesce("_first", F.lit(0)))
    number = running_total(marked, g, "_pos", "_first", part_col)
    number = number.select(*g, F.col("_pos").alias(pos_col), F.col(part_col).cast("int").alias(part_col))
    return _join(df, number, [*g, pos_col])


def part_sizes(df: DataFrame, part_cols: Sequence[str], bytes_col: str, header_bytes: int) -> DataFrame:
    """Rows and exact file bytes (header + BOM included) per part."""
    return df.groupBy(*part_cols).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(bytes_col) + F.lit(header_bytes)).cast("long").alias("bytes"))


def resplit(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence[Column | str], bytes_col: str, header_bytes: int,
            threshold: float = S.RESPLIT_THRESHOLD, targets: Sequence[float] = S.RESPLIT_TARGETS,
            limit: float = S.DATE_SPLIT_LIMIT, level_cols: Sequence[str] = ("sub", "subsub")) -> DataFrame:
    """K7/K8: parts over ``threshold`` are row-split again at ``limit * target``; then the sub-parts.

    Adds one column per target (``sub``, ``subsub``): 0 where the part was not
    split at that level, else the 1-based sub-part number.
    """
    keys = list(part_cols)
    out = df
    for target, level in zip(targets, level_cols):
        # sizes once; every row learns whether its part is over, so the rows are read once for both sides
        sizes = part_sizes(out, keys, bytes_col, header_bytes).select(*keys, (F.col("bytes") > F.lit(threshold)).alias("_big"))
        sized = _join(out, sizes, keys).checkpoint(eager=True)
        big = positions(sized.where("_big").drop("_big"), keys, list(order_cols), pos_col="_rpos")
        big = recursive_parts(big, keys, bytes_col, limit * target, header_bytes, S.ROW_SPLIT_FILL,
                              pos_col="_rpos", part_col=level).drop("_rpos")
        out = sized.where(~F.col("_big")).drop("_big").withColumn(level, F.lit(0)).unionByName(big)
        keys = keys + [level]
    return out


def manifest(df: DataFrame, part_cols: Sequence[str], bytes_col: str, header_bytes: int,
             name: Column | None = None) -> DataFrame:
    """K9/L2: one row per part with its row count, exact bytes and (optionally) file name, ordered by the part keys."""
    m = part_sizes(df, part_cols, bytes_col, header_bytes)
    if name is not None:
        m = m.withColumn("file_name", name)
    return m.orderBy(*part_cols)
