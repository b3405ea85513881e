"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows are cut into blocks (partitions) by a hash of their content.
2. The matrix "rows of block b that go to shard j" is drawn exactly: a binary tree over the
   blocks splits the shard capacities, each split one multivariate hypergeometric draw.
3. Every block is permuted on its own and dealt to the shards as its matrix row says.
4. After the exchange every shard is permuted again, block by block, for the slots.

The outcome has the law of one uniform permutation of all rows cut into shards of exact
sizes (at most one row apart), though no task sees more than a block.  Built-in functions
only.  The matrix is metadata: at most ``MAX_BLOCKS`` x shards numbers.

Cases: an empty table gives no rows.  Null columns hash like values.  Rows that agree in all
key columns are equal for the shuffle, so any order among them is the same outcome.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import free_name, stash, table, unit_interval

MAX_BLOCKS = 65_536


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Number of marked among ``drawn`` of ``total`` rows, by inversion of the distribution at ``u``.

    The weights run over the mode and 9 standard deviations (and 20) on either side, by the
    ratio of neighbours; what lies outside is below the resolution of a double.
    """
    n, k, d = total.cast("double"), marked.cast("double"), drawn.cast("double")
    mode = F.floor((d + 1) * (k + 1) / (n + 2))
    share = k / F.greatest(n, F.lit(1.0))
    spread = F.sqrt(d * share * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1.0)))
    reach = F.ceil(spread * 9) + 20
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total, mode - reach)
    high = F.least(drawn, marked, mode + reach)
    support = F.sequence(low, F.greatest(low, high))

    def ratio(x: Column) -> Column:     # weight(x + 1) / weight(x)
        return (k - x) * (d - x) / ((x + 1) * (n - k - d + x + 1))

    mass = F.aggregate(
        support, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s")),
        lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["s"] + a["w"]).alias("s")),
        lambda a: a["s"])
    return F.aggregate(
        support,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), (mass * u).alias("t"), low.alias("x")),
        lambda a, x: F.struct(
            (a["w"] * ratio(x)).alias("w"), (a["s"] + a["w"]).alias("s"), a["t"].alias("t"),
            F.when(a["s"] <= a["t"], x).otherwise(a["x"]).alias("x")),
        lambda a: a["x"])


def split_capacities(n_left: Column, capacities: Column, seed: int, level: int, node: Column) -> Column:
    """How many places of each shard the left half of a node takes (multivariate hypergeometric)."""
    start = F.struct(
        n_left.alias("need"), F.aggregate(capacities, F.lit(0).cast("long"), lambda a, c: a + c).alias("rest"),
        F.array().cast("array<bigint>").alias("taken"))

    def step(a: Column, c: Column) -> Column:
        u = unit_interval(F.lit(seed), F.lit(level), node, F.size(a["taken"]))
        return F.struct(a["need"].alias("need"), a["rest"].alias("rest"), a["taken"].alias("taken"),
                        c.alias("c"), hypergeometric(a["rest"], c, a["need"], u).alias("x"))

    def merge(a: Column, c: Column) -> Column:
        # the draw is bound once by passing it through a one-element array
        return F.element_at(F.transform(F.array(step(a, c)), lambda s: F.struct(
            (s["need"] - s["x"]).alias("need"), (s["rest"] - s["c"]).alias("rest"),
            F.concat(s["taken"], F.array(s["x"])).alias("taken"))), 1)

    return F.aggregate(capacities, start, merge, lambda a: a["taken"])


def communication_matrix(counts: DataFrame, levels: int, n_shards: int, total: int, seed: int) -> DataFrame:
    """(block, row) for all 2**levels blocks; ``row`` is the array of rows that go to each shard.

    ``counts`` holds (block, n).  One row at first, each level splits every node in two.
    """
    by_block = F.map_from_entries(F.collect_list(F.struct("block", "n")))
    sizes = F.transform(F.sequence(F.lit(0), F.lit(2 ** levels - 1)),
                        lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0).cast("long")))
    capacities = F.array(*[F.lit(total // n_shards + (j < total % n_shards)).cast("long") for j in range(n_shards)])
    nodes = (counts.select(F.col("block").cast("int").alias("block"), "n").agg(by_block.alias("m"))
             .select(F.lit(0).alias("block"), sizes.alias("sizes"), capacities.alias("row")))
    for level in range(levels):
        if level == 6:
            nodes = nodes.repartition(64, "block")
        half = 2 ** (levels - level - 1)
        n_left = F.aggregate(F.slice("sizes", 1, half), F.lit(0).cast("long"), lambda a, c: a + c)
        nodes = nodes.withColumn("left", split_capacities(n_left, F.col("row"), seed, level, F.col("block")))
        halves = F.array(
            F.struct((F.col("block") * 2).alias("block"), F.slice("sizes", 1, half).alias("sizes"),
                     F.col("left").alias("row")),
            F.struct((F.col("block") * 2 + 1).alias("block"), F.slice("sizes", half + 1, half).alias("sizes"),
                     F.zip_with("row", "left", lambda a, b: a - b).alias("row")))
        nodes = nodes.select(F.explode(halves).alias("h")).select("h.*")
    return nodes.select("block", "row")


def top_bits(h: Column, levels: int) -> Column:
    return F.shiftrightunsigned(h, 64 - levels).cast("int") if levels else F.lit(0)


def shuffle_into_shards(df: DataFrame, n_shards: int, key_columns: list[str], seed: int = 1,
                        block_rows: int = 8192) -> DataFrame:
    """Add ``shard`` (0..n-1) and ``slot`` (gapless from 0 in each shard); same rows and seed, same outcome.

    ``key_columns`` identify a row; all columns are carried.  ``df`` is read three times, so
    pass a table that is cheap to read (`stash`).  Input columns ``shard`` or ``slot`` are replaced.
    """
    df = df.drop("shard", "slot")
    names = [free_name(df.columns, n) for n in ("_block", "_order", "_row", "_n")]
    block, order, row, rank = names
    total = df.count()
    if not total:
        return df.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    levels = max(0, math.ceil(math.log2(min(max(total / block_rows, 1), MAX_BLOCKS))))
    keys = [F.col(c) for c in key_columns]
    df = df.withColumns({block: top_bits(F.xxhash64(F.lit(seed), F.lit("block"), *keys), levels),
                         order: F.xxhash64(F.lit(seed), F.lit("deal"), *keys)})
    counts = df.groupBy(F.col(block).alias("block")).agg(F.count("*").alias("n"))
    matrix = communication_matrix(counts, levels, n_shards, total, seed)
    matrix = matrix.select(F.col("block").alias(block), F.col("row").alias(row))
    # running totals of the matrix row: the n-th row of the permuted block goes where n falls
    ends = F.transform(F.sequence(F.lit(1), F.lit(n_shards)),
                       lambda j: F.aggregate(F.slice(row, 1, j), F.lit(0).cast("long"), lambda a, c: a + c))
    matrix = stash(matrix.withColumn(row, ends), "matrix")
    dealt = (df.withColumn(rank, F.row_number().over(Window.partitionBy(block).orderBy(order, *keys)))
             .join(matrix, block)
             .withColumn("shard", F.size(F.filter(row, lambda e: e < F.col(rank))).cast("int"))
             .drop(block, order, row, rank))
    dealt = stash(dealt, "dealt")
    # second permutation: a random order in each shard, cut into sub-blocks so that no task holds a shard
    sub_levels = max(0, levels - int(math.log2(n_shards)))
    dealt = dealt.withColumn(order, F.xxhash64(F.lit(seed), F.lit("slot"), *keys))
    dealt = dealt.withColumn(block, top_bits(F.col(order), sub_levels))
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", block).agg(F.count("*").alias(rank))
              .select("shard", block, F.coalesce(F.sum(rank).over(before), F.lit(0)).alias(row)))
    place = F.row_number().over(Window.partitionBy("shard", block).orderBy(order, *keys))
    return (dealt.withColumn(rank, place).join(starts, ["shard", block])
            .withColumn("slot", (F.col(row) + F.col(rank) - 1).cast("long"))
            .drop(block, order, row, rank))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents into 8 shards whose row counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shuffle_into_shards(stash(docs, "sizes"), 8, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
