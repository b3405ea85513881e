"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Sources get target sizes: weights share the mix, no target is above twice its source.
2. A source spreads over as many shards as its words need, others share a shard; in a shard
   each source's documents form one stream of words, cut into equal blocks (of a small stream
   smaller ones, so that its quota is fine enough).
3. Each shard gives its blocks to the sources by the highest quotients votes / (2k + 1), where
   a source's votes are the blocks its target asks for; that makes integer quotas.
4. A quota is met by whole passes over the stream and then by blocks in a seeded order.

A block may begin or end inside a document; the mix takes the words that blocks cover.

Bounds: a shard holds about ``SHARD_WORDS`` words (rows count as one more), so windows by shard or
by (source, shard) are bounded.  Documents are dealt by a hash of doc_id; streams that become far
too large all the same, as many rows share a doc_id, are dealt again by doc_id and position.  One
window runs over all sources, one row for each.

A source's quota in a shard is off by about half a block, so the taken words come within some
1 / ``LEAST_BLOCKS`` of the target; sources of fewer than ``LEAST_BLOCKS * SMALL_BLOCK`` words are coarser.

Cases: null text has no words.  A null source is a source of its own, last in order.  Documents
without words are never taken.  Repeated rows are taken each on its own.  An empty table gives
no rows.  Same rows, same seed: same outcome, ties by hash going to doc_id and size.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import DOCUMENT_COLUMNS, set_aside, ship, stash, table, word_count
from tally.operators.positions import positions

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2
SHARD_WORDS = 1 << 20
BLOCK_WORDS = (64, 1024)            # least and most
BLOCKS_WANTED = 4000                # of a small corpus, for quotas fine enough
LEAST_BLOCKS, SMALL_BLOCK = 64, 16  # a small stream is cut into that many blocks, of so many words at least
OVER = 4                            # streams of more than so many shards' words are dealt again
SEED = "mix-1"
WORKING = ["_key", "_shard", "_order", "_start", "_words", "_blocks", "_copies", "_parts", "_tie", "_place"]    # columns of mix() on its way


def hash60(*parts: Column) -> Column:
    """60 bits of the MD5 of ``parts`` joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Sorts by code point with null last."""
    return F.when(source.isNull(), "z").otherwise(F.concat(F.lit("s"), source))


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size) -> with ``target``: weights share SHARE_PERCENT of all words, capped at MAX_REPEATS.

    Sources fill up in order of cap / weight.  With t words for each unit of weight among
    those not yet full, the first whose cap lies above its share ends the search for t.
    """
    ordered = Window.orderBy("key")
    by_need = Window.orderBy("need", "key")
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    t = sizes.withColumn("weight", F.get(weights, (F.row_number().over(ordered) - 1) % len(WEIGHTS)))
    t = t.withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast("double"))
    t = t.withColumn("need", F.col("cap") / F.col("weight"))
    t = t.withColumns({
        "rest": F.sum("source_size").over(all_rows) * (SHARE_PERCENT / 100)
        - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)),
        "open": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))})
    t = t.withColumn("per_weight", F.col("rest") / F.col("open"))
    first = F.min(F.when(F.col("need") > F.col("per_weight"), F.struct("need", "key", "per_weight"))).over(all_rows)
    t = t.withColumn("level", first["per_weight"])
    return t.select("key", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap"))
                    .alias("target"))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Add size, source_size, target, taken and ``_spans`` to a stable table with doc_id, source and size.

    ``_spans`` lists (first word, end word, copies) in document order; ``taken`` is their sum.  Given columns
    of the names added are replaced, all others stay.
    """
    docs, back = set_aside(docs.drop("source_size", "target", "taken", "_spans"), WORKING)
    docs = docs.withColumn("_key", source_key(F.col("source")))
    sizes = stash(docs.groupBy(F.col("_key").alias("key"))
                  .agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "source-sizes")
    whole = sizes.agg(F.sum("source_size").alias("words"), F.sum("n").alias("rows")).first()
    total, rows = whole["words"] or 0, whole["rows"] or 0
    n_shards = max(1, -(-(total + rows) // SHARD_WORDS))
    block = min(BLOCK_WORDS[1], max(BLOCK_WORDS[0], total // BLOCKS_WANTED))
    parts = F.ceil((F.col("source_size") + F.col("n")) / SHARD_WORDS).cast("long").alias("_parts")
    goals = stash(targets(sizes.select("key", "source_size")).join(sizes.select("key", parts), "key"), "targets")
    goals = goals.withColumnRenamed("key", "_key")

    docs = docs.join(F.broadcast(goals) if _few(sizes) else goals, "_key")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.withColumns({"_shard": shard_of(seed, n_shards, doc), "_order": hash60(F.lit(seed), F.lit("order"), doc)})
    docs = deal_again(docs, seed, n_shards)
    streams = docs.groupBy("_key", "_shard", "target", "source_size").agg(F.sum("size").alias("_words")).filter("_words > 0")
    small = F.least(F.lit(LEAST_BLOCKS), F.floor(F.col("_words") / SMALL_BLOCK))
    streams = streams.withColumn("_blocks", F.greatest(
        F.lit(1), F.round(F.col("_words") / block), small).cast("long")).withColumn(
        "_votes", F.col("target") / F.col("source_size") * F.col("_blocks"))
    # highest quotients in each shard; a source can hold at most MAX_REPEATS times its blocks
    by_shard = Window.partitionBy("_shard")
    seats = F.round(F.sum("_votes").over(by_shard)).cast("long")
    quotients = (streams.withColumn("_seats", seats)
                 .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") * MAX_REPEATS - 1)))
                 .withColumn("_quotient", F.col("_votes") / (2 * F.col("_k") + 1)))
    rank = F.row_number().over(by_shard.orderBy(F.desc("_quotient"), "_key", "_k"))
    quotas = (quotients.withColumn("_won", F.when(rank <= F.col("_seats"), 1).otherwise(0))
              .groupBy("_key", "_shard", "_words", "_blocks").agg(F.sum("_won").alias("_quota")))
    # whole passes, then blocks in seeded order; copies of each block as an array by block number
    blocks = quotas.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    lot = hash60(F.lit(seed), F.lit("block"), F.col("_key"), F.col("_shard").cast("string"), F.col("_b").cast("string"))
    place = F.row_number().over(Window.partitionBy("_key", "_shard").orderBy(lot, "_b"))
    copies = F.floor(F.col("_quota") / F.col("_blocks")) + F.when(place <= F.col("_quota") % F.col("_blocks"), 1).otherwise(0)
    chosen = (blocks.withColumn("_copies", copies.cast("int"))
              .groupBy("_key", "_shard", "_words", "_blocks")
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_copies"))), lambda x: x["_copies"])
                   .alias("_copies")))
    chosen = stash(chosen, "block-copies")

    stream = Window.partitionBy("_key", "_shard").orderBy("_order", "doc_id", "size")
    start = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = docs.withColumn("_start", start).join(chosen, ["_key", "_shard"], "left")
    n, w = F.col("_blocks"), F.col("_words")

    def edge(b: Column) -> Column:      # first word of block b
        return F.floor(w * b / n)

    def holder(p: Column) -> Column:    # block of word p
        return F.floor((n * (p + 1) - 1) / w)

    last = F.col("_start") + F.col("size") - 1
    spans = F.transform(F.sequence(holder(F.col("_start")), holder(last)), lambda b: F.struct(
        F.greatest(edge(b) - F.col("_start"), F.lit(0).cast("long")).alias("first"),
        F.least(edge(b + 1) - F.col("_start"), F.col("size")).alias("end"),
        F.get("_copies", b.cast("int")).alias("copies")))
    empty = F.array().cast("array<struct<first:bigint,end:bigint,copies:int>>")
    placed = placed.withColumn("_spans", F.when(F.col("size") > 0, spans).otherwise(empty))
    taken = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["first"]) * s["copies"])
    return placed.withColumn("taken", taken).drop(*WORKING).withColumnsRenamed(back)


def shard_of(seed: str, n_shards: int, *parts: Column) -> Column:
    """The shard of a row: a source's ``_parts`` shards follow one another, ``parts`` choose among them."""
    part = F.pmod(hash60(F.lit(seed), *parts), F.col("_parts"))
    return F.pmod(hash60(F.lit(seed), F.lit("source"), F.col("_key")) + part, F.lit(n_shards)).cast("long")


def deal_again(docs: DataFrame, seed: str, n_shards: int) -> DataFrame:
    """Deal rows of streams that are far too large by doc_id and position among the rows of that doc_id.

    That happens where very many rows share a doc_id.  Rows alike in source, doc_id and size stand in any order.
    """
    if n_shards <= OVER:        # no stream can hold more than all words
        return docs
    stream = ["_key", "_shard"]
    weights = docs.groupBy(*stream).agg((F.sum("size") + F.count("*")).alias("_words"))
    over = stash(weights.filter(F.col("_words") > OVER * SHARD_WORDS).select(*stream), "large-streams")
    if over.isEmpty():
        return docs
    large = docs.join(over, stream, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    large = positions(large, ["_key", "doc_id"], ["size", "_tie"], "_place")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    large = large.withColumn("_shard", shard_of(seed, n_shards, doc, F.col("_place").cast("string")))
    return docs.join(over, stream, "left_anti").unionByName(large.select(*docs.columns))


def _few(sizes: DataFrame, limit: int = 10_000) -> bool:
    """Whether there are few enough sources to broadcast a row for each (else the join is Spark's choice)."""
    return len(sizes.limit(limit + 1).select("n").collect()) <= limit


def query(spark, sf_dir: str) -> DataFrame:
    """op6: how many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(stash(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of ``spans`` with the white space between them; separate spans become lines."""
    found = list(WORD.finditer(text))
    runs: list[list[int]] = []
    for a, b in spans:
        if runs and runs[-1][1] == a:
            runs[-1][1] = b
        else:
            runs.append([a, b])
    return "\n".join(text[found[a].start():found[b - 1].end()] for a, b in runs)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the mix itself.  A document comes once for each copy that is taken, with the words taken.

    Documents taken in whole keep their text; of others the taken spans remain.
    """
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    docs = docs.withColumn("size", word_count(F.col("text")))
    narrow = stash(docs.select("doc_id", "source", "size", "_row"), "sizes")
    plan = stash(mix(narrow).filter("taken > 0").select("_row", "_spans"), "mix-plan")
    most = F.array_max(F.transform("_spans", lambda s: s["copies"]))
    least = F.array_min(F.transform("_spans", lambda s: s["copies"]))
    # rows are told apart by their place in the table (files): a text that does not fit its spans ends the job
    fits = F.when(F.element_at("_spans", -1)["end"] == F.col("size"), True).otherwise(
        F.raise_error(F.lit("rows were numbered differently when read again: pass a stable table")).cast("boolean"))
    rows = (docs.join(plan, "_row").filter(fits)
            .withColumns({"_most": most, "_least": least})
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_most")))))

    @F.pandas_udf("string")
    def part(text: pd.Series, spans: pd.Series, copy: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else cut(t, [(x["first"], x["end"]) for x in s if x["copies"] >= c])
                          for t, s, c in zip(text, spans, copy)], dtype=object)

    # copies up to the least count are whole; only the others pass their spans to Python
    partial = F.when(F.col("_copy") > F.col("_least"), F.col("_spans"))
    short = part(F.when(partial.isNotNull(), F.col("text")), partial, F.col("_copy"))
    out = ship(rows).withColumn("text", F.coalesce(short, F.col("text")))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT k, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY k
), g AS (
  SELECT sum(source_size)::BIGINT AS total, greatest(1, CAST(ceil((sum(source_size) + sum(n)) / 1048576.0) AS BIGINT)) AS shards,
         least(1024, greatest(64, sum(source_size) // 4000))::DOUBLE AS block FROM s
), w AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY k) - 1) % 3]::DOUBLE AS weight,
         (source_size * 2)::DOUBLE AS cap FROM s
), x AS (
  SELECT *, cap / weight AS need FROM w
), y AS (
  SELECT x.*, ((SELECT total FROM g) * 1.5::DOUBLE - coalesce(sum(cap) OVER e, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS per_weight
  FROM x WINDOW e AS (ORDER BY need, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT first(per_weight ORDER BY need, k) AS level FROM y WHERE need > per_weight
), t AS (
  SELECT k, source_size, coalesce(least(cap, weight * (SELECT level FROM l)), cap) AS target,
         CAST(ceil((source_size + n) / 1048576.0) AS BIGINT) AS parts,
         ('0x' || substr(md5('mix-1:source:' || k), 1, 15))::BIGINT AS first FROM y
), p0 AS (
  SELECT d.*, parts, first, coalesce(doc_id::VARCHAR, '') AS id,
         (first + ('0x' || substr(md5('mix-1:' || id), 1, 15))::BIGINT % parts) % (SELECT shards FROM g) AS shard0,
         ('0x' || substr(md5('mix-1:order:' || id), 1, 15))::BIGINT AS o FROM d JOIN t USING (k)
), p1 AS (
  SELECT *, sum(size + 1) OVER (PARTITION BY k, shard0) > 4 * 1048576 AS again FROM p0
), p AS (
  SELECT doc_id, k, size, o, CASE WHEN again THEN (first + ('0x' || substr(md5('mix-1:' || id || ':'
           || row_number() OVER (PARTITION BY k, again, doc_id ORDER BY size)), 1, 15))::BIGINT % parts) % (SELECT shards FROM g)
         ELSE shard0 END AS shard FROM p1
), st AS (
  SELECT k, shard, sum(size)::BIGINT AS w FROM p GROUP BY k, shard HAVING sum(size) > 0
), sv AS (
  SELECT st.*, greatest(1, CAST(floor(w / (SELECT block FROM g) + 0.5) AS BIGINT), least(64, w // 16)) AS n, target / source_size AS rate
  FROM st JOIN t USING (k)
), sq AS (
  SELECT *, rate * n AS votes, CAST(floor(sum(rate * n) OVER (PARTITION BY shard) + 0.5) AS BIGINT) AS seats FROM sv
), q AS (
  SELECT *, unnest(range(0, n * 2)) AS i FROM sq
), r AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY votes / (2 * i + 1) DESC, k, i) AS pos FROM q
), u AS (
  SELECT k, shard, w, n, sum(CASE WHEN pos <= seats THEN 1 ELSE 0 END)::BIGINT AS quota FROM r GROUP BY k, shard, w, n
), b AS (
  SELECT *, unnest(range(0, n)) AS blk FROM u
), c AS (
  SELECT *, quota // n + CASE WHEN row_number() OVER (PARTITION BY k, shard ORDER BY
      ('0x' || substr(md5('mix-1:block:' || k || ':' || shard || ':' || blk), 1, 15))::BIGINT, blk) <= quota % n
    THEN 1 ELSE 0 END AS copies FROM b
), m AS (
  SELECT p.*, row_number() OVER () AS rid, sum(size) OVER (PARTITION BY k, shard ORDER BY o, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start FROM p
), v AS (
  SELECT rid, sum((least((w * (blk + 1)) // n, start + size) - greatest((w * blk) // n, start)) * copies)::BIGINT AS taken
  FROM m JOIN c USING (k, shard)
  WHERE (w * (blk + 1)) // n > start AND (w * blk) // n < start + size AND size > 0 GROUP BY rid
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM m JOIN t USING (k) LEFT JOIN v USING (rid)
"""
