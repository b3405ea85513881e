"""Targets against iterated resharing, quotas, and the text that the pipeline takes."""

import pytest
from pyspark.sql import functions as F

from tally.llm import mixture as mx

SCHEMA = "doc_id long, source string, size long, taken string"


def reshared(sizes):
    """The contract read literally: share by weight, stop at twice the source, share the excess again."""
    keys = sorted(sizes, key=lambda k: (k is None, (k or "").encode()))
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(keys)}
    target, left = {k: 0.0 for k in keys}, 1.5 * sum(sizes.values())
    while left > 1e-9:
        open_ = [k for k in keys if target[k] < 2 * sizes[k] - 1e-9]
        if not open_:
            break
        unit = left / sum(weight[k] for k in open_)
        left = 0.0
        for k in open_:
            target[k] += unit * weight[k]
            if target[k] > 2 * sizes[k]:
                left += target[k] - 2 * sizes[k]
                target[k] = 2 * sizes[k]
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 900, "c": 3000, None: 50}, {"a": 10}, {"a": 0, "b": 5}, {"é": 70, "z": 70, "Z": 70, "": 9000},
    {f"s{i}": (i * 37) % 500 for i in range(40)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mx.targets(df.withColumn("key", mx.source_key(F.col("source"))))
           .join(df.withColumn("key", mx.source_key(F.col("source"))).drop("source_size"), "key").collect()}
    assert got == pytest.approx(reshared(sizes), abs=1e-6)


def test_mix(spark):
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", (i * i) % 400, "clash") for i in range(900)]
    rows += [(5000, "long", 30_000, None), (5001, "long", 0, None), (3, "s0", 9, None), (3, "s0", 9, None), (None, "s1", 50, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mx.mix(df).collect()
    assert len(got) == len(rows)
    assert got and all(0 <= r.taken <= 2 * r.size for r in got)
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        spans = [(s["first"], s["end"]) for s in r._spans]
        assert not r.size or (spans[0][0] == 0 and spans[-1][1] == r.size and all(a[1] == b[0] for a, b in zip(spans, spans[1:])))
    for s in taken:
        assert taken[s] == pytest.approx(target[s], rel=0.02, abs=100)
    key = lambda r: (r.doc_id or -1, r.source or "", r.size, r.taken)
    again = mx.mix(df.repartition(5)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty(spark):
    assert mx.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = mx.mix(spark.createDataFrame([(1, None, 0, None)], SCHEMA)).collect()
    assert [(r.taken, r.target) for r in rows] == [(0, 0.0)]


def test_cut():
    text = "  a b\n\nc  d\te f "
    assert mx.cut(text, [(0, 6)]) == "a b\n\nc  d\te f"
    assert mx.cut(text, [(0, 2), (2, 3), (4, 6)]) == "a b\n\nc\ne f"


def test_stage_takes_what_the_mix_takes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mx.stage(spark, docs, "")
    assert out.columns == docs.columns
    words = out.select(F.sum(mx.word_count(F.col("text")))).first()[0]
    plan = mx.query(spark, "/root/testdata/sf0.001").select(F.sum("taken")).first()[0]
    assert words == plan


def test_columns_with_working_names_stay(spark):
    names = ["_key", "_shard", "_order", "_start", "_words", "_blocks", "_copies", "_parts", "_tie", "_place", "extra"]
    rows = [(i, f"s{i % 3}", 50 + i, *names, 0.5) for i in range(60)]
    df = spark.createDataFrame(rows, ["doc_id", "source", "size", *names, "target"])
    got = mx.mix(df)
    plain = {r.doc_id: (r.taken, r.target) for r in mx.mix(df.select("doc_id", "source", "size")).collect()}
    found = got.collect()
    assert {r.doc_id: (r.taken, r.target) for r in found} == plain and len(found) == 60
    assert all([r[n] for n in names] == names for r in found)


def nearness(df):
    got = mx.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    return [r.taken / r.target for r in got]


def test_many_sources_over_many_shards_come_near_their_targets(spark):
    """20 million words of 1,000 equal sources make 20 shards."""
    df = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 1000).alias("source"), F.lit(200).cast("long").alias("size"))
    shares = nearness(df)
    assert len(shares) == 1000 and all(0.97 < x < 1.03 for x in shares)


def test_one_doc_id_for_all_rows_is_dealt_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(mx, "SHARD_WORDS", 4096)
    ids = F.lit(None).cast("long")
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40))
    df = spark.range(6000).select(ids.alias("doc_id"), source.alias("source"), (F.col("id") % 90).alias("size"))
    held = df.withColumns({"_key": mx.source_key(F.col("source")), "_parts": F.lit(60)})
    held = held.withColumn("_shard", mx.shard_of("s", 70, F.lit("")))
    assert held.select("_key", "_shard").distinct().count() == held.select("_key").distinct().count()
    sizes = [r["count"] for r in mx.deal_again(held, "s", 70).filter("source = 'hot'").groupBy("_shard").count().collect()]
    assert len(sizes) > 50 and sum(sizes) == 2000 and max(sizes) < 200
    got = mx.mix(df).collect()
    assert len(got) == 6000 and all(0 <= r.taken <= 2 * r.size for r in got)
    assert all(0.9 < x < 1.1 for x in nearness(df))
    key = lambda r: (r.source, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mx.mix(df.repartition(5)).collect()))
