"""Sharding: the draw's distribution, exact sizes, uniformity."""

from collections import Counter
from math import comb

from pyspark.sql import functions as F

from tally.llm import sharding as sh


def test_hypergeometric_distribution(spark):
    n, k, d, draws = 40, 15, 12, 20_000
    got = Counter(r.x for r in spark.range(draws).select(sh.hypergeometric(
        F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(d).cast("long"), sh.unit_interval(F.col("id"))).alias("x")).collect())
    chi = sum((got[x] - e) ** 2 / e for x in range(d + 1)
              if (e := draws * comb(k, x) * comb(n - k, d - x) / comb(n, d)) >= 5)
    assert chi < 35 and set(got) <= set(range(d + 1))


def test_hypergeometric_borders(spark):
    cases = [(10, 0, 5, 0), (10, 10, 5, 5), (10, 3, 10, 3), (10, 3, 0, 0), (0, 0, 0, 0)]
    df = spark.createDataFrame([(c, u / 10) for c in cases for u in range(10)], "c struct<a:long,b:long,d:long,e:long>, u double")
    assert df.filter(sh.hypergeometric(F.col("c.a"), F.col("c.b"), F.col("c.d"), F.col("u")) != F.col("c.e")).count() == 0


def test_large_draw_stays_in_range(spark):
    df = spark.range(20).select(sh.hypergeometric(F.lit(10 ** 10), F.lit(10 ** 10 // 8), F.lit(5 * 10 ** 9),
                                                  sh.unit_interval(F.col("id"))).alias("x"))
    mean = 10 ** 10 // 16
    assert all(abs(r.x - mean) < 8 * 16_600 for r in df.collect())


def place(spark, n, **options):
    df = spark.range(n).withColumnRenamed("id", "k").withColumn("shard", F.lit("clash"))
    return [(r.k, r.shard, r.slot) for r in sh.shuffle_into_shards(df, 8, ["k"], **options).collect()]


def test_exact_sizes_and_gapless_slots(spark):
    for n in (0, 1, 7, 8, 1003):
        got = place(spark, n, block_rows=32)
        assert sorted(k for k, _, _ in got) == list(range(n))
        by = {}
        for _, s, slot in got:
            by.setdefault(s, []).append(slot)
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        assert sorted(map(len, by.values())) == sorted(x for j in range(8) if (x := n // 8 + (j < n % 8)))


def test_same_seed_same_outcome(spark):
    assert sorted(place(spark, 500, block_rows=64)) == sorted(place(spark, 500, block_rows=64))
    assert sorted(place(spark, 500, seed=2, block_rows=64)) != sorted(place(spark, 500, block_rows=64))


def test_uniform_over_seeds(spark):
    """Over many seeds a row meets each shard alike, and neighbours in one block no more often than they should."""
    shards, together = Counter(), 0
    for seed in range(24):
        got = {k: s for k, s, _ in place(spark, 64, seed=seed, block_rows=16)}
        shards.update(got[k] for k in range(0, 64, 5))
        together += sum(got[k] == got[k + 1] for k in range(0, 64, 2))
    n = sum(shards.values())
    assert all(abs(c - n / 8) < 5 * (n / 8) ** 0.5 for c in shards.values())
    expected = 24 * 32 * 7 / 63
    assert abs(together - expected) < 5 * expected ** 0.5


def test_repeated_and_null_rows(spark):
    df = spark.createDataFrame([(1, None)] * 100 + [(None, "x")] * 50, "k long, t string")
    got = sh.shuffle_into_shards(df, 8, ["k", "t"], block_rows=8).collect()
    assert len(got) == 150
    assert max(Counter(r.shard for r in got).values()) - min(Counter(r.shard for r in got).values()) <= 1
    assert len({(r.shard, r.slot) for r in got}) == 150
