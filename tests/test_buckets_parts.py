"""Buckets (T1-T9), positions (R5), equal-row parts (R1), recursive split (R2) against brute force."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tally import schemas as S
from tally.functions import csvbytes as cb
from tally.operators import buckets as bk
from tally.operators import parts as pt
from tally.operators.positions import ordered_checkpoint, positions
from tally.plans import pipelines as pl


def _dated(spark, days):
    return spark.createDataFrame([(i, d, 100) for i, d in enumerate(days)], "id long, d date, b long") \
        .withColumn("_d", F.col("d").cast("timestamp_ntz"))


def test_bucket_labels_calendar_edges(spark):
    days = [dt.date(2019, 1, 1), dt.date(2020, 12, 31), dt.date(2020, 2, 29), dt.date(2021, 1, 31), None]
    df = _dated(spark, days)
    d0 = F.lit(dt.date(2019, 1, 1))
    out = df.select("id", *[bk.bucket_expr(F.col("_d"), lv, d0, F.lit(2019))[0].alias(lv) for lv in bk.LEVELS])
    got = {r.id: r for r in out.collect()}
    assert got[0]["5y"] == "2019-2023" and got[0]["year"] == "2019" and got[0]["month"] == "01-2019"
    assert got[0]["week"] == "01-01-2019_a_08-01-2019" and got[0]["day"] == "01-01-2019"
    assert got[2]["month"] == "02-2020" and got[2]["day"] == "29-02-2020"
    assert got[1]["year"] == "2020" and got[3]["month"] == "01-2021"
    assert all(got[4][lv] == "sem_data" for lv in bk.LEVELS)


def test_level_choice_coarsest_that_fits(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    df = _dated(spark, days)
    sizes = bk.level_sizes(bk.daily_sizes(df, F.col("_d"), "b"), header_bytes=10)
    # 5y: 40010 bytes; year: 36610 max; month: 3110; week: 710; day: 110
    assert bk.choose_level(sizes, 50000) == "5y"
    assert bk.choose_level(sizes, 20000) == "month"
    assert bk.choose_level(sizes, 800) == "week"
    assert bk.choose_level(sizes, 50) == "day"   # nothing fits: day level, then row split
    summ = {r.level: r for r in bk.level_summary(sizes, 800).collect()}
    assert summ["week"].chosen and not summ["5y"].chosen and summ["day"].fits


def test_positions_dense_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", (i * 7919) % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, id long")
    got = positions(df, ["g"], ["k", "id"], num_partitions=8)
    w = Window.partitionBy("g").orderBy("k", "id")
    want = df.withColumn("rn", F.row_number().over(w))
    diff = got.join(want, ["g", "k", "id"]).where(F.col("pos") != F.col("rn")).count()
    assert diff == 0 and got.count() == 3000
    # the hot group is spread over several range partitions, not one task
    tagged = ordered_checkpoint(df, ["g", "k", "id"], num_partitions=8)
    parts = tagged.where("g = 'hot'").select(F.shiftright("_mid", 33).alias("p")).distinct().count()
    assert parts > 1


def row_counts(sizes, limit, header, fill=0.9):
    """Expected rows per part, from prefix sums: cut points of every interval that is too large, until none is."""
    upto = [0, *itertools.accumulate(sizes)]
    weigh = lambda a, b: header + upto[b] - upto[a]
    cuts, todo = {0, len(sizes)}, [(0, len(sizes))]
    while todo:
        a, b = todo.pop()
        step = max(1, int(limit * fill * (b - a) // weigh(a, b)))
        for x in range(a, b, step):
            y = min(x + step, b)
            cuts |= {x, y}
            if y - x > 1 and weigh(x, y) > limit:
                middle = x + (y - x) // 2
                cuts.add(middle)
                todo += [(x, middle), (middle, y)]
    edges = sorted(cuts)
    return [y - x for x, y in zip(edges, edges[1:])]


def _spark_row_split(spark, sizes, limit, header):
    df = spark.createDataFrame([(i + 1, b) for i, b in enumerate(sizes)], "pos long, b long")
    out = pt.recursive_parts(df, [], "b", limit, header)
    return [r["n"] for r in out.groupBy("parte").agg(F.count("*").alias("n")).orderBy("parte").collect()]


def test_recursive_split_matches_brute_force(spark):
    rng = random.Random(7)
    cases = [
        [100] * 50,                                            # uniform
        [rng.choice([10, 20, 500]) for _ in range(120)],       # high variance: halving needed
        [5000] + [10] * 30,                                    # one row larger than the limit
        [10],                                                  # one row
    ]
    for sizes in cases:
        for limit in (1000, 2500):
            want = row_counts(sizes, limit, 40)
            assert _spark_row_split(spark, sizes, limit, 40) == want, (sizes[:5], limit)


def test_recursive_split_properties(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 300) for _ in range(400)]
    df = spark.createDataFrame([(i + 1, b) for i, b in enumerate(sizes)], "pos long, b long")
    out = pt.recursive_parts(df, [], "b", 2000, 50)
    m = pt.part_sizes(out, ["parte"], "b", 50).orderBy("parte").collect()
    assert [r.parte for r in m] == list(range(1, len(m) + 1))            # dense from 1
    assert all(r.bytes <= 2000 or r.rows == 1 for r in m)               # bounded
    assert sum(r.rows for r in m) == 400                                # a partition of the input
    # threshold re-split (K8) of a compliant set is a no-op
    again = pt.resplit(out, ["parte"], ["pos"], "b", 50, threshold=2000, limit=2000)
    assert again.where("sub != 0 OR subsub != 0").count() == 0 and again.count() == 400


def test_equal_row_parts_edges(spark):
    # groups: one row; n == k; n == k + 1 (k = 4 from the sizes below)
    rows = [("a", 1, 10)] + [("b", i, 10) for i in range(4)] + [("c", i, 10) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, id long, b long")
    header = 0
    limit = 10 * 4 / 0.95 + 0.001          # k = int(limit*0.95 / 10) = 4
    out = pt.equal_row_parts(df, ["g"], ["id"], "b", limit, header)
    got = {(r.g, r.parte): r.n for r in out.groupBy("g", "parte").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 1): 1, ("b", 1): 4, ("c", 1): 4, ("c", 2): 1}
    assert {r.g: r.n_parts for r in out.select("g", "n_parts").distinct().collect()} == {"a": 1, "b": 1, "c": 2}


def test_empty_input_gives_no_parts(spark):
    df = spark.createDataFrame([], "g string, id long, b long")
    assert pt.equal_row_parts(df, ["g"], ["id"], "b", 1000, 10).count() == 0


def test_row_bytes_formula(spark):
    rows = [("a", "x,y", None, 'q"t'), ("", "#h", "çã", " s ")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = [r[0] for r in df.select(cb.row_bytes(df)).collect()]
    # 'a,"x,y",,"q""t"\n' = 16 ; ',#h,çã, s \n' = 13 ('#' is quoted only in the first field)
    assert got == [16, 13]
    lead = spark.createDataFrame([("#x", "#y")], "a string, b string")
    assert lead.select(cb.row_bytes(lead)).first()[0] == len('"#x",#y\n')
    assert cb.header_bytes(["a", "b"]) == 3 + len("a,b\n")
    # and the writer agrees byte for byte
    import glob
    import os

    from tally.session import scratch_path
    from tally.sinks.writers import write_csv
    path = scratch_path(spark, "bytes")
    write_csv(df.coalesce(1), path)
    f = glob.glob(os.path.join(path.replace("file:", ""), "*.csv"))[0]
    assert os.path.getsize(f) == sum(got) + cb.header_bytes(df.columns)


def test_split_by_date_oversize_bucket_gets_row_parts(spark):
    rows = [(i, "01/01/2020" if i < 60 else "15/06/2021", "x" * 20) for i in range(80)]
    df = spark.createDataFrame(rows, "Id long, `Data Emissao` string, t string")
    out, level = pl.split_by_date(df, "Data Emissao", limit=600, prefix="p")
    labels = {r.date_label for r in out.select("date_label").distinct().collect()}
    assert level == "day"
    assert "15-06-2021 (parte 1)" in labels or "15-06-2021" in labels
    assert any(lb.startswith("01-01-2020 (parte") for lb in labels)
    header = cb.header_bytes(df.columns)
    m = pt.part_sizes(out, ["date_label"], "_bytes", header).collect()
    assert all(r.bytes <= 600 for r in m) and sum(r.rows for r in m) == 80


def test_recursive_split_grouped(spark, monkeypatch):
    rng = random.Random(11)
    groups = {"a": [rng.choice([5, 10, 400]) for _ in range(90)], "b": [30] * 40,
              "c": [rng.randint(1, 200) for _ in range(70)]}
    rows = [(grp, i + 1, b) for grp, sizes in groups.items() for i, b in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g string, pos long, b long")
    want = {grp: row_counts(sizes, 900, 25) for grp, sizes in groups.items()}

    def run():
        out = pt.recursive_parts(df, ["g"], "b", 900, 25)
        got = {}
        for r in out.groupBy("g", "parte").agg(F.count("*").alias("n")).orderBy("g", "parte").collect():
            got.setdefault(r.g, []).append(r.n)
        return got

    assert run() == want
    monkeypatch.setattr(pt, "BLOCK", 8)                   # running totals over several levels of blocks
    assert run() == want


def test_a_split_without_progress_raises(spark, monkeypatch):
    """No round limit can lose rows: the loop ends when nothing is over, or raises."""
    df = spark.createDataFrame([(i + 1, 400) for i in range(20)], "pos long, b long")
    monkeypatch.setattr(pt, "_halves", lambda over, g: over.select(*g, "_st", "_ln"))
    monkeypatch.setattr(pt, "_k_expr", lambda target, header: F.lit(5).cast("long"))
    with pytest.raises(RuntimeError, match="no progress"):
        pt.recursive_parts(df, [], "b", 900, 25)


def test_split_plan_has_no_nested_loop_join(spark):
    df = spark.createDataFrame([(i + 1, 100) for i in range(50)], "pos long, b long")
    plan = pt.recursive_parts(df, [], "b", 900, 25)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_month_key_with_year_option(spark):
    rows = [("1", "10/01/2020", 2), ("2", "10/01/2021", 2), ("3", "", 2)]
    df = spark.createDataFrame(rows, "Id string, `Data vencimento` string, Estabelecimento_id int")
    from tally.operators.conform import conform
    t = conform(df, S.PAYABLES_TEMPLATE)
    plain = {r.mes for r in pl.split_by_establishment_month(t).select("mes").collect()}
    yearly = {r.mes for r in pl.split_by_establishment_month(t, with_year=True).select("mes").collect()}
    assert plain == {"1", "sem_data"}                    # Jan 2020 and Jan 2021 share a key by default
    assert yearly == {"2020-01", "2021-01", "sem_data"}


def test_splitters_on_empty_input(spark):
    from tally.operators.conform import conform
    empty = conform(spark.createDataFrame([], "Id string"), S.PAYABLES_TEMPLATE)
    assert pl.split_by_establishment_month(empty).count() == 0
    assert pl.split_by_rows(empty, limit=1000).count() == 0
    out, level = pl.split_by_date(empty, "Data Emissao", limit=1000)
    assert out.count() == 0 and level == "rows"


def test_no_valid_dates_falls_back_to_rows(spark):
    rows = [(i, "sem data", "x" * 30) for i in range(40)]
    df = spark.createDataFrame(rows, "Id long, `Data Emissao` string, t string")
    out, level = pl.split_by_date(df, "Data Emissao", limit=400)
    assert level == "rows"
    m = pt.part_sizes(out, ["parte"], "_bytes", cb.header_bytes(df.columns)).collect()
    assert sum(r.rows for r in m) == 40 and all(r.bytes <= 400 for r in m)


def test_part_numbers_are_never_cut(spark):
    from tally.functions import scalars as fx
    got = spark.createDataFrame([(7,), (999,), (1000,), (12345,)], "n int").select(fx.part_number_text(F.col("n")).alias("t")).collect()
    assert [r.t for r in got] == ["007", "999", "1000", "12345"]


def test_running_totals_at_any_depth(spark, monkeypatch):
    """Blocks of four rows: windows stay within a block, however many levels that takes."""
    from tally.operators import parts as pt
    monkeypatch.setattr(pt, "BLOCK", 4)
    assert [pt.block_levels(n) for n in (0, 4, 5, 16, 17, 64, 65, 1000)] == [0, 0, 1, 1, 2, 2, 3, 4]
    rows = [(g, p, (p * 37) % 11) for g, n in (("a", 300), ("b", 3), (None, 70)) for p in range(1, n + 1)]
    df = spark.createDataFrame(rows, "g string, p long, v long")
    got = {(r.g, r.p): r.t for r in pt.running_total(df, ["g"], "p", "v", "t").collect()}
    want, total = {}, {}
    for g, p, v in rows:
        total[g] = total.get(g, 0) + v
        want[(g, p)] = total[g]
    assert got == want


def test_size_index_follows_appended_batches(spark):
    from tally.session import scratch_path

    df = spark.range(900).select(F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, cast(id % 700 as int))").alias("d"),
                                 (F.col("id") % 50 + 1).alias("b"), F.col("id"))
    df = df.withColumn("d", F.when(F.col("id") % 90 != 0, F.col("d")))      # some rows have no date
    path, compact = scratch_path(spark, "index"), scratch_path(spark, "index-compact")
    for name, cond in [("a", "id < 300"), ("b", "id between 300 and 599"), ("b", "id between 300 and 599")]:
        bk.index_batch(df.where(cond), F.col("d"), "b", path, name)         # b's job ran twice
    bk.compact_index(spark, path, compact, "ab")
    bk.index_batch(df.where("id >= 600"), F.col("d"), "b", compact, "c")
    bk.index_batch(df.where("false"), F.col("d"), "b", compact, "none")
    whole = bk.daily_sizes(df, F.col("d"), "b")
    assert sorted(map(tuple, bk.size_index(spark, compact).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    for limit in (100, 800, 5000, 10_000, 10**6):
        a, b = (bk.choose_level(bk.level_sizes(x, 10), limit) for x in (whole, bk.size_index(spark, compact)))
        assert a == b
    with pytest.raises(ValueError):
        bk.index_batch(df, F.col("d"), "b", path, "../x")
