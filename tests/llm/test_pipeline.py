"""The registered llm queries, their SQL, and the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tally.llm.common import stash, table
from tests_llm_reference import brute_components

SMOKE = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = E.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "n-gram Jaccard join", "source mixing", "best-fit packing"]


@pytest.mark.parametrize("name", ["op5_warc", "op6_source_mixing", "op9_jaccard_join", "op10_quality_rules"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(SMOKE + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    got = E.queries()[name](spark, SMOKE)
    want = con.execute(E.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(d[0] for d in want.description)
    order = [d[0] for d in want.description]
    rows = sorted(tuple(str(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted(tuple(str(r[order.index(c)]) for c in columns) for r in want.fetchall())


def test_stages(spark):
    docs = table(spark, SMOKE, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SMOKE), "test-stage")
        seen.append((name, docs))
        if name != "best-fit packing":
            assert docs.columns == columns, name
    by = dict(seen)
    ids = lambda n: {r.doc_id for r in by[n].select("doc_id").collect()}
    assert ids("quality rules") <= ids("language ID")
    assert ids("n-gram Jaccard join") <= ids("quality rules")
    # exactly the least document of each group of the stage's own input stays
    rows = [(r.doc_id, r.text) for r in by["quality rules"].collect()]
    assert ids("n-gram Jaccard join") == set(brute_components(rows, 5, 80, 100).values())
    assert {r.doc_id for r in by["best-fit packing"].collect()} == ids("source mixing")
    clean = spark.read.parquet(f"{SMOKE}/labels.parquet").filter("quality = 1").select("doc_id")
    words = table(spark, SMOKE, "documents").join(clean, "doc_id").filter("size(split(text, '\\\\s+')) >= 12").select("doc_id")
    lost = {r.doc_id for r in words.collect()} - ids("quality rules")
    assert len(lost) <= 2, lost


def test_null_and_empty_documents(spark):
    good = "The and of is there, and it was with them. " * 3
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, good, "en", None, 9), (4, good, "en", "a", 9),
            (4, good, "en", "a", 9), (None, good + "More words are here at the end of it all, you see.", "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SMOKE), "test-stage")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stash(stage(spark, empty, SMOKE), "test-stage")
    assert empty.count() == 0
