"""Held-out accuracy, the bit-sliced filter and odd texts."""

import numpy as np
from pyspark.sql import functions as F

from tally.llm import language_id as li


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = li.query(spark, folder).filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_never_read(spark):
    """Labels and texts of held-out documents change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    twisted = docs.withColumn("lang", F.when(li.held_out(), "zz").otherwise(F.col("lang")))
    a, b = li.train(docs), li.train(twisted)
    assert a.languages == b.languages
    assert all((x == y).all() for x, y in zip(a.slots, b.slots))


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    entries = [np.unique(rng.integers(1, 1 << 31, 500)).astype(np.uint32) for _ in range(70)]
    f = li.Filter([f"l{i:02d}" for i in range(70)], entries)
    for k in (0, 63, 64, 69):
        masks = f.masks(entries[k])
        assert ((masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all()
    other = rng.integers(1, 1 << 31, 20000).astype(np.uint32)
    rate = ((f.masks(other)[0] >> np.uint64(5)) & np.uint64(1)).mean()
    assert abs(rate - f.false_positive[5]) < 0.02


def test_odd_texts(spark):
    train = [(i, t, lang, "x") for i, (t, lang) in enumerate(
        [("the cat sat on the mat and the dog ran off", "en"), ("der hund und die katze sind im garten", "de")] * 30)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string, score string")
    model = li.train(docs)
    odd = [(1, None), (2, ""), (3, "123 !? 456"), (4, "日本語"), (5, "THE CAT and the dog " * 200_000), (6, "der Garten"),
           (6, "der Garten"), (None, "the mat"), (8, "a")]
    got = li.predict(spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang_pred", F.lit("clash")), model)
    rows = got.collect()
    assert len(rows) == len(odd) and got.columns.count("lang_pred") == 1
    by = {(r.doc_id, r.text[:3] if r.text else r.text): r for r in rows}
    assert [by[k].lang_pred for k in ((1, None), (2, ""), (3, "123"))] == ["und"] * 3
    assert by[(4, "日本語")].lang_pred in ("en", "de") and by[(4, "日本語")].score == 0
    assert by[(5, "THE")].lang_pred == "en" and by[(6, "der")].lang_pred == "de" and by[(None, "the")].lang_pred == "en"
    assert by[(8, "a")].lang_pred in ("en", "de")


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = li.train(docs)
    assert model is None
    assert [tuple(r)[-2:] for r in li.predict(docs, model).collect()] == [("und", 0.0)]
    assert li.predict(docs.limit(0), model).count() == 0


def test_segments_of_long_texts_count_alike(monkeypatch):
    f = li.Filter(["a", "b"], [li.grams(np.frombuffer(b"hello world again", np.uint8)), np.array([5], np.uint32)])
    data = np.frombuffer(b"hello world again and again " * 50, np.uint8)
    offsets = np.array([0, len(data)])
    whole = f.count(data, offsets)
    monkeypatch.setattr(li, "SEGMENT_BYTES", 100)
    parts = f.count(data, offsets)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def test_marks_without_letters_are_no_language(spark):
    train = [(i, t, lang, "x") for i, (t, lang) in enumerate(
        [("the cat — and the dog — ran • off € 5", "en"), ("der hund und die katze sind im garten", "de")] * 30)]
    model = li.train(spark.createDataFrame(train, "doc_id long, text string, lang string, score string"))
    odd = [(1, "12 — 34 — • €"), (2, " —"), (3, "— the cat —"), (4, " — 日")]
    got = {r.doc_id: r for r in li.predict(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (1, 2)] == [("und", 0.0)] * 2
    assert [got[i].lang_pred for i in (3, 4)] == ["en"] * 2 and got[3].score > 0
