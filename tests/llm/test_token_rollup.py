"""Rollups against a recount, with lost and repeated commits."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tally.llm import token_rollup
from tally.llm.token_rollup import TokenRollup

CHANGE = "kind string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


@pytest.fixture()
def rollup(spark):
    return TokenRollup(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def change(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def read(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_signed_changes(spark, rollup):
    assert read(rollup) == {}
    assert rollup.commit("a", change(spark, ("insert", "s", "en", "v1", 10, None), ("insert", "s", "en", "v1", 5, None),
                                     ("insert", None, None, "v1", 7, None)))
    assert rollup.commit("b", change(spark, ("revise", "s", "en", "v1", 12, 10), ("delete", None, None, "v1", 7, None)))
    got = read(rollup)
    assert got[("s", "en", "v1")] == (2, 17)
    assert got[(None, None, "v1")] == (0, 0)        # kept: its history is not zero


def test_commits_are_idempotent(spark, rollup):
    rows = change(spark, ("insert", "s", "en", "v1", 10, None))
    assert rollup.commit("a", rows)
    assert not rollup.commit("a", rows)
    assert not TokenRollup(spark, rollup.path).commit("a", rows)
    assert read(rollup) == {("s", "en", "v1"): (1, 10)}


def test_half_written_attempt_is_not_read(spark, rollup):
    rows = change(spark, ("insert", "s", "en", "v1", 10, None))
    token_rollup.signed(rows).write.parquet(f"{rollup.path}/deltas/a-lost")
    assert read(rollup) == {}
    assert rollup.commit("a", rows)
    assert read(rollup) == {("s", "en", "v1"): (1, 10)}


def test_compaction_keeps_totals_and_batch_ids(spark, rollup):
    rollup.commit("a", change(spark, ("insert", "s", "en", "v1", 10, None)))
    rollup.commit("b", change(spark, ("insert", "t", "de", "v1", 3, None)))
    before = read(rollup)
    rollup.compact()
    assert read(rollup) == before
    assert not rollup.commit("b", change(spark, ("insert", "t", "de", "v1", 3, None)))
    rollup.commit("c", change(spark, ("delete", "t", "de", "v1", 3, None)))
    rollup.compact()
    assert read(rollup)[("t", "de", "v1")] == (0, 0)


def test_any_batch_id_is_free(spark, rollup):
    for batch, n in (("snapshot_1", 10), ("snapshot_2", 100), ("x", 1000)):
        assert rollup.commit(batch, change(spark, ("insert", "s", "en", "v1", n, None)))
    assert read(rollup) == {("s", "en", "v1"): (3, 1110)}
    rollup.compact()
    assert read(rollup) == {("s", "en", "v1"): (3, 1110)}
    assert rollup.committed() == {"snapshot_1", "snapshot_2", "x"}


def test_commit_during_compaction(spark, rollup, monkeypatch):
    """A batch that is committed while a snapshot is written counts once; so do two snapshots at a time."""
    rollup.commit("a", change(spark, ("insert", "s", "en", "v1", 10, None)))
    sums, other = rollup._sums, TokenRollup(spark, rollup.path)

    def slow(state):
        out = sums(state)
        other.commit("b", change(spark, ("insert", "s", "en", "v1", 100, None)))
        other.compact()
        return out

    monkeypatch.setattr(rollup, "_sums", slow)
    rollup.compact()
    assert read(other) == {("s", "en", "v1"): (2, 110)}
    other.compact()
    assert read(other) == {("s", "en", "v1"): (2, 110)}


def test_crash_within_a_commit(spark, rollup, monkeypatch):
    """A run that dies before the rename leaves no commit; the next one adds the batch."""
    rows = change(spark, ("insert", "s", "en", "v1", 10, None))

    def die(own, target):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(rollup, "_renamed", die)
        with pytest.raises(KeyboardInterrupt):
            rollup.commit("a", rows)
    assert read(rollup) == {} and rollup.committed() == set()
    assert rollup.commit("a", rows)
    assert read(rollup) == {("s", "en", "v1"): (1, 10)}


def test_two_runs_commit_one_batch(spark, rollup):
    """Both saw no commit; the first rename stays."""
    assert rollup._publish("commits", "a", {"data": "deltas/one"})
    own = rollup._path(f"{rollup.path}/attempts/two")
    rollup._fs.create(own, False).close()
    assert not rollup._renamed(own, rollup._path(f"{rollup.path}/commits/a.json"))
    assert rollup._listed("commits")["a"] == {"data": "deltas/one"}


def test_empty_batch(spark, rollup):
    assert rollup.commit("e", spark.createDataFrame([], CHANGE))
    assert read(rollup) == {}
    with pytest.raises(ValueError):
        rollup.commit("../x", spark.createDataFrame([], CHANGE))


def test_query_against_recount(spark):
    from tokenizers import Tokenizer

    from tally.llm.tokens import default_path

    folder = "/root/testdata/sf0.001"
    tok = Tokenizer.from_file(default_path())
    want, seen = {}, set()
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r.doc_id):
        w = want.setdefault((r.source, r.lang), [0, 0, 0])
        w[2] += 1
        if r.text not in seen:
            w[0] += 1
            w[1] += len(tok.encode(r.text or "", add_special_tokens=False).ids)
        if r.text is not None:
            seen.add(r.text)
    got = {(r.source, r.lang): [r.docs, r.tokens, r.docs_inserted] for r in token_rollup.query(spark, folder).collect()}
    assert got == want


def test_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, None, None, 9), (2, "", "s", "en", 9), (3, "two words", "s", "en", 9)],
                                 "doc_id long, text string, source string, lang string, n_tokens long")
    got = {r.doc_id: r.n_tokens for r in token_rollup.count_tokens(docs).collect()}
    assert got[1] == got[2] == 0 and got[3] == 2
    assert token_rollup.count_tokens(docs.filter(F.lit(False))).count() == 0
