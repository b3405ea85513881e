"""Jaccard components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tally.llm import jaccard_join as jj
from tally.llm import shingles
from tally.llm.common import stash
from tally.llm.components import components

SCHEMA = "doc_id long, text string, component_id string"


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows, k, num, den):
    sets = [shingle_set(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(find(i), r[0])) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, k=4, num=85, den=100, parts=3):
    df = stash(spark.createDataFrame(rows, SCHEMA).repartition(parts), "test-documents")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(df, k, num, den).collect()), key=str)


def near_copies(rng, n_groups, start=0):
    """Groups of copies with edits around the threshold, chains of edits, and shared passages."""
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows, doc_id = [], start
    for _ in range(n_groups):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        chain = list(words)
        for _ in range(rng.randint(1, 9)):
            copy = list(chain if rng.random() < 0.5 else words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            chain = copy
            text = " ".join(copy)
            if rng.random() < 0.4:
                text += "\n" + passage
            rows.append((doc_id, text.upper() if rng.random() < 0.1 else text, "clash"))
            doc_id += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,num,den", [(1, 4, 85, 100), (2, 5, 80, 100), (3, 2, 50, 100)])
def test_random_near_copies(spark, seed, k, num, den):
    rows = near_copies(random.Random(seed), 45)
    assert run(spark, rows, k, num, den) == brute(rows, k, num, den)


def test_large_group_of_near_copies(spark):
    """Copies of one text that differ in single words: far fewer pairs than all are compared, no link is lost."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(250):
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(80)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(copy), None))
    assert run(spark, rows) == brute(rows, 4, 85, 100)


def test_odd_rows(spark):
    long = " ".join(f"z{i % 977}y{i}" for i in range(250_000))
    rows = [(5, None, None), (4, "", None), (9, " \n\t", None), (8, "one two", None), (3, "ONE  two\n", None),
            (2, "one two three", None), (7, "a b c d e f g h i j", "x"), (7, "a b c d e f g h i j", "x"), (1, long, None),
            (6, long + " end", None), (None, "a b c d e f g h i j", None), (None, "alone in the world today", None),
            (11, "É é a b c", None), (12, "é é a b c", None)]
    got = run(spark, rows)
    assert got == sorted([(5, 0, 5), (4, 0, 4), (9, 0, 9), (8, 1, 3), (3, 1, 3), (2, 1, 2), (7, 7, 7), (7, 7, 7),
                          (1, 249_997, 1), (6, 249_998, 1), (None, 7, 7), (None, 2, None), (11, 2, 11), (12, 2, 12)], key=str)


def test_empty(spark):
    assert run(spark, []) == []


def test_prefix_rule():
    """Linked sets share min(l) of their chosen prefixes, whatever the weights say."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.where(rng.random(len(a)) < 0.07, rng.integers(0, 1 << 63, len(a), dtype=np.uint64), a))
        common = len(np.intersect1d(a, b))
        weight = rng.integers(0, 255, 1 << 6).astype(np.uint8)
        (pa_, la, _), (pb, lb, _) = (jj.choose_prefix(s, weight, 1.0, 85, 100) for s in (a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_sets_do_not_depend_on_batches(monkeypatch):
    texts = ["a b c d e", None, "", "A  b\tc d\ne", "x", "word " * 300, "é ü ß ñ ö é ü ß", "end"]
    whole = [s.tolist() for s in shingles.sets(pa.array(texts), 4)]
    assert whole[0] == whole[3] and len(whole[0]) == 2 and whole[1] == whole[2] == []
    assert [len(s) for s in whole] == [len(shingle_set(t, 4)) for t in texts]
    one_by_one = [next(iter(shingles.sets(pa.array([t], pa.string()), 4))).tolist() for t in texts]
    assert whole == one_by_one
    monkeypatch.setattr(shingles, "SEGMENT_BYTES", 64)
    assert [s.tolist() for s in shingles.sets(pa.array(texts).slice(0), 4)] == whole
    assert [s.tolist() for s in shingles.sets(pa.array(["pad"] + texts).slice(1), 4)] == whole


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1100))


def test_words_that_a_polynomial_confuses(spark):
    morse = "a"
    while len(morse) < 1024:
        morse += morse.translate({97: "b", 98: "a"})
    rows = [(1, morse, None), (2, morse.translate({97: "b", 98: "a"}), None)]
    assert run(spark, rows) == [(1, 1, 1), (2, 1, 2)]


def test_stage_drops_rows_not_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, "en", "s", 9), (5, text, "en", "s", 9), (5, "a text of its own that no other document has", "en", "s", 9),
            (None, text + " more", "en", "s", 9), (None, "another one that is alone in here too", "de", None, None),
            (7, None, "en", "s", 0), (7, "", "en", "s", 0), (9, "twice the same row is one document", "en", "s", 1),
            (9, "twice the same row is one document", "en", "s", 1)]
    docs = stash(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2), "docs")
    got = sorted((tuple(r) for r in jj.stage(spark, docs, "").collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[4], rows[5], rows[6], rows[7]], key=str)


def test_few_sets_are_made_that_nobody_wants(spark):
    """A bitmap of 16 bits a row took hundreds of the other rows for wanted ones; their sets were shuffled too."""
    docs = spark.range(30_000, numPartitions=4).selectExpr("id AS row", "concat('a b c d', id) AS text")
    wanted = spark.range(0, 4_100).selectExpr("id * 7 AS node")
    made = {r.node for r in jj.sets_of(docs, wanted, 4).select("node").collect()}
    assert made >= {7 * i for i in range(4_100)}
    assert len(made) < 4_100 + 100
