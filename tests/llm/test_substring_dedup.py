"""Substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tally.llm import substring_dedup as sd
from tally.llm.common import stash
from tally.llm.wordbytes import PIECE_BYTES, hash_spans, word_array, word_segments

SCHEMA = "doc_id long, text string, n_words string"


def brute(rows):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    least = {}
    for (doc_id, *_), w in zip(rows, split):
        if doc_id is not None:
            for i in range(len(w) - 12):
                key = tuple(w[i:i + 13])
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for (doc_id, *_), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - 12):
            if doc_id is not None and least[tuple(w[i:i + 13])] < doc_id:
                gone.update(range(i, i + 13))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    df = stash(spark.createDataFrame(rows, SCHEMA).repartition(parts), "test-documents")
    return sorted((tuple(r) for r in sd.deduplicate(df).collect()), key=str)


def texts_with_passages(rng, n, vocabulary=60):
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "ß,", "The", "the"]
    passages = [[rng.choice(words) for _ in range(rng.randint(10, 70))] for _ in range(6)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                w += rng.choice(passages)
            else:
                w += [rng.choice(words) for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.1:
            w += ["again"] * rng.randint(12, 60)
        text = "".join(x + rng.choice([" ", "  ", "\n", "\t", "\x0b"]) for x in w)
        rows.append((rng.randint(0, n) if rng.random() < 0.9 else None, text if rng.random() < 0.97 else None, "clash"))
    return rows + rng.sample(rows, n // 10)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(spark, seed):
    rows = texts_with_passages(random.Random(seed), 120)
    assert run(spark, rows) == brute(rows)


def test_large_buckets_go_through_the_aggregate(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 256)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 2048)
    rows = texts_with_passages(random.Random(3), 80, vocabulary=3)
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(sd, "HOT", 20)
    monkeypatch.setattr(sd, "SEEN", 10)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"z{i % 977}y{i}" for i in range(250_000))
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(5, None, None), (4, "", None), (9, " \n\t", None), (1, long, None), (6, "x " + long + " end", None),
            (2, passage, None), (3, passage, None), (3, passage, None), (None, passage, None), (7, passage.upper(), None),
            (8, "lead " + passage + " trail", None), (10, " ".join(passage.split()[:12]), None), (-4, "lead " + passage, None)]
    assert len(long) > PIECE_BYTES
    got = run(spark, rows)
    assert got == brute(rows)
    assert (6, 250_002, 250_000, hashlib.sha256(b"x end").hexdigest()) in got
    assert (8, 15, 14, hashlib.sha256(b"trail").hexdigest()) in got


def test_empty(spark):
    assert run(spark, []) == []


def test_segments_hold_every_window_once(monkeypatch):
    from tally.llm import wordbytes

    monkeypatch.setattr(wordbytes, "PIECE_BYTES", 64)
    rng = random.Random(4)
    texts = [" ".join(f"{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 20, 200]))) for _ in range(40)] + [None]
    got = {}
    for rows, bases, ends, words in word_segments(pa.array(texts), 12):
        p = 0
        for row, base, e in zip(rows, bases, ends):
            for i in range(p, e - 12):
                key = (row, base + i - p)
                assert key not in got
                got[key] = tuple(words[i:i + 13])
            p = e
    want = {(r, i): tuple(x.encode() for x in t.split()[i:i + 13]) for r, t in enumerate(texts) if t
            for i in range(len(t.split()) - 12)}
    assert got == want


def test_super_kmers_share_their_minimiser():
    rng = np.random.default_rng(6)
    words = [b"%d" % x for x in rng.integers(0, 40, 500)]
    joined, i, j = word_array(words)
    w = hash_spans(np.frombuffer(joined, np.uint8), i, j)
    ends = np.array([0, 5, 130, 142, 142, 155, 500])
    first, n, mini = sd.super_kmers(w, ends)
    windows = np.concatenate([np.arange(a, a + k) for a, k in zip(first, n)])
    starts = np.append(0, ends[:-1])
    assert windows.tolist() == [x for a, e in zip(starts, ends) for x in range(a, e - 12)]
    by_window = {}
    for a, k, m in zip(first, n, mini):
        assert 1 <= k <= sd.LONGEST
        for x in range(a, a + k):
            assert by_window.setdefault(tuple(words[x:x + 13]), m) == m     # equal windows have one bucket


def test_word_hashes_tell_words_apart():
    morse = "a"
    while len(morse) < 1024:
        morse += morse.translate({97: "b", 98: "a"})
    words = [morse.encode(), morse.translate({97: "b", 98: "a"}).encode(), b"abba", b"baab"]
    joined, i, j = word_array(words)
    assert len(set(hash_spans(np.frombuffer(joined, np.uint8), i, j).tolist())) == 4
