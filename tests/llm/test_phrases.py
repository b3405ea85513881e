"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tally.llm import phrases as ph
from tally.llm.common import stash

SCHEMA = "lang string, text string, word string, f long"


def brute(rows, least, top, spread):
    f = Counter()
    for lang, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f.update((lang if lang is not None else "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    n = Counter()
    for key, c in f.items():
        if len(key) == 2:
            n[key[0]] += c
    out = []
    cands = {key: a for key, a in f.items() if len(key) >= 3 and a >= least}
    longer = Counter()
    for key, a in cands.items():
        if len(key) == 4:
            for part in ((key[0], *key[1:3]), (key[0], *key[2:4])):
                longer[part] = max(longer[part], a)
    for key, a in cands.items():
        if 100 * longer[key] >= spread * a and longer[key]:
            continue
        lang, *w = key
        score, k = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    out.sort()
    ranked, rank = [], Counter()
    for lang, s, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -s))
    return ranked


def sentences(rng, n):
    words = ["the", "The", "of", "new", "york", "city", "é", "Ü", "x-y", "don't", "a" * 40]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(["new york city", "of the", rng.choice(words)]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "; "])
        rows.append((rng.choice(["en", "en", "de", None]), text if rng.random() < 0.95 else None, "clash", 1))
    return rows


def run(spark, rows, **kw):
    df = stash(spark.createDataFrame(rows, SCHEMA).repartition(3), "test-documents")
    out = ph.collocations(df, **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("seed,least,top,spread", [(1, 10, 2000, 50), (2, 3, 15, 80)])
def test_random_sentences(spark, seed, least, top, spread):
    rows = sentences(random.Random(seed), 150)
    rows += rows[:10]
    assert run(spark, rows, least=least, top=top, spread=spread) == sorted(brute(rows, least, top, spread))


def test_several_tries(spark, monkeypatch):
    monkeypatch.setattr(ph, "TRIE_PHRASES", 15)
    rows = sentences(random.Random(3), 120)
    assert run(spark, rows, least=4) == sorted(brute(rows, 4, 2000, 50))


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None, None, None), (None, "", None, None), ("en", " .;\n", None, None)]) == []


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_007, 4_000_000_009, 123_456_789_012
    got = spark.createDataFrame([(a, l, r), (7, 7, 7)], "a long, l long, r long").select(ph.score("a", "l", "r").alias("s")).collect()
    assert [x.s for x in got] == [1_000_000 * a * a // (l * r), 1_000_000]


def test_trie_counts_every_phrase():
    rng = np.random.default_rng(5)
    for size in (3, 40, 2000, 70_000):
        h = rng.integers(-(1 << 62), 1 << 62, size)
        text = h[np.minimum(rng.geometric(20 / size if size > 400 else 0.05, 5000) - 1, size - 1)]
        phrases = sorted({tuple(text[i:i + k].tolist()) for k in (2, 3) for i in rng.integers(0, 4990, 300)})
        phrases.append((int(h[0]), int(h[0])) if (int(h[0]), int(h[0])) not in phrases else (1, 2))
        lengths = np.array([len(p) for p in phrases])
        columns = [np.array([p[k] if len(p) > k else 0 for p in phrases]) for k in range(3)]
        trie = ph.build_trie(columns, lengths)
        room = rng.integers(1, 6, len(text))
        room = np.minimum(room, np.arange(len(text), 0, -1))
        total = ph.trie_counts(trie, *np.unique(text, return_inverse=True), room, len(phrases))
        want = Counter(tuple(text[i:i + k].tolist()) for k in (2, 3) for i in range(len(text) - k + 1) if room[i] >= k)
        assert total.tolist() == [want[p] for p in phrases]


def test_words_that_share_a_hash_show():
    low = np.frombuffer(b"ab cd ab ae", np.uint8)
    i, j = np.array([0, 3, 6, 9]), np.array([2, 5, 8, 11])
    row = np.zeros(4, np.int64)
    assert ph.unlike_words(low, i, j, row, np.array([0, 0, 0, 3])).tolist() == [1]
    assert ph.unlike_words(low, i, j, np.array([0, 0, 1, 1]), np.array([0, 1, 0, 3])).tolist() == [2]


def test_tokens_of_segments(monkeypatch):
    texts = pa.array(["One two, three", None, "", "a\tb\nC", "x" * 90 + " y"])
    langs = pa.array(["en", None, "en", None, "de"])
    whole = [(low[a:b].tobytes(), int(r), int(room)) for low, i, j, _, rooms, rows in ph.token_segments(texts, langs, 0)
             for a, b, room, r in zip(i, j, rooms, rows)]
    assert whole == [(b"one", 0, 2), (b"two", 0, 1), (b"three", 0, 1), (b"a", 3, 2), (b"b", 3, 1), (b"c", 3, 1),
                     (b"x" * 90, 4, 2), (b"y", 4, 1)]
