"""Packing against the tokenizer itself, the contract's invariants and the size bound."""

import random
import zlib

import numpy as np
import pytest

from tally.llm import packing, tokens

SCHEMA = "doc_id long, text string, sequence_id string"


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma,", "délta", "übung", "x1", "the", "of", "\n", "日本語", "🙂", "<|endoftext|>"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 900))), "clash") for i in range(60)]
    rows += [(100, None, None), (101, "", None), (102, "word " * 9000, None), (0, rows[0][1], "again"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = packing.pack_documents(docs.select("doc_id", "text"), block_items=16)
    return rows, [r.asDict() for r in out.collect()]


def test_ids_and_pieces(packed):
    from tokenizers import Tokenizer

    rows, out = packed
    tok = Tokenizer.from_file(tokens.default_path())
    want = []
    for doc_id, text, _ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or min(1024, len(ids))
        starts = [0, *range(first, len(ids), 1024)]
        for k, s in enumerate(starts):
            part = ids[s:(starts + [len(ids)])[k + 1]]
            want.append((doc_id, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_sequences_are_gapless_and_few(packed):
    _, out = packed
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r["length"] for r in out)
    assert len(by) <= -(-total // 1024) + 6        # blocks of 16 pieces lose little


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_crossover_keeps_every_item():
    rng = random.Random(1)
    sizes = np.array([rng.randint(1, 1023) for _ in range(400)])
    a, b = packing.first_packing(sizes, rng, 1024, 0.0), packing.first_packing(sizes, rng, 1024, 0.8)
    for _ in range(10):
        child = packing.crossover(sizes, a, b, rng, 1024)
        fill = np.bincount(child, weights=sizes)
        assert fill.max() <= 1024 and fill.min() > 0 and fill.sum() == sizes.sum()


def test_evolution_beats_best_fit():
    """Triplets that fill bins exactly: best fit by size misses the optimum, evolution comes nearer."""
    rng = random.Random(2)
    sizes = []
    for _ in range(60):
        a, b = rng.randint(260, 500), rng.randint(260, 380)
        sizes += [a, b, 1024 - a - b]
    sizes = np.array(sorted(sizes, reverse=True))
    plain = int(packing.first_packing(sizes, rng, 1024, 0.0).max()) + 1
    best = packing.evolve(sizes, [], random.Random(3), 1024, 3, 24)[0]
    assert 60 <= int(best.max()) + 1 < plain
    assert np.bincount(best, weights=sizes).max() <= 1024


def test_evolution_reaches_the_bound_where_best_fit_does_not():
    """Many pieces, as in a block of the documents: exact filling gets to the lower bound."""
    rng = random.Random(7)
    sizes = np.array([min(1023, 1 + int(rng.expovariate(1 / 430))) for _ in range(6000)])
    plain = int(packing.first_packing(sizes, rng, 1024, 0.0).max()) + 1
    best = packing.evolve(sizes, [], random.Random(1), 1024, 3, 12)[0]
    fill = np.bincount(best, weights=sizes)
    assert fill.max() <= 1024 and fill.sum() == sizes.sum()
    assert len(fill) <= plain and len(fill) <= -(-int(sizes.sum()) // 1024) + 1


def test_children_are_better_than_both_parents():
    """Crossover itself improves: from two blurred packings, without exact filling."""
    rng = random.Random(4)
    sizes = np.array([rng.randint(20, 700) for _ in range(1500)])
    parents = [packing.first_packing(sizes, rng, 1024, n) for n in (2.0, 2.5)]
    better = min(packing.fitness(sizes, p, 1024) for p in parents)
    assert better[0] > -(-int(sizes.sum()) // 1024)
    best = packing.evolve(sizes, list(parents), rng, 1024, 2, 20)[0]
    assert packing.fitness(sizes, best, 1024) < better


def test_pool_finds_the_greatest_sums():
    rng = random.Random(9)
    for _ in range(200):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 8))]
        least = rng.randint(0, 60)
        most = least + rng.randint(0, 40)
        sums = sizes + [a + b for i, a in enumerate(sizes) for b in sizes[:i]]
        pool = packing.Pool(sizes, range(len(sizes)))
        found = pool.most(least, most)
        assert found == max([s for s in sums if least < s <= most], default=0)
        if found:
            taken = pool.take(found)
            assert sum(sizes[i] for i in taken) == found
            assert sorted(pool.items() + taken) == list(range(len(sizes)))


def test_ties_and_pieces_without_length():
    """Equal sizes, and sizes of zero, each stay one item of one bin."""
    sizes = np.array([512] * 9 + [0] * 5 + [1024 - 512] * 4 + [1])
    for bins in (packing.exact_filling(sizes, 1024), packing.evolve(sizes, [], random.Random(1), 1024, 3, 12)[0]):
        fill = np.bincount(bins, weights=sizes)
        assert len(bins) == len(sizes) and fill.max() <= 1024 and fill.sum() == sizes.sum()


def test_fast_encoder_agrees(spark):
    """The faster encoder gives the ids of the tokenizer file on the given documents."""
    import pandas as pd

    own = tokens.encoder(tokens.default_path())
    texts = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"].dropna().tolist()
    texts += ["a  b\n\n c\t d ", "it's I'LL we've", "1234567 12 1", "é è ñ Ü ß", " ", "\r\n\r\n", "x" * 3000]
    rng, latin = random.Random(1), [chr(i) for i in range(0x280)]
    for c in latin:
        texts += [c, f"a{c}b", f" {c} x", f"{c * 3}  {c}", f"1{c}2", f"it's{c}", f"{c}\n\n{c} "]
    texts += ["".join(rng.choice(latin if rng.random() < 0.3 else "aeiou tnsr.,\n\t12") for _ in range(150)) for _ in range(500)]
    for t in texts:
        assert own.ids(t, True) == own.exact.encode(t, add_special_tokens=False).ids


def test_other_columns_pass_through(spark):
    rows = [(i, 100 + i, f"b{i}", i, "s", "o") for i in range(30)] + [(99, 1024, "full", 1, "s", "o")]
    pieces = spark.createDataFrame(rows, "doc_id long, length long, block string, items int, sequence_id string, offset string")
    out = packing.pack(pieces).collect()
    assert sorted((r.doc_id, r.length, r.block, r["items"]) for r in out) == sorted(r[:4] for r in rows)
    assert all(isinstance(r.sequence_id, int) and isinstance(r.offset, int) for r in out)


def test_a_column_named_like_the_sort_key(spark):
    rows = [(i, 100 + 7 * i % 500, "mine") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, length long, _by string")
    got = packing.pack(df).collect()
    assert len(got) == 40 and {r["_by"] for r in got} == {"mine"}
