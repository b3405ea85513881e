"""Phrase collocations counted by broadcast double-array tries.

1. Words of each language are counted; a phrase can only reach ``least`` occurrences if its words do.
2. Candidates are Apriori-safe: pairs of frequent words, and triples of which both pairs may be frequent,
   whose 64-bit hash occurs ``least`` times or more.  Hashes are counted exactly, distributed by hash; they
   only choose candidates.
3. Candidates become double-array tries over word numbers, about ``TRIE_PHRASES`` phrases each, split by
   first word.  A pass over the text holds up to ``TRIES_HELD`` of them.  Each moves the states of all text
   positions of a segment one level at a time: next = base[state] + label, valid where check[next] is the state;
   a bincount of the accepting states adds up phrases.  Counts of all shards of the text are summed.

Everything is by language (null: ``und``): a word's hash holds its language, so one trie serves all.
All words that a run numbers are told apart by 64-bit hashes; the count of step 1 proves that no two words of
the corpus share one, else another seed is taken.

Cases: null and empty texts have no words.  Repeated rows count as often as they come.  Pieces without words
and words of any length are fine; other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.arrowbytes import flat_bytes, row_groups
from tally.llm.common import ship, stash, table
from tally.llm.jaccard_join import _maybe_in, bitmap
from tally.llm.wordbytes import BLOCK_WORDS, FACTORS, hash_spans, mix

LEAST = 10                      # occurrences of a candidate
LONGEST = 3                     # words of a phrase
TOP = 2000                      # phrases reported for each language
SCALE = 1_000_000
HASHES_HELD = 1 << 22           # of phrases that a task counts before it hands them on
MERGED = 16                     # segments whose words are merged before they leave a task
TRIE_PHRASES = 1 << 19          # about, of one trie; a broadcast of some 70 bytes a phrase
TRIES_HELD = 4                  # that a task counts by in one pass over the text
UNDETERMINED = "und"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BREAK = np.zeros(256, dtype=bool)       # ends a piece
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()                      # ends a word
GAP[[0x20, 0x09]] = True


def language_seed(lang: str, seed: int) -> np.uint64:
    name = np.frombuffer(b"l" + lang.encode(), np.uint8)
    return hash_spans(name, np.array([0]), np.array([len(name)]))[0] ^ mix(np.array([seed + 1], np.uint64))[0]


def token_segments(texts, langs, seed: int):
    """Tokens of Arrow columns in segments: (bytes, first, end, hash with language, room, row).

    ``room`` is the number of tokens from each one to the end of its piece, itself included.
    """
    data, offsets = flat_bytes(texts)
    seeds: dict[str, np.uint64] = {}
    names = [x if x is not None else UNDETERMINED for x in langs.to_pylist()]
    for name in set(names):
        seeds[name] = language_seed(name, seed)
    by_row = np.array([seeds[x] for x in names], np.uint64)
    for a, b in row_groups(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        low = LOWER[data[lo:hi]]
        if not len(low):
            continue
        inside = ~GAP[low]
        border = np.zeros(len(low) + 1, dtype=bool)
        border[offsets[a:b + 1] - lo] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | border[1:-1]
        last[:-1] &= ~inside[1:] | border[1:-1]
        i, j = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(i):
            continue
        row = np.searchsorted(offsets[a:b + 1] - lo, i, side="right") - 1 + a
        piece = np.searchsorted(np.flatnonzero(BREAK[low] | border[:-1]), i, side="right")
        end = np.flatnonzero(np.append(np.diff(piece) != 0, True)) + 1
        room = np.repeat(end, np.diff(end, prepend=0)) - np.arange(len(i))
        yield low, i, j, mix(hash_spans(low, i, j) + by_row[row]), room, row


def phrase_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place (as far as there are so many)."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for x in range(n):
        out += h[x:x + m] * FACTORS[x]
    return mix(out + np.uint64(n))


def _tally(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, a place of each, count)."""
    order = np.argsort(h)
    start = np.flatnonzero(np.append(True, np.diff(h[order]) != 0)[:len(h)])
    return h[order[start]], order[start], np.diff(np.append(start, len(h)))


def unlike_words(low: np.ndarray, i: np.ndarray, j: np.ndarray, row: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Places whose word or language is not that of place ``like``, one with the same hash."""
    size = j - i
    odd = (size != size[like]) | (row != row[like])
    at = np.flatnonzero(~odd & (like != np.arange(len(i))))
    for p in range(0, len(at), BLOCK_WORDS):
        a = at[p:p + BLOCK_WORDS]
        begin = np.cumsum(size[a]) - size[a]
        place = np.arange(int(size[a].sum())) - np.repeat(begin, size[a])
        differ = low[np.repeat(i[a], size[a]) + place] != low[np.repeat(i[like[a]], size[a]) + place]
        odd[a] = np.logical_or.reduceat(differ, begin)
    return np.flatnonzero(odd)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, f): occurrences of each word of ``docs`` (lang, text).

    Words that share a hash with another come out with it, if only with f = 0, so that the clash shows.
    """
    def batches(it):
        for batch in it:
            names = pa.array([x if x is not None else UNDETERMINED for x in batch.column(0).to_pylist()], pa.string())
            parts = []
            _, lang_no = np.unique(names.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for low, i, j, h, _, row in token_segments(batch.column(1), batch.column(0), seed):
                order = np.argsort(h)
                start = np.flatnonzero(np.append(True, np.diff(h[order]) != 0))
                at, n = order[start], np.diff(np.append(start, len(h)))
                like = np.empty(len(h), np.int64)
                like[order] = np.repeat(at, n)
                odd = unlike_words(low, i, j, lang_no[row], like)
                at, n = np.append(at, odd), np.append(n, np.zeros(len(odd), np.int64))
                h = h[at]
                raw = low.tobytes()
                parts.append((h, n, row[at], [raw[a:b] for a, b in zip(i[at].tolist(), j[at].tolist())]))
            for k in range(0, len(parts), MERGED):
                hs, ns, rows, words = zip(*parts[k:k + MERGED])
                # a segment's words are distinct, so equal hashes of one word only meet across segments; unlike words stay apart
                t = pa.table({"lang": names.take(pa.array(np.concatenate(rows))), "word": pa.array(sum(words, []), pa.binary()).cast(pa.string()),
                              "h": np.concatenate(hs).view(np.int64), "f": np.concatenate(ns)})
                t = t.group_by(["lang", "word", "h"]).aggregate([("f", "sum")]).rename_columns(["lang", "word", "h", "f"])
                yield from t.combine_chunks().to_batches()

    rows = ship(docs).select("lang", "text").mapInArrow(batches, "lang string, word string, h long, f long")
    return rows.groupBy("lang", "word").agg(F.max("h").alias("h"), F.sum("f").alias("f"))


def may_be_frequent(h: np.ndarray, room: np.ndarray, n: int, bits: list[np.ndarray]) -> np.ndarray:
    """Places where a phrase of n words may be frequent, as far as the bitmaps of its parts tell."""
    if len(h) < n:
        return np.zeros(0, np.int64)
    m = len(h) - n + 1
    ok = room[:m] >= n
    for k in range(1, min(n, len(bits)) + 1):           # every part of k words
        if k == n:
            places = np.flatnonzero(ok)
            return places[_maybe_in(phrase_hashes(h, n)[places].view(np.int64), bits[k - 1])]
        part = phrase_hashes(h, k) if k > 1 else h
        # one lookup for each place of a part that still matters
        needed = np.zeros(len(part), dtype=bool)
        for x in range(n - k + 1):
            needed[x:x + m] |= ok
        places = np.flatnonzero(needed)
        found = np.zeros(len(part), dtype=bool)
        found[places] = _maybe_in(part[places].view(np.int64), bits[k - 1])
        for x in range(n - k + 1):
            ok &= found[x:x + m]
    return np.flatnonzero(ok)


def frequent_hashes(docs: DataFrame, n: int, bits: list[np.ndarray], least: int, seed: int) -> DataFrame:
    """(h): hashes of phrases of n words that occur ``least`` times or more."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def batches(it):
        held, size = [], 0

        def counted():
            h, _, count = _tally(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count)], names=["h", "n"])

        for batch in it:
            for _, _, _, h, room, _ in token_segments(batch.column(1), batch.column(0), seed):
                held.append(phrase_hashes(h, n)[may_be_frequent(h, room, n, shared.value)])
                size += len(held[-1])
                if size >= HASHES_HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    rows = ship(docs).select("lang", "text").mapInArrow(batches, "h long, n long")
    return rows.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")


def candidates(docs: DataFrame, words: DataFrame, bits: list[np.ndarray], seed: int) -> DataFrame:
    """(h1, h2, h3): distinct phrases of 2 to ``LONGEST`` frequent words that may be frequent; h3 null for pairs."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def batches(it):
        for batch in it:
            parts = []
            for _, _, _, h, room, _ in token_segments(batch.column(1), batch.column(0), seed):
                for n in range(2, LONGEST + 1):
                    at = may_be_frequent(h, room, n, shared.value)
                    if len(at):
                        _, first, _ = _tally(phrase_hashes(h, n)[at])
                        at = at[first]
                        parts.append([h[at], h[at + 1], h[at + 2] if n == 3 else None])
            for h1, h2, h3 in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                     pa.nulls(len(h1), pa.int64()) if h3 is None else pa.array(h3.view(np.int64))], names=["h1", "h2", "h3"])

    rows = stash(ship(docs).select("lang", "text").mapInArrow(batches, "h1 long, h2 long, h3 long").distinct(), "candidates")
    known = words.select("h")
    pairs, triples = rows.filter("h3 IS NULL"), rows.filter("h3 IS NOT NULL").join(known.withColumnRenamed("h", "h3"), "h3", "left_semi")
    rows = pairs.select("h1", "h2", "h3").unionByName(triples.select("h1", "h2", "h3"))
    for c in ("h1", "h2"):
        rows = rows.join(known.withColumnRenamed("h", c), c, "left_semi")
    return rows.select("h1", "h2", "h3")


def word_steps(ids: list[np.ndarray]):
    """The labels of phrases, level by level: the first word's number, then three bytes of each further word; -1 for none."""
    yield ids[0]
    for word in ids[1:]:
        for shift in (16, 8, 0):
            yield np.where(word < 0, -1, word >> shift & 255)


def build_trie(columns: list[np.ndarray], lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of a double-array trie of phrases: columns[k] holds word hash k + 1 of each phrase (any value beyond its length).

    ``codes`` are the sorted hashes of its words; word number x is codes[x].  The root's children lie at their word
    numbers.  Each further word is three steps of one byte, so a node has at most 256 children, which lie
    at base + label.  Nodes with many children get 256 places of their own; those with some draw bases until all
    their places are free, larger ones first; single children fill the places left.  ``accept`` gives the phrase that
    ends in a state, or -1.
    """
    n = len(lengths)
    codes = np.unique(np.concatenate([c[lengths > k] for k, c in enumerate(columns)]))
    ids = [np.where(lengths > k, np.searchsorted(codes, c), -1).astype(np.int32) for k, c in enumerate(columns)]
    width = max(len(codes), 256)
    # nodes level by level, by parent and label; node 0 is the root
    node = np.zeros(n, np.int32)
    parents, labels, total = [], [], 1
    for step in word_steps(ids):
        here = np.flatnonzero(step >= 0)
        distinct, back = np.unique(node[here] * np.int64(width) + step[here], return_inverse=True)
        parents.append((distinct // width).astype(np.int32))
        labels.append((distinct % width).astype(np.int32))
        node[here] = total + back
        total += len(distinct)
    first = 1 + len(parents[0])                             # nodes from here on have a parent below the root
    parent, label = np.concatenate(parents), np.concatenate(labels)
    del ids, parents, labels
    slot, base = np.full(total, -2, np.int32), np.zeros(total, np.int32)      # the root's number is -2
    slot[1:first] = label[:first - 1]
    # children of one parent have numbers in turn
    start = first + np.flatnonzero(np.append(True, np.diff(parent[first - 1:]) != 0)[:total - first])
    fan = np.diff(np.append(start, total))
    holders = parent[start - 1]
    taken = np.zeros(len(codes) + 3 * int(fan[(fan > 1) & (fan <= 16)].sum()) + 512, dtype=bool)
    taken[:len(codes)] = True

    def settle(some: np.ndarray, at: np.ndarray) -> None:
        base[holders[some]] = at
        own = _ranges(start[some], fan[some])
        slot[own] = np.repeat(at, fan[some]) + label[own - 1]
        taken[slot[own]] = True

    rng = np.random.default_rng(3)
    for least, most in ((17, 256), (9, 16), (5, 8), (3, 4), (2, 2)):
        left = np.flatnonzero((fan >= least) & (fan <= most))
        if least == 17:
            end = len(taken)
            taken = np.append(taken, np.zeros(256 * len(left), dtype=bool))
            settle(left, end + 256 * np.arange(len(left)))
            continue
        while len(left):
            at = rng.integers(len(codes), len(taken) - 256, len(left))
            want = np.repeat(at, fan[left]) + label[_ranges(start[left], fan[left]) - 1]
            free = ~taken[want]
            order = np.argsort(want, kind="stable")
            free[order[1:][want[order[1:]] == want[order[:-1]]]] = False        # drawn by an earlier one of this round
            good = np.logical_and.reduceat(free, np.cumsum(fan[left]) - fan[left])
            settle(left[good], at[good])
            if 4 * good.sum() < len(left):
                taken = np.append(taken, np.zeros(4 * int(fan[left].sum()), dtype=bool))
            left = left[~good]
    single = np.flatnonzero(fan == 1)
    room = np.flatnonzero(~taken)
    if len(room) < len(single):
        room = np.append(room, len(taken) + np.arange(len(single) - len(room)))
    own = start[single]
    slot[own] = room[:len(single)]
    base[holders[single]] = slot[own] - label[own - 1]
    size = int(slot.max()) + 1
    check, bases, accept = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.full(size, -1, np.int32)
    check[slot[1:]] = slot[parent]
    bases[slot[1:]] = base[1:]
    accept[slot[node]] = np.arange(n)
    return {"codes": codes, "check": check, "base": bases, "accept": accept}


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start[i] to start[i] + n[i] - 1 in turn."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def trie_counts(trie: dict[str, np.ndarray], distinct: np.ndarray, back: np.ndarray, room: np.ndarray, n: int) -> np.ndarray:
    """Occurrences of each of the trie's n phrases, over all places of a segment; all places move one level at a time.

    The word hash of place p is distinct[back[p]].
    """
    codes, check, base = trie["codes"], trie["check"], trie["base"]
    k = np.minimum(np.searchsorted(codes, distinct), len(codes) - 1).astype(np.int32)
    word = np.where(codes[k] == distinct, k, np.int32(-1))[back]
    total = np.zeros(n, np.int64)
    place = np.flatnonzero(word >= 0)
    place = place[check[word[place]] == -2]
    state = word[place]
    for level in range(1, LONGEST):
        on = np.flatnonzero(room[place] > level)
        place, state = place[on], state[on]
        on = np.flatnonzero(word[place + level] >= 0)
        place, state = place[on], state[on]
        for shift in (16, 8, 0):
            to = base[state] + (word[place + level] >> shift & 255)
            on = np.flatnonzero((to >= 0) & (to < len(check)))
            on = on[check[to[on]] == state[on]]
            place, state = place[on], to[on]
        ended = trie["accept"][state]
        total += np.bincount(ended[ended >= 0], minlength=n)
    return total


def phrase_counts(docs: DataFrame, found: DataFrame, seed: int) -> DataFrame:
    """(h1, h2, h3, a): exact occurrences of candidates, by tries of about ``TRIE_PHRASES`` phrases, some in one pass."""
    spark = docs.sparkSession
    shards = max(1, -(-found.count() // TRIE_PHRASES))
    found = found.withColumn("shard", F.pmod(F.xxhash64("h1"), F.lit(shards)).cast("int"))
    if shards > 1:
        found = stash(found.repartition("shard"), "candidates", partition_by=["shard"])
    def broadcast_trie(shard: int):
        own = found.filter(F.col("shard") == shard).select("h1", "h2", "h3").toArrow()        # one trie's candidates
        if not own.num_rows:
            return None
        lengths = np.where(own.column("h3").is_null().to_numpy(), 2, 3).astype(np.int8)
        columns = [own.column(c).fill_null(0).to_numpy() for c in ("h1", "h2", "h3")]
        return spark.sparkContext.broadcast(build_trie(columns, lengths) | {"phrases": columns + [lengths]})

    out = []
    for start in range(0, shards, TRIES_HELD):
        tries = [x for x in map(broadcast_trie, range(start, min(start + TRIES_HELD, shards))) if x]
        if not tries:
            continue

        def batches(it, tries=tries):
            totals = [np.zeros(len(x.value["phrases"][0]), np.int64) for x in tries]
            for batch in it:
                for _, _, _, h, room, _ in token_segments(batch.column(1), batch.column(0), seed):
                    distinct, back = np.unique(h.view(np.int64), return_inverse=True)
                    for x, total in zip(tries, totals):
                        total += trie_counts(x.value, distinct, back, room, len(total))
            for x, total in zip(tries, totals):
                at = np.flatnonzero(total)
                h1, h2, h3, k = (c[at] for c in x.value["phrases"])
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(h3, mask=k < 3), pa.array(total[at])],
                                                 names=["h1", "h2", "h3", "a"])

        counts = ship(docs).select("lang", "text").mapInArrow(batches, "h1 long, h2 long, h3 long, a long")
        out.append(stash(counts.groupBy("h1", "h2", "h3").agg(F.sum("a").alias("a")), "phrase-counts"))
        for x in tries:                 # the counts are written
            x.destroy()
    if not out:
        return spark.createDataFrame([], "h1 long, h2 long, h3 long, a long")
    return reduce(DataFrame.unionByName, out)


def score(a: str, l: str, r: str):
    """floor(SCALE * a * a / (l * r)) as a long; exact for counts below 10**15, as all products have at most 38 digits."""
    a, l, r = (f"CAST({x} AS DECIMAL(15,0))" for x in (a, l, r))
    return F.expr(f"({a} * {a} * CAST({SCALE} AS DECIMAL(7,0))) div ({l} * {r})").cast("long")


def scored(counts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a, l, r, score, inside): candidates with their lowest-scoring cut and the most frequent longer one."""
    counts = counts.filter(F.col("a") >= least)
    one = words.select("h", "f")
    pairs = counts.filter("h3 IS NULL").drop("h3")
    triples = counts.filter("h3 IS NOT NULL")

    def with_word(df, c):
        return df.join(one.select(F.col("h").alias(c), F.col("f").alias(f"f{c[1]}")), c)

    def with_pair(df, x, y, out):
        return df.join(pairs.select(F.col("h1").alias(x), F.col("h2").alias(y), F.col("a").alias(out)), [x, y])

    # both pairs of a triple occur at least as often, so each join finds its row
    triples = with_pair(with_pair(with_word(with_word(triples, "h1"), "h3"), "h1", "h2", "front"), "h2", "h3", "back")
    triples = stash(triples, "triples")
    first, second = score("a", "f1", "back"), score("a", "front", "f3")
    triples_out = triples.select(
        "h1", "h2", "h3", "a", F.when(first <= second, F.col("f1")).otherwise(F.col("front")).alias("l"),
        F.when(first <= second, F.col("back")).otherwise(F.col("f3")).alias("r"), F.least(first, second).alias("score"),
        F.lit(None).cast("long").alias("inside"))
    longer = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")) \
        .groupBy("h1", "h2").agg(F.max("a").alias("inside"))
    pairs_out = with_word(with_word(pairs, "h1"), "h2").join(longer, ["h1", "h2"], "left").select(
        "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        score("a", "f1", "f2").alias("score"), "inside")
    return pairs_out.unionByName(triples_out)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, spread: int = 50) -> DataFrame:
    """Each language's first ``top`` phrases; a phrase with ``spread`` % of its occurrences inside a longer one is left out.

    ``docs`` (lang, text) is a stable table: it is read several times.
    """
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    seed = 0
    while True:
        counted = stash(word_counts(docs, seed), "word-counts")
        if counted.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
            break
        seed += 1
    words = stash(counted.filter(F.col("f") >= least), "frequent-words")
    bits = [bitmap(words.select("h"))]
    for n in range(2, LONGEST + 1):
        bits.append(bitmap(stash(frequent_hashes(docs, n, bits, least, seed), "frequent-hashes")))
    found = stash(candidates(docs, words, bits, seed), "candidates")
    counts = stash(phrase_counts(docs, found, seed), "phrase-counts")
    kept = scored(counts, words, least).filter(F.expr(f"inside IS NULL OR inside * 100 < a * {spread}"))
    name = words.select("h", "word", "lang")
    for c in ("h1", "h2", "h3"):
        own = name.select(F.col("h").alias(c), F.col("word").alias(f"w{c[1]}"), *(["lang"] if c == "h1" else []))
        kept = kept.join(own, c, "left")
    total = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    kept = kept.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: collocations of two and three words of every language in all documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(pieces) AS piece FROM d)
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM p, unnest([1, 2, 3]) AS t(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(i)
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL
), c AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, x.a AS l, y.a AS r,
    ((c.a::HUGEINT * c.a * 1000000) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM c, unnest(range(1, c.k)) AS t(j)
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), longer AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part, a FROM c WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer q ON b.k = 2 AND q.lang = b.lang AND q.part = b.phrase
  WHERE q.most IS NULL OR 100 * q.most < 50 * b.a
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
