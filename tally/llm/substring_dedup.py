"""Substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the least hash of its
runs of ``RUN_WORDS`` words.  Consecutive windows with one minimiser travel as one packed string of
words (a super-k-mer) to the minimiser's bucket, so equal windows meet there.  In a bucket the windows are
numbered exactly, by words and not by hashes, and sorted; each learns the least document that has
it.  What a document loses goes back to it by the digests of its strings.

Equal windows have equal minimisers, so a minimiser that one document alone has names no shared
window.  Minimisers are counted first (`minimisers`); only strings of shared ones travel.

Skew: equal strings of a task are one record with their least and greatest document, so a passage
that many documents share sends a few records and not one for each of them.  Strings of minimisers that
occur more than ``HOT`` times, and buckets of more than ``BUCKET_BYTES``, are not held in a task: their windows
are grouped by an aggregate with partial sums on the way (`overflow_minima`).  The bitmaps that tasks get
have a fixed size; where they cannot tell minimisers apart, more strings travel, none is lost.

Cases: null and empty texts have no words and lose none.  A row without doc_id loses nothing and
takes nothing from others.  Rows that share a doc_id take nothing from one another.  Words are kept as
they are, whatever their length or letters; a text shorter than a window stays whole.  Other columns are
ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import ship, stash, table
from tally.llm.jaccard_join import _maybe_in, bitmap
from tally.llm.wordbytes import FACTORS, byte_pieces, hash_spans, mix, word_array, word_segments

WINDOW = 13
RUN_WORDS = 4                   # of a minimiser
LONGEST = 32                    # windows of a super-k-mer
HOT = 100_000                   # occurrences of a minimiser beyond which no bucket is made
MINIS_HELD = 1 << 20            # minimisers that a task counts before it hands them on
SEEN = 100_000                  # distinct strings that a task holds to merge equal ones
CHUNK_BYTES = 4 << 20           # of strings whose windows are sorted at once
BUCKET_BYTES = 32 << 20         # of one bucket's distinct strings that a task holds
NEVER = np.iinfo(np.int64).max

PACKED = "mini long, packed binary, lo long, hi long, hot boolean"
MINIMA = "fp1 long, fp2 long, minima array<long>, packed binary, lo long, hi long"


def run_hashes(w: np.ndarray) -> np.ndarray:
    n = len(w) - RUN_WORDS + 1
    h = np.zeros(max(0, n), np.uint64)
    for x in range(RUN_WORDS):
        h += w[x:x + len(h)] * FACTORS[x]
    return mix(h)


def minimisers(docs: DataFrame) -> DataFrame:
    """(mini, n): minimisers that two documents or more have, and how often they occur."""
    def batches(it):
        held, size = [], 0

        def counted():
            mini, doc = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((doc, mini))
            mini, doc = mini[order], doc[order]
            start = np.flatnonzero(np.append(True, np.diff(mini) != 0))
            end = np.append(start[1:], len(mini))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (mini[start], doc[start], doc[end - 1], end - start)],
                                              names=["mini", "lo", "hi", "n"])

        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, _, _, mini, _ in _strings(batch.column(1), packed=False):
                held.append((mini, ids[row]))
                size += len(mini)
                if size >= MINIS_HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    found = ship(docs).filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(batches, "mini long, lo long, hi long, n long")
    return found.groupBy("mini").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")) \
        .filter("lo < hi").select("mini", "n")


def super_kmers(w: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimiser) of the super-k-mers of parts that end before the words ``ends``."""
    n = len(w) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    least = run_hashes(w)
    wide, span = 1, WINDOW - RUN_WORDS + 1
    while 2 * wide <= span:             # least of 2, 4, 8, ... neighbours
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[:wide - span], least[span - wide:])
    own_end = np.repeat(ends, np.diff(ends, prepend=0))[:n]
    window = np.flatnonzero(np.arange(n) + WINDOW <= own_end)       # those that lie in one part
    if not len(window):
        return window, window, window
    least = least[window]
    first = np.append(True, (np.diff(window) != 1) | (least[1:] != least[:-1]))
    start = np.flatnonzero(first)
    place = np.arange(len(window)) - np.repeat(start, np.diff(np.append(start, len(window))))
    start = np.flatnonzero(place % LONGEST == 0)
    return window[start], np.diff(np.append(start, len(window))), least[start].view(np.int64)


def _strings(column, shared: np.ndarray | None = None, packed: bool = True):
    """Super-k-mers of an Arrow text column: (row, first word, windows, minimiser, packed string) in turn.

    Only those whose minimiser may be in the bitmap ``shared``, where it is given.
    """
    for rows, bases, ends, words in word_segments(column, WINDOW - 1):
        if len(words) < WINDOW:
            continue
        joined, i, j = word_array(words)
        ends = np.array(ends)
        first, n, mini = super_kmers(hash_spans(np.frombuffer(joined, np.uint8), i, j), ends)
        if shared is not None:
            keep = _maybe_in(mini, shared)
            first, n, mini = first[keep], n[keep], mini[keep]
        if not len(first):
            continue
        part = np.searchsorted(ends, first, side="right")
        word = first - np.append(0, ends[:-1])[part] + np.array(bases)[part]
        strings = [joined[a:b] for a, b in zip(i[first].tolist(), j[first + n + WINDOW - 2].tolist())] if packed else None
        yield np.array(rows)[part], word, n, mini, strings


def _digests(strings: list[bytes]) -> np.ndarray:
    """128 bits of each string, as two signed numbers in a row."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.int64).reshape(-1, 2)


def packed_strings(docs: DataFrame, shared: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Distinct super-k-mers of each task, with the least and the greatest document that has them there."""
    flags = docs.sparkSession.sparkContext.broadcast((shared, hot))
    seen_limit = SEEN

    def batches(it):
        seen: dict[bytes, list] = {}

        def flush():
            mini, lo, hi = (np.array(x, np.int64) for x in zip(*seen.values()))
            out = pa.RecordBatch.from_arrays(
                [pa.array(mini), pa.array(list(seen), pa.binary()), pa.array(lo), pa.array(hi), pa.array(_maybe_in(mini, flags.value[1]))],
                names=["mini", "packed", "lo", "hi", "hot"])
            seen.clear()
            return out

        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, _, _, mini, strings in _strings(batch.column(1), flags.value[0]):
                for m, string, doc in zip(mini.tolist(), strings, ids[row].tolist()):
                    known = seen.get(string)
                    if known is None:
                        seen[string] = [m, doc, doc]
                    elif doc < known[1]:
                        known[1] = doc
                    elif doc > known[2]:
                        known[2] = doc
                if len(seen) >= seen_limit:
                    yield flush()
        if seen:
            yield flush()

    return ship(docs).filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(batches, PACKED)


def rank(codes: np.ndarray) -> np.ndarray:
    """Equal codes to equal numbers from 0."""
    return pd.factorize(codes)[0].astype(np.int64)


def window_minima(strings, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least document of each window, windows of each string) of packed strings in an Arrow binary array.

    Words are numbered by their bytes, then runs of two, four and eight words; two runs of eight
    make a window.  Equal numbers mean equal words throughout.  Sorting brings equal windows together.
    """
    data = np.frombuffer(strings.buffers()[2], np.uint8)
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    data = data[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    gap = np.flatnonzero(data == 0x20)
    bounds = np.sort(np.concatenate([gap - np.arange(len(gap)), offsets - np.searchsorted(gap, offsets)]))     # without spaces
    words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                  [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[data != 0x20])])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.searchsorted(gap, offsets[1:]) - np.searchsorted(gap, offsets[:-1]) + 1 - (WINDOW - 1)      # windows of a string
    two = rank((ids[:-1] << 32) | ids[1:])
    four = rank((two[:-2] << 32) | two[2:])
    eight = rank((four[:-4] << 32) | four[4:])
    code = (eight[:-5] << 32) | eight[5:]
    first = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    owner = np.repeat(np.arange(len(n)), n)
    code = code[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(owner))]
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
    least = np.minimum.reduceat(lo[owner][order], starts)
    out = np.empty(len(owner), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(starts, len(owner))))
    return out, n


def _merged(t: pa.Table) -> pa.Table:
    """Equal strings as one, with the least lo and the greatest hi; (packed, lo, hi)."""
    packed = t.column("packed").combine_chunks()
    code = packed.dictionary_encode()
    own = code.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(own, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(own[order]) != 0))
    lo, hi = (f.reduceat(t.column(c).to_numpy()[order], starts) for f, c in ((np.minimum, "lo"), (np.maximum, "hi")))
    return pa.table({"packed": code.dictionary, "lo": lo, "hi": hi})


def bucket_minima(packed: DataFrame) -> DataFrame:
    """``MINIMA`` of strings of which a document may lose words.  Buckets too large for a task come back as they are."""
    rows = packed.select("mini", "packed", "lo", "hi").repartition("mini").sortWithinPartitions("mini")
    chunk_bytes, bucket_bytes = CHUNK_BYTES, BUCKET_BYTES

    def judged(held: list[pa.RecordBatch]):
        t = _merged(pa.Table.from_batches(held))
        packed, hi = t.column("packed").combine_chunks(), t.column("hi").to_numpy()
        minima, n = window_minima(packed, t.column("lo").to_numpy())
        ends = np.cumsum(n)
        use = pa.array(np.minimum.reduceat(minima, ends - n) < hi)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(minima)).filter(use)
        fp, k = _digests(packed.filter(use).to_pylist()), len(lists)
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[:, 0]), pa.array(fp[:, 1]), lists, pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())],
            names=["fp1", "fp2", "minima", "packed", "lo", "hi"])

    def unjudged(held: list[pa.RecordBatch]):
        for batch in held:
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64())),
                 batch.column("packed"), batch.column("lo"), batch.column("hi")],
                names=["fp1", "fp2", "minima", "packed", "lo", "hi"])

    def batches(it):
        held, size, last, over = [], 0, None, None      # held: whole buckets, and the bucket ``last`` as far as it came
        for batch in it:
            mini = batch.column(0).to_numpy()
            rest = batch.select(["packed", "lo", "hi"])
            cuts = [0, *(np.flatnonzero(np.diff(mini)) + 1).tolist(), len(mini)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                piece, own = rest.slice(a, b - a), int(mini[a])
                if own == over:
                    yield from unjudged([piece])
                    continue
                if own != last:
                    if size >= chunk_bytes:
                        yield judged(held)
                        held, size = [], 0
                    first, before = len(held), size     # where the bucket begins
                    last, over = own, None
                held.append(piece)
                size += _string_bytes(piece)
                if size - before >= bucket_bytes:
                    t = _merged(pa.Table.from_batches(held[first:]))
                    held, size = held[:first] + t.to_batches(), before + t.column("packed").nbytes
                    if 2 * (size - before) >= bucket_bytes:
                        yield from unjudged(t.to_batches())
                        held, size, over = held[:first], before, own
        if held:
            yield judged(held)

    return ship(rows).mapInArrow(batches, MINIMA)


def _string_bytes(batch: pa.RecordBatch) -> int:
    column = batch.column(0)
    ends = np.frombuffer(column.buffers()[1], np.int32)[[column.offset, column.offset + len(column)]]
    return int(ends[1] - ends[0])


def overflow_minima(over: DataFrame) -> DataFrame:
    """(fp1, fp2, minima) of strings (packed, lo) of large buckets: an aggregate over windows, no bucket in one task."""
    def digested(it):
        for batch in it:
            fp = _digests(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(fp[:, 0]), pa.array(fp[:, 1]), *batch.columns], names=["fp1", "fp2", "packed", "lo"])

    own = over.groupBy("packed").agg(F.min("lo").alias("lo"))
    own = stash(ship(own).mapInArrow(digested, "fp1 long, fp2 long, packed binary, lo long"), "large-buckets")
    words = F.split(F.col("packed").cast("string"), " ")
    own = own.select("fp1", "fp2", "lo", words.alias("w"))
    starts = F.sequence(F.lit(1), F.size("w") - (WINDOW - 1))
    windows = own.select("fp1", "fp2", "lo", F.posexplode(F.transform(
        starts, lambda i: F.array_join(F.slice("w", i, F.lit(WINDOW)), " "))).alias("i", "window"))
    least = windows.groupBy("window").agg(F.min("lo").alias("m"))
    joined = windows.join(least, "window").groupBy("fp1", "fp2").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("m"))
    return joined.select("fp1", "fp2", F.col("m.m").alias("minima"))


def covered_starts(docs: DataFrame, shared: np.ndarray, minima: DataFrame) -> DataFrame:
    """(doc_id, text_hash, starts): the windows of each document that a smaller doc_id has; starts lists (word, mask).

    The strings are cut again from the texts.  A bitmap of the digests in ``minima`` drops nearly all others
    before the join, which makes it exact.
    """
    flags = docs.sparkSession.sparkContext.broadcast((shared, bitmap(minima.select("fp1"))))

    def batches(it):
        for batch in it:
            for row, word, _, _, strings in _strings(batch.column(2), flags.value[0]):
                fp = _digests(strings)
                keep = _maybe_in(fp[:, 0], flags.value[1])
                at = pa.array(row[keep])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[keep, 0]), pa.array(fp[keep, 1]), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(word[keep])], names=["fp1", "fp2", "doc_id", "text_hash", "word"])

    found = ship(docs).filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(batches, "fp1 long, fp2 long, doc_id long, text_hash long, word long")
    bits = F.transform("minima", lambda m, i: F.when(m < F.col("doc_id"), F.call_function("shiftleft", F.lit(1).cast("long"), i))
                       .otherwise(F.lit(0).cast("long")))
    mask = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return found.join(minima, ["fp1", "fp2"]).select("doc_id", "text_hash", "word", mask.alias("mask")).filter("mask <> 0") \
        .groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("word", "mask")).alias("starts"))


def kept_words(raw: memoryview, word: np.ndarray, mask: np.ndarray) -> tuple[int, int, str]:
    """(words, removed words, SHA-256 of the kept words joined by spaces) of one text, read in pieces."""
    start = word[:, None] + np.arange(LONGEST)
    start = np.sort(start[(mask[:, None] >> np.arange(LONGEST)) & 1 == 1])
    digest, n, removed, joined = hashlib.sha256(), 0, 0, False
    for piece in byte_pieces(raw):
        words = piece.split()
        near = start[np.searchsorted(start, n - WINDOW + 1):np.searchsorted(start, n + len(words))] - n
        if len(near):
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, np.maximum(near, 0), 1)
            np.add.at(gone, np.minimum(near + WINDOW, len(words)), -1)
            stays = np.cumsum(gone)[:-1] == 0
            n, removed = n + len(words), removed + int(len(words) - stays.sum())
            words = list(compress(words, stays.tolist()))
        else:
            n += len(words)
        if words:
            digest.update((b" " if joined else b"") + b" ".join(words))
            joined = True
    return n, removed, digest.hexdigest()


def deduplicate(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row of ``docs`` (doc_id, text), a stable table."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stash(minimisers(docs), "minimisers")
    shared, hot = bitmap(found.select("mini")), bitmap(found.filter(F.col("n") > HOT).select("mini"))
    packed = packed_strings(docs, shared, hot)
    if hot.any():
        packed = stash(packed, "packed-strings")
    judged = stash(bucket_minima(packed.filter("NOT hot")), "window-minima")
    minima = judged.filter("packed IS NULL").select("fp1", "fp2", "minima")
    over = judged.filter("packed IS NOT NULL").select("packed", "lo")
    if hot.any():
        over = over.unionByName(packed.filter("hot").select("packed", "lo"))
    if hot.any() or not over.isEmpty():
        minima = stash(minima.unionByName(overflow_minima(over)), "window-minima")
    starts = stash(covered_starts(docs, shared, minima), "covered-starts")
    # only texts that lose words are joined with what they lose; a bitmap of them keeps the others from the shuffle
    losing = docs.sparkSession.sparkContext.broadcast(bitmap(starts.select("text_hash")))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    none = np.zeros(0, np.int64)

    def stated(batch, columns):
        out = []
        for text, *lists in zip(*columns):
            raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            out.append(kept_words(raw, *[x.values.to_numpy() if x.is_valid else none for x in lists] or [none, none]))
        n, removed, digest = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                           pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    def whole(it):
        for batch in it:
            batch = batch.filter(pa.array(~_maybe_in(batch.column(2).to_numpy(), losing.value)))
            yield stated(batch, [batch.column(1)])

    def maybe(it):
        for batch in it:
            yield batch.filter(pa.array(_maybe_in(batch.column(2).to_numpy(), losing.value)))

    def cut(it):
        for batch in it:
            yield stated(batch, [batch.column(c) for c in range(1, 4)])

    result = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    rows = ship(hashed).mapInArrow(maybe, "doc_id long, text string, text_hash long") \
        .join(starts, ["doc_id", "text_hash"], "left") \
        .select("doc_id", "text", F.col("starts.word").alias("word"), F.col("starts.mask").alias("mask"))
    return hashed.mapInArrow(whole, result).unionByName(rows.mapInArrow(cut, result))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: words of all documents without the windows that a smaller doc_id has."""
    return deduplicate(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM d, unnest(range(1, greatest(len(w) - 11, 1))) AS t(i) WHERE doc_id IS NOT NULL
), f AS (
  SELECT win, min(doc_id) AS least FROM s GROUP BY win
), c AS (
  SELECT DISTINCT rid, i + j AS p FROM s JOIN f USING (win), unnest(range(13)) AS t(j) WHERE least < doc_id
), u AS (
  SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), k AS (
  SELECT u.rid, sha256(string_agg(word, ' ' ORDER BY p)) AS h, count(*) AS n FROM u ANTI JOIN c USING (rid, p) GROUP BY u.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, coalesce(h, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""
