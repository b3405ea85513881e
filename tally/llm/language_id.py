"""Language identification by language-bitmask n-gram filters.

One Bloom filter serves all languages: its slots hold bit masks, one bit for each language (the
languages' filters are the bit slices of one array).  The AND of an n-gram's slots is the set of
languages that contain it.  A text's n-grams are looked up, each language's bits counted, the
counts corrected for the false positives that its slice's fill predicts; the largest decides.

An n-gram is entered for the languages in which it is not much rarer than in the language where
it is most frequent.  Filters are built from a bounded sample: at most ``TRAIN_DOCS`` documents
of each language, chosen by a hash of doc_id, whole texts.

Cases: null texts and texts without a letter are ``und`` with score 0; texts with letters but
without a known n-gram get the language with most training documents, score 0.  Ties go to the
language that sorts first.  Without training rows every text is ``und``.  Repeated rows are
predicted alike.  Very long texts are worked through in segments.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.arrowbytes import SEGMENT_BYTES, flat_bytes, row_groups
from tally.llm.common import DOCUMENT_COLUMNS, ship, table, unit_interval

TRAIN_DOCS = 3000           # of each language
GRAM = 4                    # bytes
HASHES = 3
SLOTS_PER_ENTRY = 12
LEAST_SHARE = 0.2           # of an n-gram's highest relative frequency
LEAST_COUNT = 2
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)

FOLDS, HELD_OUT = 3, 1


def _fold_table() -> np.ndarray:
    """Bytes with ASCII letters in lower case and every other ASCII byte as a space."""
    t = np.arange(256, dtype=np.uint8)
    t[:128] = 0x20
    for c in range(ord("a"), ord("z") + 1):
        t[c] = c
        t[c - 32] = c
    return t


FOLD = _fold_table()


def grams(segment: np.ndarray) -> np.ndarray:
    """The n-gram codes at each byte of a segment (the last GRAM - 1 of them run into nothing and are 0)."""
    b = FOLD[segment]
    # upper case of U+00C0 to U+00DE (lead byte C3) to lower case
    after = np.zeros(len(b), dtype=bool)
    after[1:] = b[:-1] == 0xC3
    b = np.where(after & (b >= 0x80) & (b <= 0x9E) & (b != 0x97), b + 0x20, b).astype(np.uint32)
    codes = np.zeros(len(b), dtype=np.uint32)
    if len(b) >= GRAM:
        n = len(b) - GRAM + 1
        codes[:n] = b[:n] << 24 | b[1:n + 1] << 16 | b[2:n + 2] << 8 | b[3:n + 3]
    return codes


def useful(codes: np.ndarray) -> np.ndarray:
    """N-grams that begin a letter run or lie in one: no space after the first byte."""
    return (codes & 0xFF != 0x20) & (codes >> 8 & 0xFF != 0x20) & (codes >> 16 & 0xFF != 0x20) & (codes != 0)


def segments(data: np.ndarray, offsets: np.ndarray):
    """Yield (rows i..j, bytes, starts in them); long texts come in overlapping segments of one row."""
    for i, j in row_groups(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j == i + 1 and hi - lo > SEGMENT_BYTES:
            for p in range(lo, hi, SEGMENT_BYTES):
                yield i, j, data[p:min(hi, p + SEGMENT_BYTES + GRAM - 1)], np.zeros(1, dtype=np.int64)
        else:
            yield i, j, data[lo:hi], offsets[i:j] - lo


def row_codes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Codes with those that run over the end of their text set to 0."""
    codes = grams(data)
    for k in range(1, GRAM):
        ends = starts[1:] - k
        codes[ends[ends >= 0]] = 0
    codes[~useful(codes)] = 0
    return codes


class Filter:
    """Slots of language masks; picklable, sent to the executors by broadcast."""

    def __init__(self, languages: list[str], entries: list[np.ndarray]):
        self.languages = languages
        n = max([1, *map(len, entries)])
        self.bits = max(10, int(np.ceil(np.log2(n * SLOTS_PER_ENTRY))))
        width = -(-len(languages) // 64)
        self.slots = [np.zeros(1 << self.bits, dtype=np.uint64) for _ in range(width)]
        for k, codes in enumerate(entries):
            for place in self._places(codes.astype(np.uint32)):
                self.slots[k // 64][place] |= np.uint64(1 << k % 64)
        if len(languages) <= 8:     # one byte a slot keeps the array in the processor's cache
            self.slots = [self.slots[0].astype(np.uint8)]
        fill = np.array([((self.slots[k // 64] >> s.dtype.type(k % 64)) & s.dtype.type(1)).mean()
                         for k in range(len(languages)) for s in [self.slots[k // 64]]])
        self.false_positive = fill ** HASHES

    def _places(self, codes: np.ndarray):
        mixed = codes ^ (codes >> np.uint32(15))
        for m in MULTIPLIERS[:HASHES]:
            yield (mixed * np.uint32(m)) >> np.uint32(32 - self.bits)

    def masks(self, codes: np.ndarray) -> list[np.ndarray]:
        out = None
        for place in self._places(codes):
            got = [s[place] for s in self.slots]
            out = got if out is None else [a & b for a, b in zip(out, got)]
        return out

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each text, and how many of them each language contains, corrected for false positives."""
        n_rows, n_langs = len(offsets) - 1, len(self.languages)
        total, found = np.zeros(n_rows), np.zeros((n_rows, n_langs))
        for i, j, part, starts in segments(data, offsets):
            if not len(part):
                continue
            codes = row_codes(part, starts)
            keep = np.flatnonzero(codes)
            ends = np.searchsorted(keep, np.append(starts[1:], len(part)))
            begins = np.append(0, ends[:-1])
            total[i:j] += ends - begins
            masks = self.masks(codes[keep])
            for k in range(n_langs):
                m = masks[k // 64]
                sums = np.append(0, np.cumsum(m >> m.dtype.type(k % 64) & m.dtype.type(1), dtype=np.int64))
                found[i:j, k] += sums[ends] - sums[begins]
        fp = self.false_positive
        return total, np.clip((found - total[:, None] * fp) / (1 - fp), 0, None)


ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Filter | None:
    """Build the filter from doc_id, text and non-null lang of the documents that are not held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & F.coalesce(~held_out(), F.lit(True))).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    number = {lang: k for k, lang in enumerate(languages)}
    share = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, train_docs / counts[lang])))])
    sample = rows.filter(unit_interval(F.lit("language"), F.col("doc_id")) < share[F.col("lang")]).select("text", "lang")

    def tally(it):
        for batch in it:
            data, offsets = flat_bytes(batch.column(0))
            langs = np.array([number[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for i, j, part, starts in segments(data, offsets):
                codes = row_codes(part, starts).astype(np.uint64)
                of = np.repeat(langs[i:j], np.diff(np.append(starts, len(part))))
                keys, n = np.unique((of.astype(np.uint64) << np.uint64(32) | codes)[codes != 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["key", "n"])

    grouped = ship(sample).mapInArrow(tally, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # the sample is bounded, and with it the number of different n-grams
    pdf = grouped.filter(F.col("n") >= LEAST_COUNT).toPandas()
    key = pdf["key"].to_numpy(dtype=np.int64)
    pdf["lang"], pdf["code"] = key >> 32, key & 0xFFFFFFFF
    pdf["share"] = pdf["n"] / pdf.groupby("lang")["n"].transform("sum")
    pdf = pdf[pdf["share"] >= LEAST_SHARE * pdf.groupby("code")["share"].transform("max")]
    entries = [np.sort(pdf.loc[pdf["lang"] == k, "code"].to_numpy()) for k in range(len(languages))]
    found = Filter(languages, entries)
    found.fallback = max(languages, key=lambda x: (counts[x], [-ord(c) for c in x]))
    return found


def predict(docs: DataFrame, model: Filter | None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to a table with a ``text`` column (all other columns pass through).

    The score is the share of the text's n-grams that the predicted language contains.
    """
    docs = docs.drop("lang_pred", "score")
    others = [c for c in docs.columns if c != "text"]
    docs = docs.select(*others, "text")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it):
        own = shared.value
        for batch in it:
            data, offsets = flat_bytes(batch.column(len(others)))
            total, found = own.count(data, offsets)
            best = found.argmax(axis=1)
            score = found[np.arange(len(best)), best] / np.maximum(total, 1)
            langs = []
            for i in range(len(best)):
                # marks can match n-grams too, so letters are asked for first
                if not has_letter(data[offsets[i]:offsets[i + 1]].tobytes()):
                    langs.append("und")
                    score[i] = 0
                else:
                    langs.append(own.languages[best[i]] if found[i, best[i]] > 0 else own.fallback)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs), pa.array(np.clip(score, 0, 1))],
                names=[*others, "text", "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return ship(docs).mapInArrow(batches, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


# Documents of which the best language contains less than this share of the n-grams are no known language.
LEAST_SCORE = 0.3


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents in no known language go; the others carry the predicted language."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    out = predict(docs, train(docs)).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return out.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")
