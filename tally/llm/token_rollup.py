"""Token counts as delta-maintained rollups: totals by source, language and tokenizer version.

A batch of changes is reduced to signed sums for each key and appended under its batch id;
totals are the sum of all committed batches, so nothing is recounted.  Kinds of change:

* ``insert``: +1 document, +n_tokens
* ``delete``: -1 document, -n_tokens (the count that was inserted)
* ``revise``: 0 documents, n_tokens - old_tokens (same key; a moved document is delete + insert)

Commits are idempotent.  A batch's rows are written to a folder of that attempt; one small
commit file then names the attempt.  It is written under a name of its own and renamed, which fails where
the batch already has one: a file that can be seen is whole, and the first attempt stays.  A batch that
has its commit file is skipped, an attempt without one is never read.

A snapshot holds the sums of the batches that it lists, from one listing of the commits.  Snapshots lie in a folder
apart, so any batch id is free for use.  Readers take the snapshot that covers most batches and add the
batches that it does not list; what two compactions at a time write is right whichever of them is read.

Cases: null source, language or text are values of their own (a null text has no tokens).  An empty
batch commits and adds nothing.  Repeated change rows count as often as they come.  Null
counts are 0.  Other columns of a change table are ignored.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import ship, stash, table
from tally.llm.tokens import default_path, encode_column
from tally.session import scratch_path

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens", "docs_inserted", "docs_deleted", "docs_revised", "tokens_inserted", "tokens_deleted",
            "tokens_revised")
SCHEMA = ", ".join([f"{k} string" for k in KEYS] + [f"{m} long" for m in MEASURES])


def signed(changes: DataFrame) -> DataFrame:
    """Signed sums by key of (kind, source, lang, tokenizer, n_tokens, old_tokens)."""
    kind = F.col("kind")
    new, old = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_tokens", "old_tokens"))
    one = F.lit(1).cast("long")
    parts = {
        "docs_inserted": F.when(kind == "insert", one), "tokens_inserted": F.when(kind == "insert", new),
        "docs_deleted": F.when(kind == "delete", one), "tokens_deleted": F.when(kind == "delete", new),
        "docs_revised": F.when(kind == "revise", one), "tokens_revised": F.when(kind == "revise", new - old),
    }
    summed = changes.groupBy(*KEYS).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in parts.items()])
    return summed.withColumns({
        "docs": F.col("docs_inserted") - F.col("docs_deleted"),
        "tokens": F.col("tokens_inserted") - F.col("tokens_deleted") + F.col("tokens_revised"),
    }).select(*KEYS, *MEASURES)


class TokenRollup:
    """Totals kept under ``path``, a folder that driver and executors share (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in ("commits", "snapshots", "attempts"):
            self._fs.mkdirs(self._path(f"{self.path}/{folder}"))

    def _listed(self, folder: str) -> dict[str, dict]:
        """The JSON files of a folder by name: one small file each."""
        out = {}
        for name in sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/{folder}"))):
            if name.endswith(".json"):
                stream = self._fs.open(self._path(f"{self.path}/{folder}/{name}"))
                try:
                    out[name[:-5]] = json.loads(bytes(stream.readAllBytes()).decode())
                finally:
                    stream.close()
        return out

    def _state(self) -> tuple[dict[str, dict], dict | None]:
        """(commits by batch id, the snapshot that covers most of them)."""
        snapshots = self._listed("snapshots")       # first, so that its batches are among the commits listed after it
        return self._listed("commits"), max(snapshots.values(), key=lambda s: len(s["batches"]), default=None)

    def committed(self) -> set[str]:
        return set(self._listed("commits"))

    def _publish(self, folder: str, name: str, data: dict) -> bool:
        """Write a file and rename it; False if another run was first."""
        target = self._path(f"{self.path}/{folder}/{name}.json")
        if self._fs.exists(target):
            return False
        own = self._path(f"{self.path}/attempts/{uuid.uuid4().hex}")
        stream = self._fs.create(own, False)
        try:
            stream.write(bytearray(json.dumps(data).encode()))
        finally:
            stream.close()
        return self._renamed(own, target)

    def _renamed(self, own, target) -> bool:
        """Rename without replacing: the file system's own check decides between two runs."""
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        try:
            files.rename(own, target, options)
            return True
        except Py4JJavaError as e:
            if self._fs.exists(target):
                return False
            raise e

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch once; True if this call added it."""
        if not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch id: letters, digits, - and _ only: {batch_id!r}")
        if batch_id in self.committed():
            return False
        attempt = f"deltas/{batch_id}-{uuid.uuid4().hex[:12]}"
        signed(changes).write.parquet(f"{self.path}/{attempt}")
        return self._publish("commits", batch_id, {"data": attempt})

    def compact(self) -> None:
        """Write the sums of all batches of one listing as a snapshot; batch ids stay known."""
        state = self._state()
        snapshot = f"sums/{uuid.uuid4().hex[:12]}"
        self._sums(state).write.parquet(f"{self.path}/{snapshot}")
        self._publish("snapshots", snapshot[-12:], {"batches": sorted(state[0]), "data": snapshot})

    def _sums(self, state: tuple[dict[str, dict], dict | None]) -> DataFrame:
        commits, snapshot = state
        covered = set(snapshot["batches"]) if snapshot else set()
        parts = [snapshot["data"]] if snapshot else []
        parts += [c["data"] for b, c in commits.items() if b not in covered]
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{p}" for p in parts])
        return rows.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])

    def totals(self, drop_zero: bool = True) -> DataFrame:
        out = self._sums(self._state())
        return out.filter(" OR ".join(f"{m} <> 0" for m in MEASURES)) if drop_zero else out


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, lang, n_tokens, estimate, copy_key): exact ids of whole texts, counted in Arrow batches.

    ``estimate`` is the cheap count that is known before the tokenizer has run: a token for every four bytes.
    """
    path = path or default_path()

    def batches(it):
        for batch in it:
            n = [len(ids) for ids in encode_column(batch.column(0), path)]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), *batch.columns[1:]],
                                             names=["n_tokens", "doc_id", "source", "lang", "estimate", "copy_key"])

    cols = docs.select("text", "doc_id", "source", "lang",
                       F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4).cast("long").alias("estimate"),
                       F.sha2("text", 256).alias("copy_key"))
    return ship(cols).mapInArrow(
        batches, "n_tokens long, doc_id long, source string, lang string, estimate long, copy_key string")


def changes(counted: DataFrame, kind: str, tokenizer: str, n_tokens: str, old_tokens: str | None = None) -> DataFrame:
    old = F.col(old_tokens) if old_tokens else F.lit(None).cast("long")
    return counted.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                          F.col(n_tokens).alias("n_tokens"), old.alias("old_tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document inserted at its estimate, revised to its exact count, later copies of a text deleted.

    The revision is committed twice, as after a lost acknowledgement; the second has no effect.
    """
    name = "byte_bpe_50k"
    counted = stash(count_tokens(table(spark, sf_dir, "documents")), "token-counts")
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load", changes(counted, "insert", name, "estimate"))
    for _ in range(2):
        rollup.commit("recount", changes(counted, "revise", name, "n_tokens", "estimate"))
    # of each text the smallest doc_id stays; only texts that occur again are joined (hot texts: AQE splits the join)
    first = (counted.filter("copy_key IS NOT NULL").groupBy("copy_key")
             .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1"))
    copies = counted.join(first, "copy_key").filter(F.col("doc_id") > F.col("first_id"))
    rollup.commit("copies", changes(copies, "delete", name, "n_tokens"))
    return rollup.totals()
