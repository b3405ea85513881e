"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their shingle sets reaches a threshold t.
Shingles are put in one global order, rare ones first.  If a pair links, the first
|x| - ceil(t|x|) + l shingles of both share at least l.  Each document chooses its own l by the
estimated cost of its candidates: a document whose prefix meets frequent shingles lengthens
it and asks for more matches.  A pair must share min(l_x, l_y) prefix shingles to be compared,
and in any case as many as its overlap needs beyond what the longer rest behind a prefix can give.

The order rests on a sketch of document frequencies over all documents (`frequency_sketch`).
It decides the cost alone; any order gives the same links.

Large groups of near copies are not expanded into pairs: first each prefix shingle's documents
are compared with its most typical document only, and those found linked are one component.
Then all pairs that share enough prefix shingles and are not yet in one component are
compared, so the components are those of all links.  Equal sets are one node from the start.

Cases: a text without words, or null, has an empty set and links with nothing.  Repeated rows
are copies.  A null doc_id is a document as any other; a component's id is its least doc_id
that is not null.  Whole texts are read, however long.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import DOCUMENT_COLUMNS, ship, stash, table
from tally.llm.components import components
from tally.llm.shingles import fingerprint, mix, sets

SKETCH_BITS = (16, 20)          # least and most, log2 of the counters; every task hands on as many bytes
SKETCH_CHUNK = 1 << 12
MOST_MATCHES = 4                # largest l
VERIFY_COST = 8.0               # of a candidate, in postings
STAR_ROUNDS = 2
BLOCK_NODES = 1024              # of a group that meet in one task at a time
BITMAP_BITS = 27                # most, log2 of the bits of a bitmap
NUMBER_BITS, NODE_BITS = 16, 512    # bits for each number, and for each row whose set is made again


def frequency_sketch(docs: DataFrame, k: int, bits: int) -> np.ndarray:
    """Counters of documents by the top bits of a shingle's hash, on a logarithmic scale (one byte each).

    Every task counts all its documents and hands on arrays, which are added up by chunk.
    """
    chunks = 1 << max(0, bits - 12)

    def count(it):
        total, waiting = np.zeros(1 << bits, dtype=np.int32), []
        held = 0

        def add():
            np.add(total, np.bincount(np.concatenate(waiting), minlength=1 << bits).astype(np.int32), out=total)

        for batch in it:
            for s in sets(batch.column(0), k):
                waiting.append((s >> np.uint64(64 - bits)).astype(np.int64))
                held += len(s)
                if held > 1 << 21:
                    add()
                    waiting, held = [], 0
        if waiting:
            add()
        # a task's counter of 255 or more is 255: frequent beyond doubt
        parts = np.minimum(total, 255).astype(np.uint8).reshape(chunks, -1)
        for i in range(0, chunks, 64):
            some = [c for c in range(i, min(i + 64, chunks)) if parts[c].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([parts[c].tobytes() for c in some], pa.binary())],
                names=["chunk", "counts"])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << bits) // chunks, dtype=np.int64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, dtype=np.uint8)
        scaled = np.minimum(255, np.round(8 * np.log2(total + 1))).astype(np.uint8)
        return pd.DataFrame({"chunk": [key[0]], "counts": [scaled.tobytes()]})

    merged = (ship(docs).select("text").mapInArrow(count, "chunk int, counts binary")
              .groupBy("chunk").applyInPandas(merge, "chunk int, counts binary"))
    out = np.zeros((chunks, (1 << bits) // chunks), dtype=np.uint8)
    for r in merged.collect():          # 2**bits bytes in all: 16 MB at most
        out[r["chunk"]] = np.frombuffer(r["counts"], dtype=np.uint8)
    return out.reshape(-1)


def least_overlap(n, num: int, den: int):
    """ceil(t * n) for t = num / den."""
    return (n * num + den - 1) // den


def choose_prefix(s: np.ndarray, weight: np.ndarray, background: float, num: int, den: int) -> tuple[np.ndarray, int, float]:
    """(prefix, l, typicality) of a set: its rarest shingles by the sketch, as many as l asks for.

    For each l the cost is the postings of the prefix and the candidates that could share l of
    its shingles: the documents counted above the sketch's background, divided by l.
    """
    n = len(s)
    frequency = weight[(s >> np.uint64(64 - int(len(weight) - 1).bit_length())).astype(np.int64)]
    order = np.lexsort((s, frequency))
    need = least_overlap(n, num, den)
    short = n - need + 1                                # prefix for l = 1
    most = min(MOST_MATCHES, need)
    ranked = frequency[order[:short + most - 1]]
    others = np.maximum(np.exp2(ranked / 8.0) - 1 - background, 0)
    sums = np.cumsum(others)
    costs = [short + l + sums[short + l - 2] / l * VERIFY_COST for l in range(1, most + 1)]
    l = int(np.argmin(costs)) + 1
    return s[order[:short + l - 1]], l, float(frequency.mean())


PROFILE = ("row long, doc_id long, n long, fp1 long, fp2 long, matches int, typical float, "
           "prefix array<long>")


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text); to be written before it is used, as numbers depend on how a table is split into tasks."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def profiles(docs: DataFrame, sketch: np.ndarray, background: float, k: int, num: int, den: int) -> DataFrame:
    """Set size, fingerprint and adaptive prefix of every row of `numbered`."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def batches(it):
        for batch in it:
            weight, rows = shared.value, []
            ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for (row, doc_id), s in zip(ids, sets(batch.column(2), k)):
                prefix, l, typical = choose_prefix(s, weight, background, num, den) if len(s) else (s, 0, 0.0)
                rows.append((row, doc_id, len(s), *fingerprint(s), l, typical, prefix.view(np.int64)))
                if len(rows) == 1024:
                    yield _profile_batch(rows)
                    rows = []
            if rows:
                yield _profile_batch(rows)

    return ship(docs).select("row", "doc_id", "text").mapInArrow(batches, PROFILE)


def _profile_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.int32(), pa.float32()]
    columns = list(zip(*rows))
    prefixes = columns.pop()
    offsets = pa.array(np.append(0, np.cumsum([len(p) for p in prefixes])), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(prefixes)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)] + [lists],
                                      names=[f.split()[0] for f in PROFILE.split(", ")])


def bitmap(numbers: DataFrame, each: int = NUMBER_BITS) -> np.ndarray:
    """Bits set at the hashes of a one-column table, ``each`` bits or more for a number, built by the tasks and joined by chunk.

    There are 2**BITMAP_BITS bits at most.
    """
    n = numbers.count()
    bits = min(BITMAP_BITS, max(16, int(each * n).bit_length()))
    chunk_bits = 15

    def mark(it):
        own: dict[int, np.ndarray] = {}
        for batch in it:
            place = _bit_of(batch.column(0).to_numpy(zero_copy_only=False), bits)
            for c in np.unique(place >> chunk_bits).tolist():
                flags = own.setdefault(c, np.zeros(1 << chunk_bits, dtype=bool))
                flags[place[place >> chunk_bits == c] & ((1 << chunk_bits) - 1)] = True
        for c, flags in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())],
                                             names=["chunk", "flags"])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        either = np.bitwise_or.reduce([np.frombuffer(x, dtype=np.uint8) for x in pdf["flags"]])
        return pd.DataFrame({"chunk": [key[0]], "flags": [either.tobytes()]})

    found = ship(numbers).mapInArrow(mark, "chunk int, flags binary").groupBy("chunk").applyInPandas(
        merge, "chunk int, flags binary")
    out = np.zeros((max(1, 1 << bits >> chunk_bits), 1 << chunk_bits >> 3), dtype=np.uint8)
    for r in found.collect():
        out[r["chunk"]] = np.frombuffer(r["flags"], dtype=np.uint8)
    return out.reshape(-1)


def _bit_of(numbers: np.ndarray, bits: int) -> np.ndarray:
    return (mix(numbers.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _maybe_in(numbers: np.ndarray, flags: np.ndarray) -> np.ndarray:
    place = _bit_of(numbers, int(len(flags) * 8 - 1).bit_length())
    return flags[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1 == 1


def postings_of(found: DataFrame, shared: DataFrame) -> DataFrame:
    """(row, token) of the prefix shingles that ``shared`` (token) holds.

    A bitmap of the shared ones drops nearly all others before anything is shuffled; the join makes it exact.
    """
    flags = found.sparkSession.sparkContext.broadcast(bitmap(shared.select("token")))

    def batches(it):
        for batch in it:
            prefix = batch.column(1)
            tokens = prefix.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(prefix.offsets.to_numpy()))
            keep = _maybe_in(tokens, flags.value) if len(tokens) else np.zeros(0, dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(row[keep]), pa.array(tokens[keep])], names=["row", "token"])

    return ship(found).select("row", "prefix").mapInArrow(batches, "row long, token long").join(shared, "token")


def sets_of(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) for the rows of `numbered` that ``nodes`` names, and some others.

    A bitmap of the wanted rows goes to the tasks, which read the texts again; no text is
    shuffled.  A row that is not wanted is taken for one by 1 in ``NODE_BITS`` at most, as there are many more of them and
    sets are wide.  When more rows are wanted than the bitmap can tell apart, more sets are made, none is lost.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select("node"), NODE_BITS))

    def batches(it):
        for batch in it:
            wanted = np.flatnonzero(_maybe_in(batch.column(0).to_numpy(zero_copy_only=False), shared.value))
            for i in range(0, len(wanted), 512):
                part = batch.take(pa.array(wanted[i:i + 512]))
                found = [s.view(np.int64) for s in sets(part.column(1), k)]
                offsets = pa.array(np.append(0, np.cumsum([len(s) for s in found])), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))],
                    names=["node", "shingles"])

    return ship(docs).select("row", "text").mapInArrow(batches, "node long, shingles array<long>")


def verify(pairs: DataFrame, shingles: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.  A set of another size than na, nb says ends the job."""
    left = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    right_sets = (F.coalesce(F.size("sa"), F.lit(-1)) == F.col("na")) & (F.coalesce(F.size("sb"), F.lit(-1)) == F.col("nb"))
    linked = F.when(~right_sets, F.raise_error(F.lit("rows were numbered differently when read again: pass a stable table"))
                    .cast("boolean")).otherwise(common * den >= (F.col("na") + F.col("nb") - common) * num)
    return pairs.join(left, "a", "left").join(right, "b", "left").filter(linked).select("a", "b")


def may_link(c, na, pa_, la, nb, pb, lb, num: int, den: int, least=F.least, greatest=F.greatest, ceil=F.ceil):
    """Whether a pair that shares ``c`` prefix shingles has to be compared (on columns, or on numpy arrays).

    Sizes must allow the threshold, and c must reach l.  Common shingles up to the earlier end of the two
    prefixes lie in both; the others lie in the rest of the document whose prefix ends there.  So the
    overlap is at most c and the longer rest.
    """
    overlap = ceil((na + nb) * num / (num + den) - 1e-6)
    return (least(na, nb) * den >= greatest(na, nb) * num) & (c >= least(la, lb)) & (c >= overlap - greatest(na - pa_, nb - pb))


def shared_counts(run: np.ndarray, node: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, count) of nodes (numbered below n) that share tokens within a run; a before b."""
    order = np.lexsort((node, token, run))
    run, node, token = run[order], node[order], token[order]
    starts = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (token[1:] != token[:-1])))
    left = np.diff(np.append(starts, len(run)))          # entries of each run's token, from its start
    places = np.arange(len(run)) - np.repeat(starts, left)
    room = np.repeat(left, left) - places - 1             # entries of the same token that follow
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, waiting, held = np.flatnonzero(room > 0), [], 0
    step = 1
    while len(at):
        waiting.append(node[at].astype(np.int64) * n + node[at + step])
        held += len(at)
        step += 1
        at = at[room[at] >= step]
        if held > 1 << 21 or not len(at):
            found, k = np.unique(np.concatenate([codes, *waiting]), return_inverse=True)
            counts = np.bincount(k, weights=np.concatenate([counts, np.ones(held)])).astype(np.int64)
            codes, waiting, held = found, [], 0
    return codes // n, codes % n, counts


def cross_pairs(hits: DataFrame, facts: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, na, nb): pairs of different components that share enough prefix shingles to be compared.

    The nodes of a hub's shingles meet in blocks of at most ``BLOCK_NODES``, each node with all its
    prefix shingles that others share.  A task counts what the pairs of a block share and hands on only those
    that may link, so no table holds all pairs of a group.
    """
    tokens = hits.groupBy("node").agg(F.collect_set("token").alias("tokens"), F.first("root").alias("root"))
    tokens = tokens.join(facts, "node")                    # bounded by a document's prefix
    meet = hits.select("hub", "node").distinct()
    parts = meet.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = meet.join(parts, "hub").select("hub", "node", own.alias("own"), other.alias("other"))
    met = met.select("hub", "node", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = met.join(tokens, "node").repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "node")
    columns = ["hub", "i", "j", "own", "node", "root", "n", "p", "l", "tokens"]

    def candidates(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held)
        c = {x: t.column(x).combine_chunks().to_numpy(zero_copy_only=False) for x in columns[:-1]}
        listed = t.column("tokens").combine_chunks()
        run = np.cumsum(np.append(0, (c["hub"][1:] != c["hub"][:-1]) | (c["i"][1:] != c["i"][:-1]) | (c["j"][1:] != c["j"][:-1])))
        row = np.repeat(np.arange(t.num_rows), np.diff(listed.offsets.to_numpy()))
        a, b, shared = shared_counts(run[row], row, listed.flatten().to_numpy(zero_copy_only=False), t.num_rows)
        keep = (c["root"][a] != c["root"][b]) & ((c["i"][a] == c["j"][a]) | (c["own"][a] != c["own"][b]))
        keep &= may_link(shared, c["n"][a], c["p"][a], c["l"][a], c["n"][b], c["p"][b], c["l"][b], num, den,
                         np.minimum, np.maximum, np.ceil)
        a, b = a[keep], b[keep]
        a, b = np.where(c["node"][a] < c["node"][b], (a, b), (b, a))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (c["node"][a], c["node"][b], c["n"][a], c["n"][b])],
                                          names=["a", "b", "na", "nb"])

    def blocks(it):
        held, size = [], 0
        for batch in it:
            key = [batch.column(x).to_numpy(zero_copy_only=False) for x in range(3)]
            ends = np.flatnonzero(np.append(False, np.logical_or.reduce([k[1:] != k[:-1] for k in key])))
            first = 0
            if held:        # does the batch go on with the run that is held?
                last = held[-1].slice(held[-1].num_rows - 1)
                if any(last.column(x)[0].as_py() != batch.column(x)[0].as_py() for x in range(3)):
                    ends = np.append(0, ends)
            for e in ends.tolist():
                if e > first:
                    held.append(batch.slice(first, e - first))
                    size += e - first
                    first = e
                if size >= BLOCK_NODES:
                    yield candidates(held)
                    held, size = [], 0
            if first < batch.num_rows:
                held.append(batch.slice(first))
                size += batch.num_rows - first
        if held:
            yield candidates(held)

    return ship(rows).select(*columns).mapInArrow(blocks, "a long, b long, na long, nb long").distinct()


def jaccard_components(docs: DataFrame, k: int, num: int, den: int, row: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, row, is_first) for each row of ``docs`` (doc_id, text); links at similarity >= num / den.

    ``row`` names a column that numbers the rows; without one they are numbered here.  One row of each component is
    its first: the one of the least doc_id.  ``docs`` is a stable table (files): it is read several times.
    """
    docs = docs.select("doc_id", "text") if row is None else docs.select("doc_id", "text", F.col(row).alias("row"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about one counter for every 64 bytes of text, within bounds
    bits = min(SKETCH_BITS[1], max(SKETCH_BITS[0], int(size // 64).bit_length()))
    sketch = frequency_sketch(docs, k, bits)
    background = float(np.exp2(np.median(sketch) / 8.0) - 1)
    if row is None:     # written once, so that the numbers stay whatever happens to executors
        docs = stash(numbered(docs), "numbered")
    found = stash(profiles(docs, sketch, background, k, num, den), "profiles")

    # equal sets are one node: the row that comes first
    key = ["n", "fp1", "fp2"]
    alike = stash(found.filter("n > 0").groupBy(*key).agg(F.min("row").alias("node"), F.count("*").alias("copies"))
                  .filter("copies > 1").drop("copies"), "copies")
    members = stash(found.select("row", "doc_id", *key).join(alike, key, "left").select(
        "row", "doc_id", "n", F.coalesce("node", "row").alias("node")), "members")

    facts = stash(found.select(F.col("row").alias("node"), "n", F.size("prefix").cast("long").alias("p"),
                               F.col("matches").cast("long").alias("l"), "typical"), "facts")

    # postings of prefix shingles that two nodes or more share; the most typical node is a shingle's first hub
    shared = stash(found.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
                   .filter("c > 1").select("token"), "shared-shingles")
    hits = postings_of(found, shared).join(members.select("row", "node"), "row").select("node", "token").distinct()
    hits = stash(hits.join(facts.select("node", "typical"), "node"), "postings")
    hubs = (hits.groupBy("token").agg(F.count("*").alias("c"), F.max(F.struct("typical", "node")).alias("m"))
            .filter("c > 1").select("token", F.col("m.node").alias("hub")))
    hits = stash(hits.join(hubs, "token"), "postings")
    facts = facts.drop("typical")

    links, tried, root = [], [], None
    for step in range(STAR_ROUNDS + 1):
        if step < STAR_ROUNDS:
            pairs = hits.filter("node <> hub").groupBy(
                F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).agg(F.count("*").alias("c"))
            for side in "ab":
                pairs = pairs.join(facts.select(*[F.col(x).alias(side if x == "node" else x + side) for x in facts.columns]), side)
            pairs = pairs.filter(may_link(*map(F.col, ("c", "na", "pa", "la", "nb", "pb", "lb")), num, den)).select("a", "b", "na", "nb")
        else:       # what is left: all pairs of different components
            pairs = cross_pairs(hits, facts, num, den)
        if tried:
            pairs = pairs.join(reduce(DataFrame.unionByName, tried).select("a", "b"), ["a", "b"], "left_anti")
        pairs = stash(pairs, "pairs")
        if not pairs.isEmpty():
            tried.append(pairs)
            wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
            links.append(stash(verify(pairs, stash(sets_of(docs, wanted, k), "sets"), num, den), "pair-links"))
        if links:
            root = stash(components(reduce(DataFrame.unionByName, links)), "roots")
        else:
            root = docs.sparkSession.createDataFrame([], "node long, root long")
        if step < STAR_ROUNDS:
            # postings that still hold several components, each with a new hub from outside the old hub's component
            labelled = _labelled(hits.drop("root", "hub_root"), root)
            outside = (labelled.filter("root <> hub_root").groupBy("token")
                       .agg(F.max(F.struct("typical", "node")).alias("m"))
                       .select("token", F.col("m.node").alias("_hub")))
            hits = stash(labelled.join(outside, "token").drop("hub", "hub_root").withColumnRenamed("_hub", "hub"), "postings")

    grouped = members.join(root, "node", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("root"))
    # the first row of a group is that of its least doc_id, null ids last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id"), F.col("row")))
    least = grouped.groupBy("root").agg(first.alias("first"), F.count("*").alias("c")).filter("c > 1") \
        .select("root", F.col("first.doc_id").alias("least"), F.col("first.row").alias("first_row"))
    return grouped.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "row",
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("is_first"))


def _labelled(hits: DataFrame, root: DataFrame) -> DataFrame:
    """Postings with the components of their node and their hub."""
    of_node = root.select("node", "root")
    of_hub = root.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    return (hits.join(of_node, "node", "left").withColumn("root", F.coalesce("root", "node"))
            .join(of_hub, "hub", "left").withColumn("hub_root", F.coalesce("hub_root", "hub")))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: components of all documents that share 85 % of their 4-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: one row of each group of near duplicates stays (five words, similarity 0.8), that of the least doc_id.

    Rows go by their number, so two rows with one doc_id, or none, are told apart.  Documents without words all stay.
    """
    docs = stash(docs.select(*DOCUMENT_COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")
    found = jaccard_components(docs, 5, 80, 100, row="_row").filter("NOT is_first").select(F.col("row").alias("_row"))
    return docs.join(found, "_row", "left_anti").select(*DOCUMENT_COLUMNS)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]))
    END AS sh FROM d
), n AS (
  SELECT rid, doc_id, len(sh)::BIGINT AS n_shingles FROM s
), u AS (
  SELECT rid, unnest(sh) AS sh FROM s
), i AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM u a JOIN u b ON a.sh = b.sh AND a.rid < b.rid GROUP BY 1, 2
), l AS (
  SELECT a, b FROM i JOIN n x ON x.rid = a JOIN n y ON y.rid = b
  WHERE 100 * c >= 85 * (x.n_shingles + y.n_shingles - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(a, b) AS (
  SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, min(m.doc_id)) AS component_id
FROM n LEFT JOIN r ON r.a = n.rid LEFT JOIN n m ON m.rid = r.b GROUP BY n.rid, n.doc_id, n.n_shingles
"""
