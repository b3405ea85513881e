"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a balanced k-means on a bounded sample and are linked to a neighbour graph;
every vector is indexed in the list of its nearest centroid and, near a boundary, in further
lists as well.  A query searches the graph for its nearest centroids, keeps those whose
distance is within a ratio of the best one's, and is compared exactly with the vectors of
these lists.  How many lists that may be, and the ratio, is settled for each table: some of its
queries are answered by brute force, and both grow until enough of these answers lie in the lists.

Sizes: the centroids (at most ``MAX_CENTROIDS``) are broadcast, some MB.  A list may grow with the
data; lists and their queries are cut into parts of bounded size, each part a group of its own.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do those of another length than the most frequent one, nor rows with a null id.  Rows that
repeat a vec_id count once (a vec_id is the row's name).  Equal distances rank by vec_id.  An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import ship, stash, table

SAMPLE_BYTES = 16 << 20         # bound of the sample (as float32) that centroids are fitted on
LIST_VECTORS = 128              # vectors wanted in a list, as long as centroids are not at their most
MAX_CENTROIDS = 4096
ROUNDS = 8
GRAPH_DEGREE = 16
MAX_REPLICAS = 4
REPLICA_RATIO = 1.15            # a vector joins lists whose centroid is at most so much further than its nearest
PROBES = 64                     # most lists that a query searches, and their ratio, unless calibration asks for more
PROBE_RATIO = 1.35
CALIBRATION_QUERIES = 100       # answered by brute force
CALIBRATION_RECALL = 0.95       # of these answers lie in the lists searched
PART_VECTORS, PART_QUERIES = 4096, 1024
ENOUGH = 4                      # a query's lists hold at least so many times k entries a replica


# -- centroids -------------------------------------------------------------

def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x from rows of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def balanced_kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds in which a list pays for its size, so that none attracts far more than the others."""
    c = x[rng.choice(len(x), k, replace=False)].astype(np.float32)
    penalty, even = np.zeros(k, dtype=np.float32), len(x) / k
    for _ in range(ROUNDS):
        label, cost = np.empty(len(x), dtype=np.int64), 0.0
        for i in range(0, len(x), 4096):
            d = distances(x[i:i + 4096], c)
            label[i:i + 4096] = (d + penalty).argmin(1)
            cost += float(d.min(1).sum())
        size = np.bincount(label, minlength=k)
        penalty += (0.3 * cost / len(x) * (np.minimum(size / even, 4) - 1)).astype(np.float32)
        order = np.argsort(label, kind="stable")
        filled = np.flatnonzero(size)
        sums = np.add.reduceat(x[order].astype(np.float64), np.append(0, np.cumsum(size[filled])[:-1]), axis=0)
        c[filled] = (sums / size[filled, None]).astype(np.float32)
        empty = np.flatnonzero(size == 0)
        c[empty] = x[rng.choice(len(x), len(empty))]
    return c


class Centroids:
    """Centroids with a graph of near neighbours; searched best-first, many queries in step."""

    def __init__(self, points: np.ndarray, rng: np.random.Generator):
        self.points = points
        k = len(points)
        degree = min(GRAPH_DEGREE, max(0, k - 1))
        near = np.empty((k, degree), dtype=np.int32)
        for i in range(0, k, 1024):
            d = distances(points[i:i + 1024], points)
            d[np.arange(len(d)), i + np.arange(len(d))] = np.inf
            near[i:i + 1024] = np.argsort(d, axis=1, kind="stable")[:, :degree]
        # beside the neighbours a few random links, so that every part of the graph can be reached
        self.links = np.concatenate([near, rng.integers(0, k, (k, 4), dtype=np.int32)], axis=1)
        self.entries = np.sort(rng.choice(k, min(k, max(4, int(k ** 0.5))), replace=False)).astype(np.int32)

    def search(self, x: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) of the ``top`` nearest found for each row, nearest first."""
        k, n = len(self.points), len(x)
        top = min(top, k)
        width = min(k, max(2 * top, 16))
        if 8 * width >= k:      # a beam over much of the graph costs more than all distances
            d = distances(x, self.points).astype(np.float32)
            best = np.argsort(d, axis=1, kind="stable")[:, :top]
            return best.astype(np.int32), np.take_along_axis(d, best, axis=1)
        seen = np.zeros((n, k), dtype=bool)
        rows = np.arange(n)[:, None]
        # the beam begins with the entry points
        ids = np.full((n, width), -1, dtype=np.int32)
        d = np.full((n, width), np.inf, dtype=np.float32)
        start = distances(x, self.points[self.entries]).astype(np.float32)
        first = np.argsort(start, axis=1, kind="stable")[:, :width]
        ids[:, :first.shape[1]] = self.entries[first]
        d[:, :first.shape[1]] = np.take_along_axis(start, first, axis=1)
        seen[:, self.entries] = True
        done = np.zeros((n, width), dtype=bool)
        while True:
            open_d = np.where(done | ~np.isfinite(d), np.inf, d)
            j = open_d.argmin(1)
            live = np.flatnonzero(np.isfinite(open_d[np.arange(n), j]))
            if not len(live):
                break
            done[live, j[live]] = True
            links = self.links[ids[live, j[live]]]
            new = ~seen[live[:, None], links]
            seen[live[:, None], links] = True
            # a link that comes twice in one row would enter the beam twice
            order = np.argsort(links, axis=1, kind="stable")
            ordered = np.take_along_axis(links, order, axis=1)
            twice = np.zeros_like(new)
            np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
            new &= ~twice
            diff = self.points[links] - x[live][:, None, :]
            got = np.where(new, np.einsum("ijk,ijk->ij", diff, diff), np.inf).astype(np.float32)
            all_d = np.concatenate([d[live], got], axis=1)
            all_ids = np.concatenate([ids[live], links], axis=1)
            all_done = np.concatenate([done[live], np.zeros_like(new)], axis=1)
            keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            d[live], ids[live] = np.take_along_axis(all_d, keep, axis=1), np.take_along_axis(all_ids, keep, axis=1)
            done[live] = np.take_along_axis(all_done, keep, axis=1)
        best = np.argsort(d, axis=1, kind="stable")[:, :top]
        return ids[rows, best], d[rows, best]

    def replicas(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list, and others that are not much further, MAX_REPLICAS at most.

        Whether a chosen list lies between does not count: in many dimensions centroids, being
        means, lie nearer to each other than vectors lie to them.
        """
        ids, d = self.search(x, MAX_REPLICAS)
        chosen = (d <= REPLICA_RATIO ** 2 * d[:, :1]) & np.isfinite(d)
        chosen[:, 0] = True
        row, col = np.nonzero(chosen)
        return row, ids[row, col]


def matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


# -- index and search ------------------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, each vec_id once."""
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e).filter(
        F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & ~bad & F.exists(e, lambda v: v != 0))
    return ok.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def fit(vectors: DataFrame, n: int, dim: int, seed: int = 1) -> Centroids:
    """Centroids from a sample of at most SAMPLE_BYTES, chosen by a hash of vec_id."""
    most = max(1024, SAMPLE_BYTES // (4 * dim))
    share = min(1.0, most / n)
    chosen = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    rows = vectors.filter(chosen | F.lit(share == 1.0)).select("embedding").limit(most).toArrow()
    x = matrix(rows.column("embedding").combine_chunks()).astype(np.float32)
    rng = np.random.default_rng(seed)
    if not len(x):      # an unlucky draw from very few rows
        x = matrix(vectors.select("embedding").limit(1).toArrow().column("embedding").combine_chunks()).astype(np.float32)
    k = max(1, min(MAX_CENTROIDS, -(-n // LIST_VECTORS), -(-len(x) // 4)))
    return Centroids(balanced_kmeans(x, k, rng), rng)


def chosen_lists(ids: np.ndarray, d: np.ndarray, filled: np.ndarray, ratio: float, least: int) -> np.ndarray:
    """Which of the lists found are searched: those within the ratio, and more while those before them hold too little."""
    before = np.cumsum(filled[ids], axis=1) - filled[ids]
    within = np.isinf(ratio) | (d <= min(ratio, 1e9) ** 2 * d[:, :1])
    return np.isfinite(d) & (filled[ids] > 0) & (within | (before < least))


def exact_nearest(found: DataFrame, ids: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """(query, vec_id) of the k nearest of a few queries by comparing them with every vector; query is a place in ids."""
    shared = found.sparkSession.sparkContext.broadcast((ids, x.astype(np.float64)))

    def scan(it):
        own, q = shared.value
        best_d, best_v = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        for batch in it:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                v = part.column(0).to_numpy()
                d = distances(q, matrix(part.column(1)).astype(np.float64))
                d[own[:, None] == v[None, :]] = np.inf
                all_d = np.concatenate([best_d, d], axis=1)
                all_v = np.concatenate([best_v, np.broadcast_to(v, d.shape)], axis=1)
                order = np.lexsort((all_v, all_d), axis=1)[:, :k]
                best_d, best_v = np.take_along_axis(all_d, order, axis=1), np.take_along_axis(all_v, order, axis=1)
        query, col = np.nonzero(np.isfinite(best_d))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(best_v[query, col]), pa.array(best_d[query, col])],
            names=["query", "vec_id", "score"])

    near = ship(found.select("vec_id", "embedding")).mapInArrow(scan, "query int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "vec_id")


def calibrate(found: DataFrame, queries: DataFrame, lists: DataFrame, centroids: Centroids, filled: np.ndarray,
              k: int, least: int) -> tuple[int, float]:
    """(lists, ratio) to search by, such that CALIBRATION_RECALL of the exact answers of some queries lie in the lists.

    The queries are at most CALIBRATION_QUERIES, those with the smallest hashes; if there are no
    more lists or the ratio has no bound, all answers do.
    """
    some = queries.orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").limit(CALIBRATION_QUERIES).toArrow()
    probes, ratio, n_lists = min(PROBES, len(filled)), PROBE_RATIO, len(filled)
    if not some.num_rows:
        return probes, ratio
    x = matrix(some.column("embedding").combine_chunks()).astype(np.float32)
    answers = exact_nearest(found, some.column("vec_id").to_numpy(), x, k)
    # at most CALIBRATION_QUERIES * k answers, each in at most MAX_REPLICAS lists
    where = lists.select("list", "vec_id").join(F.broadcast(answers), "vec_id").select("query", "vec_id", "list").toArrow()
    if not where.num_rows:
        return probes, ratio
    query, answer, at = (where.column(c).to_numpy() for c in ("query", "vec_id", "list"))
    _, pair = np.unique(np.stack([query, answer], axis=1), axis=0, return_inverse=True)
    pair = pair.reshape(-1)

    def recall(bound: float) -> float:
        ids, d = centroids.search(x, probes)
        rows, cols = np.nonzero(chosen_lists(ids, d, filled, bound, least))
        searched = np.zeros((len(x), n_lists), dtype=bool)
        searched[rows, ids[rows, cols]] = True
        return float((np.bincount(pair, weights=searched[query, at]) > 0).mean())

    while recall(ratio) < CALIBRATION_RECALL:
        if probes < n_lists and recall(np.inf) < CALIBRATION_RECALL:
            probes = min(n_lists, probes + max(1, probes // 4))
        else:
            ratio = ratio * 1.1 if ratio < 10 else np.inf
            if np.isinf(ratio) and recall(ratio) < CALIBRATION_RECALL and probes >= n_lists:
                raise AssertionError("vectors are missing in the posting lists")
    return probes, ratio


def nearest(vectors: DataFrame, is_query, k: int = 10, seed: int = 1) -> DataFrame:
    """The k nearest found for each query row: query_id, rank, vec_id, score (Euclidean distance)."""
    found = stash(usable(vectors.select("vec_id", "embedding")), "vectors")
    sizes = found.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    shape = sizes.orderBy(F.desc("n"), "dim").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shape is None:
        return empty
    dim, n = shape["dim"], shape["n"]
    found = found.filter(F.size("embedding") == dim)
    shared = found.sparkSession.sparkContext.broadcast(fit(found, n, dim, seed))

    def index(it):
        for batch in it:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                rows, lists = shared.value.replicas(matrix(part.column(1)).astype(np.float32))
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), part.column(0).take(taken), part.column(1).take(taken)],
                    names=["list", "vec_id", "embedding"])

    kind = found.schema["embedding"].dataType.simpleString()
    lists = stash(ship(found).mapInArrow(index, f"list int, vec_id long, embedding {kind}"), "posting-lists")
    # entries of each list: at most MAX_CENTROIDS rows
    entries = {r["list"]: r["n"] for r in lists.groupBy("list").agg(F.count("*").alias("n")).collect()}
    filled = np.array([entries.get(c, 0) for c in range(len(shared.value.points))])
    least = ENOUGH * MAX_REPLICAS * (k + 1)
    queries = found.filter(is_query(F.col("vec_id")))
    probes_wanted, ratio = calibrate(found, queries, lists, shared.value, filled, k, least)

    def probe(it):
        for batch in it:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids, d = shared.value.search(matrix(part.column(1)).astype(np.float32), probes_wanted)
                rows, cols = np.nonzero(chosen_lists(ids, d, filled, ratio, least))
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows, cols].astype(np.int32)), part.column(0).take(taken), part.column(1).take(taken)],
                    names=["list", "query_id", "query"])

    probes = stash(ship(queries).mapInArrow(probe, f"list int, query_id long, query {kind}"), "probes")
    # parts of lists by vectors and by queries: a small table, one row for each list
    asked = probes.groupBy("list").agg(F.count("*").alias("n_queries"))
    parts = F.broadcast(lists.groupBy("list").agg(F.count("*").alias("n")).join(asked, "list").select(
        "list", F.ceil(F.col("n") / PART_VECTORS).cast("int").alias("vector_parts"),
        F.ceil(F.col("n_queries") / PART_QUERIES).cast("int").alias("query_parts")))

    def numbers(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (lists.join(parts, "list")
            .withColumn("vp", F.pmod(F.xxhash64("vec_id"), F.col("vector_parts")).cast("int"))
            .withColumn("qp", numbers("query_parts")).select("list", "vp", "qp", "vec_id", "embedding"))
    right = (probes.join(parts, "list")
             .withColumn("qp", F.pmod(F.xxhash64("query_id"), F.col("query_parts")).cast("int"))
             .withColumn("vp", numbers("vector_parts")).select("list", "vp", "qp", "query_id", "query"))

    def compare(vectors_here: pd.DataFrame, queries_here: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors_here) and len(queries_here):
            x = np.stack(vectors_here["embedding"].to_numpy()).astype(np.float64)
            ids = vectors_here["vec_id"].to_numpy()
            for query_id, q in zip(queries_here["query_id"], queries_here["query"]):
                diff = x - np.asarray(q, dtype=np.float64)
                score = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                score[ids == query_id] = np.inf
                if len(score) > 4 * k:      # all that are as near as the k-th
                    close = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
                else:
                    close = np.arange(len(score))
                close = close[np.lexsort((ids[close], score[close]))][:k]
                close = close[np.isfinite(score[close])]
                out["query_id"] += [query_id] * len(close)
                out["vec_id"] += ids[close].tolist()
                out["score"] += score[close].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    near = (ship(left).groupBy("list", "vp", "qp").cogroup(right.groupBy("list", "vp", "qp"))
            .applyInPandas(compare, "query_id long, vec_id long, score double"))
    # a candidate met in several lists has one distance
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (near.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the 10 nearest of every hundredth vector among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)
