"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens.  Full pieces are sequences of their
own.  The others are dealt at random into blocks of about ``block_items`` pieces, and each
block is packed by islands: a population per island evolves by crossover that injects whole
well-filled bins of one parent into the other, removes the bins that hold duplicates, exchanges
displaced pieces for smaller ones where that fills a bin better and best-fits the rest; after
each epoch the elite of an island migrates to the next one.  An island is one group of one Spark task, an epoch one pass; blocks are bounded, so
memory is too, and the packing lost at block borders is below one bin in a block.

Cases: null and empty texts are one piece with the end token alone.  Repeated rows are packed
as often as they come (nothing is keyed by doc_id).  An empty table gives no rows.  Ties
between bins go to the lower bin.  A text of any length is encoded whole.
"""

from __future__ import annotations

import random
import zlib
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import free_name, ship, stash, table
from tally.llm.tokens import default_path, encode_column
from tally.session import shuffle_partitions

CAPACITY = 1024
END_ID = 2
BLOCK_ITEMS = 16_384
ISLANDS = 2
POPULATION = 3
EPOCHS = 2
CROSSOVERS = 12     # for each island and epoch, unless the lower bound is reached
INJECTED = 4        # bins that a crossover injects on average: few, so that what they displace finds a better place
DISSOLVED = 3       # emptiest bins of the host that it drops, at most
ISLANDS_IN_TASK = 64    # where there are more islands than shuffle partitions

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all full but the first, which may be shorter."""
    first = n_tokens % capacity or min(capacity, n_tokens)
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document (columns of ``PIECES``); ``docs`` has doc_id and text."""

    def batches(it):
        for batch in it:
            out = [[], [], [], [], []]
            for doc_id, ids in zip(batch.column(0), encode_column(batch.column(1), path)):
                ids.append(END_ID)
                raw = np.array(ids, dtype="<u4")
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    for column, v in zip(out, (doc_id.as_py(), k, start, length,
                                               zlib.crc32(raw[start:start + length].tobytes()))):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, PIECES)


class OpenBins:
    """Bins by free space, with a bit mask of the spaces that occur: best fit in a few steps."""

    def __init__(self, capacity: int):
        self.capacity, self.by_space, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, bin_id: int, space: int) -> None:
        if space:
            self.by_space[space].append(bin_id)
            self.mask |= 1 << space

    def best(self, size: int) -> tuple[int, int] | None:
        """Take out the fullest bin that has room for ``size``: (bin, its space)."""
        fits = self.mask >> size
        if not fits:
            return None
        space = size + (fits & -fits).bit_length() - 1
        found = self.by_space[space]
        bin_id = found.pop()
        if not found:
            self.mask ^= 1 << space
        return bin_id, space


def best_fit(sizes: list[int], order, bins: np.ndarray, spaces: dict[int, int], next_bin: int, capacity: int) -> int:
    """Place the items of ``order`` (in this order) into ``bins``; returns the next free bin number."""
    free = OpenBins(capacity)
    for b in sorted(spaces, reverse=True):
        free.add(b, spaces[b])
    for i in order:
        size = sizes[i]
        found = free.best(size)
        if found is None:
            found, next_bin = (next_bin, capacity), next_bin + 1
        bins[i] = found[0]
        free.add(found[0], found[1] - size)
    return next_bin


def renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewest bins first, then the mean squared fill (well-filled bins beside emptier ones)."""
    fill = np.bincount(bins, weights=sizes) / capacity
    return len(fill), -float((fill ** 2).mean())


class Pool:
    """Displaced items by size; bit masks tell which sizes, and which sums of two, are there."""

    def __init__(self, sizes: list[int], items):
        self.by_size: dict[int, list[int]] = {}
        for i in items:
            self.by_size.setdefault(sizes[i], []).append(i)
        self.singles, self._pairs = sum(1 << s for s in self.by_size), None

    def pairs(self) -> int:
        if self._pairs is None:
            self._pairs = 0
            for s, items in self.by_size.items():
                others = self.singles if len(items) > 1 else self.singles ^ (1 << s)
                self._pairs |= others << s
        return self._pairs

    def most(self, least: int, most: int) -> int:
        """The greatest sum of one or two items above ``least`` and up to ``most``; 0 if there is none."""
        window = (1 << (most + 1)) - 1
        one = (self.singles & window).bit_length() - 1
        if one < most:
            one = max(one, (self.pairs() & window).bit_length() - 1)
        return one if one > least else 0

    def add(self, size: int, item: int) -> None:
        self.by_size.setdefault(size, []).append(item)
        self.singles, self._pairs = self.singles | 1 << size, None

    def pop(self, size: int) -> int:
        items = self.by_size[size]
        item = items.pop()
        if not items:
            del self.by_size[size]
            self.singles ^= 1 << size
        self._pairs = None
        return item

    def take(self, total: int) -> list[int]:
        """One item of this size, or two that add up to it."""
        if self.singles >> total & 1:
            return [self.pop(total)]
        for s, items in self.by_size.items():
            rest = total - s
            if 0 <= rest <= s and rest in self.by_size and (rest != s or len(items) > 1):
                return [self.pop(s), self.pop(rest)]
        raise KeyError(total)

    def items(self) -> list[int]:
        return [i for items in self.by_size.values() for i in items]


def exchange(sizes: list[int], members: dict[int, list[int]], spaces: dict[int, int], pool: Pool, bins: np.ndarray,
             order: list[int]) -> None:
    """Fill bins from the pool: up to two items of a bin go for one or two that fill it better.

    Each exchange makes its bin fuller, so the pool shrinks and is left with smaller items.
    """
    for b in order:
        while spaces[b]:
            space, held = spaces[b], members[b]
            gain, out, total = 0, (), 0
            for gone in chain(combinations(held, 1), combinations(held, 2), [()]):
                t = sum(sizes[i] for i in gone)
                found = pool.most(t, t + space)
                if found - t > gain:
                    gain, out, total = found - t, gone, found
                    if gain == space:
                        break
            if not gain:
                break
            taken = pool.take(total)
            for i in out:
                held.remove(i)
                pool.add(sizes[i], i)
            held += taken
            bins[taken] = b
            spaces[b] = space - gain


def crossover(sizes: np.ndarray, host: np.ndarray, donor: np.ndarray, rng: random.Random, capacity: int) -> np.ndarray:
    """Inject well-filled bins of the donor into the host and repair it.

    Donor bins that would break up a full bin of the host stay out; of the others a random part goes
    in.  The host's bins with duplicates are dropped, its emptiest ones too.  What is displaced is
    exchanged for smaller items of the bins that have room, and then best-fitted by falling size.
    """
    fill, host_fill = np.bincount(donor, weights=sizes), np.bincount(host, weights=sizes)
    breaks = np.zeros(len(fill), dtype=bool)
    breaks[donor[host_fill[host] >= capacity]] = True
    ranked = np.argsort(-fill, kind="stable")
    well_filled = [b for b in ranked[: max(1, int((fill >= fill.mean()).sum()))].tolist() if not breaks[b]]
    share = min(0.5, INJECTED / max(1, len(well_filled)))
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[[b for b in well_filled if rng.random() < share] or well_filled[:1]] = True
    injected = chosen[donor]
    hit = np.zeros(len(host_fill), dtype=bool)
    hit[host[injected]] = True                       # host bins that hold an injected item go
    hit[np.argsort(host_fill, kind="stable")[:rng.randint(1, DISSOLVED)]] = True
    displaced = np.flatnonzero(hit[host] & ~injected)
    child = host.astype(np.int64)
    child[injected] = donor[injected] + len(hit)     # the donor's bins under new numbers
    stays = np.flatnonzero(~hit[host] | injected)
    used = np.bincount(child[stays], weights=sizes[stays]).astype(np.int64)
    spaces = {int(b): capacity - int(used[b]) for b in np.flatnonzero(used) if used[b] < capacity}
    members: dict[int, list[int]] = {b: [] for b in spaces}
    for i, b in zip(stays.tolist(), child[stays].tolist()):
        if b in members:
            members[b].append(i)
    plain, pool = sizes.tolist(), Pool(sizes.tolist(), displaced.tolist())
    order = list(spaces)
    rng.shuffle(order)
    exchange(plain, members, spaces, pool, child, order)
    rest = sorted(pool.items(), key=lambda i: (-plain[i], i))
    best_fit(plain, rest, child, {b: s for b, s in spaces.items() if s}, len(hit) + len(fill), capacity)
    return renumber(child)


def first_packing(sizes: np.ndarray, rng: random.Random, capacity: int, noise: float) -> np.ndarray:
    """Best fit by falling size, the sizes blurred by ``noise`` so that individuals differ."""
    keys = sizes * np.array([1 + noise * (rng.random() - 0.5) for _ in range(len(sizes))]) if noise else sizes
    bins = np.zeros(len(sizes), dtype=np.int64)
    best_fit(sizes.tolist(), np.argsort(-keys, kind="stable").tolist(), bins, {}, 0, capacity)
    return renumber(bins)


def exact_filling(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin by bin: the largest item left, then the one or two items that fill the rest best, until nothing fits."""
    bins, pool, b = np.zeros(len(sizes), dtype=np.int64), Pool(sizes.tolist(), range(len(sizes))), 0
    while pool.by_size:
        size = pool.singles.bit_length() - 1
        held, space = [pool.pop(size)], capacity - size
        while found := pool.most(0, space):
            held += pool.take(found)
            space -= found
        bins[held] = b
        b += 1
    return renumber(bins)


def evolve(sizes: np.ndarray, population: list[np.ndarray], rng: random.Random, capacity: int, size: int,
           rounds: int) -> list[np.ndarray]:
    """``rounds`` crossovers; the child takes the place of the worst.  Ends early at the lower bound.

    A new population begins with best fit by size and exact filling, the others are blurred best fits.
    """
    bound = -(-int(sizes.sum()) // capacity)
    while len(population) < size:
        population.append(exact_filling(sizes, capacity) if len(population) == 1
                          else first_packing(sizes, rng, capacity, 0.25 * len(population)))
        if int(population[-1].max()) + 1 <= bound:
            return [population[-1]]
    population.sort(key=lambda b: fitness(sizes, b, capacity))
    del population[size:]
    for _ in range(rounds):
        if int(population[0].max()) + 1 <= bound:
            break
        donor, host = rng.sample(range(len(population)), 2) if len(population) > 1 else (0, 0)
        child = crossover(sizes, population[host], population[donor], rng, capacity)
        if fitness(sizes, child, capacity) < fitness(sizes, population[-1], capacity):
            population[-1] = child
            population.sort(key=lambda b: fitness(sizes, b, capacity))
    return population


def epoch(islands: DataFrame, number: int, capacity: int, size: int, rounds: int, seed: int, tasks: int) -> DataFrame:
    """One pass over (block, island, rank, sizes, bins): each island evolves; rank 0 is its elite."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        rng = random.Random(f"{seed}-{number}-{block}-{island}")
        sizes = np.asarray(pdf["sizes"].iloc[0], dtype=np.int64)
        pdf = pdf.sort_values("rank", kind="stable")
        known = {np.asarray(b).tobytes(): np.asarray(b, dtype=np.int32) for b in pdf["bins"] if b is not None and len(b)}
        found = evolve(sizes, list(known.values()), rng, capacity, size, rounds)
        return pd.DataFrame({"block": block, "island": island, "rank": np.arange(len(found), dtype=np.int32),
                             "sizes": [sizes.tolist()] * len(found), "bins": [b.tolist() for b in found]})

    # tasks by number: islands are few bytes but much work, and AQE would merge them by bytes
    return ship(islands).repartition(tasks, "block", "island").groupBy("block", "island").applyInPandas(
        run, "block int, island int, rank int, sizes array<int>, bins array<int>")


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, islands: int = ISLANDS,
         size: int = POPULATION, epochs: int = EPOCHS, rounds: int = CROSSOVERS, seed: int = 1) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (a stable table with ``length`` <= capacity)."""
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*columns)
    full = (pieces.filter(F.col("length") >= capacity)
            .withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}))
    rest = pieces.filter(F.col("length") < capacity)
    n_blocks = max(1, -(-rest.count() // block_items))
    # dealt by row number, not by content: repeated rows spread over all blocks
    block = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int")
    blocks = stash(
        rest.select(block.alias("block"), F.struct((-F.col("length")).alias(free_name(columns, "_by")), *columns).alias("item"))
        .groupBy("block").agg(F.sort_array(F.collect_list("item")).alias("items"))
        .repartition(n_blocks, "block"), "blocks")
    sizes = F.transform("items", lambda x: x["length"].cast("int"))
    state = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          F.lit(0).alias("rank"), sizes.alias("sizes"),
                          F.lit(None).cast("array<int>").alias("bins"))
    tasks = min(n_blocks * islands, max(shuffle_partitions(pieces.sparkSession), n_blocks * islands // ISLANDS_IN_TASK))
    for k in range(epochs):
        state = stash(epoch(state, k, capacity, size, rounds, seed, tasks), "islands")
        if k < epochs - 1:      # the elite of each island joins the next island
            elite = state.filter("rank = 0").withColumn("island", (F.col("island") + 1) % islands)
            state = state.unionByName(elite.withColumn("rank", F.lit(size)))
    fill = F.struct(F.array_max("bins").alias("bins"), F.col("island").alias("island"))
    best = state.filter("rank = 0").groupBy("block").agg(F.min_by("bins", fill).alias("bins"))
    # a place in its sequence: the lengths before it in the same bin, by a running total in each block
    items = (blocks.join(best, "block")
             .select(F.col("block").alias("_block"), F.posexplode(F.arrays_zip("items", "bins")).alias("_place", "_x"))
             .select("_block", "_place", F.col("_x.bins").alias("_bin"), F.col("_x.items").alias("_item")))
    same_bin = Window.partitionBy("_block", "_bin").orderBy("_place")
    upto = same_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = (F.sum("_item.length").over(upto) - F.col("_item.length")).cast("long")
    packed = items.select(
        *[F.col("_item").getField(c).alias(c) for c in columns],
        (F.shiftleft(F.col("_block").cast("long"), 32) + F.col("_bin")).alias("sequence_id"), before.alias("offset"))
    return packed.select(*columns, "sequence_id", "offset").unionByName(full.select(*columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Tokenize (doc_id, text) and pack; one row for each piece."""
    pieces = stash(tokenize(docs, path or default_path(), options.get("capacity", CAPACITY)), "pieces")
    return pack(pieces, **options)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document, in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline, last stage: where each piece of each document lies."""
    return pack_documents(docs.select("doc_id", "text"))
