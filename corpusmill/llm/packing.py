"""Best-fit packing of documents into training sequences.

Method: a grouping genetic algorithm (Falkenauer, 1996). A solution is a list of bins; crossover injects whole well-filled
bins of one parent into the other, takes out the bins that then hold a document twice, and best-fits what these lose, after exchanging
displaced documents for shorter ones of bins that they fill better (Falkenauer's replacement step).
The pieces are dealt by hash into cells of some thousands; on each cell several islands evolve from seeds of
their own, pass their elite to the next island, evolve on, and the best solution of the cell is kept. Only lengths and
places of pieces move between tasks; a cell is a bounded row, so neither a hot source, a long document nor an id that very many rows share gathers in a task.
"""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import materialize

#: Pieces of a cell, about, and rows of one document and piece from which they are dealt by place.
CELL_PIECES, SAME = 6_000, 64
ISLANDS, EPOCHS, POPULATION = 3, 2, 4
#: An island's epoch ends at the lower bound of bins, or after so many generations of which the last STALL brought no fewer bins.
GENERATIONS, STALL = 40, 8
END_ID = 2


def token_pieces(docs: DataFrame, capacity: int = 1024, end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of (doc_id, text).

    A document's ids are those of the tokenizer, then end_id (null text: end_id alone). Longer ones than capacity are cut so that
    the first piece may be shorter and all others are full. Repeated rows are pieces of their own.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokens.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows: list[tuple] = []
                parts = []
                texts = [t or "" for t in batch.column(1)[at : at + 1000].to_pylist()]
                for doc, ids in zip(batch.column(0)[at : at + 1000].to_pylist(), bpe.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    first = len(ids) % capacity or min(capacity, len(ids))
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                        if with_ids:
                            parts.append(ids[a:b].astype(np.int32))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class BestFit:
    """Open bins by their free room; the fullest bin with room enough is found by the lowest set bit."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free, self.by_room, self.mask = capacity, [], [], [[] for _ in range(capacity + 1)], 0

    def open(self, items: list[int], used: int) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - used)
        self._file(len(self.bins) - 1)

    def _file(self, b: int) -> None:
        room = self.free[b]
        if room:
            self.by_room[room].append(b)
            self.mask |= 1 << room

    def put(self, item: int, length: int) -> None:
        wide = self.mask >> length
        if not wide:
            self.open([item], length)
            return
        room = length + (wide & -wide).bit_length() - 1
        shelf = self.by_room[room]
        b = shelf.pop()
        if not shelf:
            self.mask &= ~(1 << room)
        self.bins[b].append(item)
        self.free[b] -= length
        self._file(b)


def best_fit(lengths: list[int], order: list[int], capacity: int) -> list[list[int]]:
    fit = BestFit(capacity)
    for i in order:
        fit.put(i, lengths[i])
    return fit.bins


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (smaller is better)."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(first: list[list[int]], second: list[list[int]], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Well-filled bins of `first` whole, then the bins of `second` that share nothing with them, the rest best-fitted by falling length."""
    fills = [sum(lengths[i] for i in b) for b in first]
    bar = capacity * (1 - rng.choice((0.0, 0.002, 0.01, 0.03)))
    chosen = [k for k, f in enumerate(fills) if f >= bar and rng.random() < 0.7]
    taken = {i for k in chosen for i in first[k]}
    fit = BestFit(capacity)
    for k in chosen:
        fit.open(list(first[k]), fills[k])
    loose = min(rng.choice((1, 3, 10)), max(0, len(second) - len(chosen)))  # the emptiest bins that are left go too
    whole, displaced = [], []
    for b in second:
        left = [i for i in b if i not in taken]
        if len(left) == len(b) and left:
            whole.append((sum(lengths[i] for i in b), b))
        else:
            displaced += left
    whole.sort(key=lambda x: x[0])
    displaced += [i for _, b in whole[:loose] for i in b]
    bins, room = [list(b) for _, b in whole[loose:]], [capacity - used for used, _ in whole[loose:]]
    replace(bins, room, displaced, lengths)
    for b, r in zip(bins, room):
        fit.open(b, capacity - r)
    displaced.sort(key=lambda i: (-lengths[i], i))
    for i in displaced:
        fit.put(i, lengths[i])
    return fit.bins


def replace(bins: list[list[int]], room: list[int], displaced: list[int], lengths: list[int]) -> None:
    """Fill bins better, in place: a document, or two, goes out for a displaced one that takes more of the room, so what is displaced gets shorter."""
    out = sorted((lengths[i], i) for i in displaced)
    for k in sorted(range(len(bins)), key=lambda k: -room[k]):
        tries = 0
        while room[k] and out and tries < 4:
            tries += 1
            items = bins[k]
            groups = [(lengths[i], (i,)) for i in items] + [(lengths[a] + lengths[b], (a, b)) for x, a in enumerate(items) for b in items[x + 1 :] if len(items) <= 12]
            best = (0, 0, ())
            for size, group in groups:
                at = bisect.bisect_right(out, (size + room[k], 1 << 60)) - 1
                if at >= 0 and out[at][0] - size > best[0]:
                    best = (out[at][0] - size, at, group)
            gain, at, group = best
            if not gain:
                break
            new = out.pop(at)[1]
            for i in group:
                bisect.insort(out, (lengths[i], i))
            bins[k] = [i for i in items if i not in group] + [new]
            room[k] -= gain
    displaced[:] = [i for _, i in out]


def evolve(lengths: list[int], capacity: int, seed: int, elites: list[list[list[int]]]) -> list[list[int]]:
    """One island's epoch: from best-fit seeds and the elites that came in, to its best solution."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    falling = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    people = list(elites)
    for p in people:
        if len(p) == least:
            return p
    while len(people) < POPULATION:
        jitter = 0.0 if not people else rng.choice((0.01, 0.05, 0.2))
        order = falling if not jitter else sorted(falling, key=lambda i: -lengths[i] * (1 + jitter * rng.random()))
        people.append(best_fit(lengths, order, capacity))
        if len(people[-1]) == least:
            return people[-1]
    scored = sorted(((fitness(p, lengths, capacity), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
    stale = 0
    for _ in range(GENERATIONS):
        fewest = scored[0][0][0]
        if fewest == least or stale == STALL:
            break
        a, b = rng.sample(range(min(len(scored), POPULATION)), 2)
        child = crossover(scored[min(a, b)][2], scored[max(a, b)][2], lengths, capacity, rng)
        scored.append((fitness(child, lengths, capacity), len(scored), child))
        scored = sorted(scored, key=lambda x: x[:2])[:POPULATION]
        stale = 0 if scored[0][0][0] < fewest else stale + 1
    return scored[0][2]


def pack(pieces: DataFrame, capacity: int = 1024, cell_pieces: int = CELL_PIECES, seed: int = 11) -> DataFrame:
    """pieces (doc_id, piece, length, more columns) with sequence_id and offset added: as few sequences as found, gapless from 0.

    Every piece, full ones too, is an item; lengths must lie in 1..capacity. Only (place in the written table, length) goes into cells, whatever else a piece
    carries. Reruns agree: cells, islands and orders come from hashes and sorted rows; only pieces that more than SAME rows share (as without an id)
    are dealt by their place in the table, so that no cell grows with them. An empty input gives no rows.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    inner = [f"_{k}" for k in range(len(names))]
    items = materialize(pieces.select(*[F.col(f"`{n}`").alias(i) for n, i in zip(names, inner)], F.monotonically_increasing_id().alias("_place")))
    doc, piece, length = (inner[names.index(n)] for n in ("doc_id", "piece", "length"))
    n_cells = max(1, -(-items.count() // cell_pieces))
    short = items.select("_place", F.col(doc).alias("doc"), F.col(piece).alias("piece"), F.col(length).alias("length"))
    shared = materialize(short.groupBy(F.col("doc").alias("d"), F.col("piece").alias("p")).agg(F.count("*").alias("n")).where(F.col("n") > SAME).select("d", "p"))
    if shared.limit(1).count():
        hit = short.join(shared, F.col("doc").eqNullSafe(F.col("d")) & F.col("piece").eqNullSafe(F.col("p")), "left")
        short = hit.select("_place", "doc", "piece", "length", F.when(F.col("p").isNotNull(), F.col("_place")).otherwise(F.lit(0)).alias("salt"))
    else:
        short = short.withColumn("salt", F.lit(0).cast("long"))
    cell = F.pmod(F.xxhash64("doc", "piece", F.lit(seed), "salt"), F.lit(n_cells)).alias("cell")
    item = F.struct((-F.col("length")).alias("order"), "doc", "piece", F.col("_place").alias("place")).alias("item")
    cells = short.select(cell, item).groupBy("cell").agg(F.array_sort(F.collect_list("item")).alias("items"))
    cells = materialize(cells.select("cell", F.transform("items", lambda x: (-x["order"]).cast("int")).alias("lengths"), F.transform("items", lambda x: x["place"]).alias("places")))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    # a fixed number of tasks: these rows are small but take long, so they mustn't be gathered by size
    tasks = min(n_cells * ISLANDS, max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_cells // 4))
    elite = None
    for epoch in range(EPOCHS):
        work = cells.select("cell", "lengths", islands)
        if elite is None:
            work = work.withColumn("elites", F.array().cast("array<array<int>>"))
        else:
            moved = elite.select("cell", F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))).alias("island"), "bins").groupBy("cell", "island").agg(F.array_sort(F.collect_list("bins")).alias("elites"))
            work = work.join(moved, ["cell", "island"])
        elite = materialize(work.repartition(tasks, "cell", "island").mapInArrow(_epoch(capacity, seed * 1000 + epoch), "cell long, island int, n_bins int, bins array<int>"))
    best = elite.groupBy("cell").agg(F.min_by("bins", F.struct("n_bins", "island")).alias("bins"))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                bins, length, place = (row.column(k).flatten().to_numpy() for k in (1, 2, 3))
                order = np.argsort(bins, kind="stable")
                bins, length = bins[order], length[order].astype(np.int64)
                before = np.cumsum(length) - length
                new = np.concatenate([[True], bins[1:] != bins[:-1]])
                offset = before - np.repeat(before[new], np.diff(np.append(np.flatnonzero(new), len(bins))))
                yield pa.RecordBatch.from_arrays([pa.array(place[order]), pa.array((row.column(0)[0].as_py() << 24) + bins.astype(np.int64)), pa.array(offset)], ["_place", "sequence_id", "offset"])

    laid = cells.join(best, "cell").select("cell", "bins", "lengths", "places").mapInArrow(lay, "_place long, sequence_id long, offset long")
    return items.join(laid, "_place").select(*[F.col(i).alias(n) for n, i in zip(names, inner)], "sequence_id", "offset")


def _epoch(capacity: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                elites = []
                for e in row["elites"]:
                    bins: list[list[int]] = [[] for _ in range(max(e) + 1)]
                    for i, b in enumerate(e):
                        bins[b].append(i)
                    elites.append(bins)
                best = evolve(row["lengths"], capacity, seed + 7919 * row["cell"] + row["island"], elites)
                where = [0] * len(row["lengths"])
                for b, content in enumerate(best):
                    for i in content:
                        where[i] = b
                yield pa.RecordBatch.from_arrays([pa.array([row["cell"]], pa.int64()), pa.array([row["island"]], pa.int32()), pa.array([len(best)], pa.int32()), pa.array([where], pa.list_(pa.int32()))], ["cell", "island", "n_bins", "bins"])

    return run


def packed_sequences(docs: DataFrame, capacity: int = 1024, path: str | None = None) -> DataFrame:
    """The training sequences themselves: (sequence_id, ids array<int>), pieces in order of their offsets."""
    out = pack(token_pieces(docs, capacity, path=path, with_ids=True), capacity)
    return out.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(token_pieces(docs, 1024), 1024).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
