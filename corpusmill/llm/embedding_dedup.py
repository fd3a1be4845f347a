"""Near duplicates among embeddings, exact.

Method: spherical k-means assigns every vector to a cell, at every size of the input: the number of cells follows the vectors of the
largest label, and centroids stand in two levels (a cell is a part of a part), fitted on a bounded sample by hash of the id. Cosine
products are compared in blocks within cells; one vector of each group is kept. So that no pair is lost at the border of two
cells, a vector also visits the cells that may hold a partner. With a the angle of the threshold, y visits the cell of c unless

* a plane shuts it off: x of that cell has <x, c> >= <x, c'> for every c' of its level, so a partner y within the angle a has
  <y, c' - c> <= sin(a) |c' - c|; this is tried with the centroids nearest to y;
* the cell's reach does: its members lie between two angles around c (taken from the assigned vectors), so y lies no more than a
  beyond them.

A vector counts its partners among the members and visitors of its own cell: each partner once. Equal vectors are compared
once and counted by their number, so a large group of copies costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_groups, materialize
from .graph import connected_components

#: Vectors that k-means is fitted on at least and at most, cells at most, vectors a cell (about) and a block.
SAMPLE, MAX_SAMPLE, MAX_CELLS, CELL_ROWS, BLOCK_ROWS = 8_192, 65_536, 4_096, 1_024, 1_024
#: Nearest centroids whose planes are tried.
PLANES = 8
ROUNDS, SEED = 8, 3


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Unit centroids of unit vectors, by Lloyd's rounds on cosines; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(n > 1e-12, total / np.maximum(n, 1e-12), c)
    return c


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision, of length one."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_dim(rows: pa.Array, dtype: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lists without nulls -> for each length that occurs: the length, the places of its rows, and these as a matrix."""
    flat, dims = rows.flatten().to_numpy().astype(dtype, copy=False), np.diff(rows.offsets.to_numpy())
    begin = np.cumsum(dims) - dims
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, flat[begin[at][:, None] + np.arange(d)]


class Cells:
    """Centroids of one length of vectors in two levels, and the angles between which each cell's members lie."""

    def __init__(self, sample: np.ndarray, cells: int):
        x = unit(sample)
        self.top = kmeans(x, int(np.ceil(np.sqrt(cells))))
        own = (x @ self.top.T).argmax(axis=1)
        self.wide = -(-cells // len(self.top))
        self.sub = [kmeans(x[own == i], self.wide, seed=SEED + 1 + i) if (own == i).any() else self.top[i : i + 1] for i in range(len(self.top))]
        self.low, self.high = np.zeros(len(self.top) * self.wide), np.full(len(self.top) * self.wide, np.pi)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, angle to its centroid) of unit vectors."""
        own = (x @ self.top.T).argmax(axis=1)
        cell, angle = np.zeros(len(x), np.int64), np.zeros(len(x))
        for i in np.unique(own):
            k = np.flatnonzero(own == i)
            dots = x[k] @ self.sub[i].T
            cell[k], angle[k] = i * self.wide + dots.argmax(axis=1), np.arccos(np.clip(dots.max(axis=1), -1, 1))
        return cell, angle

    def visits(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(place in x, cell): all cells that may hold a vector within the angle `reach`."""
        places, cells = [], []
        near = _open(x @ self.top.T, self.top, reach)
        for i in np.flatnonzero(near.any(axis=0)):
            k = np.flatnonzero(near[:, i])
            dots = x[k] @ self.sub[i].T
            angle = np.arccos(np.clip(dots, -1, 1))
            ring = slice(i * self.wide, i * self.wide + len(self.sub[i]))
            may = _open(dots, self.sub[i], reach) & (angle <= self.high[ring] + reach + 1e-6) & (angle >= self.low[ring] - reach - 1e-6)
            at, j = np.nonzero(may)
            places.append(k[at])
            cells.append(i * self.wide + j)
        return (np.concatenate(places), np.concatenate(cells)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _open(dots: np.ndarray, c: np.ndarray, reach: float) -> np.ndarray:
    """Which cells of one level no plane shuts off from which vectors."""
    apart = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2)
    apart[apart == 0] = np.inf
    beyond = np.zeros(dots.shape)
    for t in np.argsort(-dots, axis=1)[:, :PLANES].T:
        beyond = np.maximum(beyond, (dots[np.arange(len(dots)), t][:, None] - dots) / apart[t])
    return beyond <= np.sin(reach) + 1e-9


def _good(col: str = "embedding"):
    """Which vectors can link: decided by built-in functions, so that rows that can't never reach Python."""
    e = F.col(col)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)


def _join_block(table: pa.Table, threshold: float, dtype: str) -> pa.RecordBatch | None:
    """Links of one block of members (side 0) with one block of candidates (side 1): a row per member with links, and the edges of a forest."""
    side = table["side"].to_numpy()
    ids, n = table["vec_id"].to_numpy(), table["n"].to_numpy()
    x = unit(np.frombuffer(b"".join(table["raw"].to_pylist()), dtype).reshape(len(ids), -1))
    home, cand = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(home) or not len(cand):
        return None
    links, src, dst = np.zeros(len(home), np.int64), [], []
    label = ids[cand].copy()  # the smallest id known to reach a candidate in this block
    for a in range(0, len(home), 256):
        h = home[a : a + 256]
        near = x[h] @ x[cand].T >= threshold
        near &= ids[h][:, None] != ids[cand][None, :]
        links[a : a + 256] = near @ n[cand]
        # members that link hook their candidates together; an edge only where labels differ
        for k in np.flatnonzero(near.any(axis=1)):
            to = np.flatnonzero(near[k])
            known = label[to]
            low = min(int(known.min()), int(ids[h[k]]))
            first = np.unique(known)
            src += [int(ids[h[k]])] * len(first)
            dst += first.tolist()
            label[to] = low
            src.append(int(ids[h[k]]))
            dst.append(low)
    got = np.flatnonzero(links)
    if not len(got):
        return None
    pairs = np.unique(np.array([src, dst], np.int64), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    rows = len(got) + pairs.shape[1]
    v = np.concatenate([ids[home[got]], pairs[0]])
    other = pa.array(np.concatenate([np.zeros(len(got), np.int64), pairs[1]]), mask=np.arange(rows) < len(got))
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(np.concatenate([links[got], np.zeros(pairs.shape[1], np.int64)])), other], ["vec_id", "links", "dst"])


def link_embeddings(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", label_col: str | None = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Only vectors of equal labels that aren't null are compared (label_col None: all with all), and of these only such of one length; those
    that are null, empty, zero or hold null or non-finite values link with nothing, with 0 links and their own component. kept: the
    vector has the smallest id of its component. Rows that repeat an id are vectors of their own that share a component.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), "embedding", (F.col(label_col) if label_col else F.lit(0)).alias("label"))
    spark, dtype = vectors.sparkSession, "float32" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "float64"
    good = _good() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    code = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(SEED), "embedding").alias("h2")]  # stand for a vector in joins
    # equal vectors: one row with their number
    same = materialize(rows.where(good).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).select("label", "embedding", "rep", "n", *code))
    most = same.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    cells = int(min(MAX_CELLS, max(2, -(-most // CELL_ROWS))))
    sample = same.orderBy(F.xxhash64("rep", F.lit(SEED)), "rep").limit(min(MAX_SAMPLE, max(SAMPLE, 16 * cells))).select("embedding").toArrow()["embedding"].combine_chunks()
    known = {d: Cells(x, cells) for d, _, x in by_dim(sample, dtype)}  # MAX_CELLS centroids a length
    shared = spark.sparkContext.broadcast(known)
    reach = float(np.arccos(min(1.0, threshold)))
    kind = same.schema["label"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in by_dim(batch.column(3), dtype):
                cell, angle = shared.value[d].assign(unit(x)) if d in shared.value else (np.zeros(len(x), np.int64), np.zeros(len(x)))
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(3)), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(np.full(len(x), d, np.int32)), pa.array(cell, pa.int32()), pa.array(angle)], ["vec_id", "n", "label", "raw", "dim", "cell", "angle"])

    assigned = materialize(same.select(F.col("rep").alias("vec_id"), "n", "label", "embedding").mapInArrow(assign, f"vec_id long, n long, label {kind}, raw binary, dim int, cell int, angle double"))
    for r in assigned.where(F.col("dim").isin(list(known))).groupBy("dim", "cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high")).collect():  # a row per cell
        known[r.dim].low[r.cell], known[r.dim].high[r.cell] = r.low, r.high
    ringed = spark.sparkContext.broadcast(known)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, own = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                place, cell = np.arange(len(at)), own[at].astype(np.int64)
                if d in ringed.value:
                    x = unit(np.frombuffer(b"".join(batch.column(3).take(pa.array(at)).to_pylist()), dtype).reshape(len(at), -1))
                    place, cell = ringed.value[d].visits(x, reach)
                take = pa.array(at[place])
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(5)), pa.array(cell, pa.int32()), pa.array(cell == own[at[place]])], ["vec_id", "n", "label", "raw", "dim", "cell", "own"])

    dealt = assigned.mapInArrow(visit, f"vec_id long, n long, label {kind}, raw binary, dim int, cell int, own boolean")
    # the key is a hash of label, length and cell: a collision would only bring strangers together, so the label's and the length are compared too
    dealt = materialize(dealt.withColumn("key", F.xxhash64("label", "dim", "cell")).withColumn("label_hash", F.xxhash64("label", "dim")).drop("label", "cell"))
    size = dealt.groupBy("key").agg(F.ceil(F.count_if("own") / BLOCK_ROWS).cast("int").alias("homes"), F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("cands"))
    placed = dealt.join(size, "key").withColumn("h", F.xxhash64("vec_id", F.lit(7)))
    wide = ["key", "label_hash", "vec_id", "n", "raw"]
    as_home = placed.where("own").select(*wide, F.pmod("h", "homes").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cands") - 1)).alias("j"), F.lit(0).alias("side"))
    as_cand = placed.where("homes > 0").select(*wide, F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("i"), F.pmod("h", "cands").cast("int").alias("j"), F.lit(1).alias("side"))
    both = as_home.unionByName(as_cand).select("key", "label_hash", "i", "j", "side", "vec_id", "n", "raw")
    found = materialize(map_groups(both, ["key", "label_hash", "i", "j"], lambda t: _join_block(t, threshold, dtype), "vec_id long, links long, dst long"))
    links = found.where("dst IS NULL").groupBy("vec_id").agg(F.sum("links").alias("links")).withColumnRenamed("vec_id", "rep")
    parts = connected_components(found.where("dst IS NOT NULL").select(F.col("vec_id").alias("src"), "dst")).withColumnRenamed("node", "rep")
    reps = same.select("label", "h1", "h2", "rep", "n").join(links, "rep", "left").join(parts, "rep", "left")
    # written by itself, so that a large group of copies is split in the join; vectors aren't keys, their hashes are
    reps = materialize(reps.select(F.col("label").alias("_l"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    mine = rows.where(good).select("vec_id", "label", *code)
    g = mine.join(reps, (F.col("label") == F.col("_l")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(good, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return g.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)
