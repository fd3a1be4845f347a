"""Toxicity scores by a factorization machine over hashed terms.

Method: a text's terms (words and the first letters of words, which carry over to inflected forms) are hashed into DIM buckets; the score is
the logistic function of w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j (Rendle, 2010), with x_i = 1 for the terms that occur, scaled
by one over the root of their number in the pairwise part. The factors have a rate and a weak penalty of their own, so that they learn
pairs that say more together than apart, which no linear weights can tell. The
machine is fitted on a bounded sample of labelled rows (MAX_ROWS, by hash of the id; rows of the held-out fold never enter), in one task,
from hashed terms alone; scoring goes over every whole text, where it is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: Buckets of the hashed terms, factors a term, and the bound on the labelled rows of the fit.
DIM, FACTORS, MAX_ROWS = 1 << 17, 8, 24_000
#: Passes over the sample, and steps at least (small samples are passed over more often), rows a step.
EPOCHS, STEPS, BATCH, TOXIC_WEIGHT, SEED = 5, 900, 64, 4.0, 5
#: Rate and penalty of the linear weights, and of the factors, which begin at random with this spread.
RATE, PENALTY, PAIR_RATE, PAIR_PENALTY, PAIR_START = 0.05, 1.0, 0.2, 0.05, 0.1
#: A term counts from so many rows of the sample on (small samples: a 300th of the rows).
MIN_SEEN = 20
STEMS = (4, 6)
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def terms(text: str | None) -> np.ndarray:
    """Distinct buckets of the text's terms."""
    if not text:
        return np.zeros(0, np.int32)
    words = {w.strip(_PUNCTUATION) for w in set(text.lower().split())}
    words.discard("")
    names = set(words)
    for w in words:
        for n in STEMS:
            if len(w) > n:
                names.add(w[:n] + "*")
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(n) & (DIM - 1) for n in names), np.int32, len(names)))


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w0, w, V): AdaGrad on the log-loss in small batches, then the score 0.5 is put between the classes.

    Every fifth row, in the given order, is kept from the descent; on these the cut between the classes is chosen. The strong
    penalty makes the ranking good and the scale of the sums arbitrary, so the cut and the scale are set afterwards.
    """
    check = np.arange(len(rows)) % 5 == 0
    if len(set(labels[check])) < 2:
        check[:] = False
    train = [r for r, c in zip(rows, check) if not c]
    model = _descend(train, labels[~check], seed)
    seen = check if check.any() else ~check
    z, y = margins(model, [r for r, c in zip(rows, seen) if c]), labels[seen]
    if len(set(y)) == 2:
        order = np.argsort(z, kind="stable")
        # of all cuts, the one with the most toxic above and the most others below; the middle between its neighbours
        above = (y == 1).sum() - np.cumsum(y[order] == 1)
        below = np.cumsum(y[order] == 0)
        k = int(np.argmax(above[:-1] / (y == 1).sum() + below[:-1] / (y == 0).sum()))
        cut = (z[order[k]] + z[order[k + 1]]) / 2
        scale = min(1e3, 4.0 / max(1e-6, float(np.mean(np.abs(z - cut)))))
        w0, w, v = model
        model = ((w0 - cut) * scale, w * scale, v * np.sqrt(scale))
    return tuple(x.astype(np.float32) for x in model)


def _descend(rows: list[np.ndarray], labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    seen = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=DIM)
    scale = np.log((len(rows) + 1) / (seen + 1.0))  # frequent terms weigh less
    scale /= max(scale.max(), 1e-9)
    scale[seen < max(2, min(MIN_SEEN, len(rows) // 300))] = 0  # and those of a few rows nothing: they would be learned by heart
    rows = [r[scale[r] > 0] for r in rows]
    w, v, w0 = np.zeros(DIM), rng.standard_normal((DIM, FACTORS)) * PAIR_START, -2.0
    gw, gv, g0 = np.full(DIM, 1e-4), np.full((DIM, FACTORS), 1e-4), 1e-2
    weight = np.where(labels == 1, TOXIC_WEIGHT, 1.0)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(rows))))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            n = np.array([len(rows[i]) for i in own])
            flat = np.concatenate([rows[i] for i in own])
            seg = np.repeat(np.arange(len(own)), n)
            x, norm = scale[flat], 1 / np.maximum(1, np.sqrt(n))
            s = v[flat] * x[:, None]
            total = np.stack([np.bincount(seg, s[:, c], minlength=len(own)) for c in range(FACTORS)], 1)
            z = w0 + np.bincount(seg, w[flat] * x, minlength=len(own)) + 0.5 * norm * ((total**2).sum(1) - np.bincount(seg, (s * s).sum(1), minlength=len(own)))
            g = weight[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own])
            g0 += g.sum() ** 2
            w0 -= RATE * g.sum() / np.sqrt(g0)
            u, inv = np.unique(flat, return_inverse=True)
            dw = np.bincount(inv, g[seg] * x, minlength=len(u)) + PENALTY * w[u]
            gw[u] += dw * dw
            w[u] -= RATE * dw / np.sqrt(gw[u])
            d = (g * norm)[seg][:, None] * x[:, None] * (total[seg] - s)
            dv = np.stack([np.bincount(inv, d[:, c], minlength=len(u)) for c in range(FACTORS)], 1) + PAIR_PENALTY * v[u]
            gv[u] += dv * dv
            v[u] -= PAIR_RATE * dv / np.sqrt(gv[u])
    w[scale == 0], v[scale == 0] = 0, 0
    return np.array([w0]), w * scale, v * scale[:, None]


def margins(model: tuple[np.ndarray, np.ndarray, np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """The machine's sums of each row of terms."""
    w0, w, v = model
    if not rows:
        return np.zeros(0)
    n = np.array([len(r) for r in rows], np.int64)
    some = np.flatnonzero(n)
    first, pair = np.zeros(len(rows)), np.zeros(len(rows))
    if len(some):
        flat = np.concatenate(rows).astype(np.int64)
        at = (np.cumsum(n) - n)[some]
        f = v[flat].astype(np.float64)
        first[some] = np.add.reduceat(w[flat].astype(np.float64), at)
        pair[some] = (np.add.reduceat(f, at) ** 2 - np.add.reduceat(f * f, at)).sum(axis=1) * 0.5 / np.sqrt(n[some])
    return float(w0[0]) + first + pair


def scores(model: tuple[np.ndarray, np.ndarray, np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margins(model, rows), -30, 30)))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 0 modulo 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = SEED) -> DataFrame:
    """One row (w0, w, v binary): the machine fitted on at most max_rows labelled rows outside the held-out fold.

    Labels that are null, and documents without a label, don't take part; a document with several labels is taken with each. The
    sample is the labels of the smallest hash of the id, the toxic ones (up to half of max_rows) and the others by themselves; of
    documents that repeat their ids so often that more than max_rows texts come of it, those of the smallest hash.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id"))).select("doc_id", (F.col("toxic") > 0).cast("int").alias("y"))
    by_hash = [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")]
    chosen = known.where("y = 1").orderBy(*by_hash).limit(max_rows // 2).union(known.where("y = 0").orderBy(*by_hash).limit(max_rows - max_rows // 2))
    chosen = materialize(chosen)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [terms(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "y", "terms"])

    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text").mapInArrow(hashed, "doc_id long, y int, terms binary")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(i, y, t) for b in batches for i, y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())]
        got.sort(key=lambda x: (zlib.crc32(str(x[0]).encode()), x[0], x[1], x[2]))  # the same order however the rows came
        w0, w, v = fit([np.frombuffer(t, np.int32) for _, _, t in got], np.array([y for _, y, _ in got], np.int64), seed) if got else (np.zeros(1, np.float32), np.zeros(DIM, np.float32), np.zeros((DIM, FACTORS), np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (w0, w, v)], ["w0", "w", "v"])

    return sample.orderBy(F.xxhash64("doc_id", "terms", F.lit(seed)), "doc_id", "y").limit(max_rows).repartition(1).mapInArrow(learn, "w0 binary, w binary, v binary")


def score_toxicity(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs; null and empty texts get the machine's constant. The model's size is fixed (5 MB)."""
    row = model.first()
    parts = [np.frombuffer(x, np.float32) for x in (row or (b"\0\0\0\0", bytes(4 * DIM), bytes(4 * DIM * FACTORS)))]
    shared = docs.sparkSession.sparkContext.broadcast((parts[0], parts[1], parts[2].reshape(DIM, FACTORS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                p = scores(shared.value, [terms(t) for t in batch.column(1)[at : at + 250].to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 250], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = score_toxicity(docs, materialize(fit_toxicity(docs, labels)))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
