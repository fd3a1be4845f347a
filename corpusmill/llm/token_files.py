"""Token ids in files of word-aligned blocks.

Method: Simple-8b (Anh and Moffat, 2010). The top four bits of a 64-bit word select how many values of how many bits the other
60 hold; values of 60 bits or more follow an escape word as they are. Blocks of BLOCK ids begin on a word of their own, whose
place is stored, so that whole chunks are decoded with array operations. The files are Parquet with a row per chunk: Spark
writes them wherever it can write, and readers prune columns and seek by chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tables import new_path
from . import tokens
from .common import materialize, row_hash

#: Fixed values of the format: selector -> (values a word, bits a value); selector 0 is 240 zeros, 1 is the escape.
SELECTORS = {0: (240, 0), 1: (1, 64), 2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7), 9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60)}
COUNT = np.array([SELECTORS[s][0] for s in range(16)], np.int64)
BLOCK = 256
#: Ids of one chunk (a row of the file), about.
CHUNK_IDS = 1 << 19
END_ID = 2
#: Files whose bases (16 bytes each) are broadcast.
MAX_PARTS = 100_000
_POW2 = np.array([1 << b for b in range(64)], np.uint64)
FILE_SCHEMA = "part int, chunk int, ids_before long, doc_ids array<long>, doc_lens array<long>, n_ids long, block_offsets binary, words binary"


def widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, 0 for 0."""
    if len(values) and values.max() < 1 << 20:
        table = np.searchsorted(_POW2, np.arange(int(values.max()) + 1, dtype=np.uint64), "right").astype(np.int8)
        return table[values.astype(np.int64)]
    return np.searchsorted(_POW2, values, "right").astype(np.int8)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """values (unsigned, up to 64 bits) -> (words, word offset of each block). All blocks are coded in step."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks = -(-n // block)
    span = block + 240
    v = np.zeros((blocks, span), np.uint64)  # behind a block's end: zeros, which fit any word
    v[:, :block] = np.concatenate([values.astype(np.uint64), np.zeros(blocks * block - n, np.uint64)]).reshape(blocks, block)
    w = np.zeros((blocks, span), np.int8)
    w[:, :block] = widths(v[:, :block].reshape(-1)).reshape(blocks, block)
    # best[i]: selector of the most values that fit from i on
    best = np.full((blocks, block), 1, np.int8)
    tops = {1: w}
    size = 1
    while size < 128:
        t = tops[size]
        tops[2 * size] = np.maximum(t[:, : t.shape[1] - size], t[:, size:])
        size *= 2
    for s in range(15, -1, -1):  # from few values to many, so the last that fits stays
        if s == 1:
            continue
        count, bits = SELECTORS[s]
        p = 1 << (count.bit_length() - 1)
        top = np.maximum(tops[p][:, :block], tops[p][:, count - p : count - p + block])
        best[top <= bits] = s
    length = np.full(blocks, block, np.int64)
    length[-1] = n - (blocks - 1) * block
    at = np.zeros(blocks, np.int64)
    lanes = np.arange(blocks)
    steps = []
    while len(lanes):
        sel = best[lanes, at[lanes]]
        steps.append((lanes, at[lanes].copy(), sel))
        at[lanes] += COUNT[sel]
        lanes = lanes[at[lanes] < length[lanes]]
    lane = np.concatenate([x[0] for x in steps])
    pos = np.concatenate([x[1] for x in steps])
    sel = np.concatenate([x[2] for x in steps]).astype(np.int64)
    order = np.argsort(lane * (block + 1) + pos)
    lane, pos, sel = lane[order], pos[order], sel[order]
    slots = 1 + (sel == 1)
    out_at = np.cumsum(slots) - slots
    words = np.zeros(int(slots.sum()), np.uint64)
    for s in np.unique(sel):
        k = np.flatnonzero(sel == s)
        count, bits = SELECTORS[int(s)]
        words[out_at[k]] = np.uint64(int(s) << 60)
        if s == 1:
            words[out_at[k] + 1] = v[lane[k], pos[k]]
        elif s:
            vals = v[lane[k][:, None], pos[k][:, None] + np.arange(count)]
            words[out_at[k]] |= np.bitwise_or.reduce(vals << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    first = np.concatenate([[True], lane[1:] != lane[:-1]])
    return words, out_at[first]


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n values back (uint64), all words of a selector at once."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (sel == 1).any():
        k = 0
        marks = np.flatnonzero(sel == 1)
        last = -1
        for k in marks:
            if k != last:  # not itself a raw word
                last = k + 1
                if last < len(words):
                    raw[last] = True
    count = np.where(raw, 0, COUNT[sel])
    block_of = np.zeros(len(words), np.int64)
    block_of[offsets[1:]] = 1
    block_of = np.cumsum(block_of)
    before = np.cumsum(count) - count
    pos = block_of * block + before - before[offsets][block_of]
    end = np.minimum((block_of + 1) * block, n)
    out = np.zeros(n, np.uint64)
    for s in np.unique(sel[~raw]):
        if s == 0:
            continue
        k = np.flatnonzero((sel == s) & ~raw)
        if s == 1:
            out[pos[k]] = words[k + 1]
            continue
        c, bits = SELECTORS[int(s)]
        vals = (words[k][:, None] >> (np.arange(c, dtype=np.uint64) * np.uint64(bits))) & np.uint64((1 << bits) - 1)
        to = pos[k][:, None] + np.arange(c)
        inside = to < end[k][:, None]
        out[to[inside]] = vals[inside]
    return out


def write_token_files(docs: DataFrame, out: str, end_id: int = END_ID, path: str | None = None, chunk_ids: int = CHUNK_IDS) -> None:
    """Write the ids of (doc_id, text) to `out`, in ascending doc_id over the parts and inside them.

    Null text is empty (the end id alone); null ids come first; rows that repeat an id stay side by side, in order of a hash of their texts. The text is dealt
    out by ranges of (doc_id, hash) (one shuffle), so a part is as long as its range, reruns agree, and neither the whole nor all rows without an id meet in one task.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, chunk, before = tokens.load(path), TaskContext.get().partitionId(), 0, 0
        ids: list = []
        arrays: list[np.ndarray] = []
        held = 0

        def row() -> pa.RecordBatch:
            flat = np.concatenate(arrays)
            words, offsets = encode(flat)
            columns = [[part], [chunk], [before], [ids], [[len(a) for a in arrays]], [len(flat)], [offsets.astype("<i4").tobytes()], [words.astype("<u8").tobytes()]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            names = [x.split()[0] for x in FILE_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                texts = [t or "" for t in batch.column(1)[at : at + 500].to_pylist()]
                for i, a in zip(batch.column(0)[at : at + 500].to_pylist(), bpe.encode(texts)):
                    a = np.append(a, np.uint32(end_id))
                    ids.append(i)
                    arrays.append(a)
                    held += len(a)
                    if held >= chunk_ids:
                        yield row()
                        before += held
                        chunk, held, ids, arrays = chunk + 1, 0, [], []
        if arrays:
            yield row()

    order = ["doc_id", "_row"]
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_hash("text").alias("_row")).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(out)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) from the files at `path`; start: the ids of all documents before."""
    chunks = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = materialize(chunks.groupBy("part").agg(F.sum("n_ids").alias("n")))  # a row per file
    base = totals.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                begin, docs, lens, n, offsets, words = (batch.column(c)[k].as_py() for c in range(6))
                flat = decode(np.frombuffer(words, "<u8"), np.frombuffer(offsets, "<i4").astype(np.int64), n).astype("<u4")
                ends = np.cumsum(lens)
                cuts = [flat[e - m : e] for e, m in zip(ends, lens)]
                columns = [pa.array(docs, pa.int64()), pa.array(begin + ends - np.array(lens)), pa.array(lens, pa.int64()), pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([c.astype(np.int32) for c in cuts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    if totals.count() <= MAX_PARTS:  # so many small rows can be sent everywhere; beyond, the encoded chunks are shuffled to them
        base = F.broadcast(base)
    rows = chunks.join(base, chunks["part"] == base["_part"]).select((F.col("base") + F.col("ids_before")).alias("begin"), "doc_ids", "doc_lens", "n_ids", "block_offsets", "words")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "tokens")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), out)
    return read_token_files(spark, out)
