"""What the training-data operators share: the shared folder, written intermediate tables, words, grouped streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import new_path

#: A word is a run of characters other than the ASCII white space (the pattern of every contract here).
WORD = r"[^\x20\x09-\x0D]+"

#: Spark 4.1: the shuffle files of a query go when it has ended (what it wrote no longer needs them).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors, and is computed once.

    Parquet, so that later reads prune columns; shuffle files of the writing query are dropped once it has ended.
    """
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize() wrote, once all that is read from them is written itself. A lost executor can't need them: what was written later has no lineage to them."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def row_hash(*columns: str) -> Column:
    """A 64-bit hash of a row's columns, nulls told from empty ones: tells rows that share an id. Rows that are equal in all of them share it."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_groups(df: DataFrame, keys: list[str], fn: Callable, schema: str, partitions: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Deal df out by keys, sort it inside the partitions, and hand each group of equal keys to fn as one Arrow table.

    fn(table) returns a record batch of `schema`, or None. Unlike a grouped map this costs one Python call per group and no
    serialisation per group; a group must fit in a worker, so callers split groups by a block key first.
    """
    dealt = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    ordered = dealt.sortWithinPartitions(*keys, *(order or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held:
                same = all(held[-1][k][-1].equals(table[k][0]) for k in keys)
                if not same:
                    yield from _emit(fn, pa.concat_tables(held))
                    held = []
            cuts = group_starts([table[k] for k in keys])
            for a, b in zip(cuts, [*cuts[1:], table.num_rows]):
                if b < table.num_rows:
                    whole = pa.concat_tables([*held, table.slice(a, b - a)]) if held else table.slice(a, b - a)
                    held = []
                    yield from _emit(fn, whole)
                else:
                    held.append(table.slice(a, b - a))
        if held:
            yield from _emit(fn, pa.concat_tables(held))

    return ordered.mapInArrow(run, schema)


def _emit(fn: Callable, table: pa.Table) -> Iterator[pa.RecordBatch]:
    out = fn(table)
    if out is not None and out.num_rows:
        yield out


def group_starts(columns: list[pa.ChunkedArray]) -> list[int]:
    """Positions where a run of equal keys begins (integer keys, nulls not allowed)."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        v = c.to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new).tolist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (public splitmix64 constants), in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces, so that a worker holds few texts as Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


_RNG = np.random.default_rng(20)
BYTE_HASH = _RNG.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        ones = np.ones(max(n, 1 << 20), np.uint64)
        out = []
        for b in (_BASE, _INVERSE):
            x = ones * np.uint64(b)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        _powers[:] = out
    return _powers[0][:n], _powers[1][:n]
