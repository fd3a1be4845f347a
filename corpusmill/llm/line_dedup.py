"""Line dedup: lines that many documents share go, but for one document that keeps them.

Method: explode normalised lines, hash them, count the distinct documents per hash, drop the lines of hashes over the
threshold, and put the rest together by position. Only (hash, document, position) rows are shuffled for counting; the
counts combine on the map side, so one line in a third of all documents costs one row per task. A document is an id: rows that
repeat one are parts of it, so a key counts once for them, but each row is cut by itself (told by a hash of its text).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_hash, slices

#: Stripped from both ends of a line to make its key.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(docs: DataFrame, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, pos, h1, h2, first): a 128-bit hash of each line's key, and 1 where the row has the key for the first time; shorter keys are left out."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            which, at, high, low, first = [], [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if not text or len(text) < min_chars:
                    continue
                seen = set()
                for k, line in enumerate(text.split("\n")):
                    key = line.strip(BLANKS)
                    if len(key) >= min_chars:
                        h = xxhash.xxh3_128_intdigest(key.encode().lower())  # bytes.lower() is A-Z only
                        which.append(i)
                        at.append(k)
                        high.append((h >> 64) - (1 << 63))
                        low.append((h & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                        first.append(h not in seen)
                        seen.add(h)
            take = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(at, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array([int(x) for x in first], pa.int32())], ["doc_id", "row", "pos", "h1", "h2", "first"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_hash(text_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(keyed, "doc_id long, row long, pos int, h1 long, h2 long, first int")


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with `text` cleaned, and the columns n_lines and n_dropped added (existing ones of these names are replaced).

    A key (line stripped of ASCII blanks, A-Z lower-cased) of at least min_chars code points in at least min_docs documents
    (distinct ids) loses all its lines except in the largest id holding it. Null text counts as empty: one empty line, text ''.
    Rows that repeat an id are one document when keys are counted, and all of them keep the lines that it keeps; each loses lines
    of its own text only. A row with a null id is no document that counts, is smaller than all others, and loses the lines over the
    threshold. A line may occur twice in one document: that counts once, and both go or stay.
    """
    lines = materialize(line_keys(docs, min_chars, id_col, text_col))
    # rows that repeat an id may count twice here, so this is a superset of the keys over the threshold. Written by itself, so that the
    # join below has plain inputs: small enough, it is broadcast; if not, a hot line's rows are split
    counted = F.when(F.col("doc_id").isNotNull(), F.col("first"))
    wide = materialize(lines.groupBy("h1", "h2").agg(F.sum(counted).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs).drop("n"))
    hits = materialize(lines.join(wide, ["h1", "h2"]))
    # the exact number of ids: a row for each key and id first, then their number
    ids = hits.where("doc_id IS NOT NULL").groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    few = materialize(ids.groupBy("h1", "h2").agg(F.sum("one").alias("n")).where(F.col("n") < min_docs).drop("n"))
    gone = hits.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).join(few, ["h1", "h2"], "left_anti")
    drops = gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("_drops")).withColumnsRenamed({"doc_id": "_id", "row": "_row"})

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names = batch.schema.names
            cols = dict(zip(names[:-1], batch.columns[:-1]))
            text, total, dropped = [], [], []
            for t, d in zip(batch.column(text_col).to_pylist(), batch.column("n_dropped").to_pylist()):
                lines = (t or "").split("\n")
                total.append(len(lines))
                dropped.append(len(d) if d else 0)
                gone = set(d) if d else ()
                text.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t or "")
            cols[text_col] = pa.array(text, batch.schema.field(text_col).type)
            cols |= {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    base = docs.drop("n_lines", "n_dropped")
    names = base.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema] + ["n_lines long", "n_dropped long"])
    # own columns are told apart by a struct, so none of the input's can clash
    packed = base.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_in"), F.col(id_col).cast("long").alias("_at"), row_hash(text_col).alias("_own"))
    joined = packed.join(drops, F.col("_at").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_row")), "left")
    return joined.select(*[F.col("_in")[c].alias(c) for c in names], F.col("_drops").alias("n_dropped")).mapInArrow(cleaned, schema)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_lines(docs, min_docs=3, min_chars=20)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, p AS pos, list_extract(l, p) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d, unnest(range(1, len(l) + 1)) AS u(p)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), wide AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT a.doc_id, a.pos, a.line, (w.k IS NOT NULL AND a.doc_id <> w.keeper) AS gone FROM keyed a LEFT JOIN wide w ON a.k = w.k
)
SELECT doc_id, count(*) AS n_lines, CAST(coalesce(sum(CASE WHEN gone THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
