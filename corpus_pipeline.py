"""The corpus pipeline: documents -> packed training sequences, by five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
Belongs to the subpackage corpusmill.llm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize, row_hash
from corpusmill.llm.jaccard import jaccard_rows
from corpusmill.llm.line_dedup import drop_repeated_lines
from corpusmill.llm.mixing import mix_sources
from corpusmill.llm.packing import pack, token_pieces
from corpusmill.llm.quality import judge_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def at() -> Column:
    return F.coalesce("doc_id", F.lit(0)).alias("_at")


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with what tells them apart: _at (the id, 0 for null), _row (a hash of the row) and _copy (1, 2, … of rows that are equal in all columns).

    Dealt out and sorted by (_at, _row) as the join that follows needs it, so the texts move once.
    """
    rows = docs.select(*COLUMNS, at(), row_hash(*COLUMNS).alias("_row"))
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_at", "_row").orderBy(F.lit(1))))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Each row is judged by itself, whether its doc_id is null or repeated.

    The texts are read twice, once for the sketches and once for the filter, and neither shuffled nor written between.
    """
    return judge_quality(docs.select(*COLUMNS), keep=COLUMNS, write=False).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share go, but in the largest doc_id; documents that are left without a word go too.

    Each row is cut by itself: rows that repeat a doc_id count as one document; a null doc_id counts as none and is smaller than all others.
    """
    out = drop_repeated_lines(docs.select(*COLUMNS), min_docs=3, min_chars=20)
    return out.withColumn("n_chars", F.length("text").cast("long")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 or more: the smallest doc_id.

    Each row is a document: of rows that repeat a doc_id, one counts as the smaller (by a hash); a null doc_id is larger than all others.
    Texts without a word stay, each of them.
    """
    row = row_hash(*COLUMNS)
    parts = jaccard_rows(docs.select(*COLUMNS), width=5, threshold=80, row=row).where("first")
    single = parts.groupBy(at(), F.col("row").alias("_row")).agg(F.max("n_shingles").alias("_n"))
    return numbered(docs).join(single, ["_at", "_row"]).where("_copy = 1 OR _n = 0").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not at all, once or twice). Each row is drawn by itself, whether its doc_id is null or repeated."""
    drawn = mix_sources(docs.withColumn("_row", row_hash(*COLUMNS)), keep=["_row"]).select("doc_id", "_row", "copies")
    taken = drawn.groupBy(at(), "_row").agg(F.array_sort(F.collect_list("copies")).alias("_taken"))
    mixed = numbered(docs).join(taken, ["_at", "_row"]).withColumn("_n", F.element_at("_taken", F.col("_copy"))).where("_n > 0")
    return mixed.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents (a document that the mix takes twice comes twice) with their places in sequences of 1024 tokens."""
    return pack(token_pieces(docs.select("doc_id", "text"), 1024), 1024).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: Sketch thresholds, sampling by hash and the packing have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if k == len(STAGES) - 1 else materialize(docs)
    return docs
