"""Sinks: partitioned and ordered outputs, publishing of staged results, keyed appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.monitoring import shrink_gate, unique_gate
from ..operators.tables import one_row


def write_by_relation(edges: DataFrame, path: str, files: int | None = None, rows: int = 500_000) -> None:
    """One folder per relation type (A9), each in up to `files` files by a hash of the edge, so that few large types or nodes aren't written by as few tasks.

    Without `files`, the edges of the largest type are counted first, and there is one for every `rows` of them.
    """
    if files is None:
        largest = edges.groupBy("rel").count().agg(F.max("count")).first()[0] or 0
        files = -(-largest // rows)
    part = F.pmod(F.xxhash64("from_id", "to_id"), F.lit(files))
    # a number of tasks that Spark keeps: it would put parts together by their size
    dealt = edges.repartition(4 * files, "rel", part) if files > 1 else edges.repartition("rel")
    dealt.sortWithinPartitions("rel", "from_id", "to_id").write.mode("overwrite").partitionBy("rel").json(path)


def write_ordered_edges(edges: DataFrame, path: str) -> None:
    """All edges in order of (from, to, rel), so that reruns are equal byte by byte (A10)."""
    edges.orderBy("from_id", "to_id", "rel").write.mode("overwrite").json(path)


def write_adjacency(nodes: DataFrame, path: str) -> None:
    nodes.orderBy("node_id").write.mode("overwrite").json(path)


def publish(spark: SparkSession, staged: str, target: str, key: str | None = None, ratio: float = 0.8) -> dict:
    """Overwrite the target with a staged Parquet result after the gates (A12); raises with the reason if they refuse. Returns row counts."""
    new = spark.read.parquet(staged)
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(target)
    old = spark.read.parquet(target) if there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there) else None
    before = 0 if old is None else old.count()
    refused = (shrink_gate(new, old, ratio) if old is not None else None) or (unique_gate(new, key) if key else None)
    if refused:
        raise ValueError(f"not published: {refused}")
    new.write.mode("overwrite").parquet(target)
    return {"before": before, "after": spark.read.parquet(target).count()}


def append_absent(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose keys the target lacks (A17); a missing target is created."""
    spark = rows.sparkSession
    new = one_row(rows, keys)
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there):
        new = new.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
    new.write.mode("append").parquet(path)


def append_by_run(rows: DataFrame, path: str, run_date: str) -> None:
    """Market items staged apart per run date."""
    rows.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").parquet(path)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Stage rows in a relational store; the keyed merge runs there."""
    rows.write.jdbc(url, table, mode="overwrite", properties=properties)
