"""Small things that operators share: staging a result, connected components, keyed merges."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: list[str] = []
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share.

    Where it is unset and all tasks run on this machine (local mode, tests), a temporary folder of our own; on a cluster such a folder
    would be read back empty by other machines, so there it is an error.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="corpusmill-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def new_path(spark: SparkSession, suffix: str = "parquet") -> str:
    """A path in the shared folder that nothing has been written to."""
    _written.append(f"{shared_folder(spark)}/{uuid.uuid4().hex}.{suffix}")
    return _written[-1]


def stage(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: computed once, short lineage, safe from lost executors."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, rows: int, *keys: str, each: int = 500_000) -> DataFrame:
    """df, of some `rows` rows, dealt by its keys to so many tasks that each has about `each`; as it is where the cores have no more than that anyway.

    Spark sizes tasks by shuffled bytes, of which a row has few where rows repeat each other; sorts and hash tables keep the rows in full.
    """
    tasks = -(-rows // each)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def remove_staged(spark: SparkSession) -> int:
    """Delete all tables that this process has staged so far, once the results that read them are written; gives their number."""
    gone = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def components(edges: DataFrame) -> DataFrame:
    """(src, dst) -> (node, component): smallest label that a node reaches, by passing labels along edges and doubling pointers until nothing moves."""
    pairs = edges.where("src <> dst").select("src", "dst")
    both = stage(pairs.union(pairs.select("dst", "src")).distinct())
    labels = both.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("label")).withColumnRenamed("src", "node")
    while True:
        labels = stage(labels)
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy("src").agg(F.min("label").alias("low"))
        lower = labels.join(near, F.col("node") == F.col("src"), "left").select("node", F.least("label", F.coalesce("low", "label")).alias("label"), F.col("label").alias("was"))
        jump = lower.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        moved = stage(lower.join(jump, F.col("label") == F.col("_n"), "left").select("node", F.least("label", F.coalesce("_l", "label")).alias("label"), "was"))
        if not moved.where("label <> was").limit(1).count():
            return moved.select("node", F.col("label").alias("component"))
        labels = moved.select("node", "label")


def one_row(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the smallest by its other columns in their order (maps, which have no order, aside): reruns agree."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    order = [F.col(c) for c in others if not dict(df.dtypes)[c].startswith("map")] or [F.lit(0)]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def first_rows(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key by order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def merge_keyed(target: DataFrame, updates: DataFrame, key: str, guarded: dict[str, str] | None = None) -> DataFrame:
    """Insert or update by key, nothing is deleted.

    guarded: column -> column of the target that, where it isn't null, keeps the old value. Columns of the target that the updates lack stay. An
    update without a key is ignored; the last of several updates of a key isn't defined, so they should be unique.
    """
    guarded = guarded or {}
    new = updates.where(F.col(key).isNotNull())
    u = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in new.columns if c != key], F.lit(True).alias("_hit"))
    j = target.withColumn("_old", F.lit(True)).join(u, F.col(key) == F.col("_k"), "full")
    out = [F.coalesce(F.col(key), F.col("_k")).alias(key)]
    for c in target.columns:
        if c == key:
            continue
        if c not in new.columns:
            out.append(F.col(c))
        elif c in guarded:
            out.append(F.when(F.col("_hit").isNotNull() & (F.col("_old").isNull() | F.col(guarded[c]).isNull()), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_hit").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    return j.select(*out)
