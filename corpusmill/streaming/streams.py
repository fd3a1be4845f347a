"""Incremental work as Structured Streaming: feed ingest with a ledger, late data, heartbeats, heat over event time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import low_quality, strip_html
from ..operators.context import heat_of_count
from ..operators.filters import ingest_class
from ..operators.tables import one_row
from ..sources.schemas import EVENTS


def read_events(spark: SparkSession, path: str, schema: str = EVENTS, per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet event files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def heat_windows(events: DataFrame, key: str = "event_type", ts: str = "ts", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(key, start, n, heat) per tumbling window, batch or stream (S7): late rows up to the watermark count."""
    d = events.withColumn(ts, F.col(ts).cast("timestamp"))
    d = d.withWatermark(ts, late) if d.isStreaming else d
    out = d.groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), "n", heat_of_count(F.col("n")).alias("heat"))


def session_heat(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """(key, start, end, n, heat) per session of a key."""
    d = events.withColumn(ts, F.col(ts).cast("timestamp"))
    d = d.withWatermark(ts, late) if d.isStreaming else d
    out = d.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", heat_of_count(F.col("n")).alias("heat"))


def first_seen(items: DataFrame, key: str = "url", ts: str = "ts", late: str = "7 days") -> DataFrame:
    """The first item of each key within the watermark; a stream keeps no more state than that."""
    d = items.withColumn(ts, F.col(ts).cast("timestamp"))
    return d.withWatermark(ts, late).dropDuplicatesWithinWatermark([key]) if d.isStreaming else one_row(d.select(key, ts, *[c for c in d.columns if c not in (key, ts)]), [key]).select(*d.columns)


def classify_items(items: DataFrame, deleted: Iterable[str] = (), min_len: int = 200) -> DataFrame:
    """items (item_id, url, title, content, date) with disposition and reason (S1): bad_id, junk, market, deleted, retry (short texts, not recorded), ingest."""
    text = F.coalesce(strip_html(F.col("content"), 1), F.lit(""))
    c = ingest_class(F.col("title"))
    gone = F.lit(False)
    for w in deleted:
        gone = gone | text.contains(w)
    disposition = F.when((F.coalesce("item_id", F.lit("")) == "") | (F.coalesce("url", F.lit("")) == ""), "bad_id").when(c["disposition"] != "ingest", c["disposition"]).when(F.coalesce(gone, F.lit(False)), "deleted").when(low_quality(text, (), min_len), "retry").otherwise("ingest")
    return items.withColumn("body", text).withColumn("disposition", disposition).withColumn("reason", c["reason"])


def ingest_batch(items: DataFrame, ledger: DataFrame, deleted: Iterable[str] = (), min_len: int = 200) -> DataFrame:
    """One batch: classified items whose url the ledger lacks, each url once (the earliest date, then id)."""
    new = items.join(ledger.select("url").distinct(), "url", "left_anti")
    d = classify_items(new, deleted, min_len)
    return d.groupBy("url").agg(F.min_by(F.struct(*[c for c in d.columns if c != "url"]), F.struct("date", "item_id")).alias("r")).select("url", "r.*")


def ingest_stream(items: DataFrame, ledger_path: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """The same over a stream, until its files are read: what isn't to be retried is recorded in the ledger after it is written.

    Each batch writes to a folder of its own number (overwritten if the batch runs again), so a restart after a failure repeats nothing.
    """
    spark = items.sparkSession
    schema = "url string, disposition string, run string, batch bigint"
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger_path)

    def run(batch: DataFrame, number: int) -> None:
        # what an earlier try of this very batch has recorded doesn't count
        ledger = spark.read.schema(schema).parquet(ledger_path).where(~((F.col("run") == checkpoint) & (F.col("batch") == number)))
        done = ingest_batch(batch, ledger).withColumn("run", F.lit(checkpoint)).withColumn("batch", F.lit(number).cast("long")).persist()
        try:
            done.drop("run", "batch").write.mode("overwrite").parquet(f"{out_path}/batch={number}")
            done.where("disposition <> 'retry'").select("url", "disposition", "run", "batch").write.mode("append").parquet(ledger_path)
        finally:
            done.unpersist()

    return items.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_late(rows: DataFrame, date: Column, bound: str) -> DataFrame:
    """rows with lane: late for known dates before the bound, else on_time; unknown dates are admitted."""
    d = F.coalesce(date.cast("string"), F.lit(""))
    return rows.withColumn("lane", F.when((d != "") & (d < bound), "late").otherwise("on_time"))


def overlap_warning(batch: DataFrame, ledger: DataFrame, key: str = "url") -> DataFrame:
    """One row (in_ledger, overlap, overrun): there is history, but nothing of the batch is in it, so items in between may be lost (S3)."""
    n = ledger.agg(F.count("*").alias("in_ledger"))
    o = batch.join(ledger.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("overlap"))
    return n.join(o, F.lit(True)).withColumn("overrun", (F.col("in_ledger") > 0) & (F.col("overlap") == 0))


def silent_sources(beats: DataFrame, source: str, ts: str, now: str, hours: int = 26) -> DataFrame:
    """(source, last_seen) of sources that were last heard more than `hours` before `now`."""
    last = beats.groupBy(source).agg(F.max(F.col(ts).cast("timestamp")).alias("last_seen"))
    return last.where(F.col("last_seen") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS"))


def drain(queue: DataFrame, docs: DataFrame, ledger: DataFrame, version: int) -> DataFrame:
    """Queue rows in order with outcome: rebuild (missing, version, content), unchanged, or dead_letter when the document is gone."""
    from ..operators.incremental import content_hash
    from ..operators.ranking import queue_order

    q = queue_order(queue)
    l = ledger.select(F.col("doc_id").alias("_l"), F.col("raw_content_hash").alias("_h"), F.col("pipeline_version").alias("_v"))
    j = q.join(docs.select(F.col("doc_id").alias("_d"), content_hash(F.col("text")).alias("_now")), F.col("pid") == F.col("_d"), "left").join(l, F.col("pid") == F.col("_l"), "left")
    outcome = F.when(F.col("_d").isNull(), "dead_letter").when(F.col("_l").isNull() | (F.col("_v") != version) | (F.col("_h") != F.col("_now")), "rebuild").otherwise("unchanged")
    return j.withColumn("outcome", outcome).drop("_d", "_now", "_l", "_h", "_v")
