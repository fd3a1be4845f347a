"""Streams with state: silence by timers, late rows and overlap beside the stream, a queue that is filled and drained batch by batch.

Every stream here ends when its files are read (availableNow) and goes on from its checkpoint when it is started again. What a batch writes goes into folders of the
batch's number and replaces what an earlier try of the same batch left there; what a batch reads of earlier ones is restricted to smaller numbers. So a
run that dies between two writes is made good by the next start, and the tables equal those of a run that didn't die.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.incremental import content_hash
from ..operators.ranking import queue_order

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folder(out: str, name: str, number: int) -> str:
    return f"{out}/{name}/batch={number}"


def write_batch(rows: DataFrame, out: str, name: str, number: int) -> None:
    """A batch's rows of one table, in place of what an earlier try of the batch has written."""
    rows.write.mode("overwrite").parquet(folder(out, name, number))


def written(spark: SparkSession, out: str, name: str, schema: str, before: int | None = None) -> DataFrame:
    """A table that batches have written, with column batch; before: only batches of smaller numbers."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, batch int")
    rows = spark.read.schema(f"{schema}, batch int").option("basePath", f"{out}/{name}").parquet(f"{out}/{name}")
    return rows if before is None else rows.where(F.col("batch") < before)


def _started(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---- silence (S4) ---------------------------------------------------------------------------------------------------------------------


class SilenceTimers(StatefulProcessor):
    """Per source the sessions that are still open: runs of beats with no gap over the allowed one. Each has a timer at its end plus that gap; when it fires, the source was silent from then on.

    Beats may come in any order within the watermark; a beat between two sessions joins them. The state holds a few sessions, however many beats there are.
    """

    def __init__(self, source: str, ts: str, gap_ms: int):
        self.source, self.ts, self.gap = source, ts, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getValueState("sessions", "starts array<long>, ends array<long>")

    def _known(self) -> list[tuple[int, int]]:
        return list(zip(*self.sessions.get())) if self.sessions.exists() else []

    def _join(self, sessions: list[tuple[int, int]]) -> list[tuple[int, int]]:
        joined: list[tuple[int, int]] = []
        for a, z in sorted(sessions):
            if joined and a <= joined[-1][1] + self.gap:
                joined[-1] = (joined[-1][0], max(z, joined[-1][1]))
            else:
                joined.append((a, z))
        return joined

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        old = self._known()
        joined = old
        for frame in rows:  # each frame's beats become sessions, so a busy source isn't held as a list
            t = np.sort(frame[self.ts].astype("datetime64[ms]").astype("int64").to_numpy())
            t = t[t > closed]
            if len(t):
                cut = np.flatnonzero(np.diff(t) > self.gap)
                joined = self._join([*joined, *zip(t[np.append(0, cut + 1)].tolist(), t[np.append(cut, len(t) - 1)].tolist())])
        for z in {z for _, z in old} - {z for _, z in joined}:
            self.handle.deleteTimer(z + self.gap)
        for z in {z for _, z in joined} - {z for _, z in old}:
            self.handle.registerTimer(z + self.gap)
        if joined:
            self.sessions.update(tuple(map(list, zip(*joined))))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() - self.gap
        left = [s for s in self._known() if s[1] != end]
        if left:
            self.sessions.update(tuple(map(list, zip(*left))))
        else:
            self.sessions.clear()
        yield pd.DataFrame({self.source: [key[0]], "last_seen": pd.to_datetime([end], unit="ms")})

    def close(self) -> None:
        pass


def silences(beats: DataFrame, source: str, ts: str, hours: int = 26, late: str = "2 days") -> DataFrame:
    """(source, last_seen) of a stream: a row for each silence of more than `hours`, as soon as the watermark has passed it.

    Rows without a source or time are left out; those behind the watermark come too late and change nothing. Needs the RocksDB state store, see silence_stream().
    """
    d = beats.where(F.col(source).isNotNull() & F.col(ts).isNotNull()).select(source, F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, late)
    schema = f"`{source}` {d.schema[source].dataType.simpleString()}, last_seen timestamp"
    return d.groupBy(source).transformWithStateInPandas(SilenceTimers(source, ts, int(hours * 3_600_000)), schema, "append", "EventTime")


def silence_stream(beats: DataFrame, source: str, ts: str, out: str, checkpoint: str, hours: int = 26, late: str = "2 days") -> StreamingQuery:
    """silences() written to out/silences by batch; a restart goes on with the timers of the checkpoint."""
    spark = beats.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        return _started(silences(beats, source, ts, hours, late), lambda batch, number: write_batch(batch, out, "silences", number), checkpoint)
    finally:
        spark.conf.set(STATE_STORE, before)


def silences_until(beats: DataFrame, source: str, ts: str, until: Column | str, hours: int = 26) -> DataFrame:
    """The same over a table: (source, last_seen) of beats that no other one of their source follows within `hours`, when that time was over before `until`."""
    t = F.date_trunc("millisecond", F.col(ts).cast("timestamp")).alias("last_seen")
    d = beats.where(F.col(source).isNotNull() & F.col(ts).isNotNull()).select(source, t)
    gap = F.expr(f"INTERVAL {int(hours * 3_600_000)} MILLISECONDS") if hours != int(hours) else F.expr(f"INTERVAL {int(hours)} HOURS")
    follows = F.lead("last_seen").over(Window.partitionBy(source).orderBy("last_seen"))
    end = F.lit(until).cast("timestamp") if isinstance(until, str) else until
    return d.withColumn("_next", follows).where((F.col("_next").isNull() | (F.col("_next") > F.col("last_seen") + gap)) & (F.col("last_seen") + gap <= end)).drop("_next")


# ---- late rows and overlap beside the stream (S2, S3) ---------------------------------------------------------------------------------------


def lanes_stream(items: DataFrame, key: str, ts: str, out: str, checkpoint: str, late: str = "2 days") -> StreamingQuery:
    """Each batch of a stream in two lanes, out/on_time and out/late, and one row in out/overlap.

    Late is a row behind the watermark that the batches before have set (greatest time less `late`; kept in out/times, for a batch can't ask the engine for it); rows of unknown time are on time. Both lanes together
    are the input, whatever order its files come in. overlap: (in_ledger, overlap, overrun), how many keys the batches before have brought,
    and how many rows of this one have such a key; overrun: there is history, but nothing of it is seen again, so items in between may be lost.
    """
    spark = items.sparkSession
    times, keys = "greatest timestamp", f"`{key}` {items.schema[key].dataType.simpleString()}"

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("_t", F.col(ts).cast("timestamp")).persist()
        try:
            seen = written(spark, out, "times", times, number).agg(F.max("greatest").alias("_g"))
            bound = F.col("_g") - F.expr(f"INTERVAL {late}")
            split = rows.join(F.broadcast(seen), F.lit(True)).withColumn("_late", F.coalesce(F.col("_t") < bound, F.lit(False)))  # one row
            write_batch(split.where("NOT _late").drop("_t", "_g", "_late"), out, "on_time", number)
            write_batch(split.where("_late").drop("_t", "_g", "_late"), out, "late", number)
            ledger = written(spark, out, "keys", keys, number).select(key)
            n = ledger.agg(F.count("*").alias("in_ledger"))
            o = rows.join(ledger, key, "left_semi").agg(F.count("*").alias("overlap"))
            write_batch(n.join(o, F.lit(True)).withColumn("overrun", (F.col("in_ledger") > 0) & (F.col("overlap") == 0)), out, "overlap", number)
            write_batch(rows.select(key).where(F.col(key).isNotNull()).distinct().join(ledger, key, "left_anti"), out, "keys", number)
            write_batch(rows.agg(F.max("_t").alias("greatest")), out, "times", number)
        finally:
            rows.unpersist()

    return _started(items, run, checkpoint)


# ---- a queue that is filled and drained (S5, S6) ---------------------------------------------------------------------------------------------

REQUESTS = "pid string, `trigger` string, priority string, requested_at string, pos long"
LEDGER = "pid string, raw_content_hash string, pipeline_version int"


def latest_ledger(spark: SparkSession, base: DataFrame, out: str, before: int | None = None) -> DataFrame:
    """(pid, raw_content_hash, pipeline_version): the base and what batches have rebuilt since; the last batch of a pid counts."""
    first = base.select(F.col("pid").cast("string").alias("pid"), "raw_content_hash", F.col("pipeline_version").cast("int").alias("pipeline_version"), F.lit(-1).alias("batch"))
    all_ = first.unionByName(written(spark, out, "ledger", LEDGER, before))
    return all_.groupBy("pid").agg(F.max_by(F.struct("raw_content_hash", "pipeline_version"), F.col("batch")).alias("l")).select("pid", "l.*")


def new_requests(docs: DataFrame, ledger: DataFrame, version: int, at: str) -> DataFrame:
    """Requests for the next stage (S6): documents (doc_id, text) that the ledger lacks (trigger new_document, priority high), or has with another content or version (content, version; normal)."""
    l = ledger.select(F.col("pid").alias("_p"), F.col("raw_content_hash").alias("_h"), F.col("pipeline_version").alias("_v"))
    d = docs.select(F.col("doc_id").cast("string").alias("pid"), content_hash(F.col("text")).alias("_now")).where("pid IS NOT NULL")
    j = d.join(l, F.col("pid") == F.col("_p"), "left")
    trigger = F.when(F.col("_p").isNull(), "new_document").when(F.col("_v") != version, "version").when(F.col("_h") != F.col("_now"), "content")
    j = j.withColumn("trigger", trigger).where("trigger IS NOT NULL").groupBy("pid").agg(F.max("trigger").alias("trigger"))
    return j.select("pid", "trigger", F.when(F.col("trigger") == "new_document", "high").otherwise("normal").alias("priority"), F.lit(at).alias("requested_at"), F.lit(0).cast("long").alias("pos"))


def drain_stream(requests: DataFrame, docs: Callable[[], DataFrame], ledger: DataFrame, out: str, checkpoint: str, version: int, after_write: Callable[[str, int], None] | None = None) -> StreamingQuery:
    """Requests (pid, trigger, priority, requested_at, pos) merged by key and drained, batch by batch.

    A batch's requests become one row a pid, of the highest priority (E10); the pid's text is hashed and compared with the ledger (C18): rows of out/rebuilt (and
    of out/ledger, with the new hash), out/unchanged, or out/dead_letter where docs() has no such document. docs: called each batch, so it may read a table that grows.
    after_write: called after each write with the table's name and the batch's number.
    """
    spark = requests.sparkSession

    def run(batch: DataFrame, number: int) -> None:
        q = queue_order(batch).select("pid", "trigger", "priority", "requested_at", "pos", "rank")
        known = latest_ledger(spark, ledger, out, number).select(F.col("pid").alias("_p"), F.col("raw_content_hash").alias("_h"), F.col("pipeline_version").alias("_v"))
        # hashes are joined, not texts
        now = docs().select(F.col("doc_id").cast("string").alias("_d"), content_hash(F.col("text")).alias("_now")).join(q.select(F.col("pid").alias("_d")), "_d", "left_semi")
        now = now.groupBy("_d").agg(F.min("_now").alias("_now"))
        j = q.join(now, F.col("pid") == F.col("_d"), "left").join(known, F.col("pid") == F.col("_p"), "left")
        change = F.when(F.col("_d").isNull(), "dead_letter").when(F.col("_p").isNull(), "missing").when(F.col("_v") != version, "version").when(F.col("_h") != F.col("_now"), "content").otherwise("unchanged")
        j = j.withColumn("change", change).persist()
        try:
            keep = ["pid", "trigger", "priority", "requested_at", "pos", "rank"]
            built = j.where("change NOT IN ('dead_letter', 'unchanged')")
            tables = {
                "rebuilt": built.select(*keep, "change"),
                "unchanged": j.where("change = 'unchanged'").select(*keep),
                "dead_letter": j.where("change = 'dead_letter'").select(*keep),
                "ledger": built.select("pid", F.col("_now").alias("raw_content_hash"), F.lit(version).alias("pipeline_version")),
            }
            for name, rows in tables.items():
                write_batch(rows, out, name, number)
                if after_write:
                    after_write(name, number)
        finally:
            j.unpersist()

    return _started(requests, run, checkpoint)


def trigger_stream(docs: DataFrame, ledger: DataFrame, out: str, checkpoint: str, version: int, at: str) -> StreamingQuery:
    """A stream of documents (doc_id, text): each batch's texts go to out/store, and what is new or changed to out/requests, a folder that drain_stream() can read as a stream.

    A document that an earlier batch has requested in the same content isn't requested again before it is drained: the ledger is what out/ledger and the base hold, and the store what is known.
    """
    spark = docs.sparkSession
    store = "doc_id string, raw_content_hash string"

    def run(batch: DataFrame, number: int) -> None:
        d = batch.select(F.col("doc_id").cast("string").alias("doc_id"), "text").persist()
        try:
            stored = written(spark, out, "store", store, number)
            asked = d.select("doc_id", content_hash(F.col("text")).alias("raw_content_hash")).join(stored.select("doc_id", "raw_content_hash"), ["doc_id", "raw_content_hash"], "left_anti").select("doc_id")
            fresh = new_requests(d.join(asked, "doc_id", "left_semi"), latest_ledger(spark, ledger, out), version, at)
            write_batch(d.select("doc_id", "text", content_hash(F.col("text")).alias("raw_content_hash")), out, "store", number)
            write_batch(fresh, out, "requests", number)
        finally:
            d.unpersist()

    return _started(docs, run, checkpoint)
