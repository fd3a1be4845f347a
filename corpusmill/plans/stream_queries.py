"""Queries over the written results of streams. The tables are replayed in slices, each after a restart from the checkpoint, as a feed would bring them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import content_hash
from ..operators.tables import new_path
from ..streaming import live
from .queries import query, table


def replay(rows: DataFrame, slices: list[str], start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Append the slices of rows to a folder, one after the other, and start the stream over it after each. start takes the stream and the checkpoint. Gives the folder that holds both."""
    base = new_path(rows.sparkSession, "stream")
    for part in slices:
        rows.where(part).write.mode("append").parquet(f"{base}/in")
        start(rows.sparkSession.readStream.schema(rows.schema).parquet(f"{base}/in"), f"{base}/checkpoint").awaitTermination()
    return base


def within(a: str, z: str) -> str:
    return f"ts >= TIMESTAMP_NTZ '{a}' AND ts < TIMESTAMP_NTZ '{z}'"


THIRDS = [within("2000-01-01", "2024-01-12"), within("2024-01-12", "2024-01-20"), within("2024-01-20", "2100-01-01")]


@query("""WITH e AS (SELECT user_id, date_trunc('milliseconds', ts) AS t FROM events), w AS (SELECT max(t) - INTERVAL 2 DAYS AS w FROM e), n AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS nx FROM e)
SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S.%g') AS last_seen FROM n, w WHERE (nx IS NULL OR nx > t + INTERVAL 26 HOURS) AND t + INTERVAL 26 HOURS <= w""")
def silence_log(spark, d):
    """What the timers have written by the end of the stream: each silence of more than 26 hours that the watermark has passed."""
    base = replay(table(spark, d, "events").select("user_id", "ts"), THIRDS, lambda stream, c: live.silence_stream(stream, "user_id", "ts", c.rpartition("/")[0] + "/out", c))
    return live.written(spark, f"{base}/out", "silences", "user_id long, last_seen timestamp").select("user_id", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss.SSS").alias("last_seen"))


MIXED_SQL = """e AS (SELECT event_id, CASE WHEN event_id % 50 > 0 THEN ts END AS ts, CASE WHEN ts < TIMESTAMP '2024-01-12' THEN 0 WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS batch FROM events),
g AS (SELECT batch, max(ts) AS g FROM e GROUP BY 1), b AS (SELECT batch, max(g) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAYS AS bound FROM g)"""


@query(f"""WITH {MIXED_SQL} SELECT event_id, e.batch, CASE WHEN coalesce(ts < bound, false) THEN 'late' ELSE 'on_time' END AS lane FROM e JOIN b ON e.batch = b.batch""")
def late_lanes(spark, d):
    """Both lanes of a stream whose third batch comes mostly too late; one row in 50 has no time."""
    e = table(spark, d, "events")
    e = e.select("event_id", F.when(F.col("event_id") % 50 > 0, F.col("ts")).alias("ts"), F.when(F.expr("ts < TIMESTAMP_NTZ '2024-01-12'"), 0).when(F.col("event_id") % 3 == 0, 1).otherwise(2).alias("slice"))
    base = replay(e, [f"slice = {k}" for k in range(3)], lambda stream, c: live.lanes_stream(stream, "event_id", "ts", c.rpartition("/")[0] + "/out", c))
    lane = lambda name: live.written(spark, f"{base}/out", name, "event_id long").select("event_id", "batch", F.lit(name).alias("lane"))
    return lane("on_time").unionByName(lane("late"))


FEED_SQL = "slices AS (SELECT * FROM (VALUES (0, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-12'), (1, TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-18'), (2, TIMESTAMP '2024-01-20', TIMESTAMP '2024-03-01')) v(batch, a, z))"


@query(f"""WITH {FEED_SQL}, f AS (SELECT batch, event_id FROM events JOIN slices ON ts >= a AND ts < z), h AS (SELECT event_id, min(batch) AS first FROM f GROUP BY 1),
n AS (SELECT s.batch, count(h.event_id) AS in_ledger FROM slices s LEFT JOIN h ON h.first < s.batch GROUP BY 1), o AS (SELECT f.batch, count(*) FILTER (h.first < f.batch) AS overlap FROM f JOIN h ON f.event_id = h.event_id GROUP BY 1)
SELECT n.batch, in_ledger, coalesce(overlap, 0) AS overlap, in_ledger > 0 AND coalesce(overlap, 0) = 0 AS overrun FROM n LEFT JOIN o ON n.batch = o.batch""")
def overrun_log(spark, d):
    """S3: three windows of a feed, the second of which overlaps the first by a day; the third leaves a gap."""
    e = table(spark, d, "events").select("event_id", "ts")
    parts = [within("2024-01-01", "2024-01-12"), within("2024-01-11", "2024-01-18"), within("2024-01-20", "2024-03-01")]
    base = replay(e, parts, lambda stream, c: live.lanes_stream(stream, "event_id", "ts", c.rpartition("/")[0] + "/out", c))
    return live.written(spark, f"{base}/out", "overlap", "in_ledger long, overlap long, overrun boolean").select("batch", "in_ledger", "overlap", "overrun")


DRAIN_SQL = """r AS (SELECT user_id, event_type, event_id, CASE WHEN ts < TIMESTAMP '2024-01-12' THEN 0 WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS batch, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS rank FROM events),
q AS (SELECT batch, user_id, min(event_id) AS pos, min(rank) AS rank, arg_min(event_type, (rank, event_id)) AS "trigger" FROM r GROUP BY batch, user_id),
s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch) AS k FROM q), d AS (SELECT doc_id FROM documents WHERE doc_id % 4 > 0)"""


@query(f"""WITH {DRAIN_SQL} SELECT batch, CAST(user_id AS VARCHAR) AS pid, pos, rank, "trigger", CASE WHEN doc_id IS NULL THEN 'dead_letter' WHEN k > 1 OR user_id % 3 = 0 AND user_id % 2 = 0 THEN 'unchanged' WHEN user_id % 3 = 0 THEN 'content' WHEN user_id % 3 = 1 THEN 'version' ELSE 'missing' END AS outcome
FROM s LEFT JOIN d ON user_id = doc_id""")
def drained_queue(spark, d):
    """Requests in three batches, one row a pid and batch; what a batch rebuilds is unchanged for the next ones. A third of the ledger has an old version, half of the rest an old text."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    key = F.col("doc_id")
    ledger = docs.where(key % 3 < 2).select(key.cast("string").alias("pid"), content_hash(F.when((key % 3 == 0) & (key % 2 == 1), "an old text").otherwise(F.col("text"))).alias("raw_content_hash"), F.when(key % 3 == 1, 1).otherwise(2).alias("pipeline_version"))
    p = F.when(F.col("event_type") == "error", "high").when(F.col("event_type") == "purchase", "normal").otherwise("low")
    r = table(spark, d, "events").select(F.col("user_id").cast("string").alias("pid"), F.col("event_type").alias("trigger"), p.alias("priority"), F.col("ts").cast("string").alias("requested_at"), F.col("event_id").alias("pos"), "ts")
    base = replay(r, THIRDS, lambda stream, c: live.drain_stream(stream, lambda: docs.where("doc_id % 4 > 0"), ledger, c.rpartition("/")[0] + "/out", c, 2))
    of = lambda name, outcome: live.written(spark, f"{base}/out", name, "pid string, pos long, rank int, `trigger` string, change string").select("batch", "pid", "pos", "rank", "trigger", outcome.alias("outcome"))
    return of("rebuilt", F.col("change")).unionByName(of("unchanged", F.lit("unchanged"))).unionByName(of("dead_letter", F.lit("dead_letter")))


@query("""WITH s AS (SELECT doc_id, doc_id % 3 AS batch, 0 AS changed FROM documents UNION ALL SELECT doc_id, 1, 0 FROM documents WHERE doc_id % 6 = 0 UNION ALL SELECT doc_id, 2, 1 FROM documents WHERE doc_id % 6 = 3)
SELECT batch, CAST(doc_id AS VARCHAR) AS pid, CASE WHEN doc_id % 5 > 1 THEN 'new_document' WHEN doc_id % 5 = 1 THEN 'version' ELSE 'content' END AS "trigger" FROM s
WHERE (batch = doc_id % 3 OR changed = 1) AND NOT (doc_id % 5 = 0 AND changed = 0)""")
def triggered_requests(spark, d):
    """Documents in three batches; the second sends some again as they were, the third some in another text. The ledger holds two fifths, half of them of an old version."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    key = F.col("doc_id")
    again = docs.where(key % 6 == 0).select("doc_id", "text", F.lit(1).alias("slice")).unionByName(docs.where(key % 6 == 3).select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("!")).alias("text"), F.lit(2).alias("slice")))
    rows = docs.withColumn("slice", (key % 3).cast("int")).unionByName(again)
    ledger = docs.where(key % 5 < 2).select(key.cast("string").alias("pid"), content_hash(F.col("text")).alias("raw_content_hash"), F.when(key % 5 == 1, 1).otherwise(2).alias("pipeline_version"))
    base = replay(rows, [f"slice = {k}" for k in range(3)], lambda stream, c: live.trigger_stream(stream, ledger, c.rpartition("/")[0] + "/out", c, 2, "2024-01-01"))
    return live.written(spark, f"{base}/out", "requests", "pid string, `trigger` string").select("batch", "pid", "trigger")
