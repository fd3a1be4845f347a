"""Streams with state: any order of files, restarts, and runs that die between two writes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.incremental import content_hash
from corpusmill.streaming import live

START = datetime.datetime(2024, 1, 1)


def beats(spark, rows):
    return spark.createDataFrame([(s, None if h is None else START + datetime.timedelta(hours=h)) for s, h in rows], "source string, ts timestamp")


def test_silence_survives_restarts_and_disorder(spark, tmp_path):
    """Beats out of order inside the watermark, an unknown source and time, a beat that joins two sessions; the second start goes on with the timers of the first."""
    first = [("a", 0), ("a", 20), ("b", 1), ("c", 5), (None, 3), ("a", None), ("c", 44)]
    second = [("a", 45.5), ("c", 30), ("b", 70), ("d", 60), ("d", 60)]  # c: 30 joins 5 and 44; a: 45.5 follows 20 within 26 hours
    third = [("e", 200)]
    for part in (first, second, third):
        beats(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("source string, ts timestamp").parquet(str(tmp_path / "in"))
        live.silence_stream(stream, "source", "ts", str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = sorted((r.source, r.last_seen) for r in live.written(spark, str(tmp_path / "out"), "silences", "source string, last_seen timestamp").collect())
    at = lambda h: START + datetime.timedelta(hours=h)
    assert got == [("a", at(45.5)), ("b", at(1)), ("b", at(70)), ("c", at(44)), ("d", at(60))]
    want = live.silences_until(beats(spark, first + second + third), "source", "ts", str(at(200 - 48)))
    assert sorted((r.source, r.last_seen) for r in want.collect()) == got


def test_a_restart_alone_changes_nothing(spark, tmp_path):
    beats(spark, [("a", 0), ("b", 100)]).coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        live.silence_stream(spark.readStream.schema("source string, ts timestamp").parquet(str(tmp_path / "in")), "source", "ts", str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert live.written(spark, str(tmp_path / "out"), "silences", "source string, last_seen timestamp").count() == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_lanes_together_are_the_input(spark, tmp_path, seed):
    r = random.Random(seed)
    files = [[(f"{k}-{j}", r.choice([None, r.randrange(0, 300)])) for j in range(20)] for k in range(3)]
    r.shuffle(files)
    late = set()
    for part in files:
        beats(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live.lanes_stream(spark.readStream.schema("source string, ts timestamp").parquet(str(tmp_path / "in")), "source", "ts", str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    bound = None
    for part in files:
        late |= {s for s, h in part if h is not None and bound is not None and h < bound}
        bound = max([h - 48 for _, h in part if h is not None] + ([bound] if bound is not None else []))
    read = lambda name: [x.source for x in live.written(spark, str(tmp_path / "out"), name, "source string").collect()]
    assert sorted(read("on_time") + read("late")) == sorted(s for part in files for s, _ in part)
    assert set(read("late")) == late


def test_overrun_of_a_gap(spark, tmp_path):
    for part in ([("a", 1), ("b", 2)], [("b", 2), ("c", 3)], [("x", 9), ("y", 9)]):
        beats(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live.lanes_stream(spark.readStream.schema("source string, ts timestamp").parquet(str(tmp_path / "in")), "source", "ts", str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = live.written(spark, str(tmp_path / "out"), "overlap", "in_ledger long, overlap long, overrun boolean").collect()
    assert sorted((x.batch, x.in_ledger, x.overlap, x.overrun) for x in got) == [(0, 0, 0, False), (1, 2, 1, False), (2, 3, 0, True)]


@pytest.mark.parametrize("dies_after", ["rebuilt", "dead_letter", "ledger"])
def test_a_drain_that_dies_between_two_writes(spark, tmp_path, dies_after):
    docs = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "three"), ("4", None)], "doc_id string, text string")
    ledger = docs.where("doc_id = '2'").select(F.col("doc_id").alias("pid"), content_hash(F.col("text")).alias("raw_content_hash"), F.lit(2).alias("pipeline_version"))
    asks = [[("1", "t", "low", "x", 1), ("2", "t", "high", "x", 2), ("1", "u", "high", "y", 3), ("9", "t", "low", "x", 4)], [("1", "t", "low", "x", 5), ("3", "t", "odd", "x", 6), ("4", "t", "normal", "x", 7)]]

    def go(name, fail):
        for part in asks:
            spark.createDataFrame(part, live.REQUESTS).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            for attempt in (0, 1):
                def after(table, number, attempt=attempt):
                    if fail and not attempt and table == dies_after:
                        raise RuntimeError("the machine is gone")

                stream = spark.readStream.schema(live.REQUESTS).parquet(str(tmp_path / name / "in"))
                q = live.drain_stream(stream, lambda: docs, ledger, str(tmp_path / name / "out"), str(tmp_path / name / "c"), 2, after)
                if fail and not attempt:
                    with pytest.raises(Exception, match="the machine is gone"):
                        q.awaitTermination()
                else:
                    q.awaitTermination()
        read = lambda t, s: sorted(map(tuple, live.written(spark, str(tmp_path / name / "out"), t, s).collect()))
        return {t: read(t, s) for t, s in (("rebuilt", "pid string, pos long, rank int, change string, `trigger` string"), ("unchanged", "pid string, pos long"), ("dead_letter", "pid string"), ("ledger", live.LEDGER))}

    got = go("fails", True)
    assert got == go("runs", False)
    assert got["rebuilt"] == [("1", 1, 0, "missing", "u", 0), ("3", 6, 99, "missing", "t", 1), ("4", 7, 1, "missing", "t", 1)]
    assert got["unchanged"] == [("1", 5, 1), ("2", 2, 0)] and got["dead_letter"] == [("9", 0)]


def test_trigger_feeds_the_drain(spark, tmp_path):
    """New documents become requests, the drain rebuilds them, and the next trigger asks for what has changed alone."""
    empty = spark.createDataFrame([], live.LEDGER)
    out, docs = str(tmp_path / "out"), "doc_id string, text string"
    known = [("1", "one"), ("2", "two")]
    asked = []
    for part in (known, [("1", "one"), ("2", "two!"), ("3", "three")]):
        spark.createDataFrame(part, docs).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
        live.trigger_stream(spark.readStream.schema(docs).parquet(str(tmp_path / "docs")), empty, out, str(tmp_path / "c1"), 1, "2024").awaitTermination()
        now = spark.createDataFrame(part, docs)
        requests = spark.readStream.schema(live.REQUESTS).parquet(out + "/requests")
        live.drain_stream(requests, lambda now=now: now, empty, out, str(tmp_path / "c2"), 1).awaitTermination()
        asked.append(sorted((x.pid, x.trigger) for x in live.written(spark, out, "requests", "pid string, `trigger` string").collect()))
    assert asked[0] == [("1", "new_document"), ("2", "new_document")]
    assert asked[1] == sorted([*asked[0], ("2", "content"), ("3", "new_document")])
    assert sorted((x.pid, x.change) for x in live.written(spark, out, "rebuilt", "pid string, change string").collect()) == [("1", "missing"), ("2", "content"), ("2", "missing"), ("3", "missing")]
