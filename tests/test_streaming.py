"""Streams against their batch forms; restart on the same checkpoint."""

import datetime as dt
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logflow import schemas
from logflow.functions.keys import JOBS_PREFIX
from logflow.operators import jobs
from logflow.sinks import writers
from logflow.sources import derived as D
from logflow.sources import readers
from logflow.streaming.collect import collect, collected_jobs, waiting_records
from logflow.streaming.live import liveness_stream
from logflow.streaming.registry import current_jobs, current_running, fold_changes, fold_running, topic_events
from logflow.streaming.state import operator_state

from conftest import SF


def _tmp():
    return tempfile.mkdtemp(prefix="logflow-test-")


def _events_of(spark, changes):
    """A stream of the job events of a change feed."""
    feed = _tmp() + "/feed"
    changes.write.parquet(feed)
    return topic_events(readers.read_job_changes(spark, feed))


def test_collect_stream_equals_batch_and_restarts(spark):
    src, out, ck = _tmp() + "/src", _tmp() + "/out", _tmp() + "/ck"
    recs = D.records(spark, SF)
    current = jobs.running_topics(jobs.to_job_events(D.changes(spark, SF)))
    events = _events_of(spark, D.changes(spark, SF))
    recs.repartition(2, "topic").write.parquet(src)
    stream = readers.read_topics(spark, path=src, max_files_per_trigger=1)
    sink = writers.index_writer(out)
    collect(stream, events, sink, ck, trigger={"availableNow": True}, index_time="record").awaitTermination()
    # more data arrives; the restarted query reads only the new files
    more = recs.filter(F.col("offset") < 3)
    more.withColumn("offset", F.col("offset") + 1_000_000).write.mode("append").parquet(src)
    stream = readers.read_topics(spark, path=src, max_files_per_trigger=1)
    collect(stream, events, sink, ck, trigger={"availableNow": True}, index_time="record").awaitTermination()
    back = writers.read_index(spark, out, "topic string, partition int, offset long")
    n_routed = recs.join(current.select("topic"), "topic").count()
    extra = more.join(current.select("topic"), "topic").count()
    assert back.count() == n_routed + extra
    assert back.select("topic", "partition", "offset").distinct().count() == back.count()


def test_replayed_batch_overwrites(spark):
    out = _tmp() + "/out"
    df = spark.createDataFrame([("i1", "p", '{"a":1}'), ("i1", "p", "not json")], "index string, pipeline string, "
                                                                                "doc string")
    sink = writers.index_writer(out)
    sink(df, 3)
    sink(df, 3)
    assert writers.read_index(spark, out, "doc string").count() == 1
    assert [r.doc for r in writers.read_index(spark, out, "doc string", status="rejected").collect()] == ["not json"]
    v = writers.read_index(spark, out, "doc string", as_variant=True)
    assert [r.a for r in v.select(F.variant_get("doc_json", "$.a", "int").alias("a")).collect()] == [1]


def test_fold_changes_equals_job_state(spark):
    src, ck = _tmp() + "/src", _tmp() + "/ck"
    ch = D.changes(spark, SF)
    ch.repartitionByRange(3, "revision").write.parquet(src)

    def fold(checkpoint):
        fold_changes(readers.read_job_changes(spark, src, max_files_per_trigger=1), checkpoint,
                     trigger={"availableNow": True}).awaitTermination()
        return {tuple(r) for r in current_jobs(spark, checkpoint).collect()}

    assert fold(ck) == {tuple(r) for r in jobs.job_state(ch).collect()}
    # the same checkpoint goes on; a new one reads the feed from its start
    more = ch.agg(F.max("revision").alias("revision")).select(
        F.col("revision") + 1, F.lit("PUT"), F.lit(JOBS_PREFIX + "late"), F.lit('{"topic":"late"}'),
        F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")).toDF(*ch.columns)
    more.write.mode("append").parquet(src)
    want = {tuple(r) for r in jobs.job_state(ch.unionByName(more)).collect()}
    assert fold(ck) == want and fold(_tmp() + "/ck") == want


def test_fold_running_equals_running_topics(spark):
    src, ck = _tmp() + "/src", _tmp() + "/ck"
    ch = D.changes(spark, SF)
    ch.repartitionByRange(3, "revision").write.parquet(src)
    fold_running(readers.read_job_changes(spark, src, max_files_per_trigger=2), ck,
                 trigger={"availableNow": True}).awaitTermination()
    want = jobs.running_topics(jobs.to_job_events(ch))
    got = current_running(spark, ck).select(*want.columns)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_tables_before_the_first_micro_batch_are_empty(spark):
    src, ck = _tmp() + "/src", _tmp() + "/ck"
    D.changes(spark, SF).limit(0).write.parquet(src)
    fold_running(readers.read_job_changes(spark, src), ck, trigger={"availableNow": True}).awaitTermination()
    assert current_running(spark, ck).count() == 0
    assert current_jobs(spark, _tmp()).count() == 0 and collected_jobs(spark, _tmp()).count() == 0
    assert waiting_records(spark, _tmp()).count() == 0


RECORD = "topic string, partition int, offset long, ts timestamp_ntz, value binary"
CHANGE = "revision long, op string, key string, value string, ts timestamp_ntz"


class Feed:
    """A collector over two folders, to which records and changes are added."""

    def __init__(self, spark, sink=None, **options):
        self.spark, self.options, self.revision = spark, options, 0
        self.src, self.feed, self.out, self.ck = (_tmp() + "/" + x for x in ("src", "feed", "out", "ck"))
        self.sink = sink or writers.index_writer(self.out)
        self.records([])
        self.changes([])

    def records(self, rows):
        rows = [(t, 0, o, None if t == "z" else dt.datetime(2024, 1, 1), b"{}") for t, o in rows]
        self.spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(self.src)

    def changes(self, ops):
        rows = []
        for op, topic in ops:
            self.revision += 1
            value = f'{{"topic":"{topic}","pipeline":"p{self.revision}"}}' if op == "PUT" else None
            rows.append((self.revision, op, JOBS_PREFIX + topic, value, dt.datetime(2024, 1, 1)))
        self.spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(self.feed)

    def run(self):
        collect(readers.read_topics(self.spark, path=self.src),
                topic_events(readers.read_job_changes(self.spark, self.feed)), self.sink, self.ck,
                trigger={"availableNow": True}, index_time="record", **self.options).awaitTermination()
        got = writers.read_index(self.spark, self.out, "topic string, offset long, pipeline string")
        return sorted((r.topic, r.offset, r.pipeline) for r in got.collect())

    def waiting(self):
        return sorted((r.topic or "", r.offset) for r in waiting_records(self.spark, self.ck).collect())


def test_records_wait_until_their_topic_has_a_job(spark):
    f = Feed(spark, shards=3)
    f.changes([("PUT", "a")])
    f.records([("a", 0), ("b", 0), ("b", 1), ("c", 0), (None, 7), ("z", 5)])
    seen = [("a", 0, "p1")]
    assert f.run() == seen
    assert f.waiting() == [("", 7), ("b", 0), ("b", 1), ("c", 0), ("z", 5)]
    f.records([("a", 1), ("b", 2)])
    seen = sorted([*seen, ("a", 1, "p1")])
    assert f.run() == seen
    f.changes([("PUT", "b")])  # the job appears; only the change feed has something new
    seen = sorted([*seen, ("b", 0, "p2"), ("b", 1, "p2"), ("b", 2, "p2")])
    assert f.run() == seen and f.waiting() == [("", 7), ("c", 0), ("z", 5)]
    f.changes([("DELETE", "b"), ("DELETE", "a"), ("PUT", "c")])  # stopped topics wait again, and the others come once
    f.records([("b", 3), ("a", 2)])
    seen = sorted([*seen, ("c", 0, "p5")])
    assert f.run() == seen
    assert {r.topic for r in collected_jobs(spark, f.ck).collect()} == {"c"}
    f.changes([("PUT", "a"), ("PUT", "b"), ("PUT", "a"), ("PUT", "z")])  # the newest of a micro-batch counts
    f.records([("c", 1)])
    seen = sorted([*seen, ("a", 2, "p8"), ("b", 3, "p7"), ("c", 1, "p5"), ("z", 5, "p9")])
    assert f.run() == seen and f.waiting() == [("", 7)]
    assert f.run() == seen  # nothing new


def test_older_events_do_not_bring_a_job_back(spark):
    f = Feed(spark, shards=2)
    f.changes([("PUT", "a"), ("DELETE", "a")])
    f.run()
    f.revision = 0  # an old change comes late
    f.changes([("PUT", "a")])
    f.records([("a", 0)])
    assert f.run() == [] and f.waiting() == [("a", 0)]


def test_a_failed_sink_delivers_waiting_records_once(spark):
    """A micro-batch whose sink fails commits no state: its replay finds the
    waiting records again, and delivers them once."""
    f = Feed(spark, shards=2)
    f.records([("b", 0), ("b", 1)])
    f.run()
    good, tries = f.sink, []

    def flaky(batch, batch_id):
        tries.append(batch.count())
        raise RuntimeError("the index is down")
    f.sink = flaky
    f.changes([("PUT", "b")])
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            f.run()
    assert tries == [2, 2] and f.waiting() == [("b", 0), ("b", 1)]
    f.sink = good
    assert f.run() == [("b", 0, "p1"), ("b", 1, "p1")] and f.waiting() == []


def test_a_hot_topic_is_dealt_over_shards(spark):
    from logflow.streaming.collect import _one_stream
    rows = [("hot", k % 3, k, dt.datetime(2024, 1, 1), b"{}") for k in range(3000)]
    events = spark.createDataFrame([("hot", 1, dt.datetime(2024, 1, 1), "k", 1, "j", "", "")], schemas.TOPIC_EVENTS)
    got = _one_stream(spark.createDataFrame(rows, RECORD), events, 8)
    per = got.groupBy("shard").agg(F.count_if(~F.col("is_event")).alias("n"), F.count_if("is_event").alias("e")).collect()
    assert len(per) == 8 and max(r.n for r in per) < 3000 / 8 * 1.5 and {r.e for r in per} == {1}


def test_flush_cut_goes_on_over_micro_batches(spark):
    from logflow.operators import batching
    from logflow.streaming.flush import assign_batches_stream
    src, out, ck = _tmp() + "/src", _tmp() + "/out", _tmp() + "/ck"
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t, p, k, t0 + dt.timedelta(milliseconds=7 * k), b"v") for t in "ab" for p in (0, 1) for k in range(900)]
    recs = spark.createDataFrame(rows, RECORD)
    for lo, hi in ((0, 50), (50, 51), (51, 333), (333, 900)):  # cuts inside of ticks
        recs.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = assign_batches_stream(readers.read_topics(spark, path=src, max_files_per_trigger=1), 40, "1 second")
    with operator_state(spark):
        q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["topic", "partition", "offset", "tick", "batch_seq"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in batching.assign_batches(recs, 40, "1 second").select(*cols).collect())
    assert got == want and {r[4] for r in want} == {0, 1, 2, 3}


def test_flush_counter_forgets_old_ticks_only():
    import pandas as pd
    from logflow.streaming.flush import TickCounter

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v
    c = TickCounter(10, 5)
    c.seen = Value()

    def feed(*ticks):
        pdf = pd.DataFrame({"tick": ticks, "offset": range(len(ticks)), "slot": 0})
        return pd.concat(c.handleInputRows(None, iter([pdf]), None))["batch_seq"].tolist()
    assert feed(*[1] * 8) == [0] * 8
    assert feed(*[1] * 4, 6) == [0, 0, 1, 1, 0]
    assert sorted(c.seen.held[0]) == [1, 6]
    assert feed(7) == [0] and sorted(c.seen.held[0]) == [6, 7]


def test_text_bodies_stream_with_stable_ids(spark):
    src = _tmp() + "/src"
    bodies = ['{"topic":"a","logs":["x"]}', "nope", "nope", ""]
    spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.text(src)
    runs = []
    for k in range(2):
        q = (readers.read_requests(spark, src, streaming=True).writeStream.format("memory").queryName(f"bodies_{k}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        runs.append(sorted((r.body, r.req_id) for r in spark.table(f"bodies_{k}").collect()))
    assert runs[0] == runs[1] and [b for b, _ in runs[0]] == sorted(bodies)
    assert runs[0] == sorted((r.body, r.req_id) for r in readers.read_requests(spark, src).collect())


def test_liveness_stream_closed_sessions_match_batch(spark):
    from logflow.operators import claims
    src = _tmp() + "/hb"
    hb = D.heartbeats(spark, SF)
    hb.write.parquet(src)
    s = liveness_stream(readers.read_heartbeats(spark, src), lease="30 minutes")
    q = s.writeStream.format("memory").queryName("live_sessions").outputMode("append").trigger(
        availableNow=True).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.table("live_sessions").collect()}
    batch = {tuple(r) for r in claims.liveness(hb, "30 minutes").collect()}
    assert got and got <= batch
    # every batch session that ended before the last heartbeat is emitted
    last = hb.agg(F.max("ts")).first()[0]
    closed = {b for b in batch if b[4] < last - dt.timedelta(minutes=30)}
    assert closed <= got


def test_ingest_stream_writes_topics_and_rejections(spark):
    from logflow.streaming.ingest import ingest_stream
    src, topics, rejected, ck = _tmp() + "/src", _tmp() + "/t", _tmp() + "/r", _tmp() + "/ck"
    bodies = [(1, '{"topic":"a","logs":["x","y"]}'), (2, '{"topic":"b","logs":["z"]}'), (3, '{"topic":"a"}'),
              (4, 'nope')]
    spark.createDataFrame([(i, None, b) for i, b in bodies], "req_id long, received_at timestamp_ntz, body string") \
        .repartition(2).write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        ingest_stream(readers.read_requests(spark, src, streaming=True, fmt="parquet", max_files_per_trigger=1),
                      topics, rejected, ck, trigger={"availableNow": True}).awaitTermination()
    t = spark.read.parquet(topics)
    assert sorted((r.topic, r.value.decode()) for r in t.collect()) == [("a", "x"), ("a", "y"), ("b", "z")]
    assert sorted((r.req_id, r.code) for r in spark.read.parquet(rejected).collect()) == [(3, -2), (4, -1)]


def test_collect_reports_written_and_rejected_counts(spark):
    from logflow.operators import metrics
    src, out, ck, met = _tmp() + "/src", _tmp() + "/out", _tmp() + "/ck", _tmp() + "/m"
    recs = D.records(spark, SF)
    current = jobs.running_topics(jobs.to_job_events(D.changes(spark, SF)))
    recs.repartition(2, "topic").write.parquet(src)
    collect(readers.read_topics(spark, path=src, max_files_per_trigger=1), _events_of(spark, D.changes(spark, SF)),
            writers.index_writer(out, metrics_path=met), ck, trigger={"availableNow": True},
            index_time="record").awaitTermination()
    m = spark.read.parquet(met)
    tot = m.agg(F.sum("indexed").alias("i"), F.sum("rejected").alias("r"), F.count("*").alias("n")).first()
    assert tot.i == recs.join(current.select("topic"), "topic").count() and tot.r == 0 and tot.n >= 2
    report = metrics.throughput(m, "10 seconds", ts="processed_at", rows="indexed")
    assert report.orderBy(F.col("tick").desc()).first().rows_total == tot.i


def test_tick_stream_then_batch_total_equals_batch_report(spark):
    from logflow.operators import metrics
    from logflow.streaming.live import tick_counts_stream
    src, out, ck = _tmp() + "/src", _tmp() + "/ticks", _tmp() + "/ck"
    recs = D.records(spark, SF)
    # records arrive in time order: three files, each a later time range
    cuts = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2024, 3, 1)]
    for lo, hi in zip(cuts, cuts[1:]):
        recs.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(src)
    (tick_counts_stream(readers.read_topics(spark, path=src, max_files_per_trigger=1), every="1 hour")
     .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    ticks = spark.read.parquet(out)
    streamed = {(r.tick, r.rows, r.rows_total) for r in metrics.throughput(ticks, "1 hour", rows="rows").collect()}
    batch = {(r.tick, r.rows, r.rows_total) for r in metrics.throughput(recs, "1 hour").collect()}
    # the stream holds back the last (open) tick; everything before it agrees
    assert streamed and streamed <= batch and len(batch - streamed) == 1


def test_live_report_equals_batch_report(spark):
    """Chained stateful operators: empty ticks, running total and jobs."""
    from logflow.operators import metrics
    from logflow.streaming.live import throughput_stream
    src, feed, out, ck = _tmp() + "/src", _tmp() + "/feed", _tmp() + "/out", _tmp() + "/ck"
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    recs = [("a", 0, k, at(s), b"v") for k, s in enumerate([0, 1, 2, 35, 36, 36, 71, 200])]
    evs = [(1, "PUT", "a", 5), (2, "PUT", "b", 20), (3, "PUT", "a", 21), (4, "DELETE", "a", 40), (5, "DELETE", "x", 41),
           (6, "PUT", "c", 70), (7, "DELETE", "c", 210)]
    changes = [(r, op, JOBS_PREFIX + t, f'{{"topic":"{t}"}}' if op == "PUT" else None, at(s)) for r, op, t, s in evs]
    for lo, hi in ((0, 35), (35, 72), (72, 300)):
        spark.createDataFrame([r for r in recs if at(lo) <= r[3] < at(hi)], RECORD).coalesce(1).write.mode("append").parquet(src)
        spark.createDataFrame([c for c in changes if at(lo) <= c[4] < at(hi)], CHANGE).coalesce(1).write.mode(
            "append").parquet(feed)
    report = throughput_stream(readers.read_topics(spark, path=src, max_files_per_trigger=1), topic_events(
        readers.read_job_changes(spark, feed, max_files_per_trigger=1)), "10 seconds")
    with operator_state(spark):
        q = (report.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    closed = spark.createDataFrame([r for r in recs if r[3] < at(100)], RECORD)
    events = jobs.to_job_events(spark.createDataFrame(changes, CHANGE))
    want = metrics.throughput(closed, "10 seconds", jobs=jobs.active_job_count(events))
    assert got == sorted(tuple(r) for r in want.collect())
    assert [r[3] for r in got] == [1, 2, 2, 1, 1, 1, 2, 2]
