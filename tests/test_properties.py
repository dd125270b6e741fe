"""Property tests: flush batches, running totals, and
snapshot + tail against the full fold, on generated inputs."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logflow.functions.keys import JOBS_PREFIX as P
from logflow.operators import batching, jobs, metrics

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

records = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)), min_size=1, max_size=120)


@SETTINGS
@given(rows=records, cap=st.integers(1, 9))
def test_flush_batches(spark, rows, cap):
    offs, data = {}, []
    for p, sec in sorted(rows, key=lambda r: r[1]):
        o = offs.get(p, 0)
        offs[p] = o + 1
        data.append(("t", p, o, T0 + dt.timedelta(seconds=sec), b"x"))
    df = spark.createDataFrame(data, "topic string, partition int, offset long, ts timestamp_ntz, value binary")
    b = batching.assign_batches(df, max_rows=cap, max_wait="4 seconds", width=3).collect()
    assert sorted((r.partition, r.offset) for r in b) == sorted((r[1], r[2]) for r in data)
    groups = {}
    for r in b:
        groups.setdefault((r.partition, r.tick, r.batch_seq), []).append(r)
    assert all(len(g) <= cap for g in groups.values())
    # a batch never spans ticks, and cuts follow offset order
    for (p, tick, seq), g in groups.items():
        assert all(int(r.ts.timestamp() - T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 4 ==
                   int((g[0].ts - T0).total_seconds()) // 4 for r in g)
    by_tick = {}
    for (p, tick, seq), g in groups.items():
        by_tick.setdefault((p, tick), []).append((seq, min(r.offset for r in g), max(r.offset for r in g)))
    for segs in by_tick.values():
        segs.sort()
        assert all(a[2] < b[1] for a, b in zip(segs, segs[1:]))


@SETTINGS
@given(secs=st.lists(st.integers(0, 5000), min_size=1, max_size=200), every=st.sampled_from([1, 7, 60]))
def test_running_total(spark, secs, every):
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s),) for s in secs], "ts timestamp_ntz")
    out = metrics.throughput(df, every).orderBy("tick").collect()
    assert out[-1].rows_total == len(secs) == sum(r.rows for r in out)
    epoch = [1_704_067_200 + s for s in secs]  # ticks are aligned to the epoch
    assert len(out) == max(epoch) // every - min(epoch) // every + 1


ops = st.lists(st.tuples(st.sampled_from(["PUT", "PUT", "DELETE", "BAD"]), st.integers(0, 5), st.integers(0, 5)),
               min_size=1, max_size=40)


@SETTINGS
@given(log=ops, cut=st.integers(0, 45))
def test_snapshot_then_tail_is_the_full_fold(spark, log, cut):
    rows = []
    for i, (op, k, t) in enumerate(log):
        value = None if op == "DELETE" else ("{bad" if op == "BAD" else json.dumps(
            {"job_name": f"j{i}", "topic": f"t{t}", "index_type": "", "pipeline": ""}))
        rows.append((i + 1, "DELETE" if op == "DELETE" else "PUT", f"{P}t{k}", value,
                     T0 + dt.timedelta(seconds=i)))
    ch = spark.createDataFrame(rows, "revision long, op string, key string, value string, ts timestamp_ntz")
    # the fold of snapshot + tail is what a watcher started at the cut holds:
    # the listing at the cut, then the tail, where an undecodable PUT is
    # skipped (it produces no event) and so leaves the old job in place
    folded = _fold_by_key(jobs.snapshot_then_tail(ch, cut))
    assert folded == _watcher(log, cut)
    # with no undecodable PUT after the cut that is the registry state (A4)
    if all(op != "BAD" for op, _, _ in log[cut:]):
        assert folded == _state(ch)
    # the running-topic count after the last event equals the running topics
    running = jobs.running_topics(jobs.to_job_events(ch)).count()
    counts = jobs.active_job_count(jobs.to_job_events(ch), width=4).orderBy("revision").collect()
    assert (counts[-1].active_jobs if counts else 0) == running


def _watcher(log, cut):
    last = {}
    for i, (op, k, t) in enumerate(log[:cut]):
        last[k] = (op, i, t)
    held = {k: (f"j{i}", f"t{t}") for k, (op, i, t) in last.items() if op == "PUT"}
    for i, (op, k, t) in enumerate(log):
        if i < cut:
            continue
        if op == "PUT":
            held[k] = (f"j{i}", f"t{t}")
        elif op == "DELETE":
            held.pop(k, None)
    return {(f"{P}t{k}", j, topic) for k, (j, topic) in held.items()}


def _state(ch):
    return {(r.key, r.job_name, r.topic) for r in jobs.job_state(ch).collect()}


def _fold_by_key(events):
    last = events.groupBy("key").agg(F.max_by(F.struct("event_type", "job_name", "topic"),
                                              F.struct("phase", "revision")).alias("l"))
    return {(r.key, r.l.job_name, r.l.topic) for r in last.collect() if r.l.event_type == 1}
