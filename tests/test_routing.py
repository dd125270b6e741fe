"""Routing (J1 J5 P5) and throughput (A2)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logflow.operators import metrics, routing

T0 = dt.datetime(2024, 1, 1)


def test_route_as_of_brute_force(spark):
    rnd = random.Random(11)
    topics = ["a", "b", "c"]
    events, rev = [], 0
    for _ in range(40):
        rev += 1
        t = rnd.choice(topics)
        et = 1 if rnd.random() < 0.6 else 2
        events.append((rev, T0 + dt.timedelta(seconds=rnd.randrange(0, 1000)), t, et,
                       f"j{rev}" if et == 1 else None, "", ""))
    events.sort(key=lambda e: e[1])
    events = [(i + 1, *e[1:4], f"j{i + 1}" if e[3] == 1 else None, *e[5:]) for i, e in enumerate(events)]
    recs = [(rnd.choice(topics + ["z"]), 0, i, T0 + dt.timedelta(seconds=rnd.randrange(0, 1100)), b"v")
            for i in range(300)]
    ev = spark.createDataFrame(events, "revision long, ts timestamp_ntz, topic string, event_type int, "
                                       "job_name string, index_type string, pipeline string")
    rd = spark.createDataFrame(recs, "topic string, partition int, offset long, ts timestamp_ntz, value binary")
    got = {r.offset: r.job_name for r in routing.route_as_of(rd, ev, width=60_000_000).collect()}

    def brute(topic, ts):
        evs = [e for e in events if e[2] == topic]
        before = [e for e in evs if e[1] <= ts]
        if before and before[-1][3] == 1:
            return before[-1][4]
        after = [e for e in evs if e[1] > ts and e[3] == 1]
        return after[0][4] if after else None

    want = {o: brute(t, ts) for t, _, o, ts, _ in recs}
    want = {o: j for o, j in want.items() if j is not None}
    assert got == want


def test_route_leaves_the_join_to_measured_sizes(spark):
    rd = spark.createDataFrame([("a", 0, 0, T0, b"x")], "topic string, partition int, offset long, "
                                                          "ts timestamp_ntz, value binary")
    jb = spark.createDataFrame([("a", "j", "", "")], "topic string, job_name string, index_type string, "
                                                     "pipeline string")
    out = routing.route(rd, jb)
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    assert out.count() == 1


def test_changes_at_one_instant_take_effect_by_revision(spark):
    rd = spark.createDataFrame([("a", 0, 0, T0, b"x")], "topic string, partition int, offset long, "
                                                          "ts timestamp_ntz, value binary")
    ev = spark.createDataFrame([("a", r, T0, 1, f"j{r}", "", "") for r in (2, 3, 1)],
                               "topic string, revision long, ts timestamp_ntz, event_type int, job_name string, "
                               "index_type string, pipeline string")
    assert [r.version for r in routing.route_as_of(rd, ev).collect()] == [3]


def test_transform_that_drops_a_column_is_refused(spark):
    df = spark.createDataFrame([("p", "x")], "pipeline string, doc string")
    with pytest.raises(ValueError, match="drops"):
        routing.apply_transforms(df, {"p": lambda d: d.drop("doc")})


def test_apply_transforms(spark):
    df = spark.createDataFrame([("p", "x"), ("q", "y"), ("", "z"), (None, "w"), ("r", "v")],
                               "pipeline string, doc string")
    reg = {"p": lambda d: d.withColumn("doc", F.upper("doc")), "q": lambda d: d.filter("false")}
    got = sorted((r.pipeline or "", r.doc) for r in routing.apply_transforms(df, reg).collect())
    assert got == [("", "w"), ("", "z"), ("p", "X"), ("r", "v")]


def test_row_transforms_read_the_input_once(spark, tmp_path):
    rows = [("p", "x", 1), ("p", "x2", None), ("q", "y", 1), ("s", "t", 2), ("", "z", 1), (None, "w", 1), ("r", "v", 1)]
    spark.createDataFrame(rows, "pipeline string, doc string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    reg = {"p": routing.RowTransform({"doc": F.upper("doc"), "tag": F.col("doc")}, F.col("n") == 1),
           "q": routing.RowTransform({"pipeline": F.lit("p"), "doc": F.concat("doc", "pipeline")}),
           "": routing.RowTransform({"doc": F.lit("never")})}
    out = routing.apply_transforms(df, reg)
    got = sorted((r.pipeline or "", r.doc, r.tag) for r in out.collect())
    assert got == [("", "w", None), ("", "z", None), ("p", "X", "x"), ("p", "yq", None), ("r", "v", None), ("s", "t", None)]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    mixed = routing.apply_transforms(df, reg | {"s": lambda d: d.union(d)})
    assert mixed.count() == 7


def test_throughput_dense_ticks(spark):
    rows = [(T0 + dt.timedelta(seconds=s),) for s in (0, 1, 25, 26, 27, 49)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = metrics.throughput(df, "10 seconds").orderBy("tick").collect()
    assert [(r.rows, r.rows_total) for r in out] == [(2, 2), (0, 2), (3, 5), (0, 5), (1, 6)]
    jobs_series = spark.createDataFrame([(T0 + dt.timedelta(seconds=5), 1), (T0 + dt.timedelta(seconds=20), 2),
                                         (T0 + dt.timedelta(seconds=40), 0)], "ts timestamp_ntz, active_jobs long")
    out = metrics.throughput(df, "10 seconds", jobs=jobs_series).orderBy("tick").collect()
    assert [r.jobs for r in out] == [1, 2, 2, 0, 0]


def test_throughput_last_total_is_row_count(spark):
    rnd = random.Random(2)
    rows = [(T0 + dt.timedelta(seconds=rnd.randrange(0, 100000)),) for _ in range(2000)]
    out = metrics.throughput(spark.createDataFrame(rows, "ts timestamp_ntz"), "7 seconds")
    last = out.orderBy(F.col("tick").desc()).first()
    assert last.rows_total == 2000
    assert out.count() == out.select("tick").distinct().count()
