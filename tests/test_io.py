"""Sources and sinks: text bodies, change round trip, option builders,
fan-out, per-tick stream, and results independent of the session zone."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF
from logflow.operators import ingest, jobs
from logflow.sinks import writers
from logflow.sources import readers
from logflow.streaming.live import tick_counts_stream


def _tmp():
    return tempfile.mkdtemp(prefix="logflow-io-")


def test_read_requests_text(spark):
    d = _tmp()
    with open(d + "/bodies.txt", "w") as f:
        f.write('{"topic":"a","logs":["x","y"]}\n{"topic":"a","logs":[1]}\nnot json\n')
    df = ingest.validate_requests(readers.read_requests(spark, d))
    assert sorted(r.code for r in df.collect()) == [-2, -1, 0]
    assert df.select("req_id").distinct().count() == 3


def test_put_and_delete_bodies_fold_into_state(spark):
    puts = spark.createDataFrame([(1, '{"key":"a","job_name":"j1","topic":"a","index_type":"yyyy"}'),
                                  (2, '{"key":"b","job_name":"j2","topic":"b"}'),
                                  (4, '{"key":"c","job_name":"j3"}')], "revision long, body string")
    dels = spark.createDataFrame([(3, '{"keys":["b","zz"]}')], "revision long, body string")
    ch = ingest.puts_to_changes(ingest.validate_job_puts(puts)).unionByName(
        ingest.deletes_to_changes(ingest.explode_deletes(dels)))
    st = {r.name: (r.job_name, r.index_type) for r in jobs.job_state(ch).collect()}
    assert st == {"a": ("j1", "yyyy")}


def test_option_builders():
    o = readers.kafka_options("h:9092", ["a", "b"], max_offsets_per_trigger=1000)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "1000"
    s = writers.search_options("h:9200", pipeline="p")
    assert s["es.ingest.pipeline"] == "p" and s["es.resource.write"] == "{index}/doc"


def test_write_topic_and_fan_out(spark):
    out = _tmp() + "/t"
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z")], "topic string, log string")
    writers.write_topic(ingest.to_records(df), path=out, partitions=2)
    back = spark.read.parquet(out)
    assert sorted((r.topic, r.value.decode()) for r in back.collect()) == [("a", "x"), ("a", "z"), ("b", "y")]
    a, b = _tmp() + "/a", _tmp() + "/b"
    sink = writers.fan_out_batches([lambda d, i: d.write.mode("overwrite").parquet(f"{a}/{i}"),
                                    lambda d, i: d.write.mode("overwrite").json(f"{b}/{i}")])
    sink(df, 7)
    assert spark.read.parquet(f"{a}/7").count() == 3 and spark.read.json(f"{b}/7").count() == 3


def test_tick_counts_stream(spark):
    src = _tmp() + "/r"
    t0 = dt.datetime(2024, 1, 1)
    rows = [("t", 0, i, t0 + dt.timedelta(seconds=s), b"x") for i, s in enumerate([1, 2, 12, 35, 36, 50])]
    spark.createDataFrame(rows, "topic string, partition int, offset long, ts timestamp_ntz, value binary") \
        .write.parquet(src)
    q = (tick_counts_stream(readers.read_topics(spark, path=src), every="10 seconds")
         .writeStream.format("memory").queryName("ticks").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.ts.second, r.rows) for r in spark.table("ticks").collect())
    assert got == [(0, 2), (10, 1), (30, 2)]  # the 50 s tick is still open


def test_results_do_not_depend_on_session_zone(spark):
    names = ["routed_counts", "route_as_of", "throughput", "liveness", "first_claim", "log_line"]
    qs = E.queries()
    base = {n: sorted(map(tuple, qs[n](spark, SF).collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        for n in names:
            assert sorted(map(tuple, qs[n](spark, SF).collect())) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cluster_conf_sizes_partitions():
    from logflow.session import cluster_conf
    c = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of cores
