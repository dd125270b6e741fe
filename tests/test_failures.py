"""Failure and skew behaviour: a failed sink write is retried from the
checkpoint without loss or duplicates; a hot key is spread over tasks."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF
from logflow.operators import jobs
from logflow.plans import scan
from logflow.sinks import writers
from logflow.sources import derived as D
from logflow.sources import readers
from logflow.streaming.collect import collect
from logflow.streaming.registry import topic_events


def _tmp():
    return tempfile.mkdtemp(prefix="logflow-fail-")


def test_failed_batch_is_replayed_without_loss_or_duplicates(spark):
    src, out, ck, feed = _tmp() + "/src", _tmp() + "/out", _tmp() + "/ck", _tmp() + "/feed"
    recs = D.records(spark, SF)
    D.changes(spark, SF).write.parquet(feed)
    current = jobs.running_topics(jobs.to_job_events(D.changes(spark, SF)))
    recs.repartition(4, "topic", "partition").write.parquet(src)
    good = writers.index_writer(out)
    calls = {"n": 0}

    def flaky(batch, batch_id):
        good(batch, batch_id)          # the write lands ...
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("executor lost after the write")  # ... but the batch is not committed

    stream = readers.read_topics(spark, path=src, max_files_per_trigger=1)
    events = topic_events(readers.read_job_changes(spark, feed))
    q = collect(stream, events, flaky, ck, trigger={"availableNow": True}, index_time="record")
    with pytest.raises(Exception):
        q.awaitTermination()
    stream = readers.read_topics(spark, path=src, max_files_per_trigger=1)
    collect(stream, events, good, ck, trigger={"availableNow": True}, index_time="record").awaitTermination()
    back = writers.read_index(spark, out, "topic string, partition int, offset long")
    want = recs.join(current.select("topic"), "topic").count()
    assert back.count() == want
    assert back.select("topic", "partition", "offset").distinct().count() == want


def test_hot_key_is_spread_over_tasks(spark):
    # count tasks as planned, without AQE merging small partitions
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_hot_key_spread(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def _check_hot_key_spread(spark):
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("k"), F.col("id").alias("o"))
    out = scan.row_number(df, "k", "o", out="rn", width=4096)
    per_task = (out.filter(F.col("k") == "hot").groupBy(F.spark_partition_id().alias("p")).count()
                .agg(F.count("*").alias("tasks"), F.max("count").alias("largest")).first())
    assert per_task.tasks > 1
    assert per_task.largest <= 160_000 // 2
    hot = out.filter(F.col("k") == "hot").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(hot) == (1, 160_000, 160_000)
