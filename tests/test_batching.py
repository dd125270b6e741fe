"""Flush batches (W1 A1): size cut inside timer ticks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logflow.operators import batching

T0 = dt.datetime(2024, 1, 1)


def recs(spark, spec):
    """spec: list of (partition, second, n rows)."""
    rows, off = [], {}
    for p, sec, n in spec:
        for _ in range(n):
            o = off.get(p, 0)
            off[p] = o + 1
            rows.append(("t", p, o, T0 + dt.timedelta(seconds=sec, microseconds=o % 1000), b"x"))
    return spark.createDataFrame(rows, "topic string, partition int, offset long, ts timestamp_ntz, value binary")


@pytest.mark.parametrize("n,want", [(0, []), (1, [1]), (999, [999]), (1000, [1000]), (1001, [1000, 1]),
                                    (2500, [1000, 1000, 500])])
def test_cut_sizes(spark, n, want):
    df = recs(spark, [(0, 0, n)]) if n else recs(spark, [(0, 0, 1)]).limit(0)
    out = batching.flush_counts(batching.assign_batches(df, width=64))
    assert [r.rows for r in out.orderBy("batch_seq").collect()] == want


def test_ticks_and_partitions(spark):
    df = recs(spark, [(0, 0, 3), (1, 0, 2), (0, 1, 4), (0, 5, 1)])
    out = batching.flush_counts(batching.assign_batches(df, max_rows=2, width=3))
    got = sorted((r.partition, r.tick_start.second, r.batch_seq, r.rows) for r in out.collect())
    assert got == [(0, 0, 0, 2), (0, 0, 1, 1), (0, 1, 0, 2), (0, 1, 1, 2), (0, 5, 0, 1), (1, 0, 0, 2)]


def test_properties(spark):
    import random
    rnd = random.Random(3)
    spec = [(rnd.randrange(3), rnd.randrange(20), rnd.randrange(0, 40)) for _ in range(30)]
    df = recs(spark, spec)
    b = batching.assign_batches(df, max_rows=7, width=5)
    rows = b.collect()
    assert len(rows) == df.count()
    assert len({(r.partition, r.offset) for r in rows}) == len(rows)
    sizes = b.groupBy("partition", "tick", "batch_seq").count().collect()
    assert max(r["count"] for r in sizes) <= 7
    span = b.groupBy("partition", "tick", "batch_seq").agg(F.countDistinct("tick").alias("t")).collect()
    assert all(r.t == 1 for r in span)
