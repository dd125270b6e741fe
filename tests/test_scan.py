"""The sliced scans equal plain windows, on a hot key and with tiny slices."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logflow.plans import scan


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(8)}"
        v = None if rnd.random() < 0.2 else rnd.randrange(100)
        rows.append((k, i * 3 + rnd.randrange(3), v))
    return spark.createDataFrame(rows, "k string, o long, v long").cache()


@pytest.mark.parametrize("width", [1, 5, 64, 1 << 20])
def test_row_number(data, width):
    w = Window.partitionBy("k").orderBy("o")
    want = {(r.k, r.o): r.rn for r in data.withColumn("rn", F.row_number().over(w)).collect()}
    got = {(r.k, r.o): r.rn for r in scan.row_number(data, "k", "o", out="rn", width=width).collect()}
    assert got == want


@pytest.mark.parametrize("how", ["sum", "max", "min"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(data, how, keys):
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("o").rowsBetween(
        Window.unboundedPreceding, 0)
    agg = {"sum": F.sum, "max": F.max, "min": F.min}[how]
    want = {r.o: r.x for r in data.withColumn("x", agg("v").over(w)).collect()}
    got = {r.o: r.x for r in scan.running(data, keys, "o", "v", "x", how=how, width=7).collect()}
    assert got == want


@pytest.mark.parametrize("lead", [False, True])
def test_lag_lead(data, lead):
    w = Window.partitionBy("k").orderBy("o")
    f = F.lead if lead else F.lag
    want = {r.o: (r.pv, r.po) for r in data.select("o", f("v").over(w).alias("pv"), f("o").over(w).alias("po"))
            .collect()}
    out = scan.lag(data, "k", "o", ["v", "o"], prefix="p_", exists="has", width=11, lead=lead)
    got = {r.o: (r.p_v, r.p_o) for r in out.collect()}
    assert got == want
    assert all(r.has == (r.p_o is not None) for r in out.collect())


@pytest.mark.parametrize("backward", [False, True])
def test_carry_forward(data, backward):
    w = Window.partitionBy("k").orderBy("o")
    if backward:
        w = w.rowsBetween(0, Window.unboundedFollowing)
        want_col = F.first("v", ignorenulls=True).over(w)
    else:
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        want_col = F.last("v", ignorenulls=True).over(w)
    want = {r.o: r.x for r in data.select("o", want_col.alias("x")).collect()}
    got = {r.o: r.x for r in scan.carry_forward(data, "k", "o", "v", "x", width=13, backward=backward).collect()}
    assert got == want


def test_hot_key_is_split(spark, data):
    """The in-group window is partitioned by (key, slice), not by key alone."""
    plan = scan.row_number(data, "k", "o", width=64)._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan


@pytest.mark.parametrize("width", [3, 10, 1000])
def test_session_starts(spark, width):
    import random
    rnd = random.Random(width)
    rows = {(rnd.choice(["hot", "hot", "a", "b"]), rnd.randrange(0, 400)) for _ in range(900)}
    df = spark.createDataFrame(sorted(rows), "k string, t long")
    got = {(r.k, r.t): r.s for r in scan.session_starts(df, "k", "t", 4, "s", width=width).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        start, prev = None, None
        for t in sorted(t for kk, t in rows if kk == k):
            if prev is None or t - prev > 4:
                start = t
            want[(k, t)] = start
            prev = t
    assert got == want


def test_null_keys_and_orders_are_groups_of_their_own(spark):
    rows = [(k, o) for k in ("a", None) for o in (1, 5, 9, 12, None)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = {(r.k, r.o): r.rn for r in scan.row_number(df, "k", "o", out="rn", width=4).collect()}
    assert got == {(k, o): n for k in ("a", None) for n, o in enumerate((None, 1, 5, 9, 12), 1)}
    run = {(r.k, r.o): r.s for r in scan.running(df, "k", "o", F.lit(1), "s", width=4).collect()}
    assert run == got


def test_null_owner_has_sessions_of_its_own(spark):
    df = spark.createDataFrame([(None, t) for t in (0, 5, 100, 108)], "k string, t long")
    got = {r.t: r.s for r in scan.session_starts(df, "k", "t", 10, "s", width=20).collect()}
    assert got == {0: 0, 5: 0, 100: 100, 108: 100}
