"""Claims: lease liveness boundaries (T3), first writer (W3), repair."""

import datetime as dt

import pytest

from logflow.operators import claims

T0 = dt.datetime(2024, 1, 1)


def beats(spark, rows):
    return spark.createDataFrame([(t, o, T0 + dt.timedelta(seconds=s)) for t, o, s in rows],
                                 "topic string, owner string, ts timestamp_ntz")


@pytest.mark.parametrize("gap,sessions", [(9, 1), (10, 1), (11, 2)])
def test_lease_boundary(spark, gap, sessions):
    s = claims.liveness(beats(spark, [("t", "o", 0), ("t", "o", gap)]), "10 seconds").collect()
    assert len(s) == sessions
    if sessions == 1:
        assert s[0].session_end == T0 + dt.timedelta(seconds=gap + 10) and s[0].beats == 2


def test_liveness_matches_session_window(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    rows = [(f"t{rnd.randrange(3)}", f"o{rnd.randrange(2)}", rnd.randrange(0, 600)) for _ in range(400)]
    df = beats(spark, rows)
    got = {(r.topic, r.owner, r.session_start, r.session_end, r.beats)
           for r in claims.liveness(df, "10 seconds", width=30_000_000).collect()}
    ref = (df.groupBy("topic", "owner", F.session_window("ts", "10 seconds").alias("w"))
           .agg(F.count("*").alias("n")).collect())
    want = {(r.topic, r.owner, r.w.start, r.w.end, r.n) for r in ref}
    assert got == want


def test_first_claim_and_unclaimed(spark):
    b = beats(spark, [("a", "o2", 5), ("a", "o1", 5), ("a", "o3", 1), ("b", "o1", 2)])
    fc = {r.topic: (r.owner, r.attempts) for r in claims.first_claim(b).collect()}
    assert fc == {"a": ("o3", 3), "b": ("o1", 1)}
    b2 = beats(spark, [("a", "o2", 5), ("a", "o1", 5)])
    assert claims.first_claim(b2).first().owner == "o1"  # same time: order by owner
    jobs_df = spark.createDataFrame([("a", "ja"), ("b", "jb"), ("c", "jc")], "topic string, job_name string")
    live = spark.createDataFrame([("a",), ("c",)], "topic string")
    assert [r.topic for r in claims.unclaimed(jobs_df, live).collect()] == ["b"]


def test_read_claims(spark):
    from logflow.functions.keys import LOCKS_PREFIX
    locks = spark.createDataFrame([(LOCKS_PREFIX + "a", "lock"), (LOCKS_PREFIX + "a", "lock"),
                                   ("/other/a", "lock")], "key string, value string")
    assert [r.topic for r in claims.read_claims(locks).collect()] == ["a"]


def test_claim_winners(spark):
    b = beats(spark, [("a", "o2", 0), ("a", "o1", 3), ("a", "o2", 8), ("a", "o1", 30), ("a", "o3", 30),
                      ("b", "o9", 1)])
    got = sorted((r.topic, r.owner, r.claimed_at.second, r.attempts, r.refused_owners)
                 for r in claims.claim_winners(b, "10 seconds").collect())
    assert got == [("a", "o1", 30, 2, 1), ("a", "o2", 0, 3, 1), ("b", "o9", 1, 1, 0)]


def test_claimed_at_equals_session_cover(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    rows = [(f"t{rnd.randrange(6)}", "o", rnd.randrange(0, 3000)) for _ in range(300)]
    hb = beats(spark, rows)
    sessions = claims.liveness(hb, "20 seconds", keys=("topic",))
    for s in (0, 5, 700, 1500, 2999, 3010, 3030):
        at = F.lit(T0 + dt.timedelta(seconds=s)).cast("timestamp_ntz")
        a = {r.topic for r in claims.claimed_at(hb, at, "20 seconds").collect()}
        b = {r.topic for r in claims.live_claims(sessions, at).collect()}
        assert a == b, s


def _simulate(rows, lease):
    out, by = [], {}
    for t, o, s in sorted(rows):
        by.setdefault(t, []).append((s, o))
    for t, seq in by.items():
        holder, exp = None, None
        for s, o in sorted(seq):
            if holder is None or s > exp:
                holder, exp = o, s + lease
                out.append([t, o, s, exp])
            elif o == holder:
                exp = s + lease
                out[-1][3] = exp
    return sorted((t, o, s, e) for t, o, s, e in out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lock_holders_match_a_lock_simulation(spark, seed):
    import random
    rnd = random.Random(seed)
    rows = {(f"t{rnd.randrange(3)}", f"o{rnd.randrange(3)}", rnd.randrange(0, 400)) for _ in range(150)}
    got = sorted((r.topic, r.owner, int((r.claimed_at - T0).total_seconds()), int((r.expires_at - T0).total_seconds()))
                 for r in claims.lock_holders(beats(spark, rows), "10 seconds", width=30_000_000).collect())
    assert got == _simulate(rows, 10)


def test_lock_holders_boundaries(spark):
    # o1 holds from 0; o1 renews at exactly one lease (10): kept; o2 at 20 =
    # o1's expiry: refused; o2 at 21: wins.  At 40 two owners tie: smaller wins.
    rows = [("t", "o1", 0), ("t", "o1", 10), ("t", "o2", 20), ("t", "o2", 21), ("t", "o3", 40), ("t", "o2", 40)]
    got = sorted((r.owner, int((r.claimed_at - T0).total_seconds()), int((r.expires_at - T0).total_seconds()))
                 for r in claims.lock_holders(beats(spark, rows), "10 seconds").collect())
    assert got == [("o1", 0, 20), ("o2", 21, 31), ("o2", 40, 50)]
    assert sorted(got) == sorted((o, s, e) for _, o, s, e in _simulate(set(rows), 10))
