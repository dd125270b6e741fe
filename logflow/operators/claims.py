"""Claims on topics.

A collector claims a topic by writing a lock key bound to a lease and renews
it while it runs.  As data that is a heartbeat table ``topic, owner, ts``; a
claim lives while heartbeats come at most one lease apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.functions.keys import LOCKS_PREFIX, strip_prefix
from logflow.functions.timefmt import from_micros, micros, seconds
from logflow.plans import scan

# ---- fixed values that must equal the reference's ---------------------------
LEASE = "10 seconds"
# -----------------------------------------------------------------------------


def read_claims(locks: DataFrame, prefix: str = LOCKS_PREFIX) -> DataFrame:
    """Claimed names under ``prefix`` (S6): one row per name."""
    return (locks.filter(F.col("key").startswith(prefix))
            .select(strip_prefix("key", prefix).alias("topic")).distinct())


def liveness(heartbeats: DataFrame, lease: str | float = LEASE,
             keys: Sequence[str] = ("topic", "owner"),
             width: int = scan.TIME_WIDTH) -> DataFrame:
    """Claim sessions (T3): heartbeats at most ``lease`` apart form one session.

    A gap of exactly one lease still merges (as ``session_window`` does).
    Returns ``keys..., session_start, last_beat, session_end, beats`` with
    ``session_end = last_beat + lease``.

    Heartbeats are first counted per distinct time, then one skew-safe scan
    labels every beat with its session start, so a hot topic is spread over
    time slices rather than sent to one task.
    """
    keys = list(keys)
    lease_us = int(round(seconds(lease) * 1_000_000))
    beats = (heartbeats.select(*keys, micros("ts").alias("__us"))
             .groupBy(*keys, "__us").agg(F.count(F.lit(1)).alias("__n")))
    labelled = scan.session_starts(beats, keys, "__us", lease_us, "__sess", width=width)
    s = labelled.groupBy(*keys, "__sess").agg(F.max("__us").alias("__last"), F.sum("__n").alias("beats"))
    return s.select(*keys, from_micros("__sess").alias("session_start"),
                    from_micros("__last").alias("last_beat"),
                    from_micros(F.col("__last") + F.lit(lease_us)).alias("session_end"),
                    F.col("beats").cast("long"))


def live_claims(sessions: DataFrame, at: Column) -> DataFrame:
    """Claims alive at time ``at``: a session whose start <= at <= end."""
    return (sessions.filter((F.col("session_start") <= at) & (at <= F.col("session_end")))
            .select("topic").distinct())


def claimed_at(heartbeats: DataFrame, at: Column, lease: str | float = LEASE) -> DataFrame:
    """Claims alive at time ``at``, straight from the heartbeats.

    A lease session covers ``at`` exactly when some heartbeat falls in
    ``[at - lease, at]`` (beats inside a session are at most one lease apart,
    and a beat in that window keeps its session alive through ``at``).  So
    this is a time filter, pushed to the scan, and a ``distinct`` -- no
    sessionization of the whole history.
    """
    lease_us = int(round(seconds(lease) * 1_000_000))
    lo = from_micros(micros(at) - F.lit(lease_us))
    return heartbeats.filter((F.col("ts") >= lo) & (F.col("ts") <= at)).select("topic").distinct()


def first_claim(claims: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """The first writer per claim key wins (W3); later writers are refused.

    ``min_by`` over ``(ts, owner)`` is an aggregate with a map-side partial, so
    a hot claim key does not gather its rows in one task.
    """
    return (claims.groupBy(*by)
            .agg(F.min_by("owner", F.struct("ts", "owner")).alias("owner"),
                 F.min("ts").alias("claimed_at"),
                 F.count(F.lit(1)).alias("attempts")))


def claim_winners(heartbeats: DataFrame, lease: str | float = LEASE,
                  width: int = scan.TIME_WIDTH) -> DataFrame:
    """Who holds each topic's lock (W3 over lease sessions).

    All attempts on a topic that come at most one lease apart form one lock
    session; the earliest attempt (then the smallest owner) wins it and every
    other owner in the session is refused.  After a gap longer than the lease
    the lock has expired and the next attempt wins a new session.  (A holder
    that stops renewing while others keep trying inside one lease is not
    modelled; the whole session goes to the first writer.)
    """
    lease_us = int(round(seconds(lease) * 1_000_000))
    hb = heartbeats.select("topic", "owner", micros("ts").alias("__us"))
    labelled = scan.session_starts(hb, "topic", "__us", lease_us, "__sess", width=width)
    g = labelled.groupBy("topic", "__sess").agg(
        F.min_by("owner", F.struct("__us", "owner")).alias("owner"),
        F.max("__us").alias("__last"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_distinct("owner").alias("owners"))
    return g.select("topic", "owner", from_micros("__sess").alias("claimed_at"),
                    from_micros(F.col("__last") + F.lit(lease_us)).alias("expires_at"),
                    "attempts", (F.col("owners") - 1).alias("refused_owners"))


def unclaimed(jobs: DataFrame, claims: DataFrame) -> DataFrame:
    """Jobs whose topic has no live claim (J2), re-emitted as SAVE events."""
    return jobs.join(claims.select("topic"), "topic", "left_anti").withColumn("event_type", F.lit(1))


def lock_holders(heartbeats: DataFrame, lease: str | float = LEASE,
                 width: int = scan.TIME_WIDTH) -> DataFrame:
    """Exact lock tenures per topic (W3 with hand-over): ``topic, owner,
    claimed_at, expires_at``.

    Every heartbeat is an attempt.  A free lock goes to the first attempt
    (then the smallest owner); the holder's own beats at most one lease apart
    keep it; other owners are refused until the holder's last beat + lease
    has passed, and the next attempt after that wins.

    A tenure lasts for the rest of the holder's own lease session (sessions of
    each owner's beats), so the tenures form a chain over owner sessions:
    each session's successor is the session of the first attempt strictly
    after its end (an as-of step on the skew-safe scan).  The chain from each
    topic's first attempt is collected by pointer doubling: round k adds the
    tenures 2^k..2^(k+1)-1 steps ahead, so a chain of n tenures takes
    log2(n) joins over the session table.  Each round is checkpointed.
    """
    from logflow.plans.materialize import materialize

    lease_us = int(round(seconds(lease) * 1_000_000))
    beats = (heartbeats.select("topic", "owner", micros("ts").alias("__us")).distinct())
    lab = materialize(scan.session_starts(beats, ["topic", "owner"], "__us", lease_us, "__s", width=width))
    node = F.struct(F.col("owner").alias("o"), F.col("__s").alias("s"))
    sessions = lab.groupBy("topic", "owner", "__s").agg((F.max("__us") + F.lit(lease_us)).alias("__end"))
    # as-of: first attempt strictly after each session's end
    attempts = lab.select("topic", F.col("__us").alias("__t"), F.lit(1).alias("__k"), F.col("owner").alias("__o"),
                          F.struct(node.alias("n"), F.col("__us").alias("at")).alias("__v"),
                          F.lit(None).cast("string").alias("owner"), F.lit(None).cast("long").alias("__s"))
    probes = sessions.select("topic", F.col("__end").alias("__t"), F.lit(2).alias("__k"),
                             F.lit(None).cast("string").alias("__o"),
                             F.lit(None).cast(attempts.schema["__v"].dataType).alias("__v"), "owner", "__s")
    nxt = scan.carry_forward(attempts.unionByName(probes), "topic", ["__t", "__k", "__o"], "__v", "__next",
                             width=width, backward=True)
    edges = materialize(nxt.filter(F.col("__k") == 2).select(
        "topic", node.alias("n"), F.col("__t").alias("end"), F.col("__next.n").alias("to"),
        F.col("__next.at").alias("to_at")))
    # the chain starts at each topic's first attempt
    first = lab.groupBy("topic").agg(F.min_by(F.struct(node.alias("n"), F.col("__us").alias("at")),
                                              F.struct("__us", "owner")).alias("__f"))
    reach = materialize(first.select("topic", F.col("__f.n").alias("n"), F.col("__f.at").alias("at")))
    # jump: n -> (node 2^k steps ahead, its entry time)
    jump = edges.select("topic", "n", "to", "to_at")
    while True:
        ahead = (reach.join(jump, ["topic", "n"]).filter(F.col("to").isNotNull())
                 .select("topic", F.col("to").alias("n"), F.col("to_at").alias("at")))
        grown = materialize(reach.unionByName(ahead).dropDuplicates(["topic", "n"]))
        if grown.count() == reach.count():
            break
        reach = grown
        j2 = jump.alias("a").join(jump.alias("b"), (F.col("a.topic") == F.col("b.topic"))
                                  & (F.col("a.to") == F.col("b.n")), "left")
        jump = materialize(j2.select(F.col("a.topic").alias("topic"), F.col("a.n").alias("n"),
                                     F.col("b.to").alias("to"), F.col("b.to_at").alias("to_at")))
    out = reach.join(edges.select("topic", "n", "end"), ["topic", "n"])
    return out.select("topic", F.col("n.o").alias("owner"), from_micros("at").alias("claimed_at"),
                      from_micros("end").alias("expires_at"))
