"""The job registry as data.

The registry is an append-only change log ``revision, op, key, value, ts``.
Its state, the job events it produces and the set of running topics are all
folds of that log, written as aggregates and skew-safe ordered scans.

Running topics follow the reference's table keyed by topic: a SAVE event
starts (or replaces, latest config wins) the topic named in the job; a DELETE
of key ``k`` stops topic ``k`` if it runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.functions.jsoncheck import JOB_FIELDS, decode_job_picked, field, is_string, kind, parse_one
from logflow.functions.keys import JOBS_PREFIX, add_prefix, strip_prefix
from logflow.plans import scan

# ---- fixed values that must equal the reference's ---------------------------
EVENT_SAVE = 1
EVENT_DELETE = 2
# -----------------------------------------------------------------------------

CHANGE_COLS = ("revision", "op", "key", "value", "ts")


def read_jobs(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Registry rows under ``prefix`` (S5; a prefix range read on Parquet)."""
    return changes.filter(F.col("key").startswith(prefix))


def _named(field_name: str):
    return lambda entry: F.lower(entry["key"]) == field_name


def decode_jobs(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``decodable`` and the four job fields decoded from ``value``.

    A key names a field in any case; of several keys the last with a string
    counts, a ``null`` leaves what was there, and a value of another type
    makes the whole undecodable wherever it stands.

    Staged as separate projections so that each expensive expression appears
    once: parse; exact-name fields; the keys in text order, read only for the
    rare value that may hold other keys than each exact name once; checks.
    """
    v, k = F.col("__v"), F.col("__k")
    text = F.col(value)
    d = df.withColumn("__v", parse_one(text))
    d = d.select(*df.columns, "__v", kind(v).alias("__k"), *[field(v, f).alias("__e_" + f) for f in JOB_FIELDS])
    names = F.lit('(?i)"(?:' + "|".join(JOB_FIELDS) + ')"')
    unsure = (F.regexp_count(text, names) != len(JOB_FIELDS)) | text.contains("\\u")
    for f in JOB_FIELDS:
        e = F.col("__e_" + f)
        unsure = unsure | e.isNull() | (F.schema_of_variant(e) == "VOID")
    keys = F.map_entries(F.from_json(text, "map<string,variant>"))  # keeps the order and repeated keys
    d = d.select("*", F.when(unsure & (k == F.lit("OBJECT")), keys).alias("__m"))
    d = d.select("*", *[F.filter("__m", _named(f)).alias("__h_" + f) for f in JOB_FIELDS])
    bad, picks = F.lit(False), []
    for f in JOB_FIELDS:
        hits = F.col("__h_" + f)
        bad = bad | F.exists(hits, lambda e: ~F.coalesce(
            F.schema_of_variant(e["value"]), F.lit("VOID")).isin("STRING", "VOID"))
        last = F.try_element_at(F.filter(hits, lambda e: is_string(e["value"])), F.lit(-1))["value"]
        picks.append(F.when(hits.isNull(), F.col("__e_" + f)).otherwise(last).alias("__p_" + f))
    d = d.select(*df.columns, "__v", "__k", F.coalesce(bad, F.lit(False)).alias("__bad"), *picks)
    j = decode_job_picked(v, k, {f: F.col("__p_" + f) for f in JOB_FIELDS})
    # The result leaves through a one-row generator.  Filters on ``decodable``
    # cannot be pushed below a generator's output, so the optimizer does not
    # copy the whole decode into every later predicate.
    out = F.struct((j["ok"] & ~F.col("__bad")).alias("decodable"), *[j[f].alias(f) for f in JOB_FIELDS])
    return d.select(*df.columns, F.inline(F.array(out)))


def registry_state(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Keys present in the registry: the last change per key, if it is a PUT.

    ``max_by`` is a partial aggregate, so a hot key is combined map-side.
    """
    last = (read_jobs(changes, prefix).groupBy("key")
            .agg(F.max_by(F.struct(*[c for c in CHANGE_COLS if c != "key"]), "revision").alias("__l")))
    return last.select("key", "__l.*").filter(F.col("op") == "PUT").drop("op")


def job_state(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Listed jobs (A4): present keys whose value decodes, with the job fields."""
    s = decode_jobs(registry_state(changes, prefix))
    return (s.filter("decodable")
            .select("key", strip_prefix("key", prefix).alias("name"), "revision", "ts", *JOB_FIELDS))


def quarantine(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """PUT changes whose value does not decode (skipped by the fold, kept here)."""
    return (decode_jobs(read_jobs(changes, prefix).filter(F.col("op") == "PUT"))
            .filter(~F.col("decodable")).select(*CHANGE_COLS))


def to_job_events(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Job events (P10): PUT -> SAVE with the decoded job; DELETE -> DELETE of the
    topic named by the key.  Undecodable PUTs produce no event."""
    d = decode_jobs(read_jobs(changes, prefix))
    put = F.col("op") == "PUT"
    return (d.filter(~put | F.col("decodable"))
            .select("revision", "ts", "key",
                    F.when(put, F.lit(EVENT_SAVE)).otherwise(F.lit(EVENT_DELETE)).alias("event_type"),
                    F.when(put, F.col("topic")).otherwise(strip_prefix("key", prefix)).alias("topic"),
                    *[F.when(put, F.col(f)).alias(f) for f in JOB_FIELDS if f != "topic"]))


def prior_image(changes: DataFrame, prefix: str = JOBS_PREFIX,
                width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """The previous value each put/delete replaced (W2), decoded; NULL fields
    when there was none, it was deleted, or it does not decode."""
    c = read_jobs(changes, prefix).select(*CHANGE_COLS)
    lagged = scan.lag(c, "key", "revision", ["op", "value"], prefix="__prev_", width=width)
    dec = decode_jobs(lagged, "__prev_value")
    live = (F.col("__prev_op") == "PUT") & F.col("decodable")
    return dec.select("revision", "key", "op", *[F.when(live, F.col(f)).alias("prior_" + f) for f in JOB_FIELDS])


def removed_jobs(deletes: DataFrame, changes: DataFrame, prefix: str = JOBS_PREFIX,
                 width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """The reply to delete requests (P9): for each key of an accepted request
    the job that it removed; NULL fields when there was none or it does not
    decode.

    ``deletes`` has ``revision, pos, key`` (``ingest.explode_deletes``),
    ``changes`` the log without these deletes.  Keys of one request are
    removed in their order, so a key named twice removes its job once.
    """
    log = read_jobs(changes, prefix).select("revision", F.lit(-1).alias("pos"), "op", "key", "value")
    gone = deletes.filter(F.col("key").isNotNull()).select(
        "revision", "pos", F.lit("DELETE").alias("op"), add_prefix("key", prefix).alias("key"),
        F.lit(None).cast("string").alias("value"))
    lagged = scan.lag(log.unionByName(gone), "key", ["revision", "pos"], ["op", "value"], prefix="__prev_", width=width)
    dec = decode_jobs(lagged.filter(F.col("pos") >= 0), "__prev_value")
    live = (F.col("__prev_op") == "PUT") & F.col("decodable")
    return dec.select("revision", "pos", strip_prefix("key", prefix).alias("key"),
                      *[F.when(live, F.col(f)).alias("removed_" + f) for f in JOB_FIELDS])


def topic_transitions(events: DataFrame, width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """Each job event with ``running_before`` / ``running_after`` of its topic."""
    lagged = scan.lag(events, "topic", "revision", ["event_type"], prefix="__prev_", width=width)
    return (lagged.withColumn("running_before",
                              F.coalesce(F.col("__prev_event_type") == EVENT_SAVE, F.lit(False)))
            .withColumn("running_after", F.col("event_type") == EVENT_SAVE)
            .drop("__prev_event_type"))


def active_job_count(events: DataFrame, width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """Number of running topics after each job event (A3): per-topic +1/-1
    deltas, then a running sum over revisions."""
    t = topic_transitions(events, width)
    delta = F.col("running_after").cast("long") - F.col("running_before").cast("long")
    return (scan.running(t.withColumn("__d", delta), [], "revision", "__d", "active_jobs", width=width)
            .select("revision", "ts", "event_type", "topic", F.col("active_jobs").cast("long")))


def running_topics(events: DataFrame) -> DataFrame:
    """Topics running after the last event, with the job in force (A5)."""
    last = events.groupBy("topic").agg(
        F.max_by(F.struct("event_type", "revision", "key", *[f for f in JOB_FIELDS if f != "topic"]),
                 "revision").alias("__l"))
    return (last.select("topic", "__l.*").filter(F.col("event_type") == EVENT_SAVE)
            .drop("event_type"))


def effective_deletes(deletes: DataFrame, running: DataFrame) -> DataFrame:
    """Deletes that stop something: the topic is running."""
    return deletes.join(running.select("topic"), "topic", "left_semi")


def effective_deletes_in_log(events: DataFrame, width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """J3 over the whole log: DELETE events whose topic runs just before them."""
    t = topic_transitions(events, width)
    return (t.filter((F.col("event_type") == EVENT_DELETE) & F.col("running_before"))
            .select("revision", "ts", "key", "topic"))


def delete_all_survivors(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Keys left after delete-all (J4).  Delete-all removes the keys named by
    the listed jobs' topics, so a key that is nobody's topic survives."""
    state = decode_jobs(registry_state(changes, prefix)).withColumn("name", strip_prefix("key", prefix))
    topics = state.filter("decodable").select(F.col("topic").alias("name"))
    return state.join(topics, "name", "left_anti").select("key", "name", "revision", "decodable")


def delete_all_changes(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """The DELETE changes delete-all appends: one per listed job, for the key
    named by the job's topic (present or not).  They share the revision after
    the log's last one; distinct keys make the order among them irrelevant."""
    nxt = changes.agg(F.max("revision")).scalar() + F.lit(1)
    topics = job_state(changes, prefix).select("topic").distinct()
    return topics.select(nxt.alias("revision"), F.lit("DELETE").alias("op"),
                         F.concat(F.lit(prefix), "topic").alias("key"), F.lit(None).cast("string").alias("value"),
                         F.lit(None).cast("timestamp_ntz").alias("ts"))


def snapshot_then_tail(changes: DataFrame, cut: Column | int, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Job events as a watcher sees them (T1): the state at revision ``cut`` as
    SAVE events (``phase`` 0), then the changes after ``cut`` (``phase`` 1).
    No change is both in the snapshot and in the tail."""
    cut_c = cut if isinstance(cut, Column) else F.lit(cut)
    snap = (job_state(changes.filter(F.col("revision") <= cut_c), prefix)
            .select(F.lit(0).alias("phase"), "revision", "ts", "key",
                    F.lit(EVENT_SAVE).alias("event_type"), *JOB_FIELDS))
    tail = (to_job_events(changes.filter(F.col("revision") > cut_c), prefix)
            .select(F.lit(1).alias("phase"), "revision", "ts", "key", "event_type", *JOB_FIELDS))
    return snap.unionByName(tail)
