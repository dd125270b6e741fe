"""Registered queries and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole of
the driver's tables (through the derivations in ``sources.derived``).  The
oracle SQL computes the same result independently: it reads the generator's
ground truth (``g_*`` columns) instead of decoding JSON, and uses plain
windows and ASOF joins where the Spark side uses the skew-safe scans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions.jsoncheck import JOB_FIELDS
from logflow.functions.keys import JOBS_PREFIX, LOCKS_PREFIX, strip_prefix
from logflow.functions.timefmt import index_name, micros
from logflow.operators import batching, claims, ingest, jobs, logs, metrics, routing
from logflow.plans.materialize import materialize
from logflow.session import scratch_path
from logflow.sinks import writers
from logflow.sources import derived as D
from logflow.sources import readers
from logflow.streaming.collect import collect, collected_jobs, waiting_records
from logflow.streaming.flush import assign_batches_stream
from logflow.streaming.ingest import ingest_stream
from logflow.streaming.live import throughput_stream
from logflow.streaming.registry import current_jobs, current_running, fold_changes, fold_running, topic_events
from logflow.streaming.state import operator_state

LIVENESS_LEASE = "30 minutes"
FLUSH_ROWS = 10
FLUSH_WAIT = "1 day"
REPORT_EVERY = "1 hour"
MAX_LEVEL = 2  # WARN
FILE_ROWS, SET_FILES = 100_000, 64  # rows of a written stream's file, unless a set would have more files
LATE_PART = 10  # the first tenth of the revisions is known before the others

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return jobs.to_job_events(D.changes(spark, d))


def _shared_events(spark: SparkSession, d: str) -> DataFrame:
    """The job event log, written once for queries that scan it several times."""
    return materialize(_events(spark, d))


# ---- queries ---------------------------------------------------------------

def routed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: how many records land in which index, through which transform."""
    current = jobs.running_topics(_events(spark, d))
    routed = routing.route(D.records(spark, d), current)
    return (routed.groupBy(index_name("topic", "index_type", "ts").alias("index"), "pipeline")
            .agg(F.count(F.lit(1)).alias("records")))


def index_names(spark: SparkSession, d: str) -> DataFrame:
    e = D.table(spark, d, "events")
    itype = F.element_at(F.array(*[F.lit(t) for t in D.INDEX_TYPES]),
                         (F.col("event_id") % len(D.INDEX_TYPES) + 1).cast("int"))
    return e.select("event_id", index_name("event_type", itype, "ts").alias("index"),
                    index_name("event_type", itype, "ts", compat=True).alias("index_compat"))


def flush_batches(spark: SparkSession, d: str) -> DataFrame:
    b = batching.assign_batches(D.records(spark, d), max_rows=FLUSH_ROWS, max_wait=FLUSH_WAIT)
    return batching.flush_counts(b, max_wait=FLUSH_WAIT)


def throughput(spark: SparkSession, d: str) -> DataFrame:
    active = jobs.active_job_count(_shared_events(spark, d))
    return metrics.throughput(D.records(spark, d), every=REPORT_EVERY, jobs=active)


def job_state(spark: SparkSession, d: str) -> DataFrame:
    return jobs.job_state(D.changes(spark, d))


def prior_image(spark: SparkSession, d: str) -> DataFrame:
    return jobs.prior_image(D.changes(spark, d))


def active_job_count(spark: SparkSession, d: str) -> DataFrame:
    return jobs.active_job_count(_shared_events(spark, d))


def request_codes(spark: SparkSession, d: str) -> DataFrame:
    return ingest.validate_requests(D.requests(spark, d)).select("req_id", "code")


def request_fanout(spark: SparkSession, d: str) -> DataFrame:
    v = ingest.validate_requests(D.requests(spark, d))
    return ingest.explode_logs(v, keep=["req_id", "topic"])


def liveness(spark: SparkSession, d: str) -> DataFrame:
    return claims.liveness(D.heartbeats(spark, d), lease=LIVENESS_LEASE)


def unclaimed_jobs(spark: SparkSession, d: str) -> DataFrame:
    hb = D.heartbeats(spark, d)
    live = claims.claimed_at(hb, hb.agg(F.max("ts")).scalar(), lease=LIVENESS_LEASE)
    return claims.unclaimed(jobs.job_state(D.changes(spark, d)), live).select(
        "key", "name", "event_type", *JOB_FIELDS)


def route_as_of(spark: SparkSession, d: str) -> DataFrame:
    r = routing.route_as_of(D.records(spark, d), _shared_events(spark, d))
    return r.select("topic", "partition", "offset", "version", "job_name", "pipeline",
                    index_name("topic", "index_type", "ts").alias("index"))


def claim_winners(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_winners(D.heartbeats(spark, d), lease=LIVENESS_LEASE)


def lock_holders(spark: SparkSession, d: str) -> DataFrame:
    return claims.lock_holders(D.heartbeats(spark, d), lease=LIVENESS_LEASE)


def first_claim(spark: SparkSession, d: str) -> DataFrame:
    hb = D.heartbeats(spark, d).withColumn("day", F.to_date("ts"))
    return claims.first_claim(hb, by=["topic", "day"])


def snapshot_tail(spark: SparkSession, d: str) -> DataFrame:
    ch = D.changes(spark, d)
    cut = F.floor(ch.agg(F.max("revision")).scalar() / 2)
    return jobs.snapshot_then_tail(ch, cut)


def delete_all_survivors(spark: SparkSession, d: str) -> DataFrame:
    return jobs.delete_all_survivors(D.changes(spark, d))


def effective_deletes(spark: SparkSession, d: str) -> DataFrame:
    return jobs.effective_deletes_in_log(_shared_events(spark, d))


def running_topics(spark: SparkSession, d: str) -> DataFrame:
    return jobs.running_topics(_events(spark, d)).select("topic", "revision", "key", "job_name",
                                                          "index_type", "pipeline")


def claims_distinct(spark: SparkSession, d: str) -> DataFrame:
    return claims.read_claims(D.lock_keys(spark, d))


def job_events(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d)


def key_names(spark: SparkSession, d: str) -> DataFrame:
    ch = D.changes(spark, d)
    return ch.select("revision", "key", strip_prefix("key", JOBS_PREFIX).alias("name"),
                     strip_prefix("key", LOCKS_PREFIX).alias("name_other_prefix"))


def job_decode(spark: SparkSession, d: str) -> DataFrame:
    dec = jobs.decode_jobs(D.changes(spark, d).filter(F.col("op") == "PUT"))
    return dec.select("revision", "decodable",
                      *[F.when(F.col("decodable"), F.col(f)).alias(f) for f in JOB_FIELDS])


def _put_bodies(spark: SparkSession, d: str) -> DataFrame:
    ch = D.changes(spark, d).filter(F.col("op") == "PUT")
    dec = jobs.decode_jobs(ch).filter("decodable")
    name = strip_prefix("key", JOBS_PREFIX)
    k = F.col("revision") % 4
    full = F.to_json(F.struct(name.alias("key"), "job_name", "topic", "pipeline", "index_type"))
    short = F.to_json(F.struct(name.alias("key"), "job_name", "topic"))
    null_pipe = F.concat(F.lit('{"key":"'), name, F.lit('","job_name":"'), F.col("job_name"),
                         F.lit('","topic":"'), F.col("topic"), F.lit('","pipeline":null}'))
    num_key = F.concat(F.lit('{"key":'), F.col("revision").cast("string"), F.lit(',"job_name":"'),
                       F.col("job_name"), F.lit('","topic":"'), F.col("topic"), F.lit('"}'))
    body = F.when(k == 0, full).when(k == 1, short).when(k == 2, null_pipe).otherwise(num_key)
    return dec.select("revision", body.alias("body"))


def job_puts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.validate_job_puts(_put_bodies(spark, d)).drop("body")


def removed_jobs(spark: SparkSession, d: str) -> DataFrame:
    """P9's reply: the bulk deletes over the log of puts."""
    return jobs.removed_jobs(bulk_deletes(spark, d), D.changes(spark, d).filter(F.col("op") == "PUT"))


def bulk_deletes(spark: SparkSession, d: str) -> DataFrame:
    ch = D.changes(spark, d).filter(F.col("op") == "DELETE")
    name = strip_prefix("key", JOBS_PREFIX)
    k = F.col("revision") % 3
    body = (F.when(k == 0, F.concat(F.lit('{"keys":["'), name, F.lit('","'), name, F.lit('_old"]}')))
            .when(k == 1, F.lit('{"keys":[]}'))
            .otherwise(F.concat(F.lit('{"keys":["'), name, F.lit('",5]}'))))
    return ingest.explode_deletes(ch.select("revision", body.alias("body"))).drop("body")


def severity_filter(spark: SparkSession, d: str) -> DataFrame:
    return logs.severity_filter(D.log_messages(spark, d), max_level=MAX_LEVEL)


def log_line(spark: SparkSession, d: str) -> DataFrame:
    return logs.log_lines(D.log_messages(spark, d)).select("ts", "level", "line", "line_text")


def decode_values(spark: SparkSession, d: str) -> DataFrame:
    return ingest.decode_value(D.records(spark, d)).select("topic", "partition", "offset", "doc")


def _transforms() -> dict[str, routing.RowTransform]:
    return {"urgent": routing.RowTransform({"doc": F.upper("doc")}),
            "high": routing.RowTransform({"doc": F.concat(F.lit("high:"), "doc")}),
            "low": routing.RowTransform(keep=F.col("partition") != 0)}


def named_transforms(spark: SparkSession, d: str) -> DataFrame:
    current = jobs.running_topics(_events(spark, d))
    routed = ingest.decode_value(routing.route(D.records(spark, d), current))
    return routing.apply_transforms(routed, _transforms()).select("topic", "partition", "offset", "pipeline", "doc")


QUERIES: dict[str, Query] = {
    "routed_counts": routed_counts,
    "index_names": index_names,
    "flush_batches": flush_batches,
    "throughput": throughput,
    "job_state": job_state,
    "prior_image": prior_image,
    "active_job_count": active_job_count,
    "request_codes": request_codes,
    "request_fanout": request_fanout,
    "liveness": liveness,
    "unclaimed_jobs": unclaimed_jobs,
    "route_as_of": route_as_of,
    "first_claim": first_claim,
    "claim_winners": claim_winners,
    "lock_holders": lock_holders,
    "snapshot_tail": snapshot_tail,
    "delete_all_survivors": delete_all_survivors,
    "effective_deletes": effective_deletes,
    "running_topics": running_topics,
    "claims_distinct": claims_distinct,
    "job_events": job_events,
    "key_names": key_names,
    "job_decode": job_decode,
    "job_puts": job_puts,
    "bulk_deletes": bulk_deletes,
    "removed_jobs": removed_jobs,
    "severity_filter": severity_filter,
    "log_line": log_line,
    "decode_values": decode_values,
    "named_transforms": named_transforms,
}


# ---- oracle SQL --------------------------------------------------------------

_L = len(JOBS_PREFIX)
_EVENTS = f"""
    SELECT revision, ts, key,
           CASE WHEN op = 'PUT' THEN 1 ELSE 2 END AS event_type,
           CASE WHEN op = 'PUT' THEN g_topic ELSE substr(key, {_L + 1}) END AS topic,
           CASE WHEN op = 'PUT' THEN g_job_name END AS job_name,
           CASE WHEN op = 'PUT' THEN g_index_type END AS index_type,
           CASE WHEN op = 'PUT' THEN g_pipeline END AS pipeline
    FROM changes WHERE NOT (op = 'PUT' AND g_bad)"""
_RUNNING = """
    SELECT topic, revision, key, job_name, index_type, pipeline FROM events
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY revision DESC) = 1 AND event_type = 1"""
_STATE = f"""
    SELECT key, substr(key, {_L + 1}) AS name, revision, ts, g_job_name AS job_name, g_topic AS topic,
           g_index_type AS index_type, g_pipeline AS pipeline, op, g_bad
    FROM changes QUALIFY row_number() OVER (PARTITION BY key ORDER BY revision DESC) = 1"""
_TRANSITIONS = """
    SELECT revision, ts, key, event_type, topic,
           coalesce(lag(event_type) OVER (PARTITION BY topic ORDER BY revision) = 1, false) AS running_before,
           event_type = 1 AS running_after
    FROM events"""
_ACTIVE = """
    SELECT revision, ts, event_type, topic,
           CAST(sum(CAST(running_after AS INTEGER) - CAST(running_before AS INTEGER))
                OVER (ORDER BY revision ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active_jobs
    FROM transitions"""


def _idx(topic: str, itype: str, ts: str, compat: bool = False) -> str:
    local = f"({ts} + INTERVAL 8 HOUR)"
    month = "'%-d%m6.%m'" if compat else "'%Y.%m'"
    return (f"(CASE {itype} WHEN 'yyyy.MM.dd' THEN {topic} || '_' || strftime({local}, '%Y.%m.%d') "
            f"WHEN 'yyyy' THEN {topic} || '_' || strftime({local}, '%Y') "
            f"WHEN 'yyyy.MM' THEN {topic} || '_' || strftime({local}, {month}) ELSE {topic} END)")


def _with(body: str, derived: list[str], extra: list[tuple[str, str]] = ()) -> str:
    ctes = D.sql_ctes()
    parts = [f"{n} AS ({ctes[n]})" for n in derived] + [f"{n} AS ({q})" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


_EV = [("events", _EVENTS)]
_TR = _EV + [("transitions", _TRANSITIONS)]

_PUT_NAME = f"substr(key, {_L + 1})"

ORACLE: dict[str, str] = {
    "routed_counts": _with(f"""
        SELECT {_idx('r.topic', 'j.index_type', 'r.ts')} AS index, j.pipeline, count(*) AS records
        FROM records r JOIN running j ON r.topic = j.topic GROUP BY ALL""",
                           ["records", "changes"], _EV + [("running", _RUNNING)]),
    "index_names": f"""
        SELECT event_id,
               {_idx('event_type', "['yyyy.MM.dd', 'yyyy', 'yyyy.MM', '', 'hourly'][event_id % 5 + 1]", 'ts')}
                 AS index,
               {_idx('event_type', "['yyyy.MM.dd', 'yyyy', 'yyyy.MM', '', 'hourly'][event_id % 5 + 1]", 'ts',
                     compat=True)} AS index_compat
        FROM events""",
    "flush_batches": _with(f"""
        SELECT topic, "partition", tick_start, batch_seq, count(*) AS rows,
               min("offset") AS first_offset, max("offset") AS last_offset
        FROM (SELECT *, date_trunc('day', ts) AS tick_start,
                     CAST((row_number() OVER (PARTITION BY topic, "partition", date_trunc('day', ts)
                                              ORDER BY "offset") - 1) // {FLUSH_ROWS} AS BIGINT) AS batch_seq
              FROM records) GROUP BY ALL""", ["records"]),
    "throughput": _with("""
        SELECT t.tick, CAST(t.rows AS BIGINT) AS rows, CAST(t.rows_total AS BIGINT) AS rows_total,
               CAST(coalesce(a.active_jobs, 0) AS BIGINT) AS jobs
        FROM tot t ASOF LEFT JOIN active a ON t.tick + INTERVAL 1 HOUR >= a.ts""",
                        ["records", "changes"], _TR + [
                            ("active", _ACTIVE),
                            ("per", "SELECT date_trunc('hour', ts) AS tick, count(*) AS rows FROM records GROUP BY 1"),
                            ("spine", "SELECT unnest(generate_series((SELECT min(tick) FROM per), "
                                      "(SELECT max(tick) FROM per), INTERVAL 1 HOUR)) AS tick"),
                            ("tot", "SELECT s.tick, coalesce(p.rows, 0) AS rows, "
                                    "sum(coalesce(p.rows, 0)) OVER (ORDER BY s.tick) AS rows_total "
                                    "FROM spine s LEFT JOIN per p ON s.tick = p.tick")]),
    "job_state": _with("""
        SELECT key, name, revision, ts, job_name, topic, index_type, pipeline
        FROM state WHERE op = 'PUT' AND NOT g_bad""", ["changes"], [("state", _STATE)]),
    "prior_image": _with("""
        SELECT revision, key, op,
               CASE WHEN ok THEN p_job_name END AS prior_job_name, CASE WHEN ok THEN p_topic END AS prior_topic,
               CASE WHEN ok THEN p_index_type END AS prior_index_type,
               CASE WHEN ok THEN p_pipeline END AS prior_pipeline
        FROM (SELECT revision, key, op,
                     coalesce(lag(op) OVER w = 'PUT' AND NOT lag(g_bad) OVER w, false) AS ok,
                     lag(g_job_name) OVER w AS p_job_name, lag(g_topic) OVER w AS p_topic,
                     lag(g_index_type) OVER w AS p_index_type, lag(g_pipeline) OVER w AS p_pipeline
              FROM changes WINDOW w AS (PARTITION BY key ORDER BY revision))""", ["changes"]),
    "active_job_count": _with("SELECT * FROM active", ["changes"], _TR + [("active", _ACTIVE)]),
    "request_codes": _with("""
        SELECT DISTINCT req_id, CASE WHEN kind IN (0, 1) THEN 0 WHEN kind = 2 THEN -1 ELSE -2 END AS code
        FROM request_rows""", ["request_rows"]),
    "request_fanout": _with("""
        SELECT req_id, 'conv_' || CAST(conv_id AS VARCHAR) AS topic, pos, text AS log
        FROM request_rows WHERE kind IN (0, 1)""", ["request_rows"]),
    "liveness": _with("""
        SELECT topic, owner, min(ts) AS session_start, max(ts) AS last_beat,
               max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(sum(n) AS BIGINT) AS beats
        FROM (SELECT *, sum(new) OVER (PARTITION BY topic, owner ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
              FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                                   THEN 1 ELSE 0 END AS new
                    FROM (SELECT topic, owner, ts, count(*) AS n FROM heartbeats GROUP BY ALL)
                    WINDOW w AS (PARTITION BY topic, owner ORDER BY ts)))
        GROUP BY topic, owner, sid""", ["heartbeats"]),
    "unclaimed_jobs": _with("""
        SELECT key, name, 1 AS event_type, job_name, topic, index_type, pipeline
        FROM state WHERE op = 'PUT' AND NOT g_bad
          AND topic NOT IN (SELECT DISTINCT topic FROM sessions
                            WHERE session_start <= (SELECT max(ts) FROM heartbeats)
                              AND (SELECT max(ts) FROM heartbeats) <= session_end)""",
                            ["changes", "heartbeats"], [("state", _STATE), ("sessions", """
        SELECT topic, owner, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end
        FROM (SELECT *, sum(new) OVER (PARTITION BY topic, owner ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
              FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                                   THEN 1 ELSE 0 END AS new
                    FROM heartbeats WINDOW w AS (PARTITION BY topic, owner ORDER BY ts)))
        GROUP BY topic, owner, sid""")]),
    "route_as_of": _with(f"""
        SELECT j.topic, j."partition", j."offset", j.ver AS version, e.job_name, e.pipeline,
               {_idx('j.topic', 'e.index_type', 'j.ts')} AS index
        FROM (SELECT r.topic, r."partition", r."offset", r.ts, m.ver
              FROM records r ASOF JOIN marks m ON r.topic = m.topic AND r.ts >= m.ts) j
        JOIN events e ON e.revision = j.ver""", ["records", "changes"], _EV + [("marks", """
        SELECT topic, ts, min(CASE WHEN event_type = 1 THEN revision END)
                 OVER (PARTITION BY topic ORDER BY revision ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ver
        FROM events
        UNION ALL
        SELECT topic, TIMESTAMP '1900-01-01 00:00:00' AS ts, min(revision) AS ver
        FROM events WHERE event_type = 1 GROUP BY topic""")]),
    "first_claim": _with("""
        SELECT topic, day, owner, claimed_at, attempts
        FROM (SELECT topic, CAST(ts AS DATE) AS day, owner, ts AS claimed_at,
                     count(*) OVER (PARTITION BY topic, CAST(ts AS DATE)) AS attempts,
                     row_number() OVER (PARTITION BY topic, CAST(ts AS DATE) ORDER BY ts, owner) AS rn
              FROM heartbeats) WHERE rn = 1""", ["heartbeats"]),
    "claim_winners": _with("""
        SELECT topic, arg_min(owner, (ts, owner)) AS owner, min(ts) AS claimed_at,
               max(ts) + INTERVAL 30 MINUTE AS expires_at, count(*) AS attempts,
               count(DISTINCT owner) - 1 AS refused_owners
        FROM (SELECT *, sum(new) OVER (PARTITION BY topic ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
              FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                                   THEN 1 ELSE 0 END AS new
                    FROM heartbeats WINDOW w AS (PARTITION BY topic ORDER BY ts, owner)))
        GROUP BY topic, sid""", ["heartbeats"]),
    "snapshot_tail": _with("""
        SELECT 0 AS phase, revision, ts, key, 1 AS event_type, job_name, topic, index_type, pipeline
        FROM (SELECT key, revision, ts, op, g_bad, g_job_name AS job_name, g_topic AS topic,
                     g_index_type AS index_type, g_pipeline AS pipeline
              FROM changes WHERE revision <= (SELECT max(revision) // 2 FROM changes)
              QUALIFY row_number() OVER (PARTITION BY key ORDER BY revision DESC) = 1)
        WHERE op = 'PUT' AND NOT g_bad
        UNION ALL
        SELECT 1 AS phase, revision, ts, key, event_type, job_name, topic, index_type, pipeline
        FROM events WHERE revision > (SELECT max(revision) // 2 FROM changes)""", ["changes"], _EV),
    "delete_all_survivors": _with("""
        SELECT key, name, revision, NOT g_bad AS decodable FROM state
        WHERE op = 'PUT' AND name NOT IN (SELECT topic FROM state WHERE op = 'PUT' AND NOT g_bad)""",
                                  ["changes"], [("state", _STATE)]),
    "effective_deletes": _with("""
        SELECT revision, ts, key, topic FROM transitions WHERE event_type = 2 AND running_before""",
                               ["changes"], _TR),
    "running_topics": _with("SELECT * FROM running", ["changes"], _EV + [("running", _RUNNING)]),
    "claims_distinct": "SELECT DISTINCT event_type AS topic FROM events",
    "job_events": _with("SELECT revision, ts, key, event_type, topic, job_name, index_type, pipeline FROM events",
                        ["changes"], _EV),
    "key_names": _with(f"""
        SELECT revision, key, substr(key, {_L + 1}) AS name, key AS name_other_prefix FROM changes""",
                       ["changes"]),
    "job_decode": _with("""
        SELECT revision, NOT g_bad AS decodable,
               CASE WHEN NOT g_bad THEN g_job_name END AS job_name, CASE WHEN NOT g_bad THEN g_topic END AS topic,
               CASE WHEN NOT g_bad THEN g_index_type END AS index_type,
               CASE WHEN NOT g_bad THEN g_pipeline END AS pipeline
        FROM changes WHERE op = 'PUT'""", ["changes"]),
    "job_puts": _with(f"""
        SELECT revision, CASE WHEN revision % 4 IN (0, 1) THEN 0 ELSE -1 END AS code,
               CASE WHEN revision % 4 IN (0, 1) THEN {_PUT_NAME} END AS key,
               CASE WHEN revision % 4 IN (0, 1) THEN g_job_name END AS job_name,
               CASE WHEN revision % 4 IN (0, 1) THEN g_topic END AS topic,
               CASE WHEN revision % 4 = 0 THEN g_pipeline WHEN revision % 4 = 1 THEN '' END AS pipeline,
               CASE WHEN revision % 4 = 0 THEN g_index_type WHEN revision % 4 = 1 THEN '' END AS index_type
        FROM changes WHERE op = 'PUT' AND NOT g_bad""", ["changes"]),
    "bulk_deletes": _with(f"""
        SELECT revision, 0 AS code, CAST(0 AS INTEGER) AS pos, {_PUT_NAME} AS key
        FROM changes WHERE op = 'DELETE' AND revision % 3 = 0
        UNION ALL
        SELECT revision, 0 AS code, CAST(1 AS INTEGER) AS pos, {_PUT_NAME} || '_old' AS key
        FROM changes WHERE op = 'DELETE' AND revision % 3 = 0
        UNION ALL
        SELECT revision, CASE WHEN revision % 3 = 1 THEN 0 ELSE -1 END AS code,
               CAST(NULL AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS key
        FROM changes WHERE op = 'DELETE' AND revision % 3 <> 0""", ["changes"]),
    "removed_jobs": _with(f"""
        SELECT revision, pos, {_PUT_NAME} AS key,
               CASE WHEN ok THEN p_job_name END AS removed_job_name, CASE WHEN ok THEN p_topic END AS removed_topic,
               CASE WHEN ok THEN p_index_type END AS removed_index_type,
               CASE WHEN ok THEN p_pipeline END AS removed_pipeline
        FROM (SELECT revision, pos, key, coalesce(lag(op) OVER w = 'PUT' AND NOT lag(g_bad) OVER w, false) AS ok,
                     lag(g_job_name) OVER w AS p_job_name, lag(g_topic) OVER w AS p_topic,
                     lag(g_index_type) OVER w AS p_index_type, lag(g_pipeline) OVER w AS p_pipeline
              FROM (SELECT *, CAST(-1 AS INTEGER) AS pos FROM changes WHERE op = 'PUT'
                    UNION ALL
                    SELECT *, CAST(0 AS INTEGER) AS pos FROM changes WHERE op = 'DELETE' AND revision % 3 = 0
                    UNION ALL
                    SELECT * REPLACE (key || '_old' AS key), CAST(1 AS INTEGER) AS pos
                    FROM changes WHERE op = 'DELETE' AND revision % 3 = 0)
              WINDOW w AS (PARTITION BY key ORDER BY revision, pos))
        WHERE pos >= 0""", ["changes"]),
    "severity_filter": _with(f"SELECT * FROM log_messages WHERE level <= {MAX_LEVEL}", ["log_messages"]),
    "log_line": _with("""
        SELECT ts, level, line,
               '[' || ['DEBUG', 'INFO', 'WARN', 'ERROR', 'FATAL'][level + 1] || '][' ||
               regexp_extract(file, '[^/]*$') || ':' || CAST(line AS VARCHAR) || '] ' ||
               strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S') || ' [' || msg || ']' AS line_text
        FROM log_messages""", ["log_messages"]),
    "decode_values": _with('SELECT topic, "partition", "offset", doc FROM records', ["records"]),
    "named_transforms": _with("""
        SELECT r.topic, r."partition", r."offset", j.pipeline,
               CASE j.pipeline WHEN 'urgent' THEN upper(r.doc) WHEN 'high' THEN 'high:' || r.doc ELSE r.doc END
                 AS doc
        FROM records r JOIN running j ON r.topic = j.topic
        WHERE NOT (j.pipeline = 'low' AND r."partition" = 0)""", ["records", "changes"],
                              _EV + [("running", _RUNNING)]),
}


# ---- queries that go through sinks and streams ----------------------------
# Each writes its input under the shared checkpoint folder, runs the sink or
# stream to completion (``availableNow``) and reads the written table back.

def request_topics(spark: SparkSession, d: str) -> DataFrame:
    """S1 -> P1 -> P2 -> S3: report bodies fanned out to topic records."""
    src, out = scratch_path(spark, "requests"), scratch_path(spark, "topics")
    D.requests(spark, d).write.parquet(src)
    lines = ingest.explode_logs(ingest.validate_requests(readers.read_requests(spark, src, fmt="parquet")))
    writers.write_topic(ingest.to_records(lines), path=out)
    back = spark.read.schema("value binary, topic string").parquet(out)
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("records"),
                                     F.sum(F.length(F.col("value").cast("string"))).alias("chars"))


def request_stream(spark: SparkSession, d: str) -> DataFrame:
    """The write path as a stream (S1 -> P1 -> P2 -> S3) over text files, one
    body a line (a body's closing line break is the line's own)."""
    src, topics, rejected, ck = (scratch_path(spark, n) for n in ("requests", "topics", "rejected", "ckpt"))
    D.requests(spark, d).select(F.regexp_replace("body", "\n$", "")).repartition(2).write.text(src)
    stream = readers.read_requests(spark, src, streaming=True, max_files_per_trigger=1)
    ingest_stream(stream, topics, rejected, ck, trigger={"availableNow": True}).awaitTermination()
    back = spark.read.schema("value binary, batch_id long, topic string").parquet(topics)
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("records"),
                                     F.sum(F.length(F.col("value").cast("string"))).alias("chars"))


def _feed(spark: SparkSession, changes: DataFrame, path: str) -> DataFrame:
    """The change feed as a stream over ``path``, with ``changes`` added."""
    changes.write.mode("append").parquet(path)
    return readers.read_job_changes(spark, path)


def collect_stream(spark: SparkSession, d: str) -> DataFrame:
    """T2 over a record stream (S2 file form) and the change feed into the
    index sink (S4), in several micro-batches."""
    src, feed, out, ck = (scratch_path(spark, n) for n in ("records", "changes", "index", "ckpt"))
    recs = D.records(spark, d)
    files = max(4, min(SET_FILES, recs.count() // FILE_ROWS))
    recs.repartition(files, "topic", "partition", F.floor(F.col("offset") / FILE_ROWS)).write.parquet(src)
    stream = readers.read_topics(spark, path=src, streaming=True, max_files_per_trigger=files // 2)
    q = collect(stream, topic_events(_feed(spark, D.changes(spark, d), feed)), writers.index_writer(out), ck,
                trigger={"availableNow": True}, index_time="record")
    q.awaitTermination()
    back = writers.read_index(spark, out, "pipeline string, doc string")
    return back.groupBy("index", "pipeline").agg(F.count(F.lit(1)).alias("records"))


def _collect_late(spark: SparkSession, d: str) -> tuple[str, str]:
    """Index and checkpoint of a collector that runs twice: half of the
    records arrive when a tenth of the changes is known, the rest of both
    comes with the second run.  Records of a topic without a job wait."""
    feed, src, out, ck = (scratch_path(spark, n) for n in ("changes", "records", "index", "ckpt"))
    ch, recs = D.changes(spark, d), D.records(spark, d)
    early = F.col("revision") <= F.floor(ch.agg(F.max("revision")).scalar() / LATE_PART)
    for known, arrived in ((early, F.col("offset") % 2 == 0), (~early, F.col("offset") % 2 == 1)):
        recs.filter(arrived).write.mode("append").parquet(src)
        collect(readers.read_topics(spark, path=src), topic_events(_feed(spark, ch.filter(known), feed)),
                writers.index_writer(out), ck, trigger={"availableNow": True}, index_time="record").awaitTermination()
    return out, ck


def collect_late_job(spark: SparkSession, d: str) -> DataFrame:
    """T2 with jobs that come after their topic's records."""
    out, _ = _collect_late(spark, d)
    back = writers.read_index(spark, out, "topic string, partition int, offset long, pipeline string, doc string")
    return back.select("topic", "partition", "offset", "index", "pipeline", "doc")


def collector_state(spark: SparkSession, d: str) -> DataFrame:
    """A5 from the collector's own state: the topics it runs, and how many
    records wait for each topic without a job."""
    _, ck = _collect_late(spark, d)
    waits = waiting_records(spark, ck).groupBy("topic").agg(F.count(F.lit(1)).alias("waiting"))
    return (collected_jobs(spark, ck).select("topic", "revision", "job_name").join(waits, "topic", "full")
            .fillna(0, ["waiting"]))


def job_state_stream(spark: SparkSession, d: str) -> DataFrame:
    """S7 -> T1: the change feed folded by a streaming aggregate in two runs,
    then A4 over its state."""
    src, ck = (scratch_path(spark, n) for n in ("changes", "ckpt"))
    ch = D.changes(spark, d).repartitionByRange(4, "revision")
    for half in (F.col("revision") % 2 == 0, F.col("revision") % 2 == 1):
        ch.filter(half).write.mode("append").parquet(src)
        fold_changes(readers.read_job_changes(spark, src, max_files_per_trigger=2), ck,
                     trigger={"availableNow": True}).awaitTermination()
    return current_jobs(spark, ck)


def running_topics_stream(spark: SparkSession, d: str) -> DataFrame:
    """T1 -> A5: job events folded by topic, the table read from the state."""
    src, ck = (scratch_path(spark, n) for n in ("changes", "ckpt"))
    D.changes(spark, d).repartitionByRange(3, "revision").write.parquet(src)
    fold_running(readers.read_job_changes(spark, src, max_files_per_trigger=2), ck,
                 trigger={"availableNow": True}).awaitTermination()
    return current_running(spark, ck).select("topic", "revision", "key", "job_name", "index_type", "pipeline")


def _by_time(df: DataFrame, path: str, parts: int) -> int:
    """``df`` as ``parts`` sets of files of rising ``ts``, written one after
    another.  Returns how many files each set has, so that a stream of so many
    files a trigger reads set by set."""
    spark, dealt = df.sparkSession, scratch_path(df.sparkSession, "dealt")
    lo, hi, rows = df.agg(F.min(micros("ts")), F.max(micros("ts")), F.count("ts")).first()
    files = min(SET_FILES, rows // (parts * FILE_ROWS) + 1)
    part = F.least(F.floor((micros("ts") - lo) * parts / max(hi - lo, 1)), F.lit(parts - 1)).cast("int")
    df.withColumn("set", part).write.partitionBy("set").parquet(dealt)
    back = spark.read.schema(df.withColumn("set", F.lit(0)).schema).parquet(dealt)
    for k in range(parts):
        mine = back.filter(F.col("set") == k).drop("set")
        (mine.repartition(files) if files > 1 else mine.coalesce(1)).write.mode("append").parquet(path)
        # a task without rows writes no file: empty ones fill up the set
        for _ in range((k + 1) * files - len(spark.read.schema(df.schema).parquet(path).inputFiles())):
            mine.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files


def _write_stream(df: DataFrame, out: str, ck: str) -> None:
    with operator_state(df.sparkSession):
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def flush_batches_stream(spark: SparkSession, d: str) -> DataFrame:
    """W1 on a stream: ticks whose records come in several micro-batches are
    cut as the whole table is."""
    src, out, ck = (scratch_path(spark, n) for n in ("records", "flushed", "ckpt"))
    recs = D.records(spark, d)
    for k in range(2):  # by offset: the two halves share ticks
        last = recs.groupBy("topic", "partition").agg((F.max("offset") / 2).alias("half"))
        half = recs.join(last, ["topic", "partition"]).filter((F.col("offset") > F.col("half")) == F.lit(k == 1))
        half.drop("half").coalesce(1).write.mode("append").parquet(src)
    stream = readers.read_topics(spark, path=src, max_files_per_trigger=1)
    cut = assign_batches_stream(stream, max_rows=FLUSH_ROWS, max_wait=FLUSH_WAIT)
    _write_stream(cut.select("topic", "partition", "offset", "tick", "batch_seq"), out, ck)
    back = spark.read.schema("topic string, partition int, offset long, tick long, batch_seq long").parquet(out)
    return batching.flush_counts(back, max_wait=FLUSH_WAIT)


def throughput_live(spark: SparkSession, d: str) -> DataFrame:
    """A2 as one stream of chained stateful operators."""
    src, feed, out, ck = (scratch_path(spark, n) for n in ("records", "changes", "report", "ckpt"))
    recs, ch = D.records(spark, d), D.changes(spark, d)
    rec_files, ch_files = _by_time(recs, src, 3), _by_time(ch, feed, 3)
    recs, ch = readers.read_topics(spark, path=src, streaming=False), readers.read_job_changes(spark, feed, streaming=False)
    # the clock goes on: a last record and event close the ticks before them
    end = F.greatest(recs.agg(F.max("ts")).scalar(), ch.agg(F.max("ts")).scalar()) + F.expr("interval 2 days")
    (recs.limit(1).select(F.lit("-").alias("topic"), "partition", "offset", end.alias("ts"), "value")
     .write.mode("append").parquet(src))
    (ch.limit(1).select("revision", F.lit("DELETE").alias("op"), F.concat("key", F.lit("-clock")).alias("key"),
                        F.lit(None).cast("string").alias("value"), end.alias("ts")).write.mode("append").parquet(feed))
    report = throughput_stream(readers.read_topics(spark, path=src, max_files_per_trigger=rec_files),
                               topic_events(readers.read_job_changes(spark, feed, max_files_per_trigger=ch_files)),
                               REPORT_EVERY)
    _write_stream(report, out, ck)
    return spark.read.schema("tick timestamp_ntz, rows long, rows_total long, jobs long").parquet(out)


def daily_log_files(spark: SparkSession, d: str) -> DataFrame:
    """Process-log lines appended to one folder per day."""
    out = scratch_path(spark, "daily")
    writers.write_daily_log(D.log_messages(spark, d), out)
    back = spark.read.schema("value string, day date").text(out)
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("lines"), F.min("value").alias("first_line"))


def fan_out_sinks(spark: SparkSession, d: str) -> DataFrame:
    """The same rows to two sinks, each read back."""
    a, b = scratch_path(spark, "fan_a"), scratch_path(spark, "fan_b")
    rows = ingest.decode_value(D.records(spark, d)).select("topic", "partition", "offset", "doc")
    writers.fan_out(rows, [lambda df: df.write.parquet(a), lambda df: df.write.json(b)])
    pa = spark.read.schema("topic string, doc string").parquet(a).withColumn("sink", F.lit("parquet"))
    pb = spark.read.schema("topic string, doc string").json(b).withColumn("sink", F.lit("json"))
    return pa.unionByName(pb).groupBy("sink", "topic").agg(F.count(F.lit(1)).alias("records"))


def log_fan_out(spark: SparkSession, d: str) -> DataFrame:
    """P11 -> S9 -> (console lines, S8 daily files): the process logger's outputs."""
    con, daily = scratch_path(spark, "console"), scratch_path(spark, "daily")
    kept = logs.severity_filter(D.log_messages(spark, d), max_level=MAX_LEVEL)
    writers.fan_out(kept, [
        lambda df: logs.log_lines(df, sink="console").select(F.to_date("ts").alias("day"), F.col("line_text"))
        .write.partitionBy("day").text(con),
        lambda df: writers.write_daily_log(df, daily)])
    a = spark.read.schema("value string, day date").text(con).withColumn("sink", F.lit("console"))
    b = spark.read.schema("value string, day date").text(daily).withColumn("sink", F.lit("file"))
    return a.unionByName(b).groupBy("sink", "day").agg(F.count(F.lit(1)).alias("lines"))


QUERIES.update({
    "log_fan_out": log_fan_out,
    "request_topics": request_topics,
    "request_stream": request_stream,
    "collect_stream": collect_stream,
    "collect_late_job": collect_late_job,
    "collector_state": collector_state,
    "running_topics_stream": running_topics_stream,
    "flush_batches_stream": flush_batches_stream,
    "throughput_live": throughput_live,
    "job_state_stream": job_state_stream,
    "daily_log_files": daily_log_files,
    "fan_out_sinks": fan_out_sinks,
})

_FILE_LINE = """'[' || ['DEBUG', 'INFO', 'WARN', 'ERROR', 'FATAL'][level + 1] || '][' ||
               regexp_extract(file, '[^/]*$') || ':' || CAST(line AS VARCHAR) || '] ' ||
               strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%Y/%m/%d %H:%M:%S') || ' [' || msg || ']'"""

ORACLE.update({
    "request_topics": _with("""
        SELECT 'conv_' || CAST(conv_id AS VARCHAR) AS topic, count(*) AS records,
               CAST(sum(length(text)) AS BIGINT) AS chars
        FROM request_rows WHERE kind IN (0, 1) GROUP BY 1""", ["request_rows"]),
    "collect_stream": ORACLE["routed_counts"],
    "collect_late_job": _with(f"""
        SELECT topic, "partition", "offset", {_idx('topic', 'index_type', 'ts')} AS index, pipeline, doc
        FROM (SELECT r.*, coalesce(e.index_type, l.index_type) AS index_type,
                     coalesce(e.pipeline, l.pipeline) AS pipeline
              FROM records r LEFT JOIN early e ON r.topic = e.topic AND r."offset" % 2 = 0
              LEFT JOIN running l ON r.topic = l.topic
              WHERE e.topic IS NOT NULL OR l.topic IS NOT NULL)""", ["records", "changes"], _EV + [
                  ("running", _RUNNING),
                  ("early", f"""
        SELECT topic, index_type, pipeline FROM events
        WHERE revision <= (SELECT max(revision) // {LATE_PART} FROM changes)
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY revision DESC) = 1 AND event_type = 1""")]),
    "job_state_stream": ORACLE["job_state"],
    "daily_log_files": _with(f"""
        SELECT CAST(ts AS DATE) AS day, count(*) AS lines, min({_FILE_LINE}) AS first_line
        FROM log_messages GROUP BY 1""", ["log_messages"]),
    "fan_out_sinks": """
        SELECT 'parquet' AS sink, event_type AS topic, count(*) AS records FROM events GROUP BY ALL
        UNION ALL
        SELECT 'json' AS sink, event_type AS topic, count(*) AS records FROM events GROUP BY ALL""",
})
ORACLE["request_stream"] = ORACLE["request_topics"]
ORACLE["running_topics_stream"] = ORACLE["running_topics"]
ORACLE["flush_batches_stream"] = ORACLE["flush_batches"]
ORACLE["throughput_live"] = ORACLE["throughput"]
ORACLE["collector_state"] = _with(f"""
        SELECT coalesce(l.topic, w.topic) AS topic, l.revision, l.job_name, coalesce(w.waiting, 0) AS waiting
        FROM running l FULL JOIN (
            SELECT topic, count(*) AS waiting FROM records r
            WHERE NOT EXISTS (SELECT 1 FROM running l WHERE l.topic = r.topic)
              AND NOT (r."offset" % 2 = 0 AND EXISTS (SELECT 1 FROM early e WHERE e.topic = r.topic))
            GROUP BY topic) w ON l.topic = w.topic""", ["records", "changes"], _EV + [
                ("running", _RUNNING),
                ("early", f"""
        SELECT topic FROM events
        WHERE revision <= (SELECT max(revision) // {LATE_PART} FROM changes)
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY revision DESC) = 1 AND event_type = 1""")])
ORACLE["log_fan_out"] = _with(f"""
    SELECT 'console' AS sink, CAST(ts AS DATE) AS day, count(*) AS lines FROM log_messages
    WHERE level <= {MAX_LEVEL} GROUP BY 2
    UNION ALL
    SELECT 'file' AS sink, CAST(ts AS DATE) AS day, count(*) AS lines FROM log_messages
    WHERE level <= {MAX_LEVEL} GROUP BY 2""", ["log_messages"])
# the lock chain, followed one tenure at a time by a recursive query
ORACLE["lock_holders"] = f"""
WITH RECURSIVE heartbeats AS ({D.sql_ctes()['heartbeats']}),
beats AS (SELECT DISTINCT topic, owner, ts FROM heartbeats),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new
      FROM beats WINDOW w AS (PARTITION BY topic, owner ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY topic, owner ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
lab AS (SELECT topic, owner, ts, max(ts) OVER (PARTITION BY topic, owner, sid) + INTERVAL 30 MINUTE AS end_ts FROM s),
att AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY topic, ts ORDER BY owner) = 1),
chain AS (
  SELECT topic, owner, ts AS claimed_at, end_ts AS expires_at FROM att
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY ts, owner) = 1
  UNION ALL
  SELECT n.topic, n.owner, n.ts, n.end_ts
  FROM chain c JOIN LATERAL (SELECT * FROM att a WHERE a.topic = c.topic AND a.ts > c.expires_at
                             ORDER BY a.ts LIMIT 1) n ON true)
SELECT topic, owner, claimed_at, expires_at FROM chain"""
