"""Engine inputs derived from the driver's tables.

The reference reads a broker, a key-value registry and HTTP bodies; none of
them exist here, so each is derived from a given table, once in Spark and once
as SQL text for the DuckDB oracle (same rules, written twice):

- ``records``     topic records, from ``events``
- ``changes``     registry change log, from ``orders``
- ``requests``    log report bodies, from ``conversations``
- ``heartbeats``  claim renewals, from ``events``
- ``log_messages`` process-log messages, from ``events``

All derivations keep every input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.functions.keys import JOBS_PREFIX, LOCKS_PREFIX
from logflow.plans import scan

PARTITIONS = 4          # broker partitions per topic
KEY_SPACE = 500         # registry names
CHANGE_EVERY_S = 180    # one registry change every 3 minutes from 2024-01-01
TURNS_PER_REQUEST = 4   # conversation turns per report body
OWNERS = 3              # collectors renewing claims

# Topic names of the driver's events table: registry names 0..4 use them so
# that jobs and records meet.
EVENT_TOPICS = ("click", "error", "purchase", "signup", "view")
INDEX_TYPES = ("yyyy.MM.dd", "yyyy", "yyyy.MM", "", "hourly")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name(name_id: Column) -> Column:
    known = F.element_at(F.array(*[F.lit(t) for t in EVENT_TOPICS]), (name_id + 1).cast("int"))
    return F.when(name_id < len(EVENT_TOPICS), known).otherwise(F.concat(F.lit("topic_"), name_id.cast("string")))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, partition, offset, ts, value`` -- one record per event."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        "event_id", "ts", F.col("props").cast("binary").alias("value"))
    ev = scan.row_number(ev, ["topic", "partition"], "event_id", out="__rn")
    return ev.select("topic", "partition", (F.col("__rn") - 1).alias("offset"), "ts", "value")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``revision, op, key, value, ts`` -- one registry change per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                      "o_orderpriority")
    name_id = F.col("o_custkey") % KEY_SPACE
    name = _name(name_id)
    topic = F.when(F.col("o_orderpriority") == "5-LOW", _name((name_id + 1) % KEY_SPACE)).otherwise(name)
    itype = F.element_at(F.array(*[F.lit(t) for t in INDEX_TYPES]),
                         (F.col("o_custkey") % len(INDEX_TYPES) + 1).cast("int"))
    pipe = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("")).otherwise(
        F.lower(F.substring("o_orderpriority", 3, 100)))
    job_name = F.concat(F.lit("job_"), F.col("o_orderkey").cast("string"))
    topic_field = F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O"),
                         F.lit('"Topic":"')).otherwise(F.lit('"topic":"'))
    good = F.concat(F.lit('{"job_name":"'), job_name, F.lit('",'), topic_field, topic,
                    F.lit('","index_type":"'), itype, F.lit('","pipeline":"'), pipe, F.lit('"}'))
    bad = F.concat(F.lit('{"job_name":"'), job_name, F.lit('","topic":'),
                   F.col("o_orderkey").cast("string"), F.lit("}"))
    is_delete = F.col("o_orderstatus") == "F"
    value = (F.when(is_delete, F.lit(None).cast("string"))
             .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), bad)
             .otherwise(good))
    return o.select(
        (F.col("o_orderkey") + 1).alias("revision"),
        F.when(is_delete, F.lit("DELETE")).otherwise(F.lit("PUT")).alias("op"),
        F.concat(F.lit(JOBS_PREFIX), name).alias("key"),
        value.alias("value"),
        F.timestamp_add("SECOND", F.col("o_orderkey") * CHANGE_EVERY_S,
                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``req_id, received_at, body`` -- report bodies of up to four turns each.

    The body kind follows ``(conv_id + chunk) % 5``: 0 plain, 1 reordered with an
    extra field and padding, 2 trailing text, 3 a number among the logs,
    4 a numeric topic.
    """
    c = table(spark, sf_dir, "conversations")
    chunk = (F.col("turn") / TURNS_PER_REQUEST).cast("long")
    g = (c.groupBy("conv_id", chunk.alias("chunk"))
         .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("__t")))
    logs = F.to_json(F.transform("__t", lambda x: x["text"]))
    topic = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"))
    kind = (F.col("conv_id") + F.col("chunk")) % 5
    body = (F.when(kind == 0, F.concat(F.lit('{"topic":"'), topic, F.lit('","logs":'), logs, F.lit("}")))
            .when(kind == 1, F.concat(F.lit(' {"logs":'), logs, F.lit(',"extra":{"n":1},"topic":"'), topic,
                                      F.lit('"}\n')))
            .when(kind == 2, F.concat(F.lit('{"topic":"'), topic, F.lit('","logs":'), logs, F.lit("} trailing")))
            .when(kind == 3, F.concat(F.lit('{"topic":"'), topic, F.lit('","logs":[1,'),
                                      F.expr("substring(to_json(transform(__t, x -> x.text)), 2)"), F.lit("}")))
            .otherwise(F.concat(F.lit('{"topic":'), F.col("conv_id").cast("string"), F.lit(',"logs":'), logs,
                                F.lit("}"))))
    return g.select(
        (F.col("conv_id") * 1_000_000 + F.col("chunk")).alias("req_id"),
        F.timestamp_add("SECOND", F.col("conv_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("received_at"),
        body.alias("body"))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, owner, ts`` -- claim renewals."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("topic"),
                    F.concat(F.lit("collector-"), (F.col("user_id") % OWNERS).cast("string")).alias("owner"),
                    "ts")


def lock_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, value`` -- lock entries as the registry lists them."""
    return heartbeats(spark, sf_dir).select(F.concat(F.lit(LOCKS_PREFIX), "topic").alias("key"),
                                            F.lit("lock").alias("value"))


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``level, file, line, ts, msg`` -- one process-log message per event."""
    e = table(spark, sf_dir, "events")
    return e.select((F.abs(F.floor("value")) % 5).cast("int").alias("level"),
                    F.concat(F.lit("/src/collector/"), "event_type", F.lit(".go")).alias("file"),
                    F.col("user_id").cast("int").alias("line"), "ts", F.col("props").alias("msg"))


# ---- the same derivations as DuckDB SQL (views named like the functions) ----

def _sql_name(e: str) -> str:
    lst = ", ".join(f"'{t}'" for t in EVENT_TOPICS)
    return f"(CASE WHEN {e} < {len(EVENT_TOPICS)} THEN [{lst}][({e}) + 1] ELSE 'topic_' || CAST({e} AS VARCHAR) END)"


def sql_ctes() -> dict[str, str]:
    itypes = ", ".join(f"'{t}'" for t in INDEX_TYPES)
    name = _sql_name("o_custkey % 500")
    topic = (f"(CASE WHEN o_orderpriority = '5-LOW' THEN {_sql_name('(o_custkey % 500 + 1) % 500')} "
             f"ELSE {name} END)")
    pipe = "(CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE lower(substr(o_orderpriority, 3, 100)) END)"
    topic_field = ("(CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' "
                   "THEN '\"Topic\":\"' ELSE '\"topic\":\"' END)")
    job_name = "('job_' || CAST(o_orderkey AS VARCHAR))"
    good = (f"'{{\"job_name\":\"' || {job_name} || '\",' || {topic_field} || {topic} || "
            f"'\",\"index_type\":\"' || [{itypes}][o_custkey % 5 + 1] || '\",\"pipeline\":\"' || {pipe} || '\"}}'")
    bad = f"'{{\"job_name\":\"' || {job_name} || '\",\"topic\":' || CAST(o_orderkey AS VARCHAR) || '}}'"
    return {
        "records": f"""
            SELECT event_type AS topic, CAST(user_id % {PARTITIONS} AS INTEGER) AS "partition",
                   CAST(row_number() OVER (PARTITION BY event_type, user_id % {PARTITIONS} ORDER BY event_id) - 1
                        AS BIGINT) AS "offset",
                   ts, props AS doc
            FROM events""",
        "changes": f"""
            SELECT o_orderkey + 1 AS revision,
                   CASE WHEN o_orderstatus = 'F' THEN 'DELETE' ELSE 'PUT' END AS op,
                   '{JOBS_PREFIX}' || {name} AS key,
                   CASE WHEN o_orderstatus = 'F' THEN NULL
                        WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN {bad}
                        ELSE {good} END AS value,
                   TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * {CHANGE_EVERY_S}) AS ts,
                   {job_name} AS g_job_name, {topic} AS g_topic, [{itypes}][o_custkey % 5 + 1] AS g_index_type,
                   {pipe} AS g_pipeline,
                   (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS g_bad
            FROM orders""",
        "heartbeats": f"""
            SELECT event_type AS topic, 'collector-' || CAST(user_id % {OWNERS} AS VARCHAR) AS owner, ts
            FROM events""",
        "log_messages": """
            SELECT CAST(abs(floor(value)) % 5 AS INTEGER) AS level,
                   '/src/collector/' || event_type || '.go' AS file,
                   CAST(user_id AS INTEGER) AS line, ts, props AS msg
            FROM events""",
        "request_rows": f"""
            SELECT conv_id * 1000000 + CAST(turn // {TURNS_PER_REQUEST} AS BIGINT) AS req_id,
                   conv_id, turn, text,
                   (conv_id + turn // {TURNS_PER_REQUEST}) % 5 AS kind,
                   CAST(row_number() OVER (PARTITION BY conv_id, turn // {TURNS_PER_REQUEST} ORDER BY turn) - 1
                        AS INTEGER) AS pos
            FROM conversations""",
    }

