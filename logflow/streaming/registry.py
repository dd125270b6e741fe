"""Registry change feed folded into a table (T1, A5 on a stream).

A streaming ``max_by`` aggregate keeps the last change of each key, or the
last job event of each topic, in the query's state; the state itself is the
table, read by ``current_jobs`` and ``current_running`` through Spark's state
data source.  Nothing else is written: no parts, no compaction, no retention.

A row keeps the highest revision, so the order in which changes arrive, a
replayed micro-batch, or a new checkpoint that reads the feed from its start
give the same table.  Deleted keys stay as rows with ``op = 'DELETE'``, so a
late change of an older revision cannot bring them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logflow import schemas
from logflow.functions.keys import JOBS_PREFIX
from logflow.operators import jobs as J
from logflow.streaming.state import read_state


def _fold(rows: DataFrame, key: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    rest = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "revision").alias("last"))
    return (last.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def _folded(spark: SparkSession, checkpoint: str, key: str, schema) -> DataFrame:
    state = read_state(spark, checkpoint)
    if state is None:
        return spark.createDataFrame([], schema)
    # the aggregate's buffer: the row of the highest revision, and the revision
    row = state.schema["value"].dataType.fields[0].name
    return state.select(f"key.{key}", f"value.{row}.*").select(*schema.fieldNames())


def fold_changes(changes: DataFrame, checkpoint: str, prefix: str = JOBS_PREFIX,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start the fold by key: the last change of each."""
    rows = J.read_jobs(changes, prefix).select(*schemas.CHANGES.fieldNames())
    return _fold(rows, "key", checkpoint, trigger)


def current_changes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last change of every key, as of the last committed micro-batch."""
    return _folded(spark, checkpoint, "key", schemas.CHANGES)


def current_jobs(spark: SparkSession, checkpoint: str, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Listed jobs of the folded table (A4 over T1)."""
    return J.job_state(current_changes(spark, checkpoint), prefix)


def topic_events(changes: DataFrame, prefix: str = JOBS_PREFIX) -> DataFrame:
    """Job events of a change feed (stream or table), one row each."""
    return J.to_job_events(changes, prefix).select(*schemas.TOPIC_EVENTS.fieldNames())


def fold_running(changes: DataFrame, checkpoint: str, prefix: str = JOBS_PREFIX,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start the fold of job events by topic: the last SAVE or DELETE of each."""
    return _fold(topic_events(changes, prefix), "topic", checkpoint, trigger)


def current_running(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Running topics with the job in force (A5 over T1)."""
    return J.running_topics(_folded(spark, checkpoint, "topic", schemas.TOPIC_EVENTS))
