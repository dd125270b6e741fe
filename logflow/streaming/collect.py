"""The continuous collector (T2): topic records -> job -> flush batches ->
index names -> transforms -> index sink.

Records and job events are one stream.  A stateful operator keyed by topic
holds the job in force (a value) and the records that wait for one (a list):
a micro-batch first applies its events, highest revision last, then sends
the waiting records and its own on with the job, or keeps them.  A job that
appears, changes or stops takes effect in the micro-batch that reads its
event, and wakes the records that waited for it; a record is delivered once,
because its place in the list is part of the state that the micro-batch
commits.  Records without a topic wait for ever.

A topic may hold a third of all records, so its records are dealt over
``shards`` keys, each of which gets the topic's events.  Only the newest event
of a topic in a micro-batch counts, so each task that reads events sends on
the newest it saw of each topic, and only these are copied to every shard.
A key's share of a micro-batch is what a task holds; the trigger's limits on
the sources bound it.

Documents are written by an idempotent ``foreachBatch`` sink.  Flush batches
are numbered inside one micro-batch, so ``batch_id, topic, partition, tick,
batch_seq`` names one; ``flush.assign_batches_stream`` numbers them across
micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import TimestampType

from logflow import schemas
from logflow.functions.timefmt import as_utc_ntz, from_micros, index_name, micros
from logflow.operators import batching, ingest, routing
from logflow.operators.jobs import EVENT_SAVE
from logflow.sinks.writers import BatchSink
from logflow.streaming.state import operator_state, read_state

SHARDS = 16
#: Events that a task holds while it looks for each topic's newest.
EVENTS_HELD = 100_000
JOB_STATE = "revision long, event_type int, key string, job_name string, index_type string, pipeline string"
WAITING = "partition int, offset long, us long, value binary"
ROUTED = f"topic string, {WAITING}, job_name string, index_type string, pipeline string"
#: Stands for null in columns that pass through pandas as whole numbers.
NO_TIME = -(1 << 63)


def collect_batch(routed: DataFrame, max_rows: int = batching.MAX_ROWS,
                  max_wait: str | float = batching.MAX_WAIT, index_time: str = "processing",
                  transforms: Mapping[str, routing.RowTransform | Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Records that have their job's fields (``routing.route``), as documents.

    ``index_time="processing"`` names indexes by the flush time (one clock
    value per micro-batch, as a collector's clock at flush); ``"record"``
    uses each record's time, which makes replays reproducible.
    """
    b = batching.assign_batches(ingest.decode_value(routed), max_rows=max_rows, max_wait=max_wait)
    if index_time == "processing":
        when = as_utc_ntz(F.current_timestamp(), TimestampType())
    else:
        when = F.col("ts")
    docs = b.withColumn("index", index_name("topic", "index_type", when))
    if transforms:
        docs = routing.apply_transforms(docs, transforms)
    return docs.select("index", "pipeline", "doc", "topic", "partition", "offset", "tick", "batch_seq")


class TopicCollector(StatefulProcessor):
    """State of one (topic, shard): its job, and the records without one."""

    def init(self, handle) -> None:
        self.job = handle.getValueState("job", JOB_STATE)
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        job = self.job.get() if self.job.exists() else None
        parts, newest = [], None
        for pdf in rows:
            events = pdf[pdf["is_event"]]
            if len(events):
                last = events.loc[events["revision"].idxmax()]
                if newest is None or last["revision"] > newest["revision"]:
                    newest = last
            parts.append(pdf.loc[~pdf["is_event"], ["partition", "offset", "us", "value"]])
        if newest is not None and (job is None or int(newest["revision"]) > job[0]):
            job = (int(newest["revision"]), int(newest["event_type"]),
                   *(newest[c] for c in ("key", "job_name", "index_type", "pipeline")))
            self.job.update(job)
        mine = pd.concat(parts)
        if job is None or job[1] != EVENT_SAVE:
            if len(mine):
                self.waiting.appendList(list(mine.itertuples(index=False, name=None)))
            return
        if self.waiting.exists():
            held = pd.DataFrame(list(self.waiting.get()), columns=mine.columns)
            self.waiting.clear()
            mine = pd.concat([held, mine])
        if len(mine):
            yield pd.DataFrame({"topic": key[0], **{c: mine[c].to_numpy() for c in mine.columns},
                                "job_name": job[3], "index_type": job[4], "pipeline": job[5]})

    def close(self) -> None:
        pass


def newest_events(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The newest event of each topic among a task's rows."""
    kept, some = None, []

    def newest() -> pd.DataFrame:
        pdf = pd.concat([*([] if kept is None else [kept]), *some], ignore_index=True)
        return pdf.loc[pdf.groupby("topic", dropna=False, sort=False)["revision"].idxmax()]

    for pdf in batches:
        some.append(pdf.loc[pdf.groupby("topic", dropna=False, sort=False)["revision"].idxmax()])
        if sum(map(len, some)) > EVENTS_HELD:
            kept, some = newest(), []
            if len(kept) > EVENTS_HELD:  # so many topics that they are passed on as they come
                yield kept
                kept = None
    if some:
        kept = newest()
    if kept is not None:
        yield kept


def _one_stream(records: DataFrame, events: DataFrame, shards: int) -> DataFrame:
    """Records and events as rows of one shape, dealt over shards."""
    def row(is_event: bool, **known: Column) -> list[Column]:
        whole = {"revision": "long", "event_type": "int", "partition": "int", "offset": "long", "us": "long"}
        text = {c: "string" for c in ("key", "job_name", "index_type", "pipeline")} | {"value": "binary"}
        return [F.lit(is_event).alias("is_event"),
                *[F.coalesce(known.get(c, F.lit(-1)).cast(t), F.lit(-1).cast(t)).alias(c) for c, t in whole.items()],
                *[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in text.items()]]

    shard = F.pmod(F.xxhash64("partition", "offset"), F.lit(shards)).cast("int")
    data = records.select("topic", shard.alias("shard"), *row(
        False, partition=F.col("partition"), offset=F.col("offset"), us=F.coalesce(micros("ts"), F.lit(NO_TIME)),
        value=F.col("value")))
    control = events.select("topic", *row(
        True, **{c: F.col(c) for c in ("revision", "event_type", "key", "job_name", "index_type", "pipeline")}))
    control = control.mapInPandas(newest_events, control.schema).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return data.unionByName(control)


def routed_stream(records: DataFrame, events: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The records of a stream with their topic's job, as soon as it has one.
    ``events``: a stream of job events (``registry.topic_events``)."""
    routed = (_one_stream(records, events, shards).groupBy("topic", "shard")
              .transformWithStateInPandas(TopicCollector(), ROUTED, "Append", "None"))
    ts = F.when(F.col("us") != NO_TIME, from_micros(F.col("us")))
    return routed.withColumn("ts", ts).select(*schemas.RECORDS.fieldNames(), "job_name", "index_type", "pipeline")


def collect(records: DataFrame, events: DataFrame, sink: BatchSink, checkpoint: str,
            trigger: dict | None = None, shards: int = SHARDS, **kwargs) -> StreamingQuery:
    """Start the collector on streams of ``records`` and of job ``events``
    (``registry.topic_events`` of the change feed).

    ``shards`` belongs to the checkpoint: keep it over restarts.  ``trigger``
    defaults to one micro-batch per second, the reference's flush timer;
    other arguments go to ``collect_batch``.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        # bounded by the trigger; kept because the flush cut reads it twice
        batch.persist()
        try:
            sink(collect_batch(batch, **kwargs), batch_id)
        finally:
            batch.unpersist()

    with operator_state(records.sparkSession):
        return (routed_stream(records, events, shards).writeStream.foreachBatch(run)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "1 second"}))
                .start())


def collected_jobs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Topics that the collector runs, with the job in force (A5), from its
    state.  Every shard has the job; shard 0 speaks for all."""
    state = read_state(spark, checkpoint, variable="job")
    if state is None:
        return spark.createDataFrame([], "topic string, " + JOB_STATE).drop("event_type")
    return (state.where("key.shard = 0").select("key.topic", "value.*").where(F.col("event_type") == EVENT_SAVE)
            .drop("event_type"))


def waiting_records(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Records that wait for a job of their topic, from the collector's state."""
    state = read_state(spark, checkpoint, variable="waiting", rows="list_element")
    if state is None:
        return spark.createDataFrame([], schemas.RECORDS)
    rows = state.select("key.topic", "value.*")
    return rows.withColumn("ts", F.when(F.col("us") != NO_TIME, from_micros(F.col("us")))).select(
        *schemas.RECORDS.fieldNames())
