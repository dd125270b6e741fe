"""Sinks (S3 S4 S8 S9) and dead letters.

Every streaming sink here is idempotent per micro-batch: a batch writes
under its own ``batch_id`` folder with overwrite, so a replay after a failure
replaces instead of duplicating, and the source position is committed only
after ``foreachBatch`` returns (no rows are lost when a write fails).
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from logflow.functions import jsoncheck as J
from logflow.functions.logline import format_log_line
from logflow.functions.timefmt import as_utc_ntz

# ---- fixed values that must equal the reference's ---------------------------
# Producer waits for all in-sync replicas.
PRODUCER_ACKS = "all"
# Bulk write attempts before the batch is given up.
WRITE_ATTEMPTS = 10
# Document type of every indexed document.
DOC_TYPE = "doc"
# -----------------------------------------------------------------------------

BatchSink = Callable[[DataFrame, int], None]


def write_topic(df: DataFrame, path: str | None = None, bootstrap: str | None = None,
                partitions: int | None = None) -> None:
    """Append records to their topics (S3): no key, so the broker spreads them.

    With ``bootstrap`` the broker sink is used; otherwise records are appended
    to Parquet under ``path`` partitioned by topic.  ``partitions`` spreads
    the write over that many tasks first (an unkeyed round robin).
    """
    out = df.select("topic", F.col("value").cast("binary").alias("value"))
    if partitions:
        out = out.repartition(partitions)
    if bootstrap:
        (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("kafka.acks", PRODUCER_ACKS).save())
        return
    if not path:
        raise ValueError("write_topic needs bootstrap= or path=")
    out.write.mode("append").partitionBy("topic").parquet(path)


def documents(df: DataFrame) -> DataFrame:
    """``index, pipeline, doc`` rows with ``accepted``: a document must be a
    JSON object to be indexed; anything else is a per-item failure."""
    v = J.parse_one("doc")
    return df.withColumn("accepted", F.coalesce(J.kind(v) == F.lit("OBJECT"), F.lit(False)))


def index_writer(out_path: str, fmt: str = "parquet", attempts: int = WRITE_ATTEMPTS,
                 check_documents: bool = True, metrics_path: str | None = None) -> BatchSink:
    """A ``foreachBatch`` function that bulk-appends documents.

    One write per micro-batch to ``out_path/batch_id=<id>/status=<s>/index=<i>/``:
    ``status=indexed`` holds accepted documents, ``status=rejected`` is the
    dead-letter table of per-item failures.  The write is retried up to
    ``attempts`` times without back-off, then the error is raised so the query
    stops with its position not committed (the batch is replayed on restart
    and overwrites its own folder).  ``check_documents=False`` skips the
    per-document JSON check (every document counts as indexed) when the
    producers are trusted and the parse cost matters.

    With ``metrics_path``, the rows written are counted during the write
    itself (an ``Observation``, no second pass) and one row
    ``batch_id, processed_at, indexed, rejected`` is stored per micro-batch:
    written rows are counted, rejected ones reported apart.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        docs = documents(batch) if check_documents else batch.withColumn("accepted", F.lit(True))
        docs = docs.withColumn("status", F.when(F.col("accepted"), F.lit("indexed"))
                               .otherwise(F.lit("rejected"))).drop("accepted")
        seen = Observation(f"index_batch_{batch_id}") if metrics_path else None
        if seen is not None:
            docs = docs.observe(seen, F.count_if(F.col("status") == "indexed").alias("indexed"),
                                F.count_if(F.col("status") == "rejected").alias("rejected"))
        target = os.path.join(out_path, f"batch_id={batch_id}")
        _retry(lambda: docs.write.mode("overwrite").partitionBy("status", "index").format(fmt).save(target),
               attempts)
        if seen is not None:
            m = seen.get
            spark = batch.sparkSession
            row = spark.createDataFrame([(batch_id, int(m.get("indexed") or 0), int(m.get("rejected") or 0))],
                                        "batch_id long, indexed long, rejected long")
            row = row.withColumn("processed_at", as_utc_ntz(F.current_timestamp(), TimestampType(), spark))
            row.write.mode("overwrite").parquet(os.path.join(metrics_path, f"batch_id={batch_id}"))
    return write


def read_index(spark, out_path: str, schema: str, status: str = "indexed", fmt: str = "parquet",
               as_variant: bool = False) -> DataFrame:
    """Documents written by ``index_writer`` (``status="rejected"`` for the
    dead letters); ``schema`` names the columns wanted, partition columns
    ``batch_id``, ``status`` and ``index`` are added.  ``as_variant`` adds
    ``doc_json``, the document parsed to VARIANT, for JSON queries
    (``variant_get(doc_json, '$.k', 'int')``); documents stay stored as text."""
    full = f"{schema}, batch_id long, status string, index string"
    df = spark.read.schema(full).format(fmt).load(out_path).filter(F.col("status") == status)
    return df.withColumn("doc_json", F.try_parse_json("doc")) if as_variant else df


def search_options(nodes: str, pipeline: str | None = None) -> dict[str, str]:
    """Options for a search-index connector writing ``index`` per row and
    running the named ingest pipeline (bulk requests, no document id)."""
    o = {"es.nodes": nodes, "es.resource.write": "{index}/" + DOC_TYPE, "es.batch.write.retry.count":
         str(WRITE_ATTEMPTS - 1), "es.batch.write.retry.wait": "0s", "es.mapping.exclude": "index,pipeline"}
    if pipeline:
        o["es.ingest.pipeline"] = pipeline
    return o


def _retry(fn: Callable[[], None], attempts: int) -> None:
    last: Exception | None = None
    for _ in range(max(1, attempts)):
        try:
            fn()
            return
        except AnalysisException:  # the plan is wrong: no attempt can succeed
            raise
        except Exception as e:  # noqa: BLE001 - any write failure is retried
            last = e
            time.sleep(0)
    raise last  # type: ignore[misc]


def write_daily_log(df: DataFrame, path: str, sink: str = "file") -> None:
    """Append formatted process-log lines, one folder per calendar day."""
    lines = df.select(F.to_date("ts").alias("day"),
                      format_log_line("level", "file", "line", "ts", "msg", sink=sink).alias("value"))
    lines.write.mode("append").partitionBy("day").text(path)


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Send the same rows to every registered sink (S9), computing them once."""
    df.persist()
    try:
        for s in sinks:
            s(df)
    finally:
        df.unpersist()


def fan_out_batches(sinks: Sequence[BatchSink]) -> BatchSink:
    """``foreachBatch`` form of ``fan_out`` for streams."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, [lambda d, s=s: s(d, batch_id) for s in sinks])
    return write
