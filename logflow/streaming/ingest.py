"""The write path as a stream: report bodies -> checks -> topic records.

S1 -> P1 -> P2 -> S3 per micro-batch.  Accepted bodies are fanned out to
topic records; rejected ones (code -1 / -2) go to a table of their own with
the body, which a request log answers from.  Both writes go under the batch's
own folder with overwrite, so a replayed batch replaces its output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logflow.functions.jsoncheck import CODE_OK
from logflow.operators import ingest


def ingest_batch(requests: DataFrame, topics_path: str, rejected_path: str, batch_id: int) -> None:
    checked = ingest.validate_requests(requests).persist()
    try:
        lines = ingest.explode_logs(checked, keep=["req_id", "topic"])
        (ingest.to_records(lines).write.mode("overwrite").partitionBy("topic")
         .parquet(os.path.join(topics_path, f"batch_id={batch_id}")))
        (checked.filter(F.col("code") != CODE_OK).select("req_id", "code", "body")
         .write.mode("overwrite").parquet(os.path.join(rejected_path, f"batch_id={batch_id}")))
    finally:
        checked.unpersist()


def ingest_stream(requests: DataFrame, topics_path: str, rejected_path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Start the write path on a streaming ``requests`` DataFrame
    (``req_id, received_at, body``)."""
    return (requests.writeStream
            .foreachBatch(lambda b, i: ingest_batch(b, topics_path, rejected_path, i))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start())
