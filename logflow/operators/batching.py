"""Flush batches.

A collector flushes a partition's buffer when it reaches ``max_rows`` rows or
when its ``max_wait`` timer fires.  A size flush does not reset the timer, so
within each timer tick the cut is plain chunking by offset, and an empty tick
flushes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.functions.timefmt import tick_of, tick_start
from logflow.plans import scan

# ---- fixed values that must equal the reference's ---------------------------
MAX_ROWS = 1000
MAX_WAIT = "1 second"
# -----------------------------------------------------------------------------


def assign_batches(records: DataFrame, max_rows: int = MAX_ROWS, max_wait: str | float = MAX_WAIT,
                   width: int = scan.ORDINAL_WIDTH) -> DataFrame:
    """Add ``tick`` (timer tick index) and ``batch_seq`` (cut within the tick).

    The offset order inside a ``(topic, partition, tick)`` comes from the
    skew-safe row number, so a hot partition-tick is split by offset ranges.
    """
    r = records.withColumn("tick", tick_of("ts", max_wait))
    r = scan.row_number(r, ["topic", "partition", "tick"], "offset", out="__rn", width=width)
    return r.withColumn("batch_seq", F.floor((F.col("__rn") - 1) / F.lit(max_rows)).cast("long")).drop("__rn")


def flush_counts(batched: DataFrame, max_wait: str | float = MAX_WAIT) -> DataFrame:
    """Rows and offset range per flush batch (A1)."""
    return (batched.groupBy("topic", "partition", "tick", "batch_seq")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset"))
            .select("topic", "partition", tick_start("tick", max_wait).alias("tick_start"), "batch_seq",
                    "rows", "first_offset", "last_offset"))
