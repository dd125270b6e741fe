"""State of streaming queries: the store that custom operators need, and
reading a query's state back as a table.

A query's state is a table already: Spark's state data source reads the last
committed version from the checkpoint folder, snapshots and changes since, so
a fold needs no output of its own.  Spark keeps and removes old versions
(``spark.sql.streaming.minBatchesToRetain``), so a reader beside a running
query sees one whole version.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The query has not committed a micro-batch yet.
NOT_YET = ("STDS_OFFSET_LOG_UNAVAILABLE", "STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_METADATA_LOG_UNAVAILABLE",
           "STDS_NO_PARTITION_DISCOVERED_IN_STATE_STORE", "STDS_INVALID_OPTION_VALUE.IS_EMPTY")


@contextmanager
def operator_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which
    ``transformWithState`` needs; a started query keeps its setting."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def read_state(spark: SparkSession, checkpoint: str, *, variable: str | None = None, rows: str = "value",
               operator: int = 0) -> DataFrame | None:
    """``key`` and ``value`` of the last committed state of a query's stateful
    operator (``variable``: a state variable of a custom one; ``rows``: the
    column of its values, ``list_element`` for a list); None if no micro-batch
    is committed yet."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    try:
        return reader.load(checkpoint).select("key", F.col(rows).alias("value"))
    except PySparkException as e:
        if (e.getCondition() or "").startswith(NOT_YET):
            return None
        raise
