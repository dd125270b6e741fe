"""Sources (S1 S2 S7): report bodies, topic records and the registry change
feed, each as a batch table or a stream.

The broker connector is used when its package is on the classpath; files
with the record columns stand in for it otherwise (tests, replays).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from logflow import schemas
from logflow.functions.timefmt import as_utc_ntz

# ---- fixed values that must equal the reference's ---------------------------
# A partition without a stored position is read from its earliest offset.
STARTING_OFFSETS = "earliest"
# The consumer group the reference commits offsets under.
CONSUMER_GROUP = "test"
# -----------------------------------------------------------------------------


def read_requests(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "text",
                  whole_file: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Report bodies (S1) as ``req_id, received_at, body``.

    ``fmt="text"`` reads one body per line (or per file with ``whole_file``);
    ``fmt="parquet"``/``"json"`` read a table that already has these columns.
    A text body's ``req_id`` is a hash of its file's path and of the body, so
    a replay gives it again; equal lines of one file share it and stay rows
    of their own.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        df = reader.option("wholetext", str(whole_file).lower()).text(path)
        now = as_utc_ntz(F.current_timestamp(), TimestampType(), spark)
        return df.select(F.xxhash64(F.col("_metadata.file_path"), "value").alias("req_id"), now.alias("received_at"),
                         F.col("value").alias("body"))
    return reader.schema(schemas.REQUESTS).format(fmt).load(path)


def kafka_options(bootstrap: str, topics: Sequence[str], max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """Options for the broker source: all partitions of ``topics``, from the
    earliest offset when the checkpoint holds no position."""
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topics),
         "startingOffsets": STARTING_OFFSETS, "kafka.group.id": CONSUMER_GROUP}
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    o.update(extra or {})
    return o


def read_topics(spark: SparkSession, topics: Sequence[str] | None = None, *, bootstrap: str | None = None,
                path: str | None = None, streaming: bool = True, max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic records (S2) as ``topic, partition, offset, ts, value``.

    With ``bootstrap`` the broker source is used (positions live in the
    query's checkpoint, so a restart resumes where it stopped).  With ``path``
    a Parquet directory of records is read instead; ``topics`` prunes it.
    """
    reader = spark.readStream if streaming else spark.read
    if bootstrap:
        df = (reader.format("kafka")
              .options(**kafka_options(bootstrap, topics or [], max_offsets_per_trigger)).load())
        return df.select("topic", "partition", "offset",
                         as_utc_ntz("timestamp", TimestampType(), spark).alias("ts"), "value")
    if not path:
        raise ValueError("read_topics needs bootstrap= or path=")
    r = reader.schema(schemas.RECORDS)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    if topics:
        df = df.filter(F.col("topic").isin(list(topics)))
    return df


def read_job_changes(spark: SparkSession, path: str, streaming: bool = True, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """The registry change feed (S7): an append-only directory of changes."""
    reader = spark.readStream if streaming else spark.read
    r = reader.schema(schemas.CHANGES).format(fmt)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_heartbeats(spark: SparkSession, path: str, streaming: bool = True, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    r = reader.schema(schemas.HEARTBEATS).format(fmt)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
