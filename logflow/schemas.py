"""Schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


JOB = _s(("job_name", StringType()), ("topic", StringType()), ("index_type", StringType()),
         ("pipeline", StringType()))

REQUESTS = _s(("req_id", LongType()), ("received_at", TimestampNTZType()), ("body", StringType()))
REQUEST_BODY = _s(("topic", StringType()), ("logs", ArrayType(StringType())))
RECORDS_OUT = _s(("topic", StringType()), ("value", BinaryType()))
RECORDS = _s(("topic", StringType()), ("partition", IntegerType()), ("offset", LongType()),
             ("ts", TimestampNTZType()), ("value", BinaryType()))
JOBS = _s(("key", StringType()), *[(f.name, f.dataType) for f in JOB.fields])
CHANGES = _s(("revision", LongType()), ("op", StringType()), ("key", StringType()), ("value", StringType()),
             ("ts", TimestampNTZType()))
JOB_EVENTS = _s(("event_type", IntegerType()), ("job", JOB))
TOPIC_EVENTS = _s(("topic", StringType()), ("revision", LongType()), ("ts", TimestampNTZType()),
                  ("key", StringType()), ("event_type", IntegerType()), ("job_name", StringType()),
                  ("index_type", StringType()), ("pipeline", StringType()))
HEARTBEATS = _s(("topic", StringType()), ("owner", StringType()), ("ts", TimestampNTZType()))
DOCUMENTS_OUT = _s(("index", StringType()), ("pipeline", StringType()), ("doc", StringType()))
THROUGHPUT = _s(("tick", TimestampNTZType()), ("rows", LongType()), ("rows_total", LongType()),
                ("jobs", LongType()))
LOG_MESSAGES = _s(("level", IntegerType()), ("file", StringType()), ("line", IntegerType()),
                  ("ts", TimestampNTZType()), ("msg", StringType()))
CODES = _s(("req_id", LongType()), ("code", IntegerType()), ("ok", BooleanType()))
