"""Write path: check report bodies, fan them out to topic records (P1 P2 P3),
and the job put / delete bodies (P8 P9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.functions import jsoncheck as J
from logflow.functions.keys import JOBS_PREFIX, add_prefix


def validate_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``code`` (0, -1, -2) and, for accepted bodies, ``topic`` and ``logs``
    (rules in ``jsoncheck.request_code``).

    A body is all-or-nothing: one bad element rejects the whole request.
    Staged projections parse the body once and convert the log array once;
    the results leave through a one-row generator so later filters on
    ``code`` do not re-inline the checks.
    """
    v = F.col("__v")
    d = df.withColumn("__v", J.parse_one(body))
    d = d.select(*df.columns, "__v", J.kind(v).alias("__k"), J.field(v, "topic").alias("__t"),
                 J.field(v, "logs").alias("__l"), J.out_of_range(body, v).alias("__oor"))
    d = d.select(*df.columns, "__v", "__k", "__t", "__oor", F.schema_of_variant("__l").alias("__ls"),
                 F.try_variant_get("__l", "$", "array<string>").alias("__arr"))
    logs_ok = (F.col("__ls").isin("ARRAY<STRING>", "ARRAY<VOID>")
               & (F.size(F.array_compact("__arr")) == F.size("__arr")))
    fields_ok = J.is_string(F.col("__t")) & F.coalesce(logs_ok, F.lit(False))
    code = (F.when(v.isNull() | ~F.col("__k").isin("OBJECT", "VOID") | F.col("__oor"), F.lit(J.CODE_NOT_JSON))
            .when(fields_ok, F.lit(J.CODE_OK)).otherwise(F.lit(J.CODE_BAD_FIELDS)))
    d = d.select(*df.columns, "__t", "__arr", code.alias("__code"))
    ok = F.col("__code") == J.CODE_OK
    out = F.struct(F.col("__code").alias("code"),
                   F.when(ok, J.as_string(F.col("__t"))).alias("topic"),
                   F.when(ok, F.col("__arr")).alias("logs"))
    return d.select(*df.columns, F.inline(F.array(out)))


def explode_logs(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per log line of an accepted request, with its position ``pos``."""
    keep = keep if keep is not None else [c for c in df.columns if c not in ("logs", "body", "code")]
    return (df.filter(F.col("code") == J.CODE_OK)
            .select(*keep, F.posexplode("logs").alias("pos", "log")))


def to_records(lines: DataFrame, value: str = "log") -> DataFrame:
    """``topic, value`` rows ready for the topic sink (no key, no headers)."""
    return lines.select("topic", F.col(value).cast("binary").alias("value"))


def decode_value(df: DataFrame, value: str = "value", out: str = "doc") -> DataFrame:
    """Record bytes as text; the contents are not parsed."""
    return df.withColumn(out, F.col(value).cast("string"))


PUT_REQUIRED = ("key", "job_name", "topic")
PUT_OPTIONAL = ("pipeline", "index_type")


def validate_job_puts(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``code, key, job_name, topic, pipeline, index_type`` from a put body
    (P8): ``PUT_REQUIRED`` are strings, ``PUT_OPTIONAL`` strings or absent
    (then ``""``); any other shape, an explicit null included, gives -1.

    Staged projections: parse once, pick the fields once, decide once, then
    emit through a one-row generator.
    """
    v = F.col("__v")
    d = df.withColumn("__v", J.parse_one(body))
    d = d.select(*df.columns, "__v", J.kind(v).alias("__k"), J.out_of_range(body, v).alias("__oor"),
                 *[J.field(v, f).alias("__f_" + f) for f in PUT_REQUIRED + PUT_OPTIONAL])
    ok = F.col("__v").isNotNull() & (F.col("__k") == F.lit("OBJECT")) & ~F.col("__oor")
    for f in PUT_REQUIRED:
        ok = ok & J.is_string(F.col("__f_" + f))
    for f in PUT_OPTIONAL:
        ok = ok & (F.col("__f_" + f).isNull() | J.is_string(F.col("__f_" + f)))
    d = d.select(*df.columns, *["__f_" + f for f in PUT_REQUIRED + PUT_OPTIONAL],
                 F.coalesce(ok, F.lit(False)).alias("__ok"))
    good = F.col("__ok")
    out = F.struct(F.when(good, F.lit(J.CODE_OK)).otherwise(F.lit(J.CODE_NOT_JSON)).alias("code"),
                   *[F.when(good, J.as_string(F.col("__f_" + f))).alias(f) for f in PUT_REQUIRED],
                   *[F.when(good, F.coalesce(J.as_string(F.col("__f_" + f)), F.lit(""))).alias(f)
                     for f in PUT_OPTIONAL])
    return d.select(*df.columns, F.inline(F.array(out)))


def puts_to_changes(puts: DataFrame, revision: str = "revision", prefix: str = JOBS_PREFIX) -> DataFrame:
    """Accepted puts as registry PUT changes, the value encoded in field order."""
    value = F.to_json(F.struct("job_name", "topic", "index_type", "pipeline"))
    return (puts.filter(F.col("code") == J.CODE_OK)
            .select(revision, F.lit("PUT").alias("op"), add_prefix("key", prefix).alias("key"),
                    value.alias("value"), _ts(puts)))


def explode_deletes(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per key of a bulk delete body (``code`` 0), or one row with a
    NULL key and ``code`` -1 for a rejected body."""
    v = F.col("__v")
    d = df.withColumn("__v", J.parse_one(body)).withColumn("__keys", J.field(v, "keys"))
    ok = F.coalesce(v.isNotNull() & (J.kind(v) == F.lit("OBJECT")) & J.is_string_array(F.col("__keys"))
                    & ~J.out_of_range(body, v), F.lit(False))
    d = d.withColumn("__ok", ok)
    return d.select(*df.columns,
                    F.when(F.col("__ok"), F.lit(J.CODE_OK)).otherwise(F.lit(J.CODE_NOT_JSON)).alias("code"),
                    F.posexplode_outer(F.when(F.col("__ok"), F.try_variant_get("__keys", "$", "array<string>")))
                    .alias("pos", "key"))


def deletes_to_changes(deletes: DataFrame, revision: str = "revision", prefix: str = JOBS_PREFIX) -> DataFrame:
    return (deletes.filter((F.col("code") == J.CODE_OK) & F.col("key").isNotNull())
            .select(revision, F.lit("DELETE").alias("op"), add_prefix("key", prefix).alias("key"),
                    F.lit(None).cast("string").alias("value"), _ts(deletes)))


def key_deletes_to_changes(df: DataFrame, key: str = "key", revision: str = "revision",
                           prefix: str = JOBS_PREFIX) -> DataFrame:
    """Single-key deletes (the key is a plain argument, any string) as DELETE
    changes.  What each delete removed is ``jobs.prior_image`` of the log."""
    return df.select(revision, F.lit("DELETE").alias("op"), add_prefix(key, prefix).alias("key"),
                     F.lit(None).cast("string").alias("value"), _ts(df))


def _ts(df: DataFrame):
    """The change time: the request's ``ts`` if it has one, else NULL."""
    return F.col("ts") if "ts" in df.columns else F.lit(None).cast("timestamp_ntz").alias("ts")
