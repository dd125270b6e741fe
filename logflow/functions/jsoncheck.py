"""Strict JSON checks on request and registry bodies.

``from_json`` is too lenient for these contracts (it turns ``1`` into ``"1"``
and reads single quotes), so bodies are parsed to VARIANT and the type of each
field is checked with ``schema_of_variant``.  Everything stays JVM-side.

``try_parse_json`` ignores text after the first value, so a body counts as one
JSON value only if it parses both inside ``[ ]`` and as the value of an object
field; any trailing text or second value breaks one of the two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's ---------------------------
# Request reply codes: accepted, body is not a JSON object, field check failed.
CODE_OK = 0
CODE_NOT_JSON = -1
CODE_BAD_FIELDS = -2
# The four string fields of a job, in declaration order.
JOB_FIELDS = ("job_name", "topic", "index_type", "pipeline")
# -----------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_one(body: str | Column) -> Column:
    """VARIANT of a body that holds exactly one JSON value, else SQL NULL.

    A JSON ``null`` body gives a VARIANT null (type ``VOID``), not SQL NULL.
    """
    b = _c(body)
    in_array = F.try_parse_json(F.concat(F.lit("["), b, F.lit("]")))
    in_field = F.try_parse_json(F.concat(F.lit('{"b":'), b, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_field, "$.b", "variant"))


def out_of_range(body: str | Column, v: Column) -> Column:
    """True when the body holds a number beyond double range (``1e999``).

    The parser turns such a number into an infinite DOUBLE, which a map
    decoder refuses; so the body is rejected if its re-serialised form has
    more ``Infinity"`` endings than its own text.  Only bodies whose text has
    a 3-digit exponent or a 309-digit run are re-serialised."""
    b = _c(body)
    suspect = b.rlike(r"[0-9][eE][+]?[0-9]{3}|[0-9]{309}")
    tail = F.lit('Infinity"')
    again = F.to_json(v)
    more = (F.length(again) - F.length(F.replace(again, tail, F.lit("")))) > \
        (F.length(b) - F.length(F.replace(b, tail, F.lit(""))))
    return F.coalesce(F.when(suspect, more), F.lit(False))


def kind(v: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``VOID`` (JSON null), ... or NULL."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z_]+)", 1)


def field(v: Column, name: str) -> Column:
    """Field of a JSON object as VARIANT; SQL NULL when absent (case-sensitive)."""
    return F.try_variant_get(v, "$." + _path(name), "variant")


def _path(name: str) -> str:
    if name.isidentifier():
        return name
    return "['" + name.replace("'", "\\'") + "']"


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == F.lit("STRING"), F.lit(False))


def is_string_array(v: Column) -> Column:
    """True for a JSON array whose elements are all strings (``[]`` included).

    The merged element type must be STRING (or VOID for ``[]``/all-null), and
    no element may be null; no lambda, so the check stays in generated code.
    """
    arr = F.try_variant_get(v, "$", "array<string>")
    typed = F.schema_of_variant(v).isin("ARRAY<STRING>", "ARRAY<VOID>")
    return F.coalesce(typed & (F.size(F.array_compact(arr)) == F.size(arr)), F.lit(False))


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def request_code(v: Column, body: str | Column | None = None) -> Column:
    """Reply code of a log report ``{topic: string, logs: [string]}``.

    -1: not one JSON value, or a value that is neither an object nor null.
    -2: ``topic`` is not a string or ``logs`` is not an all-string array
    (a null body is decoded to an empty object, so it lands here too).
    """
    k = kind(v)
    fields_ok = is_string(field(v, "topic")) & is_string_array(field(v, "logs"))
    bad = v.isNull() | ~k.isin("OBJECT", "VOID")
    if body is not None:  # also refuse numbers beyond double range
        bad = bad | out_of_range(body, v)
    return (F.when(bad, F.lit(CODE_NOT_JSON))
            .when(fields_ok, F.lit(CODE_OK))
            .otherwise(F.lit(CODE_BAD_FIELDS)))


def decode_job_picked(v: Column, k: Column, picks: dict[str, Column]) -> Column:
    """Final stage of job decoding from the parsed value, its kind and the
    picked fields.  Operators materialise each stage as a column so the
    parse and the lookups run once per row."""
    ok = v.isNotNull() & k.isin("OBJECT", "VOID")
    for p in picks.values():
        ok = ok & (p.isNull() | F.schema_of_variant(p).isin("STRING", "VOID"))
    cols = [F.coalesce(as_string(p), F.lit("")).alias(f) for f, p in picks.items()]
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), *cols)
