"""Time helpers and index naming.

Times inside the engine are TIMESTAMP_NTZ holding UTC wall-clock values, so
results do not depend on the session time zone.  ``as_utc_ntz`` converts a
TIMESTAMP (instant) column once at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# ---- fixed values that must equal the reference's ---------------------------
# Index types a job may name, and the date pattern each one appends.
INDEX_DAY = "yyyy.MM.dd"
INDEX_YEAR = "yyyy"
INDEX_MONTH = "yyyy.MM"
# Zone used for index dates (the reference asks for Asia/Chongqing, an alias).
INDEX_ZONE = "Asia/Shanghai"
# The month layout the reference really applies: day, zero-padded month, a
# literal "6.", zero-padded month (e.g. 2026-12-01 gives "1126.12").
MONTH_COMPAT_PATTERN = "dMM'6.'MM"
# -----------------------------------------------------------------------------

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_utc_ntz(col: str | Column, dtype: DataType, spark: SparkSession | None = None) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ from a TIMESTAMP or TIMESTAMP_NTZ column."""
    c = _c(col)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        tz = (spark or SparkSession.getActiveSession()).conf.get("spark.sql.session.timeZone")
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), c.cast("timestamp_ntz"))
    raise TypeError(f"not a timestamp type: {dtype}")


def micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a UTC TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(col))


def from_micros(col: str | Column) -> Column:
    """UTC TIMESTAMP_NTZ from microseconds since the epoch."""
    return F.timestamp_add("MICROSECOND", _c(col), epoch_ntz())


_FIELDS = {  # token -> (field of a TIMESTAMP_NTZ, zero-padded width)
    "yyyy": (F.year, 4), "MM": (F.month, 2), "dd": (F.dayofmonth, 2), "d": (F.dayofmonth, 0),
    "HH": (F.hour, 2), "mm": (F.minute, 2), "ss": (F.second, 2),
}


def format_ntz(col: str | Column, pattern: str) -> Column:
    """Format a TIMESTAMP_NTZ wall-clock value with the tokens ``yyyy MM dd d
    HH mm ss`` and ``'quoted'`` literals.

    Built from field extractions, which read the wall clock directly, so the
    text does not depend on the session time zone (``date_format`` converts
    through it and shifts times inside a daylight-saving gap).
    """
    c = _c(col)
    parts, i = [], 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            parts.append(F.lit(pattern[i + 1:j]))
            i = j + 1
            continue
        for tok in ("yyyy", "MM", "dd", "HH", "mm", "ss", "d"):
            if pattern.startswith(tok, i):
                fn, width = _FIELDS[tok]
                v = fn(c).cast("string")
                parts.append(F.lpad(v, width, "0") if width else v)
                i += len(tok)
                break
        else:
            parts.append(F.lit(pattern[i]))
            i += 1
    return F.concat(*parts)


def seconds(interval: str | int | float) -> float:
    """Seconds in ``"10 seconds"`` / ``"1 hour"`` / ``"1 day"`` or a number."""
    if isinstance(interval, (int, float)):
        return float(interval)
    n, unit = interval.split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60,
             "hour": 3600, "day": 86400, "week": 604800}[unit]
    return float(n) * scale


def tick_of(ts: str | Column, every: str | int | float) -> Column:
    """Index of the fixed-length tick holding ``ts`` (ticks aligned to the epoch)."""
    width = int(round(seconds(every) * 1_000_000))
    return F.floor(micros(ts) / F.lit(width)).cast("long")


def tick_start(tick: str | Column, every: str | int | float) -> Column:
    width = int(round(seconds(every) * 1_000_000))
    return from_micros(_c(tick) * F.lit(width))


def index_name(topic: str | Column, index_type: str | Column, ts: str | Column,
               zone: str = INDEX_ZONE, compat: bool = False) -> Column:
    """``topic_<date>`` for the three known index types, else ``topic``.

    ``ts`` is the UTC wall-clock flush time (TIMESTAMP_NTZ); the date is taken
    in ``zone``.  ``compat=True`` reproduces the reference's month layout.
    """
    t, it = _c(topic), _c(index_type)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts))
    month = MONTH_COMPAT_PATTERN if compat else "yyyy.MM"
    suffix = (F.when(it == INDEX_DAY, format_ntz(local, "yyyy.MM.dd"))
              .when(it == INDEX_YEAR, format_ntz(local, "yyyy"))
              .when(it == INDEX_MONTH, format_ntz(local, month)))
    return F.when(suffix.isNull(), t).otherwise(F.concat(t, F.lit("_"), suffix))
