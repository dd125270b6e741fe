"""Process-log message formatting (P12) and level filters (P11 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logflow.functions.timefmt import format_ntz

# ---- fixed values that must equal the reference's ---------------------------
# Level names by level number 0..4.
LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")
DEBUG, INFO, WARN, ERROR, FATAL = range(5)
# Date layout of the line prefix, and the standard-logger stamp each sink adds
# after it: the console writes the time only, a file writes date and time.
PREFIX_DATE = "yyyy-MM-dd"
CONSOLE_STAMP = "HH:mm:ss"
FILE_STAMP = "yyyy/MM/dd HH:mm:ss"
# -----------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def level_name(level: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LEVELS]), _c(level) + F.lit(1))


def base_name(path: str | Column) -> Column:
    return F.substring_index(_c(path), "/", -1)


def log_prefix(level: str | Column, file: str | Column, line: str | Column,
               ts: str | Column) -> Column:
    """``[LEVEL][file:line] date `` or, when the caller is unknown, ``[LEVEL] date ``."""
    lv, f, ln, t = _c(level), _c(file), _c(line), _c(ts)
    date = format_ntz(t, PREFIX_DATE)
    known = F.format_string("[%s][%s:%d] %s ", level_name(lv), base_name(f), ln, date)
    unknown = F.format_string("[%s] %s ", level_name(lv), date)
    return F.when(f.isNull() | ln.isNull(), unknown).otherwise(known)


def format_log_line(level: str | Column, file: str | Column, line: str | Column,
                    ts: str | Column, msg: str | Column, sink: str = "console") -> Column:
    """A full output line: prefix, the sink's time stamp, then the message
    arguments as one bracketed list.  ``ts`` is a TIMESTAMP_NTZ wall clock."""
    stamp = {"console": CONSOLE_STAMP, "file": FILE_STAMP}.get(sink)
    parts = [log_prefix(level, file, line, ts)]
    if stamp:
        parts.append(format_ntz(_c(ts), stamp))
        parts.append(F.lit(" "))
    parts += [F.lit("["), _c(msg), F.lit("]")]
    return F.concat(*parts)
