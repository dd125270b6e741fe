"""Process-log messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from logflow.functions.logline import format_log_line


def severity_filter(df: DataFrame, max_level: int | None = None, min_level: int | None = None) -> DataFrame:
    """Keep messages by level.  ``max_level`` keeps levels at or below the
    threshold, which is what the reference's filter does (it is inverted);
    ``min_level`` is the usual "this level and more severe"."""
    cond = F.lit(True)
    if max_level is not None:
        cond = cond & (F.col("level") <= max_level)
    if min_level is not None:
        cond = cond & (F.col("level") >= min_level)
    return df.filter(cond)


def log_lines(df: DataFrame, sink: str = "console") -> DataFrame:
    """Add ``line_text``: the message as the given sink writes it.

    ``msg`` is a string or an array of arguments; arguments are printed
    space-separated inside the one bracketed list."""
    msg = F.col("msg")
    if isinstance(df.schema["msg"].dataType, ArrayType):
        msg = F.array_join(msg, " ")
    return df.withColumn("line_text", format_log_line("level", "file", "line", "ts", msg, sink=sink))
