"""Exact ordered scans (row number, running aggregate, lag/lead, carry forward)
over groups of any size.

A plain ``Window.partitionBy(key).orderBy(o)`` sends a whole group to one task,
and a global running total sends the whole table to one task.  A topic,
registry key or claim can hold a third of all rows, so every ordered scan in
this package goes through the three steps below instead:

1. split each group into *slices* of the first order column
   (``floor(o / width)``); a slice is bounded by ``width`` for unique orders
   such as offsets and revisions, and by ``width`` x density for times;
2. scan inside each ``(group, slice)`` with an ordinary window;
3. summarise each slice to one row (count, sum, last row, ...), scan the small
   summary table per group, and join the carry-in back on ``(group, slice)``.

Only the in-slice window moves the rows (hash-partitioned on ``(group,
slice)``).  The slice summary is an aggregate with a map-side partial, so
only one small row per task and slice is shuffled for it; its branch reads the
scan's input a second time (exact numbering needs the counts before any row
can be numbered).  The join back is a left join (every slice is in its own
summary), so when a caller does not use a scan's output the optimizer drops
the whole scan.  The summary has one row per non-empty slice, so its size does
not depend on how rows spread over groups.

Null keys form a group of their own, and rows with a null order value a slice
of their own (before all others): summaries are joined back null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"

# Default slice widths.  Offsets and revisions are unique inside a group, so a
# slice holds at most this many rows.
ORDINAL_WIDTH = 1 << 20
# Times are in microseconds.  Size a time slice so that (slice width x peak
# rows per second of the hottest group) stays within a few million rows: one
# minute keeps a topic with a third of 100 TB a month (about 130k rows/s) at
# about 8M rows per slice, with 43,200 summary rows per group and month.
MICROS_PER_MINUTE = 60_000_000
TIME_WIDTH = MICROS_PER_MINUTE


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _sliced(df: DataFrame, keys: list[str], order: list[str], width: int) -> DataFrame:
    """Add the slice column (the in-slice window clusters on ``(keys, slice)``)."""
    return df.withColumn(SLICE, F.floor(F.col(order[0]) / F.lit(width)).cast("long"))


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _join_back(loc: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """``loc`` with its slice's summary; null keys match null keys."""
    on = [*keys, SLICE]
    named = summary.select(*[F.col(c).alias("__scan_on_" + c) for c in on],
                           *[c for c in summary.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col("__scan_on_" + c))
    return loc.join(named, cond, "left").drop(*["__scan_on_" + c for c in on])


def _group_window(keys: list[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def row_number(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
               out: str = "row_number", width: int = ORDINAL_WIDTH) -> DataFrame:
    """``row_number() over (partition by keys order by order)``, 1-based."""
    keys, order = _names(keys), _names(order)
    d = _sliced(df, keys, order, width)
    local = Window.partitionBy(*keys, SLICE).orderBy(*order)
    loc = d.withColumn("__scan_rn", F.row_number().over(local))
    counts = loc.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("__scan_n"))
    before = _group_window(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, SLICE, F.coalesce(F.sum("__scan_n").over(before), F.lit(0)).alias("__scan_base"))
    return (_join_back(loc, base, keys)
            .withColumn(out, (F.col("__scan_base") + F.col("__scan_rn")).cast("long"))
            .drop(SLICE, "__scan_base", "__scan_rn"))


_COMBINE = {
    "sum": lambda carried, local: F.when(carried.isNull() & local.isNull(), F.lit(None))
    .otherwise(F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))),
    "max": lambda carried, local: F.greatest(carried, local),
    "min": lambda carried, local: F.least(carried, local),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def running(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
            value: str | Column, out: str, how: str = "sum",
            width: int = ORDINAL_WIDTH) -> DataFrame:
    """Inclusive running ``sum`` / ``max`` / ``min`` of ``value`` (ROWS frame)."""
    keys, order = _names(keys), _names(order)
    v = F.col(value) if isinstance(value, str) else value
    agg = _AGG[how]
    d = _sliced(df, keys, order, width).withColumn("__scan_v", v)
    local = (Window.partitionBy(*keys, SLICE).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    loc = d.withColumn("__scan_loc", agg("__scan_v").over(local))
    summary = loc.groupBy(*keys, SLICE).agg(agg("__scan_v").alias("__scan_s"))
    before = _group_window(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SLICE, agg("__scan_s").over(before).alias("__scan_carry"))
    return (_join_back(loc, carry, keys)
            .withColumn(out, _COMBINE[how](F.col("__scan_carry"), F.col("__scan_loc")))
            .drop(SLICE, "__scan_v", "__scan_carry", "__scan_loc"))


def lag(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
        cols: str | Sequence[str], prefix: str = "prev_", exists: str | None = None,
        width: int = ORDINAL_WIDTH, lead: bool = False) -> DataFrame:
    """Previous (or, with ``lead=True``, next) row's ``cols`` in the group.

    Adds ``prefix + c`` for each column; ``exists`` names an optional boolean
    column that is true when there is such a row (values may be NULL).
    """
    keys, order, cols = _names(keys), _names(order), _names(cols)
    d = _sliced(df, keys, order, width)
    ords = [F.col(c).desc() if lead else F.col(c).asc() for c in order]
    local = Window.partitionBy(*keys, SLICE).orderBy(*ords)
    loc = d.withColumn("__scan_in", F.row_number().over(local) > 1)
    for c in cols:
        loc = loc.withColumn("__scan_lag_" + c, F.lag(c).over(local))
    row = F.struct(*[F.col(c).alias(c) for c in cols])
    pick = F.min_by if lead else F.max_by
    summary = loc.groupBy(*keys, SLICE).agg(pick(row, _order_struct(order)).alias("__scan_edge"))
    nb = _group_window(keys).orderBy(F.col(SLICE).desc() if lead else F.col(SLICE).asc())
    carry = summary.select(*keys, SLICE, F.lag("__scan_edge").over(nb).alias("__scan_carry"))
    out = _join_back(loc, carry, keys)
    for c in cols:
        out = out.withColumn(prefix + c, F.when(F.col("__scan_in"), F.col("__scan_lag_" + c))
                             .otherwise(F.col("__scan_carry").getField(c)))
    if exists:
        out = out.withColumn(exists, F.col("__scan_in") | F.col("__scan_carry").isNotNull())
    return out.drop(SLICE, "__scan_in", "__scan_carry", *["__scan_lag_" + c for c in cols])


def carry_forward(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                  value: str, out: str, width: int = ORDINAL_WIDTH,
                  backward: bool = False) -> DataFrame:
    """Last non-null ``value`` at or before each row (``backward``: first non-null
    at or after).  This is an as-of join when the value is set on marker rows
    only.
    """
    keys, order = _names(keys), _names(order)
    d = _sliced(df, keys, order, width)
    ords = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
    local = (Window.partitionBy(*keys, SLICE).orderBy(*ords)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    loc = d.withColumn("__scan_loc", F.last(value, ignorenulls=True).over(local))
    pick = F.min_by if backward else F.max_by
    marked = F.when(F.col(value).isNotNull(), _order_struct(order))
    summary = loc.groupBy(*keys, SLICE).agg(pick(F.col(value), marked).alias("__scan_edge"))
    nb = (_group_window(keys).orderBy(F.col(SLICE).desc() if backward else F.col(SLICE).asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = summary.select(*keys, SLICE, F.last("__scan_edge", ignorenulls=True).over(nb).alias("__scan_carry"))
    return (_join_back(loc, carry, keys)
            .withColumn(out, F.coalesce(F.col("__scan_loc"), F.col("__scan_carry")))
            .drop(SLICE, "__scan_carry", "__scan_loc"))



def session_starts(df: DataFrame, keys: str | Sequence[str], t: str, gap: int, out: str,
                   width: int = TIME_WIDTH) -> DataFrame:
    """Gap sessions in one scan: ``out`` is the start of the session of each
    row, where rows at most ``gap`` apart in ``t`` (per group) share a session.

    Rows may share ``t``; tied rows get the same start (counting duplicates
    first, as ``claims.liveness`` does, only makes the scan smaller).  Inside a slice
    the window finds local session starts; the slice summary (first, last and
    last local start) is scanned per group to decide whether each slice's first
    row opens a session or continues the previous slice's.
    """
    keys = _names(keys)
    d = _sliced(df, keys, [t], width)
    w = Window.partitionBy(*keys, SLICE).orderBy(t)
    prev = F.lag(t).over(w)
    loc = d.withColumn("__scan_new", prev.isNotNull() & ((F.col(t) - prev) > F.lit(gap)))
    loc = loc.withColumn("__scan_start", F.last(F.when(F.col("__scan_new"), F.col(t)), ignorenulls=True)
                         .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summary = loc.groupBy(*keys, SLICE).agg(F.min(t).alias("__scan_first"), F.max(t).alias("__scan_last"),
                                            F.max(F.when(F.col("__scan_new"), F.col(t))).alias("__scan_ls"))
    g = _group_window(keys).orderBy(SLICE)
    prev_last = F.lag("__scan_last").over(g)
    first_new = prev_last.isNull() | ((F.col("__scan_first") - prev_last) > F.lit(gap))
    s = summary.withColumn("__scan_fnew", first_new)
    s = s.withColumn("__scan_eff", F.coalesce(F.col("__scan_ls"),
                                              F.when(F.col("__scan_fnew"), F.col("__scan_first"))))
    carried = F.last("__scan_eff", ignorenulls=True).over(g.rowsBetween(Window.unboundedPreceding, -1))
    s = s.select(*keys, SLICE, F.when(F.col("__scan_fnew"), F.col("__scan_first")).otherwise(carried)
                 .alias("__scan_first_start"))
    return (_join_back(loc, s, keys)
            .withColumn(out, F.coalesce(F.col("__scan_start"), F.col("__scan_first_start")))
            .drop(SLICE, "__scan_new", "__scan_start", "__scan_first_start"))
