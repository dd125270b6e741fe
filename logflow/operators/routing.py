"""Routing records to jobs (J1 J5) and named transforms (P5)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.functions.timefmt import micros
from logflow.operators.jobs import EVENT_SAVE
from logflow.plans import scan

JOB_COLS = ("job_name", "index_type", "pipeline")


def route(records: DataFrame, jobs: DataFrame) -> DataFrame:
    """Records of topics that have a job, with the job's fields.

    ``jobs`` holds one job per topic (``running_topics``).  No hint is given:
    the measured size of the job table decides between a broadcast and a
    shuffle, and adaptive execution splits a hot topic.
    """
    j = jobs.select("topic", *JOB_COLS)
    return records.join(j, "topic")


def route_as_of(records: DataFrame, events: DataFrame, width: int = scan.TIME_WIDTH) -> DataFrame:
    """Each record with the job version that consumes it.

    A version starts at its SAVE event and lasts to the next event of the
    topic.  A record that arrives while the topic is stopped (after a DELETE,
    or before the first SAVE) is read on the next start, so it takes the next
    version; with no later SAVE it is not routed.

    Implemented as an as-of join without a range join: version markers are
    unioned into the record stream and carried forward per topic through the
    skew-safe scan (a hot topic is split into time slices).
    """
    ev = events.select("topic", "revision", "ts", "event_type",
                       *[F.when(F.col("event_type") == EVENT_SAVE, F.col(c)).alias(c) for c in JOB_COLS])
    version = F.when(F.col("event_type") == EVENT_SAVE,
                     F.struct(F.col("revision").alias("version"), *[F.col(c) for c in JOB_COLS]))
    ev = ev.withColumn("__ver", version)
    # for a DELETE, the version that will consume its gap is the next SAVE
    ev = scan.carry_forward(ev, "topic", "revision", "__ver", "__next", backward=True)
    empty = F.struct(*[F.lit(None).cast("long" if c == "version" else "string").alias(c)
                       for c in ("version", *JOB_COLS)])
    marker_val = F.coalesce(F.col("__ver"), F.col("__next"), empty)
    # changes that share a time take effect in revision order
    markers = ev.select("topic", micros("ts").alias("__us"), F.lit(0).alias("__kind"),
                        F.col("revision").cast("long").alias("__rev"), marker_val.alias("__m"))
    # before the first event of a topic: its first SAVE
    first = (ev.filter(F.col("__ver").isNotNull()).groupBy("topic")
             .agg(F.min_by("__ver", "revision").alias("__m"))
             .select("topic", F.lit(-(1 << 62)).cast("long").alias("__us"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__rev"), "__m"))
    rec_cols = [c for c in records.columns if c != "topic"]
    recs = records.select("topic", *rec_cols, micros("ts").alias("__us"), F.lit(1).alias("__kind"),
                          F.lit(0).cast("long").alias("__rev"), F.lit(None).cast(markers.schema["__m"].dataType).alias("__m"))
    allrows = recs.unionByName(markers.unionByName(first), allowMissingColumns=True)
    carried = scan.carry_forward(allrows, "topic", ["__us", "__kind", "__rev"], "__m", "__job", width=width)
    return (carried.filter((F.col("__kind") == 1) & F.col("__job.version").isNotNull())
            .select("topic", *rec_cols, *[F.col("__job." + c).alias(c) for c in ("version", *JOB_COLS)]))


@dataclass(frozen=True)
class RowTransform:
    """A transform of single rows: new values for columns, computed from the
    row as it was, and the rows to keep (None: all)."""

    columns: Mapping[str, Column] = field(default_factory=dict)
    keep: Column | None = None


def apply_transforms(df: DataFrame, registry: Mapping[str, RowTransform | Callable[[DataFrame], DataFrame]],
                     name_col: str = "pipeline") -> DataFrame:
    """Run each row through the transform its job names (P5).

    ``registry`` maps a name to a ``RowTransform`` or, for transforms that
    change the number of rows otherwise, to a DataFrame -> DataFrame function.
    A blank or unregistered name passes rows through unchanged.  All row
    transforms are one projection over one read of ``df``; each function reads
    ``df`` once more.  Columns that only some transforms make are null for
    the other rows.
    """
    name = F.coalesce(F.col(name_col), F.lit(""))
    by_row = {n: t for n, t in registry.items() if n != "" and isinstance(t, RowTransform)}
    by_frame = {n: t for n, t in registry.items() if n != "" and n not in by_row}
    out = df.filter(~name.isin(list(by_frame))) if by_frame else df
    for n, t in by_row.items():
        if t.keep is not None:
            out = out.filter((name != n) | t.keep)
    values = {}
    for c in dict.fromkeys(c for t in by_row.values() for c in t.columns):
        value = F.col(c) if c in df.columns else F.lit(None)
        for n, t in by_row.items():
            if c in t.columns:
                value = F.when(name == n, t.columns[c]).otherwise(value)
        values[c] = value
    out = out.withColumns(values) if values else out
    for n, transform in by_frame.items():
        done = transform(df.filter(name == n))
        if lost := [c for c in df.columns if c not in done.columns]:
            raise ValueError(f"transform {n!r} drops the columns {lost}")
        out = out.unionByName(done, allowMissingColumns=True)  # new columns are null for other transforms
    return out
