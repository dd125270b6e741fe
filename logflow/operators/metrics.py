"""Throughput report (A2): rows per tick, every tick including empty ones,
the running total since the first tick, and the running jobs at the tick."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.functions.timefmt import micros, seconds, tick_of, tick_start
from logflow.plans import scan

# ---- fixed values that must equal the reference's ---------------------------
REPORT_EVERY = "10 seconds"
# -----------------------------------------------------------------------------

# ticks per block of the tick spine and per slice of the running total
BLOCK_TICKS = 4096


def tick_spine(per_tick: DataFrame, block: int = BLOCK_TICKS) -> DataFrame:
    """Every tick index between the first and last of ``per_tick.tick``.

    Built in two steps (blocks, then ticks inside a block) so no single task
    generates the whole range.
    """
    b = F.lit(block)
    bounds = per_tick.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi"))
    blocks = bounds.select("lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / b), F.floor(F.col("hi") / b)))
                           .alias("__b"))
    blocks = blocks.repartition("__b")
    return blocks.select(F.explode(F.sequence(F.greatest(F.col("__b") * b, F.col("lo")),
                                              F.least(F.col("__b") * b + b - 1, F.col("hi")))).alias("tick"))


def throughput(df: DataFrame, every: str | float = REPORT_EVERY, ts: str = "ts",
               rows: str | None = None, jobs: DataFrame | None = None) -> DataFrame:
    """``tick, rows, rows_total[, jobs]`` for every tick from first to last.

    ``rows`` names a per-row count column (e.g. flush batch sizes); default 1
    per row.  ``jobs`` is an ``active_job_count`` series; the value in force
    at each tick's end is reported, as a sampler at the tick would see it.
    """
    w = F.col(rows) if rows else F.lit(1)
    per = df.select(tick_of(ts, every).alias("tick"), w.alias("__w")).groupBy("tick").agg(
        F.sum("__w").cast("long").alias("rows"))
    dense = tick_spine(per).join(per, "tick", "left").fillna(0, ["rows"])
    out = scan.running(dense, [], "tick", "rows", "rows_total", width=BLOCK_TICKS)
    out = out.select("tick", "rows", F.col("rows_total").cast("long"))
    if jobs is None:
        return out.select(tick_start("tick", every).alias("tick"), "rows", "rows_total")
    width_us = int(round(seconds(every) * 1_000_000))
    ticks = out.select("tick", "rows", "rows_total", F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__j"))
    # the last change up to each tick's end, by time and then revision: at most
    # one mark a tick, however many changes there are
    seen_by = F.floor((micros("ts") - 1) / F.lit(width_us)).cast("long")
    marks = jobs.groupBy(seen_by.alias("tick")).agg(
        F.max_by(F.col("active_jobs").cast("long"), F.struct("ts", *[c for c in ("revision",) if c in jobs.columns]))
        .alias("__j")).select("tick", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("rows_total"),
                              F.lit(0).alias("__kind"), "__j")
    both = scan.carry_forward(ticks.unionByName(marks), [], ["tick", "__kind"], "__j", "jobs", width=BLOCK_TICKS)
    return (both.filter(F.col("__kind") == 1)
            .select(tick_start("tick", every).alias("tick"), "rows", "rows_total",
                    F.coalesce(F.col("jobs"), F.lit(0)).cast("long").alias("jobs")))
