"""Streaming forms of claim liveness (T3) and per-tick counts (A2).

Streams need an event-time column of type TIMESTAMP for watermarks; the
engine's times are UTC TIMESTAMP_NTZ, converted here at the edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import TimestampType

from logflow.functions.timefmt import as_utc_ntz, micros, seconds, tick_start
from logflow.operators.claims import LEASE
from logflow.operators.jobs import EVENT_SAVE
from logflow.operators.metrics import REPORT_EVERY


def instant(ntz: str | Column, spark: SparkSession | None = None) -> Column:
    """TIMESTAMP instant of a UTC wall-clock TIMESTAMP_NTZ."""
    tz = (spark or SparkSession.getActiveSession()).conf.get("spark.sql.session.timeZone")
    c = F.col(ntz) if isinstance(ntz, str) else ntz
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c).cast("timestamp")


def liveness_stream(heartbeats: DataFrame, lease: str = LEASE, late: str | None = None) -> DataFrame:
    """Closed claim sessions of a heartbeat stream (append mode).

    ``session_window`` merges beats at most ``lease`` apart; a session is
    emitted once the watermark (max time - ``late``) passes its end.
    """
    spark = heartbeats.sparkSession
    t = heartbeats.withColumn("__t", instant("ts", spark)).withWatermark("__t", late or lease)
    g = (t.groupBy("topic", "owner", F.session_window("__t", _dur(lease)).alias("__w"))
         .agg(F.max("__t").alias("__last"), F.count(F.lit(1)).alias("beats")))
    return g.select("topic", "owner",
                    as_utc_ntz(F.col("__w.start"), TimestampType(), spark).alias("session_start"),
                    as_utc_ntz(F.col("__last"), TimestampType(), spark).alias("last_beat"),
                    as_utc_ntz(F.col("__w.end"), TimestampType(), spark).alias("session_end"),
                    F.col("beats").cast("long"))


def tick_counts_stream(records: DataFrame, every: str = REPORT_EVERY, late: str = "0 seconds") -> DataFrame:
    """Rows per tick of a record stream, one row per closed tick (append
    mode).  The running total is then a batch ``throughput(..., rows="rows")``
    over the written ticks, since running totals are refused on streams."""
    spark = records.sparkSession
    t = records.withColumn("__t", instant("ts", spark)).withWatermark("__t", late)
    g = t.groupBy(F.window("__t", _dur(every)).alias("__w")).agg(F.count(F.lit(1)).alias("rows"))
    return g.select(as_utc_ntz(F.col("__w.start"), TimestampType(), spark).alias("ts"), "rows")


#: Ticks whose steps are one entry of the report's state.
STEP_BLOCK = 1 << 14
#: Ticks that are sent on at a time.
TICKS_OUT = 1 << 16


class Report(StatefulProcessor):
    """Running total over closed ticks, with the empty ticks between them and
    the number of running jobs at each tick's end.  Steps of ticks that no
    record has closed wait in packed blocks of ticks."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "tick long, total long, jobs long")
        self.deltas = handle.getMapState("deltas", "block long", "ticks binary, steps binary")

    def _keep(self, ticks: np.ndarray, steps: np.ndarray) -> None:
        block = ticks // STEP_BLOCK
        for k in np.unique(block).tolist():
            held = self.deltas.getValue((k,)) if self.deltas.containsKey((k,)) else (b"", b"")
            mine = block == k
            self.deltas.updateValue((k,), (bytes(held[0]) + ticks[mine].tobytes(), bytes(held[1]) + steps[mine].tobytes()))

    def _take(self, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Waiting steps up to a tick, which leave the state."""
        got = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for (k,) in list(self.deltas.keys()):
            if k * STEP_BLOCK > upto:
                continue
            ticks, steps = (np.frombuffer(bytes(x), np.int64) for x in self.deltas.getValue((k,)))
            due = ticks <= upto
            got.append((ticks[due], steps[due]))
            if due.all():
                self.deltas.removeKey((k,))
            elif due.any():
                self.deltas.updateValue((k,), (ticks[~due].tobytes(), steps[~due].tobytes()))
        ticks, steps = zip(*got)
        return np.concatenate(ticks), np.concatenate(steps)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows))
        last = self.last.get() if self.last.exists() else None
        changed = pdf[pdf["is_delta"]].groupby("tick")["n"].sum()
        at, n = changed.index.to_numpy(np.int64), changed.to_numpy(np.int64)
        closed = pdf[~pdf["is_delta"]].sort_values("tick")
        if not len(closed):
            self._keep(at, n)
            return
        first = last[0] + 1 if last else int(closed["tick"].iloc[0])
        ticks = np.arange(first, int(closed["tick"].iloc[-1]) + 1)
        counts = np.zeros(len(ticks), dtype=np.int64)
        counts[closed["tick"].to_numpy() - first] = closed["n"].to_numpy()
        total = np.cumsum(counts) + (last[1] if last else 0)
        steps = np.zeros(len(ticks), dtype=np.int64)
        base = last[2] if last else 0
        due = at <= ticks[-1]
        for tick, step in (self._take(int(ticks[-1])), (at[due], n[due])):
            np.add.at(steps, np.maximum(tick - first, 0), step)  # at the end of its tick, or before the first
        self._keep(at[~due], n[~due])
        jobs = np.cumsum(steps) + base
        self.last.update((int(ticks[-1]), int(total[-1]), int(jobs[-1])))
        out = pd.DataFrame({"tick": ticks, "rows": counts, "rows_total": total, "jobs": jobs})
        for k in range(0, len(out), TICKS_OUT):
            yield out.iloc[k:k + TICKS_OUT]

    def close(self) -> None:
        pass


class Transitions(StatefulProcessor):
    """+1 / -1 for each event that starts or stops a topic."""

    def init(self, handle) -> None:
        self.running = handle.getValueState("running", "revision long, running boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("revision")
        seen, running = self.running.get() if self.running.exists() else (-1, False)
        pdf = pdf[pdf["revision"] > seen]
        if not len(pdf):
            return
        now = (pdf["event_type"] == EVENT_SAVE).to_numpy()
        step = now.astype(np.int64) - np.concatenate([[running], now[:-1]]).astype(np.int64)
        self.running.update((int(pdf["revision"].iloc[-1]), bool(now[-1])))
        yield pdf.assign(n=step).loc[step != 0, ["n", "at"]]

    def close(self) -> None:
        pass


def throughput_stream(records: DataFrame, events: DataFrame, every: str = REPORT_EVERY,
                      late: str = "0 seconds") -> DataFrame:
    """A2 as one stream: ``tick, rows, rows_total, jobs`` for every tick that
    the watermark has closed, empty ones between them included.

    Stateful operators in a chain: rows counted by tick (a window, so a hot
    topic's rows are combined before they are dealt), job events turned to
    steps by topic, steps summed by tick (a window like that of the rows, so
    both close together), and a report over the closed ticks, whose input is
    at most two rows a tick.  ``events`` is a stream of job events
    (``registry.topic_events``); each topic's come by rising revision.  Start
    the query inside ``state.operator_state``, in append mode.
    """
    spark = records.sparkSession
    width = int(round(seconds(every) * 1_000_000))
    t = records.withColumn("__t", instant("ts", spark)).withWatermark("__t", late)
    per = t.groupBy(F.window("__t", _dur(every)).alias("__w")).agg(F.count(F.lit(1)).alias("n"))
    start = micros(as_utc_ntz(F.col("__w.start"), TimestampType(), spark))
    closed = per.select(F.lit(False).alias("is_delta"), F.floor(start / width).cast("long").alias("tick"), "n",
                        F.window_time("__w").alias("at"))
    # seen by the sampler at a tick's end: an event at the very end counts, so
    # events are placed a microsecond before their time
    e = events.select("topic", "revision", "event_type",
                      instant(F.col("ts") - F.expr("interval 1 microsecond"), spark).alias("at")).withWatermark("at", late)
    steps = e.groupBy("topic").transformWithStateInPandas(
        Transitions(), "n long, at timestamp", "Append", "EventTime", eventTimeColumnName="at")
    summed = steps.groupBy(F.window("at", _dur(every)).alias("__w")).agg(F.sum("n").alias("n"))
    steps = summed.select(F.lit(True).alias("is_delta"), F.floor(start / width).cast("long").alias("tick"), "n",
                          F.window_time("__w").alias("at"))
    rows = closed.unionByName(steps).withColumn("report", F.lit(0)).groupBy("report").transformWithStateInPandas(
        Report(), "tick long, rows long, rows_total long, jobs long", "Append", "None")
    return rows.select(tick_start("tick", every).alias("tick"), "rows", "rows_total", "jobs")


def _dur(interval: str) -> str:
    return f"{int(round(seconds(interval) * 1_000_000))} microseconds"
