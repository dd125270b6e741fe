"""Flush batches across micro-batches (W1, A1 on a stream).

The batch form (``operators.batching``) cuts a whole table: inside each tick
of a (topic, partition) every ``max_rows`` records make a flush batch.  On a
stream a tick's records may come in several micro-batches; a stateful operator
counts what it has cut of each tick so far, so the cut goes on where the last
micro-batch stopped.

Ticks are dealt over ``SLOTS`` keys of their (topic, partition): what a key
holds of a micro-batch is a few ticks of one broker partition, however hot its
topic is, and the number of keys does not grow with time.  A key remembers
the ticks within ``keep`` of its newest one; a record of an older tick is kept
too, and starts the numbers of its tick anew.

Records are expected in the order of their offsets within a partition, as a
broker delivers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from logflow.functions.timefmt import seconds, tick_of
from logflow.operators import batching

SLOTS = 64
#: The tick of records without a time.
NO_TICK = -(1 << 63)


class TickCounter(StatefulProcessor):
    """Numbers the records of each tick of a (topic, partition, slot)."""

    def __init__(self, max_rows: int, keep_ticks: int):
        self.max_rows, self.keep_ticks = max_rows, keep_ticks

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "ticks array<long>, rows array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["tick", "offset"], kind="stable")
        known = dict(zip(*self.seen.get())) if self.seen.exists() else {}
        nth = pdf.groupby("tick").cumcount().to_numpy() + pdf["tick"].map(known).fillna(0).to_numpy(np.int64)
        for tick, n in pdf["tick"].value_counts().items():
            known[int(tick)] = known.get(int(tick), 0) + int(n)
        newest = max(known)
        kept = {t: n for t, n in known.items() if t >= newest - self.keep_ticks or t == NO_TICK}
        self.seen.update((list(kept), list(kept.values())))
        yield pdf.drop(columns="slot").assign(batch_seq=nth // self.max_rows)

    def close(self) -> None:
        pass


def assign_batches_stream(records: DataFrame, max_rows: int = batching.MAX_ROWS,
                          max_wait: str | float = batching.MAX_WAIT, keep: str | float = "1 hour") -> DataFrame:
    """``batching.assign_batches`` on a stream: adds ``tick`` and
    ``batch_seq``.  Start the query inside ``state.operator_state``."""
    tick = F.coalesce(tick_of("ts", max_wait), F.lit(NO_TICK))
    r = records.withColumn("tick", tick).withColumn("slot", F.pmod("tick", F.lit(SLOTS)))
    out = T.StructType([f for f in r.schema.fields if f.name != "slot"] + [T.StructField("batch_seq", T.LongType())])
    cut = r.groupBy("topic", "partition", "slot").transformWithStateInPandas(
        TickCounter(max_rows, max(1, int(seconds(keep) / seconds(max_wait)))), out, "Append", "None")
    return cut.withColumn("tick", F.nullif("tick", F.lit(NO_TICK)))
