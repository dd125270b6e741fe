"""Best-fit packing (9): configuration linear program over the length
histogram.

Documents become ids (plus an end id); those longer than ``capacity`` are cut
into full pieces, the first one shorter.  The number of pieces of each length
is a histogram of ``capacity`` entries, whatever the corpus.  A configuration
is a multiset of lengths that fits one sequence.  The covering program over
all configurations is solved in fractions by multiplicative weights: a
knapsack dynamic program prices the best configuration under the current
weights (and the best one for each of the longest uncovered lengths), a part
of the open demand is met by it, and the weights of its lengths shrink by how
much of their demand is met.  The fractional usages are then rounded to whole
ones that never exceed the demand, and the remainder is packed by best fit
over the histogram.  The weights also price a lower bound for the number of
sequences.

Pieces get their places by rank within their length: equal lengths are
interchangeable, and ranks are counted in salted groups, so a length that a
third of all pieces share is never gathered.

Null text is an empty text (one end id); rows without doc_id are left out;
repeated rows are documents of their own; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logflow.llm._common import id_text, stored
from logflow.llm._tokens import encoder, tokenizer_path

PIECES = "doc_id long, copy long, piece int, start long, length int, ids_crc32 long"


def cut_pieces(docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        end = np.asarray([end_id], "<u4").tobytes()
        for pdf in batches:
            for k in range(0, len(pdf), 500):
                some, rows = pdf.iloc[k:k + 500], []
                for doc_id, copy, raw in zip(some["doc_id"].tolist(), some["copy"].tolist(),
                                             enc.encode(some["text"].tolist())):
                    raw += end
                    n = len(raw) // 4
                    full = -(-n // capacity) - 1
                    at = 0
                    for piece in range(full + 1):
                        size = n - full * capacity if piece == 0 else capacity
                        rows.append((doc_id, copy, piece, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                        at += size
                yield pd.DataFrame(rows, columns=["doc_id", "copy", "piece", "start", "length", "ids_crc32"])

    # ``copy`` tells repeated rows of one doc_id apart
    marked = id_text(docs).withColumn("copy", F.monotonically_increasing_id())
    return marked.mapInPandas(cut, PIECES)


def _knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the largest value of a configuration of at most c; pick[c]:
    the index of a length it takes, or -1."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = upto[c]
        if not k:
            continue
        got = best[c - lengths[:k]] + values[:k]
        j = int(got.argmax())
        if got[j] > 0:
            best[c], pick[c] = got[j], j
    return best, pick


def _configuration(first: int, left: np.ndarray, lengths, values, best, capacity: int) -> list[int]:
    """Follow the program from the given length (-1: none), using no length
    more often than it is left."""
    used: dict[int, int] = {}
    out, c = [], capacity
    if first >= 0:
        out, c, used[first] = [first], capacity - int(lengths[first]), 1
    while True:
        k = int(np.searchsorted(lengths, c, side="right"))
        if not k:
            return out
        got = best[c - lengths[:k]] + values[:k]
        got[left[:k] <= 0] = -1
        for j, n in used.items():
            if j < k and left[j] <= n:
                got[j] = -1
        j = int(got.argmax())
        if got[j] <= 0:
            return out
        out.append(j)
        used[j] = used.get(j, 0) + 1
        c -= int(lengths[j])


def fractional_program(lengths: np.ndarray, demand: np.ndarray, capacity: int, *, share: float = 0.5, eta: float = 1.0,
                       seeds: int = 8, rest: float = 0.05,
                       power: float = 1.05) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional usages of configurations (tuples of lengths) that together
    hold exactly the demand, and a lower bound of the number of sequences.

    Each step uses a priced configuration for ``share`` of what its scarcest
    length still asks for (for all of it below ``rest`` of that length's
    demand); the weights fall with the demand that is met.  At first they are
    ``power`` of the length, so that long pieces, which fit worst, go early."""
    usage: dict[tuple[int, ...], float] = {}
    left = demand.astype(float)
    bound = float(np.dot(lengths, demand)) / capacity if len(lengths) else 0.0
    while left.any():
        values = (lengths / capacity) ** power * np.exp(eta * (left / demand - 1.0)) * (left > 0)
        best, _ = _knapsack(lengths, values, capacity)
        if best[capacity] > 0:  # weights scaled so that no configuration is worth over 1 are a dual solution
            bound = max(bound, float(np.dot(values, demand)) / float(best[capacity]))
        open_ = np.flatnonzero(left)
        for first in [*open_[::-1][:seeds].tolist(), -1]:
            if first >= 0 and not left[first] or not left.any():
                continue
            conf = _configuration(first, np.ceil(left), lengths, values, best, capacity)
            if not conf:
                continue
            js, counts = np.unique(conf, return_counts=True)
            ratio = left[js] / counts
            tight = int(ratio.argmin())
            times = float(ratio[tight])
            if left[js[tight]] > rest * demand[js[tight]]:
                times *= share
            left[js] -= times * counts
            left[js[left[js] < 1e-6]] = 0.0
            key = tuple(int(lengths[j]) for j in sorted(conf, reverse=True))
            usage[key] = usage.get(key, 0.0) + times
    return usage, bound


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing over a histogram: (lengths, sequences) that are
    alike.  Sequences with the same room take a length in bulk, so the work
    grows with the number of lengths and not of pieces."""
    groups: dict[int, list[tuple[list[int], int]]] = {}
    for n in sorted(counts, reverse=True):
        c = counts[n]
        while c:
            room = min((r for r, held in groups.items() if r >= n and held), default=None)
            if room is None:
                conf, k, room = [], -(-c // (capacity // n)), capacity
            else:
                conf, k = groups[room].pop()
            per = room // n
            full = min(k, c // per)
            rest = min(c - full * per, per) if full < k else 0
            if full:
                groups.setdefault(room - per * n, []).append((conf + [n] * per, full))
            if rest:
                groups.setdefault(room - rest * n, []).append((conf + [n] * rest, 1))
            unused = k - full - (1 if rest else 0)
            if unused:
                groups.setdefault(room, []).append((conf, unused))
            c -= full * per + rest
    return [g for held in groups.values() for g in held]


def _rounded(usage: dict[tuple[int, ...], float], todo: dict[int, int], capacity: int, slack: int,
             up: float) -> list[tuple[list[int], int]]:
    """Usages of configurations that leave at most ``slack`` free, rounded
    down (``up``: added before), never beyond the demand; best fit packs what
    is left."""
    left, plan = dict(todo), []
    for conf, x in sorted(usage.items(), key=lambda e: (sum(e[0]) < capacity - slack, -sum(e[0]), -e[1], e[0])):
        if sum(conf) < capacity - slack:
            break
        counts = Counter(conf)
        times = min(int(x + up), min(left[n] // k for n, k in counts.items()))
        if times > 0:
            for n, k in counts.items():
                left[n] -= times * k
            plan.append((list(conf), times))
    return plan + best_fit({n: c for n, c in left.items() if c}, capacity)


def solve_configurations(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[list[int], int]], float]:
    """Configurations (lists of lengths) with whole usages that together hold
    exactly the histogram, and a lower bound of the number of sequences.

    The fractional program is rounded in several ways (configurations with
    how much free room are kept, and from which fraction on they are rounded
    up); the plan with the fewest sequences is taken, best fit alone among
    them, so it is never worse than best-fit decreasing."""
    todo = {int(n): int(k) for n, k in histogram.items() if k > 0}
    whole = todo.pop(capacity, 0)
    lengths = np.asarray(sorted(todo), dtype=np.int64)
    demand = np.asarray([todo[int(n)] for n in lengths], dtype=np.int64)
    usage, bound = fractional_program(lengths, demand, capacity)
    plan = best_fit(todo, capacity)
    for slack in (0, 1, 2, 4, 16, 64, capacity):
        for up in (1e-6, 0.5, 1 - 1e-6):
            other = _rounded(usage, todo, capacity, slack, up)
            if sum(k for _, k in other) < sum(k for _, k in plan):
                plan = other
    return ([([capacity], whole)] if whole else []) + plan, whole + bound


def pack(spark: SparkSession, docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 2,
         capacity: int = 1024, group_rows: int = 1 << 13) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(cut_pieces(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity), "pieces")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = solve_configurations(histogram, capacity)

    # places of each length, in the order of the plan: ranks lo.. belong to
    # a configuration that is used from sequence ``first`` on
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for conf, times in plan:
        at = 0
        for n in sorted(set(conf), reverse=True):
            k = conf.count(n)
            lo = taken.get(n, 0)
            slots.setdefault(n, []).append((lo, first, k, at))
            taken[n] = lo + k * times
            at += k * n
        first += times
    table = {n: np.asarray(rows, dtype=np.int64).T for n, rows in slots.items()}

    groups = max(1, sum(histogram.values()) // group_rows)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(groups)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "salt").orderBy("doc_id", "copy", "piece")
    ranked = (salted.withColumn("nth", F.row_number().over(inside)).join(bases, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("base") + F.col("nth") - 1).alias("rank")))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank, length = pdf["rank"].to_numpy(), pdf["length"].to_numpy()
            seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                lo, begin, k, at = table[n]
                j = np.searchsorted(lo, rank[rows], side="right") - 1
                inner = rank[rows] - lo[j]
                seq[rows] = begin[j] + inner // k[j]
                off[rows] = at[j] + inner % k[j] * n
            yield pdf.drop(columns="rank").assign(length=length.astype(np.int64), sequence_id=seq, offset=off)

    return ranked.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
