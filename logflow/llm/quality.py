"""Quality rules (6): gradient-boosted trees over document statistics.

Statistics of every whole text are computed in the tasks.  The trees are
fitted with numpy on a bounded sample of labelled rows (``max_rows``, chosen
by a hash of doc_id), with histogram splits and monotonic constraints: a
larger share of symbols, repeated lines or repeated words never raises the
score.  The fitted trees are flattened into node arrays (feature, threshold,
children, value), and whole batches of rows walk them together.

A document fails the base rule with fewer than 50 words or when over half of
its words lie in repeated windows of three; the others are kept if their
score reaches ``keep_at``.  Null text counts as empty; rows without doc_id are
left out; repeated rows give a row each; an empty table gives no row.  With
no labels of both kinds every score is 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import WORD_HASHES, id_text, shingle_hashes

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "marks",
            "bars", "line_words", "common"]
#: -1: a larger value never raises the score; 0: free
MONOTONE = [0, 0, -1, -1, -1, 0, 0, 0, 0, 0, 0, 0]

_BLANKS = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_MARKS = b".,;:!?"


def repeated_words(hashes: np.ndarray) -> int:
    """Words covered by a three-word window that is found twice or more."""
    n = len(hashes)
    if n < 4:
        return 0
    _, inverse, counts = np.unique(shingle_hashes(hashes, 3), return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + 3, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def statistics(text: str) -> list[float]:
    """BASE followed by FEATURES."""
    b = text.encode("utf-8")
    words = b.split()
    n = len(words)
    count = lambda chars: len(b) - len(b.translate(None, chars))
    chars = len(text) - count(_BLANKS)
    symbols = count(_SYMBOLS)
    lines = [x for x in b.split(b"\n") if x.strip(_BLANKS)]
    dup = len(lines) - len(set(lines))
    h = WORD_HASHES.of(words)
    repeat = repeated_words(h)
    m, c = max(1, n), max(1, chars)
    distinct, counts = np.unique(h, return_counts=True)
    return [n, chars, symbols, dup, repeat,
            float(np.log1p(n)), chars / m, symbols / c, dup / max(1, len(lines)), repeat / m, len(distinct) / m,
            count(_UPPER) / c, count(_DIGITS) / c, count(_MARKS) / m, b.count(b"|") / m, n / max(1, len(lines)),
            (float(np.sort(counts)[-5:].sum()) / m) if n else 0.0]


def measure(docs: DataFrame) -> DataFrame:
    names = [*BASE, *FEATURES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([statistics(t) for t in pdf["text"].tolist()], columns=names, dtype="float64")
            out = out.astype({k: "int64" for k in BASE})
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", " + ", ".join(f"{k} double" for k in FEATURES)
    return id_text(docs).mapInPandas(run, schema)


class Trees:
    """Flattened trees; ``score`` walks all rows of a batch together."""

    def __init__(self, prior: float = 40.0):
        self.prior = prior
        self.roots: list[int] = []
        self.feature: list[int] | np.ndarray = []
        self.threshold: list[float] | np.ndarray = []
        self.left: list[int] | np.ndarray = []
        self.right: list[int] | np.ndarray = []
        self.value: list[float] | np.ndarray = []
        self.depth = 0

    def node(self, value: float) -> int:
        for a, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0), (self.value, value)):
            a.append(x)
        return len(self.value) - 1

    def freeze(self) -> Trees:
        for name in ("feature", "threshold", "left", "right", "value"):
            setattr(self, name, np.asarray(getattr(self, name)))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                go = x[rows, f] <= self.threshold[at]
                at = np.where(f < 0, at, np.where(go, self.left[at], self.right[at]))
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], *, n_trees: int = 60, depth: int = 4,
              rate: float = 0.15, bins: int = 64, smooth: float = 1.0, min_rows: float = 5.0) -> Trees:
    """Second-order boosting of the logistic loss on binned features."""
    if len(np.unique(y)) < 2:
        return Trees(40.0 if not len(y) or y[0] else -40.0).freeze()
    trees = Trees(float(np.log(y.mean() / (1 - y.mean()))))
    trees.depth = depth
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(x), trees.prior)

    def grow(rows: np.ndarray, level: int, lo: float, hi: float, g: np.ndarray, h: np.ndarray) -> int:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        leaf = float(np.clip(-sum_g / (sum_h + smooth), lo, hi))
        me = trees.node(rate * leaf)
        if level == depth or len(rows) < 2 * min_rows:
            margin[rows] += rate * leaf
            return me
        best = (1e-6, -1, 0, 0.0)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
            wl = np.clip(-gl / (hl + smooth), lo, hi)
            wr = np.clip(-(sum_g - gl) / (sum_h - hl + smooth), lo, hi)
            gain = -(gl * wl + 0.5 * (hl + smooth) * wl ** 2 + (sum_g - gl) * wr + 0.5 * (sum_h - hl + smooth) * wr ** 2)
            gain += sum_g * leaf + 0.5 * (sum_h + smooth) * leaf ** 2
            bad = (nl < min_rows) | (len(rows) - nl < min_rows)
            if monotone[f]:
                bad |= monotone[f] * (wr - wl) < 0
            gain[bad] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float((wl[k] + wr[k]) / 2))
        gain, f, k, mid = best
        if f < 0:
            margin[rows] += rate * leaf
            return me
        go = binned[rows, f] <= k
        # below a constrained split both sides stay on their side of its middle
        l_lo, l_hi, r_lo, r_hi = lo, hi, lo, hi
        if monotone[f] > 0:
            l_hi = r_lo = mid
        elif monotone[f] < 0:
            l_lo = r_hi = mid
        trees.feature[me], trees.threshold[me] = f, float(cuts[f][k])
        trees.left[me] = grow(rows[go], level + 1, l_lo, l_hi, g, h)
        trees.right[me] = grow(rows[~go], level + 1, r_lo, r_hi, g, h)
        return me

    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        trees.roots.append(grow(np.arange(len(x)), 0, -np.inf, np.inf, p - y, p * (1 - p)))
    return trees.freeze()


def fit_quality(docs: DataFrame, labels: DataFrame, *, max_rows: int = 10_000) -> Trees:
    """Fit on at most ``max_rows`` labelled documents (lowest hash of doc_id)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("_label"))
    known = known.groupBy("doc_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = measure(id_text(docs).join(F.broadcast(known), "doc_id", "left_semi")).join(F.broadcast(known), "doc_id").toPandas()
    rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
    return fit_trees(rows[FEATURES].to_numpy(float), rows["_label"].to_numpy(float), MONOTONE)


def quality_rules(docs: DataFrame, labels: DataFrame, *, max_rows: int = 10_000, keep_at: float = 0.5) -> DataFrame:
    """doc_id, BASE, base_failed, kept, score."""
    trees = fit_quality(docs, labels, max_rows=max_rows)

    def verdict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[["doc_id", *BASE]].copy()
            n = out["n_words"]
            out["base_failed"] = (n < 50) | (100 * out["n_repeat_words"] > 50 * n)
            out["score"] = trees.score(pdf[FEATURES].to_numpy(float))
            out["kept"] = ~out["base_failed"] & (out["score"] >= keep_at)
            yield out

    return measure(docs).mapInPandas(verdict, "doc_id long, " + ", ".join(f"{k} long" for k in BASE)
                                     + ", base_failed boolean, score double, kept boolean")
