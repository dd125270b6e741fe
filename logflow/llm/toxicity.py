"""Toxicity (3): a convolutional text classifier in numpy.

A word's embedding is the mean of hashed embeddings of the word and of its
first 3 to 6 letters.  Filters of widths 1, 2 and 3 run over all words of the
whole text; each filter's maximum goes through a rectifier into a logistic
output, whose slope and offset are then calibrated.  Training runs on the
driver over a bounded sample of labelled rows: at most ``max_per_class`` rows
of either label, texts of at most ``max_train_chars`` characters, chosen by a
hash of doc_id, and only from rows whose crc32(doc_id as text) mod 3 is 0.
All labelled rows with remainder 2, of any length, calibrate the output and,
for each language, the threshold at which a document is rejected.  Every row is
scored once, into a written table of margins; the labelled ones among them are
counted by language, label and bin, so no sample moves the share of the
labels, and slope, offset and thresholds are applied to the written margins.  Labels, lang, source and doc_id are no
inputs of a score; lang only picks the threshold.

Null text counts as empty and gets a score too; null or unknown languages use
the general threshold; rows without doc_id are left out of ``score_toxicity``;
repeated rows give a row each; an empty table gives no row.  Without labels
of both kinds every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logflow.llm._common import ASCII_LOWER, SLICE_ROWS, release_memory, stored, use_memo

WIDTHS = (1, 2, 3)
#: (width, offset) of every column block of the filters' weights
SLOTS = [(w, o) for w in WIDTHS for o in range(w)]
PAD = max(WIDTHS) - 1
PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def text_words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").translate(ASCII_LOWER))


def word_buckets(word: bytes, bits: int) -> list[int]:
    """Buckets of a word and of its prefixes; the kind is part of the hash.
    Prefixes count letters, so a cut never falls inside one."""
    s = word.decode("utf-8", "ignore")
    keys = [b"w" + word] + [b"%d" % k + s[:k].encode("utf-8") for k in PREFIXES]
    return [zlib.crc32(k) & ((1 << bits) - 1) for k in keys]


class Vocabulary(dict):
    """word -> row; rows of new words are kept until they are computed."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self.words) + 1
        self.words.append(word)
        return len(self.words)


def layout(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows one after another with padding rows (0) between documents;
    the first position and the number of window positions of each."""
    sizes = np.asarray([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 1) + PAD)])
    flat = np.zeros(starts[-1], dtype=np.int64)
    for a, d in zip(starts, docs):
        flat[a:a + len(d)] = d
    return flat, starts[:-1], np.maximum(sizes, 1)


class Classifier:
    def __init__(self, bits: int = 20, dim: int = 8, filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bits, self.filters = bits, filters
        self.emb = (0.02 * rng.standard_normal((1 << bits, dim))).astype(np.float32)
        self.w = (0.5 * rng.standard_normal((dim, len(SLOTS) * filters))).astype(np.float32)
        self.b = np.zeros(len(WIDTHS) * filters, np.float32)
        self.v = (0.3 * rng.standard_normal(len(WIDTHS) * filters)).astype(np.float32)
        self.c = np.float32(0)
        self.slope, self.offset = 1.0, 0.0

    def pooled(self, a: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum and its position for each document and filter; ``a`` has
        the products of all word rows with the filters' weights."""
        n, f = len(a), self.filters
        tops, spots = [], []
        for w in WIDTHS:
            conv = np.zeros((n, f), np.float32)
            for k, (width, o) in enumerate(SLOTS):
                if width == w:
                    conv[:n - o] += a[o:, k * f:(k + 1) * f]
            at = np.stack([s + conv[s:s + m].argmax(axis=0) for s, m in zip(starts.tolist(), sizes.tolist())])
            tops.append(conv[at, np.arange(f)])
            spots.append(at)
        return np.concatenate(tops, axis=1), np.concatenate(spots, axis=1)

    def fit(self, docs: list[np.ndarray], buckets: np.ndarray, y: np.ndarray, *, epochs: int = 6, batch: int = 64,
            rate: float = 0.02, min_docs: int = 3, min_z: float = 2.0, seed: int = 7) -> None:
        """``buckets``: five for each word row, row 0 is padding.  Buckets in
        fewer than ``min_docs`` training rows, or whose share of label 1 is
        within ``min_z`` standard deviations of chance, stay 0: they would
        only be learned by heart."""
        df, ones = np.zeros(len(self.emb), np.int32), np.zeros(len(self.emb), np.int32)
        for d, label in zip(docs, y):
            held = np.unique(buckets[np.unique(d)])
            df[held] += 1
            ones[held] += int(label)
        share = y.mean()
        z = (ones - share * df) / np.sqrt(share * (1 - share) * np.maximum(df, 1))
        usable = (df >= min_docs) & (np.abs(z) >= min_z)
        self.emb[~usable] = 0
        rng = np.random.default_rng(seed)
        f = self.filters
        dense = [self.w, self.b, self.v]
        m1 = [np.zeros_like(p) for p in dense]
        m2 = [np.zeros_like(p) for p in dense]
        seen = np.zeros(len(self.emb), np.float32)
        weight = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for k in range(0, len(order), batch):
                some = order[k:k + batch]
                flat, starts, sizes = layout([docs[i] for i in some])
                uniq, inv = np.unique(flat, return_inverse=True)
                x = self.emb[buckets[uniq]].mean(axis=1)
                x[uniq == 0] = 0
                top, spot = self.pooled((x @ self.w)[inv], starts, sizes)
                hid = np.maximum(top + self.b, 0)
                p = 1 / (1 + np.exp(-np.clip(hid @ self.v + self.c, -30, 30)))
                d = ((p - y[some]) * weight[some] / len(some)).astype(np.float32)
                dh = d[:, None] * self.v * (hid > 0)
                dw, dx = np.zeros_like(self.w), np.zeros_like(x)
                for s, (width, o) in enumerate(SLOTS):
                    cols = slice(WIDTHS.index(width) * f, (WIDTHS.index(width) + 1) * f)
                    rows = inv[np.minimum(spot[:, cols] + o, len(inv) - 1)]
                    for j in range(f):
                        dw[:, s * f + j] = x[rows[:, j]].T @ dh[:, cols][:, j]
                        np.add.at(dx, rows[:, j], dh[:, cols][:, j:j + 1] * self.w[:, s * f + j])
                grads = [dw, dh.sum(0), hid.T @ d]
                step += 1
                for i, (prm, g) in enumerate(zip(dense, grads)):
                    m1[i] = 0.9 * m1[i] + 0.1 * g
                    m2[i] = 0.99 * m2[i] + 0.01 * g * g
                    prm -= rate * (m1[i] / (1 - 0.9 ** step)) / (np.sqrt(m2[i] / (1 - 0.99 ** step)) + 1e-6)
                self.c -= np.float32(rate * 5 * d.sum())
                hot = np.flatnonzero((dx != 0).any(axis=1) & (uniq > 0))
                rows = buckets[uniq[hot]].ravel()
                g = np.repeat(dx[hot] / buckets.shape[1], buckets.shape[1], axis=0)
                ok = usable[rows]
                g = g[ok]
                rows, where = np.unique(rows[ok], return_inverse=True)
                total = np.zeros((len(rows), g.shape[1]), np.float32)
                np.add.at(total, where, g)
                seen[rows] += (total ** 2).mean(axis=1)
                self.emb[rows] -= 0.1 * total / (np.sqrt(seen[rows])[:, None] + 1e-7)
            self.emb *= np.float32(0.98)
        size = np.abs(self.emb).max(axis=1)
        # rows near their random start say nothing; zero rows need not be shipped
        self.emb[(size < 0.1) | (seen == 0)] = 0

    def small(self) -> Small:
        rows = np.flatnonzero(self.emb.any(axis=1))
        return Small(self, {int(r): k for k, r in enumerate(rows)}, self.emb[rows])


class Small:
    """What tasks need: the rows in use and the dense weights."""

    #: Words remembered by a task, and table rows (192 bytes each) for those
    #: of them that have trained buckets.
    limit, table_rows = 100_000, 1 << 15

    def __init__(self, model: Classifier, row_of: dict[int, int], emb: np.ndarray):
        self.bits, self.filters, self.row_of = model.bits, model.filters, row_of
        self.slope, self.offset = model.slope, model.offset
        self.b, self.v, self.c = model.b, model.v, float(model.c)
        self.products = emb @ model.w / (1 + len(PREFIXES)) if len(emb) else np.zeros((0, model.w.shape[1]), np.float32)
        self.reset()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "table", "used")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.reset()

    def reset(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.table, self.used = np.zeros((1024, len(SLOTS) * self.filters), np.float32), 1

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Table rows of words; row 0 for words without a trained bucket."""
        try:
            return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        except KeyError:
            pass
        for w in set(words).difference(self.memo):
            hits = [self.row_of[k] for k in word_buckets(w, self.bits) if k in self.row_of]
            if hits:
                if self.used == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[self.used] = self.products[hits].sum(axis=0)
                self.used += 1
            self.memo[w] = self.used - 1 if hits else 0
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def margins(self, texts: list[str]) -> np.ndarray:
        """One text after another: windows that hold no trained word have the
        value 0, so only the others are computed."""
        f, out = self.filters, np.zeros(len(texts))
        use_memo("toxicity", self.memo)
        for k, t in enumerate(texts):
            if len(self.memo) > self.limit or self.used > self.table_rows:
                self.reset()
            r = self.rows(text_words(t))
            n = max(1, len(r))
            hot = np.flatnonzero(r)
            table = self.table[r[hot]]
            top = []
            for w in WIDTHS:
                at = np.unique(np.concatenate([hot - o for o in range(w)])) if len(hot) else hot
                at = at[at >= 0]
                best = np.zeros(f, np.float32) if len(at) < n else np.full(f, -np.inf, np.float32)
                if len(at):
                    conv = np.zeros((len(at), f), np.float32)
                    for s, (width, o) in enumerate(SLOTS):
                        if width == w:
                            j = np.searchsorted(hot, at + o)
                            ok = (j < len(hot)) & (hot[np.minimum(j, len(hot) - 1)] == at + o)
                            conv[ok] += table[j[ok], s * f:(s + 1) * f]
                    best = np.maximum(best, conv.max(axis=0))
                top.append(best)
            out[k] = np.maximum(np.concatenate(top) + self.b, 0) @ self.v + self.c
        return out

    def calibrated(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.calibrated(self.margins(texts))


def calibrate(margins: np.ndarray, y: np.ndarray, count: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope (at least 0.1) and offset of a logistic curve, by Newton steps
    with a weak prior; every row stands for ``count`` rows."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w, d = (p * (1 - p) + 1e-6) * count, (p - y) * count
        ga, gb = (d * margins).sum() + 0.1 * (a - 1), d.sum() + 0.1 * b
        haa, hab, hbb = (w * margins ** 2).sum() + 0.1, (w * margins).sum(), w.sum() + 0.1
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = max(0.1, a - np.clip(da, -1, 1)), b - np.clip(db, -2, 2)
    return float(a), float(b)


def best_threshold(scores: np.ndarray, clean: np.ndarray, toxic: np.ndarray, general: float) -> float:
    """The threshold with the best F1, nearest to ``general`` among equals;
    ``clean`` and ``toxic`` rows have each score."""
    if not toxic.any():
        return general
    order = np.argsort(scores)
    s = scores[order]
    cuts = np.unique(np.concatenate([[general], (s[1:] + s[:-1]) / 2]))
    at = np.searchsorted(s, cuts)  # rows from here on reach the cut
    caught, passed = (np.append(np.cumsum(x[order][::-1])[::-1], 0)[at] for x in (toxic, clean))
    f1 = 2 * caught / np.maximum(1, caught + passed + toxic.sum())
    return float(max(zip(f1.tolist(), (-np.abs(cuts - general)).tolist(), cuts.tolist()))[2])


class Toxicity:
    def __init__(self, model: Small | None, prior: float, thresholds: dict[str, float], general: float):
        self.model, self.prior, self.thresholds, self.general = model, prior, thresholds, general

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.model.scores(texts) if self.model else np.full(len(texts), self.prior)

    def rejected(self, scores: np.ndarray, langs: list) -> np.ndarray:
        return scores >= np.asarray([self.thresholds.get(x, self.general) for x in langs])


def _fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 3


#: Bins of the uncalibrated output for each unit, from -LIMIT to LIMIT.
BINS, LIMIT = 64, 30


def margin_counts(scored: DataFrame, known: DataFrame) -> pd.DataFrame:
    """lang, margin (middle of a bin), label, count of all labelled rows; of
    rows that repeat a doc_id the one with the smallest text hash.  ``scored``
    has doc_id, lang, name (hash of the row) and margin.  At most one row for
    each language, label and bin reaches the driver."""
    one = scored.join(known, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("name", "lang", F.floor(F.col("margin") * BINS).alias("at"), "_label")).alias("r"))
    got = one.groupBy("r.lang", "r.at", "r._label").agg(F.count(F.lit(1)).alias("count")).toPandas()
    return got.assign(margin=(got["at"].to_numpy(float) + 0.5) / BINS).sort_values(["lang", "at", "_label"])


def _known(labels: DataFrame) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("_label"))
    return known.groupBy("doc_id").agg(F.max("_label").alias("_label"))


def _lang(docs: DataFrame):
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def train(docs: DataFrame, labels: DataFrame, *, max_per_class: int = 2000,
          max_train_chars: int = 12_000) -> tuple[Small | None, float]:
    """The model before calibration (None without labels of both kinds) and
    the share of label 1."""
    known = _known(labels)
    parts = [known.where((F.col("_label") == k) & (_fold() == 0)).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(max_per_class) for k in (0, 1)]
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = (rows.where(F.length("text") <= max_train_chars)
            .join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
            # of rows that repeat a doc_id one, so that the sample stays bounded
            .groupBy("doc_id").agg(F.min(F.struct("text", "_label")).alias("r")).select("doc_id", "r.*")).toPandas()
    rows = rows.sort_values("doc_id")
    y = rows["_label"].to_numpy(np.float32)
    if len(np.unique(y)) < 2:
        return None, float(y.mean()) if len(y) else 0.0
    vocab = Vocabulary()
    words = [np.fromiter(map(vocab.__getitem__, text_words(t)), np.int64) for t in rows["text"].tolist()]
    full = Classifier()
    buckets = np.asarray([[0] * (1 + len(PREFIXES))] + [word_buckets(w, full.bits) for w in vocab.words])
    full.fit(words, buckets, y)
    return full.small(), float(y.mean())


def calibrated(model: Small | None, prior: float, scored: DataFrame, labels: DataFrame, general: float = 0.7) -> Toxicity:
    """``model`` with slope, offset and language thresholds from all labelled
    rows of remainder 2; ``scored`` has doc_id, lang, name and margin."""
    thresholds: dict[str, float] = {}
    if model is None:
        return Toxicity(None, prior, {}, general)
    check = margin_counts(scored.where(_fold() == 2), _known(labels).where(_fold() == 2))
    if len(np.unique(check["_label"])) == 2:
        yc, count, margins = check["_label"].to_numpy(float), check["count"].to_numpy(float), check["margin"].to_numpy()
        model.slope, model.offset = calibrate(margins, yc, count)
        s = model.calibrated(margins)
        for name in check["lang"].dropna().unique().tolist():
            own = (check["lang"] == name).to_numpy()
            thresholds[name] = best_threshold(s[own], count[own] * (yc[own] != 1), count[own] * (yc[own] == 1), general)
    model.reset()
    return Toxicity(model, prior, thresholds, general)


def _with_margins(rows: DataFrame, model: Small | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``rows`` and ``margin``, the output for ``text`` (where
    there is none, that of the first column, a struct) within +-LIMIT; every
    row is scored once."""
    inside = "text" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                some = b.slice(at, SLICE_ROWS)
                held = some.column(b.schema.get_field_index(columns[0]))
                texts = [t or "" for t in (pc.struct_field(held, "text") if inside else some.column(
                    b.schema.get_field_index("text"))).to_pylist()]
                m = np.clip(model.margins(texts), -LIMIT, LIMIT) if model else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*(some.column(b.schema.get_field_index(c)) for c in columns),
                                                  pa.array(m, pa.float64())], [*columns, "margin"])
        release_memory()

    schema = rows.select(*columns).schema
    return rows.mapInArrow(run, type(schema)([*schema.fields, T.StructField("margin", T.DoubleType())]))


def _judged(model: Toxicity) -> tuple[Column, Column]:
    """Score of ``margin``, and whether the row's language rejects it."""
    if model.model is None:
        score = F.lit(float(model.prior))
    else:
        z = F.least(F.greatest(F.lit(model.model.slope) * F.col("margin") + F.lit(model.model.offset), F.lit(-30.0)), F.lit(30.0))
        score = 1 / (1 + F.exp(-z))
    cut = F.lit(model.general)
    for name, threshold in model.thresholds.items():
        cut = F.when(F.col("lang") == name, threshold).otherwise(cut)
    return score, score >= cut


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, general: float = 0.7, **options) -> Toxicity:
    """The calibrated model, for texts outside of ``docs``."""
    model, prior = train(docs, labels, **options)
    return calibrated(model, prior, _scored(docs, model), labels, general)


def _scored(docs: DataFrame, model: Small | None) -> DataFrame:
    """doc_id, lang, held_out, name (hash of the row) and margin of the rows
    with a doc_id, written once."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), _lang(docs).alias("lang"))
    rows = rows.select("doc_id", "lang", (_fold() == 1).alias("held_out"), F.xxhash64("text", "lang").alias("name"), "text")
    return stored(_with_margins(rows, model, ["doc_id", "lang", "held_out", "name"]), "scored")


def score_toxicity(docs: DataFrame, labels: DataFrame, *, general: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7), rejected (by the
    threshold of the document's language)."""
    small, prior = train(docs, labels, **options)
    scored = _scored(docs, small)
    score, rejected = _judged(calibrated(small, prior, scored, labels, general))
    return scored.select("doc_id", "held_out", score.alias("score"), (score >= 0.7).cast("int").alias("predicted"),
                         rejected.alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, general: float = 0.7, **options) -> DataFrame:
    """``docs`` without the rejected ones, all columns kept; rows without
    doc_id are judged like the others."""
    small, prior = train(docs, labels, **options)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), _lang(docs).alias("lang"),
                       F.xxhash64("text", _lang(docs)).alias("name"))
    scored = stored(_with_margins(rows, small, ["row", "doc_id", "lang", "name"]), "scored")
    labelled = scored.where(F.col("doc_id").isNotNull()).select("doc_id", "lang", "name", "margin")
    _, rejected = _judged(calibrated(small, prior, labelled, labels, general))
    return scored.where(~rejected).select("row.*")
