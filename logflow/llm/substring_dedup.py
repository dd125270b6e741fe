"""Substring dedup (5): a compressed FM-index for each shard.

A window is ``window`` consecutive words of one document; a word is removed if
a window that covers it also starts in a document with a smaller doc_id.

1. Each window picks the run of ``anchor`` words with the smallest hash in it.
   Equal windows pick equal anchors.  Consecutive windows with one anchor form
   a segment; a document sends each of its segments once, as hashes.
2. Anchors of one document only cannot hold a repeated window and are left.
   Equal segments are collapsed: every document but the first loses all
   windows of a segment.
3. What is left is to find windows that different segments share.  The words
   of these segments (once each, from their first document) are dealt into
   shards by anchor.  A shard is indexed: suffixes sorted by their first 16
   words, their preceding words in a wavelet matrix of packed bits.  All
   segments are streamed against it by backward search; a window's interval
   names all its occurrences, and the smallest document in it decides.
4. The segments and window masks of every document are joined to its text.

Null text and texts without words lose nothing.  Rows without doc_id are left
out of the result.  Rows that repeat a doc_id are judged each for itself
against smaller doc_ids only, so repeated rows lose the same words.  An empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logflow.llm._common import SLICE_ROWS, WORD_HASHES, id_text, map_slices, mix, shingle_hashes, stored

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.uint64((1 << 20) - 1)
ORDER = 16  # suffixes are sorted by so many words


def segments(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, segment hash, first window, windows) of all segments."""
    n = len(words)
    if n < window:
        z = np.zeros(0, np.uint64)
        return z, z, np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = WORD_HASHES.of(words)
    g = shingle_hashes(h, anchor)
    wide = window - anchor + 1
    # mixed again: the order of anchors must not follow the order of segments;
    # the low bits hold the place, so a running minimum also tells where it is
    at = np.arange(len(g), dtype=np.uint64)
    low = mix(g) & ~_PLACE | at & _PLACE
    span = 1
    while 2 * span <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < wide:
        low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
    pick = (at[:len(low)] + ((low - at[:len(low)]) & _PLACE)).astype(np.int64)
    first = np.flatnonzero(np.diff(pick, prepend=-1))
    many = np.diff(np.append(first, len(pick)))
    power = np.cumprod(np.full(n + 1, _ODD, np.uint64)) * _BACK
    back = np.cumprod(np.full(n + 1, _BACK, np.uint64)) * _ODD
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h) * power[:n], dtype=np.uint64)])
    end = first + many + window - 1
    name = mix((upto[end] - upto[first]) * back[first] + many.astype(np.uint64) * _ODD)
    return g[pick[first]], mix(name + g[pick[first]]), first, many


class WaveletMatrix:
    """rank over a sequence of symbols, on packed bits."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n, self.bits = len(symbols), max(1, int(n_symbols - 1).bit_length())
        self.levels = []
        s = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = (s >> b & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 - len(bit) % 64, np.uint8)]), bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            self.levels.append((b, packed, ones, len(bit) - int(bit.sum())))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        every = np.arange(n_symbols)
        self.start = self._walk(every, np.zeros(n_symbols, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, packed, ones, zeros in self.levels:
            word = i >> 6
            low = packed[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
            r1 = ones[word] + np.bitwise_count(low)
            i = np.where(c >> b & 1, zeros + r1, i - r1)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c stands before position i."""
        return self._walk(c, i) - self.start[c]


class FMIndex:
    """Over segments of word ids (from 1), one after another, 0 between."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = len(text)
        rank, size = text.astype(np.int64), 1
        while size < ORDER:
            second = np.zeros(n, np.int64)
            second[:n - size] = rank[size:] + 1
            key = rank * (n + n_symbols + 2) + second
            rank = np.unique(key, return_inverse=True)[1]
            size *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.before = WaveletMatrix(text[self.suffixes - 1], n_symbols)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search, for many intervals together."""
        return self.first[c] + self.before.rank(c, lo), self.first[c] + self.before.rank(c, hi)


def statistics(index: FMIndex, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of the positions ``ends`` (exclusive) of a streamed
    text, up to ``most``: length of the longest match that ends there, and the
    interval of suffixes it starts."""
    lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(index.suffixes))
    length = np.zeros(len(ends), np.int64)
    live = np.arange(len(ends))
    for k in range(1, most + 1):
        at = ends[live] - k
        live, at = live[at >= 0], at[at >= 0]
        c = text[at]
        live, c = live[c > 0], c[c > 0]
        if not len(live):
            break
        a, b = index.extend(c, lo[live], hi[live])
        ok = a < b
        live = live[ok]
        lo[live], hi[live], length[live] = a[ok], b[ok], k
    return length, lo, hi


def search_shard(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """For each segment of a shard the mask of windows that also start in a
    smaller document, if there are any."""
    pdf = pdf.drop_duplicates("seg").sort_values("seg")
    split = [w.split() for w in pdf["words"]]
    ids: dict[bytes, int] = {}
    flat: list[int] = [0]
    for words in split:
        flat += [ids.setdefault(w, len(ids) + 1) for w in words]
        flat.append(0)
    text = np.asarray(flat, dtype=np.int64)
    sizes = np.asarray([len(w) for w in split])
    begin = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(len(split)), sizes + 1)
    docs = pdf["doc_id"].to_numpy(np.int64)
    index = FMIndex(text, len(ids) + 1)
    many = np.maximum(sizes - window + 1, 0)
    seg = np.repeat(np.arange(len(split)), many)
    nth = np.arange(len(seg)) - np.repeat(np.cumsum(many) - many, many)
    length, lo, hi = statistics(index, text, begin[seg] + nth + window, window)
    # the intervals of one length are equal or disjoint
    first = np.concatenate([[np.iinfo(np.int64).max], docs[owner]])  # smallest doc_id of every text position
    by_suffix = np.append(first[index.suffixes], np.iinfo(np.int64).max)
    spans, which = np.unique(lo, return_inverse=True)
    to = np.zeros(len(spans), np.int64)
    to[which] = hi
    low = np.minimum.reduceat(by_suffix, np.stack([spans, to], axis=1).ravel())[::2] if len(spans) else spans
    hit = (length == window) & (low[which] < docs[seg])
    mask = np.zeros(len(split), dtype=np.int64)
    np.bitwise_or.at(mask, seg[hit], np.int64(1) << nth[hit])
    some = mask != 0
    return pd.DataFrame({"doc_id": docs[some], "seg": pdf["seg"].to_numpy(np.int64)[some], "mask": mask[some]})


def removed_words(words: list[bytes], wanted: dict[int, int], window: int, anchor: int) -> np.ndarray:
    """Which words the masked windows of the named segments cover."""
    out = np.zeros(len(words), dtype=bool)
    if not wanted or len(words) < window:
        return out
    _, name, first, many = segments(words, window, anchor)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    masks = np.fromiter(map(wanted.get, name.view(np.int64).tolist(), repeat(0)), np.int64, len(name))
    whole = masks == -1
    np.add.at(edge, first[whole], 1)
    np.add.at(edge, first[whole] + many[whole] + window - 1, -1)
    for k in np.flatnonzero(~whole & (masks != 0)).tolist():
        a = int(first[k])
        for j in range(int(many[k])):
            if masks[k] >> j & 1:
                edge[a + j] += 1
                edge[a + j + window] -= 1
    return np.cumsum(edge)[:-1] > 0


def repeated_segments(rows: DataFrame, *, window: int, anchor: int, shard_rows: int) -> DataFrame:
    """doc_id, found: array of (seg, mask) of the windows to remove.  ``rows``
    has doc_id and text."""
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                a, s, _, _ = segments(text.encode("utf-8").split(), window, anchor)
                s, at = np.unique(s, return_index=True)
                parts.append((a[at], s, np.full(len(s), doc_id)))
            if parts:
                a, s, d = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"anchor": a.view(np.int64), "seg": s.view(np.int64), "doc_id": d})

    group = W.partitionBy("anchor")
    same = W.partitionBy("anchor", "seg")
    sent = map_slices(rows, send, "anchor long, seg long, doc_id long")
    shared = stored(sent.withColumn("repeated", F.min("doc_id").over(group) < F.max("doc_id").over(group))
                    .withColumn("varied", F.min("seg").over(group) < F.max("seg").over(group))
                    .withColumn("first", F.min("doc_id").over(same))
                    .where("repeated and (doc_id > first or varied)")
                    .select("anchor", "seg", "doc_id", (F.col("doc_id") == F.col("first")).alias("first"), "varied"),
                    "segments")

    wanted = shared.where("first and varied").groupBy("doc_id").agg(F.collect_set("seg").alias("segs"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, segs in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), pdf["segs"]):
                words, segs = text.encode("utf-8").split(), set(segs.tolist())
                a, name, first, many = segments(words, window, anchor)
                name, at = np.unique(name.view(np.int64), return_index=True)
                for seg, k in zip(name.tolist(), at.tolist()):
                    if seg in segs:
                        out.append((int(a[k].view(np.int64)), seg, doc_id,
                                    b" ".join(words[int(first[k]):int(first[k] + many[k]) + window - 1])))
            yield pd.DataFrame(out, columns=["anchor", "seg", "doc_id", "words"])

    words = map_slices(rows.join(wanted, "doc_id"), fetch, "anchor long, seg long, doc_id long, words binary")
    shards = shared.where("first and varied").count() // shard_rows + 1
    masks = (words.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard")
             .applyInPandas(lambda pdf: search_shard(pdf, window), "doc_id long, seg long, mask long"))
    every = shared.where("not first").select("doc_id", "seg", F.lit(-1).cast("long").alias("mask"))
    return every.unionByName(masks).groupBy("doc_id").agg(F.collect_list(F.struct("seg", "mask")).alias("found"))


def _found(value) -> dict[int, int]:
    return {} if value is None else {x["seg"]: x["mask"] for x in value}


def dedup_substrings(docs: DataFrame, *, window: int = 13, anchor: int = 5, shard_rows: int = 20_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (first word, end) of
    what is removed."""
    rows = id_text(docs)
    found = repeated_segments(rows, window=window, anchor=anchor, shard_rows=shard_rows)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, some in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), pdf["found"]):
                words = text.encode("utf-8").split()
                gone = removed_words(words, _found(some), window, anchor)
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
                kept = words
                if edge:
                    kept, at = [], 0
                    for a, b in edge:
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                            [{"first": a, "end": b} for a, b in edge]))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return rows.join(found, "doc_id", "left").mapInPandas(
        cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first: long, end: long>>")


def cut_substrings(docs: DataFrame, *, window: int = 13, anchor: int = 5, shard_rows: int = 20_000) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text`` (what is kept is
    joined by one blank) and ``n_chars``, if there is one, set anew.  Texts
    that lose nothing stay as they are; all rows and columns are kept."""
    found = repeated_segments(id_text(docs), window=window, anchor=anchor, shard_rows=shard_rows)
    names = docs.columns
    joined = docs.join(found.select(F.col("doc_id").alias("_id"), F.col("found").alias("_found")),
                       F.col("doc_id").cast("long") == F.col("_id"), "left").drop("_id")

    def cut(batches):
        import pyarrow as pa

        for b in (whole.slice(k, SLICE_ROWS) for whole in batches for k in range(0, whole.num_rows, SLICE_ROWS)):
            at = b.schema.names.index
            texts, found = b.column(at("text")).to_pylist(), b.column(at("_found")).to_pylist()
            changed = {}
            for k, (text, some) in enumerate(zip(texts, found)):
                if text and some:
                    words = text.encode("utf-8").split()
                    gone = removed_words(words, _found(some), window, anchor)
                    if gone.any():
                        changed[k] = b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode("utf-8")
            columns = {name: b.column(at(name)) for name in names}
            if changed:
                columns["text"] = pa.array([changed.get(k, t) for k, t in enumerate(texts)], columns["text"].type)
                if "n_chars" in columns:
                    n = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([len(changed[k]) if k in changed else x for k, x in enumerate(n)],
                                                  columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return joined.mapInArrow(cut, docs.schema)
