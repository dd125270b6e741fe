"""Benchmark decontamination (7): SimHash of item-sized windows.

Items and documents are compared as lower-cased words (punctuation removed).
A window has as many words as an item.  Windows that share no five-word
shingle with any item cannot reach the similarity below and are excluded by a
table lookup; every other window of the sizes of the items concerned gets a
64-bit SimHash of its words.  Fingerprints are cut into four blocks of 16
bits: two fingerprints within ``radius`` agree on one block up to
``radius // 4`` bits, so all item blocks within that many bits are indexed,
which guarantees that no fingerprint within the radius is missed.  Candidates
come from this index alone.  Of passages of 8 to 59 words with up to three
edits and a similarity of 0.8 or more, 99.7% (14 words) to 100% lie within 11
bits, and all of 15,000 within the 15 that are used.

Candidates are verified by the exact Jaccard similarity of their five-word
shingles, plain (a shingle weighs its count) or weighted (a shingle of the item
weighs 1 over the number of items that hold it, any other the mean of the
item's, times its count): the larger must reach ``threshold``, so neither
wording that items share nor wording of one item alone hides a copy.

Holders are counted by Spark over all items.  The items are dealt by hash into
blocks of about ``max_bytes`` of text (an item of 250 bytes takes some 11 kB in
an index); one block at a time is read and searched for, so neither the driver
nor a task holds more, and the result does not depend on the blocks.

Items with fewer words than a shingle are one shingle, the whole sequence;
items without words match nothing.  The best match has the largest similarity;
ties go to the smallest item_id, then to the first place.  Null text is empty;
rows without doc_id or item_id are left out; repeated rows give a row each;
empty tables give no row or no match; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import ASCII_LOWER, WORD_HASHES, id_text, mix, shingle_hashes, stored

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLOCK_BITS = 16


def clean_words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").translate(ASCII_LOWER))


def bit_votes(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of every word hash."""
    bits = np.unpackbits(mix(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def shingles_of(h: np.ndarray, k: int) -> np.ndarray:
    return shingle_hashes(h, min(k, len(h))) if len(h) else np.zeros(0, np.uint64)


def held_by(items: list[tuple[int, str]], k: int) -> dict[int, int]:
    """Number of items that hold each shingle."""
    return Counter(x for _, t in items for x in set(shingles_of(WORD_HASHES.of(clean_words(t)), k).tolist()))


class ItemIndex:
    """Index of a block of items; ``held`` counts the holders of their
    shingles over all items (default: over these)."""

    def __init__(self, items: list[tuple[int, str]], k: int = 5, radius: int = 15, threshold: float = 0.8,
                 held: dict[int, int] | None = None):
        self.k, self.radius, self.threshold = k, radius, threshold
        held = held_by(items, k) if held is None else held
        hashed = [(i, WORD_HASHES.of(clean_words(t))) for i, t in sorted(items)]
        hashed = [(i, h) for i, h in hashed if len(h)]
        self.ids = [i for i, _ in hashed]
        self.sizes = np.asarray([len(h) for _, h in hashed], dtype=np.int64)
        self.shingles = [Counter(shingles_of(h, k).tolist()) for _, h in hashed]
        self.weight = {s: 1.0 / held[s] for c in self.shingles for s in c}
        self.worth = [sum(self.weight[s] * x for s, x in c.items()) for c in self.shingles]
        self.prints = np.concatenate([fingerprints(bit_votes(h).sum(axis=0, keepdims=True)) for _, h in hashed]) \
            if hashed else np.zeros(0, np.uint64)
        #: sizes of the items that hold a shingle, by shingle length
        self.known = {}
        for n in {min(k, int(m)) for m in self.sizes}:
            own: dict[int, set[int]] = {}
            for m, c in zip(self.sizes.tolist(), self.shingles):
                if min(k, m) == n:
                    for s in c:
                        own.setdefault(s, set()).add(m)
            self.known[n] = (np.asarray(sorted(own), dtype=np.uint64), own)
        flips = [sum(1 << b for b in bits) for r in range(radius // (64 // BLOCK_BITS) + 1)
                 for bits in combinations(range(BLOCK_BITS), r)]
        #: for each block of bits: where the items of a value begin, and the
        #: items by value, under each value that is near enough to theirs
        self.blocks = []
        for b in range(64 // BLOCK_BITS):
            value = (self.prints >> np.uint64(BLOCK_BITS * b) & np.uint64(0xFFFF)).astype(np.uint16)
            keys = (value[:, None] ^ np.asarray(flips, dtype=np.uint16)).ravel()
            order = np.argsort(keys, kind="stable")
            begin = np.searchsorted(keys[order], np.arange(1 << BLOCK_BITS, dtype=np.uint32))
            self.blocks.append((np.append(begin, len(keys)), (order // len(flips)).astype(np.int32)))

    def near(self, fingerprint: int) -> set[int]:
        """All items within the radius."""
        found: set[int] = set()
        for b, (begin, items) in enumerate(self.blocks):
            value = fingerprint >> (BLOCK_BITS * b) & 0xFFFF
            found.update(items[begin[value]:begin[value + 1]].tolist())
        return {i for i in found if (int(self.prints[i]) ^ fingerprint).bit_count() <= self.radius}

    def similarity(self, window: Counter, item: int) -> float:
        mine, worth, weight = self.shingles[item], self.worth[item], self.weight
        shared = [(s, min(n, mine[s])) for s, n in window.items() if s in mine]
        both = sum(n for _, n in shared)
        one = window.total() + mine.total()
        plain = both / (one - both)
        other = worth / mine.total()
        both = sum(weight[s] * n for s, n in shared)
        one = worth + sum(n * (weight[s] if s in mine else other) for s, n in window.items())
        return max(plain, both / (one - both))

    def search(self, h: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of every verified window; for
        each item the best window of each group of overlapping ones."""
        best: dict[int, list[tuple[float, int, int]]] = {}
        wanted: dict[int, set[int]] = {}
        for k, (keys, sizes) in self.known.items():
            if len(h) < k:
                continue
            s = shingle_hashes(h, k)
            at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
            places = np.flatnonzero(keys[at] == s)
            for p in places.tolist():
                for m in sizes[int(s[p])]:
                    wanted.setdefault(m, set()).update(range(max(0, p + k - m), min(p, len(h) - m) + 1))
                    if len(h) < m:  # a shorter document is one window
                        wanted[m].add(0)
        if not wanted:
            return []
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bit_votes(h), axis=0, dtype=np.int32)])
        for m, starts in wanted.items():
            a = np.asarray(sorted(starts))
            prints = fingerprints(sums[np.minimum(a + m, len(h))] - sums[a])
            for start, p in zip(a.tolist(), prints.tolist()):
                items = [i for i in self.near(p) if self.sizes[i] == m]
                if items:
                    window = Counter(shingles_of(h[start:start + m], min(self.k, m)).tolist())
                    for i in items:
                        got = self.similarity(window, i)
                        if got >= self.threshold:
                            best.setdefault(i, []).append((got, start, min(m, len(h) - start)))
        out = []
        for i, found in best.items():
            end = -1
            for got, start, n in sorted(found, key=lambda x: (x[1], -x[0])):
                if start >= end:
                    out.append((self.ids[i], start, n, got))
                    end = start + n
                elif got > out[-1][3]:
                    out[-1] = (self.ids[i], start, n, got)
        return sorted(out, key=lambda x: (x[1], x[0]))


def item_table(benchmark: DataFrame, shingle: int, max_bytes: int) -> tuple[DataFrame, int]:
    """The items (block, item_id, text, held: holders of each of their
    shingles among all items), written, and the number of blocks."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [sorted(set(shingles_of(WORD_HASHES.of(clean_words(t)), shingle).tolist())) for t in pdf["text"]]
            yield pdf.assign(shingle=[np.asarray(x, dtype=np.uint64).view(np.int64) for x in found]).explode(
                "shingle").dropna().astype({"shingle": "int64"})

    shingles = stored(items.mapInPandas(cut, "item_id long, text string, shingle long"), "item-shingles")
    held = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // max_bytes)
    return stored(shingles.join(held, "shingle").groupBy("item_id", "text")
                  .agg(F.collect_list(F.struct("shingle", "holders")).alias("held"))
                  .withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))), "items"), n


def read_block(items: DataFrame, block: int) -> tuple[list[tuple[int, str]], dict[int, int]]:
    """One block's items, of about ``max_bytes`` of text, and their holders."""
    rows, held = [], {}
    for r in items.where(F.col("block") == block).toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        held.update((s % (1 << 64), n) for s, n in r["held"])
    return rows, held


FOUND = "array<struct<item_id: long, first: long, n: long, similarity: double>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, shingle: int = 5, radius: int = 15,
                       threshold: float = 0.8, max_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, contaminated, n_matches, item_id (of the best match, else
    null), similarity (0 without a match), matches."""
    rows = id_text(docs)
    items, blocks = item_table(benchmark, shingle, max_bytes)

    def search(block: int) -> DataFrame:
        some, held = read_block(items, block)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = ItemIndex(some, shingle, radius, threshold, held)
            for pdf in batches:
                found = [[{"item_id": i, "first": a, "n": n, "similarity": x} for i, a, n, x in
                          index.search(WORD_HASHES.of(clean_words(t)))] for t in pdf["text"].tolist()]
                yield pdf.drop(columns="text").assign(matches=found)

        # rows of one text have the same matches, so its hashes name them
        return rows.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("h2"),
                           "text").mapInPandas(run, f"doc_id long, h1 long, h2 long, matches {FOUND}")

    if blocks <= 1:
        found = search(0).select("doc_id", "matches")
    else:
        key = ["doc_id", "h1", "h2"]
        parts = [stored(search(k).where(F.size("matches") > 0).distinct(), "matches") for k in range(blocks)]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        every = every.groupBy(key).agg(F.flatten(F.collect_list("matches")).alias("matches"))
        found = rows.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("h2")).join(
            every, key, "left").select("doc_id", F.coalesce("matches", F.array().cast(FOUND)).alias("matches"))
    # by place, then by item
    ordered = F.transform(F.array_sort(F.transform("matches", lambda m: F.struct(
        m["first"].alias("first"), m["item_id"].alias("item_id"), m["n"].alias("n"), m["similarity"].alias("similarity")))),
        lambda m: F.struct(m["item_id"].alias("item_id"), m["first"].alias("first"), m["n"].alias("n"),
                           m["similarity"].alias("similarity")))
    top = F.array_max(F.transform("matches", lambda m: F.struct(
        m["similarity"].alias("similarity"), (-m["item_id"]).alias("item"))))
    return found.withColumn("matches", ordered).withColumn("top", top).select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_matches"),
        (-F.col("top.item")).alias("item_id"), F.coalesce("top.similarity", F.lit(0.0)).alias("similarity"), "matches")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, shingle: int = 5, radius: int = 15,
                      threshold: float = 0.8, max_bytes: int = 2 << 20) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept; what one
    block of items leaves is written before the next is searched for."""
    items, blocks = item_table(benchmark, shingle, max_bytes)

    def keep(docs: DataFrame, block: int) -> DataFrame:
        some, held = read_block(items, block)

        def run(batches):
            import pyarrow as pa

            index = ItemIndex(some, shingle, radius, threshold, held)
            for b in batches:
                texts = b.column(b.schema.names.index("text")).to_pylist()
                hashed = (WORD_HASHES.of(clean_words(t or "")) for t in texts)
                yield b.filter(pa.array([not index.search(h) for h in hashed], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    for k in range(blocks):
        docs = keep(docs, k)
        if k + 1 < blocks:
            docs = stored(docs, "kept")
    return docs
