"""Line dedup (12): two Bloom filters, once-seen and twice-seen.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased.  A key of at least ``min_chars`` code points that two or more
documents hold stays only in the smallest doc_id that holds it; all its lines
elsewhere go.

1. Every batch of documents gives each of its distinct keys once: a 128-bit
   hash and the documents of the batch that hold it.
2. The hashes are dealt over segments, whose number grows with the lines of
   the table; a segment has about ``SEGMENT_KEYS`` keys.  Each has a pair of
   Bloom filters: a hash found in the once-seen filter enters the twice-seen
   filter.  Hashes that miss the twice-seen filter end here: on the average
   0.3 % of the unique keys pass it.  No filter covers the whole table and
   none is broadcast.
3. Only the suspected repeats shuffle on for exact confirmation: smallest and
   largest doc_id by hash.  What two documents hold is joined back to the
   suspects, and each document gets the hashes that it loses.
4. The texts meet these lists, and their lines are dropped.

A line that a third of all documents hold makes one row a batch, not one a
document, up to the list of lost lines, which the result itself needs.

Null or empty text: one empty line, kept.  Rows without a doc_id cannot be
named and are left out.  Rows that repeat a doc_id are one document to the
counts (their keys count once), and each is returned with its own text.  Ties
cannot occur: the smallest doc_id is unique.  Keys are compared by their
128-bit hashes.  Very long texts are split line by line; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import ASCII_LOWER, id_text, mix, stored

#: What is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
SEGMENT_KEYS = 1 << 18
BITS_PER_KEY = 16
PROBES = 4


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short."""
    line = line.strip(BLANKS)
    if len(line) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass").translate(ASCII_LOWER))


class BloomFilter:
    """Bits for about ``n`` 64-bit hashes; no hash that was added is missed."""

    def __init__(self, n: int):
        self.mask = np.uint64((1 << max(10, int(n * BITS_PER_KEY - 1).bit_length())) - 1)
        self.words = np.zeros((int(self.mask) + 1) >> 5, dtype=np.uint32)

    def _bits(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = mix(h) | np.uint64(1)
        for _ in range(PROBES):
            at = h & self.mask
            yield (at >> np.uint64(5)).astype(np.int64), np.uint32(1) << (at & np.uint64(31)).astype(np.uint32)
            h = h + step

    def add(self, h: np.ndarray) -> None:
        for word, bit in self._bits(h):
            np.bitwise_or.at(self.words, word, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        for word, bit in self._bits(h):
            found &= (self.words[word] & bit) != 0
        return found


def suspected(h: np.ndarray, several: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
    """Which of the hashes may occur twice.  ``several`` marks entries that
    stand for more than one document already."""
    once, twice = BloomFilter(len(h)), BloomFilter(len(h))
    twice.add(h[several])
    for k in range(0, len(h), chunk):
        distinct, count = np.unique(h[k:k + chunk], return_counts=True)
        twice.add(distinct[(count > 1) | once.has(distinct)])
        once.add(distinct)
    return twice.has(h)


def _entries(docs: DataFrame, segments: int, min_chars: int) -> DataFrame:
    """segment, h, ids: the keys of a batch and its documents that hold them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            holders: dict[bytes, set[int] | int] = {}
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                for line in text.split("\n"):
                    key = line_key(line, min_chars)
                    if key is None:
                        continue
                    had = holders.setdefault(key, doc_id)
                    if had is not doc_id and had != doc_id:
                        if isinstance(had, set):
                            had.add(doc_id)
                        else:
                            holders[key] = {had, doc_id}
            h = np.frombuffer(b"".join(holders), dtype=">u8")[::2].astype(np.uint64)
            ids = [np.asarray(sorted(v) if isinstance(v, set) else [v], dtype="<i8").tobytes()
                   for v in holders.values()]
            yield pd.DataFrame({"segment": ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64),
                                "h": list(holders), "ids": ids})

    return docs.mapInPandas(run, "segment long, h binary, ids binary")


def _suspects(pdf: pd.DataFrame) -> pd.DataFrame:
    h = np.frombuffer(b"".join(pdf["h"].tolist()), dtype=">u8").reshape(-1, 2)
    h = h[:, 1].astype(np.uint64)  # the segment comes from the first half
    pdf = pdf[suspected(h, pdf["ids"].str.len().to_numpy() > 8)]
    ids = [np.frombuffer(b, dtype="<i8") for b in pdf["ids"]]
    return pd.DataFrame({"h": pdf["h"].to_numpy(), "first": np.asarray([a[0] for a in ids], dtype=np.int64),
                         "last": np.asarray([a[-1] for a in ids], dtype=np.int64),
                         "ids": pd.Series(ids, dtype=object)})


def lost_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, lost: the hashes of the keys that each document loses."""
    # an upper bound of the number of entries
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    lines = docs.agg(F.sum(breaks)).first()[0] or 0
    segments = -(-lines // SEGMENT_KEYS) or 1
    found = stored(_entries(docs, segments, min_chars).groupBy("segment").applyInPandas(
        _suspects, "h binary, first long, last long, ids array<long>"), "suspects")
    repeats = found.groupBy("h").agg(F.min("first").alias("keeper"), F.max("last").alias("other")).where("keeper < other")
    return (found.join(repeats.select("h", "keeper"), "h").select("h", "keeper", F.explode("ids").alias("doc_id"))
            .where("doc_id <> keeper").groupBy("doc_id").agg(F.collect_set("h").alias("lost")))


def dedup_lines(docs: DataFrame, *, min_chars: int = 10) -> DataFrame:
    """doc_id, text (the lines that stay, joined by line breaks), n_lines,
    n_dropped."""
    docs = id_text(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, lines, dropped = [], [], []
            for text, lost in zip(pdf["text"].tolist(), pdf["lost"].tolist()):
                parts = text.split("\n")
                lines.append(len(parts))
                if lost is not None:
                    gone = set(lost)
                    parts = [p for p in parts if line_key(p, min_chars) not in gone]
                    text = "\n".join(parts)
                texts.append(text)
                dropped.append(lines[-1] - len(parts))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": texts, "n_lines": lines, "n_dropped": dropped})

    return docs.join(lost_lines(docs, min_chars), "doc_id", "left").mapInPandas(
        run, "doc_id long, text string, n_lines long, n_dropped long")


ORACLE = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as nth
  from documents where doc_id is not null),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
firsts as (
  select key, min(doc_id) as keeper from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
marked as (
  select k.*, f.keeper is not null and f.keeper <> k.doc_id as gone
  from keyed k left join firsts f on k.key = f.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by nth) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
