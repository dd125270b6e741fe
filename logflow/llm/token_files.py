"""Token-ID output (1): bit-plane shuffled token files.

File format ``BPS1`` (little endian):

- magic ``BPS1``;
- chunks of ``chunk_ids`` ids (the last one may be shorter): the uint32 block
  is transposed into 4 byte planes or 32 bit planes, and each plane is a
  zstandard frame of its own;
- footer, a zstandard frame: counts, the chunk index (offset, ids, length of
  every plane) and the document index (doc_id, number of ids);
- length of the footer (uint32) and the magic again.

Documents lie in ascending doc_id order over the files, which are named by
range partition and roll number; equal doc_ids lie side by side, ordered by
text.  A task writes a file under a private name and renames it, so a task
that runs twice leaves one whole file.  Files roll over after ``file_ids``
ids, so no file grows with a partition.

Null text is an empty text (only the end id); rows without doc_id are left
out; repeated rows are documents of their own; an empty table gives no file
and no row.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logflow.llm._common import id_text, scratch_dir, stored
from logflow.llm._tokens import encoder, tokenizer_path

MAGIC = b"BPS1"
MANIFEST = "part int, roll int, file string, n_docs long, n_ids long"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    wide = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(wide[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        wide = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(wide, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


class FileWriter:
    """Writes one token file; ``add`` takes a document's ids."""

    def __init__(self, out, chunk_ids: int, bits: bool, level: int = 1):
        self.out, self.chunk_ids, self.bits = out, chunk_ids, bits
        self.zip = zstandard.ZstdCompressor(level=level)
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = 0
        self.chunks: list[list[int]] = []
        self.docs: list[tuple[int, int]] = []
        self.at = out.write(MAGIC) or len(MAGIC)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.pending.append(ids)
        self.n_pending += len(ids)
        self.n_ids += len(ids)
        if self.n_pending >= self.chunk_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) // self.chunk_ids * self.chunk_ids
        for a in range(0, whole, self.chunk_ids):
            part = ids[a:min(a + self.chunk_ids, whole)]
            planes = [self.zip.compress(p) for p in to_planes(part, self.bits)]
            self.chunks.append([self.at, len(part), *map(len, planes)])
            for p in planes:
                self.out.write(p)
                self.at += len(p)
        self.pending = [ids[whole:]] if whole < len(ids) else []
        self.n_pending = len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        width = 2 + (32 if self.bits else 4)
        footer = struct.pack("<4q", len(self.chunks), width, len(self.docs), self.n_ids)
        footer += np.asarray(self.chunks, "<i8").tobytes() + np.asarray(self.docs, "<i8").tobytes()
        footer = self.zip.compress(footer)
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)


class FileReader:
    """Random access to one token file through its chunk index."""

    def __init__(self, src, size: int):
        self.src = src
        if size < 12 or self._at(size - 4, 4) != MAGIC or self._at(0, 4) != MAGIC:
            raise ValueError("not a token file")
        n = struct.unpack("<I", self._at(size - 8, 4))[0]
        self.unzip = zstandard.ZstdDecompressor()
        raw = self.unzip.decompress(self._at(size - 8 - n, n))
        n_chunks, width, n_docs, self.n_ids = struct.unpack("<4q", raw[:32])
        cut = 32 + 8 * n_chunks * width
        self.chunks = np.frombuffer(raw[32:cut], "<i8").reshape(n_chunks, width)
        self.docs = np.frombuffer(raw[cut:], "<i8").reshape(n_docs, 2)

    def _at(self, offset: int, n: int) -> bytes:
        self.src.seek(offset)
        return self.src.read(n)

    def chunk(self, k: int) -> np.ndarray:
        at, n, *lengths = self.chunks[k].tolist()
        planes, raw = [], self._at(at, sum(lengths))
        for x in lengths:
            planes.append(self.unzip.decompress(raw[:x]))
            raw = raw[x:]
        return from_planes(planes, n)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, first id in this file, ids), chunk by chunk."""
        held, k, start = np.zeros(0, "<u4"), 0, 0
        for doc_id, n in self.docs.tolist():
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.chunk(k))
                have += len(parts[-1])
                k += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, start, held[:n]
            held = held[n:]
            start += n


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, *, tokenizer: str | None = None, end_id: int = 1,
                      chunk_ids: int = 1 << 16, file_ids: int = 1 << 23, bits: bool = False) -> DataFrame:
    """Encode ``docs`` into token files under ``folder`` (a URI or path that
    driver and executors share) and return their manifest, in file order."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        ctx = TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        store, base = _open(folder)
        end = np.asarray([end_id], "<u4")
        roll, writer, out = 0, None, None

        def finish() -> pd.DataFrame:
            name = f"{part:07d}-{roll:06d}.bps"
            writer.close()
            out.close()
            store.move(f"{base}/_{attempt}-{name}", f"{base}/{name}")
            return pd.DataFrame({"part": [part], "roll": [roll], "file": [name],
                                 "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

        for pdf in batches:
            for k in range(0, len(pdf), 200):
                some = pdf.iloc[k:k + 200]
                for doc_id, ids in zip(some["doc_id"].tolist(), enc.encode(some["text"].tolist())):
                    if writer is None:
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/_{attempt}-{part:07d}-{roll:06d}.bps")
                        writer = FileWriter(out, chunk_ids, bits)
                    writer.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), end]))
                    if writer.n_ids >= file_ids:
                        yield finish()
                        writer, roll = None, roll + 1
        if writer is not None:
            yield finish()

    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInPandas(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens,
    ids_crc32.  The running start runs over one row per file."""
    before = W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        for pdf in batches:
            for name, first in zip(pdf["file"].tolist(), pdf["base"].tolist()):
                with store.open_input_file(f"{base}/{name}") as src:
                    rows: list[tuple] = []
                    for doc_id, start, ids in FileReader(src, src.size()).documents():
                        rows.append((doc_id, first + start, len(ids), zlib.crc32(np.ascontiguousarray(ids).tobytes())))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return based.repartition(files, "file").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write and read back; see the module for the defined cases."""
    folder = folder or scratch_dir(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, **options), folder)
