"""Small helpers shared by the text operators (run inside Spark tasks)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logflow.session import ensure_checkpoint_dir

ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_M1 = np.uint64(0xD6E8FEB86659FD93)
_M2 = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(32)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, so a lost executor costs a re-read and not the whole chain."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only (null text becomes empty), whatever other
    columns there are.  Rows without a doc_id cannot be named in a result and
    are left out."""
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function over an array."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M1
    return x ^ (x >> _S)


#: Rows that a task turns into Python values at a time.
SLICE_ROWS = 1000


def release_memory() -> None:
    """Give back what Arrow and the allocator keep of freed memory: workers
    are used again by the next operator's tasks."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def map_slices(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``df.mapInPandas(run, schema)`` on slices of ``SLICE_ROWS`` rows, so
    that no task holds a whole Arrow batch of texts as Python strings."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                yield b.slice(at, SLICE_ROWS).to_pandas()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(slices(batches)):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)
        release_memory()

    return df.mapInArrow(mapped, schema)


#: What a Python worker remembers between its tasks, by name.
MEMOS: dict[str, dict] = {}


def use_memo(name: str, memo: dict) -> dict:
    """``memo``, after the memos of other names are emptied: a worker that
    goes from one operator to the next holds the words of one only."""
    if MEMOS.get(name) is not memo:
        MEMOS[name] = memo
    others = [held for other, held in MEMOS.items() if other != name and held]
    for held in others:
        held.clear()
    if others:
        release_memory()
    return memo


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered up to ``limit`` words."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        use_memo("words", self)
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: One memo for each Python worker.
WORD_HASHES = WordHashes()


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; ``len(h) >= k`` is needed."""
    n = len(h) - k + 1
    g = mix(h[:n] * _M2)
    for j in range(1, k):
        g = mix(g * _M2 + h[j:j + n])
    return g


def blob(a: Iterable, dtype: str) -> bytes:
    return np.asarray(a, dtype=dtype).tobytes()
