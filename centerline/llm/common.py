"""Helpers shared by the operators: Arrow batches, word splitting, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.session import scratch_dir

# Bytes that part words: space and the ASCII controls from tab to carriage return.
# ``bytes.split()`` without arguments splits at exactly these.
SPACES = b" \t\n\x0b\x0c\r"


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def in_blocks(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block's ``column`` holds about ``size`` bytes; a longer value is a block of its own."""
    for batch in batches:
        lengths = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64
        )
        start, total = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if total and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def document_columns(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, under names of its own; other columns cannot clash with them."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def batch_of(columns: dict[str, pa.Array | list | np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Fixed values of the splitmix64 finaliser.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Vocabulary(dict):
    """Numbers of words within a task; ``trim`` empties it once it holds more than ``limit`` words."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


class WordHashes:
    """Two independent 64-bit hashes for each word of a text, cached for a bounded number of words."""

    def __init__(self, limit: int = 1_000_000):
        import xxhash

        self.digest = xxhash.xxh3_128_intdigest
        self.words = Vocabulary(limit)
        self.first = np.empty(1 << 16, dtype=np.uint64)
        self.second = np.empty(1 << 16, dtype=np.uint64)
        self.known = 0

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.words.limit:
            self.words.clear()
            self.known = 0
        ids = self.words.numbers(words)
        if len(self.words) > self.known:
            new = _tail(self.words, self.known)
            while len(self.first) < len(self.words):
                self.first = np.concatenate([self.first, np.empty_like(self.first)])
                self.second = np.concatenate([self.second, np.empty_like(self.second)])
            both = [self.digest(w) for w in new]
            span = slice(self.known, len(self.words))
            self.first[span] = [b & 0xFFFFFFFFFFFFFFFF for b in both]
            self.second[span] = [b >> 64 for b in both]
            self.known = len(self.words)
        return self.first[ids], self.second[ids]


def _tail(words: dict, start: int) -> list[bytes]:
    """The keys from number ``start`` on, newest last."""
    out = []
    for word in reversed(words):
        if words[word] < start:
            break
        out.append(word)
    return out[::-1]


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, for what several tasks can share.

    Functions travel by value, so their module's own variables are new in each task.
    """
    import sys
    import types

    return sys.modules.setdefault("_centerline_worker_store", types.ModuleType("_centerline_worker_store")).__dict__
