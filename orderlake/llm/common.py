"""Shared helpers: Arrow text access, word hashing, bounded caches, materialised tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import scratch_dir

#: 0-9, a-z and all of UTF-8 beyond ASCII.
LETTERS_AND_DIGITS = np.zeros(256, dtype=bool)
LETTERS_AND_DIGITS[0x30:0x3A] = LETTERS_AND_DIGITS[0x61:0x7B] = LETTERS_AND_DIGITS[0x80:] = True

_ODD = 0x9E3779B97F4A7C15


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below spark.checkpoint.dir and read back: cuts the
    lineage and fixes the rows, so a retried task later sees the same ones."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of whole texts: fewer rows than Spark's default, which is
    meant for short rows, so a batch of long texts fits a worker. A setting of
    the user's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, rows)


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def byte_texts(arr: pa.Array):
    """(bytes, offsets) of a string array; a null counts as empty."""
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1]
    raw = memoryview(b"") if data is None else memoryview(data)
    return raw, off


class WordCache(dict):
    """word -> value, filled on first use; emptied when full, so memory is bounded."""

    def __init__(self, make: Callable, limit: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    """Powers of an odd number and of its inverse modulo 2**64."""
    global _powers, _inverses
    n = 1 << max(12, int(n).bit_length())
    def powers(x: int) -> np.ndarray:
        out = np.full(n, x, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    _powers, _inverses = powers(_ODD), powers(pow(_ODD, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hashed_words(low: bytes, is_word: np.ndarray = LETTERS_AND_DIGITS):
    """(starts, ends, 64-bit hashes) of the runs of word bytes in ``low``.

    Equal words have equal hashes; unequal ones may collide, so a match is
    only a candidate until its bytes are compared."""
    b = np.frombuffer(low, dtype=np.uint8)
    n = len(b)
    if n >= len(_powers):
        _grow(n + 1)
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = is_word[b]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * _inverses[starts])


def chained(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
    return mix(out)
