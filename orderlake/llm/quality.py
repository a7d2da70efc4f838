"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade > j) = sigmoid(x.w - t_j) with one weight vector for all grades and
ordered thresholds t_0 < t_1 < ...: the model gives an expected grade and the
tail probability of a grade above any cut. x holds hashed words, word shapes
(letters dropped, case and signs kept) and repeats of the word before, as
log(1 + count), scaled to length 1.

At most ``sample`` distinct rated texts are fitted on, those of least draws by a
hash of the text, whatever ids or texts repeat; their count vectors (fixed size,
one byte a place) are all that reaches the driver. Every text is scored whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, byte_texts, small_batches, written

_SHAPE = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", b"a" * 26 + b"A" * 26 + b"0" * 10)


def _places(bits: int):
    """word -> place of the word * 2**16 + place of its shape."""
    top = (1 << bits) - 2  # the last place counts repeats

    def of(word: bytes) -> int:
        shape = bytearray()
        for b in word.translate(_SHAPE):
            if not shape or b != shape[-1]:
                shape.append(b)
        return (zlib.crc32(word) % top) << 16 | zlib.crc32(bytes(shape), 1) % top
    return of


def counts(text: bytes, cache: WordCache, bits: int) -> np.ndarray:
    """Counts of words, shapes and repeats by place; all zero without words."""
    words = text.split()
    if not words:
        return np.zeros(1 << bits, dtype=np.int64)
    both = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
    out = np.bincount(np.concatenate((both >> 16, both & 0xFFFF)), minlength=1 << bits)
    out[-1] = np.count_nonzero(both[1:] == both[:-1])
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.log1p(x.astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(axis=-1, keepdims=True)), 1e-6)


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade above each threshold) for rows of unit features."""
        z = x @ self.weights
        return 1 / (1 + np.exp(-(z[:, None] - self.thresholds[None, :])))


def ordered(theta: np.ndarray, d: int) -> np.ndarray:
    """The thresholds: a first one plus exponentials of free gaps."""
    return np.concatenate((theta[d:d + 1], theta[d] + np.cumsum(np.exp(theta[d + 1:]))))


def gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, l2: float) -> np.ndarray:
    """Of the mean negative log likelihood of grade places ``y`` (0 to k - 1)
    plus l2 / 2 times the weights' squares."""
    n, d = x.shape
    z = x @ theta[:d].astype(np.float32)
    t = np.concatenate(([-np.inf], ordered(theta, d), [np.inf]))
    up = 1 / (1 + np.exp(-(z[:, None] - t[None, :])))  # k + 1 columns, 1 to 0
    high, low = up[np.arange(n), y], up[np.arange(n), y + 1]
    p = np.maximum(high - low, 1e-9)
    dz = -(high * (1 - high) - low * (1 - low)) / p / n
    dt = np.zeros(k + 1)
    np.add.at(dt, y, high * (1 - high) / p / n)
    np.add.at(dt, y + 1, -low * (1 - low) / p / n)
    dt = dt[1:-1]
    gap = np.exp(theta[d + 1:]) * np.cumsum(dt[::-1])[::-1][1:]
    return np.concatenate((x.T @ dz.astype(np.float32) + l2 * theta[:d], [dt.sum()], gap))


def fit_thresholds(x: np.ndarray, grade: np.ndarray, grades: list[int], bits: int, steps: int = 300,
                   l2: float = 1e-4, rate: float = 0.2) -> Model:
    """Adam on the negative log likelihood; the thresholds stay ordered."""
    k, d = len(grades), x.shape[1]
    y = np.searchsorted(grades, grade)
    share = np.clip([(y > j).mean() for j in range(k - 1)], 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    theta = np.concatenate((np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        g = gradient(theta, x, y, k, l2)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(grades, theta[:d].astype(np.float32), ordered(theta, d), bits)


def fit(docs: DataFrame, ratings: DataFrame, train: Column, id_col: str, text_col: str, grade_col: str,
        sample: int = 4000, bits: int = 12, **params) -> Model | None:
    """The model, or None without any rated training text. One grade alone
    gives a model that always says that grade."""
    known = ratings.where(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.min(F.col(grade_col).cast("int")).alias("grade"))
    known = written(known, "quality-ratings")
    rows = docs.where(train & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
    texts = written(rows.select("_id", "h").distinct().join(known, "_id").groupBy("h").agg(F.min("grade").alias("grade")),
                    "quality-texts")
    n = texts.count()
    if not n:
        return None
    draw = F.shiftrightunsigned(F.xxhash64("h", F.lit(5)), 11) / float(1 << 53)
    want = written(texts.withColumn("draw", draw).where(F.col("draw") < min(1.0, 1.1 * sample / n))
                   .orderBy("draw", "h").limit(sample), "quality-sample")  # about 1.1 times the sample is sorted
    picked = rows.select("h", "t").join(F.broadcast(want), "h").groupBy("h").agg(
        F.first("grade").alias("grade"), F.first("draw").alias("draw"), F.any_value("t").alias("t")).select("grade", "draw", "t")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(_places(bits))
        for batch in batches:
            raw, off = byte_texts(batch.column(2))
            got = [np.minimum(counts(bytes(raw[a:b]), cache, bits), 255).astype(np.uint8).tobytes()
                   for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(got, pa.binary())],
                                  names=["grade", "draw", "x"])

    got = picked.mapInArrow(vectors, "grade int, draw double, x binary").orderBy("draw", "grade").collect()
    grade = np.array([r["grade"] for r in got])
    grades = sorted(set(grade.tolist()))
    if not grades:
        return None
    if len(grades) == 1:
        return Model(grades, np.zeros(1 << bits, np.float32), np.empty(0), bits)
    x = _unit(np.frombuffer(b"".join(r["x"] for r in got), np.uint8).reshape(len(got), -1))
    return fit_thresholds(x, grade, grades, bits, **params)


def quality(docs: DataFrame, ratings: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
            grade_col: str = "grade", above: int = 0, result: str = "quality", **params) -> DataFrame:
    """``docs`` with a struct column ``result``: expected_grade, and tail, the
    probability of a grade above ``above``.

    Ratings are joined by id and learned from where ``train`` holds; an id
    rated twice takes its least grade, and so does a text of several ids, which
    is learned from once; null ids and grades teach nothing. Null
    and empty texts have no features and score by the thresholds alone. With
    nothing to learn both values are null. All rows and columns of ``docs``
    stay; take a ``result`` name it does not have.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, ratings, train, id_col, text_col, grade_col, **params)
    kind = "struct<expected_grade: double, tail: double>"
    if model is None:
        return docs.withColumn(result, F.lit(None).cast(kind))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        cache = WordCache(_places(m.bits))
        grades = np.array(m.grades, dtype=np.float64)
        for arr in batches:
            raw, off = byte_texts(arr)
            spans = list(zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
            expected, tail = np.empty(len(spans)), np.empty(len(spans))
            for at in range(0, len(spans), 128):
                some = spans[at:at + 128]
                t = m.tails(_unit(np.stack([counts(bytes(raw[a:b]), cache, m.bits) for a, b in some])))
                t = np.concatenate((np.ones((len(some), 1)), t, np.zeros((len(some), 1))), axis=1)
                expected[at:at + 128] = (t[:, :-1] - t[:, 1:]) @ grades
                tail[at:at + 128] = t[:, np.searchsorted(grades, above, side="right")]
            yield pa.StructArray.from_arrays([pa.array(expected), pa.array(tail)], names=["expected_grade", "tail"])

    return docs.withColumn(result, predict(F.col(text_col)))
