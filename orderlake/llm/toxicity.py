"""Toxicity by gradient-boosted trees over dense features, isotonically calibrated.

Features of a whole text: lexicon density and count, the two strongest hits,
stem hits, lexicon hits near a second-person pronoun, capitals, punctuation
and obfuscation rates. The lexicon is learned from the labelled training rows:
words, and word beginnings of four to eight letters, that toxic texts hold far
more often than others, each with its log odds as weight. Trees (Spark ML) are fitted on most of the training
sample, the isotonic map from tree probability to score on the rest.

At most ``sample`` distinct labelled texts are fitted on, half of them toxic
where there are enough, those with the least draws by a hash of the text; a
text is toxic if any row of it is. Near copies of one label count once in the
lexicon: texts with equal least hashes in ``_KEY`` shingle orders whose
estimated similarity to the group's first member is ``_ALIKE`` or more. Trees
and the calibration see every text of the sample once, so scores are shares of
distinct texts. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, byte_texts, chained, hashed_words, mix, small_batches, written

#: Second-person pronouns of the languages served.
SECOND_PERSON = frozenset((
    "you your yours yourself u ur du dich dir dein deine ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros os").split())

#: Signs that stand for a letter.
LOOK_ALIKES = str.maketrans("0134578@$!", "oieastbasi")

STEMS = (4, 5, 6, 7, 8)
#: Shingle orders of a signature, those of them in a group's key, and the share of equal ones in near copies.
_ORDERS, _KEY, _ALIKE = 64, 3, 0.7
_SEEDS = mix(np.arange(1, _ORDERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
NEAR = 3
FEATURES = ("lexicon_density", "lexicon_weight", "strongest", "second_strongest", "word_hits", "stem_hits", "second_person_near",
            "second_person_rate", "capital_rate", "punctuation_rate", "exclamation_rate", "obfuscated_rate",
            "decoded_lexicon_rate", "long_run_rate", "log_words")

_LEXICON, _STEM, _SECOND, _CAPITALS, _OBFUSCATED, _DECODED, _RUN = (1 << i for i in range(7))
_LETTERS = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][\d@$!*#.\-_]+[^\W\d_]|[\d@$][^\W\d_]")
_LONG_RUN = re.compile(r"([^\W\d_])\1\1")


@dataclass(frozen=True)
class Lexicon:
    """Weights (log odds) of words, and of word beginnings under ``stem*``."""

    weights: dict = field(default_factory=dict)

    def weigh(self, word: str) -> tuple[float, int]:
        """The weight of a word's strongest term, and whether it is a stem."""
        stem = max((self.weights.get(f"{word[:n]}*", 0.0) for n in STEMS if len(word) >= n), default=0.0)
        whole = self.weights.get(word, 0.0)
        return (whole, _LEXICON) if whole >= stem else (stem, _STEM)

    def code(self, raw: bytes) -> int:
        """The classes of one white-space separated word as bits, above them
        its weight in hundredths."""
        word = raw.decode()
        low, out, best = word.lower(), 0, 0.0
        parts = _LETTERS.findall(low)
        for p in parts:
            weight, kind = self.weigh(p)
            if weight > 0:
                out |= kind
                best = max(best, weight)
            if p in SECOND_PERSON:
                out |= _SECOND
        if len(word) > 1 and word.isupper():
            out |= _CAPITALS
        if _MIXED.search(low):
            out |= _OBFUSCATED
            plain = "".join(_LETTERS.findall(low.translate(LOOK_ALIKES)))
            weight = 0.0 if plain in parts else self.weigh(plain)[0]
            if weight > best:
                out |= _DECODED
                best = weight
        if _LONG_RUN.search(low):
            out |= _RUN
        return int(round(best * 100)) << 8 | out


_PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def features(text: bytes, cache: WordCache) -> list[float]:
    """The dense features of one UTF-8 text; all zero without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.fromiter(map(cache.__getitem__, words), np.int64, n)
    weight = (codes >> 8) / 100.0
    hit = weight > 0
    second = (codes & _SECOND) > 0
    near = 0
    if hit.any() and second.any():
        reach = np.cumsum(np.concatenate(([0], second)))
        at = np.flatnonzero(hit)
        near = int((reach[np.minimum(at + NEAR + 1, n)] > reach[np.maximum(at - NEAR, 0)]).sum())
    size = len(text)
    total, top = float(weight.sum()), np.sort(np.unique(codes[hit]) >> 8)[::-1][:2] / 100.0  # of distinct kinds
    top = [*top.tolist(), 0.0, 0.0]
    if hit.any() and top[1] == 0.0 and np.count_nonzero(hit) > 1:
        top[1] = top[0]  # the same word again
    count = [int(np.count_nonzero(codes & c)) for c in (_LEXICON, _STEM, _CAPITALS, _OBFUSCATED, _DECODED, _RUN)]
    marks = size - len(text.translate(None, _PUNCTUATION))
    return [total / n, np.log1p(total), top[0], top[1], np.log1p(count[0]), np.log1p(count[1]), near / n, float(second.mean()),
            count[2] / n, marks / size, text.count(b"!") / size, count[3] / n, count[4] / n, count[5] / n, np.log1p(n)]


def _features_udf(lexicon):
    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordCache(lexicon.value.code)
        for arr in batches:
            raw, off = byte_texts(arr)
            yield pa.array([features(bytes(raw[a:b]), cache)
                            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.list_(pa.float64()))
    return of


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and stems of each text, and the least hashes of its
    shingles in ``_ORDERS`` orders."""
    for batch in batches:
        raw, off = byte_texts(batch.column(1))
        terms, signatures = [], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            text = bytes(raw[a:b])
            words = set(_LETTERS.findall(text.decode().lower()))
            stems = {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}
            terms.append(sorted(words | stems))
            hashes = hashed_words(text.lower())[2]
            shingles = np.unique(chained(hashes, min(4, len(hashes)))) if len(hashes) else hashes
            signatures.append([int(mix(shingles * x).min().view(np.int64)) if len(shingles) else 0 for x in _SEEDS])
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(terms, pa.list_(pa.string())),
                               pa.array(signatures, pa.list_(pa.int64()))], names=["label", "h", "terms", "signature"])


def without_near_copies(train: DataFrame) -> DataFrame:
    """(label, terms) of one text of each group of near copies of a label: the
    one with the least hash. Texts that share the key alone stay."""
    key = F.slice("signature", 1, _KEY).alias("key")
    rows = written(train.select("label", "text", F.xxhash64("text").alias("h")).mapInArrow(
        _terms, "label int, h long, terms array<string>, signature array<long>").dropDuplicates(["label", "h"]),
        "toxicity-terms")
    first = rows.groupBy("label", key).agg(F.min(F.struct("h", "signature")).alias("first"))
    same = F.aggregate(F.zip_with("signature", "first.signature", lambda a, b: (a == b).cast("int")), F.lit(0),
                       lambda n, x: n + x)
    return rows.withColumn("key", key).join(F.broadcast(first), ["label", "key"]).where(
        (F.col("h") == F.col("first.h")) | (same < _ALIKE * _ORDERS)).select("label", "terms")


def learn_lexicon(train: DataFrame, most: int = 2000, share: float = 0.01, odds: float = 6.0,
                  evidence: float = 16.0) -> Lexicon:
    """Terms in at least ``share`` of the toxic groups (and four of them),
    ``odds`` times as frequent there as in the others, and with a likelihood
    ratio (G) of ``evidence`` against chance, as very many terms are tried; at
    most ``most``."""
    rows = written(without_near_copies(train), "toxicity-texts")
    n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = n["t"], n["n"] - n["t"]
    if not toxic or not clean:
        return Lexicon()
    part = toxic / max(toxic + clean, 1)
    t, c, n = F.col("t"), F.col("c"), F.col("t") + F.col("c")
    g = 2 * (t * F.log(t / (n * part)) + F.when(c > 0, c * F.log(c / (n * (1 - part)))).otherwise(0.0))
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    found = (rows.select("label", F.explode("terms").alias("term")).groupBy("term")
             .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
             .where((t >= max(4.0, share * toxic)) & (t / max(toxic, 1) >= odds * (c + 0.5) / max(clean, 1))
                    & (g >= evidence))
             .withColumn("w", weight).orderBy(F.desc("t"), "term").limit(most).collect())
    return Lexicon({r["term"]: r["w"] for r in found})


@dataclass
class Model:
    lexicon: Lexicon
    trees: object
    calibration: object
    base: float


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str,
        sample: int = 8000, trees: int = 20, depth: int = 4) -> Model:
    """The model; without toxic or without other training rows it has no
    trees and scores every text with the share of toxic rows (0 if none)."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label")))
    known = written(known, "toxicity-labels")
    rows = docs.where(train & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    texts = written(rows.select("_id", "h").join(known, "_id").groupBy("h").agg(F.max("label").alias("label")), "toxicity-ids")
    count = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(count.values())
    base = count.get(1, 0) / total if total else 0.0
    if len(count) < 2:
        return Model(Lexicon(), None, None, base)
    half = min(count[1], sample // 2)
    most = {1: half, 0: min(count[0], sample - half)}
    rate = {label: n / count[label] for label, n in most.items()}
    draw = F.xxhash64("h", F.lit(6))
    want = texts.where("label = 1").orderBy(draw, "h").limit(most[1]).unionByName(
        texts.where("label = 0").orderBy(draw, "h").limit(most[0]))
    # at most ``sample`` texts, each once: copies end in the map-side part
    picked = written(rows.join(F.broadcast(want), "h").groupBy("h").agg(
        F.first("label").alias("label"), F.first("text").alias("text")), "toxicity-sample")
    lexicon = learn_lexicon(picked)
    of = _features_udf(docs.sparkSession.sparkContext.broadcast(lexicon))
    rows = written(picked.select(F.col("label").cast("double").alias("label"), of("text").alias("f"),
                                 (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("calibrate")).coalesce(4),
                   "toxicity-features").select("label", array_to_vector("f").alias("features"), "calibrate")
    part = rows.where("NOT calibrate")
    if part.select("label").distinct().count() < 2:
        part = rows
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=6, minInstancesPerNode=5).fit(part)
    # the sample holds a larger share of toxic rows: weights undo that
    weight = F.when(F.col("label") == 1, 1 / rate[1]).otherwise(1 / rate[0])
    judged = model.transform(rows.where("calibrate")).select(
        "label", vector_to_array("probability")[1].alias("p"), weight.alias("w"))
    judged = written(judged, "toxicity-judged")
    if judged.isEmpty():
        return Model(lexicon, model, None, base)
    return Model(lexicon, model, IsotonicRegression(featuresCol="p", weightCol="w").fit(judged), base)


def score(docs: DataFrame, model: Model, text_col: str = "text", result: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``result`` (0 to 1)."""
    if model.trees is None:
        return docs.withColumn(result, F.lit(model.base))
    of = _features_udf(docs.sparkSession.sparkContext.broadcast(model.lexicon))
    names = {c: f"{result}_{c}" for c in ("features", "raw", "probability", "p", "label")}
    trees = model.trees.copy().setFeaturesCol(names["features"]).setRawPredictionCol(names["raw"]).setProbabilityCol(
        names["probability"]).setPredictionCol(names["label"])
    out = trees.transform(docs.withColumn(names["features"], array_to_vector(of(F.col(text_col)))))
    out = out.withColumn(names["p"], vector_to_array(names["probability"])[1])
    if model.calibration is None:
        out = out.withColumn(result, F.col(names["p"]))
    else:
        out = model.calibration.copy().setFeaturesCol(names["p"]).setPredictionCol(result).transform(out)
    return out.drop(*names.values()).withColumn(result, F.least(F.greatest(F.col(result), F.lit(0.0)), F.lit(1.0)))


def toxicity(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", result: str = "toxicity", **params) -> DataFrame:
    """``docs`` with a double column ``result``: the calibrated probability of
    label 1, 0 to 1.

    Labels are joined by id and learned from where ``train`` holds; an id that
    repeats in ``labels`` is toxic if any of its rows is, and so is a text. Null ids and labels
    teach nothing. A null, empty or wordless text has all features zero and is
    scored like any other. All rows and columns of ``docs`` stay; take a
    ``result`` name it does not have.
    """
    small_batches(docs.sparkSession)
    return score(docs, fit(docs, labels, train, id_col, text_col, label_col, **params), text_col, result)
