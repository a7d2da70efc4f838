"""Language ID by a blended-spectrum presence kernel.

k(x, y) counts the distinct character n-grams of length 1 to ``longest`` that
both texts hold (hashed to ``2**bits`` places), divided by the root of both
texts' own counts. Nystroem landmarks are training texts; a text's kernel row
with the landmarks, whitened by their own kernel matrix, feeds one-versus-rest
kernel ridge regression. As the kernel is linear in the presence vector up to
the text's own norm, landmark presences, whitening and ridge weights multiply
out to one (places x languages) matrix, and a batch of texts is scored by one
product of its presence matrix with it.

The model is fitted on at most ``sample`` labelled texts (or one of each
language), an equal number of each language by a hash of the text; their presence bits (fixed size) are all
that reaches the driver. Every text is scored whole.

The winner's output tells languages apart, not whether a text is in any of them:
the outputs add up to 1, so one is always 1 / languages at least. That is told
by the known share: the part of a text's n-grams that at least ``_HELD`` of the
learned texts of the winning language hold (two texts at least). Every fifth
sampled text of a language is kept apart from those; ``_SLACK`` times the 5 %
quantile of their known shares is the language's least share, less two standard
errors for a text of few n-grams. A language with under ten texts has none, and
rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import byte_texts, small_batches, written

UNKNOWN = "und"
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
_PIECE = 1 << 16
_HELD, _SLACK, _APART = 0.02, 0.7, 5


def mark_presence(text: str, bits: int, longest: int, out: np.ndarray) -> None:
    """Sets the places of all n-grams of a text, its letter case folded.
    Works through long texts in overlapping pieces."""
    chars = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    shift = np.uint32(32 - bits)
    for at in range(0, len(chars), _PIECE):
        part = chars[at:at + _PIECE + longest - 1]
        grams = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            tail = part[n - 1:]
            grams = (grams[:len(tail)] ^ tail) * np.uint32(_MULTIPLIERS[n - 1])
            grams ^= grams >> np.uint32(15)
            out[(grams * np.uint32(0x9E3779B1)) >> shift] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places x languages
    offset: np.ndarray
    bits: int
    longest: int
    known: np.ndarray | None = None  # languages x places: n-grams that its texts hold
    least: np.ndarray | None = None  # known share under which a text is in no language

    def is_learned(self, present: np.ndarray, language: int) -> bool:
        """Whether a presence row can be a text of the language."""
        own = max(1, int(np.count_nonzero(present)))
        least = float(self.least[language])
        error = np.sqrt(least * (1 - least) / own)
        return np.count_nonzero(present & self.known[language]) / own >= least - 2 * error

    def scores(self, present: np.ndarray) -> np.ndarray:
        """One-versus-rest ridge outputs of a batch of presence rows."""
        own = np.sqrt(np.maximum(present.sum(axis=1), 1)).astype(np.float32)
        return (present.astype(np.float32) @ self.weights) / own[:, None] + self.offset


def fit_ridge(present: np.ndarray, labels: list[str], bits: int, longest: int, landmarks: int, ridge: float) -> Model:
    """Nystroem features of the landmarks (the first rows of each language in
    turn) and a ridge solution for every language against the rest."""
    languages = sorted(set(labels))
    y = np.array([[1.0 if own == x else 0.0 for x in languages] for own in labels])
    turn = {x: 0 for x in languages}
    order = []
    for i, own in enumerate(labels):
        order.append((turn[own], own, i))
        turn[own] += 1
    chosen = [i for _, _, i in sorted(order)[:landmarks]]
    norm = np.sqrt(np.maximum(present.sum(axis=1), 1)).astype(np.float32)[:, None]
    marks = present[chosen].astype(np.float32) / norm[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    white = vectors[:, keep] / np.sqrt(values[keep])
    # a block of rows at a time: the driver never holds all of them as floats
    phi = np.concatenate([(present[i:i + 128].astype(np.float32) / norm[i:i + 128]) @ marks.T
                          for i in range(0, len(present), 128)]).astype(np.float64) @ white
    mean, centre = phi.mean(axis=0), y.mean(axis=0)
    a = phi - mean
    # a row counts by the rarity of its language, so that all weigh the same
    share = (1 / np.maximum(y.sum(axis=0), 1))[y.argmax(axis=1)]
    share = share / share.mean()
    w = np.linalg.solve((a * share[:, None]).T @ a + ridge * np.eye(a.shape[1]), (a * share[:, None]).T @ (y - centre))
    return Model(languages, marks.T @ (white @ w).astype(np.float32), (centre - mean @ w).astype(np.float32),
                 bits, longest)


def known_places(present: np.ndarray, labels: list[str], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(languages x places that count as known, least known share of each
    language), the shares from texts that are apart from those of the places."""
    known, least = np.zeros((len(languages), present.shape[1]), dtype=bool), np.zeros(len(languages))
    rows: dict[str, list[int]] = {x: [] for x in languages}
    for i, own in enumerate(labels):
        rows[own].append(i)
    for k, x in enumerate(languages):
        apart = rows[x][_APART - 1::_APART]
        kept = np.delete(rows[x], np.s_[_APART - 1::_APART])
        held = sum(present[i].astype(np.int32) for i in kept)
        known[k] = held >= max(2.0, _HELD * len(kept))
        if len(apart) > 1:
            shares = [np.count_nonzero(present[i] & known[k]) / max(1, np.count_nonzero(present[i])) for i in apart]
            least[k] = _SLACK * np.quantile(shares, 0.05)
    return known, least


def fit(docs: DataFrame, text_col: str, lang_col: str, train: Column, sample: int = 1600, landmarks: int = 200,
        bits: int = 15, longest: int = 4, ridge: float = 0.05) -> Model | None:
    """The model, or None where no row has a text, a language and ``train``.

    ``sample`` bounds the texts fitted on: sample / languages of each (one at
    least), those with the least hashes. Copies of a text under one language
    count once. The distinct hashes are thinned by their language's count, so
    that few are ranked."""
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(text_col, F.lit(7)).alias("h"), F.col(text_col).alias("t"))
    keys = written(rows.select("lang", "h").distinct(), "language-texts")
    counts = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()
    if not languages:
        return None
    each = max(1, sample // languages)
    draw = F.shiftrightunsigned("h", 11) / float(1 << 53)
    # 40 more than twice what is needed: no language is left without a text
    thinned = keys.join(F.broadcast(counts), "lang").where(draw < (2 * each + 40) / F.col("n"))
    least = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "h"))
    want = written(thinned.withColumn("rank", least).where(F.col("rank") <= each).select("lang", "h"), "language-sample")
    picked = rows.join(F.broadcast(want), ["lang", "h"]).select("lang", "h", "t")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            raw, off = byte_texts(batch.column(2))
            langs, hashes, packed = [], [], []
            for lang, h, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), off[:-1].tolist(),
                                     off[1:].tolist(), strict=True):
                if (lang, h) in seen:
                    continue
                seen.add((lang, h))
                row = np.zeros(1 << bits, dtype=bool)
                mark_presence(bytes(raw[a:b]).decode(), bits, longest, row)
                langs.append(lang)
                hashes.append(h)
                packed.append(np.packbits(row).tobytes())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()),
                                   pa.array(packed, pa.binary())], names=["lang", "h", "bits"])

    got = picked.mapInArrow(presence, "lang string, h long, bits binary").dropDuplicates(["lang", "h"]).collect()
    kept = sorted(got, key=lambda r: ((r["h"] & ((1 << 64) - 1)) >> 11, r["lang"]))
    del got
    bits_of = np.frombuffer(b"".join(r["bits"] for r in kept), np.uint8).reshape(len(kept), -1)
    present = np.unpackbits(bits_of, axis=1).view(bool)
    labels = [r["lang"] for r in kept]
    model = fit_ridge(present, labels, bits, longest, landmarks, ridge)
    model.known, model.least = known_places(present, labels, model.languages)
    return model


def predict_udf(model, batch_rows: int = 64):
    """(lang, score, learned) of each text; ``model`` is a broadcast Model or None."""
    @F.arrow_udf("struct<lang: string, score: double, learned: boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for arr in batches:
            raw, off = byte_texts(arr)
            spans = list(zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
            langs, scores, learned = [UNKNOWN] * len(spans), np.zeros(len(spans)), np.zeros(len(spans), dtype=bool)
            for at in range(0, len(spans) if m else 0, batch_rows):
                some = spans[at:at + batch_rows]
                present = np.zeros((len(some), 1 << m.bits), dtype=bool)
                lettered = np.zeros(len(some), dtype=bool)
                for i, (a, b) in enumerate(some):
                    text = bytes(raw[a:b]).decode()
                    lettered[i] = any(map(str.isalpha, text))
                    if lettered[i]:
                        mark_presence(text, m.bits, m.longest, present[i])
                out = m.scores(present)
                best = out.argmax(axis=1)
                for i in np.flatnonzero(lettered).tolist():
                    langs[at + i] = m.languages[best[i]]
                    scores[at + i] = min(1.0, max(0.0, float(out[i, best[i]])))
                    learned[at + i] = m.is_learned(present[i], best[i])
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(learned, pa.bool_())], names=["lang", "score", "learned"])
    return predict


def predict_language(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
                     result: str = "language", **params) -> DataFrame:
    """``docs`` with a struct column ``result``: lang (a learned language),
    score (0 to 1, the winner's ridge output) and learned (whether the text's
    n-grams are known in that language; false for gibberish and languages that
    were not learned).

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text where nothing could be learned. Rows are learned from where ``train``
    holds and language and text are not null; a language is never read for a
    prediction. All columns and rows of ``docs`` are kept; take a ``result``
    name it does not have.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, text_col, lang_col, train, **params)
    return docs.withColumn(result, predict_udf(docs.sparkSession.sparkContext.broadcast(model))(F.col(text_col)))
