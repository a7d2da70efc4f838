"""Token counts of whole texts under a unigram vocabulary, without the tokens.

Text is cut before every space; spaces become the word mark, one more stands
in front. In each part an Aho-Corasick automaton enumerates the vocabulary
matches, and dynamic programming carries, for every position, the best score
and its piece count. Ties and unknown characters follow the unigram tokenizers
of the public ``tokenizers`` library: a later candidate must be strictly better,
candidates come by earliest start; a character without a one-character piece is
an unknown edge of the least score minus 10; neighbouring unknowns are one
piece, or one piece per byte where bytes stand in for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, byte_texts, small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """(piece, score) pairs, and whether bytes stand in for unknown characters."""

    pieces: tuple
    byte_fallback: bool = True


def read_sentencepiece(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece file, as a unigram vocabulary."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    return Vocabulary(tuple((sp.id_to_piece(i), sp.get_score(i)) for i in range(n)),
                      any(sp.is_byte(i) for i in range(n)))


class Counter:
    """Piece counts of single parts."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.bytes = vocabulary.byte_fallback
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY

    def count(self, part: str) -> int:
        """Pieces of the best segmentation of one part."""
        n = len(part)
        none = float("-inf")
        best, start = [0.0] + [none] * n, [-1] * (n + 1)
        count, unknown = [0] * (n + 1), [False] * (n + 1)
        at = 0

        def finish(end: int, single: bool) -> None:
            """Adds the unknown edge into ``end`` and counts the best one's pieces."""
            if not single and best[end - 1] + self.unknown > best[end]:
                best[end], start[end], unknown[end] = best[end - 1] + self.unknown, end - 1, True
            s = start[end]
            if not unknown[end]:
                count[end] = count[s] + 1
            elif self.bytes:
                count[end] = count[s] + len(part[s].encode())
            else:
                count[end] = count[s] + (not unknown[s])

        single = False
        for last, (size, score) in self.automaton.iter(part):  # by end, the longest first
            while at < last:
                finish(at + 1, single)
                at, single = at + 1, False
            s = last + 1 - size
            single |= size == 1
            total = best[s] + score
            if total > best[last + 1]:
                best[last + 1], start[last + 1] = total, s
        while at < n:
            finish(at + 1, single)
            at, single = at + 1, False
        return count[n]

    def cached(self) -> WordCache:
        return WordCache(self.count, limit=400_000)


def count_text(text: str, cache: WordCache) -> int:
    """Pieces of a whole text; an empty text has none."""
    if not text:
        return 0
    text = text.replace(MARK, " ")
    first, *rest = text.split(" ")
    # a text that begins with a space gets no second mark in front
    total = sum(map(cache.__getitem__, [MARK + w for w in rest]))
    return total + (cache[MARK + first] if first else 0)


def token_counts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
                 result: str = "n_tokens") -> DataFrame:
    """``docs`` with a long column ``result``: the pieces of each whole text.

    Null and empty texts count 0. All rows and columns stay; take a ``result``
    name the table does not have. The vocabulary (some MB) is broadcast; every
    task keeps a bounded cache of counted parts.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = _cache(shared.value)
        for arr in batches:
            raw, off = byte_texts(arr)
            yield pa.array([count_text(bytes(raw[a:b]).decode(), cache)
                            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.int64())

    return docs.withColumn(result, count(F.col(text_col)))


_kept: dict[int, WordCache] = {}


def _cache(vocabulary: Vocabulary) -> WordCache:
    """The worker's automaton and counted parts, so later tasks find them."""
    key = hash(vocabulary)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Counter(vocabulary).cached()
    return _kept[key]
