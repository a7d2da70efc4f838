"""Benchmark decontamination: prefix-filtered containment join over item windows.

Every benchmark item gives windows of ``window`` consecutive words (a shorter
item is one window). A window is a set of word shingles; a text that contains
the window contains them all, so at containment 1 the necessary prefix is the
window's one rarest shingle. Shingles are ordered by how often they occur in
the documents (counted over all of them), so common passages never drive the
join. A document shingle that equals a prefix shingle proposes the window at
one start; length and position bounds drop starts that stick out of the
document, and the words are then compared.

The distinct texts of the benchmark are taken in blocks of bounded size, each
broadcast as one index; every block is one pass over the documents that adds to
the row's spans and found texts. No document is shuffled, so skew in the
documents does not matter. Item ids are not broadcast: they are joined to the
sets of found texts, which only contaminated rows have.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import byte_texts, chained, fresh, hashed_words, small_batches, written

SHINGLE = 3
SALTS = 16
_FILTER_BITS = 18


def _shingle_sizes(lengths) -> list[int]:
    return sorted({min(SHINGLE, n) for n in lengths})


class _Lookup:
    """Sorted 64-bit keys behind a small bit table."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.table[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray):
        """(positions in ``hashes``, key numbers) of those that are keys."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _FILTER_BITS)])
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[k] == hashes[at]
        return at[same], k[same]


class Windows:
    """The distinct windows of a block of (key, text) pairs of the benchmark."""

    def __init__(self, texts: list[tuple[str, str]], window: int):
        owners: dict[bytes, set] = defaultdict(set)
        for key, text in texts:
            low = text.encode().lower()
            starts, ends, _ = hashed_words(low)
            words = [low[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners[b" ".join(words[i:i + window])].add(key)
        self.texts = sorted(owners)
        self.keys = [sorted(owners[t]) for t in self.texts]
        hashed = [hashed_words(t)[2] for t in self.texts]
        self.sizes = np.array([len(h) for h in hashed], dtype=np.int64)
        self.shingles = [chained(h, min(SHINGLE, len(h))) for h in hashed]
        self.whole = np.array([chained(h, len(h))[0] for h in hashed], dtype=np.uint64)
        self.by_size = {k: _Lookup(np.concatenate([s for s, n in zip(self.shingles, self.sizes, strict=True)
                                                   if min(SHINGLE, n) == k])) for k in _shingle_sizes(self.sizes)}

    def choose_prefixes(self, counts: dict[tuple[int, int], int]) -> None:
        """Keeps each window's rarest shingle (ties: smaller hash, then first
        place) as its prefix; ``counts`` are occurrences in the documents."""
        found: dict[int, dict[int, list]] = {k: defaultdict(list) for k in self.by_size}
        for w, (hashes, size) in enumerate(zip(self.shingles, self.sizes.tolist(), strict=True)):
            k = min(SHINGLE, size)
            _, key, place = min((counts.get((k, h), 0), h, i) for i, h in enumerate(hashes.tolist()))
            found[k][key].append((w, place))
        self.prefix = {}
        for k, by_key in found.items():
            keys = np.array(sorted(by_key), dtype=np.uint64)
            lists = [by_key[x] for x in keys.tolist()]
            first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
            flat = np.array([x for one in lists for x in one], dtype=np.int64).reshape(-1, 2)
            self.prefix[k] = (_Lookup(keys), first, flat[:, 0], flat[:, 1])
        self.shingles = self.by_size = None

    def hits(self, low: bytes):
        """(spans [(first word, end word)], keys of the texts found, words) of one document."""
        starts, ends, words = hashed_words(low)
        n = len(words)
        spans, keys = set(), set()
        for k, (lookup, first, window, place) in self.prefix.items():
            at, key = lookup.find(chained(words, k))
            if not len(at):
                continue
            many = first[key + 1] - first[key]
            row = np.repeat(np.arange(len(at)), many)
            entry = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[key][row]
            w = window[entry]
            start, size = at[row] - place[entry], self.sizes[w]
            inside = (start >= 0) & (start + size <= n)  # length and position bounds
            w, start, size = w[inside], start[inside], size[inside]
            for length in np.unique(size).tolist():
                of = size == length
                same = chained(words, length)[start[of]] == self.whole[w[of]]
                for one, s in zip(w[of][same].tolist(), start[of][same].tolist(), strict=True):
                    if b" ".join(low[a:b] for a, b in zip(starts[s:s + length].tolist(),
                                                         ends[s:s + length].tolist(), strict=True)) == self.texts[one]:
                        spans.add((s, s + length))
                        keys.update(self.keys[one])
        return spans, keys, n


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SPANS = pa.list_(pa.list_(pa.int64()))


def _counts(docs: DataFrame, text_col: str, windows) -> dict[tuple[int, int], int]:
    """Occurrences in all documents of the block's shingles, summed in Spark;
    at most one row per shingle of the block comes back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = windows.value
        sums = {k: np.zeros(len(x.keys), dtype=np.int64) for k, x in w.by_size.items()}
        for batch in batches:
            raw, off = byte_texts(batch.column(0))
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                words = hashed_words(bytes(raw[a:b]).lower())[2]
                for k, lookup in w.by_size.items():
                    np.add.at(sums[k], lookup.find(chained(words, k))[1], 1)
        for k, s in sums.items():
            some = np.flatnonzero(s)
            yield pa.record_batch({"k": pa.array([k] * len(some), pa.int32()),
                                   "h": pa.array(w.by_size[k].keys[some].view(np.int64), pa.int64()),
                                   "n": pa.array(s[some], pa.int64())})

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "k int, h long, n long")
            .groupBy("k", "h").agg(F.sum("n").alias("n")).collect())
    return {(r["k"], r["h"] & ((1 << 64) - 1)): r["n"] for r in rows}


def _probe(windows):
    kind = "struct<n_words: long, spans: array<array<bigint>>, texts: array<string>>"

    @F.arrow_udf(kind)
    def probe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = windows.value
        for arr in batches:
            raw, off = byte_texts(arr)
            got = [w.hits(bytes(raw[a:b]).lower()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.StructArray.from_arrays(
                [pa.array([n for _, _, n in got], pa.int64()),
                 pa.array([[list(s) for s in _merged(spans)] for spans, _, _ in got], SPANS),
                 pa.array([sorted(keys) for _, keys, _ in got], pa.list_(pa.string()))],
                names=["n_words", "spans", "texts"])
    return probe


def _merge_spans():
    @F.arrow_udf("array<array<bigint>>")
    def merge(arr: pa.Array) -> pa.Array:
        return pa.array([[list(s) for s in _merged(map(tuple, x))] for x in arr.to_pylist()], SPANS)
    return merge


def found_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text: str = "text",
                window: int = 13, block_chars: int = 4_000_000, result: str = "hits") -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, n_hit, spans (merged
    [first, end) word ranges inside an occurrence of a window) and texts (the
    SHA-256 of every benchmark text with an occurring window, sorted).

    Null and empty texts have no words. A text that many items repeat counts
    once; items without words have no window. An empty benchmark gives empty
    spans. All columns of ``docs`` are kept; take a ``result`` name it does not
    have (``common.fresh``).
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = written(benchmark.select(F.col(item_text).alias("text")).where("text IS NOT NULL").distinct(),
                    "benchmark-texts")
    size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_chars))
    out, parts = docs, []
    for b in range(blocks):  # one pass over the documents for each bounded block
        mine = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b)
        windows = Windows([tuple(r) for r in mine.select(F.sha2("text", 256), "text").collect()], window)
        windows.choose_prefixes(_counts(docs, text_col, spark.sparkContext.broadcast(windows)))
        part = fresh(out, f"_part{b}")
        out = out.withColumn(part, _probe(spark.sparkContext.broadcast(windows))(F.col(text_col)))
        parts.append(part)
    spans, keys = F.col(f"{parts[0]}.spans"), F.col(f"{parts[0]}.texts")
    if blocks > 1:
        spans = _merge_spans()(F.concat(*[F.col(f"{p}.spans") for p in parts]))
        keys = F.array_sort(F.array_distinct(F.concat(*[F.col(f"{p}.texts") for p in parts])))
    merged = fresh(out, "_spans")
    hit = F.aggregate(merged, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return (out.withColumn(merged, spans).withColumn(result, F.struct(
        F.col(f"{parts[0]}.n_words").alias("n_words"), hit.alias("n_hit"), F.col(merged).alias("spans"),
        keys.alias("texts"))).drop(merged, *parts))


def with_items(hits: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
               result: str = "hits") -> DataFrame:
    """``found_texts``' rows with items in place of texts: the ids of all items
    that have a found text, distinct, sorted as strings; a null id is the empty
    string.

    The rows are written once. Ids meet the distinct sets of found texts; rows
    without a hit take no part in the join, the others are dealt over salts, as
    thousands of copies share one set.
    """
    kept = written(hits, "benchmark-hits")
    texts = F.col(f"{result}.texts")
    owners = benchmark.where(F.col(item_text).isNotNull()).select(
        F.sha2(F.col(item_text), 256).alias("text"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id")).distinct()
    sets = kept.where(F.size(texts) > 0).select(texts.alias("set")).distinct()
    named = (sets.select("set", F.explode("set").alias("text")).join(owners, "text")
             .groupBy("set").agg(F.array_sort(F.collect_set("id")).alias("items"))
             .select("set", "items", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    names = [fresh(kept, x) for x in ("_set", "_items", "_salt")]
    named = named.toDF(*names)
    hit = kept.where(F.size(texts) > 0).withColumn(names[0], texts).withColumn(
        names[2], F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(named, [names[0], names[2]])
    clean = kept.where(F.size(texts) == 0)

    def named_result(items: Column) -> Column:
        return F.struct(*[F.col(f"{result}.{c}").alias(c) for c in ("n_words", "n_hit", "spans")], items.alias("items"))

    return (clean.withColumn(result, named_result(F.array().cast("array<string>"))).unionByName(
        hit.withColumn(result, named_result(F.col(names[1]))).select(*kept.columns)))


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, block_chars: int = 4_000_000,
                  result: str = "hits") -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, n_hit, spans and items
    (``found_texts``, then ``with_items``)."""
    return with_items(found_texts(docs, benchmark, text_col, item_text, window, block_chars, result),
                      benchmark, item_id, item_text, result)


def is_contaminated(hits: str):
    """Over a result column: at least a twentieth of the words are hit."""
    return (F.col(f"{hits}.n_hit") > 0) & (F.col(f"{hits}.n_hit") * 20 >= F.col(f"{hits}.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without contaminated rows, same columns."""
    name = fresh(docs, "_hits")
    return found_texts(docs, benchmark, result=name, **kw).where(~is_contaminated(name)).drop(name)
