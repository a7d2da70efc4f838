"""Cross-tokenizer alignment with an identity map for the regular groups.

Every text is encoded by two tokenizers over the same bytes: ``first``, a
byte-level BPE, over a space and the text, ``second``, a piece model, over the
text (it adds the space). Byte offsets where a token of both ends cut the two
sequences into groups; the last tokens of a group are linked.

``identity_map`` holds, for each id of the first tokenizer, the id of the
second with the same bytes. Groups of one token each that follow the map are
counted in arrays as long as the vocabulary; only the links of other groups
are shuffled as pairs. The pairs with over 1/65,536 of all these links (fewer
than 65,536 of them) are looked up in a broadcast array like the identity
counts; the documents' other links meet their counts in a join, in which no
key has more than that share of the rows.

Null or empty texts, and texts whose tokens of either side don't spell the
space and the text, have no tokens. Repeated or null ids are rows of their
own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import small_batches, written
from orderlake.llm.packing import byte_letters

#: Texts are encoded in slices of about this many characters.
SLICE = 1 << 16
#: A space between two visible characters: a token of both kinds ends before it.
_CUT = re.compile(r"(?<=[!-~¡-ɏ]) (?=[!-~¡-ɏ])")
#: Texts for which all pattern engines agree on letters, digits and white space.
_PLAIN = re.compile(r"[\t-\r\x20-\x7e -ɏ‐-‧]*").fullmatch
#: The pattern of byte-level BPE (a fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokenizer:
    """A byte-level BPE file of the ``tokenizers`` library; special-token
    strings are plain text."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.letters = byte_letters()
        back = {ord(c): b for b, c in self.letters.items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(ord(c) in back for c in token)
            self.bytes[i] = bytes(back[ord(c)] for c in token) if known else token.encode()
        self.ranks = self._ranks(json.loads(spec), vocab)

    def _ranks(self, spec: dict, vocab: dict[str, int]):
        """The same merges in the rank form, which is faster, where ids ascend
        in the order of the merges and words are cut by the usual pattern."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        ids = [vocab.get(m.replace(" ", "")) for m in merges]
        own = len(self.letters)
        if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space")
                or model.get("ignore_merges") or ids != list(range(own, own + len(ids)))
                or sorted(len(t) for t in self.bytes[:own]) != [1] * own):
            return None
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=_WORDS, special_tokens={}, mergeable_ranks={
            t: i for i, t in enumerate(self.bytes[:own + len(ids)])})

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is not None and _PLAIN(text):
            return np.array(self.ranks.encode_ordinary(text), dtype=np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class PieceTokenizer:
    """A sentencepiece model; U+2581 stands for a space, byte pieces for a byte."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes, self.byte_pieces = [], set()
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.byte_pieces.add(i)
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        """``text`` begins with the space that the model adds by itself."""
        return np.array(self.model.encode(text[1:]), dtype=np.uint32)


class Pair:
    """Both tokenizers of a worker and the tables that follow from them."""

    def __init__(self, first: str, second: bytes):
        self.a, self.b = ByteTokenizer(first), PieceTokenizer(second)
        self.sizes = [np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (self.a, self.b)]
        ids = {t: i for i, t in enumerate(self.b.bytes) if i in self.b.byte_pieces}
        ids.update((t, i) for i, t in enumerate(self.b.bytes) if i not in self.b.byte_pieces)
        self.same = np.array([ids.get(t, -1) if t else -1 for t in self.a.bytes], dtype=np.int64)
        width = len(str(max(len(self.a.bytes), len(self.b.bytes)) - 1))
        numbers = [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self.digits = np.frombuffer("".join(n.ljust(width + 1) for n in numbers).encode(), dtype=np.uint8).reshape(
            -1, width + 1)
        self.n_digits = np.array([len(n) for n in numbers], dtype=np.int64)

    def slice(self, text: str):
        """(first ids, second ids, ends of groups in each) or None where the
        tokens don't spell ``text``."""
        raw = text.encode()
        ids = [self.a.encode(text), self.b.encode(text)]
        for own, known in zip(ids, (self.a, self.b)):
            if b"".join(map(known.bytes.__getitem__, own.tolist())) != raw:
                return None
        ends = [np.cumsum(size[own]) for size, own in zip(self.sizes, ids)]
        _, at_a, at_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
        return ids[0], ids[1], at_a, at_b

    def groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of one slice: every id's digits and the sign after it."""
        ids = np.concatenate([a, b]).astype(np.int64)
        sign = np.full(len(ids), ord(","), dtype=np.uint8)
        sign[at_a], sign[len(a) + at_b] = ord("|"), ord(";")
        group_a = np.searchsorted(at_a, np.arange(len(a)))
        group_b = np.searchsorted(at_b, np.arange(len(b)))
        ends_b, ends_a = np.concatenate([[0], at_b + 1]), at_a + 1
        place = np.concatenate([np.arange(len(a)) + ends_b[group_a], np.arange(len(b)) + ends_a[group_b]])
        order = np.empty(len(ids), dtype=np.int64)
        order[place] = np.arange(len(ids))
        ids, sign = ids[order], sign[order]
        rows, length = self.digits[ids], self.n_digits[ids]
        rows[np.arange(len(ids)), length] = sign
        return rows[np.arange(rows.shape[1]) <= length[:, None]].tobytes()[:-1]


_pairs: dict[int, Pair] = {}


def _pair(spec: tuple) -> Pair:
    """The worker's tokenizers, so later tasks find their words."""
    key = hash(spec)
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(*spec)
    return _pairs[key]


def identity_map(first: str, second: bytes) -> np.ndarray:
    """For each id of the first tokenizer the second's id of the same bytes, or -1."""
    return _pair((first, second)).same


def slices(text: str):
    """``text`` cut where tokens of both kinds end, into slices of bounded size."""
    start = 0
    while len(text) - start > SLICE:
        cut = _CUT.search(text, start + SLICE)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def align_text(pair: Pair, text: str | None, digest: bool):
    """(n_a, n_b, n_groups, groups, identity ids, other links) of one text."""
    counts, exact, links = [0, 0, 0], [], []
    out, hashed = [], sha256()
    for part in slices(" " + text) if text else ():
        cut = pair.slice(part)
        if cut is None:
            return [0, 0, 0], "", [], []
        a, b, at_a, at_b = cut
        last_a, last_b = a[at_a].astype(np.int64), b[at_b].astype(np.int64)
        single = (np.diff(at_a, prepend=-1) == 1) & (np.diff(at_b, prepend=-1) == 1)
        regular = single & (pair.same[last_a] == last_b)
        shown = pair.groups(a, b, at_a, at_b)
        if digest:
            hashed.update(b";" + shown if counts[2] else shown)
        else:
            out.append(shown)
        for i, n in enumerate((len(a), len(b), len(at_a))):
            counts[i] += n
        exact.append(last_a[regular])
        links.append((last_a * len(pair.b.bytes) + last_b)[~regular])
    if not counts[2]:
        return counts, "", [], []
    groups = hashed.hexdigest() if digest else b";".join(out).decode()
    return counts, groups, np.concatenate(exact).astype(np.int32), np.concatenate(links)


_CUT_SCHEMA = "row long, doc_id {}, n_a long, n_b long, n_groups long, groups string, exact array<int>, links array<long>"


def _cut_partition(tokenizers, digest: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = _pair(tokenizers.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [align_text(pair, t.as_py(), digest) for t in batch.column("text")]
            n = len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + n)), batch.column("doc_id"),
                *(pa.array([f[0][i] for f in found], pa.int64()) for i in range(3)), pa.array([f[1] for f in found], pa.string()),
                pa.array([f[2] for f in found], pa.list_(pa.int32())), pa.array([f[3] for f in found], pa.list_(pa.int64()))],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "exact", "links"])
            row += n
    return cut


def _count_exact(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("exact").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["a", "n"])
    return count


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]


def _score_partition(tables, n_second: int):
    """Adds what the broadcast counts tell; the other links are left."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact_n, exact_best, heavy, heavy_n, best = tables.value
        for batch in batches:
            exact, links = batch.column("exact"), batch.column("links")
            ids, off = exact.flatten().to_numpy(), exact.offsets.to_numpy()
            total, top = _sums(exact_n[ids], off), _sums(exact_best[ids], off)
            codes, off = links.flatten().to_numpy(), links.offsets.to_numpy()
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, codes), len(heavy) - 1)
                known = heavy[at] == codes
                n = np.where(known, heavy_n[at], 0)
            else:
                known, n = np.zeros(len(codes), dtype=bool), np.zeros(len(codes), dtype=np.int64)
            total += _sums(n, off)
            top += _sums(known & (n == best[codes % n_second]), off)
            left = np.concatenate([[0], np.cumsum(_sums(~known, off))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(top), pa.array(total),
                pa.ListArray.from_arrays(pa.array(left), pa.array(codes[~known]))],
                names=["row", "n_best", "count_sum", "links"])
    return score


@dataclass(frozen=True)
class Alignment:
    """``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups. ``pairs``: a, b, count of every linked pair of ids."""
    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, first: str, second: str, digest: bool = False, heavy: int = 1 << 16) -> Alignment:
    """Aligns ``text`` of all rows of ``docs`` under the tokenizer files
    ``first`` and ``second``. ``groups`` is the text ``a1,a2|b1;a3|b2,b3``, or
    with ``digest`` its SHA-256 ('' without tokens). Pairs that hold at least
    1/``heavy`` of the irregular links are broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        spec = f.read(), g.read()
    same = identity_map(*spec)
    n_first, n_second = len(same), len(_pair(spec).b.bytes)
    slim = docs.select("doc_id", "text")
    cut = written(slim.mapInArrow(_cut_partition(spark.sparkContext.broadcast(spec), digest), _CUT_SCHEMA.format(
        slim.schema["doc_id"].dataType.simpleString())), "alignment-cut")

    # regular links: vectors as long as the vocabulary
    exact_n = np.zeros(n_first, dtype=np.int64)
    exact = cut.select("exact").mapInArrow(_count_exact(n_first), "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))
    for r in exact.toLocalIterator():
        exact_n[r["a"]] = r["n"]
    # irregular links: the pair shuffle
    pairs = written(cut.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n")),
                    "alignment-pairs")
    best = np.zeros(n_second, dtype=np.int64)
    on = same >= 0
    np.maximum.at(best, same[on], exact_n[on])
    for r in pairs.groupBy((F.col("link") % n_second).alias("b")).agg(F.max("n").alias("n")).toLocalIterator():
        best[r["b"]] = max(best[r["b"]], r["n"])
    share = (pairs.agg(F.sum("n")).first()[0] or 0) / heavy
    top = sorted((r["link"], r["n"]) for r in pairs.where(F.col("n") > share).toLocalIterator())
    tables = (exact_n, (exact_n == best[np.where(on, same, 0)]) & on, np.array([t[0] for t in top], dtype=np.int64),
              np.array([t[1] for t in top], dtype=np.int64), best)

    scored = written(cut.select("row", "exact", "links").mapInArrow(
        _score_partition(spark.sparkContext.broadcast(tables), n_second),
        "row long, n_best long, count_sum long, links array<long>"), "alignment-scored")
    highest = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "b int, best long")
    rest = pairs.where(F.col("n") <= share).join(F.broadcast(highest), F.col("link") % n_second == F.col("b"))
    rare = (scored.select("row", F.explode("links").alias("link")).join(rest, "link")
            .select("row", (F.col("n") == F.col("best")).cast("long").alias("n_best"), F.col("n").alias("count_sum")))
    sums = (scored.select("row", "n_best", "count_sum").unionByName(rare).groupBy("row")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    documents = cut.drop("exact", "links").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups")
    every = spark.createDataFrame([(int(a), int(n)) for a, n in enumerate(exact_n) if n], "a int, count long").join(
        F.broadcast(spark.createDataFrame([(int(a), int(b)) for a, b in enumerate(same) if b >= 0], "a int, b int")), "a")
    return Alignment(documents, every.select("a", "b", "count").unionByName(pairs.select(
        F.expr(f"int(link div {n_second})").alias("a"), (F.col("link") % n_second).cast("int").alias("b"),
        F.col("n").alias("count"))))
