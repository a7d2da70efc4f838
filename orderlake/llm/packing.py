"""Bounded-space online packing of tokenized documents into fixed sequences.

Each partition keeps a fixed number of open windows. A document's token ids
are cut into full sequences and a rest; the rest goes best-fit into an open
window. If none fits, the fullest window is emitted and a new one opened. The
windows left open at the end of all partitions are merged: they are spread
over groups of bounded expected size and packed best-fit decreasing, so no
task sees more than a few thousand of them.

The pieces of the first pass are written to the shared folder once. The merge
reads only the left-over windows' lengths from it, so a retried task cannot
make the two disagree.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import WordCache, byte_texts, small_batches, written

#: Sequences of merged left-over windows are numbered from here.
MERGED = 1 << 62
#: The usual pattern of words, and one that finds the same in lower-cased plain text, faster.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_WORDS = r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+"


class Encoder:
    """Token ids of whole texts, one word or white-space separated chunk at a time.

    The tokenizer splits at white space before it merges and drops it, so a
    chunk's ids do not depend on its neighbours and can be kept. Chunks end at
    ASCII white space only; any other is left to the tokenizer. Printable ASCII
    and Latin-1 letters are in normal form, so a text of these and ASCII white
    space is lower-cased and cut by the tokenizer's own pattern as a whole, and
    only unseen words go through its merges. Other texts go chunk by chunk: a
    chunk of these letters the same way, every other chunk, and every other kind
    of tokenizer, the tokenizer's whole way."""

    def __init__(self, tokenizer_json: str, limit: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.chunks, self.words = WordCache(self._chunk, limit), WordCache(self._word, 2 * limit)
        spec = json.loads(tokenizer_json)
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.simple = None
        if steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in cuts] == ["Split", "ByteLevel"]:
            pattern = cuts[0]["pattern"]["Regex"]
            self.findall = regex.compile(pattern).findall
            self.plain_words = re.compile(_PLAIN_WORDS).findall if pattern == _WORDS else self.findall
            self.simple = regex.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
            self.plain = re.compile(r"[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
            added = [x["content"] for x in spec["added_tokens"]]
            self.special = os.path.commonprefix(added) if added else "\n"  # no chunk holds a line end
            self.model, self.letters = self.tokenizer.model, byte_letters()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.simple:
            if text.isascii() and text.isalpha():
                return self.words[text.lower()]
            if self.simple(text) and self.special not in text:
                return b"".join(map(self.words.__getitem__, self.findall(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of one UTF-8 text."""
        if self.simple:
            whole = text.decode()
            if self.plain(whole) and self.special not in whole:
                return np.frombuffer(b"".join(map(self.words.__getitem__, self.plain_words(whole.lower()))), dtype=np.uint32)
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split())), dtype=np.uint32)


_encoders: dict[int, Encoder] = {}


def encoder(tokenizer_json: str) -> Encoder:
    """The worker's encoder, so later tasks find its words."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json)
    return _encoders[key]


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Packer:
    """Open windows of one partition. Yields closed windows as lists of pieces."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.most = capacity, open_windows
        self.windows: list[tuple[int, int]] = []  # (room left, window number), ascending
        self.pieces: dict[int, list] = {}
        self.last = -1

    def _open(self, piece) -> int:
        self.last += 1
        self.pieces[self.last] = [(piece, 0)]
        return self.last

    def add(self, size: int, piece):
        """Places a piece; returns a window that closes, or None."""
        if size == self.capacity:
            number = self._open(piece)
            return number, self.pieces.pop(number)
        at = bisect_left(self.windows, (size, -1))  # best fit: least room that suffices
        closed = None
        if at < len(self.windows):
            room, number = self.windows.pop(at)
            self.pieces[number].append((piece, self.capacity - room))
        else:
            if len(self.windows) >= self.most:  # the fullest leaves
                _, full = self.windows.pop(0)
                closed = full, self.pieces.pop(full)
            room, number = self.capacity, self._open(piece)
        if room == size:
            return number, self.pieces.pop(number)
        insort(self.windows, (room - size, number))
        return closed

    def rest(self):
        yield from self.pieces.items()


_OUT = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("left_over", pa.bool_())]


def _pack_partition(tokenizer, capacity: int, open_windows: int, end_id: int, with_ids: bool, id_type: pa.DataType):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        packer, own = Packer(capacity, open_windows), encoder(tokenizer.value)
        out: list[tuple] = []

        def close(number, pieces, left):
            for piece, offset in pieces:
                out.append((*piece, base + number, offset, left))

        def flush():
            doc, ids, *rest = zip(*out, strict=True)
            cols = [pa.array(doc, id_type)]
            cols += [pa.array(x, t) for x, (_, t) in zip(rest, _OUT, strict=True)]
            names = ["doc", *[n for n, _ in _OUT]]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            out.clear()
            return pa.record_batch(cols, names=names)

        for batch in batches:
            docs = batch.column(0).to_pylist()
            raw, off = byte_texts(batch.column(1))
            for doc, a, b in zip(docs, off[:-1].tolist(), off[1:].tolist(), strict=True):
                ids = np.append(own.encode(bytes(raw[a:b])), np.uint32(end_id)).astype("<u4")
                n = len(ids)
                for start in range(0, n, capacity):
                    part = ids[start:start + capacity]
                    piece = (doc, part.astype(np.int32) if with_ids else None, start, len(part),
                             zlib.crc32(part.tobytes()), n)
                    done = packer.add(len(part), piece)
                    if done:
                        close(*done, False)
                if len(out) >= (1024 if with_ids else 4096):
                    yield flush()
        for number, pieces in packer.rest():
            close(number, pieces, True)
            if len(out) >= (1024 if with_ids else 4096):
                yield flush()
        if out:
            yield flush()
    return pack


def _merge_group(capacity: int):
    """Best-fit decreasing over the left-over windows of one group."""
    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        order = sorted(zip(table["fill"].to_pylist(), table["sequence_id"].to_pylist(), strict=True),
                       key=lambda x: (-x[0], x[1]))
        room: list[tuple[int, int]] = []
        rows, last = [], -1
        for fill, window in order:
            at = bisect_left(room, (fill, -1))
            if at < len(room):
                left, number = room.pop(at)
            else:
                last += 1
                left, number = capacity, last
            rows.append((window, MERGED + (group << 33) + number, capacity - left))
            if left > fill:
                insort(room, (left - fill, number))
        cols = zip(*rows, strict=True)
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["sequence_id", "merged_id", "base"])
    return merge


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int = 1, open_windows: int = 64, group_windows: int = 2000, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``with_ids`` the piece's token ids.

    A document's ids are its text's ids and then ``end_id``; a null or empty
    text has the end id alone. Documents longer than ``capacity`` are cut. Each
    id lies in exactly one piece, pieces of a sequence are gapless from offset
    0 and hold at most ``capacity`` ids. Ids may be null or repeated: every row
    is packed for itself. An empty table gives no rows; other columns are not
    read. ``tokenizer_path`` is read on the driver and broadcast (a file of a
    few MB).
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc", kind)] + [
        T.StructField(n, T.BooleanType() if t == pa.bool_() else T.LongType()) for n, t in _OUT])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    pieces = written(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _pack_partition(tokenizer, capacity, open_windows, end_id, with_ids, to_arrow_type(kind)), schema), "packed")
    left = pieces.where("left_over").groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    left = written(left, "pack-left")
    groups = max(1, -(-left.count() // group_windows))
    merged = left.withColumn("group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))).groupBy("group").applyInArrow(
        _merge_group(capacity), "sequence_id long, merged_id long, base long")
    moved = pieces.where("left_over").join(merged, "sequence_id").select(
        "doc", "start", "length", "ids_crc32", "doc_tokens", F.col("merged_id").alias("sequence_id"),
        (F.col("offset") + F.col("base")).alias("offset"), *(["ids"] if with_ids else []))
    done = pieces.where("NOT left_over").drop("left_over")
    return done.unionByName(moved).withColumnRenamed("doc", id_col)
