"""Packing: exact ids, exact cover, gapless sequences, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        own = packing.Encoder(f.read(), limit=50)
    rng = random.Random(1)
    letters = "abcABC'стÉéßİ́  \x1c\x85 \t\n!?09²½٣日本😀<|>Å﻿\x00’"
    for i in range(600):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        text += " don't WE'LL <|endoftext|>x y<|startoftext|>" if i % 5 == 0 else ""
        assert own.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_texts_are_cut_as_a_whole(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        own = packing.Encoder(f.read(), limit=50)
    made, make = [], own.words.make
    own.words.make = lambda w: made.append(w) or make(w)
    text = "Tion*** tion###\ttion, don't\r\nÉté É99 'Sx it's\x0b\x0cTION"
    assert own.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert made.count("tion") == 1 and not own.chunks  # no entry for each word with other signs around it
    rng = random.Random(2)
    letters = "abcXYZ'stÉéßÿ×ª <|>~! \t\n\r\x0b\x0c09"
    for i in range(600):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) + (" <|endoftext|>x" if i % 9 == 0 else "")
        assert own.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity, open_windows", [(64, 4), (2048, 64)])
def test_pieces_cover_every_id_once(spark, make_docs, odd_texts, tokenizer, capacity, open_windows):
    rng = random.Random(3)
    docs = odd_texts + [(1000 + i, " ".join(["word"] * rng.randint(0, 3 * capacity // 2))) for i in range(60)]
    rows = packing.pack(make_docs(docs).repartition(3), PATH, capacity=capacity, open_windows=open_windows,
                        group_windows=5).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        ids = np.array(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append(ids_of(tokenizer, t))
    for i, lists in want.items():
        if len(lists) == 1:  # ids that repeat can't be told apart by piece
            assert sum((x for _, x, _ in sorted(by_doc[i])), []) == lists[0]
            assert {n for _, _, n in by_doc[i]} == {len(lists[0])}
        else:
            assert sum(len(x) for _, x, _ in by_doc[i]) == sum(map(len, lists))
    total = sum(len(x) for lists in want.values() for x in lists)
    assert len(by_sequence) <= 1.25 * total / capacity + 2


def test_open_windows_are_best_fit_and_bounded():
    p = packing.Packer(10, 2)
    assert p.add(6, "a") is None and p.add(7, "b") is None
    assert p.add(3, "c") == (1, [("b", 0), ("c", 7)])       # the tightest window that has room
    assert p.add(5, "d") is None
    assert p.add(8, "e") == (0, [("a", 0)])                 # none fits: the fullest leaves
    assert p.add(10, "f") == (4, [("f", 0)])
    assert sorted(n for n, _ in p.rest()) == [2, 3]


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), PATH, with_ids=False).count() == 0
