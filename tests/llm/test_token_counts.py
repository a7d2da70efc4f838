"""Token counts against the tokenizers library's unigram model."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from orderlake.llm import token_counts as tc

SMALL = (("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("ab", -2.0), ("b", -1.0), ("▁a", -3.0), ("abc", -4.0),
         ("c", -2.0), ("bc", -3.0), ("aaa", -3.0))


def library(vocabulary):
    t = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=vocabulary.byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


@pytest.fixture(scope="module")
def real():
    return tc.read_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("small", [True, False])
def test_counts_equal_the_library(real, small):
    vocabulary = tc.Vocabulary(SMALL, False) if small else real
    letters = "abcab cxy▁é  " if small else "abc the ing  éñ日\n\t▁<0x41><s>😀梦ゼ.,!?"
    rng = random.Random(6)
    cache, want = tc.Counter(vocabulary).cached(), library(vocabulary)
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert tc.count_text(text, cache) == len(want.encode(text, add_special_tokens=False).ids), text


def test_operator_keeps_rows_and_counts_whole_texts(make_docs, odd_texts, real):
    docs = make_docs(odd_texts)
    out = tc.token_counts(docs, real)
    assert out.columns == [*docs.columns, "n_tokens"] and out.count() == len(odd_texts)
    want = library(real)
    for r in out.collect():
        assert r["n_tokens"] == len(want.encode(r["text"] or "", add_special_tokens=False).ids)
    assert tc.token_counts(make_docs([]), real).count() == 0
