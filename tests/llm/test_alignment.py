"""Cross-tokenizer alignment against a plain version over whole texts."""

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from orderlake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    shown += [x for x in range(256) if x not in shown]
    back = {chr(x if i < 188 else 68 + i): x for i, x in enumerate(shown)}

    def bytes_a(i):
        return bytes(back[c] for c in a.id_to_token(i))

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, links = [], Counter()
    for doc, text in rows:
        groups, own = [], []
        if text:
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            tokens = [(i, bytes_a(i)) for i in left], [(i, bytes_b(i)) for i in right]
            if all(b"".join(t for _, t in s) == (" " + text).encode() for s in tokens):
                ends = []
                for side in tokens:
                    at, e = 0, []
                    for _, t in side:
                        at += len(t)
                        e.append(at)
                    ends.append(e)
                common = sorted(set(ends[0]) & set(ends[1]))
                i = j = 0
                for c in common:
                    i2, j2 = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
                    groups.append((left[i:i2], right[j:j2]))
                    own.append((left[i2 - 1], right[j2 - 1]))
                    i, j = i2, j2
        docs.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), own,
                     ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
        links.update(own)
    top = Counter()
    for (_, y), n in links.items():
        top[y] = max(top[y], n)
    return sorted((str((doc, n, m, g, len(own), sum(links[x] == top[x[1]] for x in own), sum(links[x] for x in own), s))
                   for doc, n, m, g, own, s in docs)), links


def rows_of(odd_texts):
    rng = random.Random(6)
    letters = "abc ,.'\n\t  éßжя東 😀▁ ­\x1c\x85\x00<|>_09"
    rows = [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))) for i in range(150)]
    rows += [(300, "<|endoftext|> <s></s><unk> <0x41>"), (301, " lead"), (302, "trail "), (303, " "), (304, "it's  we'll"),
             (305, "a▁b"), (306, "naïve café " * 9000)]
    odd = [(i, t) for i, t in odd_texts if not t or len(t) < 200_000]
    return odd + rows + rows[:30]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_equals_plain_version(spark, make_docs, odd_texts):
    rows = rows_of(odd_texts)
    want, links = plain(rows)
    docs = make_docs(rows).repartition(4)
    for heavy in (1 << 16, 40):                  # all pairs broadcast; nearly all joined
        out = alignment.align(docs, A, B, heavy=heavy)
        assert out.documents.columns == COLUMNS
        assert sorted(str(tuple(r)) for r in out.documents.collect()) == want
        assert {(r["a"], r["b"]): r["count"] for r in out.pairs.collect()} == links


def test_digest_and_empty(spark, make_docs):
    rows = [(1, "Hello  world, naïve text"), (2, None), (3, "a▁b")]
    shown = {r["doc_id"]: r["groups"] for r in alignment.align(make_docs(rows), A, B).documents.collect()}
    digest = {r["doc_id"]: r["groups"] for r in alignment.align(make_docs(rows), A, B, digest=True).documents.collect()}
    assert digest == {1: sha256(shown[1].encode()).hexdigest(), 2: "", 3: ""}
    assert alignment.align(make_docs([]), A, B).documents.collect() == []


def test_identity_map():
    same = alignment.identity_map(open(A, encoding="utf-8").read(), open(B, "rb").read())
    pair = alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    on = [i for i, j in enumerate(same) if j >= 0]
    assert len(on) > 10_000 and all(pair.a.bytes[i] == pair.b.bytes[same[i]] for i in on)
    assert not {t for i, t in enumerate(pair.a.bytes) if same[i] < 0} & set(pair.b.bytes)
