import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, Fp string"


def _word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) pairs as a documents table with extra, clashing columns."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty, wordless, tied, repeated and very long texts."""
    rng = random.Random(5)
    long = " ".join(_word(rng) for _ in range(30000))
    near = [_word(rng) for _ in range(300)]
    return [(1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "ONE"), (6, "two words"), (6, "two words"),
            (7, long), (8, long + " tail"), (None, long), (None, None), (9, " ".join(near)),
            (10, " ".join(near[:-1] + ["changed"])), (11, "é ñandú ß 東京  x\u0085y"), (12, "\x1cfoo\x1dbar"),
            (13, "!!! ??? ..."), (14, "a" * 50000), (15, " ".join(near)), (16, "x y z " * 5000)]
