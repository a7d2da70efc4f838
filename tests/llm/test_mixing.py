"""Mixing to target weights: targets and fits against brute force, selection against its order."""

import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, size string, Key string"


def plain_targets(sizes, weights, share):
    """Words by source in code point order (null last) -> target."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, open_, out = share * sum(sizes.values()), set(order), {}
    while True:
        rest = budget - sum(out.values())
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if rest * w[s] / total > 2 * sizes[s]}
        if not over:
            return {**out, **{s: rest * w[s] / total for s in open_}}
        out.update({s: 2.0 * sizes[s] for s in over})
        open_ -= over


@pytest.mark.parametrize("seed", range(40))
def test_fit_is_the_nearest_sum(seed):
    rng = random.Random(seed)
    sizes = np.array(sorted(rng.sample(range(1, 40), rng.randint(1, 5))))
    counts = np.array([rng.randint(1, 4) for _ in sizes])
    sums = {int(sizes @ np.array(c)) for c in product(*(range(n + 1) for n in counts))}
    for budget in {0, 1, *(rng.randint(0, int(sizes @ counts)) for _ in range(6))}:
        took = mixing.knapsack(sizes, counts, budget)
        near = min(abs(s - budget) for s in sums if s <= budget + sizes[0])
        assert (took <= counts).all() and abs(int(sizes @ took) - budget) == near
        took = mixing.fit(sizes, counts, budget, rest=int(sizes @ counts))
        assert (took <= counts).all() and (took >= 0).all()


@pytest.mark.parametrize("seed", range(30))
def test_long_documents_do_not_leave_a_target_unmet(seed):
    rng = random.Random(seed)
    sizes = np.array(sorted(rng.sample(range(1, 30), 4)) + [200])
    counts = np.array([rng.randint(1, 6) for _ in range(4)] + [1])
    whole = int(sizes @ counts)
    sums = {int(sizes @ np.array(c)) for c in product(*(range(2 * n + 1) for n in counts))}
    for target in (0.0, whole / 3, whole / 2 + 0.5, 1.3 * whole, 2.0 * whole):
        took = mixing.copies_of(sizes, counts, target)
        assert (took <= 2 * counts).all()
        assert abs(int(sizes @ took) - target) <= min(abs(s - target) for s in sums) + sizes[0]


def test_fit_of_large_counts_is_exact():
    sizes, counts = np.array([3, 50, 701, 90000]), np.array([5, 10_000, 1_000_000, 3_000_000])
    for budget in (0, 3, 12, 50_000_001, 270_000_000_003, int(sizes @ counts)):
        took = mixing.fit(sizes, counts, budget)
        assert (took <= counts).all() and abs(int(sizes @ took) - budget) <= 2


def _rows(rng):
    sources = ["a", "B", "é", "", None, "tiny", "nothing", "b"]
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(sources[:5]))
            for i in range(600)]
    rows += [(1000 + i, "same text of six words here", "b") for i in range(400)]       # copies
    rows += [(7, "one doc_id many times", "b")] * 150 + [(None, "no id", "a")] * 50     # ties
    return rows + [(2000, "lone", "tiny"), (2001, None, "nothing"), (2002, " \t ", "nothing"), (2003, "x " * 3000, "a"),
                   (2004, "a\u0085b c\x1cd e", "a"), (None, None, None)]


def _table(spark, rows, parts):
    return spark.createDataFrame([(i, t, "en", s, "x", "y") for i, t, s in rows], SCHEMA).repartition(parts)


def test_targets_sums_and_reruns(spark):
    rows = _rows(random.Random(2))
    cols = ["doc_id", "source", "size", "source_size", "target", "times", "taken"]
    runs = [[tuple(r) for r in mixing.mix(_table(spark, rows, n), (5, 2, 1), 1.5, carry=["text"]).select(
        *cols, "text").collect()] for n in (3, 5)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by = {}
    for i, t, s in rows:
        by[s] = by.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(by, (5, 2, 1), 1.5)
    assert len(runs[0]) == len(rows)
    for doc, source, n, whole, target, times, taken, _ in runs[0]:
        assert n == size[doc] or doc == 7 or doc is None
        assert whole == by[source] and target == pytest.approx(want[source]) and times in (0, 1, 2) and taken == n * times
    for s, t in want.items():
        assert abs(sum(r[6] for r in runs[0] if r[1] == s) - t) <= 1, s


def test_least_hashes_first(spark):
    rows = [(i, "four words in it", "s") for i in range(500)]
    docs = _table(spark, rows, 4)
    out = mixing.mix(docs, (1,), 0.5, seed=3)
    hashes = docs.select("doc_id", F.xxhash64(F.lit(3), "doc_id", "text").alias("h")).collect()
    order = [r["doc_id"] for r in sorted(hashes, key=lambda r: r["h"] % 2**64)]
    assert {r["doc_id"] for r in out.where("times = 1").collect()} == set(order[:250])
    assert mixing.repeated(out).count() == 250


def test_empty_and_wordless(spark):
    assert mixing.mix(_table(spark, [], 1), (5, 2, 1), 1.5).collect() == []
    out = mixing.mix(_table(spark, [(1, None, "a"), (2, "", None)], 1), (5, 2, 1), 1.5).collect()
    assert [(r["source_size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2
