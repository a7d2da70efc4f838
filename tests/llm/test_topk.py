"""Exact top-k against brute force, with ties, nulls and long integers."""

import math
import random

import numpy as np
import pytest

from orderlake.llm import topk

NAN, INF = float("nan"), float("inf")


def plain(rows, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in good:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        best = sorted((-max(min(sum(a * b for a, b in zip(v, w, strict=False)), 2**63 - 1), -2**63), i)
                      for i, w in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                  "vec_id long, embedding array<float>, score string, rank int").repartition(4)
    return sorted(tuple(r) for r in topk.top_k(table, table.where("vec_id % 20 = 0"), **kw).collect())


@pytest.mark.parametrize("seed, block_rows, lists", [(1, 2048, 4), (2, 3, 4), (3, 2, 1)])
def test_equals_brute_force(spark, seed, block_rows, lists):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(6)]) for i in range(150)]
    rows += [(i, [1.0] * 6) for i in range(200, 260)]                  # many ties
    rows += [(1001, None), (None, [1.0] * 6), (1003, [NAN] + [1.0] * 5), (1004, [INF] + [1.0] * 5), (1005, []),
             (1006, [None] + [1.0] * 5), (1007, [2.0, 2.0]), (1008, [1.0] * 9), (40, [9.0] * 6), (61, [1.0] * 6),
             (61, [1.0] * 6)]
    assert run(spark, rows, k=7, block_rows=block_rows, lists=lists) == plain(rows, 7)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0, -1.0]), (1, [0.5, 0.5]), (20, [0.25, 3.0])]
    assert run(spark, rows, k=20) == plain(rows, 20)
    assert run(spark, [], k=20) == []


def test_integers_beyond_a_double(spark):
    rows = [(i, [float((i * 7919) % 1000 + 1) * 2.0**21, float(i), -3.0 * 2.0**20]) for i in range(0, 90, 5)]
    assert run(spark, rows, k=5) == plain(rows, 5)


def test_short_vectors_are_left_out_before_their_scores(spark):
    """Lengths alone rule out what cannot reach a cutoff; results stay whole."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * (8.0 if i % 10 == 0 else 0.05) for _ in range(8)]) for i in range(400)]
    assert run(spark, rows, k=5) == plain(rows, 5)
    whole = np.array([[math.floor(64 * x) for x in v] for _, v in rows], dtype=np.int64)
    ids = [i for i, _ in rows]
    block = topk.Block([i for i in ids if i % 20 == 0], whole[::20], 4)
    scores = whole[::20] @ whole.T
    floor = np.sort(scores, axis=1)[:, -6].astype(float)
    asked, near = block.reachable(whole, floor)
    assert len(near) < 100 and len(asked) == 20
    assert set(np.nonzero((scores >= floor[:, None]).any(axis=0))[0]) <= set(near.tolist())
    assert len(block.reachable(whole[1:2], floor)[1]) == 0


def test_nothing_stays_broadcast(spark, monkeypatch):
    made = []
    real = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: made.append(real(value)) or made[-1])
    rows = [(i, [float(i), 1.0]) for i in range(0, 200, 5)]
    assert run(spark, rows, k=3, block_rows=2) == plain(rows, 3)
    assert len(made) >= 6
    assert not any(b._jbroadcast.isValid() for b in made)
