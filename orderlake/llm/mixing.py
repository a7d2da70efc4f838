"""Mixing sources to target weights by fitting budgets as subset sums.

A document's size is its number of words. Each source's target follows from
its weight; a document is taken once, twice or not at all, so a target never
exceeds twice its source. All documents of a source are taken as often as the
target holds the source whole; what remains of the target is a budget for one
more copy of some of them (of any up to twice, where long documents leave it
unmet):

* the documents are counted by source and size;
* each size gets its proportional part of the budget, rounded down, the
  longest take what is left until a short rest remains;
* a bounded-knapsack dynamic programme over the sizes' unused documents fits
  the rest to the word where any choice does, else as near as it can;
* each size's count goes to its documents in order of a seeded hash of id and
  text. No task sorts a whole size: counts of hash ranges decide all ranges
  but one, there counts of hashes, there counts of input parts.

Reruns agree: rows that tie in the hash have the same id and text. Null texts
and texts without words have size 0 and are taken 0 words. A null source is a
source, the last one. Repeated ids are rows of their own. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import written

#: Words that the dynamic programme is given to fit, about.
REST = 1 << 14
#: Hash ranges of one source and size, and input rows of one part, as powers of two.
RANGE_BITS, PART_BITS = 12, 20


def words(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def places(values: DataFrame, column: str) -> DataFrame:
    """``values`` (one row per value) with ``place``, its rank from 0 in code
    point order, null last. Ranges are ranked apart and offset by their counts."""
    v = written(values.repartitionByRange(F.col(column).asc_nulls_last())
                .withColumn("_range", F.spark_partition_id()), "mix-sources")
    before = v.groupBy("_range").count().withColumn("_before", F.coalesce(F.sum("count").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(column).asc_nulls_last()))
    return v.join(F.broadcast(before.drop("count")), "_range").withColumn("place", own + F.col("_before") - 1).drop(
        "_range", "_before")


def targets(sources: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """Adds ``target`` to sources with ``place`` and ``source_size``: ``share``
    of all sizes by weight; a target stops at twice its source's size and the
    excess goes to the others by weight, until none is above. The level (words
    a unit of weight) rises from round to round, so who has stopped stays so."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    s = written(sources.withColumn("_weight", weight), "mix-weights")
    size = F.col("source_size")
    all_sizes, all_weights = s.agg(F.sum(size), F.sum("_weight")).first()
    budget = share * (all_sizes or 0)
    level, stopped = budget / all_weights if all_weights else 0.0, -1
    while True:
        over = F.col("_weight") * level > 2 * size
        n, caps, left = s.agg(F.count_if(over), F.sum(F.when(over, 2 * size)), F.sum(F.when(~over, F.col("_weight")))).first()
        if n == stopped or not left:
            break
        stopped, level = n, (budget - (caps or 0)) / left
    return s.withColumn("target", F.least(F.col("_weight") * level, 2.0 * size)).drop("_weight")


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, rest: int = REST) -> np.ndarray:
    """How many of ``counts`` documents of each of ``sizes`` (ascending, over 0)
    to take, so that their words come nearest to ``budget``.

    A proportional part of each size first; then the longest, until about
    ``rest`` words are left. As many words of the shortest are given back, so
    that the bounded knapsack over what is not taken has a choice."""
    total = int(sizes @ counts)
    budget = max(0, min(int(budget), total))
    if not total:
        return np.zeros_like(counts)
    used = np.array([int(n) * budget // total for n in counts], dtype=np.int64)
    left = budget - int(sizes @ used)
    for i in range(len(sizes) - 1, -1, -1):
        if left <= rest:
            break
        n = min(int(counts[i] - used[i]), (left - rest) // int(sizes[i]))
        used[i] += n
        left -= n * int(sizes[i])
    given = rest
    for i, size in enumerate(sizes.tolist()):
        n = min(int(used[i]), max(given, 0) // size, 64)
        used[i] -= n
        left, given = left + n * size, given - n * size
    return used + knapsack(sizes, counts - used, left)


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts, up to ``counts``, whose words come nearest to ``budget`` (ties:
    the smaller sum), among sums up to the budget and the shortest size more."""
    at = np.flatnonzero(counts)
    taken = np.zeros(len(sizes), dtype=np.int64)
    if not len(at) or budget <= 0:
        return taken
    most = budget + int(sizes[at[0]])
    by = np.full(most + 1, -1, dtype=np.int64)   # the item that reached a sum first
    by[0] = 0
    items = [(0, 0)]                             # (size index, copies): powers of two make every count
    for i in at[::-1]:
        n, copies = min(int(counts[i]), most // int(sizes[i])), 1
        while n > 0 and by[budget] < 0:
            k = min(copies, n)
            step = k * int(sizes[i])
            new = np.flatnonzero((by[:-step] >= 0) & (by[step:] < 0)) + step
            by[new] = len(items)
            items.append((int(i), k))
            n, copies = n - k, 2 * copies
        if by[budget] >= 0:
            break
    sums = np.flatnonzero(by >= 0)
    best = int(sums[np.argmin(np.abs(sums - budget))])
    while best:
        i, k = items[by[best]]
        taken[i] += k
        best -= k * int(sizes[i])
    return taken


def copies_of(sizes: np.ndarray, counts: np.ndarray, target: float) -> np.ndarray:
    """Copies to take of all documents of each size, 0 to twice ``counts``.
    All documents as often as the target holds them whole, and one more of
    some; where that misses (long documents), any document up to twice, if
    that comes nearer."""
    whole = int(sizes @ counts)
    base = int(target // whole) if whole else 0
    took = base * counts + fit(sizes, counts, round(target - base * whole))
    if abs(int(sizes @ took) - target) >= 1:
        other = fit(sizes, 2 * counts, round(target))
        if abs(int(sizes @ other) - target) < abs(int(sizes @ took) - target):
            return other
    return took


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """All sizes of one source: at most the square root of twice its words."""
    rows = rows.sort_values("size")
    size, n = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    took, filled = np.zeros_like(n), size > 0
    took[filled] = copies_of(size[filled], n[filled], float(rows["target"].iloc[0]))
    return rows.assign(copies=took // n, quota=took % n).drop(columns=["place", "n"])


def _decide(rows: DataFrame, quotas: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """``rows`` with ``quotas`` of their ``groups`` and ``take``: the cells of a
    group (its rows by ``key``) are taken in order of ``key`` while the quota
    lasts. 1: all rows of the cell are taken, 0: none, null: ``quota`` of them.
    Cells meet the rows by part of the input, so no key has more rows than a part."""
    parts = written(rows.groupBy(*dict.fromkeys([*groups, key, "part"])).agg(F.count("*").alias("n")), "mix-cells")
    cells = parts.groupBy(*groups, key).agg(F.sum("n").alias("n")).join(quotas, list(groups))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*groups).orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    cells = (cells.withColumn("quota", F.col("quota") - before)
             .withColumn("take", F.when(F.col("quota") >= F.col("n"), 1).when(F.col("quota") <= 0, 0)))
    if key != "part":
        cells = parts.drop("n").join(cells.drop("n"), [*groups, key])
    else:
        cells = cells.drop("n")
    return written(rows.join(cells, list(dict.fromkeys([*groups, key, "part"]))), "mix-chosen")


def choose(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """``rows`` (key, size, hash, part, row) with ``times``: ``copies``, and one
    more for ``quota`` rows of each key and size, least hashes first. Each level
    decides all cells but one of a group; that one's rows go on to the next."""
    rows = rows.withColumn("bucket", F.shiftrightunsigned("hash", 64 - RANGE_BITS))
    groups, done, facts = ["key", "size"], [], [c for c in quotas.columns if c not in ("key", "size")]
    for key in ("bucket", "hash", "part"):
        decided = _decide(rows, quotas, groups, key)
        done.append(decided.where("take is not null").withColumn("times", F.col("copies") + F.col("take")))
        rows, groups = decided.where("take is null"), [*groups, key]
        quotas = rows.select(*groups, *facts).distinct()
        rows = rows.drop("take", *facts)
    nth = F.row_number().over(Window.partitionBy(*groups).orderBy("row"))
    done.append(decided.where("take is null").withColumn("times", F.col("copies") + (nth <= F.col("quota")).cast("int")))
    out = done[0].drop("take")
    for d in done[1:]:
        out = out.unionByName(d.drop("take"))
    return out


def mix(docs: DataFrame, weights: Sequence[float], share: float, seed: int = 0, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's),
    times (0, 1 or 2) and taken (size * times). ``carry`` names columns of
    ``docs`` to pass on; ``repeated`` gives one row a copy."""
    kept = {f"_carry{i}": c for i, c in enumerate(carry)}
    slim = written(docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), words(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"), F.monotonically_increasing_id().alias("row"),
        *(F.col(c).alias(k) for k, c in kept.items())), "mix-sizes")
    slim = slim.withColumn("part", F.shiftright("row", PART_BITS))
    sizes = written(slim.groupBy("source", "key", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = sizes.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(places(sources, "source"), weights, share).drop("source")
    quotas = written(sizes.drop("source").join(goals, "key").groupBy("place").applyInPandas(
        _fit_source, "key string, size long, source_size long, target double, copies int, quota long"), "mix-quotas")
    return choose(slim, quotas).select("doc_id", "source", "size", "source_size", "target", "times",
                                       (F.col("size") * F.col("times")).alias("taken"),
                                       *(F.col(k).alias(c) for k, c in kept.items()))


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes."""
    return mixed.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
