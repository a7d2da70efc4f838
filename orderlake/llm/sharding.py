"""Sharding by extendible hashing under a byte limit.

A row's bucket is given by the leading bits of a 60-bit hash of its key. The
directory starts with one bucket; a bucket over the byte limit splits on the
next bit, others stay, until every shard fits. Which buckets split is found
from the other end: the bytes of the finest cells are added up (a hot key is
summed before it moves) and siblings are joined bit by bit; where the joined
bucket is over the limit, it has split and its fitting halves are shards. Bytes
only grow towards the root, so no bucket above is needed for them, and every
bit costs half of the bit below. One shuffle serves twelve bits.

Equal keys (repeated rows) share all 60 bits. Then the split goes on over the
bits of the row's own number in the written table, so even a key that fills a
shard many times over splits. A row larger than the limit is a shard of its
own at full depth.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import fresh, written

KEY_BITS = 60
ROW_BITS = 60
#: Bits joined after one shuffle; a page is at most 4,096 cells.
PAGE_BITS = 12
#: Directories up to this many cells are broadcast (24 bytes a cell).
BROADCAST_CELLS = 200_000


def key_hash(key: Column) -> Column:
    """60 bits of the key's md5; a null key hashes like the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    """The first ``depth`` bits of (h, r) as a text of hex digits and bits."""
    if depth <= KEY_BITS:
        return F.concat(F.lit("k"), F.shiftright("h", KEY_BITS - depth).cast("string"))
    return F.concat(F.lit("r"), F.col("h").cast("string"), F.lit("."),
                    F.shiftright("r", KEY_BITS + ROW_BITS - depth).cast("string"))


def _cells(rows: DataFrame, high: int) -> DataFrame:
    """(g, p, bytes) of the cells at a depth: p are the leading bits of the key
    hash, or beyond its bits g is that hash and p the leading row bits."""
    by_row = high > KEY_BITS
    g = F.col("h") if by_row else F.lit(0).cast("long")
    p = F.shiftright("r", KEY_BITS + ROW_BITS - high) if by_row else F.shiftright("h", KEY_BITS - high)
    return rows.groupBy(g.alias("g"), p.alias("p")).agg(F.sum("size").alias("bytes"))


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(g, depth, p) of the shards that the cells of depth ``high`` join to,
    between that depth and ``low``; every bucket at ``low`` is over the limit
    unless it is the root. At the last depth all cells are shards."""
    fits = F.col("bytes") <= limit
    nodes = cells.withColumn("leaves", F.array().cast("array<struct<depth:int,p:bigint>>"))
    found = []
    for depth in range(high, low, -PAGE_BITS):
        top = max(low, depth - PAGE_BITS)
        nodes = nodes.withColumn("page", F.shiftright("p", depth - top)).repartition("g", "page")
        for d in range(depth, top, -1):
            whole = F.lit(True) if d == KEY_BITS + ROW_BITS else fits
            half = F.when(whole, F.struct(F.lit(d).alias("depth"), F.col("p").alias("p")))
            nodes = nodes.withColumn("half", half).groupBy("g", "page", F.shiftright("p", 1).alias("p")).agg(
                F.sum("bytes").alias("bytes"), F.flatten(F.collect_list("leaves")).alias("leaves"), F.collect_list("half").alias("halves"))
            nodes = nodes.withColumn("leaves", F.when(fits, F.col("leaves")).otherwise(F.concat("leaves", "halves"))).drop("halves")
        nodes = written(nodes.drop("page"), "shard-buckets")
        found.append(nodes.select("g", F.explode("leaves").alias("leaf")).select("g", "leaf.depth", "leaf.p"))
        nodes = nodes.withColumn("leaves", F.array().cast("array<struct<depth:int,p:bigint>>"))
    if low == 0:
        found.append(nodes.where(fits).select("g", F.lit(0).alias("depth"), "p"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _directory(cells: DataFrame, leaves: DataFrame, high: int) -> DataFrame:
    """cell (as ``_prefix`` names it) and its shard (depth, prefix); cells of no
    shard are left out. Depths that no shard has are not looked up."""
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())      # at most 121
    base = KEY_BITS if high > KEY_BITS else 0
    name = F.concat(F.lit("r"), F.col("g").cast("string"), F.lit(".")) if base else F.lit("k")
    up = [F.struct(F.lit(d).alias("depth"), F.shiftright("p", high - d).alias("up")) for d in depths]
    if not up:
        return cells.where(F.lit(False)).select(name.alias("cell"), F.struct(F.lit(0).alias("depth"), name.alias("prefix")).alias("leaf"))
    wide = cells.select("g", "p", F.explode(F.array(*up)).alias("e")).select("g", "p", "e.depth", "e.up")
    return wide.join(leaves.withColumnRenamed("p", "up"), ["g", "depth", "up"]).select(
        F.concat(name, F.col("p").cast("string")).alias("cell"),
        F.struct("depth", F.concat(name, F.col("up").cast("string")).alias("prefix")).alias("leaf"))


def assign(docs: DataFrame, key: Column, size: Column, limit: int, step: int = 12, cells_per_shard: int = 8,
           shard: str = "shard", depth: str = "depth") -> DataFrame:
    """``docs`` with the columns ``shard`` (its hash prefix, as text) and
    ``depth`` (its bits); every shard's sizes add up to at most ``limit``,
    unless it is one single larger row.

    Sizes are not negative, a null one counts 0. Null keys hash like the empty text. The rows are
    written to the shared folder first, so their numbers stay. All columns
    stay; take names that the table does not have. An empty table stays empty.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    h, r, s = (fresh(docs, x) for x in ("_h", "_r", "_size"))
    fixed = written(docs.withColumn(h, key_hash(key)).withColumn(
        s, F.coalesce(size.cast("long"), F.lit(0).cast("long"))), "shard-rows")
    # consecutive row numbers differ in their low bits, so they are hashed; the bits decide nothing but a split
    fixed = fixed.withColumn(r, F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - ROW_BITS))
    fixed = written(fixed, "shard-numbered")
    rows = fixed.select(F.col(h).alias("h"), F.col(r).alias("r"), F.col(s).alias("size"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    out, open_ = fixed, rows
    maps: list[tuple[int, DataFrame]] = []
    low = 0
    high = min(KEY_BITS, max(4, math.ceil(math.log2(max(2.0, cells_per_shard * total / limit)))))
    while True:
        cells = written(_cells(open_, high), "shard-cells")
        last = high == KEY_BITS + ROW_BITS
        chosen = written(_directory(cells, _leaves(cells, low, high, limit), high), "shard-directory")
        maps.append((high, chosen))
        if last:
            break
        rest = open_.withColumn("cell", _prefix(high)).join(_sized(chosen.select("cell")), "cell", "left_anti").drop("cell")
        rest = written(rest, "shard-oversized")
        if rest.isEmpty():
            break
        open_, low = rest, high
        high = min(high + step, KEY_BITS if high < KEY_BITS else KEY_BITS + ROW_BITS)
    found = []
    for i, (bits, chosen) in enumerate(maps):
        cell, leaf = f"_cell{i}", f"_leaf{i}"
        names = out.withColumnsRenamed({h: "h", r: "r"}).withColumn(cell, _prefix(bits)).withColumnsRenamed({"h": h, "r": r})
        out = names.join(_sized(chosen.select(F.col("cell").alias(cell), F.col("leaf").alias(leaf))), cell, "left").drop(cell)
        found.append(leaf)
    leaf = F.coalesce(*[F.col(x) for x in found])
    return out.withColumn(shard, F.concat(leaf["depth"].cast("string"), F.lit(":"), F.substring(leaf["prefix"], 2, 100))
                          ).withColumn(depth, leaf["depth"]).drop(h, r, s, *found)


def _sized(directory: DataFrame) -> DataFrame:
    """Broadcast below a checked size; a shuffle join beyond it."""
    return F.broadcast(directory) if directory.count() <= BROADCAST_CELLS else directory
