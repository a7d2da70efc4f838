"""Skew-aware left equi-joins of a probe side with many-to-one lookups.

When a lookup is small enough (checked by the caller) it is broadcast.
Otherwise the join is a shuffle join, and a key that holds a large share of
the probe side would land in one task. AQE's skew join does not help when
the lookup is an aggregate over its own shuffle (the events summary), so
hot keys take another way, decided once for all lookups:

* hot keys come from a sample of the raw probe rows: keys with more than one
  shuffle partition's share of the sample. So there are fewer of them than
  shuffle partitions, whatever the data size. The list is written once, every
  use reads the same rows;
* probe rows of a hot key (and of a NULL key, which matches nothing) are dealt
  over all partitions by a row hash in the shuffle join, and take their lookup
  values from a broadcast copy of just the hot keys' lookup rows;
* where those are too many to broadcast (a lookup by day and user has several
  rows for a hot user), the hot keys' lookup rows are replicated over the salts
  that their probe rows are dealt over, and meet them in the shuffle join.

The probe side is evaluated once. The result is exact for any key list: it only
decides which way a key takes, never whether its rows are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

HOT_KEY_SAMPLE = 0.01
# Lookup rows of hot keys that may be broadcast; beyond it they are replicated.
HOT_LOOKUP_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, fraction: float = HOT_KEY_SAMPLE, partitions: int | None = None,
             seed: int = 17, path: str | None = None) -> DataFrame:
    """Keys with over 1 / ``partitions`` of the sampled rows (default: the
    shuffle partitions), written once; fewer than ``partitions`` rows."""
    spark = rows.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sampled = rows.select(key)
    if fraction < 1.0:
        sampled = sampled.sample(withReplacement=False, fraction=fraction, seed=seed)
    counts = sampled.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    path = path or scratch_dir(spark, "hot-keys")
    # one row per sampled key at most; the total is a window-free second pass over these counts
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col(key).isNotNull() & (F.col("_n") > max(1.0, total / partitions))).select(key)


def _salts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(probe: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``probe`` with ``_hot`` and a salt ``_deal``: by row hash from 1 for hot
    and NULL keys, 0 for all others."""
    mark = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    own = F.pmod(F.xxhash64(*[F.col(c) for c in probe.columns]), F.lit(_salts(probe.sparkSession))) + 1
    return probe.join(mark, key, "left").withColumn(
        "_deal", F.when(F.col("_hot") | F.col(key).isNull(), own).otherwise(F.lit(0).cast("long")))


def replicated(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``lookup`` with ``_deal``: rows of hot keys once for each salt."""
    mark = F.broadcast(hot.select(key).withColumn("_is_hot", F.lit(True)))
    every = F.sequence(F.lit(1).cast("long"), F.lit(_salts(lookup.sparkSession)).cast("long"))
    return lookup.join(mark, key, "left").withColumn(
        "_deal", F.explode(F.when(F.col("_is_hot"), every).otherwise(F.array(F.lit(0).cast("long"))))).drop("_is_hot")


def left_lookup_joins(probe: DataFrame, lookups: Sequence[tuple], key: str,
                      hot: DataFrame | None = None, hot_rows: int = HOT_LOOKUP_ROWS) -> DataFrame:
    """``probe ⟕ lookup_1 ⟕ … ⟕ lookup_n``; each lookup is (frame, may be
    broadcast) or (frame, may be broadcast, join columns), ``key`` by default,
    and must be unique per join columns. ``hot``: a written key list of
    ``hot_keys``; None leaves skew to AQE. Up to ``hot_rows`` lookup rows of hot
    keys are broadcast, more are replicated over the salts."""
    spread = hot is not None and not all(x[1] for x in lookups)
    out = dealt(probe, key, hot) if spread else probe
    for lookup, small, *rest in lookups:
        on = list(rest[0]) if rest else [key]
        if small:
            out = out.join(F.broadcast(lookup), on, "left")
            continue
        if not spread:
            out = out.join(lookup, on, "left")
            continue
        values = [c for c in lookup.columns if c not in on]
        few = lookup.join(F.broadcast(hot), key, "left_semi")
        if few.limit(hot_rows + 1).count() > hot_rows:
            out = out.join(replicated(lookup, key, hot), [*on, "_deal"], "left")
            continue
        few = F.broadcast(few.withColumnsRenamed({c: f"_h_{c}" for c in values}))
        cold = lookup.withColumn("_deal", F.lit(0).cast("long")).withColumnsRenamed({c: f"_c_{c}" for c in values})
        out = out.join(few, on, "left").join(cold, [*on, "_deal"], "left")
        out = out.withColumns({c: F.coalesce(f"_h_{c}", f"_c_{c}") for c in values}).drop(
            *[f"_h_{c}" for c in values], *[f"_c_{c}" for c in values])
    return out.drop("_hot", "_deal") if spread else out


def left_lookup_join(probe: DataFrame, lookup: DataFrame, key: str, broadcast_lookup: bool,
                     hot: DataFrame | None = None) -> DataFrame:
    """Single-lookup form of ``left_lookup_joins``."""
    return left_lookup_joins(probe, [(lookup, broadcast_lookup)], key, hot)
