"""The segment of a user as of a date, from several drops of the dimension.

A drop is the whole dimension from its date until the next drop's. Per user the
drops become validity intervals, so a date finds at most one of them: a replay
of an old day gives what the day gave, whatever was dropped since.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .gates import GateError
from .joins import dealt, hot_keys, replicated

FROM, UNTIL = "valid_from", "valid_until"


def segment_intervals(drops: Sequence[tuple[str, DataFrame]], key: str = "user_id", value: str = "user_segment") -> DataFrame:
    """key, value, valid_from, valid_until (exclusive; null: still valid) of
    dated drops in order. A value that several drops repeat one after the other
    is one interval, so a user has as many as changes. A user who is missing
    from a drop has no segment while it holds. Rows without a user don't count;
    a user is once in a drop (``check_unique``)."""
    ends = [d for d, _ in drops[1:]] + [None]
    every = reduce(DataFrame.unionByName, (
        df.select(key, value, F.lit(n).alias("_n"), F.lit(d).cast("date").alias(FROM), F.lit(end).cast("date").alias(UNTIL))
        for n, ((d, df), end) in enumerate(zip(drops, ends, strict=True))))
    by_user = Window.partitionBy(key).orderBy("_n")
    before = F.lag(F.struct("_n", value)).over(by_user)
    rows = every.where(F.col(key).isNotNull()).withColumn("_before", before)
    goes_on = (F.col("_before._n") == F.col("_n") - 1) & F.col(f"_before.{value}").eqNullSafe(F.col(value))
    # gaps and islands: an interval is a run of drops that tell the same
    island = F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(by_user)
    return (rows.withColumn("_island", island).groupBy(key, "_island").agg(
        F.first(value).alias(value), F.min(FROM).alias(FROM), F.max_by(UNTIL, "_n").alias(UNTIL)).drop("_island"))


def check_unique(drops: Sequence[tuple[str, DataFrame]], key: str = "user_id") -> None:
    """Q16 over all drops in one job: a user once in each."""
    every = reduce(DataFrame.unionByName, (df.select(key, F.lit(d).alias("_d")) for d, df in drops))
    twice = every.where(F.col(key).isNotNull()).groupBy(key, "_d").count().where("count > 1").count()
    if twice:
        raise GateError(f"segment dimension has {twice} duplicated {key} keys")


def as_of_join(rows: DataFrame, intervals: DataFrame, date_col: str, key: str = "user_id",
               hot: DataFrame | None = None, **hot_opts) -> DataFrame:
    """``rows`` (all of them, once) with the interval's value on ``date_col``,
    null where none holds. An equi-join on the user, with the interval as its
    condition: a user has few intervals, so few pairs are looked at. Rows of a
    user with over a shuffle partition's share (``joins.hot_keys``) are dealt
    over all partitions, and that user's intervals replicated to them."""
    hot = hot_keys(rows, key, **hot_opts) if hot is None else hot
    values = [c for c in intervals.columns if c not in (key, FROM, UNTIL)]
    left, right = dealt(rows, key, hot).alias("l"), replicated(intervals, key, hot).alias("r")
    day = F.col(f"l.{date_col}").cast("date")
    holds = ((F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l._deal") == F.col("r._deal")) & (F.col(f"r.{FROM}") <= day)
             & (F.col(f"r.{UNTIL}").isNull() | (F.col(f"r.{UNTIL}") > day)))
    return left.join(right, holds, "left").select(*(F.col(f"l.{c}") for c in rows.columns), *(F.col(f"r.{c}") for c in values))
