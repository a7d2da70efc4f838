"""Quality gates and data tests: Q1, Q8–Q13, Q16.

Each check returns a small result DataFrame (or a result object) computed
in one pass; ``enforce`` turns a failing result into an exception. No check
collects data rows, only counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (ACCEPTED_CURRENCIES, FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS,
                       GOLD_CONTRACT, GOLD_NOT_NULL, ROW_EXPLOSION_THRESHOLD)


class GateError(RuntimeError):
    """A gate failed; the run must not publish."""


# ------------------------------------------------------------------ Q1 ----
@dataclass(frozen=True)
class RowGate:
    rows_in: int
    rows_out: int
    threshold: float = ROW_EXPLOSION_THRESHOLD

    @property
    def ratio(self) -> float:
        return self.rows_out / self.rows_in if self.rows_in > 0 else 0.0

    @property
    def passed(self) -> bool:
        return self.ratio <= self.threshold

    def enforce(self) -> RowGate:
        if not self.passed:
            raise GateError(
                f"row explosion: input {self.rows_in:,}, output {self.rows_out:,}, "
                f"ratio {self.ratio:.3f} > threshold {self.threshold}")
        return self


def row_gate_frame(inputs: DataFrame, outputs: DataFrame,
                   threshold: float = ROW_EXPLOSION_THRESHOLD) -> DataFrame:
    """Q1 as a one-row DataFrame (one job: both sides tagged, one aggregate)."""
    tagged = (inputs.select(F.lit(1).alias("_i"), F.lit(0).alias("_o"))
              .unionByName(outputs.select(F.lit(0).alias("_i"), F.lit(1).alias("_o"))))
    agg = tagged.agg(F.sum("_i").cast("long").alias("input_rows"),
                     F.sum("_o").cast("long").alias("output_rows"))
    ratio = F.when(F.col("input_rows") > 0,
                   F.col("output_rows") / F.col("input_rows")).otherwise(F.lit(0.0))
    return agg.select(
        F.coalesce("input_rows", F.lit(0)).alias("input_rows"),
        F.coalesce("output_rows", F.lit(0)).alias("output_rows"),
        F.round(ratio, 6).alias("ratio"),
        F.when(ratio > threshold, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))


# ------------------------------------------------------------- Q8–Q11 ----
def data_tests(df: DataFrame, not_null: Sequence[str] = GOLD_NOT_NULL,
               unique: Sequence[str] = ("order_id",),
               positive: Sequence[str] = ("amount",),
               non_negative: Sequence[str] = ("event_count",),
               accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per test: ``test_name``, ``failures`` (schema-test semantics).

    not_null / expression tests count failing rows (an expression that is
    NULL is not a failure); unique counts duplicated keys; accepted_values
    counts distinct non-accepted values. The row tests and the first
    accepted-values test are one map-side aggregate; each unique test is one
    pass over its own column alone, so nothing else is shuffled by a
    near-unique key.
    """
    accepted = {"currency": ACCEPTED_CURRENCIES} if accepted is None else accepted
    cols = set(df.columns)
    tests: list[tuple[str, Column]] = []
    for c in not_null:
        if c in cols:
            tests.append((f"not_null_{c}", F.count_if(F.col(c).isNull())))
    for c in positive:
        if c in cols:
            tests.append((f"expression_is_true_{c}_gt_0", F.count_if(~(F.col(c) > 0))))
    for c in non_negative:
        if c in cols:
            tests.append((f"expression_is_true_{c}_ge_0", F.count_if(~(F.col(c) >= 0))))
    bad = [(c, F.count_distinct(F.when(~F.col(c).isin(list(v)), F.col(c)))) for c, v in accepted.items() if c in cols]
    parts = []
    # two distinct aggregates in one pass would expand every row, so one each
    groups = [tests + [(f"accepted_values_{c}", e)] for c, e in bad[:1]] or ([tests] if tests else [])
    groups += [[(f"accepted_values_{c}", e)] for c, e in bad[1:]]
    for group in groups:
        wide = df.agg(*[e.alias(f"t{i}") for i, (_, e) in enumerate(group)])
        stack = ", ".join(f"'{n}', t{i}" for i, (n, _) in enumerate(group))
        parts.append(wide.selectExpr(f"stack({len(group)}, {stack}) AS (test_name, failures)"))
    for c in unique:
        if c in cols:
            dup = (df.where(F.col(c).isNotNull()).groupBy(c).count()
                     .agg(F.count_if(F.col("count") > 1).alias("failures")))
            parts.append(dup.select(F.lit(f"unique_{c}").alias("test_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test_name", F.col("failures").cast("long").alias("failures"))


def cross_day_duplicates(table: DataFrame, merged: DataFrame, key: str = "order_id",
                         partition_col: str = "process_date") -> int:
    """Q9 over old and new days: keys of ``merged`` that also lie in days of
    ``table`` that ``merged`` replaces nothing of. One column of the table is
    read; keys are joined, none collected."""
    days = merged.select(partition_col).distinct()
    old = table.select(key, partition_col).join(F.broadcast(days), partition_col, "left_anti").select(key)
    return old.join(merged.select(key).distinct(), key, "left_semi").distinct().count()


def enforce_tests(results: DataFrame) -> None:
    failing = results.where(F.col("failures") > 0).collect()
    if failing:
        raise GateError("data tests failed: " + ", ".join(
            f"{r['test_name']}={r['failures']}" for r in failing))


# ---------------------------------------------------------------- Q12 ----
def contract_check(df: DataFrame, contract: T.StructType = GOLD_CONTRACT) -> list[dict]:
    """Q12: compare the frame's schema with the typed contract (names and
    types); extra columns are allowed (additive evolution)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for f in contract.fields:
        got = actual.get(f.name)
        rows.append({"column_name": f.name, "expected_type": f.dataType.simpleString(),
                     "actual_type": got.simpleString() if got is not None else None,
                     "ok": got is not None and got == f.dataType})
    return rows


def contract_frame(df: DataFrame, contract: T.StructType = GOLD_CONTRACT) -> DataFrame:
    spark = df.sparkSession
    schema = "column_name string, expected_type string, actual_type string, ok boolean"
    return spark.createDataFrame(contract_check(df, contract), schema)


def contract_counts(df: DataFrame, contract: T.StructType = GOLD_CONTRACT) -> DataFrame:
    """Q12 with the rows behind it: each contract column's verdict and its
    non-NULL rows (0 for an absent column), in one aggregate over the table."""
    rows = contract_check(df, contract)
    counts = df.agg(*[(F.count(r["column_name"]) if r["actual_type"] else F.lit(0).cast("long")).alias(f"n{i}")
                      for i, r in enumerate(rows)])
    def text(v):
        return "CAST(NULL AS STRING)" if v is None else f"'{v}'"
    stack = ", ".join(f"'{r['column_name']}', {text(r['expected_type'])}, {text(r['actual_type'])}, "
                      f"{str(r['ok']).lower()}, n{i}" for i, r in enumerate(rows))
    return counts.selectExpr(f"stack({len(rows)}, {stack}) AS (column_name, expected_type, actual_type, ok, non_null_rows)")


# ---------------------------------------------------------------- Q13 ----
def freshness(df: DataFrame, as_of: datetime | str, loaded_at: str = "process_date",
              warn_hours: float = FRESHNESS_WARN_HOURS,
              error_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Q13: hours between the newest ``loaded_at`` and ``as_of``."""
    # wall-clock (time-zone free) timestamps: the lag never depends on the
    # session time zone or a daylight-saving change
    as_of_ts = F.lit(str(as_of)).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    lag = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of_ts) / 3600.0
    return newest.select(
        "max_loaded_at",
        F.round(lag, 2).alias("hours_since"),
        F.when(F.col("max_loaded_at").isNull() | (lag > error_hours), F.lit("error"))
         .when(lag > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


# ---------------------------------------------------------------- Q16 ----
def duplicate_keys(df: DataFrame, key: str | Sequence[str] = "user_id") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") > 1))


def assert_unique_keys(df: DataFrame, key: str | Sequence[str] = "user_id") -> None:
    n = duplicate_keys(df, key).limit(1).count()
    if n:
        raise GateError(f"dimension has duplicate keys on {key}")
