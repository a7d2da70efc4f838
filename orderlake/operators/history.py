"""Legacy CSV history (P8–P11) and the reconciliation audit (A3–A5, Q2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (amount_fault, exact_sum, finite_amount, keep_order, reject_order,
                                 safe_cast, safe_date)
from ..schemas import AMOUNT_TOLERANCE, HISTORY_TYPES


def normalize_history(raw: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Project the contract columns with NULL-on-error casts; any
    partition column discovered from the folder layout is kept."""
    cols = [(finite_amount(c) if c == "amount" else safe_cast(c, t)).alias(c)
            for c, t in HISTORY_TYPES.items()]
    extra = [c for c in raw.columns if c not in HISTORY_TYPES and c != "process_date"]
    return raw.select(*cols, safe_date("process_date", date_format).alias("process_date"), *extra)


def history_keep(df: DataFrame, reject_bad_dates: bool = True) -> Column:
    keep = keep_order(F.col("order_id"), F.col("user_id"), F.col("amount"))
    if reject_bad_dates:
        keep = keep & F.col("process_date").isNotNull()
    return keep


def split_history(normalized: DataFrame, reject_bad_dates: bool = True) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rejects, exact complements of each other.

    H9 fix (default): a row whose date does not parse is rejected instead of
    landing in the ``__HIVE_DEFAULT_PARTITION__`` folder."""
    keep = history_keep(normalized, reject_bad_dates)
    reason = (F.when(F.col("order_id").isNull(), F.lit("null order_id"))
               .when(F.col("user_id").isNull(), F.lit("null user_id"))
               .otherwise(F.coalesce(amount_fault("amount"), F.lit("unparseable process_date"))))
    clean = normalized.where(keep).select(*normalized.columns)
    rejects = normalized.where(~keep).withColumn("reject_reason", reason)
    return clean, rejects


def audit_reject(raw_amount: Column, reject_bad_dates: bool = True) -> Column:
    """The audit's reject rule on raw CSV strings (P11 plus the H9 date rule)."""
    rej = reject_order(F.col("order_id"), F.col("user_id"), raw_amount)
    if reject_bad_dates:
        rej = rej | safe_date("process_date").isNull()
    return rej


def reconciliation_report(source_raw: DataFrame, target: DataFrame, execution_date: str,
                          audited_at: datetime | str | None = None, deduplicated: int = 0,
                          reject_bad_dates: bool = True,
                          tolerance: float = AMOUNT_TOLERANCE) -> DataFrame:
    """A3–A5 + Q2 in one pass: source rows, rejected rows and target rows are
    tagged, unioned and aggregated once (no cross join of one-row results).

    Rule: target rows must equal source − rejected − ``deduplicated`` (H19);
    then the amount difference must be within ``tolerance``. The first
    failing rule names the status message.
    """
    src = source_raw.select(F.lit("s").alias("_side"), finite_amount("amount").alias("_amt"),
                            audit_reject(F.col("amount"), reject_bad_dates).alias("_rej"))
    tgt = target.select(F.lit("t").alias("_side"), F.col("amount").cast("double").alias("_amt"),
                        F.lit(False).alias("_rej"))
    is_s, is_t = F.col("_side") == "s", F.col("_side") == "t"
    rejs = is_s & F.col("_rej")

    def total(rows: Column) -> Column:
        return F.coalesce(exact_sum(F.when(rows, F.col("_amt")), scale=6), F.lit(0).cast("decimal(38,6)"))

    # the totals stay decimals until they are compared: a huge rejected amount
    # must not swallow the cents of the others
    m = src.unionByName(tgt).agg(
        F.count_if(is_s).alias("source_row_count"), total(is_s).alias("source_sum_amount"),
        F.count_if(rejs).alias("filtered_row_count"), total(rejs).alias("filtered_sum_amount"),
        F.count_if(is_t).alias("target_row_count"), total(is_t).alias("target_sum_amount"),
    )
    exp_rows = F.col("source_row_count") - F.col("filtered_row_count") - F.lit(int(deduplicated))
    exp_sum = F.col("source_sum_amount") - F.col("filtered_sum_amount")
    row_diff = F.col("target_row_count") - exp_rows
    amt_diff = F.abs(F.col("target_sum_amount") - exp_sum)
    m = m.withColumns({"_exp_rows": exp_rows, "_exp_sum": exp_sum.cast("double"),
                       "discrepancy_rows": row_diff, "_amt_diff": amt_diff.cast("double")})
    m = m.withColumns({c: F.col(c).cast("double") for c in (
        "source_sum_amount", "filtered_sum_amount", "target_sum_amount")})
    status = F.when((F.col("discrepancy_rows") != 0) | (F.col("_amt_diff") > tolerance),
                    F.lit("MISMATCH")).otherwise(F.lit("SUCCESS"))
    # fixed values: the three message texts are part of the report's contract
    message = (F.when(F.col("discrepancy_rows") != 0, F.concat(
                    F.lit("Row count discrepancy: expected "), F.format_number("_exp_rows", 0),
                    F.lit(", but got "), F.format_number("target_row_count", 0), F.lit(".")))
                .when(F.col("_amt_diff") > tolerance, F.concat(
                    F.lit("Sum of amount discrepancy: expected "), F.format_number("_exp_sum", 2),
                    F.lit(", but got "), F.format_number("target_sum_amount", 2), F.lit(".")))
                .otherwise(F.lit("All counts and amounts reconciled perfectly.")))
    out = m.select(
        F.lit(execution_date).alias("execution_date"),
        status.alias("status"),
        "source_row_count",
        F.round("source_sum_amount", 2).alias("source_sum_amount"),
        "filtered_row_count",
        F.round("filtered_sum_amount", 2).alias("filtered_sum_amount"),
        "target_row_count",
        F.round("target_sum_amount", 2).alias("target_sum_amount"),
        "discrepancy_rows",
        F.round("_amt_diff", 4).alias("discrepancy_amount"),
        message.alias("message"),
    )
    if audited_at is not None:
        out = out.withColumn("audited_at", F.lit(str(audited_at)).cast("timestamp"))
    return out


def report_doc_id(execution_date: str) -> str:
    """K8 document id: '/' → '_', '*' → 'all'."""
    return execution_date.replace("/", "_").replace("*", "all")
