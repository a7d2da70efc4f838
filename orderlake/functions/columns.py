"""Column expressions shared by the operators. All built-in Spark functions:
they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COLUMN_ALIASES


def safe_cast(c: Column | str, dtype: T.DataType | str) -> Column:
    """Cast that yields NULL on bad input instead of raising (ANSI mode, H18)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(dtype)


def safe_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse a date string, NULL when it does not match ``fmt``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, fmt)


def canonical_alias(df: DataFrame, name: str, aliases: Iterable[str] | None = None) -> DataFrame:
    """Expose ``name`` from whichever of its aliases exist.

    With several present, the first non-NULL value wins per row (rename
    transition). Absent aliases are skipped, so the plan never references a
    missing column. Other alias columns are dropped.
    """
    names = list(aliases or COLUMN_ALIASES.get(name, [name]))
    present = [a for a in names if a in df.columns]
    if not present:
        return df
    if present == [name]:
        return df
    value = F.coalesce(*[F.col(a) for a in present]) if len(present) > 1 else F.col(present[0])
    out = df.withColumn(name, value)
    return out.drop(*[a for a in present if a != name])


# Amounts from here on do not fit the money type and are faults.
AMOUNT_LIMIT = 1e15


def finite_amount(c: Column | str) -> Column:
    """Amount as double; text that does not parse, NaN and infinity are NULL."""
    v = safe_cast(c, T.DoubleType())
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def amount_ok(c: Column | str) -> Column:
    """A finite amount above 0 that fits the money type (never NULL)."""
    v = finite_amount(c)
    return F.coalesce((v > 0) & (v < AMOUNT_LIMIT), F.lit(False))


def amount_fault(c: Column | str) -> Column:
    """Why an amount is rejected; NULL for a good one."""
    v = finite_amount(c)
    return (F.when(v.isNull(), F.lit("unparseable amount"))
             .when(v <= 0, F.lit("non-positive amount"))
             .when(v >= AMOUNT_LIMIT, F.lit("amount out of range")))


def keep_order(order_id: Column, user_id: Column, amount: Column) -> Column:
    """P10: the history keep-rule (keys present, a good amount); never NULL."""
    return order_id.isNotNull() & user_id.isNotNull() & amount_ok(amount)


def reject_order(order_id: Column, user_id: Column, amount: Column) -> Column:
    """Exact complement of ``keep_order``."""
    return ~keep_order(order_id, user_id, amount)


def event_list(c: Column | str) -> Column:
    """Array of event types → sorted comma-separated string."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.sort_array(col), ",")


def exact_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum as decimal(28, scale), widened to 38 digits: it does not depend on the
    order in which partitions are added. NaN, infinity and values beyond 28
    digits count as NULL instead of stopping the query (H18)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.try_cast(T.DecimalType(28, scale)))


def money_sum(c: Column | str) -> Column:
    """``exact_sum`` to cents, as double."""
    return exact_sum(c).cast(T.DoubleType())
