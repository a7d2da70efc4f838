"""Adapters from the driver's TPC-H-style tables to the order lakehouse feeds.

The driver supplies ``orders``, ``events`` and ``customer``; the lakehouse
consumes orders, events and a user-segment dimension. These functions map
every row of those tables (nothing is sampled or capped) and plant the
faults the pipeline must handle: NULL users, non-positive amounts, a
re-transmitted corrected copy of some orders one day later, and repeated
event ids. ``FEED_CTES`` is the same mapping in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: fault-planting rules of the feed mapping ------------------
NULL_USER_MOD, NULL_USER_REM = 200, 7           # user_id NULL
ZERO_AMOUNT_MOD = 97                            # amount 0
NEGATIVE_AMOUNT_MOD = 101                       # amount negated
RESEND_MOD, RESEND_REM = 50, 3                  # corrected copy one day later
REPEAT_EVENT_MOD, REPEAT_EVENT_REM = 100, 1     # event id repeats the previous id
PRIORITY_CURRENCY = [("1-URGENT", "INR"), ("2-HIGH", "USD"), ("3-MEDIUM", "EUR"),
                     ("4-NOT SPECIFIED", "GBP")]
OTHER_CURRENCY = "JPY"
# --- end fixed values ---------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _currency(priority: Column) -> Column:
    expr = None
    for prio, cur in PRIORITY_CURRENCY:
        expr = (F.when(priority == prio, F.lit(cur)) if expr is None
                else expr.when(priority == prio, F.lit(cur)))
    return expr.otherwise(F.lit(OTHER_CURRENCY))


def orders_first_feed(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    """Every order once, as first transmitted (with planted faults).
    ``carry``: extra column expressions over the ``orders`` table."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(*carry,
        key.cast("string").alias("order_id"),
        F.when(key % NULL_USER_MOD == NULL_USER_REM, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(key % ZERO_AMOUNT_MOD == 0, F.lit(0.0))
         .when(key % NEGATIVE_AMOUNT_MOD == 0, -F.col("o_totalprice"))
         .otherwise(F.col("o_totalprice")).alias("amount"),
        _currency(F.col("o_orderpriority")).alias("currency"),
        F.col("o_orderdate").cast("date").alias("process_date"),
    )


def orders_resent_feed(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    """Corrected re-transmissions: same order, amount + 1, one day later."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey") % RESEND_MOD == RESEND_REM).select(*carry,
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.col("o_totalprice") + 1).alias("amount"),
        F.lit("USD").alias("currency"),
        F.date_add(F.col("o_orderdate").cast("date"), 1).alias("process_date"),
    )


def orders_feed(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    """All order versions: first transmissions plus corrections."""
    return orders_first_feed(spark, sf_dir, carry).unionByName(
        orders_resent_feed(spark, sf_dir, carry))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        F.when(eid % REPEAT_EVENT_MOD == REPEAT_EVENT_REM, eid - 1).otherwise(eid)
         .cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        F.col("ts").alias("event_ts"),
    )


def events_dated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the day of the drop they came in (``_batch``)."""
    e = table(spark, sf_dir, "events")
    day = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("event_id") * 13 % 2400).cast("int"))
    return e.select(F.col("user_id").cast("string").alias("user_id"), "event_type", day.alias("_batch"))


def segments_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment dimension as delivered (column still named ``segment``)."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.lower(F.col("c_mktsegment")).alias("segment"),
    )


# Same mapping for the DuckDB oracle (views orders, events, customer).
FEED_CTES = """
orders_first AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderkey % 200 = 7 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
              WHEN o_orderkey % 101 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'INR' WHEN '2-HIGH' THEN 'USD'
              WHEN '3-MEDIUM' THEN 'EUR' WHEN '4-NOT SPECIFIED' THEN 'GBP' ELSE 'JPY' END AS currency,
         CAST(o_orderdate AS DATE) AS process_date
  FROM orders
),
orders_src AS (
  SELECT * FROM orders_first
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_totalprice + 1, 'USD',
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE)
  FROM orders WHERE o_orderkey % 50 = 3
),
events_src AS (
  SELECT CAST(CASE WHEN event_id % 100 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) AS user_id, event_type, ts AS event_ts
  FROM events
),
segments_src AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_mktsegment) AS segment
  FROM customer WHERE c_acctbal > 0
)
"""


# --- fixed values: fault-planting rules of the legacy CSV export -------------
BAD_AMOUNT_MOD, BAD_AMOUNT_TEXT = 89, "n/a"      # amount text that does not parse
BAD_DATE_MOD, BAD_DATE_TEXT = 83, "2O24-13-45"   # date text that does not parse
NAN_AMOUNT_MOD, NAN_AMOUNT_REM = 71, 5           # amount text NaN
HUGE_AMOUNT_MOD, HUGE_AMOUNT_REM, HUGE_AMOUNT_TEXT = 73, 5, "1e17"  # amount beyond the money type
# --- end fixed values ---------------------------------------------------------


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy export of every order version as all-string CSV rows.

    ``date`` is the export folder (``date=YYYY-MM-DD``); the in-file
    ``process_date`` text may be corrupt, as may the amount text.
    """
    rows = orders_feed(spark, sf_dir, carry=(F.lower("o_orderstatus").alias("channel"),
                                             F.col("o_orderpriority").alias("product_sku")))
    key = F.col("order_id").cast("long")
    return rows.select(
        "order_id", "user_id",
        F.when(key % BAD_AMOUNT_MOD == 0, F.lit(BAD_AMOUNT_TEXT))
         .when(key % NAN_AMOUNT_MOD == NAN_AMOUNT_REM, F.lit("NaN"))
         .when(key % HUGE_AMOUNT_MOD == HUGE_AMOUNT_REM, F.lit(HUGE_AMOUNT_TEXT))
         .otherwise(F.col("amount").cast("string")).alias("amount"),
        "currency", "channel", "product_sku",
        F.when(key % BAD_DATE_MOD == 0, F.lit(BAD_DATE_TEXT))
         .otherwise(F.date_format("process_date", "yyyy-MM-dd")).alias("process_date"),
        F.date_format("process_date", "yyyy-MM-dd").alias("date"),
    )


HISTORY_CTES = """
history_src AS (
  SELECT s.order_id, s.user_id,
         CASE WHEN CAST(s.order_id AS BIGINT) % 89 = 0 THEN NULL
              WHEN CAST(s.order_id AS BIGINT) % 71 = 5 THEN NULL
              WHEN CAST(s.order_id AS BIGINT) % 73 = 5 THEN 1e17 ELSE s.amount END AS amount,
         s.currency, lower(o.o_orderstatus) AS channel, o.o_orderpriority AS product_sku,
         CASE WHEN CAST(s.order_id AS BIGINT) % 83 = 0 THEN NULL ELSE s.process_date END AS process_date,
         s.process_date AS date
  FROM orders_src s LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = s.order_id
),
history_clean AS (
  SELECT order_id, user_id, amount, currency, channel, product_sku, process_date FROM history_src
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND amount > 0 AND amount < 1e15
    AND process_date IS NOT NULL
),
history_rejects AS (
  SELECT * FROM history_src
  WHERE NOT (order_id IS NOT NULL AND user_id IS NOT NULL AND COALESCE(amount > 0 AND amount < 1e15, false)
             AND process_date IS NOT NULL)
)
"""
