"""Contracts, approved column lists and fixed business values.

Everything here is a parameter default: callers may pass their own lists
(an approved new column such as ``promo_code`` is added by the caller, not
by editing code paths).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's behaviour) -------------------
# Landing contracts: required columns per file type.
REQUIRED_COLUMNS = {
    "orders": ["order_id", "user_id", "amount", "currency", "process_date"],
    "events": ["event_id", "user_id", "event_type", "timestamp"],
    "user_segments": ["user_id", "user_segment", "segment_date"],
}
# Optional contract columns (not checked for presence).
OPTIONAL_COLUMNS = {"orders": ["channel", "product_sku"], "events": [], "user_segments": []}
# Physical Parquet types named by the landing contract (used when check_types=True).
CONTRACT_PARQUET_TYPES = {
    "orders": {"order_id": "BYTE_ARRAY", "user_id": "BYTE_ARRAY", "amount": "DOUBLE",
               "currency": "BYTE_ARRAY", "process_date": "INT32",
               "channel": "BYTE_ARRAY", "product_sku": "BYTE_ARRAY"},
    "events": {"event_id": "BYTE_ARRAY", "user_id": "BYTE_ARRAY",
               "event_type": "BYTE_ARRAY", "timestamp": "BYTE_ARRAY"},
    "user_segments": {"user_id": "BYTE_ARRAY", "user_segment": "BYTE_ARRAY",
                      "segment_date": "INT32"},
}
# Path-substring → file type, checked in this order; first hit wins.
FILE_TYPE_RULES = [("orders/", "orders"), ("events/", "events"),
                   ("segments/", "user_segments"), ("user_segments/", "user_segments")]
# Columns written by the daily enrichment, in output order.
APPROVED_OUTPUT_COLUMNS = ["order_id", "user_id", "amount", "currency", "process_date",
                           "user_segment", "event_count", "event_types"]
# Currencies the gold model accepts (checked before upper-casing).
ACCEPTED_CURRENCIES = ["INR", "USD", "EUR", "GBP"]
UNCLASSIFIED_SEGMENT = "unclassified"
ROW_EXPLOSION_THRESHOLD = 1.10
AMOUNT_TOLERANCE = 0.01
FRESHNESS_WARN_HOURS = 25
FRESHNESS_ERROR_HOURS = 30
# Column name aliases accepted during a rename transition (new name first is
# not assumed: the canonical name is the key).
COLUMN_ALIASES = {
    "user_segment": ["user_segment", "segment"],
    "event_type": ["event_type", "action_type"],
    "timestamp": ["timestamp", "event_time"],
}
# --- end fixed values -------------------------------------------------------

PROCESSED_TYPES = {
    "order_id": T.StringType(),
    "user_id": T.StringType(),
    "amount": T.DoubleType(),
    "currency": T.StringType(),
    "process_date": T.DateType(),
    "user_segment": T.StringType(),
    "event_count": T.IntegerType(),
    "event_types": T.ArrayType(T.StringType()),
}

HISTORY_COLUMNS = ["order_id", "user_id", "amount", "currency", "channel",
                   "product_sku", "process_date"]
HISTORY_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS])
HISTORY_TYPES = {
    "order_id": T.StringType(), "user_id": T.StringType(), "amount": T.DoubleType(),
    "currency": T.StringType(), "channel": T.StringType(), "product_sku": T.StringType(),
}

# Typed contract of the gold table (model preset).
GOLD_CONTRACT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("process_date", T.DateType()),
    T.StructField("user_segment", T.StringType()),
    T.StructField("event_count", T.IntegerType()),
    T.StructField("event_types", T.ArrayType(T.StringType())),
    T.StructField("updated_at", T.TimestampType()),
])

# Gold not_null columns (data tests).
GOLD_NOT_NULL = ["order_id", "user_id", "amount", "currency", "process_date",
                 "user_segment", "event_count", "updated_at"]

# Landing registry, seen by content: one row per MD5 (K6).
REGISTRY_SCHEMA = T.StructType([
    T.StructField("md5", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("first_seen_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
])
# As it is stored: every version of every path whose bytes were read.
VERSIONS_SCHEMA = T.StructType([
    *REGISTRY_SCHEMA.fields,
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])
