"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus the DuckDB
oracle SQL for each. Every query reads the driver tables in full (through the
feed adapters) so its work grows with the data.

Arrays are reported as sorted comma strings and money totals as exact
decimal sums cast to double, so both engines produce identical values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import event_list
from ..operators import enrichment as E
from ..operators.joins import left_lookup_join
from ..sources import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_ctes(body: str, extra: str = "") -> str:
    ctes = feeds.FEED_CTES.strip()
    if extra:
        ctes = ctes + ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}"


# ---------------------------------------------------------------- slice 1 --
def enrich_ctes(src: str = "orders_src", p: str = "") -> str:
    """Oracle CTE chain of the daily enrichment over the order feed ``src``;
    ``p`` prefixes the CTE names so two chains can coexist."""
    return f"""
{p}orders_latest AS (
  SELECT order_id, user_id, amount, currency, process_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY process_date DESC) AS rn
    FROM {src}) WHERE rn = 1
),
{p}events_agg AS (
  SELECT user_id, count(event_type) AS event_count,
         string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
  FROM events_src GROUP BY user_id
),
{p}segments_dim AS (SELECT user_id, segment AS user_segment FROM segments_src),
{p}enriched AS (
  SELECT o.order_id, o.user_id, o.amount, o.currency, o.process_date,
         COALESCE(s.user_segment, 'unclassified') AS user_segment,
         CAST(COALESCE(e.event_count, 0) AS INTEGER) AS event_count,
         e.event_types
  FROM {p}orders_latest o
  LEFT JOIN {p}events_agg e ON o.user_id = e.user_id
  LEFT JOIN {p}segments_dim s ON o.user_id = s.user_id
  WHERE o.amount > 0
),
{p}gold AS (
  SELECT order_id, user_id, ROUND(amount, 2) AS amount, UPPER(currency) AS currency,
         process_date, COALESCE(user_segment, 'unclassified') AS user_segment,
         COALESCE(event_count, 0) AS event_count, event_types
  FROM {p}enriched
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND amount > 0
    AND currency IN ('INR', 'USD', 'EUR', 'GBP')
)
"""


_DEDUP_CTE = enrich_ctes()


def _inputs(spark, sf_dir):
    return (feeds.orders_feed(spark, sf_dir), feeds.events_feed(spark, sf_dir),
            feeds.segments_feed(spark, sf_dir))


def enriched_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events, segments = _inputs(spark, sf_dir)
    _, enriched = E.enrich_daily(orders, events, segments)
    return enriched


def _flat(df: DataFrame) -> DataFrame:
    if "event_types" in df.columns:
        df = df.withColumn("event_types", event_list("event_types"))
    return df


@register("orders_dedup_latest", with_ctes("SELECT * FROM orders_latest", _DEDUP_CTE))
def orders_dedup_latest(spark, sf_dir):
    return E.latest_per_key(feeds.orders_feed(spark, sf_dir), ["order_id"], ["process_date desc"])


@register("events_per_user", with_ctes("SELECT * FROM events_agg", _DEDUP_CTE))
def events_per_user(spark, sf_dir):
    return _flat(E.aggregate_events(feeds.events_feed(spark, sf_dir)))


@register("orders_left_events", with_ctes("""
SELECT o.*, e.event_count, e.event_types
FROM orders_latest o LEFT JOIN events_agg e ON o.user_id = e.user_id""", _DEDUP_CTE))
def orders_left_events(spark, sf_dir):
    orders, events, _ = _inputs(spark, sf_dir)
    deduped = E.latest_per_key(orders)
    agg = E.staged_summary(events)
    small = E.dimension_profile(agg, cols=E.EVENTS_AGG_COLS, check_unique=False).broadcastable()
    return _flat(left_lookup_join(deduped, agg, "user_id", broadcast_lookup=small))


@register("orders_broadcast_segments", with_ctes("""
SELECT o.*, s.user_segment
FROM orders_latest o LEFT JOIN segments_dim s ON o.user_id = s.user_id""", _DEDUP_CTE))
def orders_broadcast_segments(spark, sf_dir):
    orders, _, segments = _inputs(spark, sf_dir)
    dim = segments.withColumnRenamed("segment", "user_segment").select("user_id", "user_segment")
    small = E.dimension_profile(dim).broadcastable()
    return left_lookup_join(E.latest_per_key(orders), dim, "user_id", broadcast_lookup=small)


@register("business_rules", with_ctes("""
SELECT o.order_id, o.user_id, o.amount, o.currency, o.process_date,
       COALESCE(e.event_count, 0) AS event_count, e.event_types,
       COALESCE(s.user_segment, 'unclassified') AS user_segment
FROM orders_latest o
LEFT JOIN events_agg e ON o.user_id = e.user_id
LEFT JOIN segments_dim s ON o.user_id = s.user_id
WHERE o.amount > 0""", _DEDUP_CTE))
def business_rules(spark, sf_dir):
    orders, events, segments = _inputs(spark, sf_dir)
    agg = E.staged_summary(events)
    may = E.broadcast_licence([E.dimension_profile(E.canonical_alias(segments, "user_segment")),
                               E.dimension_profile(agg, cols=E.EVENTS_AGG_COLS, check_unique=False)])
    joined = E.enrich_orders(E.latest_per_key(orders), agg, segments,
                             broadcast_segments=may[0], broadcast_events=may[1])
    return _flat(E.apply_business_rules(joined))


@register("approved_projection", with_ctes("""
SELECT order_id, user_id, amount, currency, process_date FROM orders_src"""))
def approved_projection(spark, sf_dir):
    # Upstream file with extra, unapproved columns: the firewall drops them
    # and skips approved columns the file does not have.
    orders = feeds.orders_feed(spark, sf_dir).withColumns({
        "status": F.lit("open"), "channel_code": F.lit("web")})
    return E.cast_and_select(orders)


@register("enriched_orders", with_ctes("SELECT * FROM enriched", _DEDUP_CTE))
def enriched_orders(spark, sf_dir):
    return _flat(enriched_frame(spark, sf_dir))


@register("naive_join_fanout", with_ctes("""
SELECT count(*) AS naive_rows,
       (SELECT count(*) FROM orders_latest) AS input_rows
FROM orders_latest o
LEFT JOIN events_src e ON o.user_id = e.user_id
LEFT JOIN segments_dim s ON o.user_id = s.user_id""", _DEDUP_CTE))
def naive_join_fanout(spark, sf_dir):
    """J6 without building it: each order would give a row per event of its
    user, or one. The expanding join itself is in the tests."""
    orders, events, _ = _inputs(spark, sf_dir)
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    joined = E.latest_per_key(orders).select("user_id").join(per_user, "user_id", "left")
    return joined.agg(F.sum(F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))).cast("long").alias("naive_rows"),
                      F.count(F.lit(1)).alias("input_rows"))


# ------------------------------------------------------ gold and merge ----
from ..operators import gates as G  # noqa: E402
from ..operators import gold as GD  # noqa: E402
from ..operators import history as H  # noqa: E402
from ..operators import marts as M  # noqa: E402
from ..session import scratch_dir  # noqa: E402
from ..sources.files import read_history_csv, read_processed  # noqa: E402
from . import lakehouse as L  # noqa: E402
from .daily import run_enrichment  # noqa: E402
from .history import run_history  # noqa: E402

GOLD_COLS = ["order_id", "user_id", "amount", "currency", "process_date", "user_segment",
             "event_count", "event_types"]
# A bounded range of the history export.
BACKFILL = ("1994-03-01", "1995-09-30")


def _gold_table(spark, sf_dir):
    """Every loaded day, by the table's own first and last day."""
    root = L.lake(spark, sf_dir).gold
    return M.guarded_read(spark, root, *M.table_days(spark, root))


def _last_days(spark, root, days=0):
    """The gold rows of the latest loaded day and ``days`` before it."""
    latest = date.fromisoformat(M.table_days(spark, root)[1])
    return M.guarded_read(spark, root, latest - timedelta(days=days), latest)


@register("gold_model", with_ctes("SELECT * FROM gold", _DEDUP_CTE))
def gold_model_q(spark, sf_dir):
    return _flat(GD.gold_model(enriched_frame(spark, sf_dir), L.RUN_TS).drop("updated_at"))


@register("gold_model_run_date", with_ctes(f"""
SELECT * REPLACE (DATE '2025-06-01' AS process_date), '{L.RUN_TS}' AS updated_at FROM gold""", _DEDUP_CTE))
def gold_model_run_date(spark, sf_dir):
    """The run date as a literal and the merge time on every row."""
    gold = GD.gold_model(enriched_frame(spark, sf_dir), L.RUN_TS, run_date="2025-06-01")
    return _flat(gold.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")))


@register("approved_new_column", with_ctes("SELECT *, 'P' || order_id AS promo_code FROM enriched", _DEDUP_CTE))
def approved_new_column(spark, sf_dir):
    """A new column passes the firewall once it is on the approved list;
    an unapproved one beside it does not."""
    orders, events, segments = _inputs(spark, sf_dir)
    orders = orders.withColumns({"promo_code": F.concat(F.lit("P"), "order_id"), "internal_note": F.lit("x")})
    return _flat(E.enrich_daily(orders, events, segments,
                                approved=[*E.APPROVED_OUTPUT_COLUMNS, "promo_code"])[1])


@register("gold_merge_first", with_ctes("SELECT * FROM gold", _DEDUP_CTE))
def gold_merge_first(spark, sf_dir):
    return _flat(read_processed(spark, L.lake(spark, sf_dir).gold).select(*GOLD_COLS))


@register("gold_merge_rerun", with_ctes("SELECT * FROM gold", _DEDUP_CTE))
def gold_merge_rerun(spark, sf_dir):
    target = scratch_dir(spark, "gold-rerun")
    src = GD.gold_model(enriched_frame(spark, sf_dir), L.RUN_TS)
    GD.merge_upsert(spark, target, src, run_ts=L.RUN_TS)
    GD.merge_upsert(spark, target, src, run_ts=L.RUN_TS)
    return _flat(read_processed(spark, target).select(*GOLD_COLS))


_PROMO_SQL = "upper(substr(user_segment, 1, 3)) || '10'"


@register("gold_merge_new_column", with_ctes(f"""
SELECT f.*, CAST(NULL AS VARCHAR) AS promo_code FROM f_gold f
WHERE NOT EXISTS (SELECT 1 FROM gold g
                  WHERE g.order_id = f.order_id AND g.process_date = f.process_date)
UNION ALL
SELECT g.*, {_PROMO_SQL} AS promo_code FROM gold g""",
    enrich_ctes("orders_first", "f_") + "," + _DEDUP_CTE))
def gold_merge_new_column(spark, sf_dir):
    """E1 on real batches: first the first transmissions, then the full feed
    (corrections included) carrying a newly approved column."""
    orders, events, segments = _inputs(spark, sf_dir)
    _, first = E.enrich_daily(feeds.orders_first_feed(spark, sf_dir), events, segments)
    _, full = E.enrich_daily(orders, events, segments)
    full = full.withColumn("promo_code", F.concat(
        F.upper(F.substring("user_segment", 1, 3)), F.lit("10")))
    target = scratch_dir(spark, "gold-evolve")
    GD.merge_upsert(spark, target, GD.gold_model(first, L.RUN_TS), run_ts=L.RUN_TS)
    GD.merge_upsert(spark, target, GD.gold_model(full, L.RUN_TS), run_ts=L.RUN_TS)
    return _flat(read_processed(spark, target).select(*GOLD_COLS, "promo_code"))


@register("gold_merge_script_preset", with_ctes("SELECT * FROM enriched", _DEDUP_CTE))
def gold_merge_script_preset(spark, sf_dir):
    target = scratch_dir(spark, "gold-script")
    src = GD.script_projection(read_processed(spark, L.lake(spark, sf_dir).processed))
    GD.merge_upsert(spark, target, src, preset=GD.SCRIPT, run_ts=L.RUN_TS)
    GD.merge_upsert(spark, target, src, preset=GD.SCRIPT, run_ts=L.RUN_TS)
    return read_processed(spark, target).drop("inserted_at", "updated_at")


@register("partitioned_roundtrip", with_ctes("SELECT * FROM enriched", _DEDUP_CTE))
def partitioned_roundtrip(spark, sf_dir):
    return _flat(read_processed(spark, L.lake(spark, sf_dir).processed))


@register("partition_rerun", with_ctes("SELECT * FROM enriched", _DEDUP_CTE))
def partition_rerun(spark, sf_dir):
    root = scratch_dir(spark, "rerun")
    for _ in range(2):
        orders, events, segments = _inputs(spark, sf_dir)
        run_enrichment(spark, orders, events, segments, root)
    return _flat(read_processed(spark, root))


@register("late_rows_split", with_ctes("""
SELECT * FROM enriched
WHERE process_date NOT IN (SELECT DISTINCT process_date FROM orders_first)""", _DEDUP_CTE))
def late_rows_split(spark, sf_dir):
    """H7: a run owns the first-transmission dates; corrections dated a day
    no batch owns are diverted to the late-rows table."""
    run_dates = [r[0] for r in feeds.orders_first_feed(spark, sf_dir).select("process_date").distinct().collect()]
    root = scratch_dir(spark, "late")
    orders, events, segments = _inputs(spark, sf_dir)
    run_enrichment(spark, orders, events, segments, f"{root}/processed",
                   run_dates=run_dates, late_root=f"{root}/late")
    return _flat(read_processed(spark, f"{root}/late").drop("late_run"))


def _batch_ctes(name: str, rule: str) -> str:
    return f"""{name} AS (SELECT order_id, user_id, amount, currency, process_date FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY process_date DESC) AS rn
  FROM orders_src WHERE {rule}) WHERE rn = 1)"""


@register("late_rows_merged", with_ctes("""
SELECT o.order_id, o.user_id, o.amount, o.currency, o.process_date,
       COALESCE(s.user_segment, 'unclassified') AS user_segment,
       CAST(COALESCE(e.event_count, 0) AS INTEGER) AS event_count, e.event_types
FROM (SELECT * FROM batch_a UNION ALL SELECT * FROM batch_b) o
LEFT JOIN events_agg e ON o.user_id = e.user_id
LEFT JOIN segments_dim s ON o.user_id = s.user_id WHERE o.amount > 0""",
    _DEDUP_CTE + "," + _batch_ctes("batch_a", "day(process_date) <= 10 OR (day(process_date) > 20 "
                                              "AND CAST(order_id AS BIGINT) % 2 = 0)")
    + "," + _batch_ctes("batch_b", "day(process_date) BETWEEN 11 AND 20 OR (day(process_date) > 20 "
                                   "AND CAST(order_id AS BIGINT) % 2 = 1)")))
def late_rows_merged(spark, sf_dir):
    """Two runs that each own a third of the month's days, both with
    late rows for the same days of the last third; all are kept and merged."""
    from .late import merge_late
    root = scratch_dir(spark, "late-merged")
    orders, events, segments = _inputs(spark, sf_dir)
    day, even = F.dayofmonth("process_date"), F.col("order_id").cast("long") % 2 == 0
    days = [r[0] for r in orders.select("process_date").distinct().collect()]
    runs = [((day <= 10) | ((day > 20) & even), [d for d in days if d.day <= 10] + [date(2100, 1, 1)]),
            (day.between(11, 20) | ((day > 20) & ~even), [d for d in days if 11 <= d.day <= 20] + [date(2100, 1, 2)])]
    for rule, owned in runs:
        run_enrichment(spark, orders.where(rule), events, segments, f"{root}/processed",
                       run_dates=owned, late_root=f"{root}/late")
    merge_late(spark, f"{root}/late", f"{root}/processed")
    return _flat(read_processed(spark, f"{root}/processed"))


@register("enriched_range", with_ctes("""
SELECT o.order_id, o.user_id, o.amount, o.currency, o.process_date,
       COALESCE(s.user_segment, 'unclassified') AS user_segment,
       CAST(COALESCE(e.event_count, 0) AS INTEGER) AS event_count, e.event_types
FROM orders_src o
LEFT JOIN (SELECT DATE '1992-01-01' + CAST(event_id * 13 % 2400 AS INTEGER) AS day,
                  CAST(user_id AS VARCHAR) AS user_id, count(event_type) AS event_count,
                  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
           FROM events GROUP BY 1, 2) e ON o.user_id = e.user_id AND o.process_date = e.day
LEFT JOIN segments_dim s ON o.user_id = s.user_id WHERE o.amount > 0""", _DEDUP_CTE))
def enriched_range(spark, sf_dir):
    """B2: all days in one job, as their daily runs would give: an order sent
    on two days stays in both, events count on the day of their drop."""
    root = scratch_dir(spark, "range")
    orders = feeds.orders_feed(spark, sf_dir).withColumn("_batch", F.col("process_date"))
    days = [r[0] for r in orders.select("process_date").distinct().collect()]
    run_enrichment(spark, orders, feeds.events_dated_feed(spark, sf_dir), feeds.segments_feed(spark, sf_dir),
                   f"{root}/processed", run_dates=days, batch=True)
    return _flat(read_processed(spark, f"{root}/processed"))


@register("segments_latest_drop", with_ctes("SELECT user_id, segment AS user_segment FROM segments_src"))
def segments_latest_drop(spark, sf_dir):
    """S3: an older drop with another column name and other values lies beside
    the newest one."""
    from ..sources.files import read_segments
    root = scratch_dir(spark, "segment-drops")
    seg = feeds.segments_feed(spark, sf_dir)
    seg.withColumn("segment", F.lit("stale")).write.parquet(f"{root}/segments/2025-05-25")
    seg.withColumnRenamed("segment", "user_segment").write.parquet(f"{root}/segments/2025-06-01")
    return read_segments(spark, root)


@register("row_explosion_metrics", with_ctes("""
SELECT i.n AS input_rows, o.n AS output_rows,
       ROUND(CASE WHEN i.n > 0 THEN o.n / i.n ELSE 0 END, 6) AS ratio,
       CASE WHEN i.n > 0 AND o.n / i.n > 1.10 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (SELECT count(*) AS n FROM orders_latest) i, (SELECT count(*) AS n FROM enriched) o""",
    _DEDUP_CTE))
def row_explosion_metrics(spark, sf_dir):
    orders, events, segments = _inputs(spark, sf_dir)
    deduped, final = E.enrich_daily(orders, events, segments)
    return G.row_gate_frame(deduped, final)


def _tests_sql(table: str, with_updated: bool) -> str:
    nn = ["order_id", "user_id", "amount", "currency", "process_date", "user_segment",
          "event_count"]
    parts = [f"SELECT 'not_null_{c}' AS test_name, count(*) FILTER (WHERE {c} IS NULL) AS failures "
             f"FROM {table}" for c in nn]
    if with_updated:
        parts.append("SELECT 'not_null_updated_at', CAST(0 AS BIGINT)")
    parts += [
        f"SELECT 'expression_is_true_amount_gt_0', count(*) FILTER (WHERE NOT (amount > 0)) FROM {table}",
        f"SELECT 'expression_is_true_event_count_ge_0', count(*) FILTER (WHERE NOT (event_count >= 0)) FROM {table}",
        f"SELECT 'unique_order_id', count(*) FROM (SELECT order_id FROM {table} "
        f"WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)",
        f"SELECT 'accepted_values_currency', count(*) FROM (SELECT DISTINCT currency FROM {table} "
        f"WHERE currency NOT IN ('INR', 'USD', 'EUR', 'GBP'))",
    ]
    return "SELECT test_name, CAST(failures AS BIGINT) AS failures FROM (\n" + \
        "\nUNION ALL\n".join(parts) + ")"


@register("data_tests", with_ctes(_tests_sql("gold", True), _DEDUP_CTE))
def data_tests_q(spark, sf_dir):
    return G.data_tests(_gold_table(spark, sf_dir))


@register("data_tests_processed", with_ctes(_tests_sql("enriched", False), _DEDUP_CTE))
def data_tests_processed(spark, sf_dir):
    return G.data_tests(read_processed(spark, L.lake(spark, sf_dir).processed))


@register("data_tests_feed", with_ctes(_tests_sql("(SELECT *, NULL AS user_segment, 0 AS event_count FROM orders_src)", False)))
def data_tests_feed(spark, sf_dir):
    """Q8–Q11 on the unfiltered feed: every kind of test fails on some rows."""
    feed = feeds.orders_feed(spark, sf_dir).withColumns({"user_segment": F.lit(None).cast("string"),
                                                         "event_count": F.lit(0)})
    return G.data_tests(feed)


FRESHNESS_AS_OF = "2001-08-03 04:00:00"


@register("freshness", with_ctes(f"""
SELECT max_loaded_at,
       ROUND((epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max_loaded_at)) / 3600.0, 2) AS hours_since,
       CASE WHEN max_loaded_at IS NULL
              OR (epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max_loaded_at)) / 3600.0 > 30 THEN 'error'
            WHEN (epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max_loaded_at)) / 3600.0 > 25 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT CAST(max(process_date) AS TIMESTAMP) AS max_loaded_at FROM gold)""", _DEDUP_CTE))
def freshness_q(spark, sf_dir):
    return G.freshness(_gold_table(spark, sf_dir), FRESHNESS_AS_OF)


_CONTRACT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected_type, "
    + {"event_count": "'bigint', false", "updated_at": "CAST(NULL AS VARCHAR), false"}.get(
        f.name, f"'{f.dataType.simpleString()}', true").replace(", ", " AS actual_type, ", 1) + " AS ok, "
    + ("CAST(0 AS BIGINT)" if f.name == "updated_at" else f"(SELECT count({f.name}) FROM gold)") + " AS non_null_rows"
    for f in G.GOLD_CONTRACT.fields)


@register("contract_check", with_ctes(_CONTRACT_SQL, _DEDUP_CTE))
def contract_check_q(spark, sf_dir):
    """Q12 on a table that breaks the contract: one column of another type,
    one absent."""
    gold = read_processed(spark, L.lake(spark, sf_dir).gold)
    return G.contract_counts(gold.withColumn("event_count", F.col("event_count").cast("long")).drop("updated_at"))


# -------------------------------------------------------------- marts ----
@register("daily_revenue_by_segment", with_ctes("""
SELECT process_date, user_segment,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT order_id) AS order_count
FROM gold GROUP BY process_date, user_segment""", _DEDUP_CTE))
def daily_revenue_by_segment(spark, sf_dir):
    return M.revenue_by_segment(_gold_table(spark, sf_dir))


_LATEST = "(SELECT max(process_date) FROM gold)"


@register("segment_revenue_for_date", with_ctes(f"""
SELECT user_segment, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM gold WHERE process_date = {_LATEST} GROUP BY user_segment""", _DEDUP_CTE))
def segment_revenue_for_date(spark, sf_dir):
    """A8 for the latest loaded day."""
    root = L.lake(spark, sf_dir).gold
    return M.segment_revenue(_last_days(spark, root))


@register("revenue_trend_7d", with_ctes(f"""
SELECT process_date, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM gold WHERE process_date BETWEEN {_LATEST} - INTERVAL 7 DAY AND {_LATEST}
GROUP BY process_date""", _DEDUP_CTE))
def revenue_trend_7d(spark, sf_dir):
    """The latest day and the 7 before it (inclusive bounds = 8 days)."""
    root = L.lake(spark, sf_dir).gold
    return M.revenue_trend(_last_days(spark, root, 7))


@register("month_total", with_ctes("""
SELECT date_trunc('month', process_date)::DATE AS month,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM gold GROUP BY 1""", _DEDUP_CTE))
def month_total(spark, sf_dir):
    return M.month_totals(_gold_table(spark, sf_dir))


@register("date_segment_summary", with_ctes("""
SELECT process_date, user_segment, count(*) AS order_count,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(SUM(event_count) AS BIGINT) AS total_events
FROM gold GROUP BY 1, 2""", _DEDUP_CTE))
def date_segment_summary(spark, sf_dir):
    return M.date_segment_summary(_gold_table(spark, sf_dir))


@register("user_order_count", with_ctes("""
SELECT user_id, count(*) AS order_count FROM gold GROUP BY user_id""", _DEDUP_CTE))
def user_order_count(spark, sf_dir):
    return M.user_order_count(_gold_table(spark, sf_dir))


@register("distinct_users_since", with_ctes(f"""
SELECT DISTINCT user_id FROM gold WHERE process_date >= {_LATEST} - INTERVAL 365 DAY""",
    _DEDUP_CTE))
def distinct_users_since(spark, sf_dir):
    """Users active in the year up to the latest loaded day."""
    root = L.lake(spark, sf_dir).gold
    return M.distinct_users(_last_days(spark, root, 365))


@register("duplicate_dimension_keys", with_ctes("""
SELECT user_id, count(*) AS row_count FROM segments_src GROUP BY user_id HAVING count(*) > 1"""))
def duplicate_dimension_keys(spark, sf_dir):
    return G.duplicate_keys(feeds.segments_feed(spark, sf_dir), "user_id")


@register("duplicate_order_keys", with_ctes("""
SELECT order_id, count(*) AS row_count FROM orders_src GROUP BY order_id HAVING count(*) > 1"""))
def duplicate_order_keys(spark, sf_dir):
    return G.duplicate_keys(feeds.orders_feed(spark, sf_dir), "order_id")


@register("segment_user_lookup", with_ctes(f"""
SELECT * FROM gold WHERE process_date BETWEEN {_LATEST} - INTERVAL 365 DAY AND {_LATEST}
  AND user_segment = 'building'""", _DEDUP_CTE))
def segment_user_lookup(spark, sf_dir):
    """One segment over the year up to the latest loaded day."""
    root = L.lake(spark, sf_dir).gold
    gold = _last_days(spark, root, 365)
    return _flat(M.segment_user_lookup(gold, segment="building").select(*GOLD_COLS))


@register("segment_user_point", with_ctes(f"""
SELECT * FROM gold WHERE process_date BETWEEN {_LATEST} - INTERVAL 365 DAY AND {_LATEST}
  AND user_segment = 'building' AND user_id = (SELECT max(user_id) FROM gold
    WHERE process_date BETWEEN {_LATEST} - INTERVAL 365 DAY AND {_LATEST} AND user_segment = 'building')""",
    _DEDUP_CTE))
def segment_user_point(spark, sf_dir):
    """One segment and one user."""
    gold = _last_days(spark, L.lake(spark, sf_dir).gold, 365)
    user = gold.where("user_segment = 'building'").agg(F.max("user_id")).first()[0]
    return _flat(M.segment_user_lookup(gold, segment="building", user_id=user).select(*GOLD_COLS))


@register("user_order_count_one", with_ctes("""
SELECT count(*) AS order_count FROM gold WHERE user_id = (SELECT max(user_id) FROM gold)""", _DEDUP_CTE))
def user_order_count_one(spark, sf_dir):
    """One user's orders."""
    gold = _gold_table(spark, sf_dir)
    return M.user_order_count(gold, gold.agg(F.max("user_id")).first()[0])


@register("order_lookup", with_ctes("""
SELECT * FROM enriched WHERE order_id IN
  (SELECT order_id FROM orders_src GROUP BY order_id HAVING count(*) > 1)""", _DEDUP_CTE))
def order_lookup(spark, sf_dir):
    """P20: trace the re-transmitted orders in the processed (staging) table."""
    resent = G.duplicate_keys(feeds.orders_feed(spark, sf_dir), "order_id")
    return _flat(M.order_lookup(read_processed(spark, L.lake(spark, sf_dir).processed), resent))


@register("guarded_read", with_ctes("SELECT * FROM gold", _DEDUP_CTE))
def guarded_read_q(spark, sf_dir):
    df = _gold_table(spark, sf_dir).select(*GOLD_COLS)
    M.require_partition_filter(df)
    return _flat(df)


@register("rename_transition", with_ctes("SELECT * FROM events_agg", _DEDUP_CTE))
def rename_transition(spark, sf_dir):
    """An events drop that uses the new column name ``action_type``."""
    renamed = feeds.events_feed(spark, sf_dir).withColumnRenamed("event_type", "action_type")
    return _flat(E.aggregate_events(renamed))


# ------------------------------------------------------ history + audit ----
_HIST = feeds.HISTORY_CTES.strip()


@register("history_clean", with_ctes("SELECT * FROM history_clean", _HIST))
def history_clean(spark, sf_dir):
    return read_processed(spark, L.history_lake(spark, sf_dir).clean).drop("export_date")


@register("history_rejects", with_ctes("""
SELECT order_id, user_id, amount, currency, channel, product_sku, process_date, date,
       CASE WHEN order_id IS NULL THEN 'null order_id' WHEN user_id IS NULL THEN 'null user_id'
            WHEN amount IS NULL THEN 'unparseable amount'
            WHEN amount <= 0 THEN 'non-positive amount'
            WHEN amount >= 1e15 THEN 'amount out of range' ELSE 'unparseable process_date' END
         AS reject_reason
FROM history_rejects""", _HIST))
def history_rejects(spark, sf_dir):
    return read_processed(spark, L.history_lake(spark, sf_dir).rejects).drop("reject_month")


@register("backfill_range", with_ctes(f"""
SELECT order_id, user_id, amount, currency, channel, product_sku, process_date
FROM history_src
WHERE date BETWEEN DATE '{BACKFILL[0]}' AND DATE '{BACKFILL[1]}'
  AND order_id IS NOT NULL AND user_id IS NOT NULL AND amount > 0 AND amount < 1e15
  AND process_date IS NOT NULL""",
    _HIST))
def backfill_range(spark, sf_dir):
    """One job over a date range of the CSV folders."""
    h = L.history_lake(spark, sf_dir)
    out = scratch_dir(spark, "backfill")
    run_history(spark, h.csv, out, start=BACKFILL[0], end=BACKFILL[1])
    return read_processed(spark, out).drop("export_date")


def _audit_sql(label: str, target: str) -> str:
    """One audit row; money is exact until it becomes a double through text."""
    def side(table):
        return (f"(SELECT count(*) AS n, COALESCE(SUM(CAST(amount AS DECIMAL(28,2))), 0) AS amt FROM {table})")

    def dbl(x):
        return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"
    return f"""
SELECT '{label}' AS execution_date,
       CASE WHEN t.n <> s.n - r.n OR abs(t.amt - (s.amt - r.amt)) > 0.01 THEN 'MISMATCH' ELSE 'SUCCESS' END AS status,
       s.n AS source_row_count, {dbl('s.amt')} AS source_sum_amount,
       r.n AS filtered_row_count, {dbl('r.amt')} AS filtered_sum_amount,
       t.n AS target_row_count, {dbl('t.amt')} AS target_sum_amount,
       t.n - (s.n - r.n) AS discrepancy_rows, {dbl('abs(t.amt - (s.amt - r.amt))')} AS discrepancy_amount,
       CASE WHEN t.n <> s.n - r.n
            THEN 'Row count discrepancy: expected ' || format('{{:,}}', s.n - r.n) || ', but got ' || format('{{:,}}', t.n) || '.'
            ELSE 'All counts and amounts reconciled perfectly.' END AS message
FROM {side('history_src')} s, {side('history_rejects')} r, {side(target)} t"""


_PARTIAL = "(SELECT * FROM history_clean WHERE CAST(order_id AS BIGINT) % 10 <> 0)"


@register("reconciliation_report", with_ctes(
    _audit_sql("all", "history_clean") + "\nUNION ALL\n" + _audit_sql("partial", _PARTIAL), _HIST))
def reconciliation_report(spark, sf_dir):
    """Q2 twice: the converted table, and one that lost a tenth of its orders."""
    h = L.history_lake(spark, sf_dir)
    source, target = read_history_csv(spark, h.csv), read_processed(spark, h.clean)
    partial = target.where(F.col("order_id").cast("long") % 10 != 0)
    return H.reconciliation_report(source, target, "all").unionByName(
        H.reconciliation_report(source, partial, "partial"))


@register("audit_store", with_ctes(
    "SELECT 'all' AS doc_id, * FROM (" + _audit_sql("*", "history_clean") + ")", _HIST))
def audit_store(spark, sf_dir):
    """K8: the same audit stored twice leaves one report."""
    from .history import audit
    h = L.history_lake(spark, sf_dir)
    root = scratch_dir(spark, "reports")
    for _ in range(2):
        audit(spark, h.csv, h.clean, "*", report_root=root)
    return spark.read.parquet(root)


# ------------------------------------------------------------ landing ----
def _landing_zone(spark, sf_dir):
    from .landing import build_landing_zone
    root = scratch_dir(spark, "landing")
    return build_landing_zone(spark, sf_dir, f"{root}/raw"), f"{root}/registry"


def _by_folder(df, *more):
    """Decisions per folder; of an unreadable file's reason the fixed part."""
    folder = F.regexp_replace("filename", "/[^/]+$", "")
    reason = F.regexp_replace("failure_reason", "^(unreadable Parquet footer):.*$", "$1")
    return (df.select(folder.alias("folder"), "file_type", "status", reason.alias("failure_reason"), *more)
              .groupBy("folder", "file_type", "status", "failure_reason", *more)
              .agg(F.count(F.lit(1)).alias("files")))


_LANDED = """
landed AS (
  SELECT DISTINCT 'orders/daily/month=' || strftime(process_date, '%Y-%m') AS folder, 'orders' AS file_type,
         'validated' AS status, CAST(NULL AS VARCHAR) AS failure_reason FROM orders_src
  UNION ALL
  SELECT DISTINCT 'orders/no_amount/month=' || strftime(process_date, '%Y-%m'), 'orders', 'quarantined',
         'Required column ''amount'' missing from orders file' FROM orders_src
  UNION ALL
  SELECT DISTINCT 'events/daily/part=' || CAST(CAST(user_id AS BIGINT) % 7 AS VARCHAR), 'events', 'validated', NULL
  FROM events_src
  UNION ALL
  SELECT DISTINCT 'segments/weekly/part=' || segment, 'user_segments', 'validated', NULL FROM segments_src
  UNION ALL SELECT 'misc/reference/part=0', NULL, 'quarantined', 'Could not determine file type from path'
  UNION ALL SELECT 'orders/resent', 'orders', 'duplicate', NULL
  UNION ALL SELECT 'events/a_misplaced', 'events', 'quarantined',
                   'Required column ''event_id'' missing from events file'
  UNION ALL SELECT 'events/corrupt', 'events', 'quarantined', 'unreadable Parquet footer')"""


@register("landing_decisions", with_ctes("SELECT *, CAST(1 AS BIGINT) AS files FROM landed", _LANDED))
def landing_decisions_q(spark, sf_dir):
    """The decisions over a landing zone, one file per folder."""
    from .landing import run_landing
    raw, registry = _landing_zone(spark, sf_dir)
    return _by_folder(run_landing(spark, raw, registry, L.RUN_TS).decisions)


@register("landing_rerun", with_ctes("""
SELECT folder, file_type, CASE status WHEN 'validated' THEN 'duplicate' ELSE status END AS status, failure_reason,
       status = 'quarantined' AS was_read, CAST(1 AS BIGINT) AS files FROM landed""", _LANDED))
def landing_rerun_q(spark, sf_dir):
    """The same zone twice: known good files become duplicates without being
    read, quarantined files are checked again (H20)."""
    from .landing import run_landing
    raw, registry = _landing_zone(spark, sf_dir)
    run_landing(spark, raw, registry, L.RUN_TS)
    again = run_landing(spark, raw, registry, L.RUN_TS)
    if again.status != "READY":
        raise G.GateError("a repeated landing run lost its inputs")
    return _by_folder(again.decisions, "was_read")


@register("staging_load_day", with_ctes("""
SELECT * FROM enriched WHERE process_date = (SELECT max(process_date) FROM enriched)""", _DEDUP_CTE))
def staging_load_day(spark, sf_dir):
    """One date's processed partition into staging."""
    from ..sinks.parquet import write_replace
    from ..sources.files import read_partition
    processed = L.lake(spark, sf_dir).processed
    staging = scratch_dir(spark, "staging-day")
    write_replace(read_partition(spark, processed, "process_date", M.table_days(spark, processed)[1]), staging)
    return _flat(spark.read.parquet(staging))


@register("staging_load", with_ctes("SELECT * FROM enriched", _DEDUP_CTE))
def staging_load(spark, sf_dir):
    """The processed day partitions loaded into an ephemeral staging
    table by full replace; loading twice leaves the same table."""
    from ..sinks.parquet import write_replace
    processed = L.lake(spark, sf_dir).processed
    staging = scratch_dir(spark, "staging")
    for _ in range(2):
        write_replace(read_processed(spark, processed), staging)
    return _flat(spark.read.parquet(staging))


@register("landing_stream", with_ctes("SELECT *, CAST(1 AS BIGINT) AS files FROM landed", _LANDED))
def landing_stream_q(spark, sf_dir):
    """T1 as Structured Streaming: the landing zone drained by an
    availableNow file stream, each micro-batch decided by the same gate."""
    from ..streaming.landing_stream import start_landing_stream
    raw, _ = _landing_zone(spark, sf_dir)
    root = scratch_dir(spark, "landing-stream")
    q = start_landing_stream(spark, raw, f"{root}/decisions", f"{root}/registry",
                             f"{root}/checkpoint")
    q.awaitTermination()
    return _by_folder(spark.read.parquet(f"{root}/decisions"))


from . import catalog_tables  # noqa: E402,F401 - registers its queries
