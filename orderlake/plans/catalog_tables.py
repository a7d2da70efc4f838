"""Registered queries on registry versions, as-of segments, mergeable rollups
and bitmaps, and located differences; the same rules as in ``catalog``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, bitmaps, checksums, rollups
from ..operators import enrichment as E
from ..operators import gold as GD
from ..operators import landing as LG
from ..operators import marts as M
from ..operators.key_index import KeyIndex
from ..session import scratch_dir
from ..sinks.layout import Layout
from ..sources import feeds
from ..sources.files import read_processed
from . import lakehouse as L
from .catalog import _DEDUP_CTE, _flat, _inputs, _landing_zone, register, with_ctes
from .landing import redrop_in_place, run_landing

_MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


@register("landing_redrop", with_ctes(f"""
SELECT 'orders/daily/month=' || m AS folder, count(*) AS order_rows, {_MONEY.format("amount + 1")} AS total_amount
FROM by_month WHERE CAST(right(m, 2) AS INTEGER) % 2 = 0 GROUP BY m
UNION ALL
SELECT 'orders/no_amount/month=' || m, count(*), {_MONEY.format("amount + 2")} FROM by_month GROUP BY m
UNION ALL
SELECT 'orders/resent', count(*), {_MONEY.format("amount")} FROM by_month WHERE m = (SELECT min(m) FROM by_month)""",
    "by_month AS (SELECT *, strftime(process_date, '%Y-%m') AS m FROM orders_src)"))
def landing_redrop(spark, sf_dir):
    """K6/K7/Q14: files dropped again under their old paths. Corrected months
    supersede the former bytes (even months), faulty ones withdraw theirs (odd
    months), repaired ones appear (no_amount); a copy elsewhere hands out the
    first month's former bytes. What the manifest names is read once."""
    raw, registry = _landing_zone(spark, sf_dir)
    run_landing(spark, raw, registry, "2025-06-01 00:00:00")
    orders = feeds.orders_feed(spark, sf_dir).withColumn("month", F.date_format("process_date", "yyyy-MM"))
    even = F.substring("month", 6, 2).cast("int") % 2 == 0
    staged = scratch_dir(spark, "redrop")
    for name, folder, df in (
            ("corrected", "orders/daily", orders.where(even).withColumn("amount", F.col("amount") + 1)),
            ("faulty", "orders/daily", orders.where(~even).drop("currency")),
            ("repaired", "orders/no_amount", orders.withColumn("amount", F.col("amount") + 2))):
        df.repartition("month").write.partitionBy("month").parquet(f"{staged}/{name}")
        redrop_in_place(spark, f"{staged}/{name}", f"{raw}/{folder}")
    run_landing(spark, raw, registry, "2025-06-02 00:00:00")
    paths = [r["path"] for r in LG.manifest(LG.read_versions(spark, registry), "orders").collect()]
    rows = spark.read.schema("order_id string, amount double").parquet(*paths)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/raw/(.*)/[^/]+$", 1)
    return rows.groupBy(F.url_decode(folder).alias("folder")).agg(
        F.count("*").alias("order_rows"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount"))


@register("landing_stream_daily", with_ctes("""
SELECT o.order_id, o.user_id, o.amount, o.currency, CAST(date_trunc('month', o.process_date) AS DATE) AS process_date,
       COALESCE(s.user_segment, 'unclassified') AS user_segment,
       CAST(COALESCE(e.event_count, 0) AS INTEGER) AS event_count, e.event_types
FROM orders_first o
LEFT JOIN (SELECT CAST(date_trunc('month', DATE '1992-01-01' + CAST(event_id * 13 % 2400 AS INTEGER)) AS DATE) AS month,
                  CAST(user_id AS VARCHAR) AS user_id, count(event_type) AS event_count,
                  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
           FROM events GROUP BY 1, 2) e
  ON o.user_id = e.user_id AND CAST(date_trunc('month', o.process_date) AS DATE) = e.month
LEFT JOIN segments_dim s ON o.user_id = s.user_id WHERE o.amount > 0""", _DEDUP_CTE))
def landing_stream_daily(spark, sf_dir):
    """T1 into B2: dated drops (one a month) validated by the stream, then read
    by the range run through the registry that both share. Copies of the drops
    under other names change nothing."""
    from ..streaming.landing_stream import start_landing_stream
    from .daily import run_range
    root = scratch_dir(spark, "stream-daily")
    raw = f"{root}/raw"
    month = F.trunc("process_date", "month")
    orders = feeds.orders_first_feed(spark, sf_dir).withColumn("process_date", month)
    events = feeds.events_dated_feed(spark, sf_dir).select(
        F.lit("e").alias("event_id"), "user_id", "event_type", F.lit("").alias("timestamp"), F.trunc("_batch", "month").alias("m"))
    for kind, df, day in (("orders", orders.withColumn("m", F.col("process_date")), "m"), ("events", events, "m")):
        named = df.withColumn("drop", F.concat(F.lit(f"{kind}_"), F.col(day).cast("string"), F.lit(".parquet"))).drop(day)
        named.repartition("drop").sortWithinPartitions(*named.columns).write.partitionBy("drop").parquet(f"{raw}/{kind}")
    orders.repartition("process_date").sortWithinPartitions(*orders.columns).withColumn("copy", F.col("process_date")).write.partitionBy(
        "copy").parquet(f"{raw}/orders/sent_again")
    feeds.segments_feed(spark, sf_dir).withColumn("segment_date", F.lit("1992-01-01").cast("date")).write.parquet(
        f"{raw}/segments/1992-01-01")
    q = start_landing_stream(spark, raw, f"{root}/decisions", f"{root}/registry", f"{root}/checkpoint")
    q.awaitTermination()
    days = [r[0] for r in orders.select("process_date").distinct().collect()]
    run_range(spark, raw, f"{root}/processed", days, registry=f"{root}/registry")
    return _flat(read_processed(spark, f"{root}/processed"))


_DROPS = ("1993-01-01", "1995-07-01", "1997-01-01")


@register("segments_as_of", with_ctes(f"""
SELECT o.order_id, o.user_id, o.process_date,
       CASE WHEN c.c_custkey IS NULL OR o.process_date < DATE '{_DROPS[0]}' THEN NULL
            WHEN o.process_date < DATE '{_DROPS[1]}' THEN CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) END
            WHEN o.process_date < DATE '{_DROPS[2]}' THEN lower(c_mktsegment)
            WHEN c_custkey % 5 <> 0 THEN 'vip_' || lower(c_mktsegment) END AS user_segment
FROM orders_src o LEFT JOIN customer c ON o.user_id = CAST(c.c_custkey AS VARCHAR) AND c.c_acctbal > 0"""))
def segments_as_of(spark, sf_dir):
    """Every order with its user's segment on the order's date, from
    three drops; users come, change and go."""
    seg = feeds.segments_feed(spark, sf_dir).withColumnRenamed("segment", "user_segment")
    key = F.col("user_id").cast("long")
    drops = [(_DROPS[0], seg.where(key % 3 != 0)), (_DROPS[1], seg),
             (_DROPS[2], seg.where(key % 5 != 0).withColumn("user_segment", F.concat(F.lit("vip_"), "user_segment")))]
    orders = feeds.orders_feed(spark, sf_dir).select("order_id", "user_id", "process_date")
    asof.check_unique(drops)
    return asof.as_of_join(orders, asof.segment_intervals(drops), "process_date")


@register("distinct_users_range", with_ctes("""
SELECT r.a AS range_start, r.b AS range_end, count(DISTINCT g.user_id) AS distinct_keys
FROM (SELECT DISTINCT CAST(date_trunc('year', process_date) AS DATE) AS a,
             CAST(date_trunc('year', process_date) + INTERVAL 17 MONTH AS DATE) AS b FROM gold) r
JOIN gold g ON g.process_date BETWEEN r.a AND r.b GROUP BY 1, 2""", _DEDUP_CTE))
def distinct_users_range(spark, sf_dir):
    """Exact distinct users of overlapping ranges of 17 months from
    bitmaps per day; the days are built in two lots and one lot again."""
    root = scratch_dir(spark, "bitmaps-query")
    gold = read_processed(spark, L.lake(spark, sf_dir).gold).select("process_date", "user_id")
    days = [r[0] for r in gold.select("process_date").distinct().collect()]
    first = F.year("process_date") % 2 == 0
    for part, rule in ((first, 0), (~first, 1), (first, 0)):
        rows = gold.where(part)
        users = bitmaps.update_dictionary(spark, f"{root}/users", rows)
        bitmaps.refresh_days(spark, f"{root}/days", rows, users, [d for d in days if d.year % 2 == rule])
    table = spark.read.parquet(f"{root}/days")
    start = F.trunc("process_date", "year")
    ranges = gold.select(start.alias("range_start"), F.add_months(start, 17).alias("range_end")).distinct()
    return bitmaps.distinct_in_ranges(table, ranges)


def _monthly_gold(spark, sf_dir, root):
    """Gold rows with the month as their day, written once."""
    orders, events, segments = _inputs(spark, sf_dir)
    _, enriched = E.enrich_daily(orders, events, segments)
    rows = GD.gold_model(enriched.withColumn("process_date", F.trunc("process_date", "month")), L.RUN_TS)
    rows.write.parquet(f"{root}/rows")
    return spark.read.parquet(f"{root}/rows")


@register("rollup_after_merge", with_ctes("""
SELECT process_date, user_segment, count(*) AS order_count,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, CAST(SUM(event_count) AS BIGINT) AS total_events
FROM (
  SELECT m AS process_date, CASE WHEN k % 14 = 0 THEN 'moved' ELSE user_segment END AS user_segment,
         CASE WHEN k % 7 = 0 THEN amount + 1 ELSE amount END AS amount, event_count FROM monthly
  UNION ALL SELECT m, 'late', amount, 1 FROM monthly WHERE k % 11 = 0)
GROUP BY 1, 2""", _DEDUP_CTE + """,
monthly AS (SELECT *, CAST(order_id AS BIGINT) AS k, CAST(date_trunc('month', process_date) AS DATE) AS m FROM gold)"""))
def rollup_after_merge(spark, sf_dir):
    """A8/A10/A11 with K4: the rollup after a first merge, a merge of corrected
    amounts and segments, a late merge of new orders, and the corrections once
    more; only signed sums of changed rows were added to it."""
    root = scratch_dir(spark, "rollup-query")
    rows = _monthly_gold(spark, sf_dir, root)
    key = F.col("order_id").cast("long")
    corrected = rows.where(key % 7 == 0).withColumns({
        "amount": F.col("amount") + 1, "user_segment": F.when(key % 14 == 0, "moved").otherwise(F.col("user_segment"))})
    late = rows.where(key % 11 == 0).withColumns({"order_id": F.concat(F.lit("L"), "order_id"), "user_segment": F.lit("late"),
                                                  "event_count": F.lit(1)})
    table = rollups.Rollup(f"{root}/rollup")
    for source in (rows, corrected, late, corrected):
        GD.merge_upsert(spark, f"{root}/gold", source, rollup=table)
    return rollups.date_segment_summary(table.read(spark))


_LOST, _CHANGED, _TWICE, _EXTRA = 211, 173, 401, 307


@register("audit_differences", with_ctes(f"""
SELECT order_id, process_date, CASE WHEN k % {_LOST} = 5 THEN 'lost' WHEN k % {_CHANGED} = 3 THEN 'changed' ELSE 'copies' END AS difference,
       CAST(1 AS BIGINT) AS source_rows, CAST(CASE WHEN k % {_LOST} = 5 THEN 0 WHEN k % {_CHANGED} = 3 THEN 1 ELSE 2 END AS BIGINT) AS target_rows
FROM keyed WHERE k % {_LOST} = 5 OR k % {_CHANGED} = 3 OR k % {_TWICE} = 7
UNION ALL SELECT 'X' || order_id, process_date, 'extra', 0, 1 FROM keyed WHERE k % {_EXTRA} = 11""",
    _DEDUP_CTE + ", keyed AS (SELECT *, CAST(order_id AS BIGINT) AS k FROM orders_latest)"))
def audit_differences(spark, sf_dir):
    """The orders that a copy of the table has lost, changed, doubled or
    added, found through checksums by day and key-hash prefix."""
    root = scratch_dir(spark, "audit-differences")
    source = E.latest_per_key(feeds.orders_feed(spark, sf_dir), ["order_id"], ["process_date desc"])
    source.write.parquet(f"{root}/source")
    source = spark.read.schema(source.schema).parquet(f"{root}/source")
    key = F.col("order_id").cast("long")
    lost, changed = key % _LOST == 5, key % _CHANGED == 3
    copy = source.where(~lost).withColumn("amount", F.when(changed, F.col("amount") + 0.5).otherwise(F.col("amount")))
    copy = copy.unionByName(source.where((key % _TWICE == 7) & ~lost & ~changed)).unionByName(
        source.where(key % _EXTRA == 11).withColumn("order_id", F.concat(F.lit("X"), "order_id")))
    copy.write.parquet(f"{root}/copy")
    columns = ["order_id", "user_id", "amount", "currency", "process_date"]
    return checksums.differences(source, spark.read.parquet(f"{root}/copy"), "order_id", "process_date", columns)


@register("cross_day_duplicates", with_ctes("""
SELECT order_id, CAST(date_trunc('month', process_date) AS DATE) AS process_date FROM gold
WHERE CAST(order_id AS BIGINT) % 13 = 4""", _DEDUP_CTE))
def cross_day_duplicates(spark, sf_dir):
    """The orders of a batch that days of a gold table hold already,
    found through the days' Bloom filters that two merges have kept. The batch
    sends every thirteenth order again and brings as many new ones."""
    root = scratch_dir(spark, "key-index-query")
    rows = _monthly_gold(spark, sf_dir, root)
    gold, index = f"{root}/gold", KeyIndex(f"{root}/index")
    early = F.year("process_date") < 1995
    for part in (rows.where(early), rows.where(~early)):
        GD.merge_upsert(spark, gold, part, index=index)
    again = rows.where(F.col("order_id").cast("long") % 13 == 4).select("order_id")
    batch = again.unionByName(again.select(F.concat(F.lit("N"), "order_id").alias("order_id")))
    return index.held_elsewhere(gold, batch)


_PICKED = "SELECT {} AS v FROM monthly WHERE user_segment <> 'unclassified'"


@register("clustered_lookups", with_ctes(f"""
SELECT 'order' AS lookup, * FROM monthly WHERE order_id = ({_PICKED.format("max(order_id)")})
UNION ALL SELECT 'user', * FROM monthly WHERE user_id = ({_PICKED.format("min(user_id)")})
UNION ALL SELECT 'segment', * FROM monthly WHERE user_segment = ({_PICKED.format("max(user_segment)")})""", _DEDUP_CTE + """,
monthly AS (SELECT order_id, user_id, amount, currency, CAST(date_trunc('month', process_date) AS DATE) AS process_date,
                   user_segment, event_count FROM gold)"""))
def clustered_lookups(spark, sf_dir):
    """An order, a user and a segment looked up in a gold table by
    month whose rows lie along the interleaved curve of segment and user, with
    Bloom filters on the order id."""
    root = scratch_dir(spark, "clustered-query")
    GD.merge_upsert(spark, f"{root}/gold", _monthly_gold(spark, sf_dir, root), layout=Layout())
    gold = read_processed(spark, f"{root}/gold").select(
        "order_id", "user_id", "amount", "currency", "process_date", "user_segment", "event_count")
    picked = gold.where("user_segment <> 'unclassified'").agg(
        F.max("order_id").alias("o"), F.min("user_id").alias("u"), F.max("user_segment").alias("s")).first()
    found = {"order": M.order_lookup(gold, [picked["o"]]), "user": M.segment_user_lookup(gold, user_id=picked["u"]),
             "segment": M.segment_user_lookup(gold, segment=picked["s"])}
    parts = [df.select(F.lit(name).alias("lookup"), *gold.columns) for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
