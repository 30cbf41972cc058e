"""Queries over the driver's tables, one for each operator family, with the same result as SQL for DuckDB."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions.contract import classify
from heronlake.operators import fingerprint, lateness, medallion, pit, profile, scd
from heronlake.plans import lakehouse
from heronlake.sources import adapter, files, simulate, wire
from heronlake.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LOW, HIGH = adapter.BOUNDS.low, adapter.BOUNDS.high
VALID_TYPES = "('view', 'addtocart', 'transaction')"

#: The adapter in SQL: e (events), i (with injected faults and copies), v (valid events), p (snapshots), s (intervals), w (silver).
BASE = """
WITH e0 AS (SELECT 'events.parquet' AS source_file, event_id AS source_row_number, user_id AS visitor_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event_type, epoch_us(ts) // 1000 AS event_timestamp,
  CASE WHEN event_type = 'purchase' THEN CAST(event_id // 2 AS VARCHAR) END AS transaction_id FROM events),
e AS (SELECT *, event_timestamp + 1000 AS ingestion_timestamp, 'events_' || event_type AS source_topic, CAST(((visitor_id % 3) + 3) % 3 AS INTEGER) AS source_partition,
  sha256(concat_ws('|', source_file, source_row_number, event_timestamp, visitor_id, coalesce(CAST(item_id AS VARCHAR), ''), event_type, coalesce(transaction_id, ''))) AS event_id,
  row_number() OVER (PARTITION BY event_type, ((visitor_id % 3) + 3) % 3 ORDER BY event_timestamp, source_row_number) - 1 AS source_offset FROM e0),
j0 AS (SELECT source_file, source_row_number, CASE WHEN source_row_number % 97 = 0 THEN -1 ELSE visitor_id END AS visitor_id, item_id, event_type,
  CASE WHEN source_row_number % 89 = 1 THEN 0 ELSE event_timestamp END AS event_timestamp, CASE WHEN source_row_number % 83 = 2 AND event_type <> 'transaction' THEN 'orphan' ELSE transaction_id END AS transaction_id FROM e0),
j AS (SELECT *, event_timestamp + 1000 AS ingestion_timestamp, 'events_' || event_type AS source_topic, CAST(((visitor_id % 3) + 3) % 3 AS INTEGER) AS source_partition,
  sha256(concat_ws('|', source_file, source_row_number, event_timestamp, visitor_id, coalesce(CAST(item_id AS VARCHAR), ''), event_type, coalesce(transaction_id, ''))) AS event_id,
  row_number() OVER (PARTITION BY event_type, ((visitor_id % 3) + 3) % 3 ORDER BY event_timestamp, source_row_number) - 1 AS source_offset FROM j0),
i AS (SELECT * FROM j UNION ALL SELECT * REPLACE (source_offset + 1000000 AS source_offset) FROM j WHERE source_row_number % 20 = 3),
v AS (SELECT *, CAST(make_timestamp(event_timestamp * 1000) AS DATE) AS event_date FROM e WHERE event_type IN ('view', 'addtocart', 'transaction')),
p0 AS (SELECT item_id, epoch_ms(date_trunc('week', make_timestamp(event_timestamp * 1000))) + 604800000 AS snapshot_ms, max(source_row_number) AS top, count(*) AS n FROM e GROUP BY 1, 2),
p AS (SELECT item_id, 'categoryid' AS property, CAST(top % 30 AS VARCHAR) AS value, snapshot_ms FROM p0 UNION ALL SELECT item_id, 'available', CAST(n % 2 AS VARCHAR), snapshot_ms FROM p0),
s0 AS (SELECT *, lag(value) OVER q AS before, row_number() OVER q AS place FROM p WINDOW q AS (PARTITION BY item_id, property ORDER BY snapshot_ms)),
s AS (SELECT item_id, property, value, snapshot_ms AS valid_from_ms, lead(snapshot_ms) OVER (PARTITION BY item_id, property ORDER BY snapshot_ms) AS valid_to_ms FROM s0 WHERE place = 1 OR value IS DISTINCT FROM before),
c AS (SELECT CAST(n_nationkey AS BIGINT) AS category_id, CAST(n_regionkey AS BIGINT) AS parent_id FROM nation),
pc AS (SELECT * FROM p WHERE property = 'categoryid'), pa AS (SELECT * FROM p WHERE property = 'available'),
w1 AS (SELECT v.*, TRY_CAST(pc.value AS BIGINT) AS category_id, pc.snapshot_ms AS category_snapshot_ms FROM v ASOF LEFT JOIN pc ON v.item_id = pc.item_id AND v.event_timestamp >= pc.snapshot_ms),
w2 AS (SELECT w1.*, TRY_CAST(pa.value AS INTEGER) AS available FROM w1 ASOF LEFT JOIN pa ON w1.item_id = pa.item_id AND w1.event_timestamp >= pa.snapshot_ms),
w AS (SELECT w2.*, c.parent_id AS parent_category_id FROM w2 LEFT JOIN c USING (category_id))
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = BASE + sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str, inject: bool = False, offsets: bool = True) -> DataFrame:
    return adapter.with_times(adapter.raw_events(spark, sf_dir, inject, offsets))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_events(spark, sf_dir, offsets=False), adapter.BOUNDS).where("rejection_reason is null").drop("rejection_reason")


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.snapshots(adapter.raw_events(spark, sf_dir, offsets=False))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver(_events(spark, sf_dir), scd.to_intervals(_snapshots(spark, sf_dir)), scd.category_dimension(adapter.categories(spark, sf_dir)), adapter.BOUNDS)[0]


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.col("event_date").cast("string"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder for a query's own tables: in the cluster's shared folder; on one machine without one, temporary until exit."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        base = tempfile.mkdtemp(prefix="heronlake-")
        atexit.register(shutil.rmtree, base, True)
        base = f"file://{base}"
    return f"{base.rstrip('/')}/heronlake/{name}-{uuid.uuid4().hex}"


# identity, contract, wire


@query("event_identity", "SELECT event_id, source_row_number, event_timestamp, CAST(make_timestamp(event_timestamp * 1000) AS DATE)::VARCHAR AS event_date, source_topic, source_partition, source_offset FROM e")
def event_identity(spark, sf_dir):
    return _dated(_events(spark, sf_dir)).select("event_id", "source_row_number", "event_timestamp", "event_date", "source_topic", "source_partition", "source_offset")


_REASON = f"""CASE WHEN NOT coalesce(regexp_full_match(event_id, '[0-9a-f]{{64}}'), false) THEN 'event_id_not_sha256' WHEN NOT coalesce(visitor_id >= 0, false) THEN 'negative_visitor_id'
  WHEN NOT coalesce(item_id >= 0, false) THEN 'negative_item_id' WHEN NOT coalesce(event_timestamp BETWEEN {LOW} AND {HIGH}, false) THEN 'event_timestamp_out_of_range'
  WHEN NOT coalesce(ingestion_timestamp > 0, false) THEN 'ingestion_timestamp_invalid' WHEN NOT coalesce(event_type IN {VALID_TYPES}, false) THEN 'unknown_event_type'
  {{topic}}WHEN event_type = 'transaction' AND coalesce(transaction_id, '') = '' THEN 'transaction_without_transaction_id'
  WHEN event_type <> 'transaction' AND coalesce(transaction_id, '') <> '' THEN 'non_transaction_with_transaction_id' END"""
_PLAIN = _REASON.replace("{topic}", "")
_TOPIC = _REASON.replace("{topic}", "WHEN source_topic <> 'events_' || event_type THEN 'event_type_not_of_topic' ")


@query("contract_classify", f"SELECT event_id, source_offset, {_PLAIN} AS rejection_reason FROM i")
def contract_classify(spark, sf_dir):
    return classify(adapter.raw_events(spark, sf_dir, True), adapter.BOUNDS).select("event_id", "source_offset", "rejection_reason")


@query("contract_reject_counts", f"SELECT rejection_reason, count(*) AS n FROM (SELECT {_PLAIN} AS rejection_reason FROM i) WHERE rejection_reason IS NOT NULL GROUP BY 1")
def contract_reject_counts(spark, sf_dir):
    return contract_classify(spark, sf_dir).where("rejection_reason is not null").groupBy("rejection_reason").agg(F.count("*").alias("n"))


def _misrouted(events: DataFrame) -> DataFrame:
    return events.withColumn("source_topic", F.when(F.col("source_row_number") % 53 == 5, "events_view").otherwise(F.col("source_topic")))


@query("contract_topic_rule", f"SELECT event_id, source_offset, {_TOPIC} AS rejection_reason FROM (SELECT * REPLACE (CASE WHEN source_row_number % 53 = 5 THEN 'events_view' ELSE source_topic END AS source_topic) FROM i)")
def contract_topic_rule(spark, sf_dir):
    return classify(_misrouted(adapter.raw_events(spark, sf_dir, True)), adapter.BOUNDS, topic_rule=True).select("event_id", "source_offset", "rejection_reason")


def _envelope(spark, sf_dir) -> DataFrame:
    return wire.corrupt(wire.envelope_of(adapter.raw_events(spark, sf_dir, True)))


_ROUTE = f"CASE WHEN source_offset % 31 = 7 THEN 'deserialization_failed' WHEN source_offset % 37 = 11 THEN 'unknown_schema_id' WHEN source_offset % 41 = 13 THEN 'deserialization_failed' WHEN {_TOPIC} IS NOT NULL THEN 'validation_failed' ELSE 'valid' END"


@query("wire_frame_split", "SELECT source_topic, source_partition, source_offset, CASE WHEN source_offset % 31 = 7 THEN NULL WHEN source_offset % 37 = 11 THEN 9999 ELSE 1 END AS schema_id, CASE WHEN source_offset % 31 = 7 THEN 'deserialization_failed' WHEN source_offset % 37 = 11 THEN 'unknown_schema_id' WHEN source_offset % 41 = 13 THEN 'deserialization_failed' ELSE 'decoded' END AS status FROM i")
def wire_frame_split(spark, sf_dir):
    rows = wire.decode(_envelope(spark, sf_dir))
    return rows.select(F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"), F.col("schema_id").cast("int").alias("schema_id"), wire.wire_status([1]).alias("status"))


@query("wire_flatten", "SELECT event_id, visitor_id, item_id, event_type, event_timestamp, source_topic, source_partition, source_offset, CAST(make_timestamp(event_timestamp * 1000) AS DATE)::VARCHAR AS event_date FROM i WHERE source_offset % 31 <> 7 AND source_offset % 37 <> 11 AND source_offset % 41 <> 13")
def wire_flatten(spark, sf_dir):
    good, _ = wire.split(_envelope(spark, sf_dir), [1])
    return _dated(wire.flatten(good)).select("event_id", "visitor_id", "item_id", "event_type", "event_timestamp", "source_topic", "source_partition", "source_offset", "event_date")


@query("dlq_route_counts", f"SELECT route, count(*) AS n FROM (SELECT {_ROUTE} AS route FROM i) GROUP BY 1")
def dlq_route_counts(spark, sf_dir):
    return wire.route(_envelope(spark, sf_dir), [1], adapter.BOUNDS).groupBy("route").agg(F.count("*").alias("n"))


@query("dlq_records", f"""SELECT source_topic, source_partition AS "partition", source_offset AS "offset", route AS error_type, visitor_id::VARCHAR AS message_key, CASE WHEN route = 'validation_failed' THEN 1 END AS schema_version,
  route || ': ' || CASE WHEN route = 'validation_failed' THEN {_TOPIC} ELSE 'the record could not be read' END AS error_message FROM (SELECT *, {_ROUTE} AS route FROM i) WHERE route <> 'valid'""")
def dlq_records(spark, sf_dir):
    return wire.dead_letters(wire.route(_envelope(spark, sf_dir), [1], adapter.BOUNDS)).select("source_topic", "partition", "offset", "error_type", "message_key", "schema_version", "error_message")


@query("dedup_batch", "SELECT event_id, source_topic, source_partition, source_offset FROM i QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY source_topic, source_partition, source_offset) = 1")
def dedup_batch(spark, sf_dir):
    return medallion.deduplicate(adapter.raw_events(spark, sf_dir, True)).select("event_id", "source_topic", "source_partition", "source_offset")


# dimension and enrichment


@query("scd_intervals", "SELECT item_id, property, value, valid_from_ms, valid_to_ms, valid_to_ms IS NULL AS is_current FROM s")
def scd_intervals(spark, sf_dir):
    return scd.to_intervals(_snapshots(spark, sf_dir))


@query("scd_stats", "SELECT property, property_rows, intervals, items, open_intervals, round(CAST(property_rows AS DOUBLE) / intervals, 3) AS compression_ratio FROM (SELECT property, count(*) AS property_rows FROM p GROUP BY 1) JOIN (SELECT property, count(*) AS intervals, count(DISTINCT item_id) AS items, count(*) FILTER (valid_to_ms IS NULL) AS open_intervals FROM s GROUP BY 1) USING (property)")
def scd_stats(spark, sf_dir):
    rows = _snapshots(spark, sf_dir)
    return scd.interval_stats(rows, scd.to_intervals(rows))


@query("snapshot_timeline", "SELECT snapshot_ms, round((snapshot_ms - lag(snapshot_ms) OVER (ORDER BY snapshot_ms)) / 86400000.0, 3)::DOUBLE AS gap_days FROM (SELECT DISTINCT snapshot_ms FROM p)")
def snapshot_timeline(spark, sf_dir):
    return scd.snapshot_gaps(_snapshots(spark, sf_dir))


@query("pit_join_category", "SELECT event_id, category_id::VARCHAR AS category FROM w1")
def pit_join_category(spark, sf_dir):
    return pit.point_in_time_join(_valid(spark, sf_dir), scd.to_intervals(_snapshots(spark, sf_dir)), "categoryid", "category").select("event_id", "category")


@query("pit_as_of_category", "SELECT event_id, category_id::VARCHAR AS category FROM w1")
def pit_as_of_category(spark, sf_dir):
    return pit.as_of_join(_valid(spark, sf_dir), scd.to_intervals(_snapshots(spark, sf_dir)), "categoryid", "category", buckets=4).select("event_id", "category")


@query("pit_join_two_properties", "SELECT event_id, category_id, available FROM w2")
def pit_join_two_properties(spark, sf_dir):
    return _silver(spark, sf_dir).select("event_id", "category_id", "available")


@query("silver_events", "SELECT event_id, event_timestamp, event_date::VARCHAR AS event_date, visitor_id, item_id, event_type, transaction_id, category_id, parent_category_id, available, category_id IS NOT NULL AS has_category, CASE WHEN category_id IS NOT NULL THEN 'enriched' ELSE 'unenriched' END AS enrichment_status FROM w")
def silver_events(spark, sf_dir):
    return _dated(_silver(spark, sf_dir)).select("event_id", "event_timestamp", "event_date", "visitor_id", "item_id", "event_type", "transaction_id", "category_id", "parent_category_id", "available", "has_category", "enrichment_status")


@query("silver_rejected", f"SELECT event_id, rejection_reason FROM (SELECT event_id, {_PLAIN} AS rejection_reason FROM j) WHERE rejection_reason IS NOT NULL")
def silver_rejected(spark, sf_dir):
    return medallion.silver(_events(spark, sf_dir, True), scd.to_intervals(_snapshots(spark, sf_dir)), adapter.categories(spark, sf_dir), adapter.BOUNDS)[1].select("event_id", "rejection_reason")


@query("enrichment_breakdown", "SELECT count(*) AS events, count(*) FILTER (first_ms IS NULL) AS no_property, count(*) FILTER (event_timestamp < first_ms) AS before_first, count(*) FILTER (event_timestamp >= first_ms) AS joinable, round(100.0 * (count(*) - count(*) FILTER (event_timestamp >= first_ms)) / count(*), 6)::DOUBLE AS miss_rate_pct FROM v LEFT JOIN (SELECT item_id, min(snapshot_ms) AS first_ms FROM p GROUP BY 1) USING (item_id)")
def enrichment_breakdown(spark, sf_dir):
    return pit.enrichment_breakdown(_valid(spark, sf_dir), _snapshots(spark, sf_dir))


@query("leakage_check", "SELECT count(*) AS leaks FROM w WHERE category_snapshot_ms > event_timestamp")
def leakage_check(spark, sf_dir):
    return pit.leaks(_silver(spark, sf_dir)).agg(F.count("*").alias("leaks"))


@query("min_enrichment_lag", "SELECT min(event_timestamp - valid_from_ms) AS min_lag_ms FROM v JOIN s ON v.item_id = s.item_id AND s.property = 'categoryid' AND event_timestamp >= valid_from_ms AND (valid_to_ms IS NULL OR event_timestamp < valid_to_ms)")
def min_enrichment_lag(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.min(F.col("event_timestamp") - F.col("category_id_valid_from_ms")).alias("min_lag_ms"))


# gold

_PIVOT = "count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'addtocart') AS carts, count(*) FILTER (event_type = 'transaction') AS {bought}"
_BOUGHT, _PIVOT = _PIVOT.format(bought="purchases"), _PIVOT.format(bought="transactions")
_RATE = "CASE WHEN views > 0 THEN CAST(carts AS DOUBLE) / views END AS view_to_cart_rate, CASE WHEN carts > 0 THEN CAST({bought} AS DOUBLE) / carts END AS cart_to_purchase_rate, CASE WHEN views > 0 THEN CAST({bought} AS DOUBLE) / views END AS view_to_purchase_rate"


def _timed(df: DataFrame) -> DataFrame:
    """Dates as text and event_time in epoch milliseconds, as every engine writes them."""
    return _dated(df).withColumn("event_time", F.unix_millis("event_time"))


@query("fact_events", "SELECT event_id, visitor_id, item_id, event_type, event_timestamp AS event_time, event_timestamp, category_id, parent_category_id, available, CASE WHEN category_id IS NOT NULL THEN 'enriched' ELSE 'unenriched' END AS enrichment_status, event_date::VARCHAR AS event_date FROM w")
def fact_events(spark, sf_dir):
    return _timed(medallion.fact_events(_silver(spark, sf_dir)))


@query("fact_events_provenance", "SELECT event_id, s.valid_from_ms AS category_known_since_ms, event_timestamp - s.valid_from_ms AS category_age_at_event_ms FROM w LEFT JOIN s ON w.item_id = s.item_id AND s.property = 'categoryid' AND event_timestamp >= valid_from_ms AND (valid_to_ms IS NULL OR event_timestamp < valid_to_ms)")
def fact_events_provenance(spark, sf_dir):
    return medallion.fact_events(_silver(spark, sf_dir), provenance=True).select("event_id", "category_known_since_ms", "category_age_at_event_ms")


@query("fact_transactions", "SELECT event_id, transaction_id, visitor_id, item_id, event_timestamp AS event_time, category_id, parent_category_id, event_date::VARCHAR AS event_date FROM w WHERE event_type = 'transaction'")
def fact_transactions(spark, sf_dir):
    return _timed(medallion.fact_transactions(_silver(spark, sf_dir)))


@query("mart_item_funnel", f"SELECT *, {_RATE.format(bought='purchases')} FROM (SELECT item_id, {_BOUGHT}, count(DISTINCT visitor_id) AS unique_visitors, max(category_id) AS last_known_category_id FROM w GROUP BY item_id)")
def mart_item_funnel(spark, sf_dir):
    return medallion.item_funnel(_silver(spark, sf_dir))


@query("mart_category_performance", f"SELECT category_id, parent_category_id, count(*) AS events, count(DISTINCT item_id) AS items, count(DISTINCT visitor_id) AS visitors, {_BOUGHT} FROM w WHERE category_id IS NOT NULL GROUP BY 1, 2")
def mart_category_performance(spark, sf_dir):
    return medallion.category_performance(_silver(spark, sf_dir))


@query("mart_daily_item_metrics", f"SELECT event_date::VARCHAR AS event_date, item_id, count(*) AS events, count(DISTINCT visitor_id) AS unique_visitors, {_BOUGHT} FROM w GROUP BY 1, 2")
def mart_daily_item_metrics(spark, sf_dir):
    return _dated(medallion.daily_item_metrics(_silver(spark, sf_dir)))


@query("gold_attribution", "SELECT count(*) AS events, count(category_id) AS attributed, round(100.0 * count(category_id) / count(*), 6)::DOUBLE AS attribution_pct FROM w")
def gold_attribution(spark, sf_dir):
    return medallion.attribution(_silver(spark, sf_dir))


# windows

_WINDOWS = f"SELECT epoch_ms(time_bucket(INTERVAL 5 MINUTE, make_timestamp(event_timestamp * 1000))) AS window_start_ms, count(*) AS events, count(DISTINCT visitor_id) AS unique_visitors, count(DISTINCT item_id) AS unique_items, {_PIVOT} FROM {{src}} GROUP BY 1"
_RATES = _RATE.format(bought="transactions")


def _plain_windows(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start_ms", F.unix_millis("window_start")).drop("window_start", "window_end")


@query("windowed_metrics", f"SELECT *, {_RATES} FROM ({_WINDOWS.format(src='v')})")
def windowed_metrics(spark, sf_dir):
    return _plain_windows(medallion.windowed_metrics(_valid(spark, sf_dir), approximate=False))


@query("approx_distinct_accuracy", "SELECT epoch_ms(time_bucket(INTERVAL 1 DAY, make_timestamp(event_timestamp * 1000))) AS window_start_ms, count(DISTINCT visitor_id) AS unique_visitors, count(DISTINCT item_id) AS unique_items, true AS within_tolerance FROM v GROUP BY 1")
def approx_distinct_accuracy(spark, sf_dir):
    """Sketches against exact counts on windows of a day, which hold far more keys than a sketch keeps exactly."""
    exact = _plain_windows(medallion.windowed_metrics(_valid(spark, sf_dir), "1 day", approximate=False)).select("window_start_ms", "unique_visitors", "unique_items")
    rough = _plain_windows(medallion.windowed_metrics(_valid(spark, sf_dir), "1 day")).select("window_start_ms", "unique_visitors_approx", "unique_items_approx")
    near = lambda c: F.abs(F.col(f"{c}_approx") - F.col(c)) <= F.greatest(F.lit(2), 0.05 * F.col(c))
    return exact.join(rough, "window_start_ms").select("window_start_ms", "unique_visitors", "unique_items", (near("unique_visitors") & near("unique_items")).alias("within_tolerance"))


@query("top_windows", f"SELECT window_start_ms, events FROM ({_WINDOWS.format(src='v')}) ORDER BY window_start_ms DESC LIMIT 50")
def top_windows(spark, sf_dir):
    return windowed_metrics(spark, sf_dir).select("window_start_ms", "events").orderBy(F.desc("window_start_ms")).limit(50)


@query("window_totals", f"SELECT count(*) AS windows, CAST(sum(events) AS BIGINT) AS events, CAST(sum(views) AS BIGINT) AS views, CAST(sum(carts) AS BIGINT) AS carts, CAST(sum(transactions) AS BIGINT) AS transactions, min(window_start_ms) AS first_ms, max(window_start_ms) AS last_ms FROM ({_WINDOWS.format(src='v')})")
def window_totals(spark, sf_dir):
    sums = [F.sum(c).alias(c) for c in ("events", "views", "carts", "transactions")]
    return windowed_metrics(spark, sf_dir).agg(F.count("*").alias("windows"), *sums, F.min("window_start_ms").alias("first_ms"), F.max("window_start_ms").alias("last_ms"))


@query("duplicate_inflation", "SELECT CAST(sum(CASE WHEN raw > clean THEN 1 ELSE 0 END) AS BIGINT) AS inflated_windows, CAST(sum(raw - clean) AS BIGINT) AS extra_events FROM (SELECT event_timestamp // 300000 AS w, count(*) AS raw, count(DISTINCT event_id) AS clean FROM i GROUP BY 1)")
def duplicate_inflation(spark, sf_dir):
    """The negative control in batch: what windows would count without deduplication."""
    window = F.floor(F.col("event_timestamp") / 300_000).alias("w")
    per = adapter.raw_events(spark, sf_dir, True).groupBy(window).agg(F.count("*").alias("raw"), F.count_distinct("event_id").alias("clean"))
    return per.agg(F.sum(F.when(F.col("raw") > F.col("clean"), 1).otherwise(0)).alias("inflated_windows"), F.sum(F.col("raw") - F.col("clean")).alias("extra_events"))


@query("reconcile_windows", f"SELECT window_start_ms, true AS in_left, window_start_ms % 1500000 <> 0 AS in_right FROM ({_WINDOWS.format(src='v')}) WHERE window_start_ms % 1500000 = 0 OR window_start_ms % 2100000 = 0 UNION ALL SELECT window_start_ms + 1, false, true FROM ({_WINDOWS.format(src='v')}) WHERE window_start_ms % 3300000 = 0")
def reconcile_windows(spark, sf_dir):
    """Windows against another count of them in which some are missing, some differ and some are strange; all others agree."""
    events = _valid(spark, sf_dir)
    start = F.col("window_start_ms")
    other = events.groupBy((F.col("event_timestamp") - F.col("event_timestamp") % 300_000).alias("window_start_ms")).agg(F.count("*").alias("events"))
    strange = other.where(start % 3_300_000 == 0).withColumn("window_start_ms", start + 1)
    other = other.where(start % 1_500_000 != 0).withColumn("events", F.when(start % 2_100_000 == 0, F.col("events") + 1).otherwise(F.col("events"))).unionByName(strange)
    ours = windowed_metrics(spark, sf_dir).select("window_start_ms", "events")
    return fingerprint.reconcile(ours, other, ["window_start_ms"])


@query("expectation_merge", f"SELECT status, count(*) AS n FROM (SELECT CASE WHEN window_start_ms % 1500000 = 0 THEN 'missing' WHEN window_start_ms % 2100000 = 0 THEN 'differs' ELSE 'equal' END AS status FROM ({_WINDOWS.format(src='v')}) UNION ALL SELECT 'unexpected' FROM ({_WINDOWS.format(src='v')}) WHERE window_start_ms % 3300000 = 0) GROUP BY 1")
def expectation_merge(spark, sf_dir):
    """Each window of an expectation merged with what was found: equal, differs, missing or unexpected."""
    start = F.col("window_start_ms")
    wanted = windowed_metrics(spark, sf_dir).select("window_start_ms", "events")
    found = wanted.where(start % 1_500_000 != 0).withColumn("events", F.when(start % 2_100_000 == 0, F.col("events") + 1).otherwise(F.col("events")))
    found = found.unionByName(wanted.where(start % 3_300_000 == 0).withColumn("window_start_ms", start + 1))
    return fingerprint.merge_expectation(wanted, found, ["window_start_ms"]).groupBy("status").agg(F.count("*").alias("n"))


def _chain(spark, sf_dir, name, batches=5, **options):
    from heronlake.streaming.chain import Chain, replay

    root = _scratch(spark, name)
    replay(adapter.raw_events(spark, sf_dir, True), f"{root}/log", batches)
    chain = Chain(spark, root, **options)
    chain.run_available(wire.stream_source(spark, f"{root}/log/batch=*", max_per_trigger=1))
    return chain


@query("stream_dedup_metrics", f"SELECT window_start_ms, events, views, carts, transactions FROM (SELECT epoch_ms(time_bucket(INTERVAL 5 MINUTE, make_timestamp(event_timestamp * 1000))) AS window_start_ms, count(*) AS events, {_PIVOT} FROM j WHERE event_timestamp > 0 GROUP BY 1)")
def stream_dedup_metrics(spark, sf_dir):
    """The whole live chain over a replayed log with copies. The watermark is long enough for all good events, but not for the
    faulty ones stamped 1970, which come first: a watermark cannot lie before 1970, so the first batch drops them as late."""
    chain = _chain(spark, sf_dir, "stream", watermark="40000 days")
    return _plain_windows(chain.store.read("metrics")).select("window_start_ms", "events", "views", "carts", "transactions")


@query("stream_without_dedup", f"SELECT window_start_ms, events FROM (SELECT epoch_ms(time_bucket(INTERVAL 5 MINUTE, make_timestamp(event_timestamp * 1000))) AS window_start_ms, count(*) AS events FROM i GROUP BY 1)")
def stream_without_dedup(spark, sf_dir):
    """The negative control: without deduplication copies inflate the windows."""
    return _plain_windows(_chain(spark, sf_dir, "stream-nodedup", deduplicate=False).store.read("metrics")).select("window_start_ms", "events")


# tables


def _store(spark, sf_dir, name) -> TableStore:
    store = TableStore(spark, _scratch(spark, name))
    lakehouse.ingest_bronze(store, _events(spark, sf_dir))
    lakehouse.build_scd(store, _snapshots(spark, sf_dir), adapter.categories(spark, sf_dir))
    lakehouse.build_silver(store, bounds=adapter.BOUNDS)
    return store


@query("backfill_range_replace", "SELECT event_date::VARCHAR AS event_date, count(*) AS row_count, count(*) FILTER (event_date >= DATE '2024-01-10' AND event_date < DATE '2024-01-13') AS rows_with_column, count(category_id) AS rows_with_category FROM w GROUP BY 1")
def backfill_range_replace(spark, sf_dir):
    """Three days are rebuilt with two more columns; the others keep their files and read null there."""
    store = _store(spark, sf_dir, "backfill")
    lakehouse.build_gold(store, provenance=False)
    start, end = "2024-01-10", "2024-01-13"
    part = medallion.in_range(store.read("silver_events"), start, end)
    store.replace_range("fact_events", medallion.fact_events(part, True).withColumn("rebuilt", F.lit(True)), start, end)
    return _dated(fingerprint.column_propagation(store.read("fact_events"), "rebuilt"))


@query("upsert_windows", f"SELECT window_start_ms, events, CASE WHEN window_start_ms % 600000 = 0 THEN 'second' ELSE 'first' END AS writer FROM ({_WINDOWS.format(src='v')})")
def upsert_windows(spark, sf_dir):
    store = TableStore(spark, _scratch(spark, "upsert"))
    rows = windowed_metrics(spark, sf_dir).select("window_start_ms", "events")
    store.upsert("w", rows.withColumn("writer", F.lit("first")), ["window_start_ms"], batch="a")
    for _ in range(2):  # a repeated batch changes nothing
        store.upsert("w", rows.where("window_start_ms % 600000 = 0").withColumn("writer", F.lit("second")), ["window_start_ms"], batch="b")
    return store.read("w")


@query("table_history", """SELECT version, operation, CAST(CASE version WHEN 0 THEN 0 WHEN 1 THEN (SELECT count(*) FROM e WHERE event_timestamp < 1705276800000) ELSE (SELECT count(*) FROM e) END AS BIGINT) AS row_count,
  CAST(CASE version WHEN 2 THEN (SELECT count(*) FROM e WHERE event_timestamp >= 1705276800000) ELSE 0 END AS BIGINT) AS with_extra FROM (VALUES (0::BIGINT, 'create'), (1::BIGINT, 'append'), (2::BIGINT, 'append')) t(version, operation)""")
def table_history(spark, sf_dir):
    """Two appends of the whole table by date, the first one twice and the second with one more column; rows of each version."""
    store = TableStore(spark, _scratch(spark, "history"))
    rows, middle = adapter.raw_events(spark, sf_dir, offsets=False).select("event_id", "item_id", "event_timestamp"), 1705276800000
    for _ in range(2):
        store.append("t", rows.where(F.col("event_timestamp") < middle), batch="0")
    store.append("t", rows.where(F.col("event_timestamp") >= middle).withColumn("extra", F.lit(1)), batch="1")
    found = []
    for h in store.history("t"):
        df = store.read("t", h["version"])
        n = df.agg(F.count("*"), F.count("extra") if "extra" in df.columns else F.lit(0)).first()
        found.append((h["version"], h["operation"], n[0], n[1]))
    return spark.createDataFrame(found, "version long, operation string, row_count long, with_extra long")


@query("table_fingerprint", "SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', coalesce(available::VARCHAR, '~'), coalesce(category_id::VARCHAR, '~'), event_id)), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS fingerprint FROM w")
def table_fingerprint(spark, sf_dir):
    return fingerprint.table_fingerprint(_silver(spark, sf_dir).select("event_id", "category_id", "available"), portable=True)


@query("partition_fingerprint", "SELECT event_date::VARCHAR AS event_date, count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', event_date::VARCHAR, event_id, item_id::VARCHAR)), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS fingerprint FROM v GROUP BY 1")
def partition_fingerprint(spark, sf_dir):
    return _dated(fingerprint.partition_fingerprints(_valid(spark, sf_dir).select("event_date", "event_id", "item_id"), portable=True))


@query("partition_pruned_day", "SELECT event_type, count(*) AS n FROM v WHERE event_date = DATE '2024-01-15' GROUP BY 1")
def partition_pruned_day(spark, sf_dir):
    store = TableStore(spark, _scratch(spark, "prune"))
    store.overwrite("events", _valid(spark, sf_dir), ["event_date"])
    return store.read("events").where(F.col("event_date") == F.lit("2024-01-15").cast("date")).groupBy("event_type").agg(F.count("*").alias("n"))


# lateness

_LATE = """, pos AS (SELECT event_id, event_timestamp, source_topic, source_partition, row_number() OVER (PARTITION BY source_topic, source_partition ORDER BY source_offset) AS position, count(*) OVER (PARTITION BY source_topic, source_partition) AS n, count(*) OVER () AS total FROM e),
bt AS (SELECT event_id, event_timestamp, CAST(floor(position / greatest(CAST(n AS DOUBLE) / total * 500.0, 1.0)) AS INTEGER) AS batch_index FROM pos),
tp AS (SELECT batch_index, max(event_timestamp) AS top FROM bt GROUP BY 1),
rn AS (SELECT batch_index, max(top) OVER (ORDER BY batch_index ROWS UNBOUNDED PRECEDING) AS running FROM tp),
mk AS (SELECT batch_index, lag(running) OVER (ORDER BY batch_index) AS watermark FROM rn),
lt AS (SELECT event_id, batch_index, CAST(coalesce(greatest(watermark - event_timestamp, 0), 0) AS BIGINT) AS lateness_ms FROM bt JOIN mk USING (batch_index)) """


@query("lateness_model", _LATE + "SELECT event_id, batch_index, lateness_ms FROM lt")
def lateness_model(spark, sf_dir):
    return lateness.lateness(adapter.raw_events(spark, sf_dir), batch_size=500)


@query("lateness_exceedances", _LATE + """SELECT count(*) AS total_records, count(*) FILTER (lateness_ms = 0) AS records_with_zero_lateness, count(*) FILTER (lateness_ms > 60000) AS later_than_1min, count(*) FILTER (lateness_ms > 300000) AS later_than_5min,
  count(*) FILTER (lateness_ms > 600000) AS later_than_10min, count(*) FILTER (lateness_ms > 1800000) AS later_than_30min, count(*) FILTER (lateness_ms > 3600000) AS later_than_60min, count(*) FILTER (lateness_ms > 10800000) AS later_than_180min,
  count(*) FILTER (lateness_ms > 21600000) AS later_than_360min, count(*) FILTER (lateness_ms > 43200000) AS later_than_720min, count(*) FILTER (lateness_ms > 86400000) AS later_than_1440min FROM lt""")
def lateness_exceedances(spark, sf_dir):
    return lateness.exceedances(lateness_model(spark, sf_dir))


@query("lateness_quantiles", _LATE + "SELECT " + ", ".join(f"round(quantile_cont(lateness_ms, {q}), 4)::DOUBLE AS {n}" for n, q in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999), ("max", 1.0))) + " FROM lt")
def lateness_quantiles(spark, sf_dir):
    return lateness.quantiles(lateness_model(spark, sf_dir), approximate=False)


_POINTS = (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999), ("max", 1.0))


@query("lateness_quantiles_approx", _LATE + "SELECT " + ", ".join(f"quantile_disc(lateness_ms, {q}) AS {n}, true AS {n}_near" for n, q in _POINTS) + " FROM lt")
def lateness_quantiles_approx(spark, sf_dir):
    """Exact quantiles, and whether the approximate ones lie within 1e-3 of the rows of them (their contract is 1e-4)."""
    rows = lateness_model(spark, sf_dir)
    exact = rows.agg(*(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY lateness_ms)").cast("long").alias(n) for n, q in _POINTS))
    bounds = rows.agg(*(F.expr(f"percentile_disc({max(0.0, q - 1e-3)}) WITHIN GROUP (ORDER BY lateness_ms)").cast("double").alias(f"{n}_low") for n, q in _POINTS), *(F.expr(f"percentile_disc({min(1.0, q + 1e-3)}) WITHIN GROUP (ORDER BY lateness_ms)").cast("double").alias(f"{n}_high") for n, q in _POINTS))
    rough = lateness.quantiles(rows).select(*(F.col(n).alias(f"{n}_rough") for n, _ in _POINTS))
    one = exact.join(bounds, F.lit(True)).join(rough, F.lit(True))  # three rows of one
    return one.select(*(c for n, _ in _POINTS for c in (F.col(n), F.col(f"{n}_rough").between(F.col(f"{n}_low"), F.col(f"{n}_high")).alias(f"{n}_near"))))


# profiles


@query("profile_events", f"SELECT count(*) AS events, count(DISTINCT visitor_id) AS visitors, count(DISTINCT item_id) AS items, count(DISTINCT transaction_id) AS transaction_ids, {_PIVOT}, count(*) FILTER (event_type = 'transaction' AND transaction_id IS NULL) AS transactions_without_id, count(*) FILTER (event_type <> 'transaction' AND transaction_id IS NOT NULL) AS others_with_id, " + ", ".join(f"count(DISTINCT {c}) FILTER (event_type = '{t}') AS {n}_{o}" for t, n in (("view", "view"), ("addtocart", "cart"), ("transaction", "transaction")) for c, o in (("visitor_id", "visitors"), ("item_id", "items"))) + ", " + ", ".join(f"round(100.0 * count(*) FILTER (event_type = '{t}') / count(*), 6)::DOUBLE AS {n}_pct" for t, n in (("view", "view"), ("addtocart", "cart"), ("transaction", "transaction"))) + ", min(event_timestamp) AS first_ms, max(event_timestamp) AS last_ms, round((max(event_timestamp) - min(event_timestamp)) / 86400000.0, 6)::DOUBLE AS span_days FROM i")
def profile_events(spark, sf_dir):
    return profile.events(adapter.raw_events(spark, sf_dir, True))


@query("profile_duplicates", "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT event_id, count(*) AS n FROM i GROUP BY 1 HAVING n > 1)")
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_rows(adapter.raw_events(spark, sf_dir, True), ["event_id"])


@query("interaction_histogram", "SELECT count(*) AS keys, " + ", ".join(f"count(*) FILTER (n = {k}) AS exactly_{k}" for k in (1, 2, 3, 5, 10)) + ", " + ", ".join(f"count(*) FILTER (n >= {k}) AS at_least_{k}" for k in (2, 5, 10, 20)) + " FROM (SELECT visitor_id, count(*) AS n FROM v GROUP BY 1)")
def interaction_histogram(spark, sf_dir):
    return profile.interaction_histogram(_valid(spark, sf_dir))


@query("per_visitor_stats", "SELECT round(avg(n), 6)::DOUBLE AS mean, round(quantile_cont(n, 0.5), 6)::DOUBLE AS median, round(quantile_cont(n, 0.95), 6)::DOUBLE AS p95, max(n) AS max FROM (SELECT visitor_id, count(*) AS n FROM v GROUP BY 1)")
def per_visitor_stats(spark, sf_dir):
    return profile.per_visitor(_valid(spark, sf_dir))


@query("repeat_pairs", "SELECT count(*) AS pairs, count(*) FILTER (n > 1) AS repeated, max(n) AS most FROM (SELECT visitor_id, item_id, count(*) AS n FROM v GROUP BY 1, 2)")
def repeat_pairs(spark, sf_dir):
    return profile.repeat_pairs(_valid(spark, sf_dir))


@query("eligibility_matrix", ", n AS (SELECT visitor_id, count(*) AS n FROM v GROUP BY 1) " + " UNION ALL ".join(f"SELECT {k}::INTEGER AS min_history, count(*) FILTER (n >= {k}) AS visitors, CAST(coalesce(sum(n) FILTER (n >= {k}), 0) AS BIGINT) AS events FROM n" for k in (2, 3, 5, 10, 20)))
def eligibility_matrix(spark, sf_dir):
    return profile.eligibility(_valid(spark, sf_dir))


@query("transaction_reality", ", l AS (SELECT transaction_id, count(*) AS n, count(DISTINCT item_id) AS items FROM v WHERE event_type = 'transaction' GROUP BY 1), b AS (SELECT visitor_id, max(CASE WHEN event_type = 'transaction' THEN 1 ELSE 0 END) AS buys FROM v GROUP BY 1) SELECT * FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS lines, count(*) AS ids, round(avg(n), 6)::DOUBLE AS lines_per_id, max(items) AS most_items FROM l), (SELECT round(100.0 * avg(buys), 6)::DOUBLE AS visitors_transacting_pct FROM b)")
def transaction_reality(spark, sf_dir):
    return profile.transaction_reality(_valid(spark, sf_dir))


@query("property_profile_topk", "SELECT property, value, count(*) AS updates, count(DISTINCT item_id) AS items FROM p GROUP BY 1, 2 ORDER BY updates DESC, property, value LIMIT 20")
def property_profile_topk(spark, sf_dir):
    return profile.property_topk(_snapshots(spark, sf_dir))


@query("updates_per_item", "SELECT count(*) AS items, CAST(sum(n) AS BIGINT) AS updates, round(avg(n), 6)::DOUBLE AS mean, round(quantile_cont(n, 0.5), 6)::DOUBLE AS median, max(n) AS most FROM (SELECT item_id, count(*) AS n FROM p GROUP BY 1)")
def updates_per_item(spark, sf_dir):
    return profile.updates_per_item(_snapshots(spark, sf_dir))


@query("category_tree_profile", "SELECT count(*) AS categories, count(*) FILTER (parent_id IS NULL) AS roots, count(DISTINCT parent_id) AS parents, (SELECT count(*) FROM (SELECT DISTINCT parent_id FROM c WHERE parent_id IS NOT NULL) WHERE parent_id NOT IN (SELECT category_id FROM c)) AS orphan_parents FROM c")
def category_tree_profile(spark, sf_dir):
    return profile.category_tree(adapter.categories(spark, sf_dir))


@query("items_without_properties", "SELECT DISTINCT item_id FROM i WHERE item_id NOT IN (SELECT item_id FROM p WHERE item_id % 3 <> 0)")
def items_without_properties(spark, sf_dir):
    """Against snapshots that know nothing about every third item."""
    return profile.items_without_properties(adapter.raw_events(spark, sf_dir, True, offsets=False), _snapshots(spark, sf_dir).where("item_id % 3 <> 0"))


@query("items_with_properties", "SELECT DISTINCT item_id FROM e WHERE item_id IN (SELECT item_id FROM p)")
def items_with_properties(spark, sf_dir):
    return profile.items_with_properties(adapter.raw_events(spark, sf_dir), _snapshots(spark, sf_dir))


@query("first_property_seen", "SELECT event_id, item_id, first_ms FROM e LEFT JOIN (SELECT item_id, min(snapshot_ms) AS first_ms FROM p GROUP BY 1) USING (item_id)")
def first_property_seen(spark, sf_dir):
    return profile.first_seen(adapter.raw_events(spark, sf_dir), _snapshots(spark, sf_dir))


@query("replay_order_slice", "SELECT event_id, event_timestamp FROM e ORDER BY event_timestamp, source_row_number LIMIT 200 OFFSET 100")
def replay_order_slice(spark, sf_dir):
    return files.replay_slice(adapter.raw_events(spark, sf_dir), 100, 200).select("event_id", "event_timestamp")


@query("timestamp_roundtrip", "SELECT event_id, event_timestamp, event_timestamp AS back_ms, true AS equal FROM e")
def timestamp_roundtrip(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "event_timestamp", F.unix_millis("event_time").alias("back_ms"))
    return rows.withColumn("equal", F.col("back_ms") == F.col("event_timestamp"))


# replay

_DRAW = "CAST(CAST('0x' || substr(md5('7|{what}|' || event_id), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0"


@query("replay_plan", f""", d AS (SELECT event_id, row_number() OVER (ORDER BY event_timestamp, source_row_number) - 1 AS position,
  CASE WHEN {_DRAW.format(what='late')} < 0.05 THEN CAST(floor({_DRAW.format(what='shift')} * 50) AS BIGINT) + 1 ELSE 0 END AS shift, CASE WHEN {_DRAW.format(what='duplicate')} < 0.02 THEN 1 ELSE 0 END AS copies,
  CASE WHEN {_DRAW.format(what='malformed')} < 0.03 THEN ['raw_garbage', 'unknown_schema_id', 'invalid_field'][CAST(floor({_DRAW.format(what='corruption')} * 3) AS BIGINT) + 1] END AS corruption,
  ['negative_visitor', 'zero_timestamp', 'orphan_transaction_id'][CAST(floor({_DRAW.format(what='invalid_field')} * 3) AS BIGINT) + 1] AS field FROM e),
x AS (SELECT *, unnest(range(copies + 1)) AS copy FROM d)
SELECT event_id, CAST(copy AS INTEGER) AS copy, position, shift, corruption, CASE WHEN corruption = 'invalid_field' THEN field END AS invalid_field, row_number() OVER (ORDER BY position + shift, shift > 0, position, copy) - 1 AS place FROM x""")
def replay_plan(spark, sf_dir):
    planned = simulate.plan(adapter.raw_events(spark, sf_dir), 7, duplicate_rate=0.02, malformed_rate=0.03, delay_rate=0.05)
    return planned.select("event_id", "copy", "position", "shift", "corruption", "invalid_field", "place")


@query("replay_routes", f""", d AS (SELECT event_id, CASE WHEN {_DRAW.format(what='duplicate')} < 0.02 THEN 2 ELSE 1 END AS n, {_PLAIN} AS reason,
  CASE WHEN {_DRAW.format(what='malformed')} < 0.2 THEN ['raw_garbage', 'unknown_schema_id', 'invalid_field'][CAST(floor({_DRAW.format(what='corruption')} * 3) AS BIGINT) + 1] END AS corruption FROM e)
SELECT CASE WHEN corruption = 'raw_garbage' THEN 'deserialization_failed' WHEN corruption = 'unknown_schema_id' THEN 'unknown_schema_id' WHEN corruption = 'invalid_field' OR reason IS NOT NULL THEN 'validation_failed' ELSE 'valid' END AS route, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY 1""")
def replay_routes(spark, sf_dir):
    """What a seeded replay's records come to at the router: each kind of corruption fails where it should."""
    records = simulate.emit(simulate.plan(adapter.raw_events(spark, sf_dir), 7, duplicate_rate=0.02, malformed_rate=0.2), 7)
    return wire.route(records.drop("place"), [1], adapter.BOUNDS).groupBy("route").agg(F.count("*").alias("n"))
