"""The driver's tables as the engine's inputs: events, property snapshots and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions.identity import event_id
from heronlake.functions.model import TOPIC_PREFIX, Bounds
from heronlake.operators.numbering import numbered

#: The year of the driver's events.
BOUNDS = Bounds(1704067200000, 1735689599999)
COLUMNS = ["event_id", "visitor_id", "item_id", "event_type", "event_timestamp", "ingestion_timestamp", "transaction_id", "schema_version", "source_file", "source_row_number", "source_topic", "source_partition", "source_offset"]


#: Events of one partition are numbered within so many milliseconds.
BUCKET_MS = 86_400_000


def raw_events(spark: SparkSession, sf_dir: str, inject: bool = False, offsets: bool = True) -> DataFrame:
    """Clickstream events; with inject, faults by modulus of the source row: bad visitor, zero time, orphan transaction id, copies.

    Without offsets (for readers that need none) rows are not numbered, and source_offset is null.
    """
    row = F.col("source_row_number")
    kind = F.when(F.col("event_type") == "click", "addtocart").when(F.col("event_type") == "purchase", "transaction").otherwise(F.col("event_type"))
    out = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.lit("events.parquet").alias("source_file"), F.col("event_id").alias("source_row_number"), F.col("user_id").alias("visitor_id"),
        F.get_json_object("props", "$.k").try_cast("long").alias("item_id"), kind.alias("event_type"), F.unix_millis(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.when(F.col("event_type") == "purchase", F.floor(F.col("event_id") / 2).cast("string")).alias("transaction_id"),
    )
    if inject:
        out = out.withColumns({
            "visitor_id": F.when(row % 97 == 0, -1).otherwise(F.col("visitor_id")),
            "event_timestamp": F.when(row % 89 == 1, 0).otherwise(F.col("event_timestamp")),
            "transaction_id": F.when((row % 83 == 2) & (F.col("event_type") != "transaction"), "orphan").otherwise(F.col("transaction_id")),
        })
    out = out.withColumns({
        "ingestion_timestamp": F.col("event_timestamp") + 1000,
        "schema_version": F.lit(1),
        "source_topic": F.concat(F.lit(TOPIC_PREFIX), F.col("event_type")),
        "source_partition": F.pmod("visitor_id", F.lit(3)).cast("int"),
        "event_id": event_id(*(F.col(c) for c in ("source_file", "source_row_number", "event_timestamp", "visitor_id", "item_id", "event_type", "transaction_id"))),
    })
    if offsets:
        out = numbered(out, ["source_topic", "source_partition"], ["event_timestamp", "source_row_number"], F.floor(F.col("event_timestamp") / BUCKET_MS), "source_offset")
    else:
        out = out.withColumn("source_offset", F.lit(None).cast("long"))
    if inject:
        out = out.unionByName(out.where(row % 20 == 3).withColumn("source_offset", F.col("source_offset") + 1_000_000))
    return out.select(*COLUMNS)


def with_times(events: DataFrame) -> DataFrame:
    """event_time, ingestion_time and event_date beside the epoch values."""
    return events.withColumns({"event_time": F.timestamp_millis("event_timestamp"), "ingestion_time": F.timestamp_millis("ingestion_timestamp"), "event_date": F.to_date(F.timestamp_millis("event_timestamp"))})


def snapshots(events: DataFrame) -> DataFrame:
    """Weekly property snapshots (item_id, property, value, snapshot_ms), stamped at the start of the week after the events."""
    week = F.date_trunc("week", F.timestamp_millis("event_timestamp"))
    grouped = events.groupBy("item_id", (F.unix_millis(week) + 604_800_000).alias("snapshot_ms")).agg(F.max("source_row_number").alias("top"), F.count("*").alias("n"))
    pairs = F.explode(F.array(F.struct(F.lit("categoryid").alias("property"), (F.col("top") % 30).cast("string").alias("value")), F.struct(F.lit("available").alias("property"), (F.col("n") % 2).cast("string").alias("value"))))
    return grouped.select("item_id", "snapshot_ms", pairs.alias("p")).select("item_id", "p.property", "p.value", "snapshot_ms")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category_id, parent_id) from nation and region."""
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("category_id"), F.col("n_regionkey").cast("long").alias("parent_id"))
