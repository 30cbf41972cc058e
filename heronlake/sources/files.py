"""CSV and report files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.functions.identity import event_id, normal_transaction
from heronlake.functions.model import TOPIC_PREFIX
from heronlake.operators.numbering import numbered
from heronlake.sources import adapter


def csv_strings(spark: SparkSession, paths: list[str] | str, columns: list[str]) -> DataFrame:
    """Header CSV files as strings of known columns: no inference pass, and only the columns asked for are parsed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", True).schema(schema).csv(paths)


def item_properties(spark: SparkSession, paths: list[str] | str, tracked: tuple[str, ...] | None = None) -> DataFrame:
    """(item_id, property, value, snapshot_ms); rows whose numbers do not parse are null there."""
    rows = csv_strings(spark, paths, ["timestamp", "itemid", "property", "value"]).select(F.col("itemid").try_cast("long").alias("item_id"), "property", "value", F.col("timestamp").try_cast("long").alias("snapshot_ms"))
    return rows.where(F.col("property").isin(*tracked)) if tracked else rows


def category_tree(spark: SparkSession, path: str) -> DataFrame:
    return csv_strings(spark, path, ["categoryid", "parentid"]).select(F.col("categoryid").try_cast("long").alias("category_id"), F.col("parentid").try_cast("long").alias("parent_id"))


def event_rows(spark: SparkSession, path: str, source_file: str = "events.csv") -> DataFrame:
    """Raw clickstream CSV rows with types and their row number in the file, from 0.

    Rows are numbered inside the byte ranges that tasks read, and the rows of the ranges before are added.
    """
    raw = csv_strings(spark, path, ["timestamp", "visitorid", "event", "itemid", "transactionid"])
    raw = raw.select("*", F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_in_task"))
    raw = numbered(raw, [], ["_start", "_in_task"], F.col("_start"), "source_row_number")
    return raw.select("source_row_number", F.lit(source_file).alias("source_file"), F.col("timestamp").try_cast("long").alias("event_timestamp"), F.col("visitorid").try_cast("long").alias("visitor_id"), F.col("event").alias("event_type"), F.col("itemid").try_cast("long").alias("item_id"), F.col("transactionid").alias("transaction_id"))


def clickstream(spark: SparkSession, path: str, source_file: str = "events.csv", ingestion_ms: int | None = None) -> DataFrame:
    """Events of a clickstream CSV with identity, topic and place in it, as ``adapter.raw_events`` gives them for tables."""
    rows = event_rows(spark, path, source_file)
    rows = rows.withColumn("transaction_id", F.when(normal_transaction(F.col("transaction_id")) != "", normal_transaction(F.col("transaction_id"))))
    own = ("source_file", "source_row_number", "event_timestamp", "visitor_id", "item_id", "event_type", "transaction_id")
    rows = rows.withColumns({
        "ingestion_timestamp": F.lit(ingestion_ms).cast("long") if ingestion_ms is not None else F.unix_millis(F.current_timestamp()),
        "schema_version": F.lit(1), "source_topic": F.concat(F.lit(TOPIC_PREFIX), F.col("event_type")), "source_partition": F.pmod("visitor_id", F.lit(3)).cast("int"), "event_id": event_id(*map(F.col, own)),
    })
    return numbered(rows, ["source_topic", "source_partition"], ["event_timestamp", "source_row_number"], F.floor(F.col("event_timestamp") / adapter.BUCKET_MS), "source_offset").select(*adapter.COLUMNS)


def export_csv(df: DataFrame, folder: str, order_by: list[str] | None = None) -> None:
    """One CSV file with a header: for reports, whose rows fit one task."""
    (df.orderBy(*order_by) if order_by else df).coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def write_report(values: dict, path: str) -> None:
    with open(path, "w") as f:
        json.dump(values, f, indent=2, default=str)


def replay_slice(events: DataFrame, start_row: int = 0, limit: int | None = None) -> DataFrame:
    """Events in replay order (time, then source row), from a place on."""
    out = events.orderBy("event_timestamp", "source_row_number").offset(start_row)
    return out if limit is None else out.limit(limit)
