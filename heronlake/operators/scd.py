"""Slowly changing item dimension: half-open validity intervals from property snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACKED = ("categoryid", "available")


def to_intervals(snapshots: DataFrame) -> DataFrame:
    """(item_id, property, value, valid_from_ms, valid_to_ms, is_current): runs of equal values as [from, to) intervals.

    Snapshots of one item, property and time count once, with their greatest value; a change to or from null is a change.
    One shuffle: all windows share (item_id, property).
    """
    key = Window.partitionBy("item_id", "property").orderBy("snapshot_ms")
    once = snapshots.groupBy("item_id", "property", "snapshot_ms").agg(F.max("value").alias("value"))
    first = F.row_number().over(key) == 1
    changed = once.withColumn("change", first | ~F.col("value").eqNullSafe(F.lag("value").over(key))).where("change")
    end = F.lead("snapshot_ms").over(key)
    return changed.select("item_id", "property", "value", F.col("snapshot_ms").alias("valid_from_ms"), end.alias("valid_to_ms")).withColumn("is_current", F.col("valid_to_ms").isNull())


def category_dimension(categories: DataFrame) -> DataFrame:
    """(category_id, parent_id), one row for each category."""
    return categories.groupBy("category_id").agg(F.min("parent_id").alias("parent_id"))


def interval_stats(snapshots: DataFrame, intervals: DataFrame) -> DataFrame:
    """For each property: rows, intervals, items, open intervals and compression ratio."""
    rows = snapshots.groupBy("property").agg(F.count("*").alias("property_rows"))
    own = intervals.groupBy("property").agg(F.count("*").alias("intervals"), F.count_distinct("item_id").alias("items"), F.count_if("is_current").alias("open_intervals"))
    return rows.join(own, "property").withColumn("compression_ratio", F.round(F.col("property_rows") / F.col("intervals"), 3))


def snapshot_gaps(snapshots: DataFrame) -> DataFrame:
    """Distinct snapshot times with the days since the one before."""
    times = snapshots.select("snapshot_ms").distinct()
    before = F.lag("snapshot_ms").over(Window.partitionBy(F.lit(1)).orderBy("snapshot_ms"))  # tens of rows
    return times.select("snapshot_ms", F.round((F.col("snapshot_ms") - before) / 86_400_000, 3).alias("gap_days"))
