"""Point-in-time enrichment: what was known about an item when its event happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def point_in_time_join(events: DataFrame, intervals: DataFrame, property_name: str, out: str) -> DataFrame:
    """Left join of the value valid at event_timestamp as ``out`` with ``<out>_valid_from_ms``; never fans out.

    An equi-join on the item with the interval as residual condition: intervals of one item and property do not overlap, so
    at most one matches.
    """
    side = intervals.where(F.col("property") == property_name).select(F.col("item_id").alias("_item"), F.col("value").alias(out), F.col("valid_from_ms").alias(f"{out}_valid_from_ms"), F.col("valid_to_ms").alias("_to"))
    at = F.col("event_timestamp")
    valid = (F.col("item_id") == F.col("_item")) & (at >= F.col(f"{out}_valid_from_ms")) & (F.col("_to").isNull() | (at < F.col("_to")))
    return events.join(side, valid, "left").drop("_item", "_to")


def as_of_join(events: DataFrame, intervals: DataFrame, property_name: str, out: str, buckets: int = 1) -> DataFrame:
    """point_in_time_join for skewed items with long histories: union and last value, linear in rows.

    Values sort before events at equal times, so a boundary takes the newer value. buckets > 1 deals each item's events out
    over that many groups (by row) and copies the item's intervals to each.
    """
    columns = events.columns
    deal = F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")
    left = events.select("*", deal.alias("_b"), F.col("event_timestamp").alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast("struct<v:string,f:bigint>").alias("_s"))
    side = intervals.where(F.col("property") == property_name)
    right = side.select(F.col("item_id"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_b"), F.col("valid_from_ms").alias("_t"), F.lit(0).alias("_k"), F.struct(F.col("value").alias("v"), F.col("valid_from_ms").alias("f")).alias("_s"))
    w = Window.partitionBy("item_id", "_b").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = left.unionByName(right, allowMissingColumns=True).withColumn("_last", F.last("_s", ignorenulls=True).over(w)).where("_k = 1")
    return joined.select(*columns, F.col("_last.v").alias(out), F.col("_last.f").alias(f"{out}_valid_from_ms"))


def as_of_properties(events: DataFrame, intervals: DataFrame, properties: dict[str, str], buckets: int = 1) -> DataFrame:
    """``as_of_join`` of several properties ({property: column}) in one pass: one shuffle of the events, however many."""
    columns = events.columns
    known = F.struct(F.col("value").alias("v"), F.col("valid_from_ms").alias("f"))
    kind = "struct<v:string,f:bigint>"
    deal = F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")
    left = events.select("*", deal.alias("_b"), F.col("event_timestamp").alias("_t"), F.lit(1).alias("_k"), *(F.lit(None).cast(kind).alias(f"_s{i}") for i in range(len(properties))))
    right = intervals.where(F.col("property").isin(*properties)).select(
        "item_id", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_b"), F.col("valid_from_ms").alias("_t"), F.lit(0).alias("_k"),
        *(F.when(F.col("property") == p, known).alias(f"_s{i}") for i, p in enumerate(properties)),
    )
    w = Window.partitionBy("item_id", "_b").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = left.unionByName(right, allowMissingColumns=True).select("*", *(F.last(f"_s{i}", ignorenulls=True).over(w).alias(f"_l{i}") for i in range(len(properties)))).where("_k = 1")
    return joined.select(*columns, *(c for i, out in enumerate(properties.values()) for c in (F.col(f"_l{i}.v").alias(out), F.col(f"_l{i}.f").alias(f"{out}_valid_from_ms"))))


def leaks(enriched: DataFrame, out: str = "category_id") -> DataFrame:
    """Rows enriched from the future; there must be none."""
    return enriched.where(F.col(f"{out}_valid_from_ms") > F.col("event_timestamp"))


def enrichment_breakdown(events: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row: joinable events, those whose item has no property, those before its first one, and the miss rate in percent."""
    first = snapshots.groupBy("item_id").agg(F.min("snapshot_ms").alias("first_ms"))
    found = events.join(first, "item_id", "left").agg(
        F.count("*").alias("events"), F.count_if(F.col("first_ms").isNull()).alias("no_property"),
        F.count_if(F.col("event_timestamp") < F.col("first_ms")).alias("before_first"), F.count_if(F.col("event_timestamp") >= F.col("first_ms")).alias("joinable"),
    )
    return found.withColumn("miss_rate_pct", F.when(F.col("events") > 0, F.round(100.0 * (F.col("events") - F.col("joinable")) / F.col("events"), 6)))
