"""Profiles of raw events, properties and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events(rows: DataFrame) -> DataFrame:
    """One row: size, distinct keys (of each type, too), types and their shares in percent, null-rule violations and span."""
    kind, tx = F.col("event_type"), F.col("transaction_id")
    return rows.agg(
        F.count("*").alias("events"), F.count_distinct("visitor_id").alias("visitors"), F.count_distinct("item_id").alias("items"), F.count_distinct("transaction_id").alias("transaction_ids"),
        *(F.count_if(kind == t).alias(n) for t, n in (("view", "views"), ("addtocart", "carts"), ("transaction", "transactions"))),
        F.count_if((kind == "transaction") & tx.isNull()).alias("transactions_without_id"), F.count_if((kind != "transaction") & tx.isNotNull()).alias("others_with_id"),
        *(F.count_distinct(F.when(kind == t, F.col(c))).alias(f"{n}_{of}") for t, n in (("view", "view"), ("addtocart", "cart"), ("transaction", "transaction")) for c, of in (("visitor_id", "visitors"), ("item_id", "items"))),
        *(F.round(100.0 * F.count_if(kind == t) / F.count("*"), 6).alias(f"{n}_pct") for t, n in (("view", "view"), ("addtocart", "cart"), ("transaction", "transaction"))),
        F.min("event_timestamp").alias("first_ms"), F.max("event_timestamp").alias("last_ms"), F.round((F.max("event_timestamp") - F.min("event_timestamp")) / 86_400_000.0, 6).alias("span_days"),
    )


def updates_per_item(snapshots: DataFrame) -> DataFrame:
    """One row: items with properties, their updates, and updates of an item on average, in the middle and at most."""
    per = snapshots.groupBy("item_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("items"), F.sum("n").alias("updates"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.percentile("n", 0.5), 6).alias("median"), F.max("n").alias("most"))


def duplicate_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: groups of equal rows and rows beyond the first of each."""
    same = rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
    return same.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"))


def interaction_histogram(rows: DataFrame, key: str = "visitor_id") -> DataFrame:
    """Keys by number of events: exactly 1, 2, 3, 5, 10, and at least 2, 5, 10, 20."""
    per = rows.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("keys"), *(F.count_if(F.col("n") == k).alias(f"exactly_{k}") for k in (1, 2, 3, 5, 10)), *(F.count_if(F.col("n") >= k).alias(f"at_least_{k}") for k in (2, 5, 10, 20)))


def per_visitor(rows: DataFrame) -> DataFrame:
    """One row: mean, median, 95th percentile and maximum of the events of a visitor."""
    per = rows.groupBy("visitor_id").agg(F.count("*").alias("n"))
    return per.agg(F.round(F.avg("n"), 6).alias("mean"), F.round(F.percentile("n", 0.5), 6).alias("median"), F.round(F.percentile("n", 0.95), 6).alias("p95"), F.max("n").alias("max"))


def repeat_pairs(rows: DataFrame) -> DataFrame:
    """One row: (visitor, item) pairs and those met more than once."""
    per = rows.groupBy("visitor_id", "item_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("pairs"), F.count_if(F.col("n") > 1).alias("repeated"), F.max("n").alias("most"))


def eligibility(rows: DataFrame, levels: tuple[int, ...] = (2, 3, 5, 10, 20)) -> DataFrame:
    """For each minimum history: visitors that have it and the events they made."""
    per = rows.groupBy("visitor_id").agg(F.count("*").alias("n"))
    wide = per.agg(*(F.struct(F.lit(k).alias("min_history"), F.count_if(F.col("n") >= k).alias("visitors"), F.coalesce(F.sum(F.when(F.col("n") >= k, F.col("n"))), F.lit(0)).alias("events")).alias(f"k{k}") for k in levels))
    return wide.select(F.explode(F.array(*(F.col(f"k{k}") for k in levels))).alias("r")).select("r.*")


def transaction_reality(rows: DataFrame) -> DataFrame:
    """One row: transaction lines, ids, lines of an id on average and at most, and visitors that ever transact in percent."""
    lines = rows.where("event_type = 'transaction'").groupBy("transaction_id").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("items"))
    size = lines.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count("*").alias("ids"), F.round(F.avg("n"), 6).alias("lines_per_id"), F.max("items").alias("most_items"))
    people = rows.groupBy("visitor_id").agg(F.max(F.when(F.col("event_type") == "transaction", 1).otherwise(0)).alias("buys"))
    share = people.agg(F.round(100.0 * F.avg("buys"), 6).alias("visitors_transacting_pct"))
    return size.withColumn("visitors_transacting_pct", share.scalar())


def property_topk(snapshots: DataFrame, k: int = 20) -> DataFrame:
    """The most updated properties, ties by name: (property, value) pairs by rows and items."""
    return snapshots.groupBy("property", "value").agg(F.count("*").alias("updates"), F.count_distinct("item_id").alias("items")).orderBy(F.desc("updates"), "property", "value").limit(k)


def category_tree(categories: DataFrame) -> DataFrame:
    """One row: categories, roots (no parent), and parents that are no category themselves."""
    parents = categories.where("parent_id is not null").select(F.col("parent_id").alias("category_id")).distinct()
    orphans = parents.join(categories.select("category_id"), "category_id", "left_anti").agg(F.count("*").alias("orphan_parents"))
    return categories.agg(F.count("*").alias("categories"), F.count_if(F.col("parent_id").isNull()).alias("roots"), F.count_distinct("parent_id").alias("parents")).withColumn("orphan_parents", orphans.scalar())


def items_without_properties(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    return rows.select("item_id").distinct().join(snapshots.select("item_id").distinct(), "item_id", "left_anti")


def items_with_properties(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    return rows.select("item_id").distinct().join(snapshots.select("item_id"), "item_id", "left_semi")


def first_seen(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Each event with the first time its item had a property."""
    return rows.join(snapshots.groupBy("item_id").agg(F.min("snapshot_ms").alias("first_ms")), "item_id", "left").select("event_id", "item_id", "first_ms")
