"""Order-free fingerprints of tables: equal rows in any order and any layout give equal numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLATILE = ("run_label", "batch_id", "processed_at", "failed_at")


def row_text(df: DataFrame, exclude: tuple[str, ...] = VOLATILE) -> Column:
    """All columns but the volatile ones, by name, nulls as ~."""
    return F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in sorted(df.columns) if c not in exclude))


def row_hash(df: DataFrame, exclude: tuple[str, ...] = VOLATILE, portable: bool = False) -> Column:
    """64-bit hash of a row: xxhash64, or 60 bits of MD5, which other engines compute alike."""
    text = row_text(df, exclude)
    return (F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("decimal(38,0)") if portable else F.xxhash64(text).cast("decimal(38,0)"))


def table_fingerprint(df: DataFrame, exclude: tuple[str, ...] = VOLATILE, portable: bool = False) -> DataFrame:
    """One row: row count and the sum of the row hashes; a sum, unlike xor, sees repeated rows."""
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(row_hash(df, exclude, portable)), F.lit(0)).cast("string").alias("fingerprint"))


def partition_fingerprints(df: DataFrame, by: str = "event_date", exclude: tuple[str, ...] = VOLATILE, portable: bool = False) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("row_count"), F.sum(row_hash(df, exclude, portable)).cast("string").alias("fingerprint"))


def column_propagation(df: DataFrame, column: str, by: str = "event_date") -> DataFrame:
    """For each partition: rows, rows with the new column, rows with a category."""
    return df.groupBy(by).agg(F.count("*").alias("row_count"), F.count(column).alias("rows_with_column"), F.count("category_id").alias("rows_with_category"))


def reconcile(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys on which two tables differ, missing ones included; none where they agree."""
    values = [c for c in left.columns if c not in key]
    a = left.select(*key, F.struct(*values).alias("_l"))
    b = right.select(*key, F.struct(*values).alias("_r"))
    return a.join(b, key, "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select(*key, F.col("_l").isNotNull().alias("in_left"), F.col("_r").isNotNull().alias("in_right"))


def merge_expectation(wanted: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Every key of either table with its status: equal, differs, missing (only wanted) or unexpected (only found)."""
    values = [c for c in wanted.columns if c not in key]
    a = wanted.select(*key, F.struct(*values).alias("_w"))
    b = found.select(*key, F.struct(*values).alias("_f"))
    status = F.when(F.col("_f").isNull(), "missing").when(F.col("_w").isNull(), "unexpected").when(F.col("_w").eqNullSafe(F.col("_f")), "equal").otherwise("differs")
    return a.join(b, key, "full_outer").select(*key, status.alias("status"))
