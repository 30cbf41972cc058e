"""Row numbers over long groups without one task for each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, group: list[str], order: list[str], bucket: Column, name: str) -> DataFrame:
    """rows with ``name``: the place (from 0) of each row in its group by ``order``.

    bucket must rise with the first column of order. Rows are numbered inside each (group, bucket), and the numbers of rows
    in the buckets before, from a table of one row a bucket, are added: a group of any length is spread over its buckets.
    """
    placed = rows.withColumn("_bucket", bucket)
    sizes = placed.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)) - 1
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.withColumn(name, inside).join(before, same)
    return joined.withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_bucket", "_b", "_before", *(f"_g{i}" for i in range(len(group))))
