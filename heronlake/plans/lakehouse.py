"""Full builds and bounded backfills over a table store; the same builders serve both."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions.contract import classify
from heronlake.functions.model import DEFAULT_BOUNDS, Bounds
from heronlake.operators import medallion as m
from heronlake.operators.scd import category_dimension, to_intervals
from heronlake.sources import files
from heronlake.sources.store import TableStore


def check_range(start: str | None, end: str | None) -> None:
    """Both or neither, in order: half a range would silently rebuild everything."""
    if (start is None) != (end is None):
        raise ValueError("give both a start date and an end date")
    if start is not None and not start < end:
        raise ValueError("the start date must be before the end date")


def together(*steps: Callable[[], object]) -> list:
    """Run steps that write different tables at the same time; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


def build_scd(store: TableStore, snapshots: DataFrame, categories: DataFrame) -> None:
    together(
        lambda: store.overwrite("dim_items_scd", to_intervals(snapshots), ["property"]),
        lambda: store.overwrite("dim_categories", category_dimension(categories)),
    )


def _put(store: TableStore, name: str, df: DataFrame, start: str | None, end: str | None) -> None:
    if start is None or not store.exists(name):
        store.overwrite(name, df, ["event_date"])
    else:
        store.replace_range(name, df, start, end)


def build_silver(store: TableStore, start: str | None = None, end: str | None = None, bounds: Bounds = DEFAULT_BOUNDS) -> dict:
    """Silver and its rejects from bronze, whole or for a range of days; rejects of other days stay."""
    check_range(start, end)
    bronze = m.in_range(store.read("bronze_events"), start, end)
    # deduplicated and classified once: a table of its own, which valid and rejected events are read from
    store.overwrite("silver_classified", classify(m.deduplicate(bronze), bounds))
    try:
        good, bad = m.split_silver(store.read("silver_classified"), store.read("dim_items_scd"), store.read("dim_categories"))
        together(lambda: _put(store, "silver_events", good, start, end), lambda: _put(store, "silver_rejected", bad, start, end))
    finally:
        store.drop("silver_classified")
    silver, rejected = together(*(lambda n=n: store.read(n).count() for n in ("silver_events", "silver_rejected")))
    return {"silver": silver, "rejected": rejected}


def build_gold(store: TableStore, start: str | None = None, end: str | None = None, provenance: bool = True) -> None:
    """Facts and the daily mart for the range, the global marts always from all of silver."""
    check_range(start, end)
    everything = store.read("silver_events")
    part = m.in_range(everything, start, end)
    together(
        lambda: _put(store, "fact_events", m.fact_events(part, provenance), start, end),
        lambda: _put(store, "fact_transactions", m.fact_transactions(part), start, end),
        lambda: _put(store, "mart_daily_item_metrics", m.daily_item_metrics(part), start, end),
        lambda: store.overwrite("mart_item_funnel", m.item_funnel(everything)),
        lambda: store.overwrite("mart_category_performance", m.category_performance(everything)),
    )


def backfill(store: TableStore, start: str, end: str, bounds: Bounds = DEFAULT_BOUNDS, snapshots: DataFrame | None = None, categories: DataFrame | None = None, gold: bool = True) -> dict:
    """Rebuild start <= day < end in silver and gold; bronze is only read. With snapshots the dimension is rebuilt first."""
    if start is None or end is None:
        raise ValueError("a backfill needs both dates")
    check_range(start, end)
    if snapshots is not None:
        build_scd(store, snapshots, categories)
    out = build_silver(store, start, end, bounds)
    if gold:
        build_gold(store, start, end)
    return out


def ingest_bronze(store: TableStore, events: DataFrame, batch: str | None = None) -> None:
    """Append events (with event_date) to bronze."""
    store.append("bronze_events", events, batch=batch, partition_by=["event_date"])


def export_silver(store: TableStore, folder: str) -> None:
    """All silver events as one CSV file in replay order: for hand-over to tools that read no tables."""
    files.export_csv(store.read("silver_events"), folder, ["event_timestamp", "source_row_number"])


def partition_benchmark(spark: SparkSession, store: TableStore, name: str, day: str, repeats: int = 3) -> dict:
    """Seconds and files of a one-day count on the partitioned table."""
    import time

    took = []
    frame = store.read(name).where(F.col("event_date") == F.lit(day).cast("date"))
    for _ in range(repeats):
        began = time.perf_counter()
        n = frame.count()
        took.append(time.perf_counter() - began)
    return {"rows": n, "median_s": sorted(took)[len(took) // 2], "files": len(store.read(name).inputFiles())}
