import pytest
from pyspark.sql import functions as F

from heronlake.operators import fingerprint, medallion, pit, scd
from heronlake.plans import lakehouse
from heronlake.sources import adapter
from heronlake.sources.store import TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}")


def days(spark, *pairs):
    return spark.createDataFrame(list(pairs), "event_date string, x int").withColumn("event_date", F.to_date("event_date"))


def test_range_replace_drops_vanished_partitions_and_keeps_others(spark, store):
    store.overwrite("t", days(spark, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)), ["event_date"])
    before = {f for f in store.read("t").inputFiles() if "01-03" in f}
    store.replace_range("t", days(spark, ("2024-01-01", 10)).withColumn("y", F.lit(5)), "2024-01-01", "2024-01-03")
    assert sorted((str(r.event_date), r.x, r.y) for r in store.read("t").collect()) == [("2024-01-01", 10, 5), ("2024-01-03", 3, None)]
    assert before <= set(store.read("t").inputFiles())
    with pytest.raises(ValueError):
        store.replace_range("t", days(spark, ("2024-02-01", 1)), "2024-01-01", "2024-01-03")
    assert store.read("t", 0).count() == 3
    assert [h["operation"] for h in store.history("t")] == ["replace_range", "overwrite"]


def test_append_is_idempotent_by_batch_and_widens(spark, store):
    assert store.read_or_none("t") is None
    store.append("t", spark.range(3), batch="0")
    store.append("t", spark.range(3), batch="0")
    store.append("t", spark.range(1).withColumn("z", F.lit("q")), batch="1")
    assert store.read("t").count() == 4 and store.read("t").where("z is null").count() == 3
    with pytest.raises(ValueError):
        store.append("t", spark.range(1).select(F.lit("a").alias("id")))


def test_upsert(spark, store):
    store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    store.upsert("t", spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_intervals_ties_and_nulls(spark):
    snaps = spark.createDataFrame([(1, "p", "a", 10), (1, "p", "b", 10), (1, "p", "b", 20), (1, "p", None, 30), (1, "p", "b", 40)], "item_id long, property string, value string, snapshot_ms long")
    got = sorted(map(tuple, scd.to_intervals(snaps).collect()), key=lambda r: r[3])
    assert got == [(1, "p", "b", 10, 30, False), (1, "p", None, 30, 40, False), (1, "p", "b", 40, None, True)]


def test_backfill_touches_only_its_days_and_converges(spark, sf_dir, store):
    lakehouse.ingest_bronze(store, adapter.with_times(adapter.raw_events(spark, sf_dir, True)))
    lakehouse.build_scd(store, adapter.snapshots(adapter.raw_events(spark, sf_dir)), adapter.categories(spark, sf_dir))
    counts = lakehouse.build_silver(store, bounds=adapter.BOUNDS)
    assert counts["silver"] + counts["rejected"] == medallion.deduplicate(store.read("bronze_events")).count()
    lakehouse.build_gold(store)
    marks = lambda n: {str(r["event_date"]): tuple(r)[1:] for r in fingerprint.partition_fingerprints(store.read(n)).collect()}
    before = {n: marks(n) for n in ("silver_events", "silver_rejected", "fact_events", "mart_daily_item_metrics")}
    versions = len(store.history("bronze_events"))
    lakehouse.backfill(store, "2024-01-05", "2024-01-08", adapter.BOUNDS)
    assert before == {n: marks(n) for n in before}
    assert len(store.history("bronze_events")) == versions
    with pytest.raises(ValueError):
        lakehouse.build_silver(store, None, "2024-01-08")
    plan = store.read("fact_events").where("event_date = date'2024-01-06'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_point_in_time_never_fans_out_or_leaks(spark, sf_dir):
    events = adapter.raw_events(spark, sf_dir)
    intervals = scd.to_intervals(adapter.snapshots(events))
    out = pit.point_in_time_join(events, intervals, "categoryid", "category_id")
    assert out.count() == events.count() and pit.leaks(out).count() == 0
    other = pit.as_of_join(events, intervals, "categoryid", "category_id", buckets=3)
    assert out.select("event_id", "category_id").exceptAll(other.select("event_id", "category_id")).count() == 0


def test_fingerprint_sees_copies_but_not_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert fingerprint.table_fingerprint(a).first() == fingerprint.table_fingerprint(a.orderBy(F.desc("a"))).first()
    assert fingerprint.table_fingerprint(a).first() != fingerprint.table_fingerprint(a.unionAll(a)).first()
    assert fingerprint.reconcile(a, a, ["a"]).count() == 0
    assert fingerprint.reconcile(a, a.limit(1), ["a"]).count() == 1
