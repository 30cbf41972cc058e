import pytest
from pyspark.sql import functions as F

from heronlake.sources import adapter, wire
from heronlake.streaming.chain import Chain, KeyValueView, deduplicated, drain, replay, write_view


def test_late_events_go_and_early_ones_stay(spark, tmp_path):
    """One file a batch; an event is late only two batches after the watermark passed it."""
    rows = [[("a", 0), ("b", 3600)], [("c", 7200), ("a", 0)], [("d", 7300)], [("late", 10), ("e", 7000)]]
    schema = "event_id string, s long"
    for i, r in enumerate(rows):
        spark.createDataFrame([(n, s + 100_000) for n, s in r], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b={i}")

    def run(mark, name):
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/b=*").withColumn("event_time", F.timestamp_seconds("s"))
        q = deduplicated(src, mark).writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/{name}-ck").trigger(availableNow=True).start()
        drain(q)
        return sorted(r["event_id"] for r in spark.read.schema("event_id string").parquet(f"{tmp_path}/{name}").collect())

    assert run("1 minute", "tight") == ["a", "b", "c", "d"]
    assert run("24 hours", "wide") == ["a", "b", "c", "d", "e", "late"]


def test_chain_resumes_and_serves(spark, sf_dir, tmp_path):
    events = adapter.raw_events(spark, sf_dir, True).where("event_timestamp > 0").limit(300)
    replay(events, f"{tmp_path}/log", 2)
    seen = {}
    view = KeyValueView(lambda k, v, ttl: seen.__setitem__(k, (v, ttl)))
    chain = Chain(spark, str(tmp_path / "lake"), [1], "40000 days", view=view)
    source = lambda: wire.stream_source(spark, f"{tmp_path}/log/batch=*")
    chain.run_available(source())
    first = chain.store.read("metrics").agg(F.sum("events")).first()[0]
    assert first == events.select("event_id").distinct().count()
    chain.run_available(source())  # nothing new: nothing changes
    assert chain.store.read("metrics").agg(F.sum("events")).first()[0] == first
    assert any(k.endswith(":latest") for k in seen) and all(ttl == 86_400 for k, (_, ttl) in seen.items() if not k.endswith(":latest"))
    write_view(view, str(tmp_path / "view.json"))


def test_wire_split_and_dead_letters(spark, sf_dir):
    envelope = wire.corrupt(wire.envelope_of(adapter.raw_events(spark, sf_dir, True)))
    good, bad = wire.split(envelope, [1])
    assert good.count() + bad.count() == envelope.count()
    routed = wire.route(envelope, [1], adapter.BOUNDS)
    assert {r["route"] for r in routed.select("route").distinct().collect()} == {"valid", "deserialization_failed", "unknown_schema_id", "validation_failed"}
    assert wire.dead_letters(routed).count() + routed.where("route = 'valid'").count() == envelope.count()
    assert wire.split(envelope, [])[0].count() == 0


def test_schema_registry():
    field = lambda name, type_, **more: {"name": name, "type": type_, **more}
    v1 = {"fields": [field("a", "string"), field("b", "int")]}
    v2 = {"fields": [*v1["fields"], field("c", ["null", "string"], default=None)]}
    v3 = {"fields": [field("a", "string"), field("b", "string")]}
    r = wire.SchemaRegistry()
    assert r.register("s", v1) == 1 and r.register("s", v2) == 2 and r.register("s", v1) == 1
    with pytest.raises(ValueError):
        r.register("s", v3)
    assert r.trusted_ids(["s"]) == [1, 2]
    with pytest.raises(ValueError):
        r.trusted_ids(["other"])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "Pacific/Auckland", "Europe/Berlin"])
def test_epoch_round_trip_in_any_zone(spark, zone):
    instants = [0, 1, 999, 1425790800000, 1433221332117, 1442545187788, 1445738400000, 1457852400000, 1709164799999, 1709164800000, 1711846800000, 4102444800000]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i,) for i in instants], "ms long").withColumn("t", F.timestamp_millis("ms"))
        assert [r["b"] for r in df.select(F.unix_millis("t").alias("b")).collect()] == instants
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
