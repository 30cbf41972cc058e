"""CSV files, the command line and the seeded replay, end to end."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from heronlake.plans import cli
from heronlake.sources import adapter, files, simulate, wire
from heronlake.sources.store import TableStore
from heronlake.streaming.chain import Chain, KeyValueView, replay, watch

DAY = 86_400_000
FIRST = 1431302400000  # 2015-05-11, inside the contract's bounds


def _write(path, head, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(head)
        w.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def csvs(tmp_path_factory):
    at, r = tmp_path_factory.mktemp("csv"), random.Random(3)
    events = []
    for i in range(400):
        kind = r.choice(["view"] * 6 + ["addtocart", "transaction"])
        events.append((FIRST + r.randrange(6 * DAY), r.randrange(40), kind, r.randrange(30), f"{r.randrange(50)}.0" if kind == "transaction" else ""))
    events += [events[0], events[1]]  # equal rows are different events
    properties = [(FIRST + w * DAY, i, p, v) for i in range(25) for w in (0, 2) for p, v in (("categoryid", str(r.randrange(5))), ("available", str(r.randrange(2))), ("888", "n1 n2"))]
    return {
        "events": _write(at / "events.csv", ["timestamp", "visitorid", "event", "itemid", "transactionid"], events), "rows": events,
        "parts": [_write(at / f"p{k}.csv", ["timestamp", "itemid", "property", "value"], properties[k::2]) for k in range(2)], "properties": properties,
        "tree": _write(at / "tree.csv", ["categoryid", "parentid"], [(0, ""), (1, 0), (2, 0), (3, 1), ("x", 9)]),
    }


def test_csv_sources(spark, csvs):
    got = files.item_properties(spark, csvs["parts"], ("categoryid", "available"))
    assert sorted(map(tuple, got.collect())) == sorted((i, p, v, t) for t, i, p, v in csvs["properties"] if p != "888")
    assert files.item_properties(spark, csvs["parts"]).count() == len(csvs["properties"])
    assert sorted(map(tuple, files.category_tree(spark, csvs["tree"]).collect()), key=str) == sorted([(0, None), (1, 0), (2, 0), (3, 1), (None, 9)], key=str)
    plan = got.select("item_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<itemid:string,property:string>" in plan  # only what is asked for is parsed


def test_csv_rows_are_numbered_in_file_order(spark, csvs):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many byte ranges
    try:
        rows = sorted(files.event_rows(spark, csvs["events"]).select("source_row_number", "event_timestamp", "visitor_id", "event_type", "item_id").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in rows] == [(i, *r[:4]) for i, r in enumerate(csvs["rows"])]
    assert files.clickstream(spark, csvs["events"]).select("event_id").distinct().count() == len(csvs["rows"])


def test_command_line(spark, csvs, tmp_path):
    root = str(tmp_path / "lake")
    cli.main(["--root", root, "bronze", "--events", csvs["events"]])
    cli.main(["--root", root, "lakehouse", "--properties", *csvs["parts"], "--categories", csvs["tree"]])
    store = TableStore(spark, root)
    assert store.read("silver_events").count() == len(csvs["rows"]) and store.read("fact_events").count() == len(csvs["rows"])
    assert {"category_known_since_ms", "category_age_at_event_ms", "event_time"} <= set(store.read("fact_events").columns)
    before = {n: sorted(map(str, store.read(n).collect())) for n in ("silver_events", "fact_events", "mart_item_funnel")}
    cli.main(["--root", root, "backfill", "--start-date", "2015-05-12", "--end-date", "2015-05-14", "--rebuild-scd", "--properties", *csvs["parts"], "--categories", csvs["tree"], "--out", str(tmp_path / "report.json")])
    assert before == {n: sorted(map(str, store.read(n).collect())) for n in before}
    assert json.load(open(tmp_path / "report.json"))["rebuild_scd"]
    with pytest.raises(SystemExit):
        cli.main(["--root", root, "backfill", "--start-date", "2015-05-12", "--end-date", "2015-05-14", "--rebuild-scd"])
    for name, *more in (("scd", "--properties", *csvs["parts"], "--categories", csvs["tree"]), ("silver",), ("gold", "--legacy-schema"), ("partition-benchmark", "--target-date", "2015-05-13", "--repeats", "1")):
        cli.main(["--root", root, name, *more])
    assert "category_known_since_ms" not in store.read("fact_events").columns  # the schema shrinks
    cli.main(["--root", root, "export", "--out", str(tmp_path / "silver")])
    [path] = (tmp_path / "silver").glob("*.csv")
    out = list(csv.DictReader(open(path)))
    assert len(out) == len(csvs["rows"]) and [int(r["event_timestamp"]) for r in out] == sorted(int(r["event_timestamp"]) for r in out)


def test_command_line_stream(spark, csvs, tmp_path):
    sim = ["--root", "-", "simulate", "--events", csvs["events"], "--seed", "5", "--duplicate-rate", "0.1", "--malformed-rate", "0.05", "--delay-rate", "0.1"]
    cli.main([*sim, "--out", str(tmp_path / "log"), "--batches", "3"])
    cli.main([*sim, "--out", str(tmp_path / "lines"), "--dry-run"])
    [path] = (tmp_path / "lines").glob("*.txt")
    lines = [json.loads(x) for x in open(path, errors="replace")]
    log = spark.read.parquet(str(tmp_path / "log"))
    assert len(lines) == log.count() > len(csvs["rows"]) and {x["topic"] for x in lines} == {"events_view", "events_addtocart", "events_transaction"}
    cli.main(["--root", str(tmp_path / "lake"), "stream", "--source", f"{tmp_path}/log/batch=*", "--max-per-trigger", "1", "--watermark", "40000 days", "--run-label", "r1", "--view", str(tmp_path / "view.json")])
    store = TableStore(spark, str(tmp_path / "lake/tables"))
    planned = simulate.plan(files.clickstream(spark, csvs["events"]), 5, 0.1, 0.05, 0.1)
    bad = planned.where("corruption in ('raw_garbage', 'unknown_schema_id')").count()
    assert store.read("undecodable").count() == bad > 0
    assert all(k.startswith("metrics:r1:") for k in json.load(open(tmp_path / "view.json")))


def test_replay_is_seeded(spark, sf_dir):
    events = adapter.raw_events(spark, sf_dir)
    rows = lambda seed, df: sorted(map(str, simulate.emit(simulate.plan(df, seed, 0.05, 0.05, 0.1), seed).drop("timestamp").collect()))
    assert rows(1, events) == rows(1, events.repartition(7)) != rows(2, events)
    planned = simulate.plan(events, 1, 0.05, 0.05, 0.1, 20).collect()
    assert sorted(r["place"] for r in planned) == list(range(len(planned)))
    assert 0.02 < sum(r["copy"] for r in planned) / events.count() < 0.09
    assert all(0 <= r["shift"] <= 20 for r in planned) and {r["corruption"] for r in planned} == {None, *simulate.CORRUPTIONS}
    plain = simulate.plan(events, 1).orderBy("place").select("event_timestamp", "source_row_number").collect()
    assert plain == sorted(plain)


def test_replay_files_are_read_in_order(spark, sf_dir, tmp_path):
    replay(adapter.raw_events(spark, sf_dir), f"{tmp_path}/log", 4)
    seen = []
    q = wire.stream_source(spark, f"{tmp_path}/log/batch=*", max_per_trigger=1).writeStream.foreachBatch(lambda df, i: seen.append(df.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first())).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == 4 and sum(r[2] for r in seen) == 1000 and all(a[1] <= b[0] for a, b in zip(seen, seen[1:]))


def test_killed_chain_goes_on_where_it_was(spark, sf_dir, tmp_path, monkeypatch):
    """A sink dies in the middle; a new chain over the same folders ends with what an undisturbed one has."""
    events = adapter.raw_events(spark, sf_dir, True).where("event_timestamp > 0")
    replay(events, f"{tmp_path}/log", 4)
    source = lambda: wire.stream_source(spark, f"{tmp_path}/log/batch=*", max_per_trigger=1)

    split, calls = wire.split, []

    def dies(*given):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return split(*given)

    monkeypatch.setattr(wire, "split", dies)
    with pytest.raises(Exception, match="killed"):
        Chain(spark, f"{tmp_path}/a", [1], "40000 days").run_available(source())
    monkeypatch.setattr(wire, "split", split)
    rest = Chain(spark, f"{tmp_path}/a", [1], "40000 days")
    rest.run_available(source())
    calm = Chain(spark, f"{tmp_path}/b", [1], "40000 days")
    calm.run_available(source())
    rows = lambda c: sorted(map(str, c.store.read("metrics").select("window_start", "events", "views", "carts", "transactions").collect()))
    assert rows(rest) == rows(calm) and spark.read.parquet(rest.deduped_path()).count() == spark.read.parquet(calm.deduped_path()).count()


def test_live_run_ends_when_idle_or_late(spark, sf_dir, tmp_path):
    replay(adapter.raw_events(spark, sf_dir).limit(200), f"{tmp_path}/log", 2)
    chain = Chain(spark, f"{tmp_path}/a", [1], "40000 days")
    assert chain.run_live(wire.stream_source(spark, f"{tmp_path}/log/batch=*"), 90, idle_seconds=8) == "idle"
    assert chain.store.read("metrics").agg(F.sum("events")).first()[0] == 200
    rate = lambda: spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck").start()
    assert watch([rate()], 4, idle_seconds=60) == "deadline"
    dead = rate()
    dead.stop()
    with pytest.raises(RuntimeError):
        watch([dead], 30, 30)


def test_upsert_rewrites_only_touched_files(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}")
    rows = lambda *r: spark.createDataFrame(r, "k int, v string").coalesce(1)
    for i in range(4):
        store.upsert("t", rows((i, f"v{i}")), ["k"], batch=str(i))
    before = set(store.read("t").inputFiles())
    store.upsert("t", rows((2, "a"), (2, "b"), (9, "n")), ["k"], batch="x")
    store.upsert("t", rows((2, "z")), ["k"], batch="x")  # the same batch again
    assert sorted(map(tuple, store.read("t").collect())) == [(0, "v0"), (1, "v1"), (2, "b"), (3, "v3"), (9, "n")]
    assert len(before & set(store.read("t").inputFiles())) == 3
    store.upsert("t", rows((None, "p")), ["k"])
    store.upsert("t", rows((None, "q")), ["k"])
    assert [r["v"] for r in store.read("t").where("k is null").collect()] == ["q"]


def test_view_gives_the_top_windows():
    view = KeyValueView()
    view.kept = {"metrics:live:a": {"events": "3"}, "metrics:live:b": {"events": "7"}, "metrics:live:latest": {"events": "9"}, "metrics:x:c": {"events": "8"}, "metrics:live:d": {"events": None}}
    assert view.top() == [("metrics:live:b", 7.0)] and view.top(k=5) == [("metrics:live:b", 7.0), ("metrics:live:a", 3.0)]


def test_optional_formats_say_what_they_need(spark):
    from heronlake.functions.model import ENVELOPE

    empty = spark.createDataFrame([], ENVELOPE)
    with pytest.raises(RuntimeError, match="spark-avro"):
        wire.decode(empty, avro_schema='{"type": "record", "name": "r", "fields": []}').collect()
    with pytest.raises(Exception, match="(?i)kafka"):
        wire.stream_source(spark, bootstrap="localhost:1", topics=["t"])
