"""Command line: bronze, scd, silver, gold, backfill, lakehouse, stream, simulate, export and partition-benchmark."""

from __future__ import annotations

import argparse
import sys

from heronlake.functions.model import DEFAULT_BOUNDS
from heronlake.plans import lakehouse
from heronlake.session import session
from heronlake.sources import adapter, files
from heronlake.sources.store import TableStore


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="heronlake", description=__doc__)
    p.add_argument("--root", required=True, help="folder of the table store")
    sub = p.add_subparsers(dest="command", required=True)
    scd = sub.add_parser("scd")
    scd.add_argument("--properties", nargs="+", required=True)
    scd.add_argument("--categories", required=True)
    for name in ("silver", "gold", "backfill"):
        c = sub.add_parser(name)
        c.add_argument("--start-date", required=name == "backfill")
        c.add_argument("--end-date", required=name == "backfill")
        if name == "gold":
            c.add_argument("--legacy-schema", action="store_true")
        if name == "backfill":
            c.add_argument("--skip-gold", action="store_true")
            c.add_argument("--rebuild-scd", action="store_true", help="also rebuild the dimension, from --properties and --categories")
            c.add_argument("--properties", nargs="+")
            c.add_argument("--categories")
            c.add_argument("--out", help="JSON report")
    lake = sub.add_parser("lakehouse")
    lake.add_argument("--properties", nargs="+", required=True)
    lake.add_argument("--categories", required=True)
    stream = sub.add_parser("stream")
    stream.add_argument("--source", help="folder of envelope files")
    stream.add_argument("--bootstrap", help="broker, where its connector is installed")
    stream.add_argument("--topics", nargs="*", default=["events_view", "events_addtocart", "events_transaction"])
    stream.add_argument("--registry", help="JSON registry of trusted schemas")
    stream.add_argument("--starting-offsets", default="earliest")
    stream.add_argument("--allow-data-loss", action="store_true")
    stream.add_argument("--window", default="5 minutes")
    stream.add_argument("--watermark", default="24 hours")
    stream.add_argument("--no-dedup", action="store_true")
    stream.add_argument("--max-per-trigger", type=int)
    stream.add_argument("--run-label", default="live")
    stream.add_argument("--await-seconds", type=float, help="run until this deadline instead of working off what is there")
    stream.add_argument("--idle-seconds", type=float, default=30.0, help="with --await-seconds: end earlier when nothing came for so long")
    stream.add_argument("--view", help="JSON file for the key-value view")
    bronze = sub.add_parser("bronze")
    bronze.add_argument("--events", required=True, help="clickstream CSV")
    export = sub.add_parser("export")
    export.add_argument("--out", required=True, help="folder of the CSV file")
    sim = sub.add_parser("simulate")
    sim.add_argument("--events", required=True, help="Parquet events with identity columns, or a clickstream CSV (by its ending)")
    sim.add_argument("--out", required=True)
    sim.add_argument("--start-row", type=int, default=0)
    sim.add_argument("--limit", type=int)
    sim.add_argument("--batches", type=int, default=10)
    sim.add_argument("--seed", type=int, default=42)
    for rate in ("duplicate", "malformed", "delay"):
        sim.add_argument(f"--{rate}-rate", type=float, default=0.0)
    sim.add_argument("--max-delay-positions", type=int, default=50)
    sim.add_argument("--dry-run", action="store_true", help="write JSON lines instead of envelope files")
    bench = sub.add_parser("partition-benchmark")
    bench.add_argument("--target-date", required=True)
    bench.add_argument("--repeats", type=int, default=5)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    store = TableStore(spark, a.root)
    if a.command in ("scd", "lakehouse"):
        lakehouse.build_scd(store, files.item_properties(spark, a.properties, ("categoryid", "available")), files.category_tree(spark, a.categories))
    if a.command in ("silver", "lakehouse"):
        print(lakehouse.build_silver(store, getattr(a, "start_date", None), getattr(a, "end_date", None), DEFAULT_BOUNDS))
    if a.command in ("gold", "lakehouse"):
        lakehouse.build_gold(store, getattr(a, "start_date", None), getattr(a, "end_date", None), not getattr(a, "legacy_schema", False))
    if a.command == "backfill":
        if a.rebuild_scd and not (a.properties and a.categories):
            raise SystemExit("--rebuild-scd needs --properties and --categories")
        rebuilt = (files.item_properties(spark, a.properties, ("categoryid", "available")), files.category_tree(spark, a.categories)) if a.rebuild_scd else (None, None)
        report = lakehouse.backfill(store, a.start_date, a.end_date, snapshots=rebuilt[0], categories=rebuilt[1], gold=not a.skip_gold)
        print(report)
        if a.out:
            files.write_report(report | {"start_date": a.start_date, "end_date": a.end_date, "rebuild_scd": a.rebuild_scd, "skip_gold": a.skip_gold}, a.out)
    if a.command == "bronze":
        lakehouse.ingest_bronze(store, adapter.with_times(files.clickstream(spark, a.events)))
    if a.command == "export":
        lakehouse.export_silver(store, a.out)
    if a.command == "stream":
        from heronlake.sources.wire import SchemaRegistry, stream_source
        from heronlake.streaming.chain import Chain, KeyValueView, write_view

        ids = SchemaRegistry.load(a.registry).trusted_ids([f"{t}-value" for t in a.topics]) if a.registry else [1]
        chain = Chain(spark, a.root, ids, a.watermark, a.window, not a.no_dedup, KeyValueView(), a.run_label)
        source = stream_source(spark, a.source, a.bootstrap, a.topics, a.starting_offsets, a.max_per_trigger, not a.allow_data_loss)
        print(chain.run_live(source, a.await_seconds, a.idle_seconds) if a.await_seconds else chain.run_available(source))
        if a.view:
            write_view(chain.view, a.view)
    if a.command == "simulate":
        from heronlake.sources import simulate
        from heronlake.streaming.chain import replay

        events = files.clickstream(spark, a.events) if a.events.endswith(".csv") else spark.read.parquet(a.events)
        if a.start_row or a.limit is not None:
            events = files.replay_slice(events, a.start_row, a.limit)
        envelopes = simulate.emit(simulate.plan(events, a.seed, a.duplicate_rate, a.malformed_rate, a.delay_rate, a.max_delay_positions), a.seed)
        simulate.dry_run(envelopes, a.out) if a.dry_run else replay(envelopes, a.out, a.batches, "place")
    if a.command == "partition-benchmark":
        print(lakehouse.partition_benchmark(spark, store, "fact_events", a.target_date, a.repeats))
    return 0


if __name__ == "__main__":
    sys.exit(main())
