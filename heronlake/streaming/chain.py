"""The live path: raw log to bronze, deduplicated events and window metrics, as three chained queries.

Each query has at most one stateful operator and its own checkpoint; tables join them. Sinks are idempotent by batch id.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heronlake.operators.medallion import windowed_metrics
from heronlake.operators.numbering import numbered
from heronlake.sources import adapter, wire
from heronlake.sources.store import TableStore

TOP_WINDOWS = 50
TTL_SECONDS = 86_400


def deduplicated(events: DataFrame, watermark: str = "24 hours") -> DataFrame:
    """Drop repeats of (event_id, event_time); state is forgotten, and later events are dropped, beyond the watermark."""
    return events.withWatermark("event_time", watermark).dropDuplicates(["event_id", "event_time"])


@dataclass
class KeyValueView:
    """A serving view: a hash for each window with a time to live, and the newest window of each batch.

    put(key, values, ttl) may write to any key-value service; by default values are kept in memory.
    """

    put: Callable[[str, dict, int | None], None] | None = None

    def __post_init__(self) -> None:
        self.kept: dict[str, dict] = {}

    def publish(self, windows: DataFrame, run_label: str = "live") -> int:
        """Publish the newest TOP_WINDOWS windows of a batch; keys carry the run, so runs do not mix."""
        rows = windows.orderBy(F.desc("window_start")).limit(TOP_WINDOWS).collect()
        for i, r in enumerate(rows):
            values = {k: v if v is None else str(v) for k, v in r.asDict().items()}
            self._put(f"metrics:{run_label}:{r['window_start'].isoformat()}", values, TTL_SECONDS)
            if i == 0:
                self._put(f"metrics:{run_label}:latest", values, None)
        return len(rows)

    def top(self, by: str = "events", k: int = 1, run_label: str = "live") -> list[tuple[str, float]]:
        """The k windows of a run with the greatest value, as a sorted set gives them: (key, value), ties by key."""
        held = [(key, float(v[by])) for key, v in self.kept.items() if key.startswith(f"metrics:{run_label}:") and not key.endswith(":latest") and v.get(by) is not None]
        return sorted(held, key=lambda x: (-x[1], x[0]))[:k]

    def _put(self, key: str, values: dict, ttl: int | None) -> None:
        self.kept[key] = values
        if self.put:
            self.put(key, values, ttl)


class Chain:
    """The three queries over one source folder (or broker) and one table store."""

    def __init__(self, spark: SparkSession, root: str, trusted_ids: list[int] | None = (1,), watermark: str = "24 hours", window: str = "5 minutes", deduplicate: bool = True, view: KeyValueView | None = None, run_label: str = "live"):
        self.run_label = run_label
        self.spark, self.root = spark, root.rstrip("/")
        self.store = TableStore(spark, f"{self.root}/tables")
        self.trusted_ids = None if trusted_ids is None else list(trusted_ids)
        self.watermark, self.window, self.deduplicate, self.view = watermark, window, deduplicate, view

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def bronze_path(self) -> str:
        return f"{self.root}/stream/bronze_events"

    def deduped_path(self) -> str:
        return f"{self.root}/stream/deduped_events"

    def bronze_schema(self):
        return wire.flatten(wire.split(self.spark.createDataFrame([], wire_envelope()), self.trusted_ids)[0]).schema

    def raw_to_bronze(self, source: DataFrame, **trigger) -> StreamingQuery:
        """Decoded records to bronze by date, the others whole to ``undecodable``; a repeated batch writes the same folder."""

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                good, bad = wire.split(batch, self.trusted_ids)
                wire.flatten(good).write.mode("overwrite").partitionBy("event_date").parquet(f"{self.bronze_path()}/batch_id={batch_id}")
                if not bad.isEmpty():
                    self.store.append("undecodable", bad.select("value", "topic", "partition", "offset", "status", F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("seen_at")), batch=f"raw-{batch_id}")
            finally:
                batch.unpersist()

        return source.writeStream.queryName("raw_to_bronze").option("checkpointLocation", self._checkpoint("raw")).trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()

    def bronze_to_deduped(self, max_files: int | None = None, **trigger) -> StreamingQuery:
        r = self.spark.readStream.schema(self.bronze_schema())
        r = r.option("maxFilesPerTrigger", max_files) if max_files else r
        events = r.parquet(f"{self.bronze_path()}/batch_id=*/event_date=*").withColumn("event_date", F.to_date("event_time"))
        # a date's rows go to an eighth of the tasks, so a batch writes few files a date, and no date is one task on a large cluster
        spread = F.pmod(F.xxhash64("event_id"), F.lit(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8)))
        return deduplicated(events, self.watermark).repartition("event_date", spread).writeStream.queryName("deduped_events").format("parquet").option("path", self.deduped_path()).option("checkpointLocation", self._checkpoint("deduped")).partitionBy("event_date").trigger(**(trigger or {"availableNow": True})).outputMode("append").start()

    def to_metrics(self, **trigger) -> StreamingQuery:
        """Window metrics in update mode: the last value of a window wins. No watermark: a replayed log is finite."""
        path = self.deduped_path() if self.deduplicate else f"{self.bronze_path()}/batch_id=*/event_date=*"
        events = self.spark.readStream.schema(self.bronze_schema()).parquet(path)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                if not batch.isEmpty():
                    self.store.upsert("metrics", batch, ["window_start"], batch=f"metrics-{batch_id}")
                    if self.view:
                        self.view.publish(batch, self.run_label)
            finally:
                batch.unpersist()

        return windowed_metrics(events, self.window).writeStream.queryName("window_metrics").option("checkpointLocation", self._checkpoint("metrics")).trigger(**(trigger or {"availableNow": True})).outputMode("update").foreachBatch(write).start()

    def run_live(self, source: DataFrame, seconds: float, idle_seconds: float = 30.0, interval: str = "1 second") -> str:
        """All queries at once until nothing came for idle_seconds ("idle") or seconds are over ("deadline"); a dead query raises."""
        trigger = {"processingTime": interval}
        fs, bronze = self.store._fs(self.bronze_path()), self.store._path(self.bronze_path())
        fs.mkdirs(bronze)
        fs.mkdirs(self.store._path(self.deduped_path()))
        queries = [self.raw_to_bronze(source, **trigger)] + ([self.bronze_to_deduped(**trigger)] if self.deduplicate else []) + [self.to_metrics(**trigger)]
        return watch(queries, seconds, idle_seconds)

    def run_available(self, source: DataFrame) -> dict[str, int]:
        """Work off what is there, stage by stage; a failed query raises. Returns the rows that each read."""
        out = {}
        for name, start in (("raw_to_bronze", lambda: self.raw_to_bronze(source)), ("deduped_events", self.bronze_to_deduped), ("window_metrics", self.to_metrics)):
            if name == "deduped_events" and not self.deduplicate:
                continue
            out[name] = drain(start())
        return out


def drain(query: StreamingQuery, seconds: float | None = None) -> int:
    """Wait for a bounded query, raise its failure, and return the rows that it read."""
    finished = query.awaitTermination(seconds) if seconds else query.awaitTermination() or True
    if query.exception() is not None:
        raise query.exception()
    if not finished:
        query.stop()
        raise TimeoutError(f"{query.name} did not end in {seconds} s")
    return sum(p["numInputRows"] for p in query.recentProgress)


def watch(queries: list[StreamingQuery], seconds: float, idle_seconds: float, poll: float = 0.5) -> str:
    """Wait until no query has finished a batch with rows for idle_seconds, or seconds are over; then stop all of them."""
    began = moved = time.monotonic()
    seen: dict = {}
    try:
        while True:
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
                if not q.isActive:
                    raise RuntimeError(f"{q.name} has ended")
                last = q.lastProgress
                if last and last["numInputRows"] and seen.get(q.id) != last["batchId"]:
                    seen[q.id], moved = last["batchId"], time.monotonic()
            now = time.monotonic()
            if now - began >= seconds:
                return "deadline"
            if now - moved >= idle_seconds and not any(q.status["isTriggerActive"] and q.status["isDataAvailable"] for q in queries):
                return "idle"
            time.sleep(poll)
    finally:
        for q in queries:
            q.stop()


def wire_envelope():
    from heronlake.functions.model import ENVELOPE

    return ENVELOPE


def replay(events: DataFrame, folder: str, batches: int, position: str | None = None) -> None:
    """Write events as envelope files in replay order, one file a micro-batch: the stand-in for a producer.

    Replay order is (event time, source row, offset), or a column of places from 0. Events are numbered and written once,
    dealt to their batches; files get the times at which readers, who take the oldest first, see batches in order. events
    that already are envelopes keep their values.
    """
    spark = events.sparkSession
    given = events.persist()  # read more than once below, and perhaps not the same each time
    if position is None:
        events = numbered(events, [], ["event_timestamp", "source_row_number", "source_offset"], F.floor(F.col("event_timestamp") / adapter.BUCKET_MS), "_place")
        position = "_place"
    total = events.agg(F.max(position)).first()[0]
    step = max(1, -(-(0 if total is None else total + 1) // batches))
    rows = events if "value" in events.columns else wire.envelope_of(events, more=[position])
    named = rows.withColumn("batch", F.format_string("%05d", F.floor(F.col(position) / step))).drop(position)
    named.repartition(batches, "batch").write.mode("overwrite").partitionBy("batch").parquet(folder)
    given.unpersist()
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    now = int(time.time() * 1000) - 1000 * (batches + 1)
    for k in range(batches):
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={k:05d}")
        if fs.exists(part):
            for f in fs.listStatus(part):
                fs.setTimes(f.getPath(), now + 1000 * k, -1)


def write_view(view: KeyValueView, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as f:
        json.dump(view.kept, f, indent=1)
