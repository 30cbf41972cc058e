"""A seeded replay: duplicates, malformed records and delays, decided by hashes, so every run and every layout agrees.

Each decision about an event is a number in [0, 1) from MD5 of (seed, what is decided, event id); nothing is drawn in turn,
so no row waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.operators.numbering import numbered
from heronlake.sources import adapter, wire

CORRUPTIONS = ("raw_garbage", "unknown_schema_id", "invalid_field")
INVALID_FIELDS = ("negative_visitor", "zero_timestamp", "orphan_transaction_id")
#: Places in one bucket of the emission order.
BUCKET_PLACES = 1_000_000


def draw(seed: int, what: str, key: Column) -> Column:
    """A number in [0, 1) for a key: 48 bits of MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(what), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def pick(seed: int, what: str, key: Column, choices: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), (F.floor(draw(seed, what, key) * len(choices)) + 1).cast("int"))


def plan(events: DataFrame, seed: int = 42, duplicate_rate: float = 0.0, malformed_rate: float = 0.0, delay_rate: float = 0.0, max_delay_positions: int = 50) -> DataFrame:
    """events in emission: position (place in replay order), copy (1 for a duplicate), corruption and invalid_field (null for
    good records), shift, and place, the place in the order of emission.

    A delayed event comes after the event that stands shift positions later; a duplicate comes right after its first copy.
    """
    key = F.col("event_id")
    ordered = numbered(events, [], ["event_timestamp", "source_row_number"], F.floor(F.col("event_timestamp") / adapter.BUCKET_MS), "position")
    bad = draw(seed, "malformed", key) < malformed_rate
    late = draw(seed, "late", key) < delay_rate
    shift = F.when(late, (F.floor(draw(seed, "shift", key) * max_delay_positions) + 1).cast("long")).otherwise(F.lit(0).cast("long"))
    decided = ordered.withColumns({"corruption": F.when(bad, pick(seed, "corruption", key, CORRUPTIONS)), "shift": shift, "_copies": F.when(draw(seed, "duplicate", key) < duplicate_rate, 1).otherwise(0)})
    decided = decided.withColumns({"invalid_field": F.when(F.col("corruption") == "invalid_field", pick(seed, "invalid_field", key, INVALID_FIELDS)), "_at": F.col("position") + F.col("shift"), "_late": F.col("shift") > 0})
    emitted = decided.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies")))).drop("_copies")
    return numbered(emitted, [], ["_at", "_late", "position", "copy"], F.floor(F.col("_at") / BUCKET_PLACES), "place").drop("_at", "_late")


def emit(planned: DataFrame, seed: int = 42, id_: int = 1) -> DataFrame:
    """The planned events as envelope rows with their place: records with an invalid field are framed as they are, garbage
    replaces the frame, and an unknown schema id replaces the frame's own."""
    field, kind, tx = F.col("invalid_field"), F.col("event_type"), F.col("transaction_id")
    records = planned.withColumns({
        "visitor_id": F.when(field == "negative_visitor", F.lit(-1).cast("long")).otherwise(F.col("visitor_id")),
        "event_timestamp": F.when(field == "zero_timestamp", F.lit(0).cast("long")).otherwise(F.col("event_timestamp")),
        "transaction_id": F.when((field == "orphan_transaction_id") & (kind != "transaction"), "not-a-real-transaction").when(field == "orphan_transaction_id", F.lit(None)).otherwise(tx),
    })
    framed = wire.envelope_of(records, id_, more=["place", "corruption", "event_id"])
    noise = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("garbage"), "event_id").cast("binary"))
    bogus = F.floor(F.lit(900_000) + draw(seed, "schema", F.col("event_id")) * 99_999)
    value = (
        F.when(F.col("corruption") == "raw_garbage", F.unhex(F.concat(F.lit("FF"), noise, F.substring(noise, 1, 14))))
        .when(F.col("corruption") == "unknown_schema_id", F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(bogus), 8, "0")), wire.payload(F.col("value"))))
        .otherwise(F.col("value"))
    )
    return framed.withColumn("value", value).drop("corruption", "event_id")


def dry_run(envelopes: DataFrame, folder: str) -> None:
    """Envelopes as lines of JSON (topic, key, value as text) in the order of emission, in one file: for looking at."""
    text = lambda c: F.decode(F.col(c), "UTF-8") if c == "key" else F.col(c).cast("string")
    envelopes.orderBy("place").coalesce(1).select(F.to_json(F.struct("topic", text("key").alias("key"), text("value").alias("value"))).alias("line")).write.mode("overwrite").text(folder)
