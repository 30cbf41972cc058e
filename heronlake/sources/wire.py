"""The wire format: framed payloads, trusted schema ids, decoding, dead letters and schema compatibility.

A frame is a zero byte, a four-byte big-endian schema id and the payload. Payloads are JSON; where Spark's Avro functions can
be loaded, Avro payloads decode through them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.functions.contract import rejection_reason
from heronlake.functions.model import DEFAULT_BOUNDS, DLQ_MESSAGE_CHARS, DLQ_TOPIC, WIRE_V1, Bounds


def schema_id(value: Column) -> Column:
    """Bytes 2 to 5 as a number; null for shorter values and for those that do not begin with the frame's zero byte."""
    return F.when((F.length(value) >= 5) & (F.substring(value, 1, 1) == F.unhex(F.lit("00"))), F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def payload(value: Column) -> Column:
    """What follows the frame's head."""
    return F.substring(value, 6, 2147483647)


def frame(payload_: Column, id_: int) -> Column:
    return F.concat(F.unhex(F.lit(f"00{id_:08X}")), payload_)


def trusted(id_: Column, ids: list[int] | None) -> Column:
    """Whether an id is registered; None trusts all."""
    return F.lit(True) if ids is None else F.coalesce(id_.isin(*ids), F.lit(False)) if ids else F.lit(False)


def decode(envelope: DataFrame, schema: T.StructType = WIRE_V1, avro_schema: str | None = None) -> DataFrame:
    """Adds schema_id and decoded (a struct, null where the payload is broken). avro_schema asks for Avro payloads."""
    body = payload(F.col("value"))
    if avro_schema is not None:
        try:
            from pyspark.sql.avro.functions import from_avro

            decoded = from_avro(body, avro_schema, {"mode": "PERMISSIVE"})
            envelope.select(decoded)  # analysed here, where a missing package shows
        except Exception as e:  # the JVM classes are an optional package
            raise RuntimeError("Avro payloads need the spark-avro package") from e
    else:
        decoded = F.from_json(body.cast("string"), schema, {"mode": "PERMISSIVE"})
    return envelope.withColumns({"schema_id": schema_id(F.col("value")), "decoded": decoded})


def wire_status(ids: list[int] | None) -> Column:
    """decoded, unknown_schema_id or deserialization_failed."""
    whole = F.col("decoded").isNotNull() & F.col("decoded.event_id").isNotNull()
    return F.when(~trusted(F.col("schema_id"), ids) & F.col("schema_id").isNotNull(), "unknown_schema_id").when(F.coalesce(whole, F.lit(False)) & F.col("schema_id").isNotNull(), "decoded").otherwise("deserialization_failed")


def split(envelope: DataFrame, ids: list[int] | None, schema: T.StructType = WIRE_V1) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, the others): every row is in exactly one."""
    rows = decode(envelope, schema).withColumn("status", wire_status(ids))
    return rows.where("status = 'decoded'"), rows.where("status <> 'decoded'")


def flatten(decoded: DataFrame) -> DataFrame:
    """The decoded fields with event time, date and the place in the log."""
    at = F.timestamp_millis("decoded.event_timestamp")
    return decoded.select(
        "decoded.*", at.alias("event_time"), F.timestamp_millis("decoded.ingestion_timestamp").alias("ingestion_time"), F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"), "schema_id", F.to_date(at).alias("event_date"),
    )


def route(envelope: DataFrame, ids: list[int] | None, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """Every record with its route: valid, or one of deserialization_failed, unknown_schema_id, validation_failed, and why."""
    rows = decode(envelope).withColumn("status", wire_status(ids))
    flat = rows.select("status", "key", "value", "timestamp", F.col("schema_id"), F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"), "decoded.*")
    reason = F.when(F.col("status") == "decoded", rejection_reason(bounds, topic_rule=True))
    return flat.withColumn("reason", reason).withColumn("route", F.when(F.col("status") != "decoded", F.col("status")).when(F.col("reason").isNotNull(), "validation_failed").otherwise("valid"))


def dead_letters(routed: DataFrame) -> DataFrame:
    """Failed records as dead letters: the exact payload, error type, message (bounded), source position and key, the time of
    routing in epoch milliseconds, and the schema version where the payload could be decoded that far (else null)."""
    message = F.substring(F.concat_ws(": ", "route", F.coalesce("reason", F.lit("the record could not be read"))), 1, DLQ_MESSAGE_CHARS)
    return routed.where("route <> 'valid'").select(
        F.lit(DLQ_TOPIC).alias("topic"), F.coalesce("value", F.lit(b"")).alias("original_payload"), F.col("route").alias("error_type"), message.alias("error_message"), "source_topic", F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"), F.col("key").cast("string").alias("message_key"), F.unix_millis(F.current_timestamp()).alias("ingestion_timestamp"), F.when(F.col("route") == "validation_failed", F.col("schema_version")).alias("schema_version"),
    )


class SchemaRegistry:
    """A registry kept in a JSON file: {subject: [{id, version, schema}]}; schemas are record definitions."""

    def __init__(self, entries: dict[str, list[dict]] | None = None):
        self.entries = entries or {}

    @staticmethod
    def load(path: str) -> SchemaRegistry:
        with open(path) as f:
            return SchemaRegistry(json.load(f))

    def register(self, subject: str, schema: dict) -> int:
        versions = self.entries.setdefault(subject, [])
        for v in versions:
            if v["schema"] == schema:
                return v["id"]
        if versions and not backward_compatible(schema, versions[-1]["schema"]):
            raise ValueError(f"{subject}: the schema cannot read what its last version wrote")
        id_ = 1 + max((v["id"] for own in self.entries.values() for v in own), default=0)
        versions.append({"id": id_, "version": len(versions) + 1, "schema": schema})
        return id_

    def trusted_ids(self, subjects: list[str]) -> list[int]:
        """All ids of the subjects; none at all is an error, for nothing could be read."""
        ids = sorted({v["id"] for s in subjects for v in self.entries.get(s, [])})
        if not ids:
            raise ValueError("no schema is registered for these subjects")
        return ids


def backward_compatible(reader: dict, writer: dict) -> bool:
    """Whether reader decodes writer's records: shared fields keep (or widen) their type, new ones have a default."""
    wider = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}

    def readable(new, old) -> bool:
        if isinstance(old, list):
            return all(readable(new, o) for o in old)
        if isinstance(new, list):
            return any(readable(n, old) for n in new)
        if isinstance(new, dict) and isinstance(old, dict) and new.get("type") == old.get("type") == "enum":
            return set(old["symbols"]) <= set(new["symbols"]) or "default" in new
        plain = lambda t: t.get("type") if isinstance(t, dict) else t
        return plain(new) == plain(old) or plain(new) in wider.get(plain(old), ())

    old = {f["name"]: f for f in writer["fields"]}
    return all(readable(f["type"], old[f["name"]]["type"]) if f["name"] in old else "default" in f for f in reader["fields"])


def envelope_of(events: DataFrame, id_: int = 1, more: list[str] | None = None) -> DataFrame:
    """Events as framed JSON records in the broker's envelope, with more of their columns beside it if asked for."""
    body = F.encode(F.to_json(F.struct(*(F.col(f.name) for f in WIRE_V1.fields))), "UTF-8")
    return events.select(
        F.encode(F.col("visitor_id").cast("string"), "UTF-8").alias("key"), frame(body, id_).alias("value"), F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"), F.timestamp_millis("ingestion_timestamp").alias("timestamp"), F.lit(0).alias("timestampType"), *(more or []),
    )


def corrupt(envelope: DataFrame) -> DataFrame:
    """Wire faults by offset: every 31st record garbage, every 37th an unknown schema id, every 41st a broken payload."""
    o = F.col("offset")
    return envelope.withColumn("value", F.when(o % 31 == 7, F.unhex(F.lit("FF01"))).when(o % 37 == 11, F.concat(F.unhex(F.lit("000000270F")), payload(F.col("value")))).when(o % 41 == 13, F.concat(F.substring("value", 1, 5), F.encode(F.lit("{broken"), "UTF-8"))).otherwise(F.col("value")))


def stream_source(spark: SparkSession, path: str | None = None, bootstrap: str | None = None, topics: list[str] | None = None, starting_offsets: str = "earliest", max_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """An unbounded log: a broker where its connector is installed, else a folder of Parquet files with the same envelope."""
    from heronlake.functions.model import ENVELOPE

    if bootstrap is not None:
        r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", ",".join(topics or [])).option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower())
        return (r.option("maxOffsetsPerTrigger", max_per_trigger) if max_per_trigger else r).load()
    r = spark.readStream.schema(ENVELOPE)
    return (r.option("maxFilesPerTrigger", max_per_trigger) if max_per_trigger else r).parquet(path)
