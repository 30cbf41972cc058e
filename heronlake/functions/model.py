"""Event types, topics, schemas and bounds of the event model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

EVENT_TYPES = ("view", "addtocart", "transaction")
TOPIC_PREFIX = "events_"
DLQ_TOPIC = "events_dlq"
DLQ_MESSAGE_CHARS = 2000


@dataclass(frozen=True)
class Bounds:
    """Inclusive range of event timestamps in epoch milliseconds that the contract accepts."""

    low: int
    high: int


#: Fixed values of the event contract.
DEFAULT_BOUNDS = Bounds(1430622004384, 1442545187788)

#: The ten fields of an event on the wire, version 1; version 2 adds two optional ones.
WIRE_V1 = T.StructType(
    [
        T.StructField("event_id", T.StringType()), T.StructField("visitor_id", T.LongType()), T.StructField("item_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("event_timestamp", T.LongType()), T.StructField("ingestion_timestamp", T.LongType()),
        T.StructField("transaction_id", T.StringType()), T.StructField("schema_version", T.IntegerType()),
        T.StructField("source_file", T.StringType()), T.StructField("source_row_number", T.LongType()),
    ]
)
WIRE_V2 = T.StructType([*WIRE_V1.fields, T.StructField("session_id", T.StringType()), T.StructField("device_type", T.StringType())])

#: What a message broker hands over.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()), T.StructField("timestampType", T.IntegerType()),
    ]
)
