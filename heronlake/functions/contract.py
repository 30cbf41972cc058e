"""The data contract as data: ordered rules that become one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.functions.model import DEFAULT_BOUNDS, EVENT_TYPES, TOPIC_PREFIX, Bounds


def _fails(ok: Column) -> Column:
    """A rule that fails where ok is false or unknown: null never passes."""
    return ~F.coalesce(ok, F.lit(False))


def rules(bounds: Bounds = DEFAULT_BOUNDS, topic_rule: bool = False) -> list[tuple[str, Column]]:
    """(reason, failed), in order; with topic_rule an event must also come from its own type's topic."""
    c = F.col
    tx = F.when(F.trim(c("transaction_id")) != "", c("transaction_id"))
    own = [
        ("event_id_not_sha256", _fails(c("event_id").rlike("^[0-9a-f]{64}$"))),
        ("negative_visitor_id", _fails(c("visitor_id") >= 0)),
        ("negative_item_id", _fails(c("item_id") >= 0)),
        ("event_timestamp_out_of_range", _fails(c("event_timestamp").between(bounds.low, bounds.high))),
        ("ingestion_timestamp_invalid", _fails(c("ingestion_timestamp") > 0)),
        ("unknown_event_type", _fails(c("event_type").isin(*EVENT_TYPES))),
        ("transaction_without_transaction_id", (c("event_type") == "transaction") & tx.isNull()),
        ("non_transaction_with_transaction_id", (c("event_type") != "transaction") & tx.isNotNull()),
    ]
    if topic_rule:
        own.insert(6, ("event_type_not_of_topic", _fails(c("source_topic") == F.concat(F.lit(TOPIC_PREFIX), c("event_type")))))
    return own


def rejection_reason(bounds: Bounds = DEFAULT_BOUNDS, topic_rule: bool = False) -> Column:
    """The first failing rule's reason, null for a valid event."""
    (name, failed), *rest = rules(bounds, topic_rule)
    out = F.when(failed, name)
    for name, failed in rest:
        out = out.when(failed, name)
    return out


def classify(events: DataFrame, bounds: Bounds = DEFAULT_BOUNDS, topic_rule: bool = False) -> DataFrame:
    return events.withColumn("rejection_reason", rejection_reason(bounds, topic_rule))
