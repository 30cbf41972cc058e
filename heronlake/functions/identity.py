"""Deterministic event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_transaction(tx: Column) -> Column:
    """Transaction id as text: null, NaN and blank become the empty string; whole numbers lose a trailing .0.

    Only a missing value is empty: an id that happens to be spelled none or null is an id.
    """
    text = F.trim(tx.cast("string"))
    return F.when(text.isNull() | F.lower(text).isin("", "nan"), F.lit("")).otherwise(F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"))


def event_id(source_file: Column, row: Column, timestamp: Column, visitor: Column, item: Column, event_type: Column, tx: Column) -> Column:
    """SHA-256 over the source position and the event's own values, so equal source rows keep different ids."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.sha2(F.concat_ws("|", part(source_file), part(row), part(timestamp), part(visitor), part(item), part(event_type), normal_transaction(tx)), 256)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else null."""
    return F.when(denominator > 0, numerator / denominator)
