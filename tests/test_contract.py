import pytest
from pyspark.sql import functions as F

from heronlake.functions.contract import classify, rules
from heronlake.functions.identity import normal_transaction, ratio
from heronlake.functions.model import DEFAULT_BOUNDS, WIRE_V1

GOOD = {"event_id": "a" * 64, "visitor_id": 257597, "item_id": 355908, "event_type": "view", "event_timestamp": 1433221332117, "ingestion_timestamp": 1789503301234, "transaction_id": None, "schema_version": 1, "source_file": "f", "source_row_number": 1}
CASES = [
    ({}, None),
    ({"event_type": "transaction", "transaction_id": "7"}, None),
    ({"event_type": "addtocart"}, None),
    ({"event_id": "A" * 64}, "event_id_not_sha256"),
    ({"event_id": "a" * 63}, "event_id_not_sha256"),
    ({"event_id": None}, "event_id_not_sha256"),
    ({"visitor_id": -1}, "negative_visitor_id"),
    ({"visitor_id": None}, "negative_visitor_id"),
    ({"visitor_id": 0}, None),
    ({"item_id": -5}, "negative_item_id"),
    ({"item_id": None}, "negative_item_id"),
    ({"event_timestamp": DEFAULT_BOUNDS.low}, None),
    ({"event_timestamp": DEFAULT_BOUNDS.high}, None),
    ({"event_timestamp": DEFAULT_BOUNDS.low - 1}, "event_timestamp_out_of_range"),
    ({"event_timestamp": DEFAULT_BOUNDS.high + 1}, "event_timestamp_out_of_range"),
    ({"event_timestamp": None}, "event_timestamp_out_of_range"),
    ({"ingestion_timestamp": 0}, "ingestion_timestamp_invalid"),
    ({"ingestion_timestamp": None}, "ingestion_timestamp_invalid"),
    ({"event_type": "purchase"}, "unknown_event_type"),
    ({"event_type": None}, "unknown_event_type"),
    ({"event_type": "transaction"}, "transaction_without_transaction_id"),
    ({"event_type": "transaction", "transaction_id": ""}, "transaction_without_transaction_id"),
    ({"transaction_id": "9"}, "non_transaction_with_transaction_id"),
    ({"transaction_id": " "}, None),
    ({"visitor_id": -1, "event_type": None}, "negative_visitor_id"),
]


def test_contract_cases(spark):
    data = [tuple((GOOD | over).values()) for over, _ in CASES]
    df = spark.createDataFrame(data, WIRE_V1).coalesce(1)
    assert [r["rejection_reason"] for r in classify(df).collect()] == [want for _, want in CASES]


def test_every_rule_has_a_failing_case():
    assert {n for n, _ in rules()} == {w for _, w in CASES if w}


def test_topic_rule(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], WIRE_V1)
    for topic, want in (("events_view", None), ("events_addtocart", "event_type_not_of_topic"), (None, "event_type_not_of_topic")):
        assert classify(df.withColumn("source_topic", F.lit(topic)), topic_rule=True).first()["rejection_reason"] == want


@pytest.mark.parametrize("given,want", [(None, ""), ("", ""), ("nan", ""), ("12.0", "12"), ("12", "12"), ("x.0", "x.0")])
def test_transaction_normal_form(spark, given, want):
    assert spark.range(1).select(normal_transaction(F.lit(given))).first()[0] == want


def test_ratio_guards(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0)), ratio(F.lit(1), F.lit(4))).first()[:] == (None, 0.25)
