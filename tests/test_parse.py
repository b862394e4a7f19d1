import json

from casemill.operators.parse import classify, parse_cases, parse_updates, quarantine_counts
from casemill.schemas import CASE_SCHEMA
from helpers import kafka_rows

GOOD = json.dumps({"overdueId": "1", "mobile": "13800000000", "name": "A"})


def reasons(spark, values):
    out = classify(kafka_rows(spark, values), CASE_SCHEMA).orderBy("offset").collect()
    return [r["reason"] for r in out]


def test_message_classes(spark):
    values = [None, "", "   ", "null", "not json", '{"mobile": "1"', "[]", '[{"mobile": "1"}]', "{}",
              '{"mobile": "1"}', GOOD]
    assert reasons(spark, values) == [
        "empty", "empty", "empty", "json_null", "corrupt", "corrupt", "corrupt", "corrupt", "no_phone",
        "no_key", None,
    ]


def test_valid_and_quarantine_split(spark):
    valid, quarantine = parse_cases(kafka_rows(spark, [GOOD, "oops", None]))
    assert valid.count() == 1
    rows = {r["reason"]: r for r in quarantine.collect()}
    assert set(rows) == {"corrupt", "empty"}
    assert rows["corrupt"]["value"] == "oops" and rows["corrupt"]["offset"] == 1
    counts = {r["reason"]: r["n"] for r in quarantine_counts(quarantine).collect()}
    assert counts == {"corrupt": 1, "empty": 1}


def test_lenient_json_cases(spark):
    values = [
        GOOD + " trailing",
        '{"overdueId": "2", "mobile": "1", "name": "A", "name": "B"}',
        '{"overdueId": "3", "mobile": "1", "name": {"first": "C"}}',
        '{"overdueId": "4", "mobile": "1", "NAME": "D"}',
    ]
    valid, quarantine = parse_cases(kafka_rows(spark, values))
    assert quarantine.count() == 0
    got = {r["overdueId"]: r["name"] for r in valid.collect()}
    assert got["1"] == "A"                       # trailing text accepted
    assert got["2"] == "B"                       # repeated field: last wins
    assert json.loads(got["3"]) == {"first": "C"}  # nested value kept as JSON text
    assert got["4"] is None                      # other-case name not matched


def test_exact_amounts(spark):
    values = [
        '{"overdueId": "1", "mobile": "1", "overdueAmt": 1.50}',
        '{"overdueId": "2", "mobile": "1", "overdueAmt": 12345678901234567890.10}',
        '{"overdueId": "3", "mobile": "1", "overdueAmt": "7.10"}',
        '{"overdueId": "4", "mobile": "1", "overdueAmt": 5, "overdueAmt": 6}',
        '{"overdueId": "5", "mobile": "1", "overdueAmt": -0.10, "name": {"overdueAmt": 3.0}, "loanAmt": "x"}',
    ]
    valid, _ = parse_cases(kafka_rows(spark, values))
    got = {r["overdueId"]: r["overdueAmt"] for r in valid.collect()}
    assert got["1"] == "1.50"                     # as sent
    assert got["2"] == "12345678901234567890.10"  # every digit kept
    assert got["3"] == "7.10"                     # strings are exact
    assert got["4"] == "6"                        # repeated field: last wins
    assert got["5"] == "-0.10"                    # a nested field of that name is another


def test_update_parse_and_binary_value(spark):
    msgs = kafka_rows(spark, ['{"overdueId": "9", "mobile": "5", "status": "CLOSE"}'], topic="case_update")
    msgs = msgs.withColumn("value", msgs["value"].cast("binary"))
    valid, quarantine = parse_updates(msgs)
    row = valid.collect()[0]
    assert (row["overdueId"], row["status"], row["topic"]) == ("9", "CLOSE", "case_update")
    assert quarantine.count() == 0
