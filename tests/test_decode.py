import json

from pyspark.sql import functions as F

from tests.records import RAW, ROLLUP, messages, raw_df
from tidegate.operators.decode import decode_raw, decode_rollup, encode_records
from tidegate.schemas import RAW_FIELDS


def without(record, name):
    return {k: v for k, v in record.items() if k != name}


CASES = [
    (RAW, None),
    ({**RAW, "ivalues": {"a b:`c": 2**63 - 1}, "fvalues": {"x": 1, "y": 1.5, "z": 1e300}}, None),
    (dict(reversed(RAW.items())), None),
    (None, "null_payload"),
    (json.dumps(RAW)[:-5], "malformed_json"),
    ("[1]", "malformed_json"),
    ("null", "malformed_json"),
    (without(RAW, "units"), "missing_field"),
    (without(RAW, "device"), "missing_field"),
    ({**RAW, "extra": 1}, "unknown_field"),
    ({**RAW, "accountType": "FOO"}, "unknown_account_type"),
    ({**RAW, "monitoringSystem": "FOO"}, "unknown_monitoring_system"),
    ({**RAW, "ivalues": {"a": "x"}}, "wrong_type"),
    ({**RAW, "ivalues": {"a": 1.5}}, "wrong_type"),
    ({**RAW, "ivalues": {"a": 2**63}}, "wrong_type"),
    ({**RAW, "account": 17}, "wrong_type"),
    ({**RAW, "account": None}, "wrong_type"),
    ({**RAW, "units": {"a": 1}}, "wrong_type"),
    ({**RAW, "units": {"a": None}}, "wrong_type"),
    ({**RAW, "fvalues": []}, "wrong_type"),
]


def test_raw_is_strict(spark):
    rows = decode_raw(messages(spark, *(message for message, _ in CASES))).orderBy("offset").collect()
    assert [row["reason"] for row in rows] == [reason for _, reason in CASES]
    assert all((row["account"] is None) == (row["reason"] is not None) for row in rows)


def test_raw_round_trip(spark):
    records = raw_df(spark, {}, {"ivalues": {"a": 2**62 + 1}, "deviceMetadata": {"x": "a \"b\""}})
    back = decode_raw(encode_records(records, RAW_FIELDS))
    assert [r.asDict() for r in back.select(records.columns).collect()] == [r.asDict() for r in records.collect()]


def test_rollup_is_lenient(spark):
    odd = {
        **ROLLUP,
        "unknown": {"x": [1]},
        "ivalues": {"a": {"min": "1", "max": 2**63 - 1, "mean": 3.7, "other": 1}},
        "start": 5.9,
    }
    rows = decode_rollup(messages(spark, odd, {}, None, "{", "null")).collect()
    assert rows[0]["reason"] is None
    bucket = rows[0]["ivalues"]["a"]
    assert (bucket["min"], bucket["max"], bucket["mean"], rows[0]["start"]) == (1, 2**63 - 1, 3, 5)
    assert rows[1]["reason"] is None and rows[1]["account"] is None and rows[1]["start"] == 0
    assert [r["reason"] for r in rows[2:]] == ["null_payload", "malformed_json", "null_payload"]


def test_a_number_too_large_for_a_whole_value_does_not_stop_the_job(spark):
    row = decode_rollup(messages(spark, {**ROLLUP, "ivalues": {"a": {"min": 9.9e18, "max": 1, "mean": 1}}})).first()
    assert row["ivalues"] is None or row["ivalues"]["a"]["min"] is None


def test_messages_are_parsed_once_however_they_are_filtered(spark):
    decoded = decode_raw(messages(spark, RAW)).where(F.col("reason").isNull() & F.col("account").isNotNull())
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_wide_records_decode(spark):
    """Maps with 100,000 entries, keys of both spellings, and a wrong value at their end."""
    n = 100_000
    wide = {**RAW, "ivalues": {f"key{i}": i for i in range(n)}, "units": {f"key {i}`": "u" for i in range(n)}, "fvalues": {f"f{i}": i + 0.5 for i in range(n)}}
    bad = {**wide, "ivalues": {**wide["ivalues"], "zz": "text"}}
    rows = decode_raw(messages(spark, wide, bad)).select("reason", F.size("ivalues").alias("n")).collect()
    assert [r["reason"] for r in rows] == [None, "wrong_type"] and rows[0]["n"] == n
