import pytest
from pyspark.sql import functions as F

from tests.records import raw_df, rollup_df
from tidegate.operators.points import points_long, raw_points, rollup_points, with_raw_metrics
from tidegate.operators.quarantine import STRICT_RAW, insist, split


def point(spark, **change):
    return raw_points(raw_df(spark, change)).first()


def rollup(spark, **change):
    return rollup_points(rollup_df(spark, change)).first()


def test_whole_raw_line(spark):
    assert point(spark)["line"] == (
        'MAAS_agent.filesystem,account=acct:5550101,accountType=CORE,checkId="c1",'
        'collectionName="agent.filesystem",device="1234",deviceLabel="label",filesystem_free_unit=KILOBYTES,'
        'monitoringSystem="MAAS",monitoringZone="",tenantId=CORE-acct:5550101 filesystem_free=20.0 1557777267'
    )


def test_whole_rollup_line(spark):
    row = rollup(spark)
    assert row["line"] == (
        'MAAS_agent.cpu,account=1234567,accountType=CORE,collectionName="agent.cpu",idle_unit=percent,'
        'monitoringSystem="MAAS",tenantId="other" end=987654i,idle_max=3.0,idle_mean=2.0,idle_min=1.0,start=123456i'
    )
    assert (row["level"], row["ts_s"]) == ("5m", None)


def test_rollup_time_option(spark):
    assert rollup_points(rollup_df(spark, {}), rollup_time="end").first()["line"].endswith(" 987654")


def test_device_label_depends_on_the_device(spark):
    assert point(spark, deviceLabel="")["tags"]["deviceLabel"] == '""'
    assert not {"device", "deviceLabel"} & set(point(spark, device="")["tags"])
    assert point(spark, device=" \t")["tags"]["device"] == '""'


def test_account_tag_is_not_cleaned_and_the_tenant_is(spark):
    tags = point(spark, account=" acct :1 ")["tags"]
    assert (tags["account"], tags["tenantId"]) == ("acct :1", "CORE-_acct__1_")


def test_collection_name_tag_is_not_cleaned_and_the_measurement_is(spark):
    row = point(spark, collectionName="a b.c")
    assert (row["tags"]["collectionName"], row["measurement"]) == ('"a b.c"', "MAAS_a_b_c")


def test_other_metadata_and_text_values_are_never_emitted(spark):
    assert "demo" not in point(spark)["line"] and "note" not in point(spark)["line"]


def test_metadata_replaces_earlier_tags_and_yields_to_later_ones(spark):
    tags = point(
        spark,
        deviceMetadata={"monitoringSystem": "no", "account": "yes", "s": "no", "": "x"},
        systemMetadata={"s": None, "collectionName": "no", "filesystem_free_unit": "no", "collectionLabel": "kept"},
    )["tags"]
    assert tags["account"] == '"yes"' and tags["monitoringSystem"] == '"MAAS"' and tags["s"] == '"null"'
    assert tags["collectionName"] == '"agent.filesystem"' and tags["filesystem_free_unit"] == "KILOBYTES"
    assert tags["collectionLabel"] == '"kept"' and "" not in tags


def test_units(spark):
    tags = point(spark, ivalues={"a": 1, "b": 1}, units={"a": ""}, systemMetadata={"a_unit": "m"})["tags"]
    assert tags["a_unit"] == '"m"' and tags["b_unit"] == "unavailable"
    assert rollup(spark, units={})["reason"] == "missing_unit"
    assert rollup(spark, units=None)["reason"] == "missing_unit"


def test_clashing_names(spark):
    fields = point(spark, ivalues={"a.b": 1, "a-b": 2}, fvalues={})["fields"]
    assert fields == {"a_b": 1.0}  # "a.b" is the larger key
    assert point(spark, ivalues={"a.b": 1}, fvalues={"a:b": 2.5})["fields"] == {"a_b": 2.5}


def test_long_values_lose_precision_as_doubles(spark):
    assert point(spark, ivalues={"a": 2**53 + 1})["fields"]["a"] == float(2**53)


RAW_CASES = [
    ({"timestamp": "2019-05-13 19:54:27Z"}, "timestamp_whitespace"),
    ({"timestamp": "junk"}, "unparsable_time"),
    ({"timestamp": None}, "unparsable_time"),
    ({"accountType": "CO RE"}, "invalid_account_type"),
    ({"monitoringSystem": "MA\tAS"}, "invalid_monitoring_system"),
    ({"account": None}, "null_identity"),
    ({"collectionName": None}, "null_identity"),
    ({"deviceLabel": None}, "null_device_label"),
    ({"deviceLabel": None, "device": ""}, None),
    ({"ivalues": {}, "fvalues": {}}, "no_fields"),
    ({"ivalues": {"a": None}}, "null_value"),
    ({"fvalues": {"a": float("nan")}}, "non_finite_field"),
    ({"fvalues": {"a": float("-inf")}}, "non_finite_field"),
    ({"deviceMetadata": {"a": "x\ny"}}, "newline_in_line"),
    ({"device": "x\n"}, None),
    ({"deviceMetadata": {"a": "x\ry"}}, None),
]


def test_raw_reasons(spark):
    rows = raw_points(raw_df(spark, *(change for change, _ in RAW_CASES))).orderBy("offset").collect()
    assert [row["reason"] for row in rows] == [reason for _, reason in RAW_CASES]
    assert all((row["line"] is None) == (row["reason"] is not None) for row in rows)


ROLLUP_CASES = [
    ({"ivalues": None}, "null_values"),
    ({"fvalues": None}, "null_values"),
    ({"ivalues": {"idle": None}}, "null_bucket"),
    ({"ivalues": {"idle": {"min": 1, "max": None, "mean": 2}}}, "null_bucket"),
    ({"accountType": None}, "null_identity"),
    ({"accountType": "A B"}, "invalid_account_type"),
    ({"ivalues": {}, "units": None}, None),
    ({"deviceMetadata": None, "systemMetadata": None}, None),
]


def test_rollup_reasons(spark):
    rows = rollup_points(rollup_df(spark, *(change for change, _ in ROLLUP_CASES))).orderBy("offset").collect()
    assert [row["reason"] for row in rows] == [reason for _, reason in ROLLUP_CASES]


def test_decode_reasons_come_first(spark):
    records = raw_df(spark, {"timestamp": "a b"}).withColumn("reason", F.lit("malformed_json"))
    assert raw_points(records).first()["reason"] == "malformed_json"


def test_strict_stops_and_split_sorts(spark):
    rows = raw_points(raw_df(spark, {}, {"timestamp": "a b"}, {"timestamp": "junk"}))
    good, dead = split(rows)
    assert good.count() == 1 and [r["reason"] for r in dead.collect()] == ["timestamp_whitespace", "unparsable_time"]
    with pytest.raises(Exception, match="batch refused: timestamp_whitespace"):
        insist(rows, STRICT_RAW).select("reason").collect()
    assert insist(rows.where(F.col("offset") != 1), STRICT_RAW).select("reason").count() == 2


def test_points_long_keeps_every_entry(spark):
    rows = points_long(with_raw_metrics(raw_df(spark, {"ivalues": {"a.b": 1}, "fvalues": {"a:b": 2.0}}))).collect()
    assert [(r["kind"], r["key"], r["name"], r["value"], r["unit"]) for r in rows] == [
        ("i", "a.b", "a_b", 1.0, "unavailable"),
        ("f", "a:b", "a_b", 2.0, "unavailable"),
    ]
