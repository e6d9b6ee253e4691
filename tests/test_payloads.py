from pyspark.sql import functions as F

from tests.records import messages, raw_df
from tidegate.operators import ops, payloads
from tidegate.operators.points import raw_points
from tidegate.operators.reconcile import reconcile_restore


def test_payloads_keep_arrival_order_and_stay_within_a_poll(spark):
    points = raw_points(raw_df(spark, *({"ivalues": {"v": i}} for i in range(10)))).repartition(5)
    rows = payloads.tenant_payloads(points, records=4).orderBy("poll").collect()
    order = [[line.split("v=")[1].split(".")[0] for line in r["payload"].split("\n")] for r in rows]
    assert order == [["0", "1", "2", "3"], ["4", "5", "6", "7"], ["8", "9"]]
    stats = payloads.payload_stats(points, records=4).orderBy("poll").collect()
    assert [(s["payload_records"], s["payload_bytes"]) for s in stats] == [
        (len(o), len(r["payload"].encode())) for o, r in zip(order, rows)
    ]


def test_bytes_are_counted_in_utf8(spark):
    points = raw_points(raw_df(spark, {"deviceMetadata": {"ort": "Köln"}}))
    payload = payloads.tenant_payloads(points).first()["payload"]
    assert payloads.payload_stats(points).first()["payload_bytes"] == len(payload.encode()) == len(payload) + 1


def test_backup_day_is_that_of_the_last_line(spark):
    points = raw_points(raw_df(spark, {"timestamp": "2019-05-13T00:00:00Z"}, {"timestamp": "2019-05-12T00:00:00Z"}))
    assert payloads.payload_backup_day(points).first()["day"] == "20190512"


def test_counts_come_before_checks(spark):
    points = raw_points(raw_df(spark, {}, {"timestamp": "junk"}, {"monitoringSystem": "UIM"}))
    counts = {r["monitoring_system"]: r["records"] for r in payloads.ingested_data_count(points).collect()}
    assert counts == {"MAAS": 2, "UIM": 1}
    assert tuple(payloads.unconverted_count(points).first()) == (1, 3)


def test_replay_starts_at_the_smallest_offset(spark):
    rows = spark.createDataFrame([("t", 0, 7), ("t", 0, 5), ("t", 1, 9)], "topic STRING, `partition` INT, `offset` BIGINT")
    assert sorted(map(tuple, payloads.replay_offsets(rows).collect())) == [("t", 0, 5), ("t", 1, 9)]


def test_ops_lines(spark):
    points = raw_points(raw_df(spark, {}))
    lines = ops.ops_metric_lines(
        payloads.ingested_data_count(points),
        payloads.ingestion_records_count(points),
        payloads.payload_stats(points),
        "raw",
        "box",
    )
    size = len(points.first()["line"])
    assert [r["line"] for r in lines.collect()] == [
        "ingested_data_count,topic=unified.metrics.json,partitionid=0,monitoringsystem=MAAS count=1",
        "ingestion_records_count,listener=raw,hostname=box count=1",
        f"ingestion_payload,listener=raw,hostname=box payloadrecordscount=1,payloadsize={size}",
    ]


def test_reconcile(spark):
    schema = "host STRING, database STRING, retention_policy STRING, measurement STRING, ts_s BIGINT, retention STRING"
    row = ("h", "d", "rp", "m")
    written = spark.createDataFrame([(*row, 100, "10s"), (*row, 50, "10s"), ("h", "d", "rp", "n", 100, "10s")], schema)
    assert reconcile_restore(written, written).count() == 0
    assert reconcile_restore(written, written.where("ts_s > 60"), as_of=100).count() == 0
    lost = reconcile_restore(written, written.where("measurement = 'm'"), as_of=100).collect()
    assert [(r["measurement"], r["difference"]) for r in lost] == [("n", 1)]
    doubled = reconcile_restore(written, written.unionByName(written)).collect()
    assert sorted((r["measurement"], r["difference"]) for r in doubled) == [("m", -2), ("n", -1)]


def test_fan_in_keeps_all(spark):
    parts = [messages(spark, "a", topic=f"t{i}") for i in range(5)]
    assert payloads.rollup_fan_in(*parts).select(F.countDistinct("topic")).first()[0] == 5
