import json
import os
from dataclasses import replace

import pytest

from tests.records import RAW, ROLLUP, messages
from tidegate.plans.ingest import raw_pipeline, rollup_pipeline, routed_points
from tidegate.schemas import ROUTES
from tidegate.sources import backup, points_table
from tidegate.sources.routes_table import prepared_routes
from tidegate.sources.wire import WireSource, read_rollup_streams
from tidegate.streaming import ingest
from tidegate.streaming.ingest import BatchReporter, IngestJob, Sinks, raw_ingest_stream, rollup_ingest_stream

KEY = ("CORE-acct:5550101", "MAAS_agent.filesystem")
TARGET = ("http://h:1", "db")


def routes(spark):
    return spark.createDataFrame(
        [(*KEY, "full", *TARGET, "rp_5d", "5d"), ("CORE-1234567", "MAAS_agent.cpu", "5m", *TARGET, "rp_10d", "10d")], ROUTES
    )


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def job(place, kind="raw", **settings):
    sinks = Sinks(
        points=place("points"), dead_letter=place("dead"), ops=place("ops"),
        backup=place("backup"), provisioning=place("provisioning"),
    )
    return IngestJob(kind, routes, sinks, hostname="box", **settings)


def run(spark, place, work, limit=None):
    source = WireSource("json", place("wire"), max_files_per_batch=limit)
    start = raw_ingest_stream if work.kind == "raw" else rollup_ingest_stream
    return start(spark, source, work, place("checkpoint"))


def letters(spark, place):
    return sorted((r["stage"], r["reason"]) for r in spark.read.parquet(place("dead")).collect())


def test_raw_stream_and_restart(spark, place):
    other = {**RAW, "account": "unknown"}
    messages(spark, RAW, other, "{", None).coalesce(1).write.json(place("wire"), ignoreNullFields=False)
    work = job(place)
    for _ in range(2):
        run(spark, place, work).awaitTermination()
    stored = points_table.read_points(spark, place("points")).collect()
    assert [(r["host"], r["database"], r["retention_policy"], r["day"], r["fields"]) for r in stored] == [
        ("h", "db", "rp_5d", "20190513", {"filesystem_free": 20.0})
    ]
    assert backup.read_backup(spark, place("backup")).count() == 1
    assert letters(spark, place) == [("ingest", "malformed_json"), ("ingest", "no_route"), ("ingest", "null_payload")]
    ops = {r["line"] for r in spark.read.parquet(place("ops")).where("scope = 'batch'").collect()}
    assert "ingestion_records_count,listener=raw,hostname=box count=4" in ops
    # Another file is a second batch: only its rows are taken up, and no statement is planned twice.
    messages(spark, RAW, offset=10).coalesce(1).write.mode("append").json(place("wire"))
    run(spark, place, work).awaitTermination()
    assert points_table.read_points(spark, place("points")).count() == 2
    assert spark.read.parquet(place("provisioning") + "/plan").count() == 1
    assert spark.read.parquet(place("provisioning") + "/keys").count() == 1


def test_a_batch_that_fails_between_sinks_is_run_again_without_duplicates(spark, place, monkeypatch):
    messages(spark, RAW, RAW).coalesce(1).write.json(place("wire"))
    work = job(place)

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_write_dead_letters", broken)
        assert "disk full" in ingest.stop_on_error(run(spark, place, work))
    assert backup.read_backup(spark, place("backup")).count() == 2
    assert ingest.stop_on_error(run(spark, place, work)) is None
    assert backup.read_backup(spark, place("backup")).count() == 2
    assert points_table.read_points(spark, place("points")).count() == 2


@pytest.mark.parametrize(
    "settings, record, reason",
    [
        ({"on_error": "fail", "as_of": 2_000_000_000}, RAW, "beyond_retention"),
        ({"strict": True}, {**RAW, "timestamp": "2019-05-13 19:54:27Z"}, "timestamp_whitespace"),
        ({"strict": True}, {**RAW, "account": "unknown"}, "no_route"),
    ],
)
def test_fatal_rows_stop_the_batch_only_on_request(spark, place, settings, record, reason):
    messages(spark, RAW, record).coalesce(1).write.json(place("wire"))
    assert reason in ingest.stop_on_error(run(spark, place, job(place, **settings)))
    lenient = job(place, as_of=settings.get("as_of"))
    assert ingest.stop_on_error(run(spark, place, lenient)) is None
    assert ("ingest", reason) in letters(spark, place)


def test_rollup_stream(spark, place):
    topic = "unified.metrics.json.5m"
    messages(spark, ROLLUP, {**ROLLUP, "units": {}}, topic=topic).write.json(place("wire"))
    messages(spark, ROLLUP, topic="unified.metrics.json.60m").write.mode("append").json(place("wire"))
    messages(spark, RAW).write.mode("append").json(place("wire"))
    run(spark, place, job(place, "rollup")).awaitTermination()
    stored = points_table.read_points(spark, place("points")).collect()
    assert [(r["level"], r["retention_policy"], r["day"], r["int_fields"]["start"]) for r in stored] == [
        ("5m", "rp_10d", "undated", 123456)
    ]
    assert letters(spark, place) == [("backup", "no_timestamp"), ("ingest", "missing_unit"), ("ingest", "no_level")]


def test_source_options(spark, place):
    kafka = WireSource("kafka", options={"a": "b"}, max_records_per_batch=1500, max_files_per_batch=3)
    assert kafka.read_options() == {"a": "b", "maxOffsetsPerTrigger": "1500"}
    assert WireSource("json", "x", max_files_per_batch=3).read_options() == {"maxFilesPerTrigger": "3"}
    messages(spark, ROLLUP, topic="unified.metrics.json.20m").write.json(place("wire"))
    stream = read_rollup_streams(spark, WireSource("json", place("wire")))
    assert stream.isStreaming and stream.columns == ["topic", "partition", "offset", "value", "level"]


def test_stream_with_prepared_routes(spark, place):
    messages(spark, RAW, {**RAW, "account": "unknown"}).coalesce(1).write.json(place("wire"))
    ready = lambda session: prepared_routes(session, place("routes"), "1", routes)
    run(spark, place, replace(job(place), routes=ready)).awaitTermination()
    assert points_table.read_points(spark, place("points")).count() == 1
    assert letters(spark, place) == [("ingest", "no_route")]
    assert spark.read.parquet(place("provisioning") + "/plan").count() == 1


def test_reporter_speaks_every_thousand_batches():
    said = []
    reporter = BatchReporter(said.append)
    for _ in range(2500):
        reporter.done()
    assert (said, reporter.batches) == ([1000, 2000], 2500)


@pytest.mark.parametrize("sinks, held", [(("points",), {"tags", "fields", "int_fields"}), (("backup",), {"line"}), (("ops", "provisioning"), {"line"})])
def test_a_batch_keeps_only_what_its_sinks_read(spark, place, monkeypatch, sinks, held):
    kept = []
    monkeypatch.setattr(ingest, "_refuse", lambda rows, fatal: kept.append(set(rows.columns)))
    work = IngestJob("raw", routes, Sinks(**{"points": None, "dead_letter": place("dead"), **{name: place(name) for name in sinks}}))
    ingest.ingest_batch(messages(spark, RAW, "{"), 0, work)
    assert kept[0] & {"tags", "fields", "int_fields", "line"} == held
    assert letters(spark, lambda name: f"{place(name)}/batch_id=0") == [("ingest", "malformed_json")]


def test_counters_compute_their_rows_once(spark, place):
    wire = messages(spark, RAW, {**RAW, "account": "unknown"}, "{", None).coalesce(1)
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    work = job(place)
    rows = ingest.route_points(ingest.raw_decoded(wire.mapInArrow(counted, wire.schema)), routes(spark))
    ingest.write_ops_metrics(rows, 0, work)
    assert passed.value == 4
    found = {(r["scope"], r["line"].split(" ")[1]) for r in spark.read.parquet(place("ops")).collect()}
    ours = {r["line"] for r in spark.read.parquet(place("ops")).collect()}
    assert ours == {r["line"] for r in ingest.ops_rows(rows, "raw", "box").collect()}
    assert ("batch", "count=4") in found and ("source", "count=2") in found


def test_a_batch_is_computed_once_and_kept_in_files_until_it_is_written(spark, place, monkeypatch):
    wire = messages(spark, RAW, {**RAW, "account": "unknown"}, "{", None).coalesce(1)
    passed, seen = spark.sparkContext.accumulator(0), []

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(ingest, "_refuse", lambda rows, fatal: seen.append((rows.storageLevel.useMemory, rows.inputFiles())))
    ingest.ingest_batch(wire.mapInArrow(counted, wire.schema), 0, job(place))
    assert passed.value == 4
    cached, kept = seen[0]
    assert not cached and kept
    assert not any(os.path.exists(file.removeprefix("file://")) for file in kept)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in found.split("\n") if "shuffle_" in name}


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_shuffle_files_of_a_batch_go_with_it(spark, place):
    wire = messages(spark, RAW, {**RAW, "account": "unknown"}, "{", None)
    # Keys to provision are cached, and the shuffles of a cached frame stay with it.
    work = job(place)
    work = replace(work, sinks=replace(work.sinks, provisioning=None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = shuffle_files(spark)
        ingest.ingest_batch(wire, 0, work)
        assert not shuffle_files(spark) - before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_batches_by_bytes_hold_the_same_rows(spark, place):
    for i in range(3):
        messages(spark, RAW, "{", offset=10 * i).coalesce(1).write.mode("append").json(place("wire"))
    source = WireSource("json", place("wire"), max_bytes_per_batch=1)
    raw_ingest_stream(spark, source, job(place), place("checkpoint")).awaitTermination()
    stored = points_table.read_points(spark, place("points"))
    assert stored.select("batch_id").distinct().count() == stored.count() == 3
    assert letters(spark, place) == [("ingest", "malformed_json")] * 3


ODD = ("{", None, "null", "[]", "[{}]", "{}", "17", '{"account": {"a": 1}}')
SPOILED = ({"accountType": "FOO"}, {"account": 17}, {"account": None}, {"account": " a b "}, {"account": "unknown"}, {"collectionName": ["x"]}, {"units": {}}, {"start": "x"})


@pytest.mark.parametrize("kind, record, topic", [("raw", RAW, "unified.metrics.json"), ("rollup", ROLLUP, "unified.metrics.json.5m"), ("rollup", ROLLUP, "unified.metrics.json.60m")])
def test_messages_are_routed_before_they_are_decoded(spark, kind, record, topic):
    whole = json.dumps(record)
    cut = [whole[:n] for n in range(10, len(whole), 25)]
    wire = messages(spark, record, *({**record, **odd} for odd in SPOILED), *ODD, *cut, f"[{whole}]", f"[{whole}, {{}}]", whole + "x", topic=topic)
    pipeline = raw_pipeline if kind == "raw" else rollup_pipeline
    expected, rows = pipeline(wire, routes(spark), as_of=2_000_000_000), routed_points(wire, kind, routes(spark), as_of=2_000_000_000)
    ours, theirs = ([r.asDict(recursive=True) for r in found.orderBy("offset").collect()] for found in (rows, expected))
    assert ours == theirs
    # What crosses the join's shuffle is the message, not the point made of it.
    joins = [node for node in nodes(rows._jdf.queryExecution().optimizedPlan()) if node.nodeName() == "Join"]
    crossing = joins[0].children().apply(0).output().mkString(",")
    assert "value" in crossing and not any(name in crossing for name in ("tags", "fields", "line", "metrics"))


def test_kept_batches_points_and_dead_letters_are_compressed_alike(spark, place, monkeypatch):
    kept = []
    monkeypatch.setattr(ingest, "_refuse", lambda rows, fatal: kept.extend(rows.inputFiles()))
    ingest.ingest_batch(messages(spark, RAW, "{"), 0, job(place))
    written = [name for sink in ("points", "dead") for name in spark.read.parquet(place(sink)).inputFiles()]
    assert kept and written and all(name.endswith(".zstd.parquet") for name in kept + written)
