"""Reruns that go elsewhere, the table of seen keys, compaction and rotation while readers look on."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.records import RAW, messages
from tests.test_backup import one, routed
from tidegate.plans.restore import wipe_then_restore
from tidegate.schemas import ROUTES
from tidegate.sources import backup, files, generations, points_table
from tidegate.sources.manifest import replace_batch
from tidegate.sources.snapshots import SeenTable
from tidegate.sources.wire import WireSource
from tidegate.streaming import ingest
from tidegate.streaming.ingest import IngestJob, Sinks, ingest_batch, raw_ingest_stream

KEY = ("CORE-acct:5550101", "MAAS_agent.filesystem")


def routes_to(*hosts):
    rows = [(*KEY, "full", f"http://{host}:1", "db", "rp_5d", "5d") for host in hosts]
    return lambda spark: spark.createDataFrame(rows, ROUTES)


def job(tmp_path, routes, **sinks):
    return IngestJob("raw", routes, Sinks(points=str(tmp_path / "points"), dead_letter=str(tmp_path / "dead"), **sinks), hostname="box")


def hosts(spark, folder):
    return {r["host"]: r["count"] for r in points_table.read_points(spark, str(folder)).groupBy("host").count().collect()}


def test_a_rerun_replaces_what_the_first_run_wrote_elsewhere(spark, tmp_path):
    two = messages(spark, RAW, RAW)
    for routes, expected in ((routes_to("h1"), {"h1": 2}), (routes_to("a b%"), {"a b%": 2}), (routes_to(), {}), (routes_to("h1"), {"h1": 2})):
        ingest_batch(two, 0, job(tmp_path, routes))
        assert hosts(spark, tmp_path / "points") == expected
    ingest_batch(messages(spark, RAW, offset=5), 1, job(tmp_path, routes_to("h2")))
    ingest_batch(two, 0, job(tmp_path, routes_to("h2")))
    assert hosts(spark, tmp_path / "points") == {"h2": 3}


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_run_that_stops_anywhere_is_replaced(spark, tmp_path, fails):
    folder = str(tmp_path / "t")

    def rows(place):
        return spark.createDataFrame([(place, 0, 1)], "place string, batch_id long, x long")

    def write(df):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("place", "batch_id").parquet(folder)

    def broken(df):
        if fails == "after":
            write(df)
        raise OSError("lost")

    first, second = rows("one/1"), rows("two")
    with pytest.raises(OSError):
        replace_batch(first, folder, 0, ("place", "batch_id"), lambda: broken(first))
    replace_batch(second, folder, 0, ("place", "batch_id"), lambda: write(second))
    assert [r["place"] for r in spark.read.parquet(folder).collect()] == ["two"]
    assert len(files.names(spark, f"{folder}/_written/0")) == 1


def test_seen_keys_cost_the_same_in_every_batch(spark, tmp_path):
    table = SeenTable(spark, str(tmp_path / "seen"), "k string", ("k",), buckets=3)
    read = []
    for batch in range(14):
        keys = spark.createDataFrame([(f"k{n}",) for n in range(batch, batch + 12)], "k string")
        known = table.before(keys, batch)
        read.append(len(known.inputFiles()))
        table.add(keys.join(known, "k", "left_anti"), batch)
    assert read[0] == 0 and set(read[1:]) == {3}
    assert len(glob.glob(f"{tmp_path}/seen/bucket=*/as_of=*")) <= 6  # the present state of each bucket and the one before
    everything = spark.createDataFrame([(f"k{n}",) for n in range(40)], "k string")
    assert sorted(r["k"] for r in table.before(everything, 99).collect()) == sorted(f"k{n}" for n in range(25))
    # Run again with other keys, the last batch forgets those of its first run.
    for again in ((("new",),), ()):
        keys = spark.createDataFrame(list(again), "k string")
        table.add(keys.join(table.before(keys, 13), "k", "left_anti"), 13)
        got = {r["k"] for r in table.before(everything.unionByName(keys), 99).collect()}
        assert got == {f"k{n}" for n in range(24)} | {k for (k,) in again}


def test_points_are_read_once_before_during_and_after_compaction(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "points")
    for batch in range(4):
        ingest_batch(messages(spark, RAW, RAW, offset=2 * batch), batch, job(tmp_path, routes_to("h1")))

    def counted():
        rows = points_table.read_points(spark, folder)
        return {r["batch_id"]: r["count"] for r in rows.groupBy("batch_id").count().collect()}

    assert counted() == dict.fromkeys(range(4), 2)
    reader = points_table.read_points(spark, folder)  # planned before, read after
    seen = []
    with monkeypatch.context() as patch:
        def stopped(*args):
            seen.append(counted())
            raise OSError("lost")
        patch.setattr(generations, "commit", stopped)
        with pytest.raises(OSError):
            points_table.compact_points(spark, folder, 2)
    assert seen == [dict.fromkeys(range(4), 2)] and counted() == seen[0]
    points_table.compact_points(spark, folder, 2)
    assert counted() == seen[0] and reader.count() == 8
    assert len(files.names(spark, f"{folder}/_parts")) == 1  # that of the stopped run is gone
    assert points_table.read_points(spark, folder).where("batch_id < 3").select(F.input_file_name()).distinct().count() == 1
    # A rerun of a compacted batch, elsewhere and with fewer rows; the others stay.
    ingest_batch(messages(spark, RAW), 1, job(tmp_path, routes_to("h2")))
    assert counted() == {0: 2, 1: 1, 2: 2, 3: 2} and hosts(spark, folder) == {"h1": 6, "h2": 1}
    for upto, most in ((3, 16), (3, 1), (3, 16)):
        points_table.compact_points(spark, folder, upto, most_parts=most)
        assert counted() == {0: 2, 1: 1, 2: 2, 3: 2} and hosts(spark, folder) == {"h1": 6, "h2": 1}
    ingest_batch(messages(spark, RAW, offset=9), 4, job(tmp_path, routes_to("h1")))
    points_table.compact_points(spark, folder, 4, most_parts=2)  # merges the parts
    points_table.compact_points(spark, folder, 4)
    assert counted() == {0: 2, 1: 1, 2: 2, 3: 2, 4: 1}
    assert glob.glob(f"{folder}/host=*/**/*.parquet", recursive=True) == []
    ingest_batch(messages(spark, None), 2, job(tmp_path, routes_to("h1")))  # refuses all
    assert counted() == {0: 2, 1: 1, 3: 2, 4: 1}


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "points")
    ingest_batch(messages(spark, RAW), 0, job(tmp_path, routes_to("h1")))
    real = generations.commit

    def other_first(spark, folder, seen, new):
        monkeypatch.setattr(generations, "commit", real)
        points_table.compact_points(spark, folder, 0)
        real(spark, folder, seen, new)

    monkeypatch.setattr(generations, "commit", other_first)
    with pytest.raises(generations.Superseded):
        points_table.compact_points(spark, folder, 0)
    assert hosts(spark, folder) == {"h1": 1}


def test_wipe_leaves_compacted_points_of_the_instance_out(spark, tmp_path):
    folder, saved = str(tmp_path / "points"), str(tmp_path / "b")
    for batch, host in enumerate(("node-1.com", "other")):
        ingest_batch(messages(spark, RAW, RAW, offset=2 * batch), batch, job(tmp_path, routes_to(host)))
    points_table.compact_points(spark, folder, 1)
    backup.write_backup(backup.backup_lines(routed(spark, one(1))), saved)
    for _ in range(2):
        wipe_then_restore(spark, saved, "node-1.com", folder)
        assert hosts(spark, folder) == {"node-1.com": 1, "other": 2}


def lines_of(spark, folder, **options):
    return sorted(r["line"] for r in backup.read_backup(spark, folder, **options).collect())


def test_rotation_of_finished_days_beside_a_running_stream(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "b")

    def batch(number, *days):
        rows = routed(spark, *(("http://h:1", "db", "p", 1557705600 + 86400 * d + number, f"m f={number}.0 {1557705600 + 86400 * d + number}") for d in days))
        backup.write_backup(backup.backup_lines(rows), f"{folder}/batch_id={number}", mode="overwrite")
        return [r["line"] for r in rows.collect()]

    expected = sorted(sum((batch(n, 0, 1, 2) for n in range(3)), []))
    with monkeypatch.context() as patch:
        def stopped(*args):
            assert lines_of(spark, folder) == expected
            raise OSError("lost")
        patch.setattr(generations, "commit", stopped)
        with pytest.raises(OSError):
            backup.rotate_backup(spark, folder, 1, "20190514")
    reader = backup.read_backup(spark, folder)
    backup.rotate_backup(spark, folder, 1, "20190514")  # day 0 of batches 0 and 1
    assert lines_of(spark, folder) == expected and reader.count() == len(expected)
    assert len(glob.glob(f"{folder}/_parts/part=*/host=*/*/*/day=20190513/*.gz")) == 1
    # A batch of the running stream may be run again, and may bring late lines of a finished day.
    batch(2, 0, 1, 2)
    expected = sorted(expected + batch(3, 0, 3))
    assert lines_of(spark, folder) == expected
    for upto, day, most in ((3, "20190515", 16), (3, "20190516", 1), (3, "20190601", 16), (3, "20190601", 16), (3, "20190514", 16)):
        backup.rotate_backup(spark, folder, upto, day, most_parts=most)
        assert lines_of(spark, folder) == expected
        assert backup.header_mismatches(spark, folder).count() == 0
    assert lines_of(spark, folder, host="h") == expected and lines_of(spark, folder, host="x") == []
    assert not glob.glob(f"{folder}/batch_id=*/**/*.gz", recursive=True)


def test_stream_goes_on_after_compaction(spark, tmp_path):
    wire, checkpoint = str(tmp_path / "wire"), str(tmp_path / "checkpoint")
    work = job(tmp_path, routes_to("h1"), ops=str(tmp_path / "ops"), backup=str(tmp_path / "backup"))
    assert ingest.compact_sinks(spark, work, checkpoint) == -1
    for n in range(3):
        messages(spark, RAW, "{", offset=2 * n).coalesce(1).write.mode("append").json(wire)
        raw_ingest_stream(spark, WireSource("json", wire), work, checkpoint).awaitTermination()
        assert ingest.compact_sinks(spark, work, checkpoint, before_day="20300101") == n
        assert hosts(spark, tmp_path / "points") == {"h1": n + 1}
        assert backup.read_backup(spark, str(tmp_path / "backup")).count() == n + 1
        letters = ingest.read_dead_letters(spark, str(tmp_path / "dead")).collect()
        assert sorted((r["batch_id"], r["reason"]) for r in letters) == [(i, "malformed_json") for i in range(n + 1)]
        counted = ingest.read_ops(spark, str(tmp_path / "ops")).where("line LIKE 'ingestion_records_count%'")
        assert sorted(r["batch_id"] for r in counted.collect()) == list(range(n + 1))


def test_a_pointer_that_was_cut_off_is_never_in_effect(spark, tmp_path):
    folder = str(tmp_path / "points")
    ingest_batch(messages(spark, RAW), 0, job(tmp_path, routes_to("h1")))
    now = points_table.compact_points(spark, folder, 0)
    with open(os.path.join(folder, "_generations", f"{now.number + 1:012d}"), "w") as out:
        out.write('{"number": ')
    assert generations.current(spark, folder) == now and hosts(spark, folder) == {"h1": 1}
    ingest_batch(messages(spark, RAW, offset=1), 1, job(tmp_path, routes_to("h1")))
    assert points_table.compact_points(spark, folder, 1).number == now.number + 2
    assert hosts(spark, folder) == {"h1": 2}
