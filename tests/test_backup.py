import glob
import gzip

import pytest
from pyspark.sql import functions as F

from tidegate.plans.restore import restore_target, restored_points, wipe_then_restore
from tidegate.schemas import ROUTES
from tidegate.sources import backup, points_table

SCHEMA = (
    "topic STRING, `partition` INT, `offset` BIGINT, measurement STRING, path STRING, "
    "database STRING, retention_policy STRING, ts_s BIGINT, line STRING"
)


def routed(spark, *rows):
    full = [("t", 0, i, "m", *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def one(number, path="https://node-1.com:8080", database="myDB1", policy="1440h"):
    ts = 1557777267 + number
    return (path, database, policy, ts, f"m,tenantId=t f={number}.0 {ts}")


def test_one_file_per_place_with_header_and_ordered_lines(spark, tmp_path):
    second = {"path": "https://node-2.com:8080", "database": "myDB2"}
    rows = routed(spark, *(one(i) for i in range(3)), *(one(i, **second) for i in range(3))).repartition(4)
    backup.write_backup(backup.backup_lines(rows), str(tmp_path / "b"))
    files = sorted(glob.glob(f"{tmp_path}/b/host=*/database=*/retention_policy=*/day=*/*.gz"))
    assert len(files) == 2
    for number, name in enumerate(files, 1):
        assert f"/host=node-{number}.com/database=myDB{number}/retention_policy=1440h/day=20190513/" in name
        assert gzip.open(name, "rt").read().splitlines() == [
            "# DML",
            f"# CONTEXT-DATABASE: myDB{number}",
            "# CONTEXT-RETENTION-POLICY: 1440h",
            *(one(i)[-1] for i in range(3)),
        ]
    assert backup.header_mismatches(spark, str(tmp_path / "b")).count() == 0


def test_a_crowded_place_is_split_and_stays_whole(spark, tmp_path):
    rows = routed(spark, *(one(i) for i in range(300)), one(0, database="small"))
    folder = str(tmp_path / "b")
    # So few rows would otherwise be put into one task, and so into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        backup.write_backup(backup.backup_lines(rows), folder, rows_per_file=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{folder}/host=*/database=myDB1/*/*/*.gz")
    assert 2 <= len(files) <= 6 and len(glob.glob(f"{folder}/host=*/database=small/*/*/*.gz")) == 1
    assert all(gzip.open(name, "rt").readline() == "# DML\n" for name in files)
    back = backup.read_backup(spark, folder)
    assert sorted(r["line"] for r in back.where("database = 'myDB1'").collect()) == sorted(one(i)[-1] for i in range(300))
    compacted = str(tmp_path / "c")
    backup.compact_backup(spark, folder, compacted)
    assert len(glob.glob(f"{compacted}/host=*/database=myDB1/*/*/*.gz")) == 1
    assert backup.read_backup(spark, compacted).count() == 301


def test_the_input_is_computed_once_and_sorted_once(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    rows = routed(spark, *(one(i) for i in range(200)), *(one(i, database="other") for i in range(30))).repartition(3)
    lines = backup.backup_lines(rows)
    lines = lines.mapInArrow(counted, lines.schema)
    backup.write_backup(lines, str(tmp_path / "b"), rows_per_file=70)
    assert passed.value == 230
    backup.compact_backup(spark, str(tmp_path / "b"), str(tmp_path / "c"), rows_per_file=70)
    for folder, files in (("b", 3), ("c", 3)):
        assert backup.read_backup(spark, str(tmp_path / folder)).count() == 230
        crowded = sorted(glob.glob(f"{tmp_path}/{folder}/host=*/database=myDB1/*/*/*.gz"))
        texts = [gzip.open(name, "rt").read().splitlines() for name in crowded]
        assert len(texts) >= files and all(text[0] == "# DML" and text[3] != "# DML" for text in texts)
        assert all(len(text) <= 73 and text[3:] == sorted(text[3:], key=lambda line: int(line.split()[-1])) for text in texts)


def test_names_that_need_encoding_have_their_own_header(spark, tmp_path):
    rows = routed(spark, one(1, database="a/b", policy="p"), one(2, database="a", policy="b/p"))
    backup.write_backup(backup.backup_lines(rows), str(tmp_path / "b"))
    assert backup.header_mismatches(spark, str(tmp_path / "b")).count() == 0
    assert backup.read_backup(spark, str(tmp_path / "b")).count() == 2


def test_odd_names_and_carriage_returns_come_back(spark, tmp_path):
    line = 'm,tenantId=t,a="x\ry" f=1.0 1557777267'
    rows = routed(spark, ("http://test_x.com", "a/b%", "a b", 1557777267, line))
    backup.write_backup(backup.backup_lines(rows), str(tmp_path / "b"))
    row = backup.read_backup(spark, str(tmp_path / "b"), host="test_x.com").first()
    assert (row["host"], row["database"], row["retention_policy"], row["day"], row["line"]) == (
        "test_x.com", "a/b%", "a b", "20190513", line,
    )


def test_reading_one_instance_leaves_other_directories_unread(spark, tmp_path):
    rows = routed(spark, one(1), one(2, path="http://other:1"))
    backup.write_backup(backup.backup_lines(rows), str(tmp_path / "b"))
    read = backup.read_backup(spark, str(tmp_path / "b"), host="other")
    assert [r["line"] for r in read.collect()] == [one(2)[-1]]
    assert len(read.inputFiles()) == 2  # the pruning shows in the plan, not here
    assert "PartitionFilters: [isnotnull(host" in read._jdf.queryExecution().executedPlan().toString()


def test_guards(spark, tmp_path):
    rows = routed(
        spark, one(1), one(2, database=" "), one(3, policy=None), one(4, path="http://:1"),
        ("http://h", "d", "p", None, "m f=1.0"),
    )
    lines = backup.backup_lines(rows)
    assert [r["backup_reason"] for r in lines.orderBy("offset").collect()] == [
        None, "blank_database", "blank_retention_policy", "blank_host", "no_timestamp",
    ]
    backup.write_backup(lines, str(tmp_path / "off"), enabled=False)
    assert not (tmp_path / "off").exists()
    blank = spark.range(1).select(backup.payload_guards(F.lit(" \t"), F.lit("d"), F.lit("p"), F.lit("http://h")))
    assert blank.first()[0] == "blank_payload"


def test_header_of_another_database_is_found(spark, tmp_path):
    place = tmp_path / "b/host=h/database=d/retention_policy=p/day=20190513"
    place.mkdir(parents=True)
    with gzip.open(place / "x.gz", "wt") as out:
        out.write("# DML\n# CONTEXT-DATABASE: wrong\n# CONTEXT-RETENTION-POLICY: p\nm f=1.0 1557777267\n")
    wrong = backup.header_mismatches(spark, str(tmp_path / "b")).collect()
    assert [r["value"] for r in wrong] == ["# CONTEXT-DATABASE: wrong"]


@pytest.mark.parametrize("host", ["node-1.com", "a b%*~"])
def test_restore_and_wipe(spark, tmp_path, host):
    folder, source = str(tmp_path / "points"), str(tmp_path / "b")
    path = f"http://{host}:1"
    rows = routed(spark, one(1, path=path), one(2, path=path), one(3, path="http://other:1"))
    backup.write_backup(backup.backup_lines(rows), source)
    assert restored_points(spark, source).count() == 3
    for _ in range(2):
        restore_target(spark, source, host, folder)
    restore_target(spark, source, "other", folder)

    def counts():
        stored = points_table.read_points(spark, folder)
        return {r["host"]: r["count"] for r in stored.groupBy("host").count().collect()}

    assert counts() == {host: 4, "other": 1}  # replay is no overwrite
    for _ in range(2):
        wipe_then_restore(spark, source, host, folder)
        assert counts() == {host: 2, "other": 1}


def test_names_like_numbers_and_levels_come_back(spark, tmp_path):
    folder, source = str(tmp_path / "points"), str(tmp_path / "b")
    rows = routed(spark, one(1, database="007", policy="010"), one(2, database="007", policy="020"))
    backup.write_backup(backup.backup_lines(rows), source)
    routes = spark.createDataFrame(
        [("t", "m", level, one(1)[0], "007", policy, "1d") for level, policy in (("5m", "010"), ("full", "020"), ("20m", "020"))],
        ROUTES,
    )
    restore_target(spark, source, "node-1.com", folder, routes=routes)
    stored = points_table.read_points(spark, folder).orderBy("retention_policy").collect()
    # A policy of two levels does not tell which one it was.
    assert [(r["database"], r["retention_policy"], r["level"]) for r in stored] == [("007", "010", "5m"), ("007", "020", None)]


def test_a_backup_without_the_instance_wipes_nothing(spark, tmp_path):
    folder, source = str(tmp_path / "points"), str(tmp_path / "b")
    backup.write_backup(backup.backup_lines(routed(spark, one(1))), source)
    restore_target(spark, source, None, folder)
    with pytest.raises(ValueError, match="nothing of 'unknown'"):
        wipe_then_restore(spark, source, "unknown", folder)
    assert points_table.read_points(spark, folder).count() == 1


def test_times_before_1970_and_comments_are_refused(spark):
    rows = routed(spark, ("http://h", "d", "p", -1, "m f=1.0 -1"), ("http://h", "d", "p", 0, "m f=1.0 0"))
    assert [r["backup_reason"] for r in backup.backup_lines(rows).orderBy("offset").collect()] == ["no_timestamp", None]
    refused = spark.range(1).select(backup.payload_guards(F.lit("#a_m f=1.0 1"), F.lit("d"), F.lit("p"), F.lit("http://h")))
    assert refused.first()[0] == "comment_line"
