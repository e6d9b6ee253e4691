"""The registered queries against their SQL on the smallest data set."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog import fixtures, queries
from catalog.oracle import all_oracles
from catalog.queries import all_queries

SF = "/root/testdata/sf0.001"
STREAMED_OR_WRITTEN = ("ingest", "stream", "replay", "commit", "policy", "dead", "limits", "rotation", "counter",
                       "timings", "restore", "backup", "write", "rows")
QUICK = [n for n in all_queries() if not any(word in n for word in STREAMED_OR_WRITTEN)]


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_sql(spark, sql, name):
    result = entry.queries()[name](spark, SF)
    columns = sorted(result.columns)
    expected = sql.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = expected.select(quoted).fetchall()
    ours = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(map(repr, ours)) == sorted(map(repr, theirs))


def test_no_task_holds_a_whole_batch(spark):
    # Files of one row group each, as a batch's messages are at this size, cannot be split.
    source = queries._raw_source(spark, SF, batches=2)
    sizes = [row["n"] for row in spark.read.parquet(source.path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 2 * source.max_files_per_batch == 2 * spark.sparkContext.defaultParallelism
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_events_of_one_row_group_are_shared_by_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    source = queries._raw_source(spark, SF)
    messages = spark.read.parquet(source.path)
    sizes = [row["n"] for row in messages.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= cores
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_rollups_are_shared_by_the_cores(spark):
    # Spark joins the partitions of a small aggregate into few.
    rollups = fixtures.rollup_records(fixtures.events(spark, SF))
    sizes = [row["n"] for row in rollups.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_rollup_messages_are_written_level_by_level(spark):
    # Each level's shuffles are gone before the next level's, and a batch takes a bounded share of the files.
    source = queries._rollup_source(spark, SF)
    written = spark.read.parquet(source.path)
    together = fixtures.rollup_wire(fixtures.events(spark, SF))
    assert sorted(map(repr, written.collect())) == sorted(map(repr, together.collect()))
    levels = written.groupBy(F.input_file_name()).agg(F.countDistinct("topic").alias("n")).collect()
    assert {row["n"] for row in levels} == {1}
    assert "maxBytesPerTrigger" in source.read_options()
