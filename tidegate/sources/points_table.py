"""The points table: Parquet by instance, database, policy, day and batch, with merged parts (``generations``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.places import instance_host
from tidegate.functions.times import utc_day
from tidegate.sources import generations
from tidegate.sources.layout import CODEC, ROWS_PER_FILE
from tidegate.sources.manifest import replace_batch

PLACE = ("host", "database", "retention_policy", "day")
STORED = {
    "level": "STRING",
    "tenant_id": "STRING",
    "measurement": "STRING",
    "tags": "MAP<STRING, STRING>",
    "fields": "MAP<STRING, DOUBLE>",
    "int_fields": "MAP<STRING, BIGINT>",
    "ts_s": "BIGINT",
}
# The batch comes innermost, so an instance is one directory whoever wrote to it.
PARTITIONS = (*PLACE, "batch_id")
# Names are text also where they look like numbers.
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in {**STORED, **dict.fromkeys(PLACE, "STRING")}.items())
# Rows of a place that belong together lie side by side.
ORDER = ("measurement", "tenant_id", "ts_s")

# Day of points without a time of their own.
UNDATED = "undated"
# Batch of points that no stream wrote.
NO_BATCH = -1


def stored_points(routed: DataFrame, batch_id: int = NO_BATCH) -> DataFrame:
    """Routed points with the place they are stored in; names are URL-encoded there."""
    return routed.select(
        *STORED,
        F.url_encode(instance_host(F.col("path"))).alias("host"),
        F.url_encode("database").alias("database"),
        F.url_encode("retention_policy").alias("retention_policy"),
        F.coalesce(utc_day(F.col("ts_s")), F.lit(UNDATED)).alias("day"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def laid_out(stored: DataFrame) -> DataFrame:
    """The rows as they are written: places together, crowded ones split by Spark, series side by side."""
    return (
        stored.select(*STORED, *PARTITIONS)
        .hint("rebalance", *(F.col(name) for name in PARTITIONS))
        .sortWithinPartitions(*PARTITIONS, *ORDER)
    )


def write_points(
    stored: DataFrame, folder: str, rows_per_file: int = ROWS_PER_FILE, mode: str = "append"
) -> None:
    """Write rows of ``stored_points`` in one pass.

    ``overwrite`` replaces the places and batches that the rows belong to and no others.
    """
    (
        laid_out(stored)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", CODEC)
        .partitionBy(*PARTITIONS)
        .parquet(folder)
    )


def write_batch(stored: DataFrame, folder: str, batch_id: int, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the rows of one batch in the place of what its earlier runs wrote, wherever that was.

    Without rows, what earlier runs wrote is removed. A batch that was compacted meanwhile is replaced as well.
    """
    replace_batch(stored, folder, batch_id, PARTITIONS, lambda: write_points(stored, folder, rows_per_file, mode="overwrite"))
    generations.revive_batch(stored.sparkSession, folder, batch_id)


def compact_points(
    spark: SparkSession, folder: str, upto_batch: int, rows_per_file: int = ROWS_PER_FILE, most_parts: int = generations.MOST_PARTS
) -> generations.Generation:
    """Merge the small files of committed batches; the batch of each row is kept."""
    return generations.compact(spark, folder, SCHEMA, upto_batch, PLACE, ORDER, rows_per_file, most_parts)


def batch_files(spark: SparkSession, folder: str) -> DataFrame:
    """What stands in the batches' own files, without parts; the table that writes go to."""
    return spark.read.schema(f"{SCHEMA}, batch_id BIGINT").parquet(folder)


def read_encoded(spark: SparkSession, folder: str) -> DataFrame:
    """The table with its names as they stand in the directories."""
    return generations.read_live(spark, folder, SCHEMA)


def read_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_encoded(spark, folder)
    return rows.withColumns({name: F.url_decode(name) for name in PLACE[:3]})
