"""Replay of a backup into the points table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.lines import parse_lines
from tidegate.functions.places import instance_host
from tidegate.functions.times import utc_day
from tidegate.session import scratch_folder
from tidegate.sources.backup import read_backup
from tidegate.sources.generations import leave_out_host
from tidegate.sources.layout import ROWS_PER_FILE
from tidegate.sources.points_table import NO_BATCH, PARTITIONS, STORED, UNDATED, batch_files, laid_out, read_encoded, write_points

_TARGET = ("host", "database", "retention_policy")


def restored_points(spark: SparkSession, backup: str, host: str | None = None) -> DataFrame:
    """Points parsed from the backup, of one instance or of all."""
    return parse_lines(read_backup(spark, backup, host).drop("day"))


def target_levels(routes: DataFrame) -> DataFrame:
    """Level of each (host, database, policy) that the routes use for one level only."""
    return (
        routes.groupBy(instance_host(F.col("path")).alias("host"), "database", "retention_policy")
        .agg(F.min("rollup_level").alias("level"), F.max("rollup_level").alias("_last"))
        .where(F.col("level") == F.col("_last"))
        .drop("_last")
    )


def _stored(points: DataFrame, routes: DataFrame | None) -> DataFrame:
    """A line does not tell its level: routes do, and without them it stays NULL."""
    if routes is None:
        points = points.withColumn("level", F.lit(None).cast("string"))
    else:
        points = points.join(target_levels(routes), list(_TARGET), "left")
    return points.select(
        "level",
        F.try_element_at("tags", F.lit("tenantId")).alias("tenant_id"),
        "measurement", "tags", "fields", "int_fields", "ts_s",
        *(F.url_encode(name).alias(name) for name in _TARGET),
        F.coalesce(utc_day(F.col("ts_s")), F.lit(UNDATED)).alias("day"),
        F.lit(NO_BATCH).cast("bigint").alias("batch_id"),
    )


def restore_target(
    spark: SparkSession,
    backup: str,
    host: str | None,
    folder: str,
    rows_per_file: int = ROWS_PER_FILE,
    routes: DataFrame | None = None,
) -> None:
    """Add the backup of one instance, or of all, to the points. Replay does not overwrite."""
    write_points(_stored(restored_points(spark, backup, host), routes), folder, rows_per_file)


def wipe_then_restore(
    spark: SparkSession,
    backup: str,
    host: str,
    folder: str,
    rows_per_file: int = ROWS_PER_FILE,
    routes: DataFrame | None = None,
) -> None:
    """Replace all points of one instance by its backup; other instances stay untouched.

    All days and batches of the instance go, also those that the backup does not hold.
    The backup is parsed into a folder of its own first: a backup without a line of the
    instance stops the job before anything is wiped. Running it again gives the same result.
    """
    staged = scratch_folder(spark, "restore")
    write_points(_stored(restored_points(spark, backup, host), routes), staged, rows_per_file)
    rows = read_encoded(spark, staged)
    if rows.isEmpty():
        raise ValueError(f"the backup holds nothing of {host!r}; its points are left as they are")
    # URL-encoded, so without quotes or backslashes.
    encoded = spark.range(1).select(F.url_encode(F.lit(host))).first()[0]
    columns = ", ".join((*STORED, *PARTITIONS[1:]))
    views = [f"tidegate_{uuid.uuid4().hex}" for _ in range(2)]
    table, source = views
    try:
        leave_out_host(spark, folder, encoded)
        batch_files(spark, folder).createOrReplaceTempView(table)
        laid_out(rows).createOrReplaceTempView(source)
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (host = '{encoded}', {', '.join(PARTITIONS[1:])}) "
            f"SELECT {columns} FROM {source}"
        )
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
