"""Grouping of lines into payloads, and the counts taken of a batch.

A payload holds the lines of one key in one poll. A poll is a run of offsets of one
partition, so a payload has at most ``POLL_RECORDS`` lines however large its tenant
is, and a hot tenant spreads over as many groups as it has polls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.places import payload_timestamp, utc_day
from tidegate.schemas import POLL_RECORDS

PAYLOAD_KEY = ("topic", "partition", "poll", "tenant_id", "measurement")


def poll_of(offset: Column, records: int = POLL_RECORDS) -> Column:
    """Number of the poll an offset falls into."""
    return F.floor(offset / records)


def with_poll(points: DataFrame, records: int = POLL_RECORDS) -> DataFrame:
    return points.withColumn("poll", poll_of(F.col("offset"), records))


def tenant_payloads(points: DataFrame, records: int = POLL_RECORDS) -> DataFrame:
    """Lines of each key in each poll, joined in order of arrival."""
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "line"))), lambda row: row["line"]
    )
    return (
        with_poll(points, records)
        .where(F.col("reason").isNull())
        .groupBy(*PAYLOAD_KEY)
        .agg(F.array_join(lines, "\n").alias("payload"))
    )


def payload_stats(points: DataFrame, records: int = POLL_RECORDS) -> DataFrame:
    """Records and bytes of each payload, without building it.

    A column ``line_bytes``, if there is one, spares the lines themselves.
    """
    count = F.count(F.lit(1))
    line_bytes = F.col("line_bytes") if "line_bytes" in points.columns else F.octet_length("line")
    size = F.sum(line_bytes.cast("bigint")) + count - 1
    return (
        with_poll(points, records)
        .where(F.col("reason").isNull())
        .groupBy(*PAYLOAD_KEY)
        .agg(count.alias("payload_records"), size.alias("payload_bytes"))
    )


def payload_backup_day(points: DataFrame, records: int = POLL_RECORDS) -> DataFrame:
    """Day a payload is filed under as a whole: that of its last line."""
    last = F.max_by(payload_timestamp(F.col("line")), "offset")
    return (
        with_poll(points, records)
        .where(F.col("reason").isNull())
        .groupBy(*PAYLOAD_KEY)
        .agg(utc_day(last).alias("day"))
    )


def ingested_data_count(records: DataFrame) -> DataFrame:
    """Decoded records per topic, partition and system, before any check of content."""
    return (
        records.where(F.col("monitoring_system").isNotNull())
        .groupBy("topic", "partition", "monitoring_system")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def ingestion_records_count(records: DataFrame, *by: str) -> DataFrame:
    """Records in all, or per batch where columns tell the batches apart."""
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


def unconverted_count(points: DataFrame) -> DataFrame:
    """Rows that became no point, and rows received."""
    return points.agg(
        F.count_if(F.col("reason").isNotNull()).alias("unconverted"),
        F.count(F.lit(1)).alias("received"),
    )


def replay_offsets(messages: DataFrame) -> DataFrame:
    """Where to start again after a failed batch."""
    return messages.groupBy("topic", "partition").agg(F.min("offset").alias("offset"))


def rollup_fan_in(*streams: DataFrame) -> DataFrame:
    """The streams of all levels as one."""
    first, *others = streams
    for other in others:
        first = first.unionByName(other)
    return first
