"""The pipeline's own counters as line protocol (plain text, as received, no time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingested_count_lines(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.format_string(
            "ingested_data_count,topic=%s,partitionid=%d,monitoringsystem=%s count=%d",
            "topic", "partition", "monitoring_system", "records",
        ).alias("line")
    )


def records_count_line(total: DataFrame, listener: str, hostname: str) -> DataFrame:
    return total.select(
        F.format_string(
            "ingestion_records_count,listener=%s,hostname=%s count=%d",
            F.lit(listener), F.lit(hostname), F.col("records"),
        ).alias("line")
    )


def payload_lines(stats: DataFrame, listener: str, hostname: str) -> DataFrame:
    return stats.select(
        F.format_string(
            "ingestion_payload,listener=%s,hostname=%s payloadrecordscount=%d,payloadsize=%d",
            F.lit(listener), F.lit(hostname), F.col("payload_records"), F.col("payload_bytes"),
        ).alias("line")
    )


def ops_metric_lines(
    counts: DataFrame, total: DataFrame, stats: DataFrame, listener: str, hostname: str
) -> DataFrame:
    """All lines of one batch: one per source count, one total, one per payload."""
    return (
        ingested_count_lines(counts)
        .unionByName(records_count_line(total, listener, hostname))
        .unionByName(payload_lines(stats, listener, hostname))
    )


def stage_lines(spark: SparkSession, millis: dict[str, int], listener: str, hostname: str) -> DataFrame:
    """One line per stage of a batch; the stages are few and known to the driver alone."""
    lines = [
        (f"ingestion_stage,listener={listener},hostname={hostname},stage={stage} millis={value}",)
        for stage, value in millis.items()
    ]
    return spark.createDataFrame(lines, "line STRING")


def stage_timings(ops: DataFrame) -> DataFrame:
    """Milliseconds per batch and stage, from the ops lines of all batches."""
    pattern = "^ingestion_stage,listener=([^,]*),hostname=.*,stage=([a-z_]+) millis=([0-9]+)$"
    part = [F.regexp_extract("line", pattern, i) for i in (1, 2, 3)]
    return ops.where(F.col("scope") == "stage").select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        part[0].alias("listener"),
        part[1].alias("stage"),
        part[2].cast("bigint").alias("millis"),
    )
