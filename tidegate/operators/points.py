"""Typed records to points with tags, fields, time and line text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.identity import measurement_name, tenant_id
from tidegate.functions.lines import encode_line
from tidegate.functions.metrics import (
    raw_fields,
    raw_metrics,
    rollup_fields,
    rollup_metrics,
    unit_tags,
)
from tidegate.functions.settle import settle
from tidegate.functions.tags import build_tags
from tidegate.functions.times import event_time_seconds
from tidegate.operators.quarantine import raw_reason, rollup_reason
from tidegate.schemas import DIMENSIONS, ORIGIN, RAW_LEVEL, RAW_TOPIC, ROLLUP_LEVELS

# Columns of every point, raw or rollup.
POINT_COLUMNS = (
    *ORIGIN,
    "level",
    "monitoring_system",
    "tenant_id",
    "measurement",
    "tags",
    "fields",
    "int_fields",
    "ts_s",
    "line",
    "reason",
)


def topic_level(topic: Column) -> Column:
    """Level a topic carries; NULL for a topic that is not ours."""
    level = F.when(topic == RAW_TOPIC, RAW_LEVEL)
    for name in ROLLUP_LEVELS:
        level = level.when(topic == f"{RAW_TOPIC}.{name}", name)
    return level


def with_identity(records: DataFrame) -> DataFrame:
    """Add tenant and measurement."""
    return records.withColumns(
        {
            "tenant_id": tenant_id(F.col("accountType"), F.col("account")),
            "measurement": measurement_name(F.col("monitoringSystem"), F.col("collectionName")),
        }
    )


def dimensions(records: DataFrame) -> DataFrame:
    """Origin, identity and metadata columns of raw or rollup records."""
    return records.select(*ORIGIN, *DIMENSIONS)


def with_raw_metrics(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "metrics", raw_metrics(F.col("ivalues"), F.col("fvalues"), F.col("units"))
    )


def with_rollup_metrics(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "metrics", rollup_metrics(F.col("ivalues"), F.col("fvalues"), F.col("units"))
    )


def points_long(records: DataFrame) -> DataFrame:
    """One row per metric entry of records that carry ``metrics``."""
    kept = [name for name in records.columns if name != "metrics"]
    return records.select(*kept, F.inline("metrics"))


def raw_points(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw records -> points; those that cannot become one keep a reason and no line.

    ``reason`` of the input, if any, comes first. ``keep`` names further input
    columns to carry along.
    """
    prepared = with_raw_metrics(with_identity(records)).withColumn(
        "ts_s", event_time_seconds(F.col("timestamp"))
    )
    return _points(
        prepared,
        level=F.lit(RAW_LEVEL),
        refusal=raw_reason(F.col("metrics"), F.col("ts_s")),
        fields=raw_fields(F.col("metrics")),
        int_fields=None,
        keep=keep,
    )


def rollup_points(
    records: DataFrame, keep: tuple[str, ...] = (), rollup_time: str | None = None
) -> DataFrame:
    """Rollup records -> points of the level their topic carries.

    They have no time of their own; ``rollup_time`` ("start" or "end") takes one
    bound of the record, in seconds, instead.
    """
    seconds = F.col(rollup_time) if rollup_time else F.lit(None).cast("bigint")
    return _points(
        with_rollup_metrics(with_identity(records)).withColumn("ts_s", seconds),
        level=topic_level(F.col("topic")),
        refusal=rollup_reason(F.col("metrics")),
        fields=rollup_fields(F.col("metrics")),
        int_fields=F.create_map(F.lit("start"), F.col("start"), F.lit("end"), F.col("end")),
        keep=keep,
    )


def _points(
    records: DataFrame,
    level: Column,
    refusal: Column,
    fields: Column,
    int_fields: Column | None,
    keep: tuple[str, ...],
) -> DataFrame:
    tags = build_tags(F.col("tenant_id"), unit_tags(F.col("metrics")))

    def text(tags: Column, fields: Column, int_fields: Column | None) -> Column:
        return encode_line(F.col("measurement"), tags, fields, F.col("ts_s"), int_fields)

    earlier = F.col("reason") if "reason" in records.columns else F.lit(None).cast("string")
    # A line feed would split the line on its way out. Trimming may still remove it,
    # so the line decides, but only where some part of the record holds one.
    broken = F.when(
        _source_text().contains("\n"),
        F.when(text(tags, fields, int_fields).contains("\n"), "newline_in_line"),
    )
    checked = records.withColumn("reason", F.coalesce(earlier, refusal)).withColumn(
        "reason", F.when(F.col("reason").isNotNull(), F.col("reason")).otherwise(broken)
    )
    settled = settle(checked, "tenant_id", "measurement", "ts_s", "reason")
    sound = F.col("reason").isNull()
    no_ints = F.lit(None).cast("map<string,bigint>")
    built = settled.select(
        *ORIGIN,
        level.alias("level"),
        F.col("monitoringSystem").alias("monitoring_system"),
        "tenant_id",
        "measurement",
        F.when(sound, tags).alias("tags"),
        F.when(sound, fields).alias("fields"),
        (no_ints if int_fields is None else F.when(sound, int_fields)).alias("int_fields"),
        "ts_s",
        "reason",
        *keep,
    )
    ints = None if int_fields is None else F.col("int_fields")
    line = F.when(F.col("reason").isNull(), text(F.col("tags"), F.col("fields"), ints))
    return built.withColumn("line", line).select(*POINT_COLUMNS, *keep)


def _source_text() -> Column:
    """All text of a record that its line may hold, run together."""
    maps = ("deviceMetadata", "systemMetadata", "units")
    plain = [name for name in DIMENSIONS if not name.endswith("Metadata")]
    return F.concat_ws(
        "",
        *plain,
        *(part for name in maps for part in (F.map_keys(name), F.map_values(name))),
        *(F.map_keys(name) for name in ("ivalues", "fvalues")),
    )
