"""From messages to routed points, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.settle import settle
from tidegate.operators.decode import decode_raw, decode_rollup
from tidegate.operators.points import raw_points, rollup_points, topic_level, with_identity
from tidegate.operators.routing import KEY, TARGET, attach_routes, is_beyond_retention
from tidegate.schemas import ORIGIN, RAW_FIELDS, RAW_LEVEL, ddl

# The fields of a record, raw or rollup, that tenant and measurement are made of.
_KEY_FIELDS = ("accountType", "account", "monitoringSystem", "collectionName")


def raw_pipeline(messages: DataFrame, routes: DataFrame, as_of: int | None = None, salts: int = 1) -> DataFrame:
    """Raw messages -> points with target and reason (the message is kept as ``value``)."""
    return route_points(raw_decoded(messages), routes, as_of, salts)


def rollup_pipeline(
    messages: DataFrame,
    routes: DataFrame,
    as_of: int | None = None,
    salts: int = 1,
    rollup_time: str | None = None,
) -> DataFrame:
    """Rollup messages of any level -> points with target and reason."""
    return route_points(rollup_decoded(messages, rollup_time), routes, as_of, salts)


def raw_decoded(messages: DataFrame, keep: tuple[str, ...] = ("value",)) -> DataFrame:
    return raw_points(decode_raw(messages), keep=keep)


def rollup_decoded(messages: DataFrame, rollup_time: str | None = None, keep: tuple[str, ...] = ("value",)) -> DataFrame:
    return rollup_points(decode_rollup(messages), keep=keep, rollup_time=rollup_time)


def routed_points(
    messages: DataFrame, kind: str, routes: DataFrame, as_of: int | None = None, salts: int = 1, rollup_time: str | None = None
) -> DataFrame:
    """The same rows as ``raw_pipeline`` or ``rollup_pipeline``, with the message in the join instead of the point.

    A point with its message takes four times what the message takes, and all of it crosses
    the shuffle where routes are too many to broadcast. So the key is read from the message
    first, and the message that comes out of the join is decoded there.
    """
    record = F.from_json("value", ddl({name: RAW_FIELDS[name] for name in _KEY_FIELDS}))
    named = messages.select(*ORIGIN, "value", record.alias("_r")).select(*ORIGIN, "value", *(f"_r.{name}" for name in _KEY_FIELDS))
    level = F.lit(RAW_LEVEL) if kind == "raw" else topic_level(F.col("topic"))
    keyed = settle(with_identity(named).drop(*_KEY_FIELDS), *KEY).withColumn("level", level)
    routed = attach_routes(keyed, routes, salts).drop(*KEY, "level")
    keep = ("value", *TARGET, "route_reason")
    points = raw_decoded(routed, keep) if kind == "raw" else rollup_decoded(routed, rollup_time, keep)
    # A message that does not decode has no key, though its text may hold one.
    has_key = F.col("tenant_id").isNotNull() & F.col("measurement").isNotNull()
    found = {name: F.when(has_key, F.col(name)) for name in TARGET}
    return _judged(points.withColumns({**found, "route_reason": F.when(has_key, F.col("route_reason")).otherwise("no_route")}), as_of)


def route_points(points: DataFrame, routes: DataFrame, as_of: int | None = None, salts: int = 1) -> DataFrame:
    """Add target and reason to points that carry their message."""
    return _judged(attach_routes(points, routes, salts), as_of)


def _judged(routed: DataFrame, as_of: int | None) -> DataFrame:
    late = F.lit(None).cast("string")
    if as_of is not None:
        late = F.when(is_beyond_retention(F.col("ts_s"), F.col("retention"), as_of), "beyond_retention")
    reason = F.coalesce(F.col("reason"), F.col("route_reason"), late)
    return routed.withColumn("reason", reason).drop("route_reason")
