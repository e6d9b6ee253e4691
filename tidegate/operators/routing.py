"""Where points go: route lookup, default routes, provisioning, retention.

No join here is forced to broadcast: routes grow with the tenants. Spark broadcasts
them when their measured size is under its threshold and otherwise sort-merges,
splitting hot keys. ``salts`` spreads hot keys by hand where that is not enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.identity import route_key
from tidegate.functions.times import retention_seconds
from tidegate.schemas import DEFAULT_DATABASE, DEFAULT_PATH, DEFAULT_POLICIES, LEVELS

KEY = ("tenant_id", "measurement")
TARGET = ("path", "database", "retention_policy", "retention")


def routes_by_key(routes: DataFrame) -> DataFrame:
    """One row per (tenant, measurement) with a map level -> target.

    A map holds one entry per level, so it is as small as the list of levels. Of routes
    that repeat a level the least target counts.
    """
    target = F.struct(*TARGET)
    # One shuffle: each level is an aggregate of its own.
    per_level = routes.groupBy(*KEY).agg(
        *(F.min(F.when(F.col("rollup_level") == level, target)).alias(f"_{level}") for level in LEVELS)
    )
    entries = F.array(
        *(
            F.when(F.col(f"_{level}").isNotNull(), F.struct(F.lit(level).alias("level"), F.col(f"_{level}").alias("target")))
            for level in LEVELS
        )
    )
    return per_level.select(*KEY, F.map_from_entries(F.array_compact(entries)).alias("targets"))


def route_rows(routes: DataFrame) -> DataFrame:
    """One row per key and level, of routes as rows (left as they are) or by key."""
    if "targets" not in routes.columns:
        return routes
    rows = routes.select(*KEY, F.explode("targets").alias("rollup_level", "target"))
    return rows.select(*KEY, "rollup_level", *(F.col(f"target.{name}").alias(name) for name in TARGET))


def attach_routes(points: DataFrame, routes: DataFrame, salts: int = 1) -> DataFrame:
    """Add the target of each point, or NULLs and a ``route_reason``.

    Routes are rows, which are reduced to one per key here, or the outcome of
    ``routes_by_key``, as of ``prepared_routes``, which is joined as it is.

    ``no_route``: the key is unknown. ``no_level``: it has no route for this level.
    Rows without a key, as of messages that did not decode, match no route and are
    spread by salts that no route has; else all of them would meet in one task.
    """
    place = F.xxhash64("topic", "partition", "offset")
    keyless = reduce(lambda a, b: a | b, (F.col(name).isNull() for name in KEY))
    salt = F.when(keyless, salts + F.pmod(place, F.lit(1 << 20))).otherwise(F.pmod(place, F.lit(salts)))
    rows = points.withColumn("_salt", salt)
    table = routes if "targets" in routes.columns else routes_by_key(routes)
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
    table = table.withColumn("_salt", copies if salts > 1 else F.lit(0).cast("bigint"))
    joined = rows.join(table, [*KEY, "_salt"], "left").withColumn(
        "_target", F.try_element_at("targets", F.col("level"))
    )
    reason = F.when(F.col("targets").isNull(), "no_route").when(F.col("_target").isNull(), "no_level")
    return joined.select(
        *points.columns,
        *(F.col(f"_target.{name}").alias(name) for name in TARGET),
        reason.alias("route_reason"),
    )


def _where_route(points: DataFrame, routes: DataFrame, verdict: Column) -> DataFrame:
    return attach_routes(points, routes).where(verdict).drop("route_reason")


def route_lookup(points: DataFrame, routes: DataFrame) -> DataFrame:
    """Points that have a route for their level, with its target."""
    return _where_route(points, routes, F.col("route_reason").isNull())


def unrouted_level(points: DataFrame, routes: DataFrame) -> DataFrame:
    """Points whose key has routes, but none for their level."""
    return _where_route(points, routes, F.col("route_reason") == "no_level")


def route_not_found(points: DataFrame, routes: DataFrame) -> DataFrame:
    """Points whose key has no route at all."""
    return _where_route(points, routes, F.col("route_reason") == "no_route")


def first_seen_keys(points: DataFrame, provisioned: DataFrame | None = None) -> DataFrame:
    """Distinct keys of the points that were not provisioned before."""
    keys = points.select(*KEY).distinct()
    return keys if provisioned is None else keys.join(provisioned, list(KEY), "left_anti")


def default_routes(points: DataFrame) -> DataFrame:
    """The six stub routes of every key."""
    stubs = F.array(
        *(
            F.struct(
                F.lit(level).alias("rollup_level"),
                F.lit(DEFAULT_PATH).alias("path"),
                F.lit(DEFAULT_DATABASE).alias("database"),
                F.lit(policy).alias("retention_policy"),
                F.lit(duration).alias("retention"),
            )
            for level, (policy, duration) in DEFAULT_POLICIES.items()
        )
    )
    return first_seen_keys(points).select(
        *KEY, route_key(F.col("tenant_id"), F.col("measurement")).alias("route_key"), F.inline(stubs)
    )


def level_order(level: Column) -> Column:
    """full < 5m < ... < 1440m; an unknown level comes last."""
    return reduce(
        lambda order, item: F.when(level == item[1], F.lit(item[0])).otherwise(order),
        enumerate(LEVELS),
        F.lit(len(LEVELS)),
    )


def provisioning_plan(
    routes: DataFrame, existing_databases: DataFrame, existing_policies: DataFrame
) -> DataFrame:
    """Statements that create what the routes need and the instances lack.

    A missing database is created with its first policy, in level order; its other
    policies, and those missing from existing databases, are created on their own.
    """
    place = ["path", "database"]
    first_use = F.struct(level_order(F.col("rollup_level")).alias("rank"), "retention")
    # Thousands of keys share a policy: reduced to one row each before any join.
    policies = routes.groupBy(*place, "retention_policy").agg(F.min(first_use).alias("use"))
    policies = policies.select(
        *place, "retention_policy", F.col("use.rank").alias("rank"), F.col("use.retention").alias("retention")
    )
    missing_database = policies.join(existing_databases, place, "left_anti")
    first = missing_database.groupBy(*place).agg(
        F.min_by("retention_policy", F.struct("rank", "retention_policy")).alias("first_policy")
    )
    in_new = missing_database.join(first, place).withColumn(
        "creates_database", F.col("retention_policy") == F.col("first_policy")
    )
    in_old = (
        policies.join(existing_databases, place, "left_semi")
        .join(existing_policies, [*place, "retention_policy"], "left_anti")
        .withColumn("creates_database", F.lit(False))
    )
    create_database = F.format_string(
        'CREATE DATABASE "%s" WITH DURATION %s NAME "%s"',
        F.col("database"), F.col("retention"), F.col("retention_policy"),
    )
    create_policy = F.concat(
        F.format_string(
            'CREATE RETENTION POLICY "%s" ON "%s" DURATION %s REPLICATION 1',
            F.col("retention_policy"), F.col("database"), F.col("retention"),
        ),
        F.when(F.col("rank") == 0, " DEFAULT").otherwise(""),
    )
    return in_new.unionByName(in_old, allowMissingColumns=True).select(
        *place,
        "retention_policy",
        F.when(F.col("creates_database"), create_database).otherwise(create_policy).alias("statement"),
        F.when(F.col("creates_database"), 0).otherwise(F.col("rank") + 1).alias("step"),
    )


def is_beyond_retention(seconds: Column, retention: Column, as_of: Column | int) -> Column:
    """True for a point older than its policy keeps data; unknown durations keep all."""
    now = F.lit(as_of) if isinstance(as_of, int) else as_of
    return F.coalesce(seconds < now - retention_seconds(retention), F.lit(False))
