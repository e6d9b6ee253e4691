import pytest
from pyspark.sql import functions as F

from tests.records import raw_df, rollup_df
from tidegate.operators import routing
from tidegate.operators.points import raw_points, rollup_points
from tidegate.schemas import ROUTES
from tidegate.sources.routes_table import prepared_routes

DATABASES = "path STRING, database STRING"
POLICIES = "path STRING, database STRING, retention_policy STRING"


def route_df(spark, *rows):
    return spark.createDataFrame(list(rows), ROUTES)


def route(tenant, level, database="db", policy="rp_5d", retention="5d", measurement="MAAS_agent.filesystem"):
    return (tenant, measurement, level, "http://h:1", database, policy, retention)


def plan(spark, routes, databases=(), policies=()):
    rows = routing.provisioning_plan(
        route_df(spark, *routes),
        spark.createDataFrame(list(databases), DATABASES),
        spark.createDataFrame(list(policies), POLICIES),
    )
    return [r["statement"] for r in rows.orderBy("database", "step").collect()]


def test_nothing_to_create(spark):
    known = ("http://h:1", "existing_db")
    assert plan(spark, [route("t", "full", "existing_db", "existing_rp")], [known], [(*known, "existing_rp")]) == []


def test_missing_database(spark):
    assert plan(spark, [route("t", "full", "non_existing_database", "existing_rp")]) == [
        'CREATE DATABASE "non_existing_database" WITH DURATION 5d NAME "existing_rp"'
    ]


def test_missing_policy(spark):
    assert plan(spark, [route("t", "full", "existing_db", "non_existing_rp")], [("http://h:1", "existing_db")]) == [
        'CREATE RETENTION POLICY "non_existing_rp" ON "existing_db" DURATION 5d REPLICATION 1 DEFAULT'
    ]


def test_first_level_creates_the_database_and_keys_share_statements(spark):
    routes = [
        route(tenant, level, "new", policy, retention)
        for tenant in ("a", "b")
        for level, policy, retention in (("1440m", "rp_1825d", "1825d"), ("20m", "rp_20d", "20d"), ("5m", "rp_10d", "10d"))
    ]
    assert plan(spark, routes) == [
        'CREATE DATABASE "new" WITH DURATION 10d NAME "rp_10d"',
        'CREATE RETENTION POLICY "rp_20d" ON "new" DURATION 20d REPLICATION 1',
        'CREATE RETENTION POLICY "rp_1825d" ON "new" DURATION 1825d REPLICATION 1',
    ]


@pytest.mark.parametrize("salts", [1, 7])
def test_routes_and_their_absence(spark, salts):
    points = raw_points(raw_df(spark, *({"account": name} for name in ("a", "b", "c"))))
    routes = route_df(spark, route("CORE-a", "full"), route("CORE-a", "5m", policy="rp_10d"), route("CORE-b", "5m"))
    rows = routing.attach_routes(points, routes, salts).orderBy("offset").collect()
    assert [(r["retention_policy"], r["route_reason"]) for r in rows] == [
        ("rp_5d", None), (None, "no_level"), (None, "no_route"),
    ]
    assert [r["offset"] for r in routing.route_lookup(points, routes).collect()] == [0]
    assert [r["offset"] for r in routing.unrouted_level(points, routes).collect()] == [1]
    assert [r["offset"] for r in routing.route_not_found(points, routes).collect()] == [2]


def test_repeated_routes_do_not_repeat_points(spark):
    points = raw_points(raw_df(spark, {"account": "a"}))
    routes = route_df(spark, route("CORE-a", "full"), route("CORE-a", "full"), route("CORE-a", "full", database="other"))
    assert [r["database"] for r in routing.attach_routes(points, routes).collect()] == ["db"]


def test_a_hot_tenant_is_spread_by_salt(spark):
    points = raw_points(raw_df(spark, *({"account": "hot" if i % 3 else f"t{i}"} for i in range(90))))
    routes = route_df(spark, *(route(f"CORE-{name}", "full") for name in ["hot", *(f"t{i}" for i in range(0, 90, 3))]))
    plain = routing.attach_routes(points, routes)
    salted = routing.attach_routes(points, routes, salts=8)
    key = ["offset", "database", "route_reason"]
    assert sorted(map(tuple, plain.select(key).collect())) == sorted(map(tuple, salted.select(key).collect()))


def test_no_join_is_forced_to_broadcast(spark):
    points = raw_points(raw_df(spark, {}))
    plan_text = routing.attach_routes(points, route_df(spark, route("t", "full")))._jdf.queryExecution().toString()
    assert "hint" not in plan_text.lower()


def test_default_routes_and_first_seen(spark):
    points = raw_points(raw_df(spark, {}, {}, {"account": "b"}))
    rows = routing.default_routes(points)
    assert rows.count() == 12 and rows.where("rollup_level = '60m'").first()["retention_policy"] == "rp_155d"
    known = routing.first_seen_keys(points.where("offset < 2"))
    assert [r["tenant_id"] for r in routing.first_seen_keys(points, known).collect()] == ["CORE-b"]


def test_retention_edge(spark):
    rows = spark.createDataFrame([(10, "5s"), (9, "5s"), (0, "never"), (0, None), (None, "5s")], "s BIGINT, r STRING")
    late = rows.select(routing.is_beyond_retention(F.col("s"), F.col("r"), 15).alias("x"))
    assert [r["x"] for r in late.collect()] == [False, True, False, False, False]


def test_rollups_use_the_route_of_their_level(spark):
    points = rollup_points(rollup_df(spark, {"account": "a"}, level="20m"))
    routes = route_df(
        spark,
        route("CORE-a", "20m", policy="rp_20d", measurement="MAAS_agent.cpu"),
        route("CORE-a", "full", measurement="MAAS_agent.cpu"),
    )
    assert routing.attach_routes(points, routes).first()["retention_policy"] == "rp_20d"


def test_prepared_routes_are_reduced_once_per_version(spark, tmp_path):
    points = raw_points(raw_df(spark, *({"account": name} for name in ("a", "b", "c"))))
    rows = [route("CORE-a", "full"), route("CORE-a", "full", database="other"), route("CORE-b", "5m")]
    calls = []

    def routes(session):
        calls.append(len(rows))
        return route_df(session, *rows)

    ready = lambda version: prepared_routes(spark, str(tmp_path), version, routes)
    key = ["offset", "database", "retention_policy", "route_reason"]
    found = lambda routes: sorted(map(tuple, routing.attach_routes(points, routes).select(key).collect()))
    for _ in range(2):
        assert found(ready("a/1")) == found(route_df(spark, *rows))
    assert calls == [3]
    joined = routing.attach_routes(points, ready("a/1"))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in joined
    rows.append(route("CORE-c", "full", database="late"))
    assert found(ready("a/2"))[2][1:] == ("late", "rp_5d", None) and calls == [3, 4]
    assert found(ready("a/1"))[2][3] == "no_route"
    files = tmp_path / "version=a%2F1" / "_SUCCESS"
    files.unlink()
    assert len(found(ready("a/1"))) == 3 and calls == [3, 4, 4]


def test_rows_of_prepared_routes(spark):
    rows = [route("a", "full"), route("a", "5m", policy="rp_10d"), route("b", "full")]
    raw = route_df(spark, *rows)
    again = routing.route_rows(routing.routes_by_key(raw))
    assert sorted(map(tuple, again.select(raw.columns).collect())) == sorted(rows)
    assert routing.route_rows(raw) is raw
