"""Messages, records, routes and catalogs derived from the ``events`` table.

Everything is integer arithmetic on the rows, so SQL can derive the same; nothing
is drawn at random and nothing depends on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.identity import measurement_name, tenant_id
from tidegate.operators.decode import encode_records
from tidegate.schemas import (
    DEFAULT_POLICIES,
    RAW_FIELDS,
    RAW_TOPIC,
    ROLLUP_FIELDS,
)

AS_OF = 1706659200  # 2024-01-31T00:00:00Z

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Tasks that share the events, or the rollups made of them, for each core.
_TASKS_PER_CORE = 4

# Window lengths in minutes of the derived rollups.
MINUTES = (5, 20, 60, 240, 1440)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt to tasks: a row group cannot be split, and one of a million rows may be all there is."""
    return _dealt(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(_TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, "event_id")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _empty_map(kind: str) -> Column:
    return F.create_map().cast(kind)


def _map(kind: str, **entries: Column) -> Column:
    pairs = [part for name, value in entries.items() for part in (F.lit(name.replace("__", ".")), value)]
    return F.create_map(*pairs).cast(kind)


_TEXT = "map<string,string>"


def _identity() -> dict[str, Column]:
    """Identity and metadata columns shared by raw and rollup records (from user and event id)."""
    e, u = F.col("event_id"), F.col("user_id")
    system_metadata = F.map_concat(
        _map(_TEXT, checkId=F.format_string("check-%d", u), monitoringZone=F.lit("")),
        F.when(e % 23 == 0, _map(_TEXT, tenantId=F.lit("override"))).otherwise(_empty_map(_TEXT)),
    )
    return {
        "accountType": _pick(("CORE", "ENCORE", "RCN", "UNKNOWN"), u % 4),
        "account": F.concat(F.when(e % 7 == 0, "acct ").otherwise("acct:"), u.cast("string")),
        "device": F.when(e % 11 == 0, "").otherwise((u + 1000).cast("string")),
        "deviceLabel": F.when(e % 17 == 0, "").otherwise(F.format_string("box-%d", u)),
        "deviceMetadata": F.when(e % 19 == 0, _map(_TEXT, os=F.lit("linux, x86"))).otherwise(_empty_map(_TEXT)),
        "monitoringSystem": _pick(("MAAS", "UIM", "SALUS", "SCOM", "ZENOSS"), e % 5),
        "systemMetadata": system_metadata,
        "collectionName": F.concat(F.when(e % 43 == 0, "agent ").otherwise("agent."), F.col("event_type")),
        "collectionLabel": F.lit("sampled"),
        "collectionTarget": F.lit(""),
        "collectionMetadata": _map(_TEXT, product=F.lit("demo")),
    }


def raw_records(rows: DataFrame) -> DataFrame:
    """Events -> typed raw records (``user_id`` and ``event_id`` are kept)."""
    e, u = F.col("event_id"), F.col("user_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    longs, doubles = "map<string,bigint>", "map<string,double>"
    columns = {
        **_identity(),
        "timestamp": F.when(e % 97 == 0, "not-a-time")
        .when(e % 101 == 0, F.translate(iso, "T", " "))
        .otherwise(iso),
        "ivalues": F.when(e % 13 == 0, _empty_map(longs)).otherwise(_map(longs, props__k=k)),
        "fvalues": F.when(e % 13 == 0, _empty_map(doubles))
        .when(e % 29 == 0, _map(doubles, event__value=F.col("value"), props_k=F.col("value")))
        .otherwise(_map(doubles, event__value=F.col("value"))),
        "svalues": _empty_map(_TEXT),
        "units": _map(_TEXT, event__value=F.lit("USD")),
    }
    return rows.select(
        F.lit(RAW_TOPIC).alias("topic"),
        (u % 4).cast("int").alias("partition"),
        e.alias("offset"),
        "user_id",
        *(columns[name].alias(name) for name in RAW_FIELDS),
    )


def raw_wire(rows: DataFrame) -> DataFrame:
    """Events -> raw messages, some of them broken in every way a message can be."""
    good = encode_records(raw_records(rows), RAW_FIELDS).drop("user_id")
    v, o = F.col("value"), F.col("offset")
    broken = (
        F.when(o % 211 == 5, F.lit(None).cast("string"))
        .when(o % 223 == 5, F.expr("left(value, length(value) - 10)"))
        .when(o % 227 == 5, F.regexp_replace(v, r',"units":\{[^}]*\}', ""))
        .when(o % 229 == 5, F.regexp_replace(v, r'^\{', '{"extra":1,'))
        .when(o % 233 == 5, F.regexp_replace(v, r'"accountType":"[A-Z]+"', '"accountType":"FOO"'))
        .when(o % 239 == 5, F.regexp_replace(v, r'"ivalues":\{[^}]*\}', '"ivalues":{"props.k":"x"}'))
        .when(o % 241 == 5, F.regexp_replace(v, r'"account":"[^"]*"', '"account":17'))
        .otherwise(v)
    )
    return good.withColumn("value", broken)


def rollup_buckets(rows: DataFrame, minutes: tuple[int, ...] = MINUTES) -> DataFrame:
    """Tumbling windows of all five lengths, or of those given, per user and event type.

    They are dealt to tasks as events are: Spark joins the aggregate's small outcome to about one task a core, or
    somewhat more, and their conversion, which costs far more than their bytes tell, would run in two uneven rounds.
    """
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    cents = F.round(F.col("value") * 100).cast("bigint")
    width = F.col("minutes") * 60
    n, sum_k, sum_c = F.count(F.lit(1)), F.sum("k"), F.sum("cents")
    buckets = (
        rows.select(
            "event_id", "user_id", "event_type", k.alias("k"), cents.alias("cents"),
            seconds.alias("s"), F.explode(F.array(*map(F.lit, minutes))).alias("minutes"),
        )
        .withColumn("start", F.col("s") - F.col("s") % width)
        .groupBy("minutes", "start", "user_id", "event_type")
        .agg(
            F.min("event_id").alias("event_id"),
            F.min("k").alias("k_min"), F.max("k").alias("k_max"),
            (sum_k - sum_k % n).alias("k_whole"), n.alias("n"),
            F.min("cents").alias("c_min"), F.max("cents").alias("c_max"),
            (sum_c - sum_c % n).alias("c_whole"),
        )
        .withColumns(
            {
                # Whole-number means: exact in every engine.
                "k_mean": (F.col("k_whole") / F.col("n")).cast("bigint"),
                "c_mean": (F.col("c_whole") / F.col("n")).cast("bigint"),
                "end": F.col("start") + width,
            }
        )
    )
    return _dealt(buckets)


def _bucket(kind: str, low: Column, high: Column, mean: Column) -> Column:
    return F.struct(low.alias("min"), high.alias("max"), mean.alias("mean")).cast(
        f"struct<min:{kind},max:{kind},mean:{kind}>"
    )


def _rollups(rows: DataFrame, whole: str, minutes: tuple[int, ...] = MINUTES) -> DataFrame:
    b = rollup_buckets(rows, minutes)
    u = F.col("user_id")
    # A mean with a fraction, which decoding cuts off, where the kind allows one.
    k_mean = F.col("k_mean") if whole == "bigint" else F.col("k_mean") + F.when(F.col("event_id") % 37 == 0, 0.75).otherwise(0.0)
    columns = {
        **_identity(),
        "key": F.format_string("rollup-%d", F.col("event_id")),
        "start": F.col("start"),
        "end": F.col("end"),
        "units": F.when(u % 31 == 0, _map(_TEXT, props__k=F.lit("count"))).otherwise(
            _map(_TEXT, props__k=F.lit("count"), event__value=F.lit("USD"))
        ),
        "ivalues": _map(
            f"map<string,struct<min:{whole},max:{whole},mean:{whole}>>",
            props__k=_bucket(whole, F.col("k_min"), F.col("k_max"), k_mean),
        ),
        "fvalues": _map(
            "map<string,struct<min:double,max:double,mean:double>>",
            event__value=_bucket("double", F.col("c_min") / 100, F.col("c_max") / 100, F.col("c_mean") / 100),
        ),
    }
    return b.select(
        F.format_string(RAW_TOPIC + ".%dm", "minutes").alias("topic"),
        (u % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "user_id",
        *(columns[name].alias(name) for name in ROLLUP_FIELDS),
    )


def rollup_records(rows: DataFrame) -> DataFrame:
    """Events -> typed rollup records of all levels."""
    return _rollups(rows, "bigint")


def rollup_wire(rows: DataFrame, minutes: tuple[int, ...] = MINUTES) -> DataFrame:
    """Events -> rollup messages: some with fractions in whole values, unknown or no fields, or cut."""
    good = encode_records(_rollups(rows, "double", minutes), ROLLUP_FIELDS).drop("user_id")
    v, o = F.col("value"), F.col("offset")
    changed = (
        F.when(o % 211 == 5, F.lit(None).cast("string"))
        .when(o % 223 == 5, F.expr("left(value, length(value) - 10)"))
        .when(o % 227 == 5, F.regexp_replace(v, r'"key":"[^"]*","start":[0-9]+,', ""))
        .when(o % 229 == 5, F.regexp_replace(v, r'^\{', '{"extra":{"a":[1]},'))
        .otherwise(v)
    )
    return good.withColumn("value", changed)


def _keys(rows: DataFrame) -> DataFrame:
    """Distinct (tenant, measurement, user) of the events."""
    ids = _identity()
    return rows.select(
        "user_id",
        tenant_id(ids["accountType"], ids["account"]).alias("tenant_id"),
        measurement_name(ids["monitoringSystem"], ids["collectionName"]).alias("measurement"),
    ).distinct()


def routes(rows: DataFrame) -> DataFrame:
    """Routes over three instances and ten databases; some keys or levels are left out."""
    u = F.col("user_id")
    policies = F.array(
        *(
            F.struct(F.lit(level).alias("rollup_level"), F.lit(policy).alias("retention_policy"), F.lit(duration).alias("retention"))
            for level, (policy, duration) in DEFAULT_POLICIES.items()
        )
    )
    return (
        _keys(rows)
        .where(u % 13 != 12)
        .select(
            "tenant_id",
            "measurement",
            F.format_string("http://store-%d:8086", u % 10 % 3).alias("path"),
            F.format_string("db_%d", u % 10).alias("database"),
            "user_id",
            F.inline(policies),
        )
        .where((u % 11 != 10) | (F.col("rollup_level") != "full"))
        .select("tenant_id", "measurement", "rollup_level", "path", "database", "retention_policy", "retention")
    )


def existing_catalog(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(databases, policies) already present on the instances."""
    databases = (
        routes(rows)
        .where(F.substring("database", 4, 9).cast("int") <= 6)
        .select("path", "database")
        .distinct()
    )
    policies = databases.where(F.substring("database", 4, 9).cast("int") % 2 == 0).select(
        "path", "database", F.explode(F.array(F.lit("rp_5d"), F.lit("rp_10d"))).alias("retention_policy")
    )
    return databases, policies
