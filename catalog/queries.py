"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from tidegate import prepare_session, scratch_folder
from tidegate.functions import identity, lines, metrics, places, tags, text, times
from tidegate.operators import ops, payloads, quarantine, reconcile, routing
from tidegate.operators.decode import decode_raw, decode_rollup, encode_records, enum_reason
from tidegate.operators.points import (
    dimensions,
    points_long,
    raw_points,
    rollup_points,
    with_identity,
    with_raw_metrics,
    with_rollup_metrics,
)
from tidegate.plans.ingest import raw_pipeline
from tidegate.plans.restore import restore_target, restored_points, wipe_then_restore
from tidegate.schemas import DIMENSIONS, POLL_RECORDS, RAW_FIELDS
from tidegate.session import brief_shuffles
from tidegate.sources import backup, files, points_table
from tidegate.sources.layout import CODEC, ROWS_PER_FILE
from tidegate.sources.routes_table import prepared_routes
from tidegate.sources.wire import WireSource, read_raw_stream, read_rollup_streams, with_level
from tidegate.streaming import progress
from tidegate.streaming.ingest import (
    IngestJob,
    Sinks,
    compact_sinks,
    raw_ingest_stream,
    rollup_ingest_stream,
    stop_on_error,
    write_ops_metrics,
)

Query = Callable[[SparkSession, str], DataFrame]

HOST = "store-1"
ORIGIN = ("topic", "partition", "offset")

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare_session(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs ---------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_records(fx.events(spark, sf_dir))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.rollup_records(fx.events(spark, sf_dir))


def _raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_points(_raw(spark, sf_dir))


def _rollup_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_points(_rollup(spark, sf_dir))


def _sound(points: DataFrame) -> DataFrame:
    return points.where(F.col("reason").isNull())


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.routes(fx.events(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound raw points with a target."""
    routed = routing.attach_routes(_sound(_raw_points(spark, sf_dir)), _routes(spark, sf_dir))
    return routed.where(F.col("route_reason").isNull()).drop("route_reason")


def _text_of(entries: Column) -> Column:
    """A map as sorted text, for comparison."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(entries)),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        ),
        "|",
    )


def _by_level(points: DataFrame) -> DataFrame:
    return points.select(*ORIGIN, "level", "tenant_id", "measurement")


# --- sources, sinks, decoding ----------------------------------------------


def _wire_folder(spark: SparkSession, messages: DataFrame, label: str, files: int | None = None) -> str:
    folder = scratch_folder(spark, label)
    (messages if files is None else messages.repartition(files)).write.parquet(folder)
    return folder


def _drain(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there into files and read those."""
    folder = scratch_folder(spark, label)
    running = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    running.awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@query
def read_raw_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _wire_folder(spark, fx.raw_wire(fx.events(spark, sf_dir)), "wire")
    stream = read_raw_stream(spark, WireSource("parquet", folder))
    return _drain(spark, stream, "raw-rows").select(*ORIGIN, F.col("value").isNull().alias("no_payload"))


@query
def read_rollup_streams_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _wire_folder(spark, fx.rollup_wire(fx.events(spark, sf_dir)), "wire")
    stream = read_rollup_streams(spark, WireSource("parquet", folder))
    return _drain(spark, stream, "rollup-rows").select(*ORIGIN, "level")


@query
def topic_to_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.events(spark, sf_dir)
    messages = fx.raw_wire(rows).unionByName(fx.rollup_wire(rows))
    return with_level(messages).groupBy("topic", "level").agg(F.count(F.lit(1)).alias("messages"))


@query
def decode_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_raw(fx.raw_wire(fx.events(spark, sf_dir)))
    plain = [name for name, kind in RAW_FIELDS.items() if kind == "STRING"]
    maps = [name for name, kind in RAW_FIELDS.items() if kind != "STRING"]
    return decoded.select(*ORIGIN, *plain, *(_text_of(F.col(name)).alias(name) for name in maps), "reason")


@query
def decode_rollup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_rollup(fx.rollup_wire(fx.events(spark, sf_dir)))
    k = F.try_element_at("ivalues", F.lit("props.k"))
    v = F.try_element_at("fvalues", F.lit("event.value"))
    return decoded.select(
        *ORIGIN,
        "key",
        F.col("start").alias("start_s"),
        F.col("end").alias("end_s"),
        *(name for name in DIMENSIONS if not name.endswith("Metadata")),
        *(_text_of(F.col(name)).alias(name) for name in DIMENSIONS if name.endswith("Metadata")),
        _text_of(F.col("units")).alias("units"),
        *(F.array_join(F.array_sort(F.map_keys(name)), "|").alias(f"{name}_keys") for name in ("ivalues", "fvalues")),
        *(k[part].alias(f"k_{part}") for part in ("min", "max", "mean")),
        *(v[part].alias(f"v_{part}") for part in ("min", "max", "mean")),
        "reason",
    )


@query
def encode_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_records(_raw(spark, sf_dir), RAW_FIELDS).select(*ORIGIN, "value")


@query
def write_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "points")
    points_table.write_points(points_table.stored_points(_routed(spark, sf_dir)), folder)
    stored = points_table.read_points(spark, folder)
    value = F.round(F.try_element_at("fields", F.lit("event_value")) * 100).cast("bigint")
    return stored.groupBy(*points_table.PLACE).agg(
        F.count(F.lit(1)).alias("points"),
        F.min("ts_s").alias("first_s"),
        F.max("ts_s").alias("last_s"),
        F.sum(value).alias("cents"),
    )


def _written_backup(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_folder(spark, "backup")
    backup.write_backup(backup.backup_lines(_routed(spark, sf_dir)), folder)
    return folder


def _backup_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per place, and how many of its files lack the header, however many files hold it."""
    is_header = F.col("value").startswith("#")
    per_file = backup.read_files(spark, folder).groupBy(*backup.PLACE, "file").agg(
        F.count_if(~is_header).alias("lines"), F.count_if(is_header).alias("header_lines")
    )
    return per_file.groupBy(*backup.PLACE).agg(
        F.sum("lines").alias("lines"), F.count_if(F.col("header_lines") < 3).alias("bare_files")
    )


@query
def write_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backup_files(spark, _written_backup(spark, sf_dir))


@query
def read_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backup.read_backup(spark, _written_backup(spark, sf_dir))


@query
def backup_header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = backup.header_mismatches(spark, _written_backup(spark, sf_dir))
    return wrong.select(*backup.PLACE, F.col("value").alias("header"))


@query
def write_ops_metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "ops")
    rows = raw_pipeline(fx.raw_wire(fx.events(spark, sf_dir)), _routes(spark, sf_dir))
    job = IngestJob("raw", lambda s: _routes(s, sf_dir), Sinks(points=folder, dead_letter=folder, ops=folder))
    write_ops_metrics(rows, 0, job)
    return spark.read.parquet(folder).select("scope", "line")


# --- filters and quarantine ------------------------------------------------


@query
def is_valid_no_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        *ORIGIN,
        *(
            text.has_no_whitespace(F.col(name)).alias(f"{name}_valid")
            for name in ("timestamp", "account", "device", "collectionName")
        ),
    )


@query
def timestamp_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw(spark, sf_dir).withColumn("reason", quarantine.timestamp_gate(F.col("timestamp")))
    return quarantine.split(rows)[1].select(*ORIGIN, "timestamp", "reason")


@query
def enum_domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lower-case symbols of some event types are not in the domain.
    odd = F.col("collectionName").endswith("signup")
    rows = _raw(spark, sf_dir).withColumns(
        {
            "accountType": F.when(odd, F.lower("accountType")).otherwise(F.col("accountType")),
            "monitoringSystem": F.when(F.col("device") == "", "OTHER").otherwise(F.col("monitoringSystem")),
        }
    )
    reason = enum_reason(F.col("accountType"), F.col("monitoringSystem"))
    return rows.select(*ORIGIN, "accountType", "monitoringSystem", reason.alias("reason"))


@query
def mandatory_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.when(F.col("device") == "", F.concat("accountType", F.lit(" x"))).otherwise(F.col("accountType"))
    tabbed = F.when(F.col("deviceLabel") == "", F.concat("monitoringSystem", F.lit("\t"))).otherwise(
        F.col("monitoringSystem")
    )
    rows = _raw(spark, sf_dir).withColumns({"accountType": spaced, "monitoringSystem": tabbed})
    reason = quarantine.mandatory_identity(F.col("accountType"), F.col("monitoringSystem"))
    return rows.select(*ORIGIN, "accountType", "monitoringSystem", reason.alias("reason"))


@query
def convertible_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_points(spark, sf_dir).select(*ORIGIN, "reason")


@query
def convertible_filter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup_points(spark, sf_dir).select(*ORIGIN, "reason")


@query
def beyond_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = routing.is_beyond_retention(F.col("ts_s"), F.col("retention"), fx.AS_OF)
    return _routed(spark, sf_dir).select(*ORIGIN, "retention_policy", "ts_s", late.alias("refused"))


@query
def payload_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    line = F.when(e % 5 == 0, " \t").otherwise(F.col("event_type"))
    database = F.when(e % 7 == 0, "").otherwise(F.format_string("db_%d", u % 10))
    policy = F.when(e % 11 == 0, F.lit(None).cast("string")).otherwise("rp_5d")
    path = F.when(e % 3 == 0, "http://:8086").otherwise("http://test_x.com:8086")
    return fx.events(spark, sf_dir).select(
        "event_id", backup.payload_guards(line, database, policy, path).alias("reason")
    )


def _mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have lost their time."""
    cut = F.regexp_replace("line", " [0-9]+$", "")
    return _sound(_raw_points(spark, sf_dir)).select(
        *ORIGIN, F.when(F.col("offset") % 3 == 0, cut).otherwise(F.col("line")).alias("line")
    )


@query
def backup_time_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = backup.backup_time_required(F.col("line"))
    return _mixed_payloads(spark, sf_dir).select(*ORIGIN, reason.alias("reason"))


# --- projections -----------------------------------------------------------


@query
def sanitize_special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pages hold every one of the characters.
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return rows.select("page_id", text.sanitize(F.col("url")).alias("url"), text.sanitize(F.col("html")).alias("html"))


@query
def tenant_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenant = identity.tenant_id(F.col("accountType"), F.col("account"))
    return _raw(spark, sf_dir).select(*ORIGIN, tenant.alias("tenant_id"))


@query
def measurement_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = identity.measurement_name(F.col("monitoringSystem"), F.col("collectionName"))
    return _raw(spark, sf_dir).select(*ORIGIN, name.alias("measurement"))


@query
def ingest_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would be stored for whom."""
    seconds = times.event_time_seconds(F.col("timestamp"))
    return (
        with_identity(_raw(spark, sf_dir))
        .groupBy("tenant_id", "measurement")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min(seconds).alias("first_s"),
            F.max(seconds).alias("last_s"),
        )
    )


def _shown_dimensions(rows: DataFrame) -> DataFrame:
    return rows.select(
        *(
            _text_of(F.col(name)).alias(name) if name.endswith("Metadata") else F.col(name)
            for name in rows.columns
        )
    )


@query
def dimensions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_dimensions(dimensions(_raw(spark, sf_dir)))


@query
def dimensions_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_dimensions(dimensions(_rollup(spark, sf_dir)))


@query
def java_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t \x01"), F.col("text"), F.lit("\n\x1f "))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", text.trim_controls(padded).alias("trimmed")
    )


@query
def wrap_tag_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = F.when(F.col("device") != "", F.col("device"))
    return _raw(spark, sf_dir).select(*ORIGIN, text.wrap(device).alias("wrapped"))


@query
def build_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = tags.build_tags(F.col("tenant_id"))
    return with_identity(_raw(spark, sf_dir)).select(*ORIGIN, _text_of(built).alias("tags"))


def _decimal_fields(fields: Column) -> Column:
    return _text_of(F.transform_values(fields, lambda _, v: lines.decimal_text(v)))


@query
def raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = metrics.raw_fields(F.col("metrics"))
    return with_raw_metrics(_raw(spark, sf_dir)).select(*ORIGIN, _decimal_fields(fields).alias("fields"))


@query
def raw_unit_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = metrics.unit_tags(F.col("metrics"))
    return with_raw_metrics(_raw(spark, sf_dir)).select(*ORIGIN, _text_of(units).alias("units"))


@query
def rollup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(_rollup_points(spark, sf_dir)).select(
        *ORIGIN, _decimal_fields(F.col("fields")).alias("fields"), _text_of(F.col("int_fields")).alias("int_fields")
    )


@query
def rollup_unit_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A missing unit shows as no tag here; convertible_filter_rollup refuses the row.
    units = metrics.unit_tags(F.col("metrics"))
    return with_rollup_metrics(_rollup(spark, sf_dir)).select(*ORIGIN, _text_of(units).alias("units"))


@query
def event_time_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(*ORIGIN, times.event_time_seconds(F.col("timestamp")).alias("ts_s"))


@query
def encode_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(_raw_points(spark, sf_dir)).select(*ORIGIN, "tenant_id", "measurement", "line")


@query
def encode_line_protocol_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(_rollup_points(spark, sf_dir)).select(*ORIGIN, "tenant_id", "measurement", "line")


@query
def parse_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _raw_points(spark, sf_dir).unionByName(_rollup_points(spark, sf_dir))
    parsed = lines.parse_lines(_sound(both).select(*ORIGIN, "line"))
    return parsed.select(
        *ORIGIN,
        "measurement",
        _text_of(F.col("tags")).alias("tags"),
        _decimal_fields(F.col("fields")).alias("fields"),
        _text_of(F.col("int_fields")).alias("int_fields"),
        "ts_s",
    )


@query
def points_long_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points_long(with_raw_metrics(with_identity(_raw(spark, sf_dir))))
    return rows.select(*ORIGIN, "tenant_id", "measurement", "kind", "key", "name", "value", "unit")


@query
def points_long_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points_long(with_rollup_metrics(with_identity(_rollup(spark, sf_dir)).drop("key")))
    values = (F.col(part).alias(f"v_{part}") for part in ("min", "mean", "max"))
    return rows.select(*ORIGIN, "tenant_id", "measurement", "kind", "key", "name", *values, "unit")


@query
def backup_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = places.backup_location(F.col("path"), F.col("database"), F.col("retention_policy"), F.col("ts_s"))
    return _routed(spark, sf_dir).select(*ORIGIN, where.alias("location"))


@query
def payload_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed_payloads(spark, sf_dir).select(
        *ORIGIN, places.payload_timestamp(F.col("line")).alias("ts_s")
    )


@query
def dml_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = _routes(spark, sf_dir).select("database", "retention_policy").distinct()
    return targets.select("*", places.dml_header(F.col("database"), F.col("retention_policy")).alias("header"))


@query
def route_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = identity.route_key(F.col("tenant_id"), F.col("measurement"))
    return with_identity(_raw(spark, sf_dir)).select(*ORIGIN, key.alias("route_key"))


@query
def retention_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.array(*map(F.lit, ("s", "m", "h", "d", "w", "y")))
    duration = F.concat(F.col("event_id").cast("string"), F.element_at(units, (F.col("event_id") % 6 + 1).cast("int")))
    return fx.events(spark, sf_dir).select("event_id", times.retention_seconds(duration).alias("seconds"))


# --- joins -----------------------------------------------------------------


@query
def route_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.route_lookup(_sound(_raw_points(spark, sf_dir)), _routes(spark, sf_dir))
    return routed.select(*ORIGIN, "tenant_id", "measurement", "path", "database", "retention_policy")


@query
def route_lookup_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "routes")
    by_key = prepared_routes(spark, folder, "1", lambda s: _routes(s, sf_dir))
    routed = routing.route_lookup(_sound(_raw_points(spark, sf_dir)), by_key)
    return routed.select(*ORIGIN, "tenant_id", "measurement", "path", "database", "retention_policy")


@query
def route_lookup_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.attach_routes(_sound(_rollup_points(spark, sf_dir)), _routes(spark, sf_dir), salts=4)
    return routed.select(*ORIGIN, "level", "path", "database", "retention_policy", "route_reason")


@query
def unrouted_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_level(routing.unrouted_level(_sound(_raw_points(spark, sf_dir)), _routes(spark, sf_dir)))


@query
def route_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_level(routing.route_not_found(_sound(_raw_points(spark, sf_dir)), _routes(spark, sf_dir)))


@query
def default_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.default_routes(_sound(_raw_points(spark, sf_dir)))


@query
def provisioning_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.events(spark, sf_dir)
    return routing.provisioning_plan(fx.routes(rows), *fx.existing_catalog(rows))


@query
def reconcile_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All instances restored from a backup that lost one day of one database, and retention run after."""
    saved, folder = scratch_folder(spark, "backup"), scratch_folder(spark, "restored")
    routed = _routed(spark, sf_dir)
    lines = backup.backup_lines(routed)
    lost = (F.col("database") == "db_3") & (F.col("day") == "20240129")
    backup.write_backup(lines.where(~lost), saved)
    restore_target(spark, saved, None, folder)
    # Policies are named for how long they keep points.
    duration = F.regexp_replace("retention_policy", "^rp_", "")
    restored = points_table.read_points(spark, folder).where(
        ~routing.is_beyond_retention(F.col("ts_s"), duration, fx.AS_OF)
    )
    written = routed.withColumn("host", places.instance_host(F.col("path")))
    return reconcile.reconcile_restore(written, restored, fx.AS_OF)


# --- payloads and counts ---------------------------------------------------


@query
def tenant_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.tenant_payloads(_raw_points(spark, sf_dir))


@query
def tenant_payloads_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.tenant_payloads(_rollup_points(spark, sf_dir))


@query
def payload_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.payload_stats(_raw_points(spark, sf_dir))


@query
def ingested_data_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.ingested_data_count(_raw_points(spark, sf_dir))


@query
def ingestion_records_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per batch, a batch being one poll of one partition."""
    polled = payloads.with_poll(_raw(spark, sf_dir), POLL_RECORDS)
    return payloads.ingestion_records_count(polled, "topic", "partition", "poll")


@query
def ops_metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _raw_points(spark, sf_dir)
    return ops.ops_metric_lines(
        payloads.ingested_data_count(points),
        payloads.ingestion_records_count(points),
        payloads.payload_stats(points),
        "raw",
        "localhost",
    )


@query
def unconverted_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _raw_points(spark, sf_dir).unionByName(_rollup_points(spark, sf_dir))
    return payloads.unconverted_count(both)


@query
def replay_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.events(spark, sf_dir)
    messages = fx.raw_wire(rows).unionByName(fx.rollup_wire(rows))
    return payloads.replay_offsets(messages)


@query
def backup_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backup.backup_manifest(backup.backup_lines(_routed(spark, sf_dir)))


@query
def payload_backup_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.payload_backup_day(_raw_points(spark, sf_dir))


@query
def rollup_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _rollup(spark, sf_dir)
    levels = [records.where(F.col("topic").endswith(f".{level}")) for level in ("5m", "20m", "60m", "240m", "1440m")]
    merged = with_level(payloads.rollup_fan_in(*levels))
    return merged.groupBy("level", "accountType").agg(F.count(F.lit(1)).alias("records"))


@query
def first_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the second half of the month brings for the first time."""
    points = _sound(_raw_points(spark, sf_dir))
    middle = 1705276800  # 2024-01-15T00:00:00Z
    known = routing.first_seen_keys(points.where(F.col("ts_s") < middle))
    return routing.first_seen_keys(points.where(F.col("ts_s") >= middle), known)


# --- streams ---------------------------------------------------------------


_ALL_SINKS = ("points", "ops", "backup", "provisioning")


def _stream_job(
    spark: SparkSession, sf_dir: str, kind: str, label: str, sinks: tuple[str, ...] = _ALL_SINKS, **settings
) -> tuple[IngestJob, str]:
    base = scratch_folder(spark, label)
    used = {name: f"{base}/{name}" if name in sinks else None for name in _ALL_SINKS}
    sinks = Sinks(dead_letter=f"{base}/dead", **used)
    routes = f"{base}/routes"
    # A routing table as a running service would have one.
    with brief_shuffles(spark):
        _routes(spark, sf_dir).write.parquet(routes)
    return IngestJob(kind, lambda s: s.read.parquet(routes), sinks, **settings), base


def _raw_source(spark: SparkSession, sf_dir: str, batches: int | None = None) -> WireSource:
    """Raw messages; in so many batches, if given, each of as many files as there are cores, since a file may be one task."""
    limit = None if batches is None else spark.sparkContext.defaultParallelism
    folder = _wire_folder(spark, fx.raw_wire(fx.events(spark, sf_dir)), "wire", batches and batches * limit)
    return WireSource("parquet", folder, max_files_per_batch=limit)


# What a batch of rollups may take of the messages' files, so that what it keeps and shuffles on its way does not grow with them.
_BATCH_BYTES = 1 << 30


def _rollup_source(spark: SparkSession, sf_dir: str) -> WireSource:
    """Rollup messages in batches by bytes; written level by level, so that the shuffles of one level are gone before the next."""
    folder = scratch_folder(spark, "wire")
    with brief_shuffles(spark):
        for minutes in fx.MINUTES:
            messages = fx.rollup_wire(fx.events(spark, sf_dir), (minutes,))
            writer = messages.write.mode("append").option("compression", CODEC).option("maxRecordsPerFile", ROWS_PER_FILE)
            writer.parquet(folder)
    return WireSource("parquet", folder, max_bytes_per_batch=_BATCH_BYTES)


def _rollup_job(spark: SparkSession, sf_dir: str, label: str, sinks: tuple[str, ...]) -> tuple[IngestJob, str]:
    """A job for rollups whose routes are reduced once for all its batches."""
    job, base = _stream_job(spark, sf_dir, "rollup", label, sinks)
    return replace(job, routes=lambda s: prepared_routes(s, f"{base}/prepared", "1", job.routes)), base


def _stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    stored = points_table.read_points(spark, folder)
    return stored.groupBy("host", "database", "retention_policy", "level").agg(
        F.count(F.lit(1)).alias("points"), F.countDistinct("day").alias("days")
    )


@query
def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, base = _stream_job(spark, sf_dir, "raw", "raw-ingest")
    source = _raw_source(spark, sf_dir)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    return _stored_counts(spark, job.sinks.points)


@query
def rollup_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, base = _rollup_job(spark, sf_dir, "rollup-ingest", ("points", "ops"))
    source = _rollup_source(spark, sf_dir)
    rollup_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    return _stored_counts(spark, job.sinks.points)


@query
def commit_after_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A restarted stream takes up after its last batch and writes nothing twice."""
    job, base = _stream_job(spark, sf_dir, "raw", "commit", ("points",))
    source = _raw_source(spark, sf_dir)
    for _ in range(2):
        raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    return _stored_counts(spark, job.sinks.points)


@query
def replay_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch refused after its first run is run again as a whole, without duplicates."""
    job, base = _stream_job(spark, sf_dir, "raw", "replay", ("points",), on_error="fail", as_of=fx.AS_OF)
    source = _raw_source(spark, sf_dir)
    stop_on_error(raw_ingest_stream(spark, source, job, f"{base}/checkpoint"))
    lenient = IngestJob("raw", job.routes, job.sinks)
    raw_ingest_stream(spark, source, lenient, f"{base}/checkpoint").awaitTermination()
    return _stored_counts(spark, job.sinks.points)


@query
def payload_failure_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of a stream that files refused payloads and goes on."""
    job, base = _stream_job(spark, sf_dir, "raw", "policy", ("ops",), as_of=fx.AS_OF)
    raw_ingest_stream(spark, _raw_source(spark, sf_dir), job, f"{base}/checkpoint").awaitTermination()
    letters = spark.read.parquet(job.sinks.dead_letter)
    return letters.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def rollup_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups have no time, so all that are stored are refused by the backup."""
    job, base = _rollup_job(spark, sf_dir, "rollup-dead", ("backup",))
    source = _rollup_source(spark, sf_dir)
    rollup_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    letters = spark.read.parquet(job.sinks.dead_letter)
    return letters.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def fetch_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice as many files as one batch may take make two batches."""
    job, base = _stream_job(spark, sf_dir, "raw", "limits", ("points",))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    stored = points_table.read_points(spark, job.sinks.points)
    return stored.agg(
        F.countDistinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("points")
    )


@query
def provisioning_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of a stream over several batches: each key and each policy once."""
    job, base = _stream_job(spark, sf_dir, "raw", "provision", ("provisioning",))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    plan = spark.read.parquet(f"{job.sinks.provisioning}/plan")
    return plan.select("path", "database", "retention_policy", "statement")


@query
def backup_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished days merged in place after each of two batches; lines of other days stay where they are."""
    job, base = _stream_job(spark, sf_dir, "raw", "rotation", ("backup",))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    for batch_id, day in enumerate(("20240110", "20240120")):
        backup.rotate_backup(spark, job.sinks.backup, batch_id, day)
    return _backup_files(spark, job.sinks.backup)


@query
def compact_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of two batches, compacted, the second batch written again, and compacted again: each point once."""
    job, base = _stream_job(spark, sf_dir, "raw", "compaction", ("points", "ops"))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    compact_sinks(spark, job, f"{base}/checkpoint")
    points_table.read_encoded(spark, job.sinks.points).where("batch_id = 1").write.parquet(f"{base}/again")
    points_table.write_batch(spark.read.parquet(f"{base}/again"), job.sinks.points, 1)
    points_table.compact_points(spark, job.sinks.points, 1)
    return _stored_counts(spark, job.sinks.points)


@query
def replay_after_route_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails after its points were written, run again after all routes moved to another database."""
    job, base = _stream_job(spark, sf_dir, "raw", "moved", ("points",))
    source = _raw_source(spark, sf_dir)
    moved = f"{base}/moved"
    job.routes(spark).withColumn("database", F.concat("database", F.lit("_moved"))).write.parquet(moved)
    # Dead letters are written after the points: a file in the place of their folder stops the batch there.
    files.create_text(spark, job.sinks.dead_letter, "")
    stop_on_error(raw_ingest_stream(spark, source, job, f"{base}/checkpoint"))
    after = replace(job, routes=lambda s: s.read.parquet(moved), sinks=replace(job.sinks, dead_letter=f"{base}/letters"))
    raw_ingest_stream(spark, source, after, f"{base}/checkpoint").awaitTermination()
    return _stored_counts(spark, job.sinks.points)


@query
def batch_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches so far and their records, from the stream's own counters."""
    job, base = _stream_job(spark, sf_dir, "raw", "counter", ("ops",))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    counted = spark.read.parquet(job.sinks.ops).where(F.col("line").startswith("ingestion_records_count"))
    return counted.agg(
        F.countDistinct("batch_id").alias("batches"),
        F.sum(F.regexp_extract("line", "count=([0-9]+)$", 1).cast("bigint")).alias("records"),
    )


@query
def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of each batch, timed; how long they took differs from run to run."""
    job, base = _stream_job(spark, sf_dir, "raw", "timings", ("points", "ops"))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    timings = ops.stage_timings(spark.read.parquet(job.sinks.ops))
    return timings.select("batch_id", "listener", "stage", (F.col("millis") >= 0).alias("measured"))


@query
def route_lookup_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with decoding and the route lookup timed apart."""
    job, base = _stream_job(spark, sf_dir, "raw", "route-timings", ("points", "ops"), time_routing=True)
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    timings = ops.stage_timings(spark.read.parquet(job.sinks.ops))
    return timings.select("batch_id", "listener", "stage", (F.col("millis") >= 0).alias("measured"))


@query
def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's progress of all batches: input rows, and which of its stages were timed."""
    job, base = _stream_job(spark, sf_dir, "raw", "progress", ("points",))
    source = _raw_source(spark, sf_dir, batches=2)
    with progress.ProgressLog(spark, f"{base}/progress") as log:
        stream = raw_ingest_stream(spark, source, job, f"{base}/checkpoint")
        stream.awaitTermination()
        log.wait(stream)
    stages = progress.progress_stages(progress.read_progress(spark, f"{base}/progress"))
    return stages.where(F.col("stage").isin("addBatch", "queryPlanning", "triggerExecution")).groupBy("stage").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.bool_and(F.col("millis") >= 0).alias("measured"),
    )


@query
def backup_of_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows too old to be stored are in the backup all the same."""
    job, base = _stream_job(spark, sf_dir, "raw", "late", ("points", "backup"), as_of=fx.AS_OF)
    raw_ingest_stream(spark, _raw_source(spark, sf_dir), job, f"{base}/checkpoint").awaitTermination()
    place = ["host", "database", "retention_policy"]
    saved = backup.read_backup(spark, job.sinks.backup).groupBy(*place).agg(F.count(F.lit(1)).alias("saved"))
    stored = points_table.read_points(spark, job.sinks.points).groupBy(*place).agg(F.count(F.lit(1)).alias("stored"))
    return saved.join(stored, place, "full_outer").select(
        *place, *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("saved", "stored"))
    )


@query
def stream_wipe_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's table, one instance of it doubled, then replaced from the stream's backup."""
    job, base = _stream_job(spark, sf_dir, "raw", "wipe-stream", ("points", "backup"))
    source = _raw_source(spark, sf_dir, batches=2)
    raw_ingest_stream(spark, source, job, f"{base}/checkpoint").awaitTermination()
    restore_target(spark, job.sinks.backup, HOST, job.sinks.points)
    wipe_then_restore(spark, job.sinks.backup, HOST, job.sinks.points, routes=job.routes(spark))
    return _stored_counts(spark, job.sinks.points)


# --- restore ---------------------------------------------------------------


def _host_counts(rows: DataFrame) -> DataFrame:
    value = F.round(F.try_element_at("fields", F.lit("event_value")) * 100).cast("bigint")
    return rows.groupBy("host", "database", "retention_policy", "measurement").agg(
        F.count(F.lit(1)).alias("points"), F.sum(value).alias("cents")
    )


@query
def restore_one_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "restored")
    restore_target(spark, _written_backup(spark, sf_dir), HOST, folder)
    return _host_counts(points_table.read_points(spark, folder))


@query
def restored_points_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored_points(spark, _written_backup(spark, sf_dir))
    return rows.select(
        "host", "database", "retention_policy", "measurement", "ts_s",
        _text_of(F.col("tags")).alias("tags"),
        _decimal_fields(F.col("fields")).alias("fields"),
    )


@query
def wipe_and_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instance, damaged by a doubled write, replaced from backup; the others as they were."""
    folder = scratch_folder(spark, "wiped")
    routed = _routed(spark, sf_dir)
    stored = points_table.stored_points(routed)
    points_table.write_points(stored, folder)
    points_table.write_points(stored.where(F.col("host") == HOST), folder)
    wipe_then_restore(spark, _written_backup(spark, sf_dir), HOST, folder)
    return _host_counts(points_table.read_points(spark, folder))
