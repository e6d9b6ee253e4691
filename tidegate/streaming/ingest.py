"""The two ingestion streams.

Each micro-batch is computed once, kept in Parquet files, and written to every sink before
Spark commits its offsets. Every sink keeps the rows of a batch in directories of their own,
which a rerun of the same batch replaces, also where its rows go elsewhere the second
time: a batch that failed half way, or an executor or driver that was lost, leaves no
duplicates behind. ``compact_sinks`` merges the small files of committed batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.ops import ingested_count_lines, payload_lines, records_count_line, stage_lines
from tidegate.operators.payloads import (
    ingested_data_count,
    ingestion_records_count,
    payload_stats,
)
from tidegate.operators.quarantine import STRICT_RAW, STRICT_ROLLUP
from tidegate.operators.routing import KEY, first_seen_keys, provisioning_plan, route_rows
from tidegate.plans.ingest import raw_decoded, rollup_decoded, route_points, routed_points
from tidegate.schemas import ORIGIN, POLL_RECORDS
from tidegate.session import brief_shuffles, scratch_folder
from tidegate.sources import files
from tidegate.sources.backup import backup_lines, rotate_backup, write_backup
from tidegate.sources.generations import committed_batch, compact, read_live
from tidegate.sources.layout import CODEC, ROWS_PER_FILE
from tidegate.sources.points_table import STORED, compact_points, stored_points, write_batch
from tidegate.sources.snapshots import SeenTable
from tidegate.sources.wire import WireSource, read_raw_stream, read_rollup_streams

# Reasons that belong to the write of a payload rather than to one record.
PAYLOAD_REASONS = ("beyond_retention",)

# Fixed value: batches between two progress reports.
REPORT_EVERY = 1000

POLICY = ("path", "database", "retention_policy")
DEAD_LETTERS = "topic STRING, `partition` INT, `offset` BIGINT, stage STRING, reason STRING, content STRING"
OPS_LINES = "scope STRING, line STRING"


# What every batch needs of its points, and what a sink needs besides: a kept batch holds no more.
_KEPT = {*ORIGIN, "monitoring_system", *KEY, "ts_s", "path", "database", "retention_policy", "reason", "value"}
# What the counters read of a point, besides the length of its line.
_COUNTED = (*ORIGIN, "monitoring_system", *KEY, "reason")
_KEPT_FOR = {"points": set(STORED), "backup": {"line"}, "ops": {"line"}, "provisioning": set()}


class BatchRefused(RuntimeError):
    """A batch holds rows that must stop it; Spark will run it again."""


@dataclass(frozen=True)
class Sinks:
    """Folders written per batch. A sink that is None is switched off."""

    points: str | None
    dead_letter: str
    ops: str | None = None
    backup: str | None = None
    provisioning: str | None = None


@dataclass(frozen=True)
class IngestJob:
    """What to do with every batch of one stream.

    ``routes`` is called per batch, so new routes are seen without a restart; where it
    gives ``prepared_routes``, a batch joins them without an aggregation of its own.
    ``on_error`` says what a refused payload does: ``dead_letter`` files its rows and
    goes on, ``fail`` stops the batch. ``strict`` also stops at the record errors that
    stop a batch in the original instead of filing them.
    ``catalog`` gives the (databases, policies) that exist before the stream starts.
    ``poll_records`` bounds a payload: its lines come from one run of so many offsets.
    ``time_routing`` times decoding and the route lookup apart from all else. Points are
    kept once more for it; else the check, the first stage that needs rows, carries both.
    """

    kind: str
    routes: Callable[[SparkSession], DataFrame]
    sinks: Sinks
    on_error: str = "dead_letter"
    strict: bool = False
    as_of: int | None = None
    rollup_time: str | None = None
    hostname: str = "localhost"
    salts: int = 1
    rows_per_file: int = ROWS_PER_FILE
    poll_records: int = POLL_RECORDS
    catalog: Callable[[SparkSession], tuple[DataFrame, DataFrame]] | None = None
    time_routing: bool = False

    def kept(self, points: DataFrame, *more: str) -> DataFrame:
        """The columns of a batch's points that its sinks read, to be kept for all of them.

        Tags, fields and line text are most of a point's bytes, and no sink reads all of them.
        """
        used = (columns for sink, columns in _KEPT_FOR.items() if getattr(self.sinks, sink) is not None)
        wanted = _KEPT.union(more, *used)
        return points.select(*(name for name in points.columns if name in wanted))

    def fatal_reasons(self) -> tuple[str, ...]:
        strict = STRICT_RAW if self.kind == "raw" else STRICT_ROLLUP
        return (strict if self.strict else ()) + (PAYLOAD_REASONS if self.on_error == "fail" else ())


def ingest_batch(messages: DataFrame, batch_id: int, job: IngestJob) -> None:
    """Decode, check, route and write one batch."""
    spark = messages.sparkSession
    decoded, routed = (scratch_folder(spark, f"batch-{step}") for step in ("decoded", "routed"))
    try:
        with brief_shuffles(spark):
            _ingest_batch(messages, batch_id, job, decoded, routed)
    finally:
        for folder in (decoded, routed):
            files.delete(spark, folder)


def _keep(rows: DataFrame, folder: str) -> DataFrame:
    """The rows from files of their own, so that each sink reads its columns only.

    A point takes 1.4 KB in Spark's cache and a tenth of that here; what the cache puts on disk is read back whole.
    """
    rows.write.option("compression", CODEC).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _ingest_batch(messages: DataFrame, batch_id: int, job: IngestJob, decoded: str, routed: str) -> None:
    spark = messages.sparkSession
    routes = job.routes(spark)
    millis: dict[str, int] = {}
    if job.time_routing:
        points = raw_decoded(messages) if job.kind == "raw" else rollup_decoded(messages, job.rollup_time)
        with _timed(millis, "decode"):
            points = _keep(job.kept(points, "level"), decoded)
        rows = route_points(points, routes, job.as_of, job.salts)
    else:
        rows = routed_points(messages, job.kind, routes, job.as_of, job.salts, job.rollup_time)
    # Dead letters need the message, sound rows do not.
    rows = job.kept(rows.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))))
    if job.time_routing:
        with _timed(millis, "route_lookup"):
            rows = _keep(rows, routed)
    with _timed(millis, "check"):
        rows = rows if job.time_routing else _keep(rows, routed)
        _refuse(rows, job.fatal_reasons())
    sound = rows.where(F.col("reason").isNull())
    # What is refused only when it is written has been backed up by then.
    stored = F.col("reason").isNull() | F.col("reason").isin(*PAYLOAD_REASONS)
    backup = None if job.sinks.backup is None else backup_lines(rows.where(stored))
    if job.sinks.provisioning is not None:
        with _timed(millis, "provision"):
            _provision(sound, routes, batch_id, job)
    if backup is not None:
        with _timed(millis, "backup"):
            write_backup(backup, _of_batch(job.sinks.backup, batch_id), job.rows_per_file, mode="overwrite")
    if job.sinks.points is not None:
        with _timed(millis, "points"):
            write_batch(stored_points(sound, batch_id), job.sinks.points, batch_id, job.rows_per_file)
    with _timed(millis, "dead_letter"):
        _write_dead_letters(rows, backup, batch_id, job)
    if job.sinks.ops is not None:
        write_ops_metrics(rows, batch_id, job, millis)


@contextmanager
def _timed(millis: dict[str, int], stage: str) -> Iterator[None]:
    start = time.perf_counter()
    yield
    millis[stage] = round((time.perf_counter() - start) * 1000)


def _of_batch(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/batch_id={batch_id}"


def _refuse(rows: DataFrame, fatal: tuple[str, ...]) -> None:
    if not fatal:
        return
    # At most one row per reason comes back.
    found = rows.where(F.col("reason").isin(*fatal)).groupBy("reason").count().collect()
    if found:
        raise BatchRefused(", ".join(f"{row['reason']}: {row['count']}" for row in found))


def _write_dead_letters(rows: DataFrame, backup: DataFrame | None, batch_id: int, job: IngestJob) -> None:
    refused = rows.where(F.col("reason").isNotNull()).select(
        *ORIGIN, F.lit("ingest").alias("stage"), "reason", F.col("value").alias("content")
    )
    if backup is not None:
        refused = refused.unionByName(
            backup.where(F.col("backup_reason").isNotNull()).select(
                *ORIGIN,
                F.lit("backup").alias("stage"),
                F.col("backup_reason").alias("reason"),
                F.col("line").alias("content"),
            )
        )
    refused.write.mode("overwrite").option("compression", CODEC).parquet(_of_batch(job.sinks.dead_letter, batch_id))


def ops_rows(rows: DataFrame, kind: str, hostname: str, poll_records: int = POLL_RECORDS) -> DataFrame:
    """Counters of one batch: per source, per payload, and of the whole batch."""
    sound = rows.where(F.col("reason").isNull())
    stats = payload_stats(sound, poll_records)
    totals = stats.agg(
        F.coalesce(F.sum("payload_records"), F.lit(0)).alias("payload_records"),
        F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("payload_bytes"),
    )
    parts = {
        "source": ingested_count_lines(ingested_data_count(rows)),
        "payload": payload_lines(stats, kind, hostname),
        "batch": records_count_line(ingestion_records_count(rows), kind, hostname).unionByName(
            payload_lines(totals, kind, hostname)
        ),
    }
    scoped = [lines.select(F.lit(scope).alias("scope"), "line") for scope, lines in parts.items()]
    return scoped[0].unionByName(scoped[1]).unionByName(scoped[2])


def write_ops_metrics(
    rows: DataFrame, batch_id: int, job: IngestJob, millis: dict[str, int] | None = None
) -> None:
    """Write the counters of a batch and, if given, the milliseconds of its stages.

    Each counter is a pass of its own over the rows; unless they are kept already, what the
    counters read of them is, so that they are decoded and routed once.
    """
    counted = rows
    if rows.storageLevel == StorageLevel.NONE:
        line_bytes = F.octet_length("line").alias("line_bytes")
        counted = rows.select(*_COUNTED, line_bytes).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lines = ops_rows(counted, job.kind, job.hostname, job.poll_records)
        if millis:
            timed = stage_lines(rows.sparkSession, millis, job.kind, job.hostname)
            lines = lines.unionByName(timed.select(F.lit("stage").alias("scope"), "line"))
        lines.write.mode("overwrite").parquet(_of_batch(job.sinks.ops, batch_id))
    finally:
        if counted is not rows:
            counted.unpersist()


def _provision(sound: DataFrame, routes: DataFrame, batch_id: int, job: IngestJob) -> None:
    """Plan what the routes of newly seen keys need, each key and each statement once.

    Keys and planned policies of earlier batches are read from the buckets that this batch's fall in.
    """
    spark = sound.sparkSession
    folder = job.sinks.provisioning.rstrip("/")
    seen = SeenTable(spark, f"{folder}/keys", ", ".join(f"{name} STRING" for name in KEY), KEY)
    made = SeenTable(spark, f"{folder}/planned", ", ".join(f"{name} STRING" for name in POLICY), POLICY[:2])
    keys = sound.select(*KEY).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    news = first_seen_keys(keys, seen.before(keys, batch_id)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        wanted = route_rows(routes.join(news, list(KEY), "left_semi"))
        earlier = made.before(wanted.select(*POLICY[:2]).distinct(), batch_id)
        known_databases, known_policies = earlier.select(*POLICY[:2]).distinct(), earlier
        if job.catalog is not None:
            databases, policies = job.catalog(spark)
            known_databases = known_databases.unionByName(databases)
            known_policies = known_policies.unionByName(policies)
        path = _of_batch(f"{folder}/plan", batch_id)
        plan = provisioning_plan(wanted, known_databases, known_policies)
        plan.write.mode("overwrite").parquet(path)
        made.add(spark.read.schema(plan.schema).parquet(path).select(*POLICY), batch_id)
        seen.add(news, batch_id)
    finally:
        news.unpersist()
        keys.unpersist()


def compact_sinks(spark: SparkSession, job: IngestJob, checkpoint: str, before_day: str | None = None) -> int:
    """Merge the small files that a stream's committed batches have written; returns the last batch taken.

    The stream and readers may go on meanwhile. The backup is rotated only up to ``before_day``, if one is given.
    """
    upto = committed_batch(spark, checkpoint)
    if upto < 0:
        return upto
    if job.sinks.points is not None:
        compact_points(spark, job.sinks.points, upto, job.rows_per_file)
    compact(spark, job.sinks.dead_letter, DEAD_LETTERS, upto, order=("stage", "reason"))
    if job.sinks.ops is not None:
        compact(spark, job.sinks.ops, OPS_LINES, upto, order=("scope",))
    if job.sinks.backup is not None and before_day is not None:
        rotate_backup(spark, job.sinks.backup, upto, before_day, job.rows_per_file)
    return upto


def read_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters of all batches, compacted or not."""
    return read_live(spark, folder, DEAD_LETTERS)


def read_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Counter and timer lines of all batches, compacted or not."""
    return read_live(spark, folder, OPS_LINES)


def start_ingest(
    messages: DataFrame,
    job: IngestJob,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    report: Callable[[int], None] = lambda n: print(f"Processed {n} batches."),
) -> StreamingQuery:
    """Run ``ingest_batch`` on a stream of messages.

    Offsets are committed after the batch function returns, so after every write. The
    default trigger takes what is there and stops. ``report`` hears of every
    ``REPORT_EVERY``-th batch since the start.
    """
    reporter = BatchReporter(report)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, job)
        reporter.done()

    writer = messages.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def raw_ingest_stream(
    spark: SparkSession, source: WireSource, job: IngestJob, checkpoint: str, **kwargs
) -> StreamingQuery:
    return start_ingest(read_raw_stream(spark, source), job, checkpoint, **kwargs)


def rollup_ingest_stream(
    spark: SparkSession, source: WireSource, job: IngestJob, checkpoint: str, **kwargs
) -> StreamingQuery:
    return start_ingest(read_rollup_streams(spark, source), job, checkpoint, **kwargs)


def stop_on_error(query: StreamingQuery) -> str | None:
    """Wait for a query that may fail; the message of the failure, or None.

    Its batch is not committed: started again, the same batch runs again.
    """
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        return str(error)
    return None


class BatchReporter:
    """Counts the batches of one stream since its start and reports every ``REPORT_EVERY``."""

    def __init__(self, report: Callable[[int], None]):
        self.batches = 0
        self._report = report

    def done(self) -> None:
        self.batches += 1
        if self.batches % REPORT_EVERY == 0:
            self._report(self.batches)
