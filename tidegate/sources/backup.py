"""Gzip line-protocol backup: guards, writing, reading back, rotation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.places import dml_header, instance_host, payload_timestamp, utc_day
from tidegate.functions.text import has_text
from tidegate.schemas import ORIGIN
from tidegate.sources import files, generations
from tidegate.sources.layout import ROWS_PER_FILE

# Directory levels, outermost first; names are URL-encoded inside them.
PLACE = ("host", "database", "retention_policy", "day")


def payload_guards(line: Column, database: Column, policy: Column, path: Column) -> Column:
    """Why a payload is refused, NULL if all four parts are given."""
    return (
        F.when(~has_text(line), "blank_payload")
        .when(~has_text(database), "blank_database")
        .when(~has_text(policy), "blank_retention_policy")
        .when(~has_text(instance_host(path)), "blank_host")
        # Readers of line protocol take such a line for a comment.
        .when(line.startswith("#"), "comment_line")
    )


def time_required(seconds: Column) -> Column:
    """A line is filed by the digits that end it, so a time before 1970 is none."""
    return F.when(utc_day(seconds).isNull() | (seconds < 0), "no_timestamp")


def backup_time_required(line: Column) -> Column:
    return time_required(payload_timestamp(line))


def backup_lines(routed: DataFrame) -> DataFrame:
    """Routed points -> rows to back up, with their place or a ``backup_reason``.

    ``ts_s`` is the time that ends the line; taken from its column, it spares those
    who only count places from building lines.
    """
    c = F.col
    return routed.select(
        "topic",
        "partition",
        "offset",
        "measurement",
        instance_host(c("path")).alias("host"),
        "database",
        "retention_policy",
        utc_day(c("ts_s")).alias("day"),
        "ts_s",
        "line",
        F.coalesce(
            payload_guards(c("measurement"), c("database"), c("retention_policy"), c("path")),
            time_required(c("ts_s")),
        ).alias("backup_reason"),
    )


def backup_manifest(lines: DataFrame) -> DataFrame:
    """Lines per backup place."""
    return lines.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("lines"))


def _numbered(rows_per_file: int):
    """A function for ``mapInArrow`` that deals the rows of each place in a task to files and adds a row before each.

    What it keeps are the places of one task and how many rows they had so far. It is
    nested, and imports what it needs, so workers can run it without this package.
    """
    place = PLACE

    def number(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        seen: dict[str, int] = {}
        for batch in batches:
            # Encoded names hold no slash.
            key = pc.binary_join_element_wise(*(batch.column(name) for name in place), "/").dictionary_encode()
            group, names = key.indices.to_numpy(), key.dictionary.to_pylist()
            sizes = np.bincount(group, minlength=len(names))
            before = np.array([seen.get(name, 0) for name in names], dtype=np.int64)
            nth = np.empty(len(group), dtype=np.int64)
            nth[np.argsort(group, kind="stable")] = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            nth += before[group]
            seen.update(zip(names, (before + sizes).tolist(), strict=True))
            lines = batch.append_column("file_no", pa.array(nth // rows_per_file))
            yield lines.append_column("is_line", pa.array(np.ones(len(nth), dtype=bool)))
            first = lines.filter(pa.array(nth % rows_per_file == 0))
            if first.num_rows:
                first = first.set_column(first.schema.get_field_index("line"), "line", pa.nulls(first.num_rows, pa.string()))
                yield first.append_column("is_line", pa.array(np.zeros(first.num_rows, dtype=bool)))

    return number


def with_headers(sound: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows as they are written, in one pass over the input: places together, crowded ones
    split by Spark, and within a task each run of ``rows_per_file`` rows of a place
    headed by a row of its own, in order of arrival.

    Which rows share a task is only known behind the shuffle, and no expression can
    tell there which one is the first of its place; so the rows pass through Arrow once.
    """
    c = F.col
    # Never NULL: Spark's writer would sort once more by columns that may be.
    encoded = [F.coalesce(F.url_encode(name), F.lit("")).alias(name) for name in PLACE[:3]]
    placed = sound.select(*encoded, F.coalesce("day", F.lit("")).alias("day"), *ORIGIN, "line")
    names = ", ".join(f"{name} STRING NOT NULL" for name in PLACE)
    schema = f"{names}, topic STRING, `partition` INT, `offset` BIGINT, line STRING, file_no BIGINT, is_line BOOLEAN"
    header = dml_header(F.url_decode("database"), F.url_decode("retention_policy"))
    return (
        placed.hint("rebalance", *map(c, PLACE))
        .mapInArrow(_numbered(rows_per_file), schema)
        .sortWithinPartitions(*PLACE, "file_no", "is_line", *ORIGIN)
        .select(*PLACE, F.when(c("is_line"), c("line")).otherwise(header).alias("value"))
    )


def write_backup(
    lines: DataFrame,
    folder: str,
    rows_per_file: int = ROWS_PER_FILE,
    enabled: bool = True,
    mode: str = "append",
) -> None:
    """Write rows of ``backup_lines`` that have no ``backup_reason``."""
    if not enabled:
        return
    sound = lines.where(F.col("backup_reason").isNull())
    (
        with_headers(sound, rows_per_file)
        .write.mode(mode)
        .partitionBy(*PLACE)
        .option("compression", "gzip")
        .option("lineSep", "\n")
        # A header and its lines fill a file exactly.
        .option("maxRecordsPerFile", rows_per_file + 1)
        .text(folder)
    )


def _text(reader: DataFrameReader, paths: list[str], batches: bool = False) -> DataFrame:
    # The line separator is named: by default a carriage return would split lines too.
    names = ", ".join(f"{name} STRING" for name in PLACE)
    schema = f"value STRING, {'batch_id BIGINT, ' if batches else ''}{names}"
    return reader.schema(schema).option("lineSep", "\n").format("text").load(paths)


def _has_batches(spark: SparkSession, folder: str) -> bool:
    """Whether a batch has files of its own; without any, Spark would not know the columns that directories stand for."""
    return any(files.visible(spark, f"{folder.rstrip('/')}/{name}") for name in files.visible(spark, folder))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """All lines that count, headers among them, with their encoded place and their file."""
    now = generations.current(spark, folder)
    columns = [*PLACE, "value", F.col("_metadata.file_path").alias("file")]
    if not now.parts:
        return _text(spark.read, [folder]).select(*columns)
    rows = generations.part_rows(spark, folder, now, _text).select(*columns)
    if not _has_batches(spark, folder):
        return rows
    batches = _text(spark.read, [folder], batches=True)
    return rows.unionByName(batches.where(~now.covers(F.col("batch_id"), F.col("day"))).select(*columns))


def _decoded(rows: DataFrame) -> DataFrame:
    # Only the outer names are decoded: they alone were encoded.
    return rows.withColumns({name: F.url_decode(name) for name in PLACE[:3]})


def read_backup(spark: SparkSession, folder: str, host: str | None = None) -> DataFrame:
    """Lines of a backup with the place each belongs to; one instance only, if given.

    Every header line is dropped, wherever it stands: files may have been joined.
    """
    rows = read_files(spark, folder)
    if host is not None:
        # Compared in encoded form, so whole directories are left unread.
        rows = rows.where(F.col("host") == F.url_encode(F.lit(host)))
    lines = rows.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return _decoded(lines).select(
        *PLACE, F.col("value").alias("line"), payload_timestamp(F.col("value")).alias("ts_s")
    )


def header_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """Headers that name another database or policy than their directory does."""
    named = {
        "database": "# CONTEXT-DATABASE: ",
        "retention_policy": "# CONTEXT-RETENTION-POLICY: ",
    }
    wrong = F.lit(False)
    for column, prefix in named.items():
        wrong = wrong | (
            F.col("value").startswith(prefix)
            & (F.substr("value", F.lit(len(prefix) + 1)) != F.col(column))
        )
    return _decoded(read_files(spark, folder).drop("file")).where(wrong)


def _as_lines(encoded: DataFrame) -> DataFrame:
    """Rows of backup files as rows of ``backup_lines``."""
    lines = encoded.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return _decoded(lines).select(
        *PLACE,
        F.col("value").alias("line"),
        # The position in the files stands for arrival.
        F.lit("").alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("string").alias("backup_reason"),
    )


def compact_backup(
    spark: SparkSession, folder: str, target: str, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Rewrite the many small files of a stream as few large ones, into a new folder."""
    write_backup(_as_lines(read_files(spark, folder)), target, rows_per_file, mode="overwrite")


def rotate_backup(
    spark: SparkSession,
    folder: str,
    upto_batch: int,
    before_day: str,
    rows_per_file: int = ROWS_PER_FILE,
    most_parts: int = generations.MOST_PARTS,
) -> generations.Generation:
    """Merge the files of finished days, those before ``before_day``, in place while a stream writes other batches.

    Only batches up to ``upto_batch`` are taken, which the stream must have committed; they are final from then on. A
    late line of a finished day, in a later batch, stays in its own file until the next rotation. Days that were
    rotated before are not written again unless there are ``most_parts`` parts by now.
    """
    now = generations.clean(spark, folder)
    new = replace(now, upto_batch=max(now.upto_batch, upto_batch), before_day=max(now.before_day or "", before_day))
    if not _has_batches(spark, folder):
        return now
    batches = _text(spark.read, [folder], batches=True)
    day, batch = F.col("day"), F.col("batch_id")
    fresh = batches.where(new.covers(batch, day))
    if now.parts:
        fresh = fresh.where(~now.covers(batch, day))
    rows, merged = fresh.select(*PLACE, "value"), len(now.parts) >= most_parts
    if merged:
        rows = rows.unionByName(generations.part_rows(spark, folder, now, _text).select(*PLACE, "value"))
    return generations.advance(
        spark, folder, now, new, lambda path: write_backup(_as_lines(rows), path, rows_per_file, mode="overwrite"), fresh.select("batch_id", *PLACE), merged
    )
