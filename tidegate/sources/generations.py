"""Compaction of what a stream writes per batch, in place, while the stream and its readers go on.

A folder with rows per batch gets merged parts in ``_parts/part=<name>`` and numbered pointers in ``_generations``. The
newest pointer says which parts count, and which batches (and days) they cover; files of covered batches are not read
any more. So readers see each row once, before, during and after a compaction: a new pointer, one small file that is
only created if its number is free, is the only step that changes what they see. Files that a generation has replaced
are deleted when the next compaction begins, so readers that started before have until then.

Only batches that the stream has committed may be compacted (``committed_batch``). Parts of Parquet tables keep each
row's batch in ``from_batch``. A covered batch that is written again becomes live in its own files, and its rows in the
parts are left out from then on. A compaction that stops half way has written a part that no pointer names; the next one
deletes it. Two compactions of one folder must not run at once: the second to end fails with ``Superseded``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from itertools import groupby

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tidegate.sources import files
from tidegate.sources.layout import CODEC
from tidegate.sources.manifest import delete_partitions

#: From so many parts on, a compaction merges them into one.
MOST_PARTS = 16
_POINTERS_KEPT = 3


class Superseded(RuntimeError):
    """Another generation was written meanwhile; what was done is not in effect."""


@dataclass(frozen=True)
class Part:
    name: str
    without_batches: tuple[int, ...] = ()
    without_hosts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Generation:
    """``live``: batches up to ``upto_batch`` that are read from their own files all the same."""

    number: int = 0
    upto_batch: int = -1
    before_day: str | None = None
    parts: tuple[Part, ...] = ()
    live: tuple[int, ...] = ()
    garbage: tuple[str, ...] = field(default=())

    def covers(self, batch: Column, day: Column | None = None) -> Column:
        """Rows of batch files that are in a part; rows that no stream wrote have negative batches and are in none."""
        covered = batch.between(0, self.upto_batch) & ~batch.isin(*self.live) if self.live else batch.between(0, self.upto_batch)
        return covered & (day < self.before_day) if self.before_day is not None else covered


def _pointers(folder: str) -> str:
    return f"{folder.rstrip('/')}/_generations"


def part_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/_parts/part={name}"


def current(spark: SparkSession, folder: str) -> Generation:
    """The newest generation; number 0, without parts, for a folder that was never compacted."""
    for name in sorted(files.names(spark, _pointers(folder)), reverse=True):
        try:
            found = json.loads(files.read_text(spark, f"{_pointers(folder)}/{name}"))
        except ValueError:  # cut off while it was written: never in effect
            continue
        parts = tuple(Part(p["name"], tuple(p["without_batches"]), tuple(p["without_hosts"])) for p in found.pop("parts"))
        return Generation(**found | {"parts": parts, "live": tuple(found["live"]), "garbage": tuple(found["garbage"])})
    return Generation()


def commit(spark: SparkSession, folder: str, seen: Generation, new: Generation) -> None:
    """Make ``new`` the folder's generation if ``seen`` still is."""
    taken = files.names(spark, _pointers(folder))
    number = max((int(name) for name in taken), default=0) + 1
    text = json.dumps(asdict(replace(new, number=number)))
    if current(spark, folder).number != seen.number or not files.create_text(spark, f"{_pointers(folder)}/{number:012d}", text):
        raise Superseded(f"{folder} has a newer generation than {seen.number}")
    for name in taken[: 1 - _POINTERS_KEPT]:
        files.delete(spark, f"{_pointers(folder)}/{name}")


def _change(spark: SparkSession, folder: str, change: Callable[[Generation], Generation]) -> None:
    """Commit a change that holds whatever generation it meets."""
    while True:
        seen = current(spark, folder)
        new = change(seen)
        if new == seen:
            return
        try:
            return commit(spark, folder, seen, new)
        except Superseded:
            continue


def revive_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Read a batch from its own files from now on, if a part covers it."""

    def change(now: Generation) -> Generation:
        if not 0 <= batch_id <= now.upto_batch:
            return now
        parts = tuple(replace(p, without_batches=tuple(sorted({*p.without_batches, batch_id}))) for p in now.parts)
        return replace(now, parts=parts, live=tuple(sorted({*now.live, batch_id})))

    _change(spark, folder, change)


def leave_out_host(spark: SparkSession, folder: str, host: str) -> None:
    """Leave an instance, named as in the directories, out of all parts."""
    _change(spark, folder, lambda now: replace(now, parts=tuple(replace(p, without_hosts=tuple(sorted({*p.without_hosts, host}))) for p in now.parts)))


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose offsets a stream has committed; -1 before the first."""
    return max((int(name) for name in files.names(spark, f"{checkpoint.rstrip('/')}/commits") if name.isdigit()), default=-1)


def part_rows(spark: SparkSession, folder: str, now: Generation, read: Callable[[DataFrameReader, list[str]], DataFrame]) -> DataFrame | None:
    """Rows of the parts that count; ``read`` gets a reader and the paths of parts with the same rows left out."""

    def left_out(part: Part) -> tuple:
        return part.without_batches, part.without_hosts

    rows = None
    for (batches, hosts), parts in groupby(sorted(now.parts, key=left_out), key=left_out):
        reader = spark.read.option("basePath", f"{folder.rstrip('/')}/_parts")
        some = read(reader, [part_path(folder, p.name) for p in parts]).drop("part")
        if batches:
            some = some.where(~F.col("from_batch").isin(*batches))
        if hosts:
            some = some.where(~F.col("host").isin(*hosts))
        rows = some if rows is None else rows.unionByName(some)
    return rows


def read_live(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a Parquet folder with a directory per batch, and their ``batch_id``; ``schema`` is that of all other columns."""
    now = current(spark, folder)
    rows = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(folder)
    parts = part_rows(spark, folder, now, lambda reader, paths: reader.schema(f"{schema}, from_batch BIGINT").parquet(*paths))
    if parts is None:
        return rows
    return rows.where(~now.covers(F.col("batch_id"))).unionByName(parts.withColumnRenamed("from_batch", "batch_id"))


def compact(
    spark: SparkSession,
    folder: str,
    schema: str,
    upto_batch: int,
    partitions: tuple[str, ...] = (),
    order: tuple[str, ...] = (),
    rows_per_file: int = 1_000_000,
    most_parts: int = MOST_PARTS,
) -> Generation:
    """Merge the files of committed batches up to ``upto_batch`` of a Parquet folder; ``partitions`` lie above its batches."""
    now = clean(spark, folder)
    columns = f"{schema}, batch_id BIGINT"
    batches = spark.read.schema(columns).parquet(folder)
    fresh = batches.where(F.col("batch_id").between(now.upto_batch + 1, upto_batch) | (F.col("batch_id").isin(*now.live) if now.live else F.lit(False)))
    rows, merged = fresh.withColumnRenamed("batch_id", "from_batch"), len(now.parts) >= most_parts
    if merged:
        rows = rows.unionByName(part_rows(spark, folder, now, lambda reader, paths: reader.schema(f"{schema}, from_batch BIGINT").parquet(*paths)))
    spread = [F.col(name) for name in partitions] or [F.col("from_batch")]

    def write(path: str) -> None:
        laid_out = rows.hint("rebalance", *spread).sortWithinPartitions(*partitions, *order, "from_batch")
        laid_out.write.option("maxRecordsPerFile", rows_per_file).option("compression", CODEC).partitionBy(*partitions).parquet(path)

    return advance(spark, folder, now, replace(now, upto_batch=max(now.upto_batch, upto_batch), live=()), write, fresh.select(*partitions, "batch_id"), merged)


def advance(
    spark: SparkSession, folder: str, now: Generation, new: Generation, write: Callable[[str], None], replaced: DataFrame, merged: bool
) -> Generation:
    """Write a part, list the directories it replaces, and commit; nothing is done if there is nothing to replace."""
    name = uuid.uuid4().hex
    garbage = f"{folder.rstrip('/')}/_garbage/{name}"
    replaced.distinct().write.parquet(garbage)
    if spark.read.schema(replaced.schema).parquet(garbage).isEmpty():
        files.delete(spark, garbage)
        return now
    write(part_path(folder, name))
    kept = () if merged else now.parts
    commit(spark, folder, now, replace(new, parts=(*kept, Part(name)), garbage=(name,)))
    return current(spark, folder)


def clean(spark: SparkSession, folder: str) -> Generation:
    """Delete what earlier generations have replaced, and parts that no pointer names; returns the present generation."""
    now = current(spark, folder)
    root = folder.rstrip("/")
    for name in files.names(spark, f"{root}/_garbage"):
        if name in now.garbage:
            replaced = spark.read.parquet(f"{root}/_garbage/{name}")
            # A batch that came to life again since has its rows there.
            delete_partitions(spark, root, replaced.where(~F.col("batch_id").isin(*now.live)) if now.live else replaced)
        files.delete(spark, f"{root}/_garbage/{name}")
    counting = {part_path(root, p.name) for p in now.parts}
    for name in files.names(spark, f"{root}/_parts"):
        if f"{root}/_parts/{name}" not in counting:
            files.delete(spark, f"{root}/_parts/{name}")
    return now
