"""Spark's own progress of every batch, kept beyond the hundred that a query remembers.

A ``ProgressLog`` listens to the streams of a session and writes each progress, a few KB of JSON, as a file of its own; the
driver has it at hand, so no job runs for it. Every ``merge_every`` files of a stream are merged into one, and deleted at
the merge after that, so a reader that has listed them still finds them. A progress that stands in two files is read once.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegate.sources import files

_PROGRESS = "id STRING, runId STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT, durationMs MAP<STRING, BIGINT>"


class ProgressLog(StreamingQueryListener):
    """Use as ``with ProgressLog(spark, folder) as log``; a progress that cannot be written does not stop its stream."""

    def __init__(self, spark: SparkSession, folder: str, merge_every: int = 100):
        self._spark, self._folder, self._merge_every = spark, folder.rstrip("/"), merge_every
        self._merged: dict[str, list[str]] = {}
        self._written: dict[str, int] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self._spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Whether all progress of a query that has ended is written; Spark delivers it a little later."""
        until = time.monotonic() + seconds
        with self._news:
            while str(query.runId) not in self._ended:
                if not self._news.wait(max(0.0, until - time.monotonic())) and time.monotonic() >= until:
                    return False
        return True

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        stream = str(progress.id)
        files.create_text(self._spark, f"{self._folder}/one-{stream}-{progress.runId}-{progress.batchId:012d}.json", progress.json + "\n")
        self._written[stream] = self._written.get(stream, 0) + 1
        if self._written[stream] % self._merge_every == 0:
            self._merge(stream, f"{progress.runId}-{progress.batchId:012d}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def _merge(self, stream: str, upto: str) -> None:
        done = self._merged.get(stream, [])
        names = [name for name in files.names(self._spark, self._folder) if name.startswith(f"one-{stream}-") and name not in done]
        text = "".join(files.read_text(self._spark, f"{self._folder}/{name}") for name in names)
        files.create_text(self._spark, f"{self._folder}/many-{stream}-{upto}.json", text)
        for name in done:
            files.delete(self._spark, f"{self._folder}/{name}")
        self._merged[stream] = names


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per run and batch: its input rows and the milliseconds of each of Spark's stages."""
    rows = spark.read.schema(_PROGRESS).json(folder)
    return rows.select(
        F.col("id").alias("query_id"),
        F.col("runId").alias("run_id"),
        F.col("batchId").alias("batch_id"),
        F.to_timestamp("timestamp").alias("started"),
        F.col("numInputRows").alias("input_rows"),
        F.col("durationMs").alias("millis"),
    ).dropDuplicates(["query_id", "run_id", "batch_id"])


def progress_stages(progress: DataFrame) -> DataFrame:
    """Rows of ``read_progress``, one per stage."""
    return progress.select("query_id", "run_id", "batch_id", "started", "input_rows", F.explode("millis").alias("stage", "millis"))
