"""Which partitions each batch has written, so that a rerun removes what it does not write again.

``folder/_written/<batch>/run=<n>`` lists the partitions of one run and is complete before that run writes its first
row. The lists of all runs of a batch together therefore name every partition that may hold rows of it, wherever a run
stopped. When a run has written its rows, partitions that only earlier runs have are deleted, and then their lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.sources import files


def _lists(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/_written/{batch_id}"


def has_run(spark: SparkSession, folder: str, batch_id: int) -> bool:
    """Whether a run of the batch has begun to write here."""
    return bool(files.names(spark, _lists(folder, batch_id)))


def replace_batch(rows: DataFrame, folder: str, batch_id: int, partitions: tuple[str, ...], write: Callable[[], None]) -> None:
    """Run ``write``, which overwrites the ``partitions`` of ``rows`` below ``folder``, in the place of the batch's earlier runs."""
    spark = rows.sparkSession
    lists = _lists(folder, batch_id)
    earlier = files.names(spark, lists)
    mine = f"run={max((int(name.removeprefix('run=')) for name in earlier), default=-1) + 1}"
    # One row per partition of one batch.
    rows.select(*partitions).distinct().write.parquet(f"{lists}/{mine}")
    write()
    if not earlier:
        return
    schema = rows.select(*partitions).schema
    before = spark.read.schema(schema).parquet(*(f"{lists}/{name}" for name in earlier)).distinct()
    stale = before.join(spark.read.schema(schema).parquet(f"{lists}/{mine}"), list(partitions), "left_anti")
    delete_partitions(spark, folder, stale)
    for name in earlier:
        files.delete(spark, f"{lists}/{name}")


def delete_partitions(spark: SparkSession, folder: str, partitions: DataFrame) -> None:
    """Delete the directories of partition values, a stream of names through the driver, and those left empty above them."""
    root = folder.rstrip("/")
    for row in partitions.toLocalIterator():
        steps = files.partition_path(spark, row.asDict()).split("/")
        files.delete(spark, "/".join([root, *steps]))
        while len(steps) > 1 and not files.visible(spark, "/".join([root, *steps[:-1]])):
            steps.pop()
            files.delete(spark, "/".join([root, *steps]))
