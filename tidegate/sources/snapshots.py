"""A table of what was seen before, in buckets: a batch reads and rewrites only the buckets it has keys in.

``folder/bucket=<b>/as_of=<n>`` is the whole content of a bucket after batch n, never changed by later batches. Batch m
reads of each of its buckets the latest state before m, so what it reads depends on its own keys and on the size of their
buckets, not on the number of batches. Buckets that get new rows are written as states of batch m; states that a newer
one before m has replaced are deleted. A batch that runs again reads the same states, and its first run's states are
replaced or deleted (``manifest``), so it finds the same news.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources import files
from tidegate.sources.manifest import has_run, replace_batch

BUCKETS = 256
_PARTITIONS = ("bucket", "as_of")


class SeenTable:
    """Rows of ``schema``, spread over buckets by a hash of the ``key`` columns."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: tuple[str, ...], buckets: int = BUCKETS):
        self.spark, self.folder, self.schema, self.key, self.buckets = spark, folder.rstrip("/"), schema, key, buckets

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _states(self, bucket: int, batch_id: int) -> list[int]:
        """Batches before ``batch_id`` whose state of the bucket is there, latest first."""
        found = files.names(self.spark, f"{self.folder}/bucket={bucket}")
        states = (int(name.removeprefix("as_of=")) for name in found if name.startswith("as_of="))
        return sorted((n for n in states if n < batch_id), reverse=True)

    def paths(self, buckets: list[int], batch_id: int) -> list[str]:
        """The latest states of the buckets before a batch."""
        states = {b: self._states(b, batch_id)[:1] for b in buckets}
        return [f"{self.folder}/bucket={b}/as_of={n[0]}" for b, n in states.items() if n]

    def before(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """What was seen before a batch in the buckets of its rows."""
        # At most as many numbers as there are buckets.
        return self._read([r[0] for r in self.bucketed(rows).select("bucket").distinct().collect()], batch_id)

    def _read(self, buckets: list[int], batch_id: int) -> DataFrame:
        paths = self.paths(buckets, batch_id)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def add(self, news: DataFrame, batch_id: int) -> None:
        """Add a batch's rows, which are distinct and not in the table; a rerun replaces those of its first run."""
        rows = self.bucketed(news)
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]
        if not touched and not has_run(self.spark, self.folder, batch_id):
            return
        whole = rows.unionByName(self.bucketed(self._read(touched, batch_id))).withColumn("as_of", F.lit(batch_id).cast("long"))

        def write() -> None:
            (
                whole.repartition("bucket")
                .sortWithinPartitions("bucket", *self.key)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*_PARTITIONS)
                .parquet(self.folder)
            )

        replace_batch(rows.withColumn("as_of", F.lit(batch_id).cast("long")), self.folder, batch_id, _PARTITIONS, write)
        for bucket in touched:
            for old in self._states(bucket, batch_id)[1:]:
                files.delete(self.spark, f"{self.folder}/bucket={bucket}/as_of={old}")
