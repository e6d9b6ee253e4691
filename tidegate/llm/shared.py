"""What several operators share: words of a text, Arrow batches of bounded size, stored steps, components of a graph."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import scratch_folder

#: Bytes of text that a task works on at once.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it back, so that it is computed once and survives executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of(key: str, buckets: int) -> Column:
    """crc32 of a column's text, modulo ``buckets``; null counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % buckets, F.lit(0))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at just these six characters."""
    return text.split() if text else []


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece have about ``most`` bytes at most; a longer text is a piece of its own."""
    for batch in batches:
        start, total = 0, 0
        for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of token ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def local_labels(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest index that each row reaches."""
    labels = np.arange(len(linked))
    while True:
        lower = np.minimum(labels, np.where(linked, labels[None, :], len(linked)).min(axis=1, initial=len(linked)))
        lower = lower[lower]
        if (lower == labels).all():
            return labels
        labels = lower


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, component), component being the smallest node.

    Rounds of large-star and small-star, each stored, until nothing changes; the number of rounds grows with the
    logarithm of the graph's size. Minima are aggregated before they are joined back, so a hub costs no large group.
    Loops and nulls are ignored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = store(edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = store(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
