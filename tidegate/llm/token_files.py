"""Token ids as Parquet list columns, one row per document in ascending ``doc_id`` order, and readers that take only what they need.

A folder holds ``tokens/`` (doc_id, part, local_start, n_tokens, ids) and ``parts/`` (part, first and last doc_id, number
of documents and tokens, start: all ids of earlier parts). Parts are ranges of doc_id; rows within are sorted, so row
groups and pages cover narrow ranges of doc_id and filters on it skip the rest. ``ids`` is dictionary-encoded while a
column chunk's dictionary is small and delta-encoded otherwise (format version 2); the other integers are
delta-encoded. Parquet's column and offset indexes (page indexes) are always written. ``n_tokens`` and ``local_start``
are columns of their own, so metadata is read without touching ids.

Null and empty texts have the end id alone. Rows that repeat a doc_id all stay, ordered by their text as well. An empty
table gives an empty ``parts``. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import CHUNK_BYTES, chunks, crc
from tidegate.llm.tokens import END, encoder, vocabulary

TOKENS = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000


def _encode_sorted(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in chunks(batches, most=2 * CHUNK_BYTES):
            ids, begins = encoder(path).encode(batch.column("text"))
            n = batch.num_rows
            lengths = np.diff(begins) + 1
            ends = np.cumsum(lengths)
            full = np.full(int(ends[-1]) if n else 0, end, np.int32)
            keep = np.ones(len(full), bool)
            keep[ends - 1] = False
            full[keep] = ids
            starts = start + ends - lengths
            start += len(full)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(starts),
                    pa.array(lengths.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(ends - lengths, len(full)).astype(np.int32)), pa.array(full)),
                ],
                names=["doc_id", "part", "local_start", "n_tokens", "ids"],
            )

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END,
                      row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the folder described above."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    (
        rows.mapInArrow(_encode_sorted(tokenizer or vocabulary(), end), TOKENS)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("compression", "snappy")
        .parquet(f"{path}/tokens")
    )
    parts = spark.read.schema(TOKENS).parquet(f"{path}/tokens").groupBy("part").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # One row per part: a running sum over the parts, not over documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/parts")


def read_documents(spark: SparkSession, path: str, columns: tuple[str, ...] = ("n_tokens",)) -> DataFrame:
    """(doc_id, start, chosen columns); only those columns are read, and filters on doc_id skip row groups and pages."""
    rows = spark.read.schema(TOKENS).parquet(f"{path}/tokens").select("doc_id", "part", "local_start", *columns)
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    return rows.join(parts, "part").withColumn("start", F.col("start") + F.col("local_start")).drop("part", "local_start")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        crcs = [crc(values[a:b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("part"), batch.column("local_start"), batch.column("n_tokens").cast(pa.int64()), pa.array(crcs, pa.int64())],
            names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    rows = spark.read.schema(TOKENS).parquet(f"{path}/tokens").mapInArrow(_digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    return rows.join(parts, "part").select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def decode(files: DataFrame, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Texts from rows (doc_id, ids): the exact texts that were encoded, empty for null."""
    path = tokenizer or vocabulary()

    def run(batches):
        for batch in batches:
            lists = [x[:-1] if x and x[-1] == end else x for x in batch.column("ids").to_pylist()]
            texts = encoder(path).tokenizer.decode_batch(lists, skip_special_tokens=False)
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return files.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
