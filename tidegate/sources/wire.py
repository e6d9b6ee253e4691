"""Message sources: a broker, or files of messages with the same columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.points import topic_level
from tidegate.schemas import RAW_TOPIC, ROLLUP_TOPICS, WIRE


@dataclass(frozen=True)
class WireSource:
    """Where to read messages.

    ``format`` is ``kafka`` (options name the servers, credentials and group) or a
    file format whose files hold topic, partition, offset and value columns. Of files, a
    batch is limited by their number or by their bytes; Spark refuses both at once.
    """

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    max_records_per_batch: int | None = None
    max_files_per_batch: int | None = None
    max_bytes_per_batch: int | None = None

    def read_options(self) -> dict[str, str]:
        """Options with the limits one micro-batch has to keep."""
        options = dict(self.options)
        if self.format == "kafka" and self.max_records_per_batch:
            options["maxOffsetsPerTrigger"] = str(self.max_records_per_batch)
        if self.format != "kafka" and self.max_files_per_batch:
            options["maxFilesPerTrigger"] = str(self.max_files_per_batch)
        if self.format != "kafka" and self.max_bytes_per_batch:
            options["maxBytesPerTrigger"] = str(self.max_bytes_per_batch)
        return options


def _read(spark: SparkSession, source: WireSource, topics: tuple[str, ...]) -> DataFrame:
    reader = spark.readStream.format(source.format).options(**source.read_options())
    if source.format == "kafka":
        rows = reader.option("subscribe", ",".join(topics)).load()
        return rows.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    return reader.schema(WIRE).load(source.path).where(F.col("topic").isin(*topics))


def read_raw_stream(spark: SparkSession, source: WireSource) -> DataFrame:
    """Stream of raw messages."""
    return _read(spark, source, (RAW_TOPIC,))


def read_rollup_streams(spark: SparkSession, source: WireSource) -> DataFrame:
    """One stream of the rollup messages of all levels."""
    return with_level(_read(spark, source, ROLLUP_TOPICS))


def with_level(messages: DataFrame) -> DataFrame:
    return messages.withColumn("level", topic_level(F.col("topic")))
