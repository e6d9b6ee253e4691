"""Small file operations on whatever file system a folder is in, done by the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, place = _at(spark, folder)
    return sorted(found.getPath().getName() for found in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder and all in it, if it exists."""
    system, place = _at(spark, path)
    system.delete(place, True)


def visible(spark: SparkSession, folder: str) -> list[str]:
    """Names that readers do not skip."""
    return [name for name in names(spark, folder) if not name.startswith(("_", "."))]


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if there is one already."""
    system, place = _at(spark, path)
    try:
        out = system.create(place, False)
    except Py4JJavaError as error:
        if "already exists" not in str(error.java_exception):
            raise
        return False
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def partition_path(spark: SparkSession, values: dict[str, object]) -> str:
    """Directories that Spark's writers make for these partition values."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(escape(name, str(value)) for name, value in values.items())
