"""Session settings the pipeline relies on, and where it may put scratch data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Days and ISO times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Tags and fields are merged "later value wins"; Spark's default is to fail.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here assumes."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write or count done within are deleted when it is done.

    Otherwise they stay until the driver's heap is collected next, which a driver with little to do
    puts off: the files of all steps add up. Frames that are computed again make theirs again;
    those of cached frames are not deleted.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the cluster's shared checkpoint folder.

    A machine-local folder is used only where the session names none, as in
    local tests: executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidegate-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
