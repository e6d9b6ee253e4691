"""Compare what was written with what a restore brought back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.routing import is_beyond_retention

_GROUP = ("host", "database", "retention_policy", "measurement")


def reconcile_restore(
    written: DataFrame, restored: DataFrame, as_of: int | None = None
) -> DataFrame:
    """Targets and measurements whose counts differ.

    With ``as_of`` (and a ``retention`` column in ``written``) the rows retention has
    may have removed since are counted as expected losses and not as a difference.
    A positive difference is missing rows, a negative one surplus rows.
    """
    if as_of is None:
        expired = F.lit(False)
    else:
        expired = is_beyond_retention(F.col("ts_s"), F.col("retention"), as_of)
    before = written.groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("written"), F.count_if(expired).alias("expected_loss")
    )
    after = restored.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("restored"))
    zero = F.lit(0).cast("bigint")
    compared = before.join(after, list(_GROUP), "full_outer").select(
        *_GROUP,
        *(F.coalesce(name, zero).alias(name) for name in ("written", "restored", "expected_loss")),
    )
    # Expired rows may be gone or still there; anything beyond that is a difference.
    missing = F.greatest(F.col("written") - F.col("expected_loss") - F.col("restored"), zero)
    surplus = F.greatest(F.col("restored") - F.col("written"), zero)
    difference = missing - surplus
    return compared.withColumn("difference", difference).where(F.col("difference") != 0)
