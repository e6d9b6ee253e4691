"""Why rows are refused, and how refused rows leave the main flow.

Every check adds to one ``reason`` column and keeps the row. ``split`` then gives
the sound rows and the dead letters; with ``strict`` the reasons that fail a whole
batch in the original stop the job instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import has_no_whitespace

# Reasons that stop the batch under ``strict``.
STRICT_RAW = ("timestamp_whitespace", "no_route")
STRICT_ROLLUP = ("invalid_account_type", "invalid_monitoring_system", "no_route")


def timestamp_gate(timestamp: Column) -> Column:
    return F.when(~has_no_whitespace(timestamp), "timestamp_whitespace")


def mandatory_identity(account_type: Column, monitoring_system: Column) -> Column:
    return F.when(~has_no_whitespace(account_type), "invalid_account_type").when(
        ~has_no_whitespace(monitoring_system), "invalid_monitoring_system"
    )


def _unfit_dimension() -> Column:
    """Identity that cannot be turned into tags (reads the dimension columns)."""
    c = F.col
    missing = (
        c("accountType").isNull()
        | c("account").isNull()
        | c("monitoringSystem").isNull()
        | c("collectionName").isNull()
    )
    return F.when(missing, "null_identity").when(
        (F.coalesce(c("device"), F.lit("")) != "") & c("deviceLabel").isNull(), "null_device_label"
    )


def _all_finite(values: Column) -> Column:
    """True if no number of the array is NULL, infinite or NaN (which sorts above infinity)."""
    return F.forall(values, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))


def raw_reason(metrics: Column, seconds: Column) -> Column:
    """First reason why a decoded raw record is no point."""
    c = F.col
    values = metrics["value"]
    return F.coalesce(
        timestamp_gate(c("timestamp")),
        mandatory_identity(c("accountType"), c("monitoringSystem")),
        _unfit_dimension(),
        F.when(metrics.isNull() | F.exists(values, F.isnull), "null_value"),
        F.when(seconds.isNull(), "unparsable_time"),
        F.when(F.size(metrics) == 0, "no_fields"),
        F.when(~_all_finite(values), "non_finite_field"),
    )


def rollup_reason(metrics: Column) -> Column:
    """First reason why a decoded rollup record is no point."""
    c = F.col
    values = F.concat(metrics["min"], metrics["mean"], metrics["max"])
    return F.coalesce(
        mandatory_identity(c("accountType"), c("monitoringSystem")),
        _unfit_dimension(),
        F.when(metrics.isNull(), "null_values"),
        F.when(F.exists(metrics["unit"], F.isnull), "missing_unit"),
        F.when(
            ~_all_finite(values),
            F.when(F.exists(values, F.isnull), "null_bucket").otherwise("non_finite_field"),
        ),
    )


def split(rows: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(sound rows without the reason column, dead letters)."""
    return (
        rows.where(F.col(reason).isNull()).drop(reason),
        rows.where(F.col(reason).isNotNull()),
    )


def insist(rows: DataFrame, fatal: tuple[str, ...], reason: str = "reason") -> DataFrame:
    """Same rows, but the job stops at the first one refused for a fatal reason."""
    stop = F.raise_error(F.concat(F.lit("batch refused: "), F.col(reason)))
    return rows.withColumn(
        reason, F.when(F.col(reason).isin(*fatal), stop.cast("string")).otherwise(F.col(reason))
    )
