"""Where a point is stored and backed up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.times import utc_day


def instance_host(path: Column) -> Column:
    """Host of an instance URL; ``parse_url`` refuses hosts with an underscore."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)"
    return F.regexp_extract(path, pattern, 1)


def backup_location(path: Column, database: Column, policy: Column, seconds: Column) -> Column:
    """``host/database/policy/yyyyMMdd`` with each name URL-encoded."""
    return F.concat_ws(
        "/",
        F.url_encode(instance_host(path)),
        F.url_encode(database),
        F.url_encode(policy),
        utc_day(seconds),
    )


def payload_timestamp(payload: Column) -> Column:
    """Epoch seconds that end a payload, or NULL."""
    return F.regexp_extract(payload, " ([0-9]+)$", 1).try_cast("bigint")


def dml_header(database: Column, policy: Column) -> Column:
    """The three lines a backup file starts with."""
    return F.concat(
        F.lit("# DML\n# CONTEXT-DATABASE: "),
        database,
        F.lit("\n# CONTEXT-RETENTION-POLICY: "),
        policy,
    )
