"""Who a record belongs to and what it measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import sanitize_if_spaced


def tenant_id(account_type: Column, account: Column) -> Column:
    return F.concat(account_type, F.lit("-"), sanitize_if_spaced(account))


def measurement_name(monitoring_system: Column, collection_name: Column) -> Column:
    return F.concat(monitoring_system, F.lit("_"), sanitize_if_spaced(collection_name))


def route_key(tenant: Column, measurement: Column) -> Column:
    return F.concat(tenant, F.lit(":"), measurement)
