"""Tags of a point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import trim_controls, wrap


def _empty() -> Column:
    return F.create_map().cast("map<string,string>")


def _given(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def _quoted(name: str) -> list[Column]:
    return [F.lit(name), wrap(trim_controls(F.col(name)))]


def _metadata(name: str) -> Column:
    return F.coalesce(F.transform_values(name, lambda _, v: wrap(v)), _empty())


def build_tags(tenant: Column, units: Column | None = None) -> Column:
    """Merge identity, metadata and unit tags of one record; later ones win.

    Reads the dimension columns by name. The device label depends on the device
    being given, not on itself. Metadata may replace identity tags. The first
    three tags and the units are plain, all others are quoted. A tag without
    name or value is left out.
    """
    account_type, account = trim_controls(F.col("accountType")), trim_controls(F.col("account"))
    plain = [F.lit("tenantId"), tenant, F.lit("accountType"), account_type, F.lit("account"), account]
    device = [*_quoted("device"), *_quoted("deviceLabel")]
    label, target = _quoted("collectionLabel"), _quoted("collectionTarget")
    has_label, has_target = _given(F.col("collectionLabel")), _given(F.col("collectionTarget"))
    name = _quoted("collectionName")
    parts = [
        F.when(_given(F.col("device")), F.create_map(*plain, *device)).otherwise(F.create_map(*plain)),
        _metadata("deviceMetadata"),
        F.create_map(*_quoted("monitoringSystem")),
        _metadata("systemMetadata"),
        F.when(has_label & has_target, F.create_map(*name, *label, *target))
        .when(has_label, F.create_map(*name, *label))
        .when(has_target, F.create_map(*name, *target))
        .otherwise(F.create_map(*name)),
    ]
    if units is not None:
        parts.append(units)
    merged = F.map_concat(*parts)
    # Only these can be empty: quoted values never are, empty units were left out.
    blank = (account_type == "") | (account == "")
    for metadata in ("deviceMetadata", "systemMetadata"):
        blank = blank | F.coalesce(F.map_contains_key(metadata, ""), F.lit(False))
    return F.when(blank, F.map_filter(merged, lambda k, v: (k != "") & (v != ""))).otherwise(merged)
