"""The values of a record: one array of entries, from which fields and unit tags follow.

Both value maps are put into one array in a fixed order (long values by key, then
double values by key). Fields and unit tags are built from that array with "later
wins", so a double value beats a long one of the same cleaned name, and inside one
map the largest original key wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import sanitize

# Fixed value: unit of a raw metric that names none.
NO_UNIT = "unavailable"


def _ordered(values: Column) -> Column:
    return F.sort_array(F.map_entries(values))


def _unit_tag(name: Column) -> Column:
    return F.concat(name, F.lit("_unit"))


def raw_metrics(ivalues: Column, fvalues: Column, units: Column) -> Column:
    """ARRAY<STRUCT<kind, key, name, value, unit_tag, unit>> of a raw record."""

    def entries(values: Column, kind: str) -> Column:
        return F.transform(
            _ordered(values),
            lambda e: F.struct(
                F.lit(kind).alias("kind"),
                e["key"].alias("key"),
                sanitize(e["key"]).alias("name"),
                e["value"].alias("value"),
                _unit_tag(sanitize(e["key"])).alias("unit_tag"),
                F.coalesce(F.try_element_at(units, e["key"]), F.lit(NO_UNIT)).alias("unit"),
            ),
        )

    return F.concat(entries(ivalues.cast("map<string,double>"), "i"), entries(fvalues, "f"))


def raw_fields(metrics: Column) -> Column:
    """MAP name -> value."""
    return F.map_from_arrays(metrics["name"], metrics["value"])


def rollup_metrics(ivalues: Column, fvalues: Column, units: Column) -> Column:
    """ARRAY<STRUCT<kind, key, name, min, mean, max, unit_tag, unit>> of a rollup record.

    A missing unit stays NULL here: such a rollup cannot become a point.
    """

    def entries(values: Column, kind: str) -> Column:
        return F.transform(
            _ordered(values),
            lambda e: F.struct(
                F.lit(kind).alias("kind"),
                e["key"].alias("key"),
                sanitize(e["key"]).alias("name"),
                e["value"]["min"].alias("min"),
                e["value"]["mean"].alias("mean"),
                e["value"]["max"].alias("max"),
                _unit_tag(sanitize(e["key"])).alias("unit_tag"),
                F.try_element_at(units, e["key"]).alias("unit"),
            ),
        )

    doubles = ivalues.cast("map<string,struct<min:double,max:double,mean:double>>")
    return F.concat(entries(doubles, "i"), entries(fvalues, "f"))


def rollup_fields(metrics: Column) -> Column:
    """MAP ``<name>_min|_mean|_max`` -> value."""
    parts = ("min", "mean", "max")

    def named(part: str) -> Column:
        return F.transform(metrics["name"], lambda name: F.concat(name, F.lit(f"_{part}")))

    return F.map_from_arrays(F.concat(*map(named, parts)), F.concat(*(metrics[part] for part in parts)))


def unit_tags(metrics: Column) -> Column:
    """MAP ``<name>_unit`` -> unit. An empty unit sets no tag, so it also replaces none."""

    def as_map(named: Column) -> Column:
        return F.map_from_arrays(named["unit_tag"], named["unit"])

    odd = F.array_contains(metrics["unit"], "") | F.exists(metrics["unit"], F.isnull)
    given = F.filter(metrics, lambda m: m["unit"] != "")
    return F.when(odd, as_map(given)).otherwise(as_map(metrics))
