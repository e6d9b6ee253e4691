"""JSON messages to typed records and back.

Raw records are strict: all sixteen fields, no others, each of its type and each
enum symbol known. Rollup records are lenient: what is missing is NULL, what is
unknown is ignored. A message that does not decode keeps its row, with NULL
columns and a ``reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.settle import settle
from tidegate.schemas import (
    ACCOUNT_TYPES,
    MONITORING_SYSTEMS,
    RAW_FIELDS,
    ROLLUP_FIELDS,
    ddl,
)

# Repeats are possessive: they never backtrack, so the engine loops over a wide map's entries instead of recursing.
_KEY = r"(?:[A-Za-z0-9_]++|`(?:[^`]|``)*+`)"


def _object_of(kind: str) -> str:
    entry = f"{_KEY}: {kind}"
    return rf"OBJECT<(?:{entry}(?:, {entry})*+)?>"


# How Spark names the JSON type each declared type must have been written in.
_JSON_TYPES = {
    "STRING": "STRING",
    "MAP<STRING, STRING>": _object_of("STRING"),
    "MAP<STRING, BIGINT>": _object_of("BIGINT"),
    "MAP<STRING, DOUBLE>": _object_of(r"(?:DOUBLE|BIGINT|DECIMAL\(\d+,\d+\))"),
}

# The type text of a well-formed raw message: its keys in order, each with its type.
# One match finds missing and unknown fields, nulls and wrong types at any depth,
# also a number where text belongs, which a plain ``from_json`` would turn into text.
_RAW_SHAPE = "^OBJECT<" + ", ".join(f"{k}: {_JSON_TYPES[t]}" for k, t in sorted(RAW_FIELDS.items())) + ">$"


def raw_shape_reason(value: Column, shape: Column) -> Column:
    """Why a message is no raw record, NULL if it is one."""
    keys = F.json_object_keys(value)
    expected = F.array(*map(F.lit, RAW_FIELDS))
    return (
        F.when(value.isNull(), "null_payload")
        .when(shape.isNull() | ~shape.startswith("OBJECT<"), "malformed_json")
        .when(shape.rlike(_RAW_SHAPE), F.lit(None))
        .when(F.size(F.array_except(expected, keys)) > 0, "missing_field")
        .when(F.size(F.array_except(keys, expected)) > 0, "unknown_field")
        .otherwise("wrong_type")
    )


def enum_reason(account_type: Column, monitoring_system: Column) -> Column:
    """Why an enum column is refused, NULL if both symbols are known."""
    return F.when(~account_type.isin(*ACCOUNT_TYPES), "unknown_account_type").when(
        ~monitoring_system.isin(*MONITORING_SYSTEMS), "unknown_monitoring_system"
    )


def decode_raw(messages: DataFrame) -> DataFrame:
    """Messages -> all their columns, the sixteen record columns and ``reason``."""
    shape = F.schema_of_variant(F.try_parse_json("value"))
    record = F.from_json("value", ddl(RAW_FIELDS))
    enums = enum_reason(F.col("_r.accountType"), F.col("_r.monitoringSystem"))
    parsed = (
        messages.withColumn("_shape", shape)
        .withColumn("_reason", raw_shape_reason(F.col("value"), F.col("_shape")))
        .withColumn("_r", F.when(F.col("_reason").isNull(), record))
        .withColumn("reason", F.coalesce("_reason", enums))
        .withColumn("_r", F.when(F.col("reason").isNull(), F.col("_r")))
    )
    return settle(parsed, "_r", "reason").select(
        *messages.columns, *(F.col(f"_r.{name}").alias(name) for name in RAW_FIELDS), "reason"
    )


# Whole-number parts of a rollup may be written with a fraction, which is cut off;
# an exact decimal keeps large numbers whole.
_WIDE = "DECIMAL(38, 18)"
_ROLLUP_JSON = {
    **ROLLUP_FIELDS,
    "start": _WIDE,
    "end": _WIDE,
    "ivalues": ROLLUP_FIELDS["ivalues"].replace("BIGINT", _WIDE),
    "_corrupt": "STRING",
}


def decode_rollup(messages: DataFrame) -> DataFrame:
    """Messages -> all their columns, the seventeen rollup columns and ``reason``."""
    parsed = messages.withColumn(
        "_r",
        F.from_json(
            "value",
            ddl(_ROLLUP_JSON),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
        ),
    )
    # A message of the text "null" decodes to a record of NULLs without being corrupt.
    reason = F.when(F.col("value").isNull() | (F.trim("value") == "null"), "null_payload").when(
        F.col("_r").isNull() | F.col("_r._corrupt").isNotNull(), "malformed_json"
    )
    for name in ("start", "end"):
        bound = F.col(f"_r.{name}")
        reason = reason.when(bound.isNotNull() & bound.try_cast("bigint").isNull(), "malformed_json")
    parsed = settle(parsed.withColumn("reason", reason), "_r", "reason")
    columns = {name: F.col(f"_r.{name}") for name in ROLLUP_FIELDS}
    for name in ("start", "end"):
        # Primitive in the record type: absent means zero.
        columns[name] = F.coalesce(columns[name].try_cast("bigint"), F.lit(0).cast("bigint"))
    columns["ivalues"] = columns["ivalues"].try_cast(ROLLUP_FIELDS["ivalues"])
    sound = F.col("reason").isNull()
    return parsed.select(
        *messages.columns,
        *(F.when(sound, column).alias(name) for name, column in columns.items()),
        "reason",
    )


def encode_records(records: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed records -> their messages (every other column is kept)."""
    value = F.to_json(F.struct(*(F.col(f"`{name}`") for name in fields)))
    kept = [name for name in records.columns if name not in fields]
    return records.select(*kept, value.alias("value"))
