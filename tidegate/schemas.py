"""Record shapes and the fixed values of the wire formats."""

from __future__ import annotations

# --- Fixed values: enum symbols a raw record may carry ---------------------
ACCOUNT_TYPES = ("UNKNOWN", "CORE", "ENCORE", "RCN")
MONITORING_SYSTEMS = ("MAAS", "UIM", "SALUS", "SCOM", "ZENOSS")

# --- Fixed values: topics and the level each one carries -------------------
RAW_TOPIC = "unified.metrics.json"
RAW_LEVEL = "full"
ROLLUP_LEVELS = ("5m", "20m", "60m", "240m", "1440m")
LEVELS = (RAW_LEVEL, *ROLLUP_LEVELS)
ROLLUP_TOPICS = tuple(f"{RAW_TOPIC}.{level}" for level in ROLLUP_LEVELS)

# --- Fixed values: routes handed out where there is no routing table -------
# level -> (retention policy, duration)
DEFAULT_POLICIES = {
    "full": ("rp_5d", "5d"),
    "5m": ("rp_10d", "10d"),
    "20m": ("rp_20d", "20d"),
    "60m": ("rp_155d", "155d"),
    "240m": ("rp_300d", "300d"),
    "1440m": ("rp_1825d", "1825d"),
}
DEFAULT_PATH = "http://localhost:8086"
DEFAULT_DATABASE = "db_0"

# --- Fixed value: records the consumer takes per poll ----------------------
POLL_RECORDS = 1500

# A message as the broker delivers it.
WIRE = "topic STRING, `partition` INT, `offset` BIGINT, value STRING"

_TEXT_MAP = "MAP<STRING, STRING>"

RAW_FIELDS = {
    "timestamp": "STRING",
    "accountType": "STRING",
    "account": "STRING",
    "device": "STRING",
    "deviceLabel": "STRING",
    "deviceMetadata": _TEXT_MAP,
    "monitoringSystem": "STRING",
    "systemMetadata": _TEXT_MAP,
    "collectionName": "STRING",
    "collectionLabel": "STRING",
    "collectionTarget": "STRING",
    "collectionMetadata": _TEXT_MAP,
    "ivalues": "MAP<STRING, BIGINT>",
    "fvalues": "MAP<STRING, DOUBLE>",
    "svalues": _TEXT_MAP,
    "units": _TEXT_MAP,
}

_LONG_BUCKET = "STRUCT<min: BIGINT, max: BIGINT, mean: BIGINT>"
_DOUBLE_BUCKET = "STRUCT<min: DOUBLE, max: DOUBLE, mean: DOUBLE>"

ROLLUP_FIELDS = {
    "key": "STRING",
    "start": "BIGINT",
    "end": "BIGINT",
    "accountType": "STRING",
    "account": "STRING",
    "device": "STRING",
    "deviceLabel": "STRING",
    "monitoringSystem": "STRING",
    "collectionLabel": "STRING",
    "collectionTarget": "STRING",
    "collectionName": "STRING",
    "units": _TEXT_MAP,
    "collectionMetadata": _TEXT_MAP,
    "systemMetadata": _TEXT_MAP,
    "deviceMetadata": _TEXT_MAP,
    "ivalues": f"MAP<STRING, {_LONG_BUCKET}>",
    "fvalues": f"MAP<STRING, {_DOUBLE_BUCKET}>",
}

# One row per (tenant, measurement, level).
ROUTES = (
    "tenant_id STRING, measurement STRING, rollup_level STRING, path STRING, "
    "database STRING, retention_policy STRING, retention STRING"
)

# Where a message came from; kept on every row from source to sink.
ORIGIN = ("topic", "partition", "offset")

# Identity and metadata columns of one record, raw or rollup.
DIMENSIONS = (
    "accountType",
    "account",
    "device",
    "deviceLabel",
    "deviceMetadata",
    "monitoringSystem",
    "systemMetadata",
    "collectionName",
    "collectionLabel",
    "collectionTarget",
    "collectionMetadata",
)


def ddl(fields: dict[str, str]) -> str:
    """``{"a": "STRING"}`` -> a DDL schema string."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
