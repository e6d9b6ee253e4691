"""The same results in SQL, derived from the given tables without any code of the package."""

from __future__ import annotations

# Events as typed raw records, tags and units in columns of their own.
_RAW = r"""
base AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events
),
ident AS (
  SELECT event_id, user_id, ts, event_type, value, k,
    ['CORE','ENCORE','RCN','UNKNOWN'][user_id % 4 + 1] AS "accountType",
    CASE WHEN event_id % 7 = 0 THEN 'acct ' ELSE 'acct:' END || user_id AS account,
    CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(1000 + user_id AS VARCHAR) END AS device,
    CASE WHEN event_id % 17 = 0 THEN '' ELSE 'box-' || user_id END AS "deviceLabel",
    CASE WHEN event_id % 19 = 0 THEN 'linux, x86' END AS os,
    ['MAAS','UIM','SALUS','SCOM','ZENOSS'][event_id % 5 + 1] AS "monitoringSystem",
    'check-' || user_id AS check_id,
    CASE WHEN event_id % 23 = 0 THEN 'override' END AS tenant_override,
    CASE WHEN event_id % 43 = 0 THEN 'agent ' ELSE 'agent.' END || event_type AS "collectionName"
  FROM base
),
named AS (
  SELECT *,
    "accountType" || '-' || CASE WHEN contains(account, ' ')
      THEN translate(account, '\:^${}[]().*+?|<>-&% ', repeat('_', 21)) ELSE account END AS tenant_id,
    "monitoringSystem" || '_' || CASE WHEN contains("collectionName", ' ')
      THEN translate("collectionName", '\:^${}[]().*+?|<>-&% ', repeat('_', 21)) ELSE "collectionName" END AS measurement
  FROM ident
),
raw AS (
  SELECT *, 'unified.metrics.json' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
    CASE WHEN event_id % 97 = 0 THEN 'not-a-time'
         WHEN event_id % 101 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%fZ')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "timestamp",
    event_id % 13 <> 0 AS has_values
  FROM named
),
timed AS (
  SELECT *, CAST(floor(epoch(try_strptime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ'))) AS BIGINT) AS ts_s FROM raw
)"""

# Tags of a record of ``named`` in key order, as a list item per tag. {e} marks the
# text function of keys and values, {units} the unit tags before and after.
_TAG_ITEMS = [
    ("account", "account"),
    ("accountType", '"accountType"'),
    ("checkId", "'\"' || check_id || '\"'"),
    ("collectionLabel", "'\"sampled\"'"),
    ("collectionName", "'\"' || \"collectionName\" || '\"'"),
    ("device", "CASE WHEN device <> '' THEN '\"' || device || '\"' END"),
    ("deviceLabel", "CASE WHEN device <> '' THEN '\"' || \"deviceLabel\" || '\"' END"),
    ("event_value_unit", "value_unit"),
    ("monitoringSystem", "'\"' || \"monitoringSystem\" || '\"'"),
    ("monitoringZone", "'\"\"'"),
    ("os", "'\"' || os || '\"'"),
    ("props_k_unit", "k_unit"),
    ("tenantId", "coalesce('\"' || tenant_override || '\"', tenant_id)"),
]


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, ' ', '\\ '), ',', '\\,'), '=', '\\=')"


def _tags(separator: str, escape: bool, units: bool = True) -> str:
    items = [
        f"'{key}=' || ({_escaped(text) if escape else text})"
        for key, text in _TAG_ITEMS
        if units or not key.endswith("_unit")
    ]
    return f"concat_ws('{separator}', {', '.join(items)})"


_POINTS = (
    _RAW
    + f""",
units AS (
  SELECT *, CASE WHEN has_values THEN 'USD' END AS value_unit,
    CASE WHEN has_values THEN 'unavailable' END AS k_unit,
    CASE WHEN regexp_matches("timestamp", '\\s') THEN 'timestamp_whitespace'
         WHEN ts_s IS NULL THEN 'unparsable_time'
         WHEN NOT has_values THEN 'no_fields' END AS reason,
    CAST(value AS VARCHAR) AS value_text,
    CAST(CASE WHEN event_id % 29 = 0 THEN value ELSE CAST(k AS DOUBLE) END AS VARCHAR) AS k_text
  FROM timed
),
points AS (
  SELECT *, 'full' AS level,
    CASE WHEN reason IS NULL THEN {_escaped('measurement')} || ',' || {_tags(',', True)}
      || ' event_value=' || value_text || ',props_k=' || k_text || ' ' || ts_s END AS line
  FROM units
),
good AS (SELECT * FROM points WHERE reason IS NULL)"""
)

_ROUTES = """
keys AS (SELECT DISTINCT tenant_id, measurement, user_id FROM named),
levels(rank, rollup_level, retention_policy, retention) AS (VALUES
  (0, 'full', 'rp_5d', '5d'), (1, '5m', 'rp_10d', '10d'), (2, '20m', 'rp_20d', '20d'),
  (3, '60m', 'rp_155d', '155d'), (4, '240m', 'rp_300d', '300d'), (5, '1440m', 'rp_1825d', '1825d')),
routes AS (
  SELECT tenant_id, measurement, rank, rollup_level, retention_policy, retention,
    'http://store-' || (user_id % 10 % 3) || ':8086' AS path,
    'store-' || (user_id % 10 % 3) AS host, 'db_' || (user_id % 10) AS "database"
  FROM keys, levels
  WHERE user_id % 13 <> 12 AND (user_id % 11 <> 10 OR rollup_level <> 'full')
)"""

_ROUTED = (
    _POINTS
    + ","
    + _ROUTES
    + """,
routed AS (
  SELECT g.*, r.path, r.host, r."database", r.retention_policy, r.retention,
    strftime(to_timestamp(ts_s) AT TIME ZONE 'UTC', '%Y%m%d') AS "day"
  FROM good g JOIN routes r USING (tenant_id, measurement) WHERE r.rollup_level = g.level
)"""
)

# Rollup records; identity as for the first event of each window.
_ROLLUP = (
    _RAW
    + """,
windows AS (
  SELECT minutes, s - s % (minutes * 60) AS start_s, user_id, event_type, min(event_id) AS first_id,
    min(k) AS k_min, max(k) AS k_max, CAST(sum(k) // count(*) AS BIGINT) AS k_mean,
    min(cents) AS c_min, max(cents) AS c_max, CAST(sum(cents) // count(*) AS BIGINT) AS c_mean
  FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(round(value * 100) AS BIGINT) AS cents FROM base),
    (VALUES (5), (20), (60), (240), (1440)) AS m(minutes)
  GROUP BY ALL
),
rollups AS (
  SELECT n.*, minutes || 'm' AS level, 'unified.metrics.json.' || minutes || 'm' AS topic,
    CAST(n.user_id % 4 AS INTEGER) AS "partition", n.event_id AS "offset",
    start_s, start_s + minutes * 60 AS end_s, k_min, k_max, k_mean,
    c_min / 100.0 AS v_min, c_max / 100.0 AS v_max, c_mean / 100.0 AS v_mean,
    'count' AS k_unit, CASE WHEN n.user_id % 31 <> 0 THEN 'USD' END AS value_unit
  FROM windows w JOIN named n ON n.event_id = w.first_id
)"""
)


def _double(text: str) -> str:
    return f"CAST(CAST({text} AS DOUBLE) AS VARCHAR)"


_ROLLUP_VALUES = [
    ("event_value_max", "v_max"),
    ("event_value_mean", "v_mean"),
    ("event_value_min", "v_min"),
    ("props_k_max", "k_max"),
    ("props_k_mean", "k_mean"),
    ("props_k_min", "k_min"),
]


def _rollup_doubles(separator: str) -> str:
    return f" || '{separator}' || ".join(f"'{name}=' || {_double(column)}" for name, column in _ROLLUP_VALUES)


_ROLLUP_POINTS = (
    _ROLLUP
    + f""",
rpoints AS (
  SELECT *, CASE WHEN value_unit IS NULL THEN 'missing_unit' END AS reason,
    CASE WHEN value_unit IS NOT NULL THEN {_escaped('measurement')} || ',' || {_tags(',', True)}
      || ' end=' || end_s || 'i,' || {_rollup_doubles(',')} || ',start=' || start_s || 'i' END AS line
  FROM rollups
),
rgood AS (SELECT * FROM rpoints WHERE reason IS NULL)"""
)

_ORIGIN = 'topic, "partition", "offset"'

# Why a raw message of the wire fixture does not decode.
_WIRE_REASON = """CASE
    WHEN event_id % 211 = 5 THEN 'null_payload'
    WHEN event_id % 223 = 5 THEN 'malformed_json'
    WHEN event_id % 227 = 5 THEN 'missing_field'
    WHEN event_id % 229 = 5 THEN 'unknown_field'
    WHEN event_id % 233 = 5 THEN 'unknown_account_type'
    WHEN event_id % 239 = 5 THEN 'wrong_type'
    WHEN event_id % 241 = 5 THEN 'wrong_type' END"""

_ROLLUP_WIRE_REASON = """CASE
    WHEN event_id % 211 = 5 THEN 'null_payload'
    WHEN event_id % 223 = 5 THEN 'malformed_json' END"""

# Messages of the raw stream after decoding, checking and routing.
_STREAM = (
    _ROUTED
    + f""",
decoded AS (SELECT *, {_WIRE_REASON} AS wire_reason FROM points),
keyed AS (SELECT DISTINCT tenant_id, measurement FROM routes),
judged AS (
  SELECT d.*, r.path, r.host, r."database", r.retention_policy, r.retention,
    CASE WHEN ts_s IS NOT NULL THEN strftime(to_timestamp(ts_s) AT TIME ZONE 'UTC', '%Y%m%d') END AS "day",
    coalesce(wire_reason, reason,
      CASE WHEN q.tenant_id IS NULL THEN 'no_route' WHEN r.path IS NULL THEN 'no_level' END) AS verdict
  FROM decoded d
  LEFT JOIN keyed q ON d.tenant_id = q.tenant_id AND d.measurement = q.measurement
  LEFT JOIN routes r ON d.tenant_id = r.tenant_id AND d.measurement = r.measurement AND r.rollup_level = 'full'
),
stored AS (SELECT * FROM judged WHERE verdict IS NULL)"""
)

_ROLLUP_STREAM = (
    _ROLLUP_POINTS
    + ","
    + _ROUTES
    + f""",
rkeyed AS (SELECT DISTINCT tenant_id, measurement FROM routes),
rjudged AS (
  SELECT p.*, r.path, r.host, r."database", r.retention_policy,
    coalesce({_ROLLUP_WIRE_REASON}, p.reason,
      CASE WHEN q.tenant_id IS NULL THEN 'no_route' WHEN r.path IS NULL THEN 'no_level' END) AS verdict
  FROM rpoints p
  LEFT JOIN rkeyed q ON p.tenant_id = q.tenant_id AND p.measurement = q.measurement
  LEFT JOIN routes r ON p.tenant_id = r.tenant_id AND p.measurement = r.measurement AND r.rollup_level = p.level
)"""
)

_PAYLOAD = """topic, "partition", "offset" // 1500 AS poll, tenant_id, measurement"""

_STORED_COUNTS = """SELECT host, "database", retention_policy, level,
  count(*) AS points, count(DISTINCT "day") AS days FROM {rows} GROUP BY ALL"""

_EXISTING = """
databases AS (SELECT DISTINCT path, "database" FROM routes WHERE CAST("database"[4:] AS INTEGER) <= 6),
policies AS (SELECT path, "database", p AS retention_policy FROM databases, (VALUES ('rp_5d'), ('rp_10d')) AS v(p)
  WHERE CAST("database"[4:] AS INTEGER) % 2 = 0)"""


def _plan(source: str, existing: str) -> str:
    return f"""{existing},
wanted AS (SELECT path, "database", retention_policy, min(rank) AS rank, min(retention) AS retention
  FROM {source} GROUP BY ALL),
placed AS (
  SELECT w.*, d.path IS NOT NULL AS known,
    row_number() OVER (PARTITION BY w.path, w."database" ORDER BY rank) AS nth
  FROM wanted w LEFT JOIN databases d ON w.path = d.path AND w."database" = d."database"),
steps AS (
  SELECT path, "database", retention_policy,
    CASE WHEN NOT known AND nth = 1
      THEN 'CREATE DATABASE "' || "database" || '" WITH DURATION ' || retention || ' NAME "' || retention_policy || '"'
      ELSE 'CREATE RETENTION POLICY "' || retention_policy || '" ON "' || "database" || '" DURATION ' || retention
        || ' REPLICATION 1' || CASE WHEN rank = 0 THEN ' DEFAULT' ELSE '' END END AS statement,
    CAST(CASE WHEN NOT known AND nth = 1 THEN 0 ELSE rank + 1 END AS INTEGER) AS step
  FROM placed l
  WHERE NOT EXISTS (SELECT 1 FROM policies p WHERE p.path = l.path AND p."database" = l."database"
    AND p.retention_policy = l.retention_policy))"""


_NONE_EXISTING = """
databases AS (SELECT path, "database" FROM routes WHERE false),
policies AS (SELECT path, "database", retention_policy FROM routes WHERE false)"""

_WHITESPACE = r"'[\t-\r\x1c-\x20]'"


def _raw_json() -> str:
    values = """CASE WHEN NOT has_values THEN '{}'
      WHEN event_id % 29 = 0 THEN '{"event.value":' || value || ',"props_k":' || value || '}'
      ELSE '{"event.value":' || value || '}' END"""
    parts = [
        """'{"timestamp":"' || "timestamp" || '","accountType":"' || "accountType" || '","account":"' || account""",
        """'","device":"' || device || '","deviceLabel":"' || "deviceLabel" || '","deviceMetadata":'""",
        """CASE WHEN os IS NULL THEN '{}' ELSE '{"os":"' || os || '"}' END""",
        """',"monitoringSystem":"' || "monitoringSystem" || '","systemMetadata":{"checkId":"' || check_id""",
        """'","monitoringZone":""' || CASE WHEN tenant_override IS NULL THEN '' ELSE ',"tenantId":"override"' END""",
        """'},"collectionName":"' || "collectionName" || '","collectionLabel":"sampled"'""",
        """',"collectionTarget":"","collectionMetadata":{"product":"demo"},"ivalues":'""",
        """CASE WHEN has_values THEN '{"props.k":' || k || '}' ELSE '{}' END""",
        f"""',"fvalues":' || {values}""",
        """',"svalues":{},"units":{"event.value":"USD"}}'""",
    ]
    return " || ".join(parts)


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _null_if_broken(*columns: str) -> str:
    return ", ".join(f"CASE WHEN why IS NULL THEN {c} END AS {alias}" for c, alias in (
        (c if isinstance(c, tuple) else (f'"{c}"', f'"{c}"')) for c in columns
    ))


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # --- sources, sinks, decoding
    o["read_raw_stream_rows"] = _select(_RAW, f"SELECT {_ORIGIN}, event_id % 211 = 5 AS no_payload FROM raw")
    o["read_rollup_streams_rows"] = _select(_ROLLUP, f"SELECT {_ORIGIN}, level FROM rollups")
    o["topic_to_level"] = _select(
        _ROLLUP,
        """SELECT topic, 'full' AS level, count(*) AS messages FROM raw GROUP BY ALL
        UNION ALL SELECT topic, level, count(*) FROM rollups GROUP BY ALL""",
    )
    o["decode_raw_records"] = _select(
        f"{_RAW}, checked AS (SELECT *, {_WIRE_REASON} AS why FROM raw)",
        f"""SELECT {_ORIGIN}, {_null_if_broken(
            "timestamp", "accountType", "account", "device", "deviceLabel", "monitoringSystem", "collectionName",
            ("'sampled'", '"collectionLabel"'), ("''", '"collectionTarget"'),
            ("coalesce('os=' || os, '')", '"deviceMetadata"'),
            ("'checkId=' || check_id || '|monitoringZone=' || CASE WHEN tenant_override IS NULL THEN '' ELSE '|tenantId=override' END", '"systemMetadata"'),
            ("'product=demo'", '"collectionMetadata"'),
            ("CASE WHEN has_values THEN 'props.k=' || k ELSE '' END", "ivalues"),
            ("CASE WHEN NOT has_values THEN '' ELSE 'event.value=' || value || CASE WHEN event_id % 29 = 0 THEN '|props_k=' || value ELSE '' END END", "fvalues"),
            ("''", "svalues"), ("'event.value=USD'", "units"),
        )}, why AS reason FROM checked""",
    )
    o["decode_rollup_records"] = _select(
        f"{_ROLLUP}, checked AS (SELECT *, {_ROLLUP_WIRE_REASON} AS why, event_id % 227 = 5 AS bare FROM rollups)",
        f"""SELECT {_ORIGIN}, {_null_if_broken(
            ("CASE WHEN NOT bare THEN 'rollup-' || event_id END", '"key"'),
            ("CASE WHEN bare THEN 0 ELSE start_s END", "start_s"), ("end_s", "end_s"),
            "accountType", "account", "device", "deviceLabel", "monitoringSystem", "collectionName",
            ("'sampled'", '"collectionLabel"'), ("''", '"collectionTarget"'),
            ("coalesce('os=' || os, '')", '"deviceMetadata"'),
            ("'checkId=' || check_id || '|monitoringZone=' || CASE WHEN tenant_override IS NULL THEN '' ELSE '|tenantId=override' END", '"systemMetadata"'),
            ("'product=demo'", '"collectionMetadata"'), ("'props.k'", "ivalues_keys"), ("'event.value'", "fvalues_keys"),
            ("concat_ws('|', 'event.value=' || value_unit, 'props.k=count')", "units"),
            "k_min", "k_max", "k_mean", ("CAST(v_min AS DOUBLE)", "v_min"),
            ("CAST(v_max AS DOUBLE)", "v_max"), ("CAST(v_mean AS DOUBLE)", "v_mean"),
        )}, why AS reason FROM checked""",
    )
    o["encode_records_json"] = _select(_RAW, f"SELECT {_ORIGIN}, {_raw_json()} AS value FROM raw")
    o["write_points"] = _select(
        _ROUTED,
        """SELECT host, "database", retention_policy, "day", count(*) AS points, min(ts_s) AS first_s,
        max(ts_s) AS last_s, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM routed GROUP BY ALL""",
    )
    o["write_backup"] = _select(
        _ROUTED,
        """SELECT host, "database", retention_policy, "day", count(*) AS lines, CAST(0 AS BIGINT) AS bare_files
        FROM routed GROUP BY ALL""",
    )
    o["read_backup"] = _select(
        _ROUTED, 'SELECT host, "database", retention_policy, "day", line, ts_s FROM routed'
    )
    o["backup_header_check"] = _select(
        _ROUTED, """SELECT host, "database", retention_policy, "day", '' AS header FROM routed WHERE false"""
    )
    o["write_ops_metrics_lines"] = _select(
        f"""{_STREAM},
stats AS (SELECT {_PAYLOAD}, count(*) AS n, CAST(sum(strlen(line)) + count(*) - 1 AS BIGINT) AS b
  FROM stored GROUP BY ALL)""",
        """SELECT 'source' AS scope, 'ingested_data_count,topic=' || topic || ',partitionid=' || "partition"
          || ',monitoringsystem=' || "monitoringSystem" || ' count=' || count(*) AS line
        FROM decoded WHERE wire_reason IS NULL GROUP BY topic, "partition", "monitoringSystem"
        UNION ALL SELECT 'payload', 'ingestion_payload,listener=raw,hostname=localhost payloadrecordscount=' || n
          || ',payloadsize=' || b FROM stats
        UNION ALL SELECT 'batch', 'ingestion_payload,listener=raw,hostname=localhost payloadrecordscount=' || CAST(sum(n) AS BIGINT)
          || ',payloadsize=' || CAST(sum(b) AS BIGINT) FROM stats
        UNION ALL SELECT 'batch', 'ingestion_records_count,listener=raw,hostname=localhost count=' || count(*) FROM decoded""",
    )

    # --- filters and quarantine
    valid = ", ".join(
        f'NOT regexp_matches("{c}", {_WHITESPACE}) AS "{c}_valid"'
        for c in ("timestamp", "account", "device", "collectionName")
    )
    o["is_valid_no_whitespace"] = _select(_RAW, f"SELECT {_ORIGIN}, {valid} FROM raw")
    o["timestamp_gate"] = _select(
        _RAW,
        f"""SELECT {_ORIGIN}, "timestamp", 'timestamp_whitespace' AS reason FROM raw
        WHERE regexp_matches("timestamp", {_WHITESPACE})""",
    )
    o["enum_domain_check"] = _select(
        f"""{_RAW}, odd AS (SELECT {_ORIGIN},
  CASE WHEN event_type = 'signup' THEN lower("accountType") ELSE "accountType" END AS "accountType",
  CASE WHEN device = '' THEN 'OTHER' ELSE "monitoringSystem" END AS "monitoringSystem" FROM raw)""",
        """SELECT *, CASE WHEN "accountType" NOT IN ('UNKNOWN','CORE','ENCORE','RCN') THEN 'unknown_account_type'
          WHEN "monitoringSystem" NOT IN ('MAAS','UIM','SALUS','SCOM','ZENOSS') THEN 'unknown_monitoring_system'
          END AS reason FROM odd""",
    )
    o["mandatory_identity"] = _select(
        f"""{_RAW}, odd AS (SELECT {_ORIGIN},
  CASE WHEN device = '' THEN "accountType" || ' x' ELSE "accountType" END AS "accountType",
  CASE WHEN "deviceLabel" = '' THEN "monitoringSystem" || chr(9) ELSE "monitoringSystem" END AS "monitoringSystem" FROM raw)""",
        f"""SELECT *, CASE WHEN regexp_matches("accountType", {_WHITESPACE}) THEN 'invalid_account_type'
          WHEN regexp_matches("monitoringSystem", {_WHITESPACE}) THEN 'invalid_monitoring_system' END AS reason FROM odd""",
    )
    o["convertible_filter"] = _select(_POINTS, f"SELECT {_ORIGIN}, reason FROM points")
    o["convertible_filter_rollup"] = _select(_ROLLUP_POINTS, f"SELECT {_ORIGIN}, reason FROM rpoints")
    o["beyond_retention"] = _select(
        _ROUTED, f"SELECT {_ORIGIN}, retention_policy, ts_s, ts_s < 1706659200 - 5 * 86400 AS refused FROM routed"
    )
    o["payload_guards"] = """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'blank_payload'
        WHEN event_id % 7 = 0 THEN 'blank_database' WHEN event_id % 11 = 0 THEN 'blank_retention_policy'
        WHEN event_id % 3 = 0 THEN 'blank_host' END AS reason FROM events"""
    o["backup_time_required"] = _select(
        _POINTS, f"""SELECT {_ORIGIN}, CASE WHEN event_id % 3 = 0 THEN 'no_timestamp' END AS reason FROM good"""
    )

    # --- projections
    clean = r"translate({c}, '\:^${{}}[]().*+?|<>-&% ', repeat('_', 21)) AS {c}"
    o["sanitize_special_chars"] = f"SELECT page_id, {clean.format(c='url')}, {clean.format(c='html')} FROM pages"
    o["tenant_id"] = _select(_RAW, f"SELECT {_ORIGIN}, tenant_id FROM raw")
    o["measurement_name"] = _select(_RAW, f"SELECT {_ORIGIN}, measurement FROM raw")
    o["ingest_overview"] = _select(
        _RAW,
        """SELECT tenant_id, measurement, count(*) AS records, min(ts_s) AS first_s, max(ts_s) AS last_s
        FROM timed GROUP BY ALL""",
    )
    dims = f"""SELECT {_ORIGIN}, "accountType", account, device, "deviceLabel", coalesce('os=' || os, '') AS "deviceMetadata",
        "monitoringSystem", 'checkId=' || check_id || '|monitoringZone='
          || CASE WHEN tenant_override IS NULL THEN '' ELSE '|tenantId=override' END AS "systemMetadata",
        "collectionName", 'sampled' AS "collectionLabel", '' AS "collectionTarget",
        'product=demo' AS "collectionMetadata" FROM """
    o["dimensions_raw"] = _select(_RAW, dims + "raw")
    o["dimensions_rollup"] = _select(_ROLLUP, dims + "rollups")
    o["java_trim"] = r"""SELECT doc_id,
        regexp_replace(regexp_replace(text, '^[\x00-\x20]+', ''), '[\x00-\x20]+\z', '') AS trimmed FROM documents"""
    o["wrap_tag_value"] = _select(
        _RAW, f"""SELECT {_ORIGIN}, '"' || CASE WHEN device = '' THEN 'null' ELSE device END || '"' AS wrapped FROM raw"""
    )
    o["build_tags"] = _select(_RAW, f"SELECT {_ORIGIN}, {_tags('|', False, units=False)} AS tags FROM raw")
    o["raw_fields"] = _select(
        _POINTS,
        f"""SELECT {_ORIGIN}, CASE WHEN has_values THEN 'event_value=' || value_text || '|props_k=' || k_text ELSE '' END
        AS fields FROM points""",
    )
    o["raw_unit_tags"] = _select(
        _POINTS,
        f"""SELECT {_ORIGIN}, concat_ws('|', 'event_value_unit=' || value_unit, 'props_k_unit=' || k_unit) AS units
        FROM points""",
    )
    o["rollup_fields"] = _select(
        _ROLLUP_POINTS,
        f"""SELECT {_ORIGIN}, {_rollup_doubles('|')} AS fields, 'end=' || end_s || '|start=' || start_s AS int_fields
        FROM rgood""",
    )
    o["rollup_unit_tags"] = _select(
        _ROLLUP,
        f"""SELECT {_ORIGIN}, concat_ws('|', 'event_value_unit=' || value_unit, 'props_k_unit=' || k_unit) AS units
        FROM rollups""",
    )
    o["event_time_seconds"] = _select(_RAW, f"SELECT {_ORIGIN}, ts_s FROM timed")
    o["encode_line_protocol"] = _select(_POINTS, f"SELECT {_ORIGIN}, tenant_id, measurement, line FROM good")
    o["encode_line_protocol_rollup"] = _select(
        _ROLLUP_POINTS, f"SELECT {_ORIGIN}, tenant_id, measurement, line FROM rgood"
    )
    o["parse_line_protocol"] = _select(
        _POINTS + "," + _ROLLUP_POINTS[len(_RAW) + 1 :],
        f"""SELECT {_ORIGIN}, measurement, {_tags('|', False)} AS tags,
          'event_value=' || value_text || '|props_k=' || k_text AS fields, '' AS int_fields, ts_s FROM good
        UNION ALL SELECT {_ORIGIN}, measurement, {_tags('|', False)}, {_rollup_doubles('|')},
          'end=' || end_s || '|start=' || start_s, NULL FROM rgood""",
    )
    o["points_long_raw"] = _select(
        _RAW,
        f"""SELECT {_ORIGIN}, tenant_id, measurement, 'i' AS kind, 'props.k' AS "key", 'props_k' AS name,
          CAST(k AS DOUBLE) AS value, 'unavailable' AS unit FROM raw WHERE has_values
        UNION ALL SELECT {_ORIGIN}, tenant_id, measurement, 'f', 'event.value', 'event_value', value, 'USD'
          FROM raw WHERE has_values
        UNION ALL SELECT {_ORIGIN}, tenant_id, measurement, 'f', 'props_k', 'props_k', value, 'unavailable'
          FROM raw WHERE has_values AND event_id % 29 = 0""",
    )
    o["points_long_rollup"] = _select(
        _ROLLUP,
        f"""SELECT {_ORIGIN}, tenant_id, measurement, 'i' AS kind, 'props.k' AS "key", 'props_k' AS name,
          CAST(k_min AS DOUBLE) AS v_min, CAST(k_mean AS DOUBLE) AS v_mean, CAST(k_max AS DOUBLE) AS v_max, k_unit AS unit
        FROM rollups UNION ALL SELECT {_ORIGIN}, tenant_id, measurement, 'f', 'event.value', 'event_value',
          CAST(v_min AS DOUBLE), CAST(v_mean AS DOUBLE), CAST(v_max AS DOUBLE), value_unit FROM rollups""",
    )
    o["backup_location"] = _select(
        _ROUTED,
        f"""SELECT {_ORIGIN}, host || '/' || "database" || '/' || retention_policy || '/' || "day" AS location FROM routed""",
    )
    o["payload_timestamp"] = _select(
        _POINTS, f"SELECT {_ORIGIN}, CASE WHEN event_id % 3 <> 0 THEN ts_s END AS ts_s FROM good"
    )
    o["dml_header"] = _select(
        _RAW + "," + _ROUTES,
        """SELECT DISTINCT "database", retention_policy, '# DML' || chr(10) || '# CONTEXT-DATABASE: ' || "database"
        || chr(10) || '# CONTEXT-RETENTION-POLICY: ' || retention_policy AS header FROM routes""",
    )
    o["route_key"] = _select(_RAW, f"SELECT {_ORIGIN}, tenant_id || ':' || measurement AS route_key FROM raw")
    o["retention_seconds"] = """SELECT event_id,
        event_id * [1, 60, 3600, 86400, 604800, NULL][event_id % 6 + 1] AS seconds FROM events"""

    # --- joins
    o["route_lookup"] = _select(
        _ROUTED, f'SELECT {_ORIGIN}, tenant_id, measurement, path, "database", retention_policy FROM routed'
    )
    o["route_lookup_prepared"] = o["route_lookup"]
    o["route_lookup_rollup"] = _select(
        _ROLLUP_POINTS + "," + _ROUTES,
        f"""SELECT {_ORIGIN}, p.level, r.path, r."database", r.retention_policy,
          CASE WHEN k.tenant_id IS NULL THEN 'no_route' WHEN r.path IS NULL THEN 'no_level' END AS route_reason
        FROM rgood p
        LEFT JOIN (SELECT DISTINCT tenant_id, measurement FROM routes) k
          ON p.tenant_id = k.tenant_id AND p.measurement = k.measurement
        LEFT JOIN routes r ON p.tenant_id = r.tenant_id AND p.measurement = r.measurement AND p.level = r.rollup_level""",
    )
    o["unrouted_level"] = _select(
        _ROUTED,
        f"""SELECT {_ORIGIN}, level, tenant_id, measurement FROM good
        JOIN (SELECT tenant_id, measurement, list(rollup_level) AS known FROM routes GROUP BY ALL) k USING (tenant_id, measurement)
        WHERE NOT list_contains(known, level)""",
    )
    o["route_not_found"] = _select(
        _ROUTED,
        f"""SELECT {_ORIGIN}, level, tenant_id, measurement FROM good g
        WHERE NOT EXISTS (SELECT 1 FROM routes r WHERE r.tenant_id = g.tenant_id AND r.measurement = g.measurement)""",
    )
    o["default_routes"] = _select(
        _ROUTED,
        """SELECT DISTINCT tenant_id, measurement, tenant_id || ':' || measurement AS route_key, l.rollup_level,
        'http://localhost:8086' AS path, 'db_0' AS "database", l.retention_policy, l.retention FROM good, levels l""",
    )
    o["provisioning_plan"] = _select(_RAW + "," + _ROUTES + "," + _plan("routes", _EXISTING), "SELECT * FROM steps")
    o["reconcile_restore"] = _select(
        f"""{_ROUTED},
marked AS (SELECT *, ts_s < 1706659200 - 5 * 86400 AS expired, "database" = 'db_3' AND "day" = '20240129' AS lost FROM routed),
counted AS (SELECT host, "database", retention_policy, measurement, count(*) AS written,
  count(*) FILTER (WHERE NOT expired AND NOT lost) AS restored, count(*) FILTER (WHERE expired) AS expected_loss
  FROM marked GROUP BY ALL)""",
        """SELECT *, written - expected_loss - restored AS difference FROM counted
        WHERE written - expected_loss - restored <> 0""",
    )

    # --- payloads and counts
    payload = f"""SELECT {_PAYLOAD}, string_agg(line, chr(10) ORDER BY "offset") AS payload FROM {{rows}} GROUP BY ALL"""
    o["tenant_payloads"] = _select(_POINTS, payload.format(rows="good"))
    o["tenant_payloads_rollup"] = _select(_ROLLUP_POINTS, payload.format(rows="rgood"))
    o["payload_stats"] = _select(
        _POINTS,
        f"""SELECT {_PAYLOAD}, count(*) AS payload_records,
        CAST(sum(strlen(line)) + count(*) - 1 AS BIGINT) AS payload_bytes FROM good GROUP BY ALL""",
    )
    o["ingested_data_count"] = _select(
        _RAW,
        """SELECT topic, "partition", "monitoringSystem" AS monitoring_system, count(*) AS records FROM raw GROUP BY ALL""",
    )
    o["ingestion_records_count"] = _select(
        _RAW, """SELECT topic, "partition", "offset" // 1500 AS poll, count(*) AS records FROM raw GROUP BY ALL"""
    )
    o["ops_metric_lines"] = _select(
        f"""{_POINTS}, stats AS (SELECT {_PAYLOAD}, count(*) AS n,
  CAST(sum(strlen(line)) + count(*) - 1 AS BIGINT) AS b FROM good GROUP BY ALL)""",
        """SELECT 'ingested_data_count,topic=' || topic || ',partitionid=' || "partition" || ',monitoringsystem='
          || "monitoringSystem" || ' count=' || count(*) AS line
        FROM raw GROUP BY topic, "partition", "monitoringSystem"
        UNION ALL SELECT 'ingestion_records_count,listener=raw,hostname=localhost count=' || count(*) FROM raw
        UNION ALL SELECT 'ingestion_payload,listener=raw,hostname=localhost payloadrecordscount=' || n
          || ',payloadsize=' || b FROM stats""",
    )
    o["unconverted_count"] = _select(
        _POINTS + "," + _ROLLUP_POINTS[len(_RAW) + 1 :],
        """SELECT count(*) FILTER (WHERE reason IS NOT NULL) AS unconverted, count(*) AS received
        FROM (SELECT reason FROM points UNION ALL SELECT reason FROM rpoints)""",
    )
    o["replay_offsets"] = _select(
        _ROLLUP,
        """SELECT topic, "partition", min("offset") AS "offset" FROM (
          SELECT topic, "partition", "offset" FROM raw UNION ALL SELECT topic, "partition", "offset" FROM rollups)
        GROUP BY ALL""",
    )
    o["backup_manifest"] = _select(
        _ROUTED, """SELECT host, "database", retention_policy, "day", count(*) AS lines FROM routed GROUP BY ALL"""
    )
    o["payload_backup_day"] = _select(
        _POINTS,
        f"""SELECT {_PAYLOAD}, strftime(to_timestamp(arg_max(ts_s, "offset")) AT TIME ZONE 'UTC', '%Y%m%d') AS "day"
        FROM good GROUP BY ALL""",
    )
    o["rollup_fan_in"] = _select(
        _ROLLUP, """SELECT level, "accountType", count(*) AS records FROM rollups GROUP BY ALL"""
    )
    o["first_seen_keys"] = _select(
        _POINTS,
        """SELECT tenant_id, measurement FROM good GROUP BY ALL HAVING min(ts_s) >= 1705276800""",
    )

    # --- streams
    stored = _select(_STREAM, _STORED_COUNTS.format(rows="stored"))
    for name in ("raw_ingest", "commit_after_write", "replay_failed_batch", "compact_points"):
        o[name] = stored
    o["replay_after_route_change"] = f"""SELECT * REPLACE ("database" || '_moved' AS "database") FROM ({stored})"""
    o["rollup_ingest"] = _select(
        _ROLLUP_STREAM,
        """SELECT host, "database", retention_policy, level, count(*) AS points, CAST(1 AS BIGINT) AS days
        FROM rjudged WHERE verdict IS NULL GROUP BY ALL""",
    )
    o["payload_failure_policy"] = _select(
        _STREAM,
        """SELECT 'ingest' AS stage, coalesce(verdict, 'beyond_retention') AS reason, count(*) AS records FROM judged
        WHERE verdict IS NOT NULL OR ts_s < 1706659200 - 5 * 86400 GROUP BY ALL""",
    )
    o["rollup_dead_letters"] = _select(
        _ROLLUP_STREAM,
        """SELECT CASE WHEN verdict IS NULL THEN 'backup' ELSE 'ingest' END AS stage,
        coalesce(verdict, 'no_timestamp') AS reason, count(*) AS records FROM rjudged GROUP BY ALL""",
    )
    o["fetch_limits"] = _select(
        _STREAM, "SELECT CAST(2 AS BIGINT) AS batches, count(*) AS points FROM stored"
    )
    o["provisioning_stream"] = _select(
        f"""{_STREAM},
seen AS (SELECT r.* FROM routes r WHERE EXISTS (SELECT 1 FROM stored s
  WHERE s.tenant_id = r.tenant_id AND s.measurement = r.measurement)),"""
        + _plan("seen", _NONE_EXISTING),
        """SELECT path, "database", retention_policy, statement FROM steps""",
    )
    o["backup_rotation"] = _select(
        _STREAM,
        """SELECT host, "database", retention_policy, "day", count(*) AS lines, CAST(0 AS BIGINT) AS bare_files
        FROM stored GROUP BY ALL""",
    )
    o["batch_counter"] = _select(
        _RAW, "SELECT CAST(2 AS BIGINT) AS batches, count(*) AS records FROM raw"
    )

    o["stage_timings"] = """SELECT CAST(b AS BIGINT) AS batch_id, 'raw' AS listener, stage, true AS measured
        FROM (VALUES (0), (1)) AS batches(b), (VALUES ('check'), ('points'), ('dead_letter')) AS stages(stage)"""
    o["route_lookup_timings"] = """SELECT CAST(b AS BIGINT) AS batch_id, 'raw' AS listener, stage, true AS measured
        FROM (VALUES (0), (1)) AS batches(b),
            (VALUES ('decode'), ('route_lookup'), ('check'), ('points'), ('dead_letter')) AS stages(stage)"""
    o["batch_progress"] = _select(
        _RAW,
        """SELECT stage, CAST(2 AS BIGINT) AS batches, (SELECT count(*) FROM raw) AS input_rows, true AS measured
        FROM (VALUES ('addBatch'), ('queryPlanning'), ('triggerExecution')) AS stages(stage)""",
    )
    o["backup_of_late_rows"] = _select(
        _STREAM,
        """SELECT host, "database", retention_policy, count(*) AS saved,
        count(*) FILTER (WHERE ts_s >= 1706659200 - 5 * 86400) AS stored FROM stored GROUP BY ALL""",
    )
    o["stream_wipe_restore"] = stored

    # --- restore
    counts = """SELECT host, "database", retention_policy, measurement, count(*) AS points,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM routed {where} GROUP BY ALL"""
    o["restore_one_target"] = _select(_ROUTED, counts.format(where="WHERE host = 'store-1'"))
    o["wipe_and_restore"] = _select(_ROUTED, counts.format(where=""))
    o["restored_points_of_all"] = _select(
        _ROUTED,
        f"""SELECT host, "database", retention_policy, measurement, ts_s, {_tags('|', False)} AS tags,
        'event_value=' || value_text || '|props_k=' || k_text AS fields FROM routed""",
    )
    return o
