"""The SQL each registered query is compared with, over the same tables in another engine."""

from __future__ import annotations

from entity_events import fixed_values as fixed
from entity_events.catalog.queries import END, MIDDLE, POLL_SECONDS, SETTINGS, START, STATIC
from entity_events.operators import quality
from entity_events.operators.manifest import SCHEMA_NAME
from entity_events.settings import Targets
from entity_events.sources import supplied

_STAMP = "%Y-%m-%dT%H:%M:%S.%f"
_NUMBER = (
    r"^\s*[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
)
_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{word}'" for word in words)


def _stamp(column: str) -> str:
    return f"strftime({column}, '{_STAMP}')"


def _decimal(column: str) -> str:
    return f"CAST(CAST(round(CAST({column} AS DOUBLE) + 1e-8, 6) AS DECIMAL(18,6)) AS VARCHAR)"


def _moment_literal(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def _sql_columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _feed(states: str) -> str:
    return (
        f"SELECT {supplied.ENTITY_ID} AS entity_id, ts AS time, event_id AS seq, "
        f"{supplied.STATES[states]} AS state, {supplied.ATTRIBUTES} AS attributes FROM events"
    )


def _classified(feed: str) -> str:
    before = "lag(state) OVER (PARTITION BY entity_id ORDER BY time, seq)"
    return (
        f"SELECT *, CASE WHEN {before} IS NULL OR {before} <> state THEN '{fixed.STATE}' "
        f"ELSE '{fixed.ATTRIBUTE}' END AS reason FROM {feed}"
    )


def _rule(targets: Targets) -> str:
    labels = f"[{_words(targets.label_ids)}]"
    return (
        f"CASE WHEN entity_id IN ({_words(targets.entity_ids)}) THEN 'entity' "
        f"WHEN rule_area_id IN ({_words(targets.area_ids)}) THEN 'area' "
        f"WHEN list_has_any(label_list, {labels}) THEN 'entity label' "
        f"WHEN device_id IN ({_words(targets.device_ids)}) THEN 'device' "
        f"WHEN list_has_any(device_label_list, {labels}) THEN 'device label' END"
    )


def _docs(feed: str) -> str:
    number = "TRY_CAST(replace(trim(state), '_', '') AS DOUBLE)"
    return f"""SELECT *,
        CASE WHEN as_boolean IS NULL AND as_float IS NULL AND state SIMILAR TO '{_MOMENT}'
            THEN replace(state, 'Z', '+00:00') END AS as_datetime,
        CASE WHEN as_boolean IS NULL AND as_float IS NULL AND NOT state SIMILAR TO '{_MOMENT}'
            THEN state END AS as_string
        FROM (SELECT f.*, d.* EXCLUDE (entity_id),
            substring(f.entity_id, instr(f.entity_id, '.') + 1) AS state_object_id,
            '{fixed.DATASET_PREFIX}.' || split_part(f.entity_id, '.', 1) AS dataset,
            coalesce(json_extract_string(attributes, '$.friendly_name'),
                replace(substring(f.entity_id, instr(f.entity_id, '.') + 1), '_', ' ')) AS shown,
            CASE WHEN state IN ({_words(fixed.TRUE_WORDS)}) THEN 'true'
                WHEN state IN ({_words(fixed.FALSE_WORDS)}) THEN 'false' END AS as_boolean,
            CASE WHEN regexp_matches(state, '{_NUMBER}') AND isfinite({number}) THEN {number} END AS as_float
        FROM {feed} f JOIN details d ON f.entity_id = d.entity_id)"""


_LON, _LAT = (
    f"CAST(json_extract(attributes, '$.{name}') AS DOUBLE)" for name in ("longitude", "latitude")
)
_LOCATION = f"CASE WHEN {_LON} <> 0 AND {_LAT} <> 0 THEN {_LON}::VARCHAR || '|' || {_LAT}::VARCHAR END"

_NORMAL = (
    "lower(trim(regexp_replace(regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g'), "
    "'[^A-Za-z0-9_]+', '_', 'g'), '_'))"
)

_SKIPPED = _words(fixed.SKIPPED_ATTRIBUTES)

_BULK = f"""SELECT event_id // 100 AS batch_id,
    row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS position,
    NOT ({supplied.FAILED}) AS ok, event_type, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount
    FROM events"""

_CTES = {
    "feed_mixed": _feed("mixed"),
    "feed_decimal": _feed("decimal"),
    "feed_switch": _feed("switch"),
    "feed_orders": "SELECT 'purchase.user_' || o_custkey AS entity_id, CAST(o_orderdate AS TIMESTAMP) AS time, "
    "o_orderkey AS seq, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS state, "
    "CAST(NULL AS VARCHAR) AS attributes FROM orders",
    "reasons_mixed": _classified("feed_mixed"),
    "reasons_switch": _classified("feed_switch"),
    "newest": "SELECT * FROM feed_mixed QUALIFY row_number() OVER "
    "(PARTITION BY entity_id ORDER BY time DESC, seq DESC) = 1",
    "polled": f"SELECT entity_id, {_moment_literal(END)} AS time, seq, state, attributes, "
    f"'{fixed.POLLING}' AS reason FROM newest",
    "entity": f"SELECT {_sql_columns(supplied.ENTITY_COLUMNS)}, [domain, c_mktsegment] AS labels "
    f"FROM customer CROSS JOIN (SELECT unnest([{_words(supplied.DOMAINS)}]) AS domain) "
    f"WHERE {supplied.REGISTERED}",
    "device": f"SELECT {_sql_columns(supplied.DEVICE_COLUMNS)}, [{supplied.DEVICE_LABEL}] AS labels "
    "FROM supplier",
    "area": f"SELECT {_sql_columns(supplied.AREA_COLUMNS)} FROM nation",
    "floor": f"SELECT {_sql_columns(supplied.FLOOR_COLUMNS)} FROM region",
    "details": """SELECT e.entity_id, e.entity_id AS id, coalesce(nullif(e.name, ''), e.original_name) AS name,
        e.domain, a.id AS area_id, a.name AS area_name, f.floor_id AS area_floor_id, f.name AS area_floor_name,
        coalesce(nullif(e.device_class, ''), e.original_device_class) AS device_class,
        d.id AS device_id, coalesce(nullif(d.name_by_user, ''), d.name) AS device_name,
        da.id AS device_area_id, da.name AS device_area_name,
        df.floor_id AS device_area_floor_id, df.name AS device_area_floor_name,
        array_to_string(list_sort(d.labels), '|') AS device_labels,
        array_to_string(list_sort(e.labels), '|') AS labels,
        e.platform, e.unit_of_measurement, e.area_id AS rule_area_id,
        e.labels AS label_list, d.labels AS device_label_list
        FROM entity e LEFT JOIN area a ON a.id = e.area_id LEFT JOIN floor f ON f.floor_id = a.floor_id
        LEFT JOIN device d ON d.id = e.device_id LEFT JOIN area da ON da.id = d.area_id
        LEFT JOIN floor df ON df.floor_id = da.floor_id""",
    "rules": f"SELECT *, {_rule(SETTINGS.include)} AS include_rule, {_rule(SETTINGS.exclude)} AS exclude_rule "
    "FROM details",
    "docs_mixed": _docs("feed_mixed"),
    "docs_decimal": _docs("feed_decimal"),
    "docs_switch": _docs("feed_switch"),
    "docs_orders": _docs("feed_orders"),
    "docs_reasons": _docs("reasons_mixed"),
    "attribute": "SELECT f.seq, f.entity_id, j.key AS raw_name, CAST(j.value AS VARCHAR) AS json, j.type, "
    f"j.id AS position, {_NORMAL.format('j.key')} AS name FROM feed_mixed f, json_each(f.attributes) j",
    "kept": f"SELECT * FROM attribute WHERE raw_name NOT IN ({_SKIPPED}) AND trim(raw_name) <> ''",
    "published": """SELECT seq, name, min(position) AS position, arg_max(CASE
        WHEN name = 'zone' THEN CAST(to_json('{"b": ' || (json->'b') || ', "a": '
            || to_json('{"c": ' || (json->'a'->'c') || '}') || '}') AS VARCHAR)
        WHEN name = 'parts' THEN '[' || to_json('{"n": ' || (json->0->'n') || '}') || ',' || (json->1) || ']'
        ELSE json END, position) AS json FROM kept GROUP BY seq, name""",
    "filled": "SELECT * FROM published WHERE json NOT IN ('null', '[]', '{}')",
    "bulk": _BULK,
    "streams": f"SELECT '{supplied.STREAM_HEAD}' || event_type || '{supplied.STREAM_TAIL}' AS name, "
    f"isodow(ts) - 1 AS generation, CASE WHEN event_type = 'click' THEN {fixed.SCHEMA_VERSION} ELSE 1 END "
    "AS schema_version FROM events",
    "current_streams": "SELECT name, CAST(arg_max(schema_version, generation) AS INTEGER) AS schema_version, "
    "CAST(max(generation) AS INTEGER) AS generation FROM streams GROUP BY name",
}

ORACLES: dict[str, str] = {}


def _with(select: str, *names: str) -> str:
    ctes = ", ".join(f"{name} AS ({_CTES[name]})" for name in names)
    return f"WITH {ctes} {select}"


_REGISTRY = ("entity", "device", "area", "floor", "details")


def _over(states: str, select: str, *more: str) -> str:
    return _with(select, f"feed_{states}", *_REGISTRY, f"docs_{states}", *more)


def _pick(**fields: str) -> str:
    columns = ", ".join(f"d.{column} AS {name}" for name, column in fields.items())
    return _with(
        f"SELECT f.seq, {columns} FROM feed_mixed f JOIN details d USING (entity_id)",
        "feed_mixed",
        *_REGISTRY,
    )


def _decided(condition: str) -> str:
    return _with(
        "SELECT r.entity_id, r.seq, r.reason FROM reasons_switch r JOIN rules d USING (entity_id) "
        f"WHERE {condition}",
        "feed_switch",
        "reasons_switch",
        *_REGISTRY,
        "rules",
    )


_GATHERED = (
    "SELECT * FROM (SELECT entity_id, time, seq, state, reason FROM reasons_switch "
    "UNION ALL SELECT entity_id, time, seq, state, reason FROM polled)"
)
_GATHERED_FROM = ("feed_switch", "reasons_switch", "feed_mixed", "newest", "polled")
_ACTION = (
    f"CASE reason WHEN '{fixed.STATE}' THEN '{fixed.ACTION_TEXT[fixed.STATE]}' "
    f"WHEN '{fixed.ATTRIBUTE}' THEN '{fixed.ACTION_TEXT[fixed.ATTRIBUTE]}' "
    f"ELSE '{fixed.ACTION_TEXT[fixed.POLLING]}' END"
)
_BUCKETED = (
    "SELECT {by}, strftime(time_bucket(INTERVAL '{width}', time, TIMESTAMP '2000-01-01'), '"
    + _STAMP
    + "') AS bucket, {values} FROM docs_decimal WHERE as_float IS NOT NULL {where} GROUP BY ALL {having}"
)
_HOURLY = (
    f"{_decimal('avg(as_float)')} AS average, {_decimal('min(as_float)')} AS lowest, "
    f"{_decimal('max(as_float)')} AS highest, count(*) AS readings"
)


def _trend(states: str) -> str:
    return _over(
        states,
        "SELECT area_floor_name AS floor, area_name AS area, month, "
        "CAST(grouping_id(area_floor_name, area_name, month) AS BIGINT) AS level, "
        f"{_decimal('avg(as_float)')} AS average, count(*) AS readings "
        "FROM (SELECT *, CAST(CAST(date_trunc('month', time) AS DATE) AS VARCHAR) AS month "
        f"FROM docs_{states} WHERE as_float IS NOT NULL) GROUP BY ROLLUP (area_floor_name, area_name, month)",
    )


def _replay(seconds: int, start: str, end: str, feed: str) -> str:
    return (
        f"SELECT f.entity_id, t.tick AS time, f.seq, f.state, f.attributes "
        f"FROM (SELECT e.entity_id, g.tick FROM (SELECT DISTINCT entity_id FROM {feed}) e CROSS JOIN "
        f"(SELECT unnest(generate_series({start}, {end}, INTERVAL '{seconds} seconds')) AS tick) g) t "
        f"ASOF JOIN {feed} f ON t.entity_id = f.entity_id AND t.tick >= f.time"
    )


ORACLES["s1_change_feed"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, seq, state, attributes FROM feed_mixed", "feed_mixed"
)
ORACLES["s2_poll_snapshot"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, state, reason FROM polled", "feed_mixed", "newest", "polled"
)
ORACLES["s3_latest_state"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, seq, state, attributes FROM newest", "feed_mixed", "newest"
)
ORACLES["s4_registries"] = _with(
    "SELECT 'entity' AS kind, entity_id AS id, name, device_id AS parent FROM entity "
    "UNION ALL SELECT 'device', id, name, area_id FROM device "
    "UNION ALL SELECT 'area', id, name, floor_id FROM area "
    "UNION ALL SELECT 'floor', floor_id, name, NULL FROM floor",
    "entity",
    "device",
    "area",
    "floor",
)
ORACLES["s5_static_fields"] = (
    "SELECT event_id AS seq, '1.0.0' AS version, 'x86' AS architecture, 'spark_host' AS hostname, "
    "'-99.0|45.5' AS location, 'lab' AS tags, CAST(6 AS INTEGER) AS fields FROM events"
)
ORACLES["s6_target_lists"] = _with(
    "SELECT entity_id, include_rule, exclude_rule FROM rules", *_REGISTRY, "rules"
)
ORACLES["p1_drop_removals"] = _with(
    f"SELECT {_stamp('time')} AS time, entity_id, state FROM feed_switch WHERE NOT ({supplied.REMOVAL})",
    "feed_switch",
)
ORACLES["p2_change_type"] = _with(
    f"SELECT entity_id, seq, reason FROM ({_GATHERED}) WHERE reason IN ('attribute', 'polling')", *_GATHERED_FROM
)
ORACLES["p3_registered"] = _with(
    "SELECT entity_id, seq FROM feed_mixed WHERE entity_id IN (SELECT entity_id FROM entity)", "feed_mixed", "entity"
)
ORACLES["p4_exclude_targets"] = _decided("exclude_rule IS NULL")
ORACLES["p5_include_targets"] = _decided("include_rule IS NOT NULL")
ORACLES["p6_combined_filter"] = _decided(
    "reason = 'state' AND exclude_rule IS NULL AND include_rule IS NOT NULL"
)
ORACLES["p7_filter_audit"] = _with(
    "SELECT CASE WHEN reason <> 'state' THEN 'change type not listed' "
    "WHEN d.entity_id IS NULL THEN 'entity not registered' "
    "WHEN exclude_rule IS NOT NULL THEN 'excluded by ' || exclude_rule "
    "WHEN include_rule IS NULL THEN 'not included' ELSE 'passed' END AS filter_reason, count(*) AS readings "
    "FROM reasons_switch r LEFT JOIN rules d USING (entity_id) GROUP BY 1",
    "feed_switch",
    "reasons_switch",
    *_REGISTRY,
    "rules",
)
ORACLES["p8_attribute_filter"] = _with(
    "SELECT seq, raw_name AS name FROM kept", "feed_mixed", "attribute", "kept"
)
ORACLES["p9_attribute_audit"] = _with(
    f"SELECT raw_name AS name, CASE WHEN raw_name IN ({_SKIPPED}) THEN 'skipped name' ELSE 'blank name' END "
    "AS reason, count(*) AS rejections FROM attribute "
    f"WHERE raw_name IN ({_SKIPPED}) OR trim(raw_name) = '' GROUP BY 1, 2",
    "feed_mixed",
    "attribute",
)
ORACLES["p10_keep_keys"] = _with(
    "SELECT seq, raw_name AS name FROM attribute WHERE raw_name IN ('user', 'k') "
    "OR starts_with(raw_name, 'Event') OR starts_with(raw_name, 'lo')",
    "feed_mixed",
    "attribute",
)
ORACLES["p11_skip_empty"] = _with(
    "SELECT seq, raw_name AS name FROM attribute WHERE json NOT IN ('null', '[]', '{}')",
    "feed_mixed",
    "attribute",
)
ORACLES["w1_classify_change"] = _with(
    "SELECT entity_id, seq, state, reason FROM reasons_switch", "feed_switch", "reasons_switch"
)
ORACLES["w1_classify_event"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, seq, state, reason FROM reasons_switch "
    f"WHERE NOT ({supplied.REMOVAL})",
    "feed_switch",
    "reasons_switch",
)
ORACLES["w2_poll_replay"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, seq, state, '{fixed.POLLING}' AS reason FROM "
    f"({_replay(POLL_SECONDS, _moment_literal(START), _moment_literal(END), 'feed_switch')})",
    "feed_switch",
)
ORACLES["w3_merge_feeds"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, seq, state, reason FROM reasons_mixed "
    f"UNION ALL SELECT entity_id, {_stamp('time')}, seq, state, reason FROM polled",
    "feed_mixed",
    "reasons_mixed",
    "newest",
    "polled",
)
ORACLES["j1_state_entity"] = _pick(entity_id="id", name="name", platform="platform")
ORACLES["j2_entity_device"] = _pick(entity_id="id", device_id="device_id", device_name="device_name")
ORACLES["j3_entity_area"] = _pick(entity_id="id", area_id="area_id", area_name="area_name")
ORACLES["j4_area_floor"] = _pick(
    area_id="area_id", floor_id="area_floor_id", floor_name="area_floor_name"
)
ORACLES["j5_device_area"] = _pick(
    device_id="device_id", area_id="device_area_id", area_name="device_area_name"
)
ORACLES["j6_device_area_floor"] = _pick(
    device_id="device_id", floor_id="device_area_floor_id", floor_name="device_area_floor_name"
)
ORACLES["j7_entity_details"] = _with(
    "SELECT * EXCLUDE (entity_id, rule_area_id, label_list, device_label_list) FROM details", *_REGISTRY
)
ORACLES["d1_document"] = _with(
    f"SELECT seq, {_stamp('time')} AS timestamp, {_ACTION} AS action, 'change' AS type, entity_id, name, "
    "shown AS friendly_name, area_name AS area, area_floor_name AS floor, device_name AS device, "
    f"device_area_name AS device_area, labels, {_LOCATION} AS location, state AS value, as_boolean, "
    f"{_decimal('as_float')} AS as_float, as_datetime, as_string, state_object_id AS object_id, dataset, "
    "attributes_filled AS attributes FROM docs_reasons "
    "JOIN (SELECT seq, count(*) AS attributes_filled FROM filled GROUP BY seq) USING (seq)",
    "feed_mixed",
    "reasons_mixed",
    *_REGISTRY,
    "docs_reasons",
    "attribute",
    "kept",
    "published",
    "filled",
)
ORACLES["d2_action_text"] = _with(
    f"SELECT entity_id, seq, {_ACTION} AS action FROM ({_GATHERED})", *_GATHERED_FROM
)
ORACLES["d3_event_type"] = _with(
    f"SELECT entity_id, seq, CASE WHEN reason = 'polling' THEN 'info' ELSE 'change' END AS type FROM ({_GATHERED})",
    *_GATHERED_FROM,
)
ORACLES["d4_static_override"] = _with(
    "SELECT seq, 'metric' AS kind, '2.0.0' AS version FROM feed_mixed JOIN details USING (entity_id)",
    "feed_mixed",
    *_REGISTRY,
)
ORACLES["d5_tags"] = _with(
    "SELECT seq, 'lab|demo' AS tags, 'false' AS set_without_tags FROM feed_mixed JOIN details USING (entity_id)",
    "feed_mixed",
    *_REGISTRY,
)
ORACLES["d6_friendly_name"] = _over("mixed", "SELECT seq, name, shown FROM docs_mixed")
ORACLES["d7_location"] = _with(f"SELECT seq, {_LOCATION} AS location FROM feed_mixed", "feed_mixed")
ORACLES["d8_split_entity_id"] = (
    "SELECT event_id AS seq, event_type AS domain, 'user_' || user_id AS object_id FROM events"
)
ORACLES["d9_flatten"] = _with(
    "SELECT seq, area_id, area_name, area_floor_id, area_floor_name, device_class, device_id, device_name, "
    "device_area_id, device_area_name, device_area_floor_id, device_area_floor_name, device_labels "
    "FROM feed_mixed JOIN details USING (entity_id)",
    "feed_mixed",
    *_REGISTRY,
)
ORACLES["d10_prepare"] = _with(
    "SELECT seq, state AS value, labels, CAST(3 AS INTEGER) AS fields FROM feed_mixed JOIN details USING (entity_id)",
    "feed_mixed",
    *_REGISTRY,
)
ORACLES["f1_sanitize_domain"] = (
    "SELECT doc_id, substring(regexp_replace(lower(text), '[^a-z0-9_]', '', 'g'), 1, "
    f"{fixed.DATASET_NAME_LIMIT}) AS domain FROM documents"
)
_SANE = "substring(regexp_replace(lower({0}), '[^a-z0-9_]', '', 'g'), 1, 128)"
ORACLES["f2_data_stream"] = (
    f"SELECT page_id, '{fixed.STREAM_TYPE}' AS type, '{fixed.DATASET_PREFIX}.' || {_SANE.format('url')} AS dataset, "
    f"'{fixed.STREAM_NAMESPACE}' AS namespace FROM pages"
)
ORACLES["f3_stream_name"] = (
    f"SELECT p_partkey, '{supplied.STREAM_HEAD}' || {_SANE.format('p_name')} || '{supplied.STREAM_TAIL}' AS name "
    "FROM part"
)
ORACLES["f4_normalize_name"] = f"SELECT doc_id, md5({_NORMAL.format('text')}) AS name_hash FROM documents"
ORACLES["f4_normalize_url"] = f"SELECT page_id, {_NORMAL.format('url')} AS name FROM pages"
ORACLES["f5_key_collisions"] = _with(
    "SELECT seq, count(*) - count(DISTINCT name) AS collisions FROM kept GROUP BY seq",
    "feed_mixed",
    "attribute",
    "kept",
)
ORACLES["f6_published_attributes"] = _with(
    "SELECT seq, name, json FROM published", "feed_mixed", "attribute", "kept", "published"
)
ORACLES["f7_objects_as_text"] = _with(
    "SELECT seq, name, CASE WHEN json LIKE '\"%' THEN json_extract_string(json, '$') ELSE nullif(json, 'null') END AS text "
    "FROM published",
    "feed_mixed",
    "attribute",
    "kept",
    "published",
)
ORACLES["f8_json_encoding"] = _with(
    "SELECT entity_id, CAST(to_json({'entity_id': entity_id, 'domain': domain, 'labels': list_sort(labels)}) "
    "AS VARCHAR) AS json FROM entity",
    "entity",
)
_VALUE = "FROM feed_mixed"
_FLAG = (
    f"CASE WHEN state IN ({_words(fixed.TRUE_WORDS)}) THEN 'true' "
    f"WHEN state IN ({_words(fixed.FALSE_WORDS)}) THEN 'false' END"
)
_FLOAT = f"CASE WHEN regexp_matches(state, '{_NUMBER}') THEN TRY_CAST(replace(trim(state), '_', '') AS DOUBLE) END"
_WHEN = f"CASE WHEN regexp_matches(state, '{_MOMENT}') THEN replace(state, 'Z', '+00:00') END"
ORACLES["f9_boolean"] = _with(f"SELECT seq, {_FLAG} AS value {_VALUE}", "feed_mixed")
ORACLES["f10_number"] = _with(f"SELECT seq, {_decimal(_FLOAT)} AS value {_VALUE}", "feed_mixed")
ORACLES["f11_datetime"] = _with(
    f"SELECT seq, m AS datetime, substring(m, 1, 10) AS date, substring(m, 12, 8) AS time "
    f"FROM (SELECT seq, {_WHEN} AS m {_VALUE})",
    "feed_mixed",
)
ORACLES["f12_coerce_value"] = _with(
    "SELECT seq, CASE WHEN b IS NOT NULL THEN 'boolean' WHEN n IS NOT NULL THEN 'float' "
    "WHEN m IS NOT NULL THEN 'datetime' ELSE 'string' END AS branch, coalesce(b, n, m, state) AS value "
    f"FROM (SELECT seq, state, {_FLAG} AS b, {_decimal(_FLOAT)} AS n, {_WHEN} AS m {_VALUE})",
    "feed_mixed",
)
ORACLES["f12_coerce_texts"] = (
    "SELECT CASE WHEN b IS NOT NULL THEN 'boolean' WHEN n IS NOT NULL THEN 'float' "
    "WHEN m IS NOT NULL THEN 'datetime' ELSE 'string' END AS branch, count(*) AS texts "
    f"FROM (SELECT {_FLAG} AS b, {_FLOAT} AS n, {_WHEN} AS m FROM (SELECT text AS state FROM conversations "
    "UNION ALL SELECT text FROM documents)) GROUP BY 1"
)
ORACLES["f13_fallback_names"] = _with(
    "SELECT entity_id, coalesce(nullif(name, ''), original_name) AS name, "
    "coalesce(nullif(device_class, ''), original_device_class) AS device_class FROM entity",
    "entity",
)
ORACLES["f14_sorted_labels"] = _with(
    "SELECT entity_id, array_to_string(list_sort(labels), '|') AS labels FROM entity", "entity"
)
ORACLES["f15_iso_timestamp"] = _with(
    "SELECT kind, seq, replace(strftime(time, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00' AS time "
    "FROM (SELECT 'event' AS kind, seq, time FROM feed_mixed UNION ALL SELECT 'order', seq, time FROM feed_orders)",
    "feed_mixed",
    "feed_orders",
)
ORACLES["c1_keyword_cap"] = (
    "SELECT doc_id, CAST(CASE WHEN length(text) <= 1024 THEN length(text) END AS VARCHAR) AS keyword_length, "
    "length(text) AS text_length FROM documents"
)
ORACLES["c2_tolerant_number"] = _with(
    f"SELECT seq, {_decimal('TRY_CAST(t AS DOUBLE)')} AS as_float, "
    f"CAST(CAST(trunc({_FLOAT}) AS INTEGER) AS VARCHAR) AS as_integer "
    "FROM (SELECT seq, state, json_extract_string(attributes, '$.temperature') AS t FROM feed_mixed)",
    "feed_mixed",
)
ORACLES["c3_strict_date_time"] = _with(
    r"SELECT seq, CAST(CASE WHEN regexp_matches(split_part(state, 'T', 1), '^\d{4}-\d{2}-\d{2}$') "
    r"THEN TRY_CAST(split_part(state, 'T', 1) AS DATE) END AS VARCHAR) AS date, "
    r"CASE WHEN regexp_matches(substring(state, strpos(state, 'T') + 1), "
    r"'^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{6}|(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2}))?$') "
    r"THEN substring(state, strpos(state, 'T') + 1) END AS time FROM feed_mixed",
    "feed_mixed",
)
ORACLES["c4_attribute_text"] = _with(
    "SELECT seq, name, CASE WHEN json LIKE '\"%' THEN json_extract_string(json, '$') ELSE json END AS text FROM filled",
    "feed_mixed",
    "attribute",
    "kept",
    "published",
    "filled",
)
ORACLES["c5_typed_attribute"] = _with(
    "SELECT seq, " + _decimal("TRY_CAST(json_extract_string(attributes, '$.temperature') AS DOUBLE)") + " AS temperature, "
    "CAST(json_extract(attributes, '$.user') AS BIGINT) AS \"user\" FROM feed_mixed",
    "feed_mixed",
)
ORACLES["c6_ingest_hook"] = _over(
    "mixed",
    f"SELECT seq, {_decimal('celsius')} AS celsius FROM (SELECT seq, (as_float - 32) * 5 / 9 AS celsius FROM docs_mixed) "
    "WHERE celsius > 0",
)
ORACLES["c7_series_dedup"] = _over(
    "mixed",
    "SELECT seq, state_object_id AS object_id, state AS value, n AS attributes FROM docs_mixed "
    "JOIN (SELECT seq, count(*) AS n FROM filled GROUP BY seq) USING (seq)",
    "attribute",
    "kept",
    "published",
    "filled",
)
ORACLES["c8_retention"] = _with(
    f"SELECT entity_id, seq, {_stamp('time')} AS timestamp FROM feed_orders "
    "WHERE time >= TIMESTAMP '1999-06-01' - INTERVAL 365 DAY",
    "feed_orders",
)
ORACLES["c9_stream_constants"] = _over(
    "mixed",
    f"SELECT '{fixed.STREAM_TYPE}-' || dataset || '{supplied.STREAM_TAIL}' AS _index, count(*) AS documents, "
    "CAST(count(DISTINCT dataset) = 1 AS VARCHAR) AS constant FROM docs_mixed GROUP BY 1",
)
ORACLES["k1_append_stream"] = _over(
    "mixed",
    f"SELECT CASE WHEN time < {_moment_literal(MIDDLE)} OR dataset NOT IN (SELECT dataset FROM docs_mixed "
    f"WHERE time < {_moment_literal(MIDDLE)}) THEN 1::BIGINT ELSE 2 END AS generation, dataset, "
    "CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS documents, "
    f"{_decimal('sum(as_float)')} AS total FROM docs_mixed GROUP BY 1, 2, 3",
)
_HALF = f"(SELECT count(*) FROM docs_mixed WHERE time < {_moment_literal(MIDDLE)})"
ORACLES["k5_append_counts"] = _over(
    "mixed",
    f"SELECT CAST(batch AS BIGINT) AS batch, CASE batch WHEN 0 THEN {_HALF} WHEN 1 THEN count(*) - {_HALF} ELSE 0 END AS created, "
    f"CASE batch WHEN 0 THEN 0 WHEN 1 THEN {_HALF} ELSE count(*) END AS refused, 0::BIGINT AS failed "
    "FROM docs_mixed, range(3) b(batch) GROUP BY batch",
)
ORACLES["k2_action_envelope"] = _over(
    "mixed",
    f"SELECT '{fixed.CREATE}' AS _op_type, '{fixed.STREAM_TYPE}-' || dataset || '{supplied.STREAM_TAIL}' AS _index, "
    "seq, state AS value FROM docs_mixed",
)


def _document_line() -> str:
    entity = fixed.ENTITY_FIELD

    def text(name: str, column: str) -> str:
        return f"""'"{name}":' || to_json({column})"""

    def labels(name: str, column: str) -> str:
        return f"""'"{name}":' || to_json(list_sort({column}))"""

    parts = [
        f"""'"{fixed.TIMESTAMP_FIELD}":"' || replace({_stamp("time")}, '.000000', '') || '+00:00"'""",
        f"""'"event.action":"{fixed.ACTION_TEXT[fixed.STATE]}","event.kind":"event","event.type":"change"'""",
        text(entity + ".id", "entity_id"),
        text(entity + ".name", "name"),
        text(entity + ".domain", "domain"),
        text(entity + ".area.id", "area_id"),
        text(entity + ".area.name", "area_name"),
        text(entity + ".area.floor.id", "area_floor_id"),
        text(entity + ".area.floor.name", "area_floor_name"),
        text(entity + ".device_class", "device_class"),
        text(entity + ".device.id", "device_id"),
        text(entity + ".device.name", "device_name"),
        text(entity + ".device.area.id", "device_area_id"),
        text(entity + ".device.area.name", "device_area_name"),
        text(entity + ".device.area.floor.id", "device_area_floor_id"),
        text(entity + ".device.area.floor.name", "device_area_floor_name"),
        labels(entity + ".device.labels", "device_label_list"),
        labels(entity + ".labels", "label_list"),
        text(entity + ".platform", "platform"),
        text(entity + ".unit_of_measurement", "unit_of_measurement"),
        text(entity + ".friendly_name", "shown"),
        f"""'"{entity}.location":[' || replace({_LOCATION}, '|', ',') || ']'""",
        "attribute_text",
        text(entity + ".value", "state"),
        f"""'"{entity}.valueas.boolean":' || as_boolean""",
        text(entity + ".valueas.float", "as_float"),
        text(entity + ".valueas.datetime", "as_datetime"),
        f"""'"{entity}.valueas.date":"' || substring(as_datetime, 1, 10) || '"'""",
        f"""'"{entity}.valueas.time":"' || substring(as_datetime, 12, 8) || '"'""",
        text(entity + ".valueas.string", "as_string"),
        text(entity + ".object.id", "state_object_id"),
        f"""'"data_stream.type":"{fixed.STREAM_TYPE}"'""",
        text("data_stream.dataset", "dataset"),
        f"""'"data_stream.namespace":"{fixed.STREAM_NAMESPACE}"'""",
        f"""'"agent.version":"{STATIC.version}","host.architecture":"{STATIC.architecture}"'""",
        f"""'"host.os.name":"{STATIC.os_name}","host.hostname":"{STATIC.hostname}"'""",
        f"""'"host.location":[{STATIC.longitude},{STATIC.latitude}],"tags":["lab","demo"]'""",
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


ORACLES["k3_bulk_text"] = _over(
    "mixed",
    f"""SELECT '{{"create":{{"_index":"{fixed.STREAM_TYPE}-' || dataset || '{supplied.STREAM_TAIL}"}}}}' || chr(10)
        || {_document_line()} AS value FROM docs_mixed JOIN (
        SELECT seq, string_agg('"{fixed.ATTRIBUTES_FIELD}.' || name || '":' || json, ',' ORDER BY position)
            AS attribute_text FROM filled GROUP BY seq) USING (seq)""",
    "attribute",
    "kept",
    "published",
    "filled",
)
ORACLES["k4_bulk_items"] = _with(
    "SELECT batch_id, position, 'create' AS operation, CAST(ok AS VARCHAR) AS ok, "
    "CAST(CASE WHEN ok THEN 201 ELSE 400 END AS BIGINT) AS status, "
    f"'{supplied.STREAM_HEAD}' || event_type || '{supplied.STREAM_TAIL}' AS index, "
    "CASE WHEN NOT ok THEN 'document_parsing_exception' END AS error_type, "
    "CASE WHEN NOT ok THEN 'value ' || amount END AS error_reason FROM bulk",
    "bulk",
)
ORACLES["k5_outcome_counts"] = _with(
    "SELECT batch_id, count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed "
    "FROM bulk GROUP BY 1",
    "bulk",
)
ORACLES["k6_schema_version"] = _with(
    f"SELECT *, CASE WHEN schema_version <> {fixed.SCHEMA_VERSION} THEN 'update' ELSE 'keep' END AS action "
    "FROM current_streams",
    "streams",
    "current_streams",
)
ORACLES["k7_generation_rollover"] = _with(
    f"SELECT name, CAST({fixed.SCHEMA_VERSION} AS INTEGER) AS schema_version, "
    "CAST(generation + 1 AS INTEGER) AS generation FROM current_streams",
    "streams",
    "current_streams",
)
ORACLES["k7_written_streams"] = _over(
    "mixed",
    f"SELECT '{SCHEMA_NAME}' AS name, CAST({fixed.SCHEMA_VERSION} AS INTEGER) AS schema_version, 2::INTEGER AS generation "
    f"UNION ALL SELECT DISTINCT '{fixed.STREAM_TYPE}-' || dataset || '{supplied.STREAM_TAIL}', CAST({fixed.SCHEMA_VERSION} AS INTEGER), "
    f"CASE WHEN min(time) < {_moment_literal(MIDDLE)} THEN 2::INTEGER ELSE 1 END FROM docs_mixed GROUP BY dataset",
)
_REGISTERED_SWITCH = "FROM reasons_switch WHERE entity_id IN (SELECT entity_id FROM entity)"
ORACLES["t1_publish_stream"] = _with(
    f"SELECT entity_id, seq, state AS value, {_ACTION} AS action {_REGISTERED_SWITCH}",
    "feed_switch",
    "reasons_switch",
    "entity",
)
_DAY = "(SELECT {0}(date_trunc('day', ts)) FROM events)"
ORACLES["t2_poll_stream"] = _with(
    f"SELECT entity_id, {_stamp('time')} AS time, state AS value, '{fixed.ACTION_TEXT[fixed.POLLING]}' AS action FROM "
    f"({_replay(86400, _DAY.format('min'), _DAY.format('max'), 'feed_switch')}) "
    "WHERE entity_id IN (SELECT entity_id FROM entity)",
    "feed_switch",
    "entity",
)
ORACLES["t3_exactly_once"] = _with(
    f"SELECT '{fixed.DATASET_PREFIX}.' || split_part(entity_id, '.', 1) AS dataset, count(*) AS documents, "
    f"CAST(sum(seq) AS BIGINT) AS seq_total {_REGISTERED_SWITCH} GROUP BY 1",
    "feed_switch",
    "reasons_switch",
    "entity",
)
ORACLES["e1_quarantine"] = _with(
    f"SELECT entity_id, seq, CASE WHEN d.domain IS NULL THEN '{quality.UNKNOWN_ENTITY}' "
    f"ELSE '{quality.UNREADABLE}' END AS error FROM feed_mixed LEFT JOIN entity d USING (entity_id) "
    "WHERE d.domain IS NULL OR seq % 40 = 3",
    "feed_mixed",
    "entity",
)
ORACLES["a1_search"] = _over(
    "mixed",
    f"SELECT {_stamp('time')} AS time, entity_id AS id, seq, state AS value FROM docs_mixed "
    f"WHERE time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-15' "
    f"AND dataset = '{fixed.DATASET_PREFIX}.click'",
)
ORACLES["a2_value_over_time"] = _over(
    "decimal", _BUCKETED.format(by="entity_id", width="6 hours", values=_HOURLY, where="", having="")
)
ORACLES["a3_value_by_area"] = _over(
    "decimal",
    _BUCKETED.format(
        by="entity_id",
        width="1 day",
        values=_HOURLY,
        where="AND (area_name = 'NATION_2' OR shown = 'User 4')",
        having="",
    ),
)
ORACLES["a4_time_in_state"] = _over(
    "switch",
    "SELECT entity_id, state, CAST(CAST(day AS DATE) AS VARCHAR) AS day, "
    + _decimal("sum(epoch_us(least(finish, day + INTERVAL 1 DAY)) - epoch_us(greatest(start, day))) / 1000000.0")
    + " AS seconds FROM (SELECT *, unnest(generate_series(date_trunc('day', start), "
    "date_trunc('day', finish - INTERVAL 1 MICROSECOND), INTERVAL 1 DAY)) AS day FROM ("
    f"SELECT entity_id, state, time AS start, least(coalesce(lead(time) OVER (PARTITION BY entity_id "
    f"ORDER BY time, seq), {_moment_literal(END)}), {_moment_literal(END)}) AS finish FROM docs_switch) "
    "WHERE finish > start) GROUP BY 1, 2, 3",
)
ORACLES["a5_panel"] = _over(
    "decimal",
    f"SELECT {_stamp('CAST(CAST(time AS DATE) AS TIMESTAMP)')} AS bucket, "
    + ", ".join(
        f"{_decimal(f'''avg(as_float) FILTER (entity_id = '{kind}.user_1')''')} AS {kind}"
        for kind in ("click", "view", "error")
    )
    + " FROM docs_decimal WHERE entity_id IN ('click.user_1', 'view.user_1', 'error.user_1') GROUP BY 1",
)
ORACLES["a6_sustained_deviation"] = _over(
    "decimal",
    f"SELECT entity_id, {_stamp('min(time)')} AS started, {_stamp('max(time)')} AS ended FROM ("
    "SELECT *, sum(CASE WHEN as_float < 60 THEN 0 ELSE 1 END) OVER (PARTITION BY entity_id ORDER BY time, seq) "
    "AS island FROM docs_decimal) WHERE as_float < 60 GROUP BY entity_id, island "
    "HAVING max(time) - min(time) >= INTERVAL 1 DAY",
)
ORACLES["a7_threshold_rule"] = _over(
    "decimal",
    _BUCKETED.format(
        by="area_name AS area",
        width="1 day",
        values=f"{_decimal('min(as_float)')} AS lowest, {_decimal('max(as_float)')} AS highest",
        where="",
        having="HAVING min(as_float) < 1.0 OR max(as_float) > 200.0",
    ),
)
ORACLES["a8_area_floor_trend"] = _trend("decimal")
ORACLES["a8_order_trend"] = _trend("orders")
ORACLES["a9_tag_filter"] = _over(
    "mixed", "SELECT seq, state_object_id AS object_id, 'lab' AS first_tag FROM docs_mixed"
)
ORACLES["a10_latest_value"] = _over(
    "decimal",
    f"SELECT entity_id, {_stamp('max(time)')} AS time, arg_max(state, time) AS value FROM docs_decimal GROUP BY 1",
)

_LINE_PARTS = (
    f"SELECT {supplied.ENTITY_ID} AS entity_id, date_trunc('second', ts) AS time, {supplied.STATES['switch']} AS state, "
    f"event_id, {supplied.EVENT_LINE} AS line, {supplied.BROKEN_LINE} AS broken FROM events"
)
ORACLES["s1_feed_lines"] = (
    "SELECT CASE WHEN NOT broken THEN entity_id END AS entity_id, "
    f"CASE WHEN NOT broken THEN {_stamp('time')} END AS time, CASE WHEN NOT broken THEN state END AS state, "
    "CASE WHEN NOT broken THEN '{\"n\":' || event_id || '}' END AS attributes, "
    f"CASE WHEN NOT broken THEN '{fixed.STATE}' END AS reason, CASE WHEN broken THEN line END AS unreadable_line "
    f"FROM ({_LINE_PARTS})"
)
ORACLES["e1_broken_lines"] = _with(
    "SELECT CASE WHEN NOT broken THEN p.entity_id END AS entity_id, CASE WHEN NOT broken THEN event_id END AS number, "
    "CASE WHEN broken THEN line END AS line, "
    f"CASE WHEN broken THEN '{quality.UNREADABLE_LINE}' WHEN e.entity_id IS NULL THEN '{quality.UNKNOWN_ENTITY}' END AS error "
    f"FROM ({_LINE_PARTS}) p LEFT JOIN entity e ON p.entity_id = e.entity_id",
    "entity",
)
ORACLES["w1_keyed_stream"] = ORACLES["w1_classify_change"]
ORACLES["c7_stream_dedup"] = ORACLES["t1_publish_stream"]
ORACLES["t3_folded_batches"] = ORACLES["t3_exactly_once"]
ORACLES["c6_stream_hook"] = _over(
    "decimal",
    f"SELECT seq, {_decimal('celsius')} AS celsius FROM (SELECT seq, (as_float - 32) * 5 / 9 AS celsius FROM docs_decimal) "
    "WHERE celsius > 0",
)
ORACLES["c8_dropped_folders"] = _over(
    "mixed",
    "SELECT dataset, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS documents FROM docs_mixed "
    "WHERE time >= TIMESTAMP '2024-01-10' GROUP BY 1, 2",
)
_CLOSED = "(SELECT max(time) - INTERVAL 1 HOUR FROM docs_decimal)"
ORACLES["a2_stream_windows"] = _over(
    "decimal",
    _BUCKETED.format(
        by="entity_id",
        width="6 hours",
        values=_HOURLY,
        where=f"AND time_bucket(INTERVAL '6 hours', time, TIMESTAMP '2000-01-01') + INTERVAL 6 HOUR <= {_CLOSED}",
        having="",
    ),
)
ORACLES["a7_stream_breaches"] = _over(
    "decimal",
    _BUCKETED.format(
        by="area_name AS area",
        width="1 day",
        values=f"{_decimal('min(as_float)')} AS lowest, {_decimal('max(as_float)')} AS highest",
        where=f"AND time_bucket(INTERVAL '1 day', time, TIMESTAMP '2000-01-01') + INTERVAL 1 DAY <= {_CLOSED}",
        having="HAVING min(as_float) < 1.0 OR max(as_float) > 200.0",
    ),
)
ORACLES["a6_running_alert"] = _over(
    "decimal",
    f"SELECT entity_id, {_stamp('started')} AS started, {_stamp('min(time)')} AS reached FROM ("
    "SELECT *, min(time) OVER (PARTITION BY entity_id, island) AS started FROM ("
    "SELECT *, sum(CASE WHEN as_float < 60 THEN 0 ELSE 1 END) OVER (PARTITION BY entity_id ORDER BY time, seq) "
    "AS island FROM docs_decimal) WHERE as_float < 60) WHERE time - started >= INTERVAL 1 DAY GROUP BY entity_id, island, started",
)
ORACLES["a8_recorded_trend"] = ORACLES["a8_area_floor_trend"]
ORACLES["s6_rule_table"] = _with(
    """SELECT entity_id, CASE
        WHEN rule_area_id = 'area_4' THEN 'excluded by area'
        WHEN device_id IN (SELECT 'device_' || c_custkey FROM customer WHERE c_custkey % 6 = 2) THEN 'excluded by device'
        WHEN CAST(split_part(entity_id, 'user_', 2) AS BIGINT) % 5 < 2
            OR rule_area_id IN (SELECT 'area_' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0)
            OR list_has_any(label_list, (SELECT list(c_mktsegment) FROM customer WHERE c_mktsegment LIKE 'M%'))
            OR list_has_any(device_label_list, (SELECT list(c_mktsegment) FROM customer WHERE c_mktsegment LIKE 'M%'))
            THEN 'passed'
        ELSE 'not included' END AS target_decision FROM details""",
    *_REGISTRY,
)
ORACLES["c3_search_columns"] = _over(
    "mixed",
    "SELECT seq, state AS value_keyword, CAST(trunc(as_float) AS BIGINT) AS integer, "
    "CASE WHEN seq % 8 = 3 THEN split_part(state, 'T', 1) END AS date, "
    "CASE WHEN seq % 8 = 3 THEN split_part(state, 'T', 2) END AS time, "
    "split_part(entity_id, '.', 1) AS kind FROM docs_mixed",
)

# These queries leave no entity out.
for _name in (
    "s4_registries", "s6_target_lists", "s6_rule_table", "j7_entity_details", "f8_json_encoding", "f13_fallback_names", "f14_sorted_labels"
):
    ORACLES[_name] = ORACLES[_name].replace(f"WHERE {supplied.REGISTERED}", "")
