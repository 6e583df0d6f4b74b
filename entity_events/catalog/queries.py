"""One query per operator over the supplied tables; every query reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple
from datetime import UTC, datetime
from itertools import pairwise

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.functions import attributes as attrs
from entity_events.functions import rules, text, values
from entity_events.operators import changes, documents, enrich, filters, manifest, quality, sinks
from entity_events.operators.skew import Lookup
from entity_events.plans import analyses
from entity_events.plans.publish import classify_and_publish, publish
from entity_events.session import configure, shared_folder
from entity_events.settings import Settings, StaticFields
from entity_events.sources import feed, supplied
from entity_events.streaming import keyed
from entity_events.streaming import publish as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START = datetime(2024, 1, 1, tzinfo=UTC)
END = datetime(2024, 1, 31, tzinfo=UTC)
MIDDLE = datetime(2024, 1, 16, tzinfo=UTC)
POLL_SECONDS = 6 * 3600

OPTIONS = {
    "change_detection_type": ["state"],
    "tags": ["lab", "demo"],
    "include_targets": True,
    "exclude_targets": True,
    "targets_to_include": {
        "area_id": [f"area_{n}" for n in range(0, 20)],
        "label_id": ["MACHINERY", "rich"],
        "device_id": ["device_2", "device_4"],
        "entity_id": ["click.user_5", "view.user_11"],
    },
    "targets_to_exclude": {
        "area_id": ["area_3"],
        "label_id": ["purchase", "poor"],
        "device_id": ["device_6"],
        "entity_id": ["view.user_8"],
    },
}
SETTINGS = Settings.from_options(OPTIONS)
STATIC = StaticFields("1.0.0", "x86", "Linux", "spark_host", -99.0, 45.5, ("lab", "demo"))


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


# Shared inputs and output forms


def stamp(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def decimal(number: Column | str) -> Column:
    """Six places; the small offset keeps both engines on one side of a tie."""
    column = F.col(number) if isinstance(number, str) else number
    return F.round(column.cast("double") + 1e-8, 6).cast("decimal(18,6)").cast("string")


def joined(labels: Column | str) -> Column:
    return F.array_join(labels, "|")


def lookup(spark: SparkSession, folder: str) -> Lookup:
    return enrich.details_lookup(supplied.registry(spark, folder))


def classified(spark: SparkSession, folder: str, states: str = "mixed") -> DataFrame:
    return changes.classify_readings(supplied.readings(spark, folder, states))


def polled(spark: SparkSession, folder: str) -> DataFrame:
    latest = changes.latest_state(supplied.readings(spark, folder))
    return changes.poll(latest, END)


def docs(
    spark: SparkSession,
    folder: str,
    states: str = "mixed",
    settings: Settings | None = None,
    static: StaticFields | None = None,
) -> DataFrame:
    """Documents of every registered reading, each taken as a state change."""
    readings = supplied.readings(spark, folder, states)
    readings = readings.withColumn("reason", F.lit(fixed.STATE))
    return publish(readings, lookup(spark, folder), settings, static, trusted=True)


# Sources


@register("s1_change_feed")
def s1(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.readings(spark, folder)
    return rows.select("entity_id", stamp("time").alias("time"), "seq", "state", "attributes")


@register("s1_feed_lines")
def s1_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A feed of text lines, some broken: every line is a reading or kept as it is."""
    path = shared_folder(spark)
    supplied.feed_lines(spark, folder).select("value").write.text(path)
    rows = changes.classify_events(feed.read_events(spark, path))
    return rows.select("entity_id", stamp("time").alias("time"), "state", "attributes", "reason", "unreadable_line")


@register("s2_poll_snapshot")
def s2(spark: SparkSession, folder: str) -> DataFrame:
    rows = polled(spark, folder)
    return rows.select("entity_id", stamp("time").alias("time"), "state", "reason")


@register("s3_latest_state")
def s3(spark: SparkSession, folder: str) -> DataFrame:
    latest = changes.latest_state(supplied.readings(spark, folder))
    return latest.select("entity_id", stamp("time").alias("time"), "seq", "state", "attributes")


@register("s4_registries")
def s4(spark: SparkSession, folder: str) -> DataFrame:
    reg = supplied.registry(spark, folder, whole=True)

    def rows(table: DataFrame, kind: str, key: str, parent: str | None) -> DataFrame:
        above = F.col(parent) if parent else F.lit(None).cast("string")
        return table.select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), "name", above.alias("parent")
        )

    return (
        rows(reg.entities, "entity", "entity_id", "device_id")
        .unionByName(rows(reg.devices, "device", "id", "area_id"))
        .unionByName(rows(reg.areas, "area", "id", "floor_id"))
        .unionByName(rows(reg.floors, "floor", "floor_id", None))
    )


@register("s5_static_fields")
def s5(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents.with_static(
        supplied.readings(spark, folder).select("seq"),
        StaticFields("1.0.0", "x86", None, "spark_host", -99.0, 45.5, ("lab",)),
    )
    flat = documents.flatten(rows)
    return flat.select(
        "seq",
        F.col("`agent.version`").alias("version"),
        F.col("`host.architecture`").alias("architecture"),
        F.col("`host.hostname`").alias("hostname"),
        joined(F.col("`host.location`").cast("array<string>")).alias("location"),
        joined("tags").alias("tags"),
        F.lit(len(flat.columns)).alias("fields"),
    )


@register("s6_target_lists")
def s6(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich.entity_details(supplied.registry(spark, folder, whole=True))
    return rows.select(
        "entity_id",
        filters.matching_rule(SETTINGS.include).alias("include_rule"),
        filters.matching_rule(SETTINGS.exclude).alias("exclude_rule"),
    )


@register("s6_rule_table")
def s6_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rules as tables: one row for each customer, area and label of a kind, of any number."""
    customers, areas = (supplied.table(spark, folder, name) for name in ("customer", "nation"))
    domain = F.explode(F.array(*map(F.lit, supplied.DOMAINS))).alias("domain")

    def ids(rows: DataFrame, kind: str, sql: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.expr(sql).alias("id"))

    named = customers.select("c_custkey", domain)
    include = ids(named.where("c_custkey % 5 < 2"), "entity", supplied.ENTITY_COLUMNS["entity_id"])
    include = include.unionByName(ids(areas.where("n_nationkey % 2 = 0"), "area", supplied.AREA_COLUMNS["id"]))
    include = include.unionByName(ids(customers.where("c_mktsegment LIKE 'M%'").select("c_mktsegment"), "label", "c_mktsegment"))
    exclude = ids(customers.where("c_custkey % 6 = 2"), "device", "'device_' || CAST(c_custkey AS STRING)")
    exclude = exclude.unionByName(ids(areas.where("n_nationkey = 4"), "area", supplied.AREA_COLUMNS["id"]))
    entities = enrich.details_lookup(supplied.registry(spark, folder, whole=True))
    decided = filters.decided_by_tables(entities, include, exclude)
    return decided.rows.select("entity_id", "target_decision")


# Filters


@register("p1_drop_removals")
def p1(spark: SparkSession, folder: str) -> DataFrame:
    kept = changes.drop_removals(supplied.change_events(spark, folder))
    return kept.select(
        stamp("time_fired").alias("time"), "new_state.entity_id", "new_state.state"
    )


@register("p2_change_type")
def p2(spark: SparkSession, folder: str) -> DataFrame:
    gathered = changes.merge(
        classified(spark, folder, "switch"), polled(spark, folder)
    )
    kept = gathered.where(filters.change_type_passes(F.col("reason"), ["attribute"]))
    return kept.select("entity_id", "seq", "reason")


@register("p3_registered")
def p3(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.registered(supplied.readings(spark, folder), lookup(spark, folder))
    return kept.select("entity_id", "seq")


def _decided(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    entities = lookup(spark, folder)
    wanted = filters.targeted(supplied.readings(spark, folder, "switch"), entities, settings)
    kept = filters.accepted(changes.classify_readings(wanted), entities, settings)
    return kept.select("entity_id", "seq", "reason")


@register("p4_exclude_targets")
def p4(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder, Settings(exclude_enabled=True, exclude=SETTINGS.exclude))


@register("p5_include_targets")
def p5(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder, Settings(include_enabled=True, include=SETTINGS.include))


@register("p6_combined_filter")
def p6(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder, SETTINGS)


@register("p7_filter_audit")
def p7(spark: SparkSession, folder: str) -> DataFrame:
    audit = filters.audited(classified(spark, folder, "switch"), lookup(spark, folder), SETTINGS)
    return filters.reason_counts(audit)


@register("p8_attribute_filter")
def p8(spark: SparkSession, folder: str) -> DataFrame:
    kept = attrs.keep_publishable(attrs.parse(F.col("attributes")))
    return supplied.readings(spark, folder).select("seq", F.explode(F.map_keys(kept)).alias("name"))


@register("p9_attribute_audit")
def p9(spark: SparkSession, folder: str) -> DataFrame:
    out = attrs.rejected(attrs.parse(F.col("attributes")))
    rows = supplied.readings(spark, folder).select("entity_id", F.explode(out).alias("entry"))
    return rows.groupBy(F.col("entry.key").alias("name"), F.col("entry.reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("rejections")
    )


@register("p10_keep_keys")
def p10(spark: SparkSession, folder: str) -> DataFrame:
    kept = attrs.keep_names(attrs.parse(F.col("attributes")), ["user", "k"], ["Event", "lo"])
    return supplied.readings(spark, folder).select("seq", F.explode(F.map_keys(kept)).alias("name"))


@register("p11_skip_empty")
def p11(spark: SparkSession, folder: str) -> DataFrame:
    kept = attrs.skip_empty(attrs.parse(F.col("attributes")))
    return supplied.readings(spark, folder).select("seq", F.explode(F.map_keys(kept)).alias("name"))


# Change detection and polling


@register("w1_classify_change")
def w1(spark: SparkSession, folder: str) -> DataFrame:
    return classified(spark, folder, "switch").select("entity_id", "seq", "state", "reason")


@register("w1_classify_event")
def w1_event(spark: SparkSession, folder: str) -> DataFrame:
    rows = changes.classify_events(supplied.change_events(spark, folder))
    return rows.select("entity_id", stamp("time").alias("time"), "seq", "state", "reason")


@register("w2_poll_replay")
def w2(spark: SparkSession, folder: str) -> DataFrame:
    readings = supplied.readings(spark, folder, "switch")
    rows = changes.poll_replay(readings, START, END, POLL_SECONDS)
    return rows.select("entity_id", stamp("time").alias("time"), "seq", "state", "reason")


@register("w3_merge_feeds")
def w3(spark: SparkSession, folder: str) -> DataFrame:
    rows = changes.merge(classified(spark, folder), polled(spark, folder))
    return rows.select("entity_id", stamp("time").alias("time"), "seq", "state", "reason")


# Joins


def _detailed(spark: SparkSession, folder: str) -> DataFrame:
    return lookup(spark, folder).join(supplied.readings(spark, folder), "inner")


def _pick(spark: SparkSession, folder: str, **fields: str) -> DataFrame:
    rows = _detailed(spark, folder)
    return rows.select("seq", *(F.col(f"details.{path}").alias(name) for name, path in fields.items()))


@register("j1_state_entity")
def j1(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(spark, folder, entity_id="id", name="name", platform="platform")


@register("j2_entity_device")
def j2(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(spark, folder, entity_id="id", device_id="device.id", device_name="device.name")


@register("j3_entity_area")
def j3(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(spark, folder, entity_id="id", area_id="area.id", area_name="area.name")


@register("j4_area_floor")
def j4(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(
        spark, folder, area_id="area.id", floor_id="area.floor.id", floor_name="area.floor.name"
    )


@register("j5_device_area")
def j5(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(
        spark, folder, device_id="device.id", area_id="device.area.id", area_name="device.area.name"
    )


@register("j6_device_area_floor")
def j6(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(
        spark,
        folder,
        device_id="device.id",
        floor_id="device.area.floor.id",
        floor_name="device.area.floor.name",
    )


@register("j7_entity_details")
def j7(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich.entity_details(supplied.registry(spark, folder, whole=True)).select("details")
    flat = documents.flatten(rows.select("details.*"))
    return flat.select(
        *(
            (joined(F.col(f"`{n}`")) if n.endswith("labels") else F.col(f"`{n}`")).alias(
                n.replace(".", "_")
            )
            for n in flat.columns
        )
    )


# Documents

def _text_fields() -> dict[str, Column]:
    return {
        "timestamp": stamp("timestamp"),
        "action": F.col("event.action"),
        "type": F.col("event.type"),
        "entity_id": F.col("entity.id"),
        "name": F.col("entity.name"),
        "friendly_name": F.col("entity.friendly_name"),
        "area": F.col("entity.area.name"),
        "floor": F.col("entity.area.floor.name"),
        "device": F.col("entity.device.name"),
        "device_area": F.col("entity.device.area.name"),
        "labels": joined("entity.labels"),
        "location": joined(F.col("entity.location").cast("array<string>")),
        "value": F.col("value"),
        "as_boolean": F.col("valueas.boolean").cast("string"),
        "as_float": decimal("valueas.float"),
        "as_datetime": F.col("valueas.datetime"),
        "as_string": F.col("valueas.string"),
        "object_id": F.col("object_id"),
        "dataset": F.col("data_stream.dataset"),
        "attributes": F.size("attributes").cast("bigint"),
    }


@register("d1_document")
def d1(spark: SparkSession, folder: str) -> DataFrame:
    rows = classify_and_publish(supplied.readings(spark, folder), lookup(spark, folder))
    return rows.select("seq", *(column.alias(name) for name, column in _text_fields().items()))


def _gathered(spark: SparkSession, folder: str) -> DataFrame:
    return changes.merge(classified(spark, folder, "switch"), polled(spark, folder))


@register("d2_action_text")
def d2(spark: SparkSession, folder: str) -> DataFrame:
    rows = _gathered(spark, folder)
    return rows.select("entity_id", "seq", text.action_text(F.col("reason")).alias("action"))


@register("d3_event_type")
def d3(spark: SparkSession, folder: str) -> DataFrame:
    rows = _gathered(spark, folder)
    return rows.select("entity_id", "seq", text.event_type(F.col("reason")).alias("type"))


@register("d4_static_override")
def d4(spark: SparkSession, folder: str) -> DataFrame:
    flat = documents.flatten(docs(spark, folder), documents.FIELD_NAMES)
    fixed_rows = documents.override(flat, {"event.kind": "metric", "agent.version": "2.0.0"})
    kind, version = F.col("`event.kind`"), F.col("`agent.version`")
    return fixed_rows.select("seq", kind.alias("kind"), version.alias("version"))


@register("d5_tags")
def d5(spark: SparkSession, folder: str) -> DataFrame:
    with_tags = docs(spark, folder, settings=Settings.from_options({"tags": OPTIONS["tags"]}))
    without = docs(spark, folder)
    has_tags = F.lit("tags" in without.columns).cast("string")
    return with_tags.select("seq", joined("tags").alias("tags"), has_tags.alias("set_without_tags"))


@register("d6_friendly_name")
def d6(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder)
    return rows.select("seq", F.col("entity.name").alias("name"), F.col("entity.friendly_name").alias("shown"))


@register("d7_location")
def d7(spark: SparkSession, folder: str) -> DataFrame:
    place = attrs.location(attrs.parse(F.col("attributes")))
    rows = supplied.readings(spark, folder)
    return rows.select("seq", joined(place.cast("array<string>")).alias("location"))


@register("d8_split_entity_id")
def d8(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.readings(spark, folder)
    entity_id = F.col("entity_id")
    return rows.select(
        "seq", text.domain_of(entity_id).alias("domain"), text.object_id_of(entity_id).alias("object_id")
    )


@register("d9_flatten")
def d9(spark: SparkSession, folder: str) -> DataFrame:
    flat = documents.flatten(docs(spark, folder), documents.FIELD_NAMES)
    wanted = documents.keep_columns(flat, ["seq"], [fixed.ENTITY_FIELD + ".device", fixed.ENTITY_FIELD + ".area"])
    return wanted.select(
        *(
            (joined(F.col(f"`{n}`")) if n.endswith("labels") else F.col(f"`{n}`")).alias(
                n.removeprefix(fixed.ENTITY_FIELD + ".").replace(".", "_")
            )
            for n in wanted.columns
        )
    )


@register("d10_prepare")
def d10(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select("seq", "value", "entity")
    labels = fixed.ENTITY_FIELD + ".labels"
    ready = documents.prepare(rows, documents.FIELD_NAMES, ["seq", labels, fixed.ENTITY_FIELD + ".value"])
    return ready.select(
        "seq",
        F.col(f"`{fixed.ENTITY_FIELD}.value`").alias("value"),
        joined(F.col(f"`{labels}`")).alias("labels"),
        F.lit(len(ready.columns)).alias("fields"),
    )


# Scalar functions


@register("f1_sanitize_domain")
def f1(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "documents")
    return rows.select("doc_id", text.sanitize_domain(F.col("text")).alias("domain"))


@register("f2_data_stream")
def f2(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "pages")
    return rows.select("page_id", text.data_stream(F.col("url")).alias("s")).select("page_id", "s.*")


@register("f3_stream_name")
def f3(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "part")
    name = text.stream_name(text.data_stream(F.col("p_name")))
    return rows.select("p_partkey", name.alias("name"))


@register("f4_normalize_name")
def f4(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "documents")
    return rows.select("doc_id", text_hash(attrs.normalize_name(F.col("text"))).alias("name_hash"))


def text_hash(column: Column) -> Column:
    return F.md5(column.cast("binary"))


@register("f4_normalize_url")
def f4_url(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "pages")
    return rows.select("page_id", attrs.normalize_name(F.col("url")).alias("name"))


@register("f5_key_collisions")
def f5(spark: SparkSession, folder: str) -> DataFrame:
    lost = attrs.collisions(attrs.parse(F.col("attributes")))
    return supplied.readings(spark, folder).select("seq", lost.cast("bigint").alias("collisions"))


def _published(spark: SparkSession, folder: str) -> DataFrame:
    kept = attrs.published(F.col("attributes"))
    return supplied.readings(spark, folder).select("seq", F.explode(kept).alias("name", "value"))


@register("f6_published_attributes")
def f6(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).select("seq", "name", F.to_json("value").alias("json"))


@register("f7_objects_as_text")
def f7(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).select("seq", "name", F.col("value").cast("string").alias("text"))


@register("f8_json_encoding")
def f8(spark: SparkSession, folder: str) -> DataFrame:
    entities = supplied.registry(spark, folder, whole=True).entities
    record = F.struct("entity_id", "domain", text.sorted_labels(F.col("labels")).alias("labels"))
    return entities.select("entity_id", F.to_json(record).alias("json"))


@register("f9_boolean")
def f9(spark: SparkSession, folder: str) -> DataFrame:
    value = values.as_boolean(F.col("state")).cast("string")
    return supplied.readings(spark, folder).select("seq", value.alias("value"))


@register("f10_number")
def f10(spark: SparkSession, folder: str) -> DataFrame:
    value = decimal(values.as_number(F.col("state")))
    return supplied.readings(spark, folder).select("seq", value.alias("value"))


@register("f11_datetime")
def f11(spark: SparkSession, folder: str) -> DataFrame:
    moment = values.as_datetime(F.col("state"))
    rows = supplied.readings(spark, folder).select("seq", moment.alias("m"))
    return rows.select(
        "seq",
        F.col("m.datetime").alias("datetime"),
        F.col("m.date").cast("string").alias("date"),
        F.col("m.time").alias("time"),
    )


def _branch(value: Column) -> Column:
    return (
        F.when(value["boolean"].isNotNull(), "boolean")
        .when(value["float"].isNotNull(), "float")
        .when(value["datetime"].isNotNull(), "datetime")
        .otherwise("string")
    )


@register("f12_coerce_value")
def f12(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.readings(spark, folder).select("seq", values.coerce(F.col("state")).alias("v"))
    value = F.coalesce(
        F.col("v.boolean").cast("string"), decimal("v.float"), F.col("v.datetime"), F.col("v.string")
    )
    return rows.select("seq", _branch(F.col("v")).alias("branch"), value.alias("value"))


@register("f12_coerce_texts")
def f12_texts(spark: SparkSession, folder: str) -> DataFrame:
    texts = supplied.table(spark, folder, "conversations").select("text")
    texts = texts.unionByName(supplied.table(spark, folder, "documents").select("text"))
    branch = _branch(values.coerce(F.col("text")))
    return texts.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("texts"))


@register("f13_fallback_names")
def f13(spark: SparkSession, folder: str) -> DataFrame:
    entities = supplied.registry(spark, folder, whole=True).entities
    return entities.select(
        "entity_id",
        text.first_filled(F.col("name"), F.col("original_name")).alias("name"),
        text.first_filled(F.col("device_class"), F.col("original_device_class")).alias("device_class"),
    )


@register("f14_sorted_labels")
def f14(spark: SparkSession, folder: str) -> DataFrame:
    entities = supplied.registry(spark, folder, whole=True).entities
    return entities.select("entity_id", joined(text.sorted_labels(F.col("labels"))).alias("labels"))


@register("f15_iso_timestamp")
def f15(spark: SparkSession, folder: str) -> DataFrame:
    fed = supplied.readings(spark, folder).select(F.lit("event").alias("kind"), "seq", "time")
    orders = supplied.order_readings(spark, folder).select(F.lit("order").alias("kind"), "seq", "time")
    rows = fed.unionByName(orders)
    return rows.select("kind", "seq", text.iso_utc(F.col("time")).alias("time"))


# Schema rules


@register("c1_keyword_cap")
def c1(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.table(spark, folder, "documents")
    keyword = rules.keyword(F.col("text"))
    return rows.select(
        "doc_id",
        F.char_length(keyword).cast("string").alias("keyword_length"),
        F.char_length("text").cast("bigint").alias("text_length"),
    )


@register("c2_tolerant_number")
def c2(spark: SparkSession, folder: str) -> DataFrame:
    given = attrs.as_text(attrs.parse(F.col("attributes")))["temperature"]
    rows = supplied.readings(spark, folder)
    return rows.select(
        "seq",
        decimal(rules.tolerant(given, "double")).alias("as_float"),
        values.as_integer(F.col("state")).cast("string").alias("as_integer"),
    )


@register("c3_strict_date_time")
def c3(spark: SparkSession, folder: str) -> DataFrame:
    state = F.col("state")
    rows = supplied.readings(spark, folder)
    return rows.select(
        "seq",
        rules.strict_date(F.substring_index(state, "T", 1)).cast("string").alias("date"),
        rules.clock_time(F.substr(state, F.instr(state, "T") + 1)).alias("time"),
    )


@register("c3_search_columns")
def c3_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents.with_search_columns(docs(spark, folder)).select("seq", "search.*")
    return rows.select(
        "seq",
        "value_keyword",
        F.col("integer").cast("bigint").alias("integer"),
        F.col("date").cast("string").alias("date"),
        "time",
        F.col("attributes")["kind"].alias("kind"),
    )


@register("c4_attribute_text")
def c4(spark: SparkSession, folder: str) -> DataFrame:
    kept = attrs.as_text(attrs.skip_empty(attrs.published(F.col("attributes"))))
    return supplied.readings(spark, folder).select("seq", F.explode(kept).alias("name", "text"))


@register("c5_typed_attribute")
def c5(spark: SparkSession, folder: str) -> DataFrame:
    wanted = attrs.typed(attrs.parse(F.col("attributes")), {"temperature": "double", "user": "int"})
    rows = supplied.readings(spark, folder).select("seq", *wanted)
    return rows.select("seq", decimal("temperature").alias("temperature"), F.col("user").cast("bigint").alias("user"))


@register("c6_ingest_hook")
def c6(spark: SparkSession, folder: str) -> DataFrame:
    def hook(rows: DataFrame) -> DataFrame:
        return rows.withColumn("celsius", (F.col("valueas.float") - 32) * 5 / 9).where("celsius > 0")

    rows = docs(spark, folder).transform(hook)
    return rows.select("seq", decimal("celsius").alias("celsius"))


@register("c7_series_dedup")
def c7(spark: SparkSession, folder: str) -> DataFrame:
    first = docs(spark, folder)
    again = first.withColumns({"seq": F.col("seq") + 1_000_000_000, "value": F.lit("late copy")})
    kept = quality.first_per_point(again.unionByName(first))
    return kept.select("seq", "object_id", "value", F.size("attributes").cast("bigint").alias("attributes"))


@register("c8_retention")
def c8(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.order_readings(spark, folder).withColumn("timestamp", F.col("time"))
    kept = quality.retained(rows, datetime(1999, 6, 1, tzinfo=UTC))
    return kept.select("entity_id", "seq", stamp("timestamp").alias("timestamp"))


@register("c9_stream_constants")
def c9(spark: SparkSession, folder: str) -> DataFrame:
    checked = quality.stream_constants(sinks.envelope(docs(spark, folder)))
    return checked.select("_index", "documents", F.col("constant").cast("string").alias("constant"))


# Sinks


@register("k1_append_stream")
def k1(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    manifest.ensure_schema(spark, sinks.manifest_path(path), version=1)
    rows = docs(spark, folder)
    sinks.append(rows.where(F.col("timestamp") < F.lit(MIDDLE)), path)
    manifest.ensure_schema(spark, sinks.manifest_path(path))
    sinks.append(rows, path)
    sinks.append(rows, path)
    stored = spark.read.parquet(path)
    return stored.groupBy(
        F.col("generation").cast("bigint").alias("generation"), "dataset", F.col("event_date").cast("string").alias("day")
    ).agg(F.count(F.lit(1)).alias("documents"), decimal(F.sum("valueas.float")).alias("total"))


@register("k5_append_counts")
def k5_append(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    rows = docs(spark, folder)
    half = rows.where(F.col("timestamp") < F.lit(MIDDLE))
    told = [(i, *astuple(sinks.append(batch, path))) for i, batch in enumerate((half, rows, rows))]
    return spark.createDataFrame(told, "batch long, created long, refused long, failed long")


@register("k2_action_envelope")
def k2(spark: SparkSession, folder: str) -> DataFrame:
    actions = sinks.envelope(docs(spark, folder))
    return actions.select("_op_type", "_index", F.col("_source.seq").alias("seq"), "_source.value")


@register("k3_bulk_text")
def k3(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.bulk_text(docs(spark, folder, static=STATIC))


@register("k4_bulk_items")
def k4(spark: SparkSession, folder: str) -> DataFrame:
    items = sinks.bulk_items(supplied.bulk_responses(spark, folder))
    return items.select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        F.col("position").cast("bigint").alias("position"),
        "operation",
        F.col("ok").cast("string").alias("ok"),
        F.col("status").cast("bigint").alias("status"),
        "index",
        "error_type",
        "error_reason",
    )


@register("k5_outcome_counts")
def k5(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.outcome_counts(sinks.bulk_items(supplied.bulk_responses(spark, folder)))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Streams of the feed with the schema version and generations they were written under."""
    rows = supplied.table(spark, folder, "events")
    name = text.stream_name(text.data_stream(F.col("event_type")))
    return rows.groupBy(name.alias("name"), F.weekday("ts").alias("generation")).agg(
        F.max(F.when(F.col("event_type") == "click", fixed.SCHEMA_VERSION).otherwise(1)).alias("schema_version")
    )


@register("k6_schema_version")
def k6(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.with_action(manifest.current(_manifest(spark, folder)))


@register("k7_generation_rollover")
def k7(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.rolled_over(_manifest(spark, folder))


@register("k7_written_streams")
def k7_written(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a table that two appends wrote to, with an update of the schema between them."""
    path = shared_folder(spark)
    record = sinks.manifest_path(path)
    manifest.ensure_schema(spark, record, version=1)
    rows = docs(spark, folder)
    sinks.append(rows.where(F.col("timestamp") < F.lit(MIDDLE)), path)
    manifest.ensure_schema(spark, record)
    sinks.append(rows, path)
    return manifest.current(manifest.read(spark, record))


# Streams: what each wrote, read back


def _published_stream(
    spark: SparkSession, folder: str, settings: Settings, poll: bool = False
) -> DataFrame:
    configure(spark)
    schema = supplied.table(spark, folder, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    readings = supplied.readings_of(reader.parquet(folder), "switch")
    ticks = None
    if poll:
        ticks = reader.parquet(folder).select(
            F.date_trunc("day", F.col("ts").cast("timestamp")).alias("time")
        )
    out = shared_folder(spark)
    query = stream.start(
        readings,
        out,
        lambda: supplied.registry(spark, folder),
        settings,
        poll_ticks=ticks,
        available_now=True,
    )
    query.awaitTermination()
    return stream.read_documents(spark, out)


@register("t1_publish_stream")
def t1(spark: SparkSession, folder: str) -> DataFrame:
    rows = _published_stream(spark, folder, Settings())
    return rows.select(F.col("entity.id").alias("entity_id"), "seq", "value", F.col("event.action").alias("action"))


@register("t2_poll_stream")
def t2(spark: SparkSession, folder: str) -> DataFrame:
    settings = Settings(change_types=(), poll_seconds=86400)
    rows = _published_stream(spark, folder, settings, poll=True)
    return rows.select(
        F.col("entity.id").alias("entity_id"),
        stamp("timestamp").alias("time"),
        "value",
        F.col("event.action").alias("action"),
    )


@register("t3_exactly_once")
def t3(spark: SparkSession, folder: str) -> DataFrame:
    rows = _published_stream(spark, folder, Settings())
    return rows.groupBy(F.col("data_stream.dataset").alias("dataset")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("seq").alias("seq_total"),
    )


EDGES = [None, *(datetime(2024, 1, day, tzinfo=UTC) for day in (8, 16, 24)), None]


def _slices(rows: DataFrame, time: str = "time") -> Iterator[DataFrame]:
    """All rows in stretches of time, one after the other, as a feed would bring them."""
    for begin, end in pairwise(EDGES):
        part = rows
        if begin:
            part = part.where(F.col(time) >= F.lit(begin))
        if end:
            part = part.where(F.col(time) < F.lit(end))
        yield part


def _streamed(rows: DataFrame, time: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream gives out that is stopped and started again for every slice of its source."""
    spark = rows.sparkSession
    source, out = shared_folder(spark), shared_folder(spark)
    for part in _slices(rows, time):
        part.write.mode("append").parquet(source)
        query = (
            build(spark.readStream.schema(rows.schema).parquet(source))
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{out}/rows")
        )
        query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _published_slices(rows: DataFrame, registry: Callable[[], enrich.Registry], **options) -> str:
    """The folder that a publishing stream fills which is stopped and started again for every slice."""
    spark = rows.sparkSession
    source, out = shared_folder(spark), shared_folder(spark)
    for part in _slices(rows):
        part.write.mode("append").parquet(source)
        readings = spark.readStream.schema(rows.schema).parquet(source)
        stream.start(readings, out, registry, available_now=True, **options).awaitTermination()
    return out


@register("w1_keyed_stream")
def w1_keyed(spark: SparkSession, folder: str) -> DataFrame:
    rows = _streamed(supplied.readings(spark, folder, "switch"), "time", keyed.classified)
    return rows.select("entity_id", "seq", "state", "reason")


@register("c7_stream_dedup")
def c7_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading comes again a slice later, as another state; only the first is published."""
    rows = supplied.readings(spark, folder, "switch")
    source, out = shared_folder(spark), shared_folder(spark)
    again = None
    for part in _slices(rows):
        (part.unionByName(again) if again else part).write.mode("append").parquet(source)
        again = part.withColumn("state", F.lit("late copy"))
        readings = spark.readStream.schema(rows.schema).parquet(source)
        registry = lambda: supplied.registry(spark, folder)
        stream.start(readings, out, registry, available_now=True, first_within="20 days").awaitTermination()
    stored = stream.read_documents(spark, out)
    return stored.select(F.col("entity.id").alias("entity_id"), "seq", "value", F.col("event.action").alias("action"))


@register("t3_folded_batches")
def t3_folded(spark: SparkSession, folder: str) -> DataFrame:
    """A stream one of whose batches fails first, folded into the table as it goes and once more at the end."""
    rows = supplied.readings(spark, folder, "switch")
    source, out, table = (shared_folder(spark) for _ in range(3))
    failures = iter((False, True, False))

    def registry() -> enrich.Registry:
        if next(failures, False):
            raise OSError("the registry cannot be read")
        return supplied.registry(spark, folder)

    for part in _slices(rows):
        part.write.mode("append").parquet(source)
        for _ in range(2):
            readings = spark.readStream.schema(rows.schema).parquet(source)
            try:
                stream.start(readings, out, registry, available_now=True).awaitTermination()
                break
            except StreamingQueryException:
                continue
        stream.fold(spark, out, table)
        stream.drop_folded(spark, out, table)
    stream.fold(spark, out, table)
    return spark.read.parquet(table).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("seq").alias("seq_total")
    )


@register("c6_stream_hook")
def c6_stream(spark: SparkSession, folder: str) -> DataFrame:
    def celsius(rows: DataFrame) -> DataFrame:
        return rows.withColumn("celsius", (F.col("valueas.float") - 32) * 5 / 9)

    def above_freezing(rows: DataFrame) -> DataFrame:
        return rows.where("celsius > 0")

    readings = supplied.readings(spark, folder, "decimal")
    out = _published_slices(readings, lambda: supplied.registry(spark, folder), hooks=(celsius, above_freezing))
    return stream.read_documents(spark, out).select("seq", decimal("celsius").alias("celsius"))


@register("c8_dropped_folders")
def c8_folders(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.append(docs(spark, folder), path)
    for _ in range(2):
        sinks.drop_expired(spark, path, datetime(2024, 1, 20, tzinfo=UTC), days=10)
    stored = spark.read.parquet(path)
    return stored.groupBy("dataset", F.col("event_date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("documents"))


@register("e1_broken_lines")
def e1_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of text lines, some broken: what was stored and what went to the quarantine."""
    source, out = shared_folder(spark), shared_folder(spark)
    for part in _slices(supplied.feed_lines(spark, folder)):
        part.select("value").write.mode("append").text(source)
        events = changes.classify_events(feed.stream_events(spark, source))
        registry = lambda: supplied.registry(spark, folder)
        stream.start(events, out, registry, available_now=True).awaitTermination()
    stored = stream.read_documents(spark, out)
    number = F.col("attributes")["n"].cast("bigint")
    refused = spark.read.parquet(f"{out}/quarantine")
    nothing = F.lit(None).cast("string")
    return stored.select(
        F.col("entity.id").alias("entity_id"), number.alias("number"), nothing.alias("line"), nothing.alias("error")
    ).unionByName(
        refused.select(
            "entity_id",
            F.get_json_object("attributes", "$.n").cast("bigint").alias("number"),
            F.col("unreadable_line").alias("line"),
            "error",
        )
    )


def _watched(spark: SparkSession, folder: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """An analysis of a stream of documents, with a watermark an hour behind."""
    rows = docs(spark, folder, "decimal").select("timestamp", "entity", "valueas", "seq")
    return _streamed(rows, "timestamp", lambda given: build(given.withWatermark("timestamp", "1 hour")))


@register("a2_stream_windows")
def a2_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _hourly(_watched(spark, folder, lambda rows: analyses.value_over_time(rows, width="6 hours")))


@register("a7_stream_breaches")
def a7_stream(spark: SparkSession, folder: str) -> DataFrame:
    by = F.col("entity.area.name").alias("area")
    rows = _watched(spark, folder, lambda given: analyses.threshold_breaches(given, [by], 1.0, 200.0, "1 day"))
    return rows.select(
        "area", stamp("bucket").alias("bucket"), decimal("lowest").alias("lowest"), decimal("highest").alias("highest")
    )


@register("a6_running_alert")
def a6_stream(spark: SparkSession, folder: str) -> DataFrame:
    series = docs(spark, folder, "decimal").select(
        F.col("entity.id").alias("entity_id"), F.col("timestamp").alias("time"), "seq", F.col("valueas.float").alias("number")
    )
    alerts = _streamed(series, "time", lambda rows: keyed.running_deviation(rows, F.col("number") < 60, 24 * 60))
    return alerts.select("entity_id", stamp("started").alias("started"), stamp("reached").alias("reached"))


@register("e1_quarantine")
def e1(spark: SparkSession, folder: str) -> DataFrame:
    readings = supplied.readings(spark, folder)
    broken = F.when(F.col("seq") % 40 == 3, F.lit("{broken")).otherwise(F.col("attributes"))
    refused = quality.quarantined(readings.withColumn("attributes", broken), lookup(spark, folder))
    return refused.select("entity_id", "seq", "error")


# Analyses


@register("a1_search")
def a1(spark: SparkSession, folder: str) -> DataFrame:
    found = analyses.search(
        docs(spark, folder),
        datetime(2024, 1, 8, tzinfo=UTC),
        datetime(2024, 1, 15, tzinfo=UTC),
        ["timestamp", "entity.id", "seq", "value"],
        F.col("data_stream.dataset") == f"{fixed.DATASET_PREFIX}.click",
    )
    return found.select(stamp("timestamp").alias("time"), "id", "seq", "value")


def _hourly(rows: DataFrame) -> DataFrame:
    return rows.select(
        "entity_id",
        stamp("bucket").alias("bucket"),
        decimal("average").alias("average"),
        decimal("lowest").alias("lowest"),
        decimal("highest").alias("highest"),
        "readings",
    )


@register("a2_value_over_time")
def a2(spark: SparkSession, folder: str) -> DataFrame:
    return _hourly(analyses.value_over_time(docs(spark, folder, "decimal"), width="6 hours"))


@register("a3_value_by_area")
def a3(spark: SparkSession, folder: str) -> DataFrame:
    wanted = (F.col("entity.area.name") == "NATION_2") | (F.col("entity.friendly_name") == "User 4")
    return _hourly(analyses.value_over_time(docs(spark, folder, "decimal"), wanted, "1 day"))


@register("a4_time_in_state")
def a4(spark: SparkSession, folder: str) -> DataFrame:
    rows = analyses.time_in_state(docs(spark, folder, "switch"), END)
    return rows.select(
        "entity_id", "state", F.col("day").cast("string").alias("day"), decimal("seconds").alias("seconds")
    )


@register("a5_panel")
def a5(spark: SparkSession, folder: str) -> DataFrame:
    chosen = ["click.user_1", "view.user_1", "error.user_1"]
    rows = analyses.panel(docs(spark, folder, "decimal"), chosen, "1 day")
    return rows.select(
        stamp("bucket").alias("bucket"),
        *(decimal(F.col(f"`{name}`")).alias(name.split(".")[0]) for name in chosen),
    )


@register("a6_sustained_deviation")
def a6(spark: SparkSession, folder: str) -> DataFrame:
    runs = analyses.sustained_deviation(docs(spark, folder, "decimal"), F.col("valueas.float") < 60, 24 * 60)
    return runs.select("entity_id", stamp("started").alias("started"), stamp("ended").alias("ended"))


@register("a7_threshold_rule")
def a7(spark: SparkSession, folder: str) -> DataFrame:
    by = F.col("entity.area.name").alias("area")
    rows = analyses.threshold_breaches(docs(spark, folder, "decimal"), [by], 1.0, 200.0, "1 day")
    return rows.select(
        "area", stamp("bucket").alias("bucket"), decimal("lowest").alias("lowest"), decimal("highest").alias("highest")
    )


def _trend(rows: DataFrame) -> DataFrame:
    return _trend_columns(analyses.trend(rows))


def _trend_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "floor",
        "area",
        F.col("month").cast("string").alias("month"),
        F.col("level").cast("bigint").alias("level"),
        decimal("average").alias("average"),
        "readings",
    )


@register("a8_area_floor_trend")
def a8(spark: SparkSession, folder: str) -> DataFrame:
    return _trend(docs(spark, folder, "decimal"))


@register("a8_order_trend")
def a8_orders(spark: SparkSession, folder: str) -> DataFrame:
    readings = supplied.order_readings(spark, folder).withColumn("reason", F.lit(fixed.STATE))
    return _trend(publish(readings, lookup(spark, folder), trusted=True))


@register("a8_recorded_trend")
def a8_recorded(spark: SparkSession, folder: str) -> DataFrame:
    """The trend from what was recorded of each slice, one of them twice."""
    path = shared_folder(spark)
    parts = list(_slices(docs(spark, folder, "decimal"), "timestamp"))
    for number, part in [*enumerate(parts), (0, parts[0])]:
        analyses.record_trend(part, path, str(number))
    return _trend_columns(analyses.recorded_trend(spark.read.parquet(path)))


@register("a9_tag_filter")
def a9(spark: SparkSession, folder: str) -> DataFrame:
    rows = analyses.tagged(docs(spark, folder, static=STATIC), "lab")
    return rows.select("seq", "object_id", F.element_at("tags", 1).alias("first_tag"))


@register("a10_latest_value")
def a10(spark: SparkSession, folder: str) -> DataFrame:
    rows = analyses.latest_value(docs(spark, folder, "decimal"))
    return rows.select("entity_id", stamp("timestamp").alias("time"), "value")
