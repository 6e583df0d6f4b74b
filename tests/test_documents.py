import json
from datetime import UTC, datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.operators import documents, enrich, sinks
from entity_events.plans.publish import publish
from entity_events.settings import StaticFields
from entity_events.sources import feed
from tests import home

NOON = datetime(2031, 5, 6, 12, tzinfo=UTC)
READING = "entity_id string, time timestamp, seq long, state string, attributes string, reason string"
SIMPLE = {"depth": 3, "note": "dry soil", "level": 0.25}
E = fixed.ENTITY_FIELD


def lines(spark, registry, state, reason=fixed.STATE, attributes=None, static=None):
    row = (home.ENTITY_ID, NOON, 1, state, json.dumps(attributes or {}), reason)
    readings = spark.createDataFrame([row], READING)
    rows = publish(readings, enrich.details_lookup(registry), static=static)
    return [r["value"] for r in sinks.bulk_text(rows).collect()]


def document(*args, **given):
    (line,) = lines(*args, **given)
    return json.loads(line.split("\n")[1])


def expected_details(entity_area, entity_floor, entity_labels, device_area, device_floor, device_labels):
    kept = ("name", "domain", "device_class", "platform", "unit_of_measurement")
    fields = {"id": home.ENTITY_ID, **{name: home.ENTITY[name] for name in kept}}
    fields |= {"friendly_name": "north bench", "object.id": "north_bench", "device.id": home.DEVICE_ID, "device.name": "Probe"}
    if entity_area:
        fields |= {"area.id": "bench", "area.name": "Bench"}
        if entity_floor:
            fields |= {"area.floor.id": "ground", "area.floor.name": "Ground"}
    if device_area:
        fields |= {"device.area.id": "shed", "device.area.name": "Shed"}
        if device_floor:
            fields |= {"device.area.floor.id": "gallery", "device.area.floor.name": "Gallery"}
    if entity_labels:
        fields["labels"] = home.ENTITY_LABELS
    if device_labels:
        fields["device.labels"] = home.DEVICE_LABELS
    return {f"{E}.{name}": value for name, value in fields.items()}


# With or without an area, a floor of the area, and labels; a floor needs an area.
PLACES = [(area, floor, labels) for area, floor, labels in product([True, False], repeat=3) if area or not floor]
#: State, reason, attributes given and published, and the typed state.
STATES = [
    ("leaking", fixed.STATE, SIMPLE, SIMPLE, {"string": "leaking"}),
    ("-4.75", fixed.STATE, {}, {}, {"float": -4.75}),
    ("40", fixed.ATTRIBUTE, {"Pump Speed": 1, "pump_speed": 9, "fault": None}, {"pump_speed": 9}, {"float": 40.0}),
    ("off", fixed.POLLING, {"  ": "no name"}, {}, {"boolean": False}),
    (
        "2031-05-06T07:08:09+02:00",
        fixed.POLLING,
        SIMPLE,
        SIMPLE,
        {"date": "2031-05-06", "datetime": "2031-05-06T07:08:09+02:00", "time": "07:08:09"},
    ),
]


@pytest.mark.parametrize(("entity", "device"), list(zip(PLACES * len(PLACES), [p for p in PLACES for _ in PLACES])))
def test_whole_documents(spark, make_registry, entity, device):
    registry = make_registry(
        [home.entity(entity[0], entity[2])],
        [home.device(device[0], device[2])],
        home.areas(entity[1], device[1]),
        home.FLOORS,
    )
    rows = [
        (home.ENTITY_ID, NOON, i, state, json.dumps(attributes), reason)
        for i, (state, reason, attributes, *_) in enumerate(STATES)
    ]
    readings = spark.createDataFrame(rows, READING)
    docs = publish(readings, enrich.details_lookup(registry))
    got = docs.select("seq", documents.document_line(docs).alias("line")).collect()
    for row in got:
        state, reason, _, published, valueas = STATES[row["seq"]]
        assert json.loads(row["line"]) == {
            fixed.TIMESTAMP_FIELD: "2031-05-06T12:00:00+00:00",
            "event.action": fixed.ACTION_TEXT[reason],
            "event.kind": "event",
            "event.type": "info" if reason == fixed.POLLING else "change",
            **expected_details(*entity, *device),
            f"{E}.value": state,
            **{f"{E}.valueas.{kind}": value for kind, value in valueas.items()},
            **{f"{E}.attributes.{k}": v for k, v in published.items()},
            "data_stream.type": fixed.STREAM_TYPE,
            "data_stream.dataset": fixed.DATASET_PREFIX + ".sensor",
            "data_stream.namespace": fixed.STREAM_NAMESPACE,
        }
    assert len(got) == len(STATES)


def test_bulk_text_of_a_polled_reading(spark, make_registry):
    registry = make_registry([home.entity()], [home.device()], home.areas(), home.FLOORS)
    static = StaticFields("4.2", "riscv", "Plan 9", "shed-pi", 12.5, -7.0)
    (text,) = lines(spark, registry, "value", fixed.POLLING, static=static)
    action, line = text.split("\n")
    stream = f"{fixed.STREAM_TYPE}-{fixed.DATASET_PREFIX}.sensor-{fixed.STREAM_NAMESPACE}"
    assert action == '{"create":{"_index":"' + stream + '"}}'
    assert list(json.loads(line))[:5] == [
        fixed.TIMESTAMP_FIELD, "event.action", "event.kind", "event.type", f"{E}.id",
    ]
    assert line.endswith(
        f'"{E}.value":"value","{E}.valueas.string":"value","{E}.object.id":"north_bench",'
        f'"data_stream.type":"{fixed.STREAM_TYPE}","data_stream.dataset":"{fixed.DATASET_PREFIX}.sensor",'
        f'"data_stream.namespace":"{fixed.STREAM_NAMESPACE}","agent.version":"4.2",'
        '"host.architecture":"riscv","host.os.name":"Plan 9","host.hostname":"shed-pi",'
        '"host.location":[12.5,-7.0]}'
    )


def test_location_friendly_name_and_tags(spark, make_registry):
    registry = make_registry([home.entity(device_id=None)])
    given = {"latitude": 1.0, "longitude": 2.5, "friendly_name": "Shown"}
    got = document(spark, registry, "on", attributes=given, static=StaticFields(tags=("a", "b")))
    assert got[f"{E}.location"] == [2.5, 1.0]
    assert got[f"{E}.friendly_name"] == "Shown"
    assert f"{E}.attributes.friendly_name" not in got
    assert got["tags"] == ["a", "b"]
    assert not any(name.startswith(f"{E}.device.") for name in got)


def test_missing_rows_leave_their_part_out(spark, make_registry):
    registry = make_registry([home.entity()])
    got = document(spark, registry, "on")
    assert not any(name.startswith((f"{E}.device.", f"{E}.area.")) for name in got)
    assert lines(spark, make_registry(), "on") == []


def test_flatten_and_prepare(spark):
    nested = spark.sql(
        "SELECT 1 AS a, struct(2 AS c, struct(array(5, 6) AS e) AS d) AS b, '' AS f, 0 AS g, false AS h, "
        "CAST(array() AS array<int>) AS i, CAST(map() AS map<string,int>) AS j, CAST(NULL AS string) AS k"
    )
    flat = documents.flatten(nested)
    assert flat.columns == ["a", "b.c", "b.d.e", "f", "g", "h", "i", "j", "k"]
    ready = documents.prepare(nested)
    assert tuple(ready.first()) == (1, 2, [5, 6], "", 0, False, None, None, None)
    assert documents.prepare(nested, keep=["b.c", "f"]).columns == ["b.c", "f"]
    assert documents.keep_columns(flat, ["a"], ["b."]).columns == ["a", "b.c", "b.d.e"]
    assert documents.keep_columns(flat).columns == []
    assert documents.flatten(nested, {"b": "x.y"}).columns[1:3] == ["x.y.c", "x.y.d.e"]


def test_override_wins(spark):
    flat = spark.createDataFrame([("a", "b")], "`event.kind` string, other string")
    row = documents.override(flat, {"event.kind": "x", "new.field": 1}).first()
    assert row.asDict() == {"event.kind": "x", "other": "b", "new.field": 1}


def test_static_fields_share_their_parents(spark):
    rows = documents.with_static(spark.range(1), StaticFields("1", "x86", "Linux", "h"))
    assert rows.columns == ["id", "agent", "host"]
    assert rows.select("host.os.name", "host.hostname", F.col("agent.version")).first() == ("Linux", "h", "1")


def test_search_columns_leave_out_what_does_not_fit(spark, make_registry):
    registry = make_registry([home.entity()], [home.device()], home.areas(), home.FLOORS)
    long = "x" * (fixed.KEYWORD_LIMIT + 1)
    states = ["12.7", "1e12", "2024-02-29T10:00:00Z", "2024-02-30T10:00:00Z", "2024-02-28", long, "on"]
    rows = [(home.ENTITY_ID, NOON, i, state, json.dumps({"n": 1, "long": long}), fixed.STATE) for i, state in enumerate(states)]
    docs = publish(spark.createDataFrame(rows, READING), enrich.details_lookup(registry))
    found = documents.with_search_columns(docs)
    assert found.columns == [*docs.columns, "search"]
    got = [tuple(r) for r in found.orderBy("seq").select("search.value_keyword", "search.integer", F.col("search.date").cast("string"), "search.time").collect()]
    assert got == [
        ("12.7", 12, None, None),
        ("1e12", None, None, None),
        (states[2], None, "2024-02-29", "10:00:00Z"),
        (states[3], None, None, "10:00:00Z"),
        (states[4], None, "2024-02-28", None),
        (None, None, None, None),
        ("on", None, None, None),
    ]
    assert found.select("search.attributes").first()[0] == {"n": "1"}


def test_entities_without_device_or_area_do_not_meet_in_one_task(spark, make_registry):
    rows = [{"entity_id": f"light.l{n}", "domain": "light", "object_id": f"l{n}", "labels": []} for n in range(800)]
    rows += [{**rows[0], "entity_id": "light.-1", "device_id": "-1"}, {**rows[0], "entity_id": "light.d", "device_id": "d"}]
    devices = [{"id": "d", "name": "D", "labels": []}, {"id": None, "name": "none", "labels": []}]
    registry = make_registry(rows, devices, [{"id": "a", "name": "A"}], [])
    shuffled = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in shuffled}
    try:
        for name, value in shuffled.items():
            spark.conf.set(name, value)
        details = enrich.entity_details(registry)
        tasks = details.groupBy(F.spark_partition_id()).count().collect()
        found = details.select("entity_id", "details.device.name").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(row["count"] for row in tasks) < 200
    assert len(found) == 802 and [row["entity_id"] for row in found if row["name"]] == ["light.d"]


def test_entities_of_one_file_are_detailed_in_several_tasks(spark, tmp_path, make_registry):
    rows = [{"entity_id": f"light.l{n}", "domain": "light", "object_id": f"l{n}", "labels": []} for n in range(200)]
    rows += [{**rows[0], "entity_id": None}, rows[0]]
    registry = make_registry(rows, [{"id": "d", "name": "D", "labels": []}], [{"id": "a", "name": "A"}], [])
    for name, table in zip(("entity", "device", "area", "floor"), (registry.entities, registry.devices, registry.areas, registry.floors)):
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    details = enrich.entity_details(feed.read_registry(spark, str(tmp_path)), in_task=20)
    tasks = details.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 5 and max(row["count"] for row in tasks) < 60
    assert sorted(map(str, (row["entity_id"] for row in details.collect()))) == sorted(str(row["entity_id"]) for row in rows)
