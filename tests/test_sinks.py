import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.functions import text
from entity_events.operators import changes, enrich, manifest, quality, sinks
from entity_events.plans.publish import publish
from entity_events.sources import feed

T0 = datetime(2024, 1, 1, tzinfo=UTC)
STREAM = f"{fixed.STREAM_TYPE}-{fixed.DATASET_PREFIX}.{{}}-{fixed.STREAM_NAMESPACE}"


@pytest.fixture(scope="module")
def lookup(make_registry):
    entities = [
        {"entity_id": name, "domain": name.split(".")[0], "object_id": "a", "labels": []}
        for name in ("light.a", "sensor.a")
    ]
    return enrich.details_lookup(make_registry(entities))


def readings(spark, rows):
    frame = spark.createDataFrame(rows, schemas.READING)
    return frame.withColumn("reason", F.lit(fixed.STATE))


def some(spark):
    return readings(
        spark,
        [
            ("light.a", T0 + timedelta(days=d), d * 10 + copy, f"{d}", '{"k": 1}')
            for d in range(3)
            for copy in range(3)
        ]
        + [("sensor.a", T0, 99, "on", None)],
    )


def test_one_document_per_point(spark, lookup):
    docs = publish(some(spark), lookup)
    kept = quality.first_per_point(docs)
    assert kept.columns == docs.columns
    assert sorted(r["seq"] for r in kept.collect()) == [0, 10, 20, 99]
    assert kept.where("seq = 10").select(F.to_json("attributes")).first()[0] == '{"k":1}'


def test_one_document_per_point_in_a_stream(spark, lookup, tmp_path):
    some(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(some(spark).schema).parquet(str(tmp_path / "in"))
    rows = quality.first_per_point_stream(publish(stream, lookup), "1 day")
    query = (
        rows.select("object_id", "timestamp", "data_stream")
        .writeStream.format("memory")
        .queryName("points")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("points").count() == 4


def test_retention(spark, lookup):
    docs = publish(some(spark), lookup)
    as_of = T0 + timedelta(days=fixed.RETENTION_DAYS + 1)
    assert quality.retained(docs, as_of).count() == 6
    assert quality.retained(sinks.table_layout(docs), as_of).count() == 6


def test_expired_folders_are_dropped_by_name(spark, lookup, tmp_path):
    table = tmp_path / "t"
    sinks.append(publish(some(spark), lookup), str(table))
    as_of = T0 + timedelta(days=fixed.RETENTION_DAYS + 1, hours=5)
    kept = {f: f.read_bytes() for f in table.rglob("*.parquet") if "event_date=2024-01-01" not in str(f)}
    dropped = sinks.drop_expired(spark, str(table), as_of)
    assert sorted(each.split("/")[1:] for each in dropped) == [
        [f"dataset={fixed.DATASET_PREFIX}.{name}", "event_date=2024-01-01"] for name in ("light", "sensor")
    ]
    assert {f: f.read_bytes() for f in table.rglob("*.parquet")} == kept
    assert sinks.drop_expired(spark, str(table), as_of) == []
    assert sinks.drop_expired(spark, str(tmp_path / "none"), as_of) == []


def test_stream_constants(spark, lookup):
    actions = sinks.envelope(publish(some(spark), lookup))
    rows = {r["_index"]: (r["documents"], r["constant"]) for r in quality.stream_constants(actions).collect()}
    assert rows == {STREAM.format("light"): (9, True), STREAM.format("sensor"): (1, True)}
    mixed = actions.withColumn("_index", F.lit("one"))
    assert quality.stream_constants(mixed).first()["constant"] is False


def test_quarantine_and_documents_share_the_readings(spark, lookup):
    rows = readings(
        spark,
        [
            ("light.a", T0, 1, "on", "{}"),
            ("light.gone", T0, 2, "on", "{}"),
            ("light.a", T0, 3, "on", "{broken"),
            ("sensor.a", T0, 4, "on", None),
        ],
    )
    refused = {r["seq"]: r["error"] for r in quality.quarantined(rows, lookup).collect()}
    assert refused == {2: quality.UNKNOWN_ENTITY, 3: quality.UNREADABLE}
    assert sorted(r["seq"] for r in publish(rows, lookup).collect()) == [1, 4]


def test_envelope(spark, lookup):
    row = sinks.envelope(publish(some(spark).where("seq = 99"), lookup)).first()
    assert (row["_op_type"], row["_index"]) == (fixed.CREATE, STREAM.format("sensor"))
    assert row["_source"]["value"] == "on"


def test_append_and_read_back(spark, lookup, tmp_path):
    docs = publish(some(spark), lookup)
    for _ in range(2):
        sinks.append(docs, str(tmp_path / "t"))
    late = readings(spark, [("light.a", T0 + timedelta(days=1, hours=1), 200, "on", None), ("light.a", T0, 201, "off", None)])
    sinks.append(publish(late, lookup), str(tmp_path / "t"))
    sinks.append(docs.where("seq = 99"), str(tmp_path / "t"), generation=2)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert sorted((r["generation"], r["seq"]) for r in stored.collect()) == [(1, 0), (1, 10), (1, 20), (1, 99), (1, 200)]
    assert stored.where("seq = 99").select("dataset").first()[0] == fixed.DATASET_PREFIX + ".sensor"
    plan = stored.where("dataset = 'x' AND event_date > DATE '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    assert stored.where("seq = 10").select(F.col("attributes")["k"].cast("int")).first()[0] == 1
    sinks.replace_part(docs, str(tmp_path / "p"))
    sinks.replace_part(docs, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 10


FAILED = {"errors": True, "items": [{"create": {"_index": "i1", "status": 429, "error": {"type": "busy", "reason": "queue is full"}}}]}
DONE = {"errors": False, "items": [{"create": {"_index": "i2", "status": 200}}, {"create": {"_index": "i3", "status": 201}}]}


def test_bulk_response(spark):
    bodies = [(1, json.dumps(FAILED)), (2, json.dumps(DONE)), (3, '{"errors": false, "items": []}')]
    items = sinks.bulk_items(spark.createDataFrame(bodies, "batch_id long, response string"))
    rows = [tuple(r) for r in items.orderBy("batch_id", "position").collect()]
    assert rows == [
        (1, 0, "create", False, 429, "i1", "busy", "queue is full"),
        (2, 0, "create", True, 200, "i2", None, None),
        (2, 1, "create", True, 201, "i3", None, None),
    ]
    counts = sinks.outcome_counts(items).orderBy("batch_id").collect()
    assert [tuple(c) for c in counts] == [(1, 1, 0, 1), (2, 2, 2, 0)]


def test_schema_is_installed_updated_and_kept(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert manifest.ensure_schema(spark, path, version=1) == manifest.INSTALL
    assert manifest.ensure_schema(spark, path, version=1) == manifest.KEEP
    streams = [(STREAM.format("sensor"), 1, 1), (STREAM.format("counter"), 1, 4), ("metrics-other.x-default", 1, 1)]
    spark.createDataFrame(streams, schemas.MANIFEST).write.mode("append").json(path)
    assert manifest.ensure_schema(spark, path) == manifest.UPDATE
    state = {r["name"]: (r["schema_version"], r["generation"]) for r in manifest.current(manifest.read(spark, path)).collect()}
    assert state == {
        manifest.SCHEMA_NAME: (fixed.SCHEMA_VERSION, 2),
        STREAM.format("sensor"): (fixed.SCHEMA_VERSION, 2),
        STREAM.format("counter"): (fixed.SCHEMA_VERSION, 5),
        "metrics-other.x-default": (1, 1),
    }
    streams = [STREAM.format("sensor"), STREAM.format("new")]
    assert manifest.join_streams(spark, path, streams) == {streams[0]: 2, streams[1]: 1}
    assert manifest.current(manifest.read(spark, path)).where(F.col("name") == streams[1]).count() == 1
    assert manifest.ensure_schema(spark, path) == manifest.KEEP
    assert manifest.ensure_schema(spark, path, version=3) == manifest.UPDATE


def test_each_stream_is_written_to_its_generation(spark, lookup, tmp_path):
    table = str(tmp_path / "t")
    record = sinks.manifest_path(table)
    docs = publish(some(spark), lookup)
    lights = docs.where("data_stream.dataset LIKE '%light'")
    manifest.ensure_schema(spark, record, version=1)
    assert sinks.append(lights, table) == sinks.Outcome(3, 6, 0)
    manifest.ensure_schema(spark, record)
    assert sinks.append(docs, table) == sinks.Outcome(1, 9, 0)
    assert sinks.append(docs, table) == sinks.Outcome(0, 10, 0)
    late = readings(spark, [("light.a", T0 + timedelta(days=1, hours=1), 200, "on", None)])
    assert sinks.append(publish(late, lookup), table) == sinks.Outcome(1, 0, 0)
    rows = spark.read.parquet(table).groupBy("generation", "dataset").count().collect()
    short = {(r["generation"], r["dataset"].split(".")[1]): r["count"] for r in rows}
    assert short == {(1, "light"): 3, (1, "sensor"): 1, (2, "light"): 1}
    state = {r["name"]: r["generation"] for r in manifest.current(manifest.read(spark, record)).collect()}
    assert state == {manifest.SCHEMA_NAME: 2, STREAM.format("light"): 2, STREAM.format("sensor"): 1}


def test_an_append_reads_only_the_folders_of_its_days(spark, lookup, tmp_path):
    table = str(tmp_path / "t")
    docs = publish(some(spark), lookup)
    sinks.append(docs, table)
    batch = docs.where("seq >= 10 AND seq < 99")
    touched, complete, failed = sinks.touched_by(batch)
    assert (complete, failed) == (6, 0)
    first = (T0 + timedelta(days=1)).date()
    assert [each.ranges() for each in touched] == [[(first, first + timedelta(days=1))]]
    points = sinks.stored_points(spark, table, touched)
    assert len(points.inputFiles()) == len(spark.read.parquet(table).inputFiles())
    scan = points._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert points.count() == 2
    gaps = sinks.Touched("s", "d", (first, first + timedelta(days=3), first + timedelta(days=4)))
    assert len(gaps.ranges()) == 2


def test_documents_without_a_point_fail(spark, lookup, tmp_path):
    rows = readings(spark, [("light.a", None, 1, "on", None), ("light.a", T0, 2, "on", None)])
    docs = publish(rows, lookup)
    assert sinks.append(docs, str(tmp_path / "t")) == sinks.Outcome(1, 0, 1)
    assert sinks.append(docs.where("timestamp IS NULL"), str(tmp_path / "t")) == sinks.Outcome(0, 0, 1)


def test_no_feed_line_is_lost(spark, lookup, tmp_path):
    state = {"entity_id": "light.a", "state": "on", "attributes": "{}", "last_updated": "2024-01-01T00:00:01Z"}
    good = json.dumps({"time_fired": "2024-01-01T00:00:00Z", "old_state": None, "new_state": state})
    removal = json.dumps({"time_fired": "2024-01-01T00:00:00Z", "old_state": state, "new_state": None})
    bad = [good[:40], "[1, 2]", "{}", '{"time_fired": "yesterday", "new_state": {"state": "on"}}', "plain text", '{"time_fired": 7']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([good, "", removal, *bad]) + "\n")
    events = feed.read_events(spark, str(tmp_path / "in"))
    assert events.count() == 2 + len(bad)
    kept = changes.classify_events(events)
    assert kept.where("unreadable_line IS NULL").select("seq", "reason").collect() == [(1_704_067_201_000_000, fixed.STATE)]
    refused = quality.quarantined(kept, lookup).collect()
    assert sorted(r["unreadable_line"] for r in refused) == sorted(bad)
    assert {r["error"] for r in refused} == {quality.UNREADABLE_LINE}
    assert publish(kept, lookup).count() == 1
    bodies = spark.createDataFrame([(line.encode(),) for line in bad] + [(None,), (b" ",)], "value binary")
    assert feed.parse_events(bodies).where("unreadable_line IS NOT NULL").count() == len(bad)


def test_feeds_and_registries_from_files(spark, make_registry, tmp_path):
    state = {"entity_id": "light.a", "state": "on", "attributes": "{}", "last_changed": "2024-01-01T00:00:00Z"}
    event = json.dumps({"time_fired": "2024-01-01T00:00:00Z", "new_state": state})
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "one.json").write_text(event + "\n")
    path = str(tmp_path / "events")
    assert feed.read_events(spark, path).first()["new_state"]["state"] == "on"
    assert feed.stream_events(spark, path, maxFilesPerTrigger="1").isStreaming
    messages = spark.createDataFrame([(bytearray(event.encode()),)], "value binary")
    assert feed.parse_events(messages).first()["new_state"]["entity_id"] == "light.a"
    registry = make_registry([{"entity_id": "light.a", "domain": "light", "labels": ["b", "a"]}])
    for name, table in {"entity": registry.entities, "device": registry.devices, "area": registry.areas, "floor": registry.floors}.items():
        table.write.parquet(str(tmp_path / "registry" / name))
    stored = feed.read_registry(spark, str(tmp_path / "registry"))
    details = enrich.entity_details(stored).first()["details"]
    assert (details["id"], details["labels"]) == ("light.a", ["a", "b"])
    some(spark).drop("reason").write.parquet(str(tmp_path / "readings"))
    assert feed.read_readings(spark, str(tmp_path / "readings")).count() == 10


def test_event_texts(spark):
    rows = spark.createDataFrame([(r,) for r in (fixed.STATE, fixed.ATTRIBUTE, fixed.POLLING)], "r string")
    got = rows.select(text.action_text(F.col("r")), text.event_type(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("State change", "change"), ("Attribute change", "change"), ("Polling", "info")]
