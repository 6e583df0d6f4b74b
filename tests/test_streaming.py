import json
import random
import uuid
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.operators import changes, enrich, quality, sinks
from entity_events.plans.publish import publish
from entity_events.settings import Settings
from entity_events.sources import feed as feeds
from entity_events.sources import folders
from entity_events.streaming import keyed
from entity_events.streaming import publish as stream

T0 = datetime(2024, 1, 1, tzinfo=UTC)
ENTITIES = [f"light.l{n}" for n in range(5)]


@pytest.fixture
def registry(make_registry):
    rows = [{"entity_id": e, "domain": "light", "object_id": e[6:], "labels": []} for e in ENTITIES]
    return make_registry(rows)


def feed(first, last):
    """One reading a minute, the states of each entity changing now and then."""
    return [
        (ENTITIES[i % 5], T0 + timedelta(minutes=i), i, "on" if (i // 7) % 2 else "off", '{"n": %d}' % i)
        for i in range(first, last)
    ] + [("light.unknown", T0 + timedelta(minutes=last), 1000 + last, "on", "{}")]


def put(spark, folder, rows, schema=schemas.READING):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, registry, settings=None, ticks=False):
    source = spark.readStream.schema(schemas.READING).option("maxFilesPerTrigger", 1)
    poll = spark.readStream.schema("time timestamp").parquet(f"{tmp_path}/ticks") if ticks else None
    query = stream.start(
        source.parquet(f"{tmp_path}/in"),
        f"{tmp_path}/out",
        lambda: registry,
        settings,
        poll_ticks=poll,
        available_now=True,
    )
    query.awaitTermination()
    return query


def content(documents):
    return sorted(
        tuple(row)
        for row in documents.select(
            "timestamp", "seq", "entity.id", "value", "event.action", F.to_json("attributes")
        ).collect()
    )


def test_stream_equals_batch_over_several_batches_and_restarts(spark, tmp_path, registry):
    for first in (0, 20, 40):
        put(spark, f"{tmp_path}/in", feed(first, first + 20))
    first_id = run(spark, tmp_path, registry).id
    put(spark, f"{tmp_path}/in", feed(60, 80))
    assert run(spark, tmp_path, registry).id == first_id
    whole = spark.read.schema(schemas.READING).parquet(f"{tmp_path}/in")
    expected = publish(changes.classify_readings(whole), enrich.details_lookup(registry))
    got = stream.read_documents(spark, f"{tmp_path}/out")
    assert content(got) == content(expected)
    assert got.select("batch_id").distinct().count() == 4
    refused = spark.read.parquet(f"{tmp_path}/out/quarantine")
    assert {r["entity_id"] for r in refused.collect()} == {"light.unknown"}
    outcomes = spark.read.json(f"{tmp_path}/out/outcomes")
    assert outcomes.agg(F.sum("documents")).first()[0] == 80


def test_a_batch_writes_one_small_file_for_a_stream_and_day(spark, tmp_path, make_registry):
    lights = [f"light.l{n}" for n in range(40)]
    registry = make_registry([{"entity_id": e, "domain": "light", "object_id": e[6:], "labels": []} for e in lights])
    for day in range(2):
        put(spark, f"{tmp_path}/in", [(e, T0 + timedelta(days=day), n, "on", "{}") for n, e in enumerate(lights)])
    run(spark, tmp_path, registry)
    stored = stream.read_documents(spark, f"{tmp_path}/out")
    rows = stored.select("batch_id", "event_date", F.input_file_name().alias("file")).collect()
    assert len(rows) == 80 and len({tuple(row) for row in rows}) == 2


@pytest.mark.parametrize(
    "settings", [Settings(), Settings(include_enabled=True), Settings(change_types=(), poll_seconds=0)]
)
def test_batches_without_documents_do_not_stop_the_stream(spark, tmp_path, registry, settings):
    assert stream.read_documents(spark, f"{tmp_path}/out").count() == 0
    unknown = [("light.unknown", T0 + timedelta(minutes=i), i, "on", "{}") for i in range(3)]
    put(spark, f"{tmp_path}/in", unknown)
    run(spark, tmp_path, registry, settings)
    assert stream.read_documents(spark, f"{tmp_path}/out").count() == 0
    put(spark, f"{tmp_path}/in", feed(0, 20))
    run(spark, tmp_path, registry, settings)
    published = 20 if settings == Settings() else 0
    assert stream.read_documents(spark, f"{tmp_path}/out").count() == published
    outcomes = spark.read.json(f"{tmp_path}/out/outcomes").agg(F.sum("succeeded"), F.sum("failed")).first()
    assert tuple(outcomes) == (published, 4)


def test_a_tick_before_any_reading(spark, tmp_path, registry):
    put(spark, f"{tmp_path}/ticks", [(T0 - timedelta(hours=1),)], "time timestamp")
    put(spark, f"{tmp_path}/in", [], schemas.READING)
    run(spark, tmp_path, registry, Settings(change_types=()), ticks=True)
    put(spark, f"{tmp_path}/in", feed(0, 10))
    put(spark, f"{tmp_path}/ticks", [(T0 + timedelta(hours=1),), (T0 + timedelta(hours=1, seconds=7),)], "time timestamp")
    run(spark, tmp_path, registry, Settings(change_types=()), ticks=True)
    assert stream.read_documents(spark, f"{tmp_path}/out").count() == 10


def test_tags_and_audit_switch_take_effect(spark, tmp_path, registry):
    rows = [("light.l1", T0, 1, "on", '{"icon": "x", "a": 1, " ": 2}')]
    put(spark, f"{tmp_path}/in", rows)
    run(spark, tmp_path, registry, Settings(tags=("lab",), audit_attributes=True))
    assert [r["tags"] for r in stream.read_documents(spark, f"{tmp_path}/out").collect()] == [["lab"]]
    audit = spark.read.parquet(f"{tmp_path}/out/audit").collect()
    assert sorted((r["entity_id"], r["key"]) for r in audit) == [("light.l1", " "), ("light.l1", "icon")]


def test_a_batch_that_failed_is_stored_once(spark, tmp_path, registry, monkeypatch):
    put(spark, f"{tmp_path}/in", feed(0, 20))
    run(spark, tmp_path, registry)
    put(spark, f"{tmp_path}/in", feed(20, 40))

    def broken(*_):
        raise OSError("the output went away after the documents were written")

    with monkeypatch.context() as patched:
        patched.setattr(stream.quality, "quarantined", broken)
        with pytest.raises(Exception, match="went away"):
            run(spark, tmp_path, registry)
    run(spark, tmp_path, registry)
    whole = spark.read.schema(schemas.READING).parquet(f"{tmp_path}/in")
    expected = publish(changes.classify_readings(whole), enrich.details_lookup(registry))
    assert content(stream.read_documents(spark, f"{tmp_path}/out")) == content(expected)


def test_polls_in_the_stream_equal_a_replay(spark, tmp_path, registry):
    ticks = [(T0 + timedelta(minutes=10 * i),) for i in range(5)]
    put(spark, f"{tmp_path}/in", feed(0, 40))
    put(spark, f"{tmp_path}/ticks", ticks, "time timestamp")
    settings = Settings(poll_seconds=600)
    run(spark, tmp_path, registry, settings, ticks=True)
    whole = spark.read.schema(schemas.READING).parquet(f"{tmp_path}/in")
    gathered = changes.merge(
        changes.classify_readings(whole), changes.poll_replay(whole, ticks[0][0], ticks[-1][0], 600)
    )
    expected = publish(gathered, enrich.details_lookup(registry))
    got = stream.read_documents(spark, f"{tmp_path}/out")
    assert content(got) == content(expected)
    assert got.where(F.col("event.action") == "Polling").count() == 25 - 4


def test_polls_alone_follow_the_feed_without_publishing_it(spark, tmp_path, registry):
    put(spark, f"{tmp_path}/in", feed(0, 20))
    put(spark, f"{tmp_path}/ticks", [(T0 + timedelta(minutes=30),)], "time timestamp")
    run(spark, tmp_path, registry, Settings(change_types=(), poll_seconds=60), ticks=True)
    rows = stream.read_documents(spark, f"{tmp_path}/out").select("seq", "event.type").collect()
    assert sorted(map(tuple, rows)) == [(i, "info") for i in range(15, 20)]


def test_a_known_reason_is_kept(spark, tmp_path, registry):
    rows = [(*row, fixed.ATTRIBUTE) for row in feed(0, 10)]
    schema = T.StructType([*schemas.READING.fields, T.StructField("reason", T.StringType())])
    put(spark, f"{tmp_path}/in", rows, schema)
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    query = stream.start(source, f"{tmp_path}/out", lambda: registry, available_now=True)
    query.awaitTermination()
    actions = stream.read_documents(spark, f"{tmp_path}/out").select("event.action").distinct()
    assert [r[0] for r in actions.collect()] == ["Attribute change"]


def plain_reasons(batches):
    """Reasons of batches of (entity, time, seq, state), the newest reading of an entity carried from batch to batch."""
    newest, out = {}, []
    for batch in batches:
        for entity in {row[0] for row in batch}:
            rows = sorted((row for row in batch if row[0] == entity), key=lambda row: row[1:3])
            carried = newest.get(entity)
            line = sorted([*rows, carried] if carried else rows, key=lambda row: (row[1:3], row is not carried))
            for before, row in zip([None, *line], line):
                if row is not carried:
                    changed = before is None or before[3] != row[3]
                    out.append((row[0], row[2], fixed.STATE if changed else fixed.ATTRIBUTE))
            newest[entity] = line[-1]
    return sorted(out)


def test_state_per_entity_follows_the_order_of_times(spark, tmp_path):
    rng = random.Random(3)
    batches, seq = [], 0
    for number in range(4):
        rows = []
        for _ in range(60):
            seq += 1
            at = T0 + timedelta(minutes=20 * number + rng.randrange(-15, 20), microseconds=rng.randrange(3))
            rows.append((f"light.l{rng.randrange(6)}", at, seq, rng.choice(["on", "off", None]), None))
        batches.append(rows)
    got = []
    for number, rows in enumerate(batches):
        put(spark, f"{tmp_path}/in", rows)
        source = spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in")
        query = (
            keyed.classified(source)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{tmp_path}/out")
        )
        query.awaitTermination()
        # A batch changes the state of no other entity than its own.
        updated = sum(o.numRowsUpdated for p in query.recentProgress for o in p.stateOperators)
        assert updated <= len({row[0] for row in rows})
        got = spark.read.parquet(f"{tmp_path}/out").select("entity_id", "seq", "reason", "time").collect()
        assert len(got) == 60 * (number + 1)
    assert sorted((r["entity_id"], r["seq"], r["reason"]) for r in got) == plain_reasons([[row[:4] for row in b] for b in batches])
    assert {r["seq"]: r["time"] for r in got} == {row[2]: row[1].replace(tzinfo=None) for b in batches for row in b}


def test_copies_in_later_batches_are_left_out_and_counted(spark, tmp_path, registry):
    put(spark, f"{tmp_path}/in", feed(0, 40))
    query = stream.start(
        spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in"),
        f"{tmp_path}/out",
        lambda: registry,
        available_now=True,
        first_within="15 minutes",
    )
    query.awaitTermination()
    copies = [(*row[:2], row[2] + 500, "late copy", row[4]) for row in feed(30, 40)[:-1]]
    late = [(ENTITIES[0], T0, 900, "on", "{}")]
    put(spark, f"{tmp_path}/in", copies + late + feed(40, 45))
    query = stream.start(
        spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in"),
        f"{tmp_path}/out",
        lambda: registry,
        available_now=True,
        first_within="15 minutes",
    )
    query.awaitTermination()
    stored = stream.read_documents(spark, f"{tmp_path}/out")
    assert sorted(r["seq"] for r in stored.select("seq").collect()) == list(range(45))
    assert keyed.left_out(query) == {"late": 1, "copies": 10}


def test_executors_hold_points_only_while_a_task_works(spark, tmp_path, registry):
    def reused(out, **options):
        source = spark.readStream.schema(schemas.READING).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = stream.start(source, f"{tmp_path}/{out}", lambda: registry, available_now=True, **options)
        query.awaitTermination()
        metrics = [o.customMetrics for p in query.recentProgress for o in p.stateOperators]
        return sum(int(each["loadedMapCacheHitCount"]) for each in metrics)

    for number in range(3):
        put(spark, f"{tmp_path}/in", feed(10 * number, 10 * number + 15))
    setting = "spark.sql.streaming.stateStore.unloadOnCommit"
    before = spark.conf.get(setting)
    assert reused("points", first_within="1 hour") == 0
    stored = stream.read_documents(spark, f"{tmp_path}/points").select("seq").collect()
    assert sorted(r["seq"] for r in stored) == list(range(35))
    # Other streams are started as before.
    assert spark.conf.get(setting) == before
    assert reused("plain") > 0


def test_lines_that_cannot_be_read_reach_the_quarantine(spark, tmp_path, registry):
    (tmp_path / "lines").mkdir()
    for number in range(3):
        state = {"entity_id": ENTITIES[number], "state": "on", "attributes": "{}"}
        good = json.dumps({"time_fired": "2024-01-01T00:00:00Z", "new_state": state})
        (tmp_path / "lines" / f"{number}.json").write_text(f"{good}\n{good[: 30 + number]}\nno event\n")
        for _ in range(2):  # nothing new the second time
            events = feeds.stream_events(spark, str(tmp_path / "lines"), maxFilesPerTrigger="1")
            query = stream.start(
                changes.classify_events(events), f"{tmp_path}/out", lambda: registry, available_now=True, first_within="1 hour"
            )
            query.awaitTermination()
    refused = spark.read.parquet(f"{tmp_path}/out/quarantine").collect()
    assert len(refused) == 6 and {r["error"] for r in refused} == {quality.UNREADABLE_LINE}
    assert stream.read_documents(spark, f"{tmp_path}/out").count() == 3


def test_runs_are_told_once_while_they_last(spark, tmp_path):
    def at(minute, out, entity="a"):
        return entity, T0 + timedelta(minutes=minute), minute, out

    batches = [
        [at(0, True), at(5, True), at(0, False, "b"), at(3, True, "b")],
        [at(10, True), at(12, True), at(13, False), at(14, True), at(20, True, "b")],
        [at(11, False), at(20, True), at(30, True), at(40, None), at(41, True), at(55, True, "b")],
    ]
    for rows in batches:
        put(spark, f"{tmp_path}/in", rows, "entity_id string, time timestamp, seq long, out boolean")
        source = spark.readStream.schema("entity_id string, time timestamp, seq long, out boolean").parquet(f"{tmp_path}/in")
        query = (
            keyed.running_deviation(source, F.col("out"), 10)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{tmp_path}/out")
        )
        query.awaitTermination()
    minutes = lambda moment: int((moment.replace(tzinfo=UTC) - T0).total_seconds() // 60)
    told = sorted((r["entity_id"], minutes(r["started"]), minutes(r["reached"])) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert told == [("a", 0, 10), ("a", 14, 30), ("b", 3, 20)]


def test_batches_are_folded_once_whenever_the_job_ends(spark, tmp_path, registry, monkeypatch):
    out, table = f"{tmp_path}/out", f"{tmp_path}/table"
    assert stream.fold(spark, out, table) == sinks.Outcome(0, 0, 0)
    put(spark, f"{tmp_path}/in", feed(0, 20))
    run(spark, tmp_path, registry)
    put(spark, f"{tmp_path}/in", [("light.unknown", T0, 1, "on", "{}")])
    run(spark, tmp_path, registry)
    put(spark, f"{tmp_path}/in", feed(20, 40))
    run(spark, tmp_path, registry)

    def ended(*_):
        raise OSError("the job ended before it wrote its log")

    with monkeypatch.context() as patched:
        patched.setattr(spark, "createDataFrame", ended)
        with pytest.raises(Exception, match="its log|created"):
            stream.fold(spark, out, table)
    assert stream.fold(spark, out, table).refused in (0, 40)
    assert stream.fold(spark, out, table) == sinks.Outcome(0, 0, 0)
    assert sorted(r["seq"] for r in spark.read.parquet(table).select("seq").collect()) == list(range(40))
    assert stream.drop_folded(spark, out, table) == 3
    assert stream.drop_folded(spark, out, table) == 0
    put(spark, f"{tmp_path}/in", feed(40, 50))
    run(spark, tmp_path, registry)
    assert stream.fold(spark, out, table) == sinks.Outcome(10, 0, 0)
    assert spark.read.parquet(table).count() == 50


def test_hooks_run_in_order_and_may_not_lose_a_place(spark, tmp_path, registry):
    def counted(rows):
        return rows.withColumn("n", F.col("attributes")["n"].cast("int"))

    def even(rows):
        return rows.where("n % 2 = 0")

    def careless(rows):
        return rows.drop("object_id")

    put(spark, f"{tmp_path}/in", feed(0, 20))
    source = spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in")
    stream.start(source, f"{tmp_path}/out", lambda: registry, available_now=True, hooks=(counted, even)).awaitTermination()
    assert sorted(r["n"] for r in stream.read_documents(spark, f"{tmp_path}/out").select("n").collect()) == list(range(0, 20, 2))
    rows = spark.read.schema(schemas.READING).parquet(f"{tmp_path}/in").withColumn("reason", F.lit(fixed.STATE))
    with pytest.raises(ValueError, match="careless loses or changes object_id"):
        publish(rows, enrich.details_lookup(registry), hooks=(counted, careless))


def test_newest_readings_are_kept_as_a_whole_and_parts(spark, tmp_path, registry):
    settings = Settings(change_types=(), poll_seconds=600)
    put(spark, f"{tmp_path}/ticks", [(T0 + timedelta(minutes=5),)], "time timestamp")
    for first in range(0, 40, 10):
        put(spark, f"{tmp_path}/in", feed(first, first + 10))
        if first == 30:
            put(spark, f"{tmp_path}/ticks", [(T0 + timedelta(hours=2),)], "time timestamp")
        query_id = run(spark, tmp_path, registry, settings, ticks=True).id
    root = f"{tmp_path}/out/latest/query_id={query_id}"
    whole = list(map(int, folders.values(spark, f"{root}/kind=whole", "batch_id")))
    assert len(whole) == 2 and folders.values(spark, f"{root}/kind=part", "batch_id")
    polled = stream.read_documents(spark, f"{tmp_path}/out").where("timestamp > '2024-01-01 01:00:00'")
    assert sorted(r["seq"] for r in polled.select("seq").collect()) == list(range(35, 40))
    newest = spark.read.schema(schemas.READING).parquet(f"{root}/kind=whole/batch_id={max(whole)}")
    assert newest.where("entity_id LIKE 'light.l%'").count() == 5


def test_publishing_can_be_off(spark, tmp_path, registry):
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in")
    off = Settings(publish_seconds=0)
    assert stream.start(source, str(tmp_path / "out"), lambda: registry, off) is None


def test_wall_clock_ticks(spark, tmp_path):
    ticks = stream.ticks(spark, 1)
    name = f"ticks_{uuid.uuid4().hex}"
    query = (
        ticks.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start()
    )
    try:
        for _ in range(40):
            query.processAllAvailable()
            if spark.table(name).count() >= 2:
                break
            query.awaitTermination(0.5)
        times = [r["time"] for r in spark.table(name).collect()]
    finally:
        query.stop()
    assert len(times) >= 2
    assert all(t.microsecond == 0 for t in times)


def test_a_tick_when_the_stream_starts(spark, tmp_path):
    name = f"ticks_{uuid.uuid4().hex}"
    writer = stream.ticks(spark, 365 * 24 * 3600).writeStream.format("memory").queryName(name)
    query = writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    try:
        for _ in range(20):
            query.awaitTermination(0.5)
            if spark.table(name).count():
                break
        assert spark.table(name).count() == 1
    finally:
        query.stop()


def test_entities_share_the_state_rows_of_their_group(spark, tmp_path):
    rng = random.Random(5)
    batches = [
        [(f"light.l{n}", T0 + timedelta(minutes=10 * b + rng.randrange(15)), 1000 * b + n, rng.choice(["on", "off", None]), None) for n in range(100)]
        for b in range(2)
    ]
    alerts = []
    for rows in batches:
        put(spark, f"{tmp_path}/in", rows + [(None, T0, 9000, "on", None)])
        for name, build in (
            ("reasons", lambda source: keyed.classified(source, groups=4)),
            ("runs", lambda source: keyed.running_deviation(source, F.col("state") == "on", 5, groups=4)),
        ):
            source = spark.readStream.schema(schemas.READING).parquet(f"{tmp_path}/in")
            query = (
                build(source)
                .writeStream.format("parquet")
                .option("checkpointLocation", f"{tmp_path}/checkpoint-{name}")
                .trigger(availableNow=True)
                .start(f"{tmp_path}/{name}")
            )
            query.awaitTermination()
            assert max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators) <= 4
    got = spark.read.parquet(f"{tmp_path}/reasons").select("entity_id", "seq", "reason").collect()
    assert [r["reason"] for r in got if r["entity_id"] is None] == [None, None]
    told = sorted((r["entity_id"], r["seq"], r["reason"]) for r in got if r["entity_id"])
    assert told == plain_reasons([[row[:4] for row in rows] for rows in batches])
    for first, then in zip(*batches):
        if first[3] == then[3] == "on" and then[1] - first[1] >= timedelta(minutes=5):
            alerts.append((first[0], first[1].replace(tzinfo=None), then[1].replace(tzinfo=None)))
    assert alerts and sorted(map(tuple, spark.read.parquet(f"{tmp_path}/runs").collect())) == sorted(alerts)
