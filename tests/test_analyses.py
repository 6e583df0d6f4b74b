import random
from datetime import UTC, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.operators import enrich
from entity_events.plans import analyses
from entity_events.plans.publish import publish
from entity_events.settings import StaticFields

T0 = datetime(2024, 1, 1, tzinfo=UTC)
FLOORS = [{"floor_id": "f1", "name": "upstairs"}]
AREAS = [{"id": "a1", "name": "attic", "floor_id": "f1"}, {"id": "a2", "name": "barn"}]
ENTITIES = [
    {"entity_id": "t.hot", "domain": "t", "object_id": "hot", "area_id": "a1", "labels": []},
    {"entity_id": "t.cold", "domain": "t", "object_id": "cold", "area_id": "a2", "labels": []},
    {"entity_id": "t.none", "domain": "t", "object_id": "none", "labels": []},
]


def make_feed(seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(400):
        entity = rng.choice(["t.hot"] * 5 + ["t.cold", "t.none"])
        rows.append((entity, T0 + timedelta(minutes=rng.randrange(5 * 1440)), seq, rng.choice(["5", "15", "25.5", "off"]), None))
    return rows


@pytest.fixture(scope="module")
def feed():
    return make_feed(1)


@pytest.fixture(scope="module")
def docs(spark, make_registry, feed):
    lookup = enrich.details_lookup(make_registry(ENTITIES, [], AREAS, FLOORS))
    readings = spark.createDataFrame(feed, schemas.READING).withColumn("reason", F.lit(fixed.STATE))
    return publish(readings, lookup, static=StaticFields(tags=("lab",))).cache()


def per_entity(feed):
    for entity in sorted({row[0] for row in feed}):
        yield entity, sorted((r for r in feed if r[0] == entity), key=lambda r: (r[1], r[2]))


def naive(moment):
    return moment.replace(tzinfo=None)


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_time_in_state_adds_up(docs, feed, hot_rows):
    until = T0 + timedelta(days=6)
    expected = {}
    for entity, rows in per_entity(feed):
        for row, later in zip(rows, [*rows[1:], None]):
            start, end = row[1], later[1] if later else until
            while start < end:
                midnight = start.replace(hour=0, minute=0) + timedelta(days=1)
                stop = min(end, midnight)
                key = (entity, row[3], start.date())
                expected[key] = expected.get(key, 0) + (stop - start).total_seconds()
                start = stop
    rows = analyses.time_in_state(docs, until, hot_rows).collect()
    assert {(r["entity_id"], r["state"], r["day"]): r["seconds"] for r in rows} == expected


@pytest.mark.parametrize("hot_rows", [7, 100_000])
@pytest.mark.parametrize("minutes", [0, 30, 240])
def test_sustained_deviation(docs, feed, hot_rows, minutes):
    expected = set()
    for entity, rows in per_entity(feed):
        run = []
        for row in [*(r for r in rows if r[3] != "off"), None]:
            if row is not None and float(row[3]) > 10:
                run.append(row[1])
                continue
            if run and run[-1] - run[0] >= timedelta(minutes=minutes):
                expected.add((entity, naive(run[0]), naive(run[-1])))
            run = []
    got = analyses.sustained_deviation(docs, F.col("valueas.float") > 10, minutes, hot_rows)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected


def test_value_over_time(docs, feed):
    hourly = analyses.value_over_time(docs, F.col("entity.id") == "t.cold").collect()
    expected = {}
    for row in feed:
        if row[0] == "t.cold" and row[3] != "off":
            expected.setdefault(naive(row[1].replace(minute=0)), []).append(float(row[3]))
    assert {r["bucket"]: (r["lowest"], r["highest"], r["readings"]) for r in hourly} == {
        hour: (min(v), max(v), len(v)) for hour, v in expected.items()
    }
    by_area = analyses.value_over_time(docs, F.col("entity.area.name") == "barn").collect()
    assert sorted(map(tuple, by_area)) == sorted(map(tuple, hourly))


def test_trend_levels(docs, feed):
    rows = {(r["level"], r["floor"], r["area"]): r for r in analyses.trend(docs).collect()}
    numbers = [float(r[3]) for r in feed if r[3] != "off"]
    assert rows[(7, None, None)]["readings"] == len(numbers)
    assert rows[(7, None, None)]["average"] == pytest.approx(sum(numbers) / len(numbers))
    hot = [float(r[3]) for r in feed if r[0] == "t.hot" and r[3] != "off"]
    for level in (0, 1):
        assert rows[(level, "upstairs", "attic")]["average"] == pytest.approx(sum(hot) / len(hot))
    assert rows[(3, "upstairs", None)]["readings"] == len(hot)


def test_recorded_trends_outlive_their_documents(spark, docs, feed, tmp_path):
    path = str(tmp_path / "trend")
    for day in range(5):
        begin = T0 + timedelta(days=day)
        part = docs.where((F.col("timestamp") >= F.lit(begin)) & (F.col("timestamp") < F.lit(begin + timedelta(days=1))))
        for _ in range(2 if day == 3 else 1):  # a batch that is run again counts once
            analyses.record_trend(part, path, f"day-{day}")
    analyses.record_trend(docs.limit(0), path, "none")
    got = analyses.recorded_trend(spark.read.parquet(path), [0.1, 0.5, 0.9])
    key = lambda r: (r["level"], r["floor"], r["area"], r["month"])
    rows = {key(r): r for r in got.collect()}
    whole = {key(r): r for r in analyses.trend(docs).collect()}
    assert rows.keys() == whole.keys()
    for name, row in rows.items():
        assert row["readings"] == whole[name]["readings"]
        assert row["average"] == pytest.approx(whole[name]["average"])
    numbers = sorted(float(r[3]) for r in feed if r[3] != "off")
    for share, value in zip([0.1, 0.5, 0.9], rows[(7, None, None, None)]["quantiles"]):
        below, upto = (sum(test) / len(numbers) for test in ([n < value for n in numbers], [n <= value for n in numbers]))
        assert below - 0.02 <= share <= upto + 0.02


def test_panel_search_threshold_tags_latest(docs, feed):
    panel = analyses.panel(docs, ["t.hot", "t.cold"], "1 day")
    assert panel.columns == ["bucket", "t.hot", "t.cold"]
    assert panel.count() == 5
    day = analyses.search(docs, T0, T0 + timedelta(days=1), ["seq"], F.col("value") == "5")
    wanted = {r[2] for r in feed if r[1] < T0 + timedelta(days=1) and r[3] == "5"}
    assert {r["seq"] for r in day.collect()} == wanted
    breaches = analyses.threshold_breaches(docs, [F.col("entity.id").alias("id")], 0, 20, "1 day")
    hit = {(r[0], naive(r[1].replace(hour=0, minute=0))) for r in feed if r[3] == "25.5"}
    assert {(r["id"], r["bucket"]) for r in breaches.collect()} == hit
    assert analyses.tagged(docs, "lab").count() == len(feed)
    assert analyses.tagged(docs, "other").count() == 0
    assert analyses.tagged(docs.drop("tags"), "lab").count() == 0
    latest = {r["entity_id"]: r["value"] for r in analyses.latest_value(docs).collect()}
    assert latest == {entity: rows[-1][3] for entity, rows in per_entity(feed)}


def test_search_prunes_by_utc_days(spark):
    west = timezone(timedelta(hours=-5))
    moment = datetime(2024, 1, 16, 2, tzinfo=UTC)
    rows = spark.createDataFrame([(moment, "a")], "timestamp timestamp, object_id string")
    rows = rows.withColumn("event_date", F.col("timestamp").cast("date"))
    found = analyses.search(rows, datetime(2024, 1, 15, 20, tzinfo=west), datetime(2024, 1, 15, 23, tzinfo=west), ["object_id"])
    assert found.count() == 1
