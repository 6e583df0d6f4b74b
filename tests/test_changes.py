import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.operators import changes
from entity_events.operators.skew import Lookup, with_neighbours, with_segments

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def local(moment):
    return moment.astimezone(UTC).replace(tzinfo=None)


def random_feed(seed, rows=600):
    """Readings where one entity holds most rows, in bursts, with ties in time."""
    rng = random.Random(seed)
    feed = []
    for seq in range(rows):
        entity = "hot.one" if rng.random() < 0.6 else f"cold.{rng.randrange(20)}"
        second = rng.choice([rng.randrange(100), rng.randrange(5000), 42])
        feed.append((entity, at(second), seq, rng.choice(["on", "off", None]), "{}"))
    return feed


def frame(spark, feed):
    return spark.createDataFrame(feed, schemas.READING)


@pytest.mark.parametrize("hot_rows", [1, 7, 50, 10_000])
def test_neighbours_do_not_depend_on_how_hot_keys_are_cut(spark, hot_rows):
    feed = random_feed(hot_rows)
    got = with_neighbours(
        frame(spark, feed), "entity_id", "time", ["seq", "state"], previous=True, following=True, hot_rows=hot_rows
    )
    before, after = {}, {}
    for entity in {row[0] for row in feed}:
        ordered = sorted((r for r in feed if r[0] == entity), key=lambda r: (r[1], r[2]))
        for left, right in zip(ordered, ordered[1:]):
            before[right[2]], after[left[2]] = (left[2], left[3]), (right[2], right[3])
    rows = got.collect()
    assert len(rows) == len(feed)
    for row in rows:
        assert (row["previous"] and tuple(row["previous"])) == before.get(row["seq"])
        assert (row["following"] and tuple(row["following"])) == after.get(row["seq"])


def test_a_hot_key_is_cut_into_parts_of_about_the_limit(spark):
    rows = [("hot", at(i), i, "x", None) for i in range(1000)]
    rows += [(f"cold.{i % 50}", at(i), i, "x", None) for i in range(500)]
    cut, any_hot = with_segments(frame(spark, rows), "entity_id", "time", hot_rows=100)
    sizes = cut.groupBy("entity_id", "_segment").count().collect()
    assert any_hot and max(r["count"] for r in sizes) <= 200
    assert all((r["_segment"] == 0) == (r["entity_id"] != "hot") for r in sizes)


SHAPES = {
    "burst and outliers": [at(i % 7) for i in range(1000)] + [at(-(10**7)), at(10**7), at(3 * 10**7)],
    "one instant": [at(5)] * 1000,
    "two instants": [at(5)] * 700 + [at(6)] * 300 + [at(10**6)],
    "even": [at(i) for i in range(1000)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_no_segment_of_a_hot_key_exceeds_twice_the_limit(spark, shape):
    times = SHAPES[shape]
    rows = [("hot", time, seq, "x", None) for seq, time in enumerate(times)] + [("cold", at(0), -1, "x", None)]
    cut, _ = with_segments(frame(spark, rows), "entity_id", "time", hot_rows=100)
    assert max(r["count"] for r in cut.groupBy("entity_id", "_segment").count().collect()) <= 200
    ends = cut.groupBy("_segment").agg(F.min(F.struct("time", "seq")).alias("a"), F.max(F.struct("time", "seq")).alias("b"))
    ordered = sorted((r["_segment"], r["a"], r["b"]) for r in ends.where("_segment > 0").collect())
    assert all(left[2] < right[1] for left, right in zip(ordered, ordered[1:]))
    got = with_neighbours(frame(spark, rows), "entity_id", "time", ["seq"], previous=True, hot_rows=100)
    order = sorted((time, seq) for seq, time in enumerate(times))
    expected = {right[1]: left[1] for left, right in zip(order, order[1:])}
    assert {r["seq"]: r["previous"] and r["previous"]["seq"] for r in got.where("entity_id = 'hot'").collect()} == {
        seq: expected.get(seq) for _, seq in order
    }


def test_a_long_silence_is_polled_throughout(spark, monkeypatch):
    monkeypatch.setattr(changes, "TICKS_AT_ONCE", 7)
    rows = [("a.b", at(0), 1, "x", None), ("a.b", at(1000), 2, "y", None)]
    got = changes.poll_replay(frame(spark, rows), at(0), at(1100), 10).groupBy("seq").count().collect()
    assert {r["seq"]: r["count"] for r in got} == {1: 100, 2: 11}


def test_polls_at_uneven_ticks(spark):
    rows = [("a.b", at(0), 1, "x", None), ("a.b", at(10), 2, "y", None)]
    ticks = spark.createDataFrame([(at(s),) for s in (-5, 0, 9, 10, 33, 33)], "time timestamp")
    got = changes.poll_at(frame(spark, rows), ticks).orderBy("time").collect()
    assert [(r["seq"], r["time"]) for r in got] == [(1, local(at(0))), (1, local(at(9))), (2, local(at(10))), (2, local(at(33)))]


def test_every_hot_key_is_split(spark, monkeypatch):
    monkeypatch.setattr("entity_events.operators.skew.BROADCAST_BYTES", 1)
    feed = [(f"e.{i % 3}", at(i), i, "x", None) for i in range(90)]
    cut, _ = with_segments(frame(spark, feed), "entity_id", "time", hot_rows=10)
    assert max(r["count"] for r in cut.groupBy("entity_id", "_segment").count().collect()) <= 20
    got = with_neighbours(frame(spark, feed), "entity_id", "time", ["seq"], previous=True, hot_rows=10)
    assert {r["seq"]: r["previous"] and r["previous"]["seq"] for r in got.collect()} == {
        i: i - 3 if i >= 3 else None for i in range(90)
    }
    left = Lookup(frame(spark, feed).groupBy("entity_id").count(), "entity_id", False)
    assert left.join(frame(spark, feed), "inner", hot_rows=10).count() == 90


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_broadcast_or_shuffled(spark, how):
    left = frame(spark, random_feed(3))
    names = spark.createDataFrame([("hot.one", "h"), ("cold.1", "c"), ("none", "n")], "entity_id string, name string")
    joins = [
        Lookup(names, "entity_id", small).join(left, how, hot_rows=hot_rows)
        for small, hot_rows in [(True, 10), (False, 10), (False, 10_000)]
    ]
    first, *others = (sorted(map(tuple, j.select(sorted(j.columns)).collect()), key=str) for j in joins)
    assert first
    assert all(other == first for other in others)
    assert Lookup.measured(names, "entity_id").small
    assert not Lookup.measured(names, "entity_id", limit=10).small


EVENTS = [
    (at(0), None, ("light.a", "on", None, None, None)),
    (at(1), ("light.a", "off", None, None, None), ("light.a", "on", None, None, at(5))),
    (at(2), ("light.a", "off", None, None, None), ("light.a", "off", "{}", None, None)),
    (at(3), ("light.a", "off", None, None, None), None),
]


def test_events_with_an_old_state(spark):
    events = spark.createDataFrame(EVENTS, schemas.CHANGE_EVENT)
    rows = changes.classify_events(events).orderBy("time").collect()
    assert [r["reason"] for r in rows] == [fixed.STATE, fixed.STATE, fixed.ATTRIBUTE]
    assert [r["seq"] for r in rows] == [0, int(at(5).timestamp() * 1e6), 0]
    assert changes.drop_removals(events).count() == 3


@pytest.mark.parametrize("hot_rows", [2, 10_000])
def test_readings_are_classified_against_the_one_before(spark, hot_rows):
    feed = random_feed(11)
    got = {r["seq"]: r["reason"] for r in changes.classify_readings(frame(spark, feed), hot_rows).collect()}
    last = {}
    for entity, _, seq, state, _ in sorted(feed, key=lambda r: (r[1], r[2])):
        changed = entity not in last or last[entity] != state
        assert got[seq] == (fixed.STATE if changed else fixed.ATTRIBUTE)
        last[entity] = state


def test_latest_state_and_poll(spark):
    feed = random_feed(5)
    latest = changes.latest_state(frame(spark, feed))
    expected = {}
    for row in sorted(feed, key=lambda r: (r[1], r[2])):
        expected[row[0]] = row[2]
    assert {r["entity_id"]: r["seq"] for r in latest.collect()} == expected
    for size in (0, 1, 2):
        rows = [(f"light.{i}", at(i), i, "on", None) for i in range(size)]
        polled = changes.poll(changes.latest_state(frame(spark, rows)), at(99)).collect()
        assert sorted((r["entity_id"], r["state"], r["reason"]) for r in polled) == [
            (f"light.{i}", "on", fixed.POLLING) for i in range(size)
        ]
        assert all(r["time"] == local(at(99)) for r in polled)


@pytest.mark.parametrize(("start", "end", "step", "hot_rows"), [(0, 100, 10, 5), (7, 4999, 60, 50), (-30, 200, 7, 9999), (50, 40, 5, 9), (42, 42, 1, 10)])
def test_poll_replay_gives_what_polling_would_have_seen(spark, start, end, step, hot_rows):
    feed = random_feed(start + 40)
    got = changes.poll_replay(frame(spark, feed), at(start), at(end), step, hot_rows)
    expected = set()
    for tick in range(start, end + 1, step):
        seen = {}
        for row in sorted(feed, key=lambda r: (r[1], r[2])):
            if row[1] <= at(tick):
                seen[row[0]] = row[2]
        expected |= {(entity, local(at(tick)), seq) for entity, seq in seen.items()}
    rows = [(r["entity_id"], r["time"], r["seq"]) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected


def test_a_tick_belongs_to_the_reading_that_starts_on_it(spark):
    rows = [("a.b", at(0), 1, "x", None), ("a.b", at(10), 2, "y", None)]
    got = changes.poll_replay(frame(spark, rows), at(0), at(20), 10).orderBy("time").collect()
    assert [(r["seq"], r["reason"]) for r in got] == [(1, "polling"), (2, "polling"), (2, "polling")]
    with pytest.raises(ValueError):
        changes.poll_replay(frame(spark, rows), at(0), at(20), 0)


def test_merge_keeps_duplicates(spark):
    rows = frame(spark, random_feed(1, 10)).withColumn("reason", F.lit("x"))
    assert changes.merge(rows, rows).count() == 20
