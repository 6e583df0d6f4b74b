import json
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.functions import attributes as attrs
from entity_events.functions.ascii import closest_ascii

#: Every kind of value and of name at once; "kinds" stands for a set.
COMPREHENSIVE = {
    "note": "dry \"soil\"",
    "depth": 31,
    "slope": -0.125,
    "wet": False,
    "history": [3, 1, 2],
    "kinds": ["b", "a", "b"],
    "grid": [[0, 1], [2, 3]],
    "pump": {
        "maker": "Ä & Ö",
        "speeds": [10, 20],
        "valve": {"state": 'half\\open"', "inner": {"y": 2, "b": [{"none": None}]}},
    },
    "fault": None,
    "Last Seen": "lost",
    "last_seen": "kept",
    "--Größe  (in cm)__Ñ 🌱": 4,
    "": "no name",
    "\t ": "no name",
}


def nested_as_text(value):
    """What a nested value must become, worked out in Python."""
    if isinstance(value, dict):
        return json.dumps({k: nested_as_text(v) for k, v in value.items()})
    if isinstance(value, list):
        return [nested_as_text(v) for v in value]
    return value


def published(spark, attributes, sets=None):
    raw = attributes if isinstance(attributes, str) else json.dumps(attributes, ensure_ascii=False)
    frame = spark.createDataFrame([(raw, sets)], "a string, sets array<string>")
    column = attrs.published(F.col("a"), F.col("sets") if sets else None)
    result = frame.select(F.to_json(column)).first()[0]
    return None if result is None else json.loads(result)


def test_comprehensive_attributes(spark):
    expected = {k: nested_as_text(v) for k, v in COMPREHENSIVE.items() if k.strip()}
    del expected["Last Seen"]
    expected["groe_in_cm___n"] = expected.pop("--Größe  (in cm)__Ñ 🌱")
    expected["kinds"] = ["a", "b"]
    assert published(spark, COMPREHENSIVE, ["kinds"]) == expected


def test_the_later_of_two_equal_names_stays_everywhere(spark):
    given = '{"a": 1, "b": 2, "a": 3, "A": 4}'
    frame = spark.createDataFrame([(given,)], "a string")
    a = F.col("a")
    row = frame.select(
        F.to_json(attrs.published(a)).alias("one"), F.to_json(attrs.published_filled(a, None, attrs.parse(a))).alias("two")
    ).first()
    assert json.loads(row["one"]) == json.loads(row["two"]) == {"a": 4, "b": 2}


@pytest.mark.parametrize(("name", "expected"), [("abc\n", "abc"), ("a\u2028", "a"), ("abc", "abc"), ("a_b\r", "a_b")])
def test_a_line_end_is_no_part_of_a_name(spark, name, expected):
    frame = spark.createDataFrame([(name,)], "n string")
    assert frame.select(attrs.normalize_name(F.col("n"))).first()[0] == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ({}, {}),
        ({"note": "x", "depth": 3, "slope": 0.5}, {"note": "x", "depth": 3, "slope": 0.5}),
        ({"dim": 7, "pump_speed": 1, "pump speed?": 2}, {"dim": 7, "pump_speed": 2}),
        ({name: 1 for name in fixed.SKIPPED_ATTRIBUTES}, {}),
        ({"probe": {"maker": "Zoë 🌱"}}, {"probe": '{"maker": "Zo\\u00eb \\ud83c\\udf31"}'}),
        ({"probes": [{"id": 4}, "{"]}, {"probes": ['{"id": 4}', "{"]}),
        ({"text": "no {object} here, a:b", "other": {"a": "x, y: {z}"}}, {"text": "no {object} here, a:b", "other": '{"a": "x, y: {z}"}'}),
        ({"!!!": 5}, {"": 5}),
        ({"empty": {}, "list": []}, {"empty": "{}", "list": []}),
    ],
)
def test_published(spark, given, expected):
    assert published(spark, given) == expected


@pytest.mark.parametrize(
    "given",
    [
        {"plain": 1, "icon": "x", "null": None, "a__b": "t"},
        {"plain": 1, "list": []},
        {"A b": 1, "a_b": None},
        {"a_": 1, "_a": 2, "é": None},
        {"nested": {"a": {}}, "list": [[], {}]},
        {"in text": "[] {}", "plain": "[]"},
        {"a b": 1, "": 2, "\n": 3},
        {},
    ],
)
def test_published_filled_is_both_steps(spark, given):
    frame = spark.createDataFrame([(json.dumps(given),)], "a string")
    a, parsed = F.col("a"), attrs.parse(F.col("a"))
    row = frame.select(
        F.to_json(attrs.published_filled(a, None, parsed)).alias("one"),
        F.to_json(attrs.skip_empty(attrs.published(a))).alias("two"),
    ).first()
    assert row["one"] == row["two"]


def test_unreadable_attributes_are_null(spark):
    assert published(spark, "{broken") is None


@pytest.mark.parametrize("depth", range(1, 6))
def test_objects_nest_as_text_at_any_depth(spark, depth):
    value = {"leaf": 'a"b\\c,d:e{}', "n": [1, {"k": [True, None]}]}
    for level in range(depth):
        value = {f"level{level}": value, "beside": [value, "x"]}
    assert published(spark, {"v": value}) == {"v": nested_as_text(value)}


def test_sets_are_sorted_by_value_or_text(spark):
    given = {"n": [10, 9, 9, 1.5], "s": ["b", "a", "b"], "l": [2, 1]}
    assert published(spark, given, ["n", "s"]) == {"n": [1.5, 9, 10], "s": ["a", "b"], "l": [2, 1]}


def test_skip_empty_keeps_falsy_values(spark):
    given = {"null": None, "list": [], "object": {}, "zero": 0, "false": False, "text": "", "brackets": "[]"}
    frame = spark.createDataFrame([(json.dumps(given),)], "a string")
    kept = frame.select(F.to_json(attrs.skip_empty(attrs.parse(F.col("a"))))).first()[0]
    assert json.loads(kept) == {"zero": 0, "false": False, "text": "", "brackets": "[]"}


def test_rejections_and_collisions(spark):
    given = {"icon": 1, " ": 2, "a b": 3, "a-b": 4, "A b": 5, "ok": 6}
    frame = spark.createDataFrame([(json.dumps(given),)], "a string")
    parsed = attrs.parse(F.col("a"))
    row = frame.select(attrs.rejected(parsed).alias("r"), attrs.collisions(parsed).alias("c")).first()
    assert [tuple(r) for r in row["r"]] == [("icon", attrs.SKIPPED_NAME), (" ", attrs.BLANK_NAME)]
    assert row["c"] == 2


@pytest.mark.parametrize(
    ("names", "prefixes", "expected"),
    [((), (), []), (["a"], (), ["a"]), ((), ["b"], ["b1", "b2"]), (["a"], ["b"], ["a", "b1", "b2"])],
)
def test_keep_names(spark, names, prefixes, expected):
    frame = spark.createDataFrame([('{"a":1,"b1":2,"b2":3,"c":4}',)], "a string")
    kept = attrs.keep_names(attrs.parse(F.col("a")), names, prefixes)
    assert frame.select(F.map_keys(kept)).first()[0] == expected


def test_closest_ascii_agrees_with_the_unicode_database(spark):
    """Every assigned character, in runs, against the definition."""
    runs = ["".join(map(chr, range(start, start + 64))) for start in [*range(0x20, 0x3400, 64), *range(0xF900, 0x10000, 64), *range(0x1D400, 0x1D800, 64), *range(0x1F100, 0x1F200, 64)]]
    frame = spark.createDataFrame([(run,) for run in runs], "t string")
    for row in frame.select("t", closest_ascii(F.col("t")).alias("a")).collect():
        expected = unicodedata.normalize("NFKD", row["t"]).encode("ascii", "ignore").decode()
        assert row["a"] == expected


def test_text_typed_name_and_location(spark):
    given = '{"temperature": "21.5", "n": 3, "bad": "x", "longitude": 1.0, "latitude": 2, "friendly_name": ""}'
    frame = spark.createDataFrame([(given,)], "a string").withColumn("p", attrs.parse(F.col("a")))
    kinds = {"temperature": "float", "n": "int", "bad": "double", "gone": "int"}
    assert tuple(frame.select(*attrs.typed(F.col("p"), kinds)).first()) == (21.5, 3, None, None)
    assert frame.select(attrs.as_text(F.col("p"))["n"]).first()[0] == "3"
    assert frame.select(attrs.friendly_name(F.col("p"), F.lit("living_room"))).first()[0] == "living room"
    assert frame.select(attrs.location(F.col("p"))).first()[0] == [1.0, 2.0]
    zero = frame.select(attrs.location(attrs.parse(F.lit('{"longitude": 0.0, "latitude": 2}'))))
    assert zero.first()[0] is None


def test_long_texts_with_every_character_are_normalised(spark):
    everything = "".join(c for c in map(chr, range(1, 0x20000)) if not 0xD800 <= ord(c) < 0xE000)
    texts = [everything, "_a_ ,B__c!\n", "\x00x\x7f Y", "ﬁ—ж½ Ab" * 30, " ", "_", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = dict(frame.select("n", attrs.normalize_name(F.col("text"))).collect())

    def plain(text):
        spelled = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        return re.sub("[^A-Za-z0-9_]+", "_", spelled).strip("_").lower()

    assert got == {n: plain(text) for n, text in enumerate(texts)}
    began = time.monotonic()
    long = spark.range(4, numPartitions=4).select(F.repeat(F.lit("ﬁ жж"), 1_000_000).alias("text"))
    assert [r[0] for r in long.select(F.length(attrs.normalize_name(F.col("text")))).distinct().collect()] == [2_999_999]
    assert time.monotonic() - began < 30
