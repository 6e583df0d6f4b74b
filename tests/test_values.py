from datetime import date, datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.functions import rules, text, values

MOMENT = {
    "2023-04-12T12:00:00Z": ("2023-04-12T12:00:00+00:00", "12:00:00"),
    "2024-04-12T00:00:00+00:00": ("2024-04-12T00:00:00+00:00", "00:00:00"),
    "2024-04-12": ("2024-04-12T00:00:00", "00:00:00"),
    "2024-04-12T00:00:00+02:00": ("2024-04-12T00:00:00+02:00", "00:00:00"),
    "2024-04-12 10:11": ("2024-04-12T10:11:00", "10:11:00"),
    "2024-04-12T10:11:12.5-0330": ("2024-04-12T10:11:12.500000-03:30", "10:11:12.500000"),
    "2024-04-12T10:11:12.000+02": ("2024-04-12T10:11:12+02:00", "10:11:12"),
    "2024-04-12T10:11:12.120000-00:00": ("2024-04-12T10:11:12.120000+00:00", "10:11:12.120000"),
}
NUMBERS = {
    "123.456": 123.456,
    "123": 123.0,
    "25.5": 25.5,
    "1_000": 1000.0,
    " 12 ": 12.0,
    "2024": 2024.0,
    "-.5": -0.5,
    "5.": 5.0,
    "1e5": 100000.0,
}
TEXTS = [
    "True", "On", "inf", "nan", "-Infinity", "tomato", "1d", "1f", "1e400", "-1e400", "", "00:00:00",
    "2024-02-31", "2024-04-12T25:00:00Z", "1__0", "_1", "1_", "0x10", "2024-04-12T10", "1,5",
]


def coerced(spark, states):
    frame = spark.createDataFrame([(s,) for s in states], "state string")
    rows = frame.select("state", values.coerce(F.col("state")).alias("v")).collect()
    return {
        row["state"]: {k: v for k, v in row["v"].asDict().items() if v is not None} for row in rows
    }


def test_each_text_takes_exactly_one_branch(spark):
    expected = {word: {"boolean": True} for word in fixed.TRUE_WORDS}
    expected |= {word: {"boolean": False} for word in fixed.FALSE_WORDS}
    expected |= {word: {"float": number} for word, number in NUMBERS.items()}
    expected |= {
        word: {"datetime": full, "date": date.fromisoformat(full[:10]), "time": clock}
        for word, (full, clock) in MOMENT.items()
    }
    expected |= {word: {"string": word} for word in TEXTS}
    assert coerced(spark, expected) == expected


def test_numbers_and_datetimes_agree_with_python(spark):
    """Generated texts: the branch and the value must be the ones Python's own parsers give."""
    signs, bodies, tails = ["", "-", "+", "--"], ["7", "07", "7.", ".7", "7.25", "1_0", ".", "1._0"], ["", "e2", "E-1", "e", "f"]
    states = ["".join(parts) for parts in product(signs, bodies, tails)]
    for state, got in coerced(spark, states).items():
        try:
            expected = {"float": float(state)}
        except ValueError:
            expected = {"string": state}
        assert got == expected, state
    dates, clocks, zones = ["2024-02-29", "2023-02-29"], ["T01:02", " 23:59:59", "T24:00", "T10:00:00.25"], ["", "Z", "-05", "+0545", "+14:00"]
    for state, got in coerced(spark, ["".join(p) for p in product(dates, clocks, zones)]).items():
        try:
            moment = datetime.fromisoformat(state)
            if " 24" in state or "T24" in state:
                raise ValueError
            assert got["datetime"] == moment.isoformat()
            assert (got["date"], got["time"]) == (moment.date(), moment.time().isoformat())
        except ValueError:
            assert got == {"string": state}, state


def test_numbers_in_other_scripts(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    states = ["١٢", "١٢.٥", "-१२", "１２e３", "1_٢", "٣x", "²", "Ⅷ", "٠", "1٫5", "𝟙𝟚"] + [f"{s}7{s}" for s in spaces] + ["1\u00a02"]
    for state, got in coerced(spark, states).items():
        try:
            expected = {"float": float(state)}
        except ValueError:
            expected = {"string": state}
        assert got == expected, ascii(state)


def test_long_near_numbers_fail_without_backtracking(spark):
    state = "1_" * 100_000 + "x"
    assert coerced(spark, [state]) == {state: {"string": state}}


def test_integer_reading(spark):
    frame = spark.createDataFrame([("72.5",), ("-3.9",), ("9e99",), ("on",)], "s string")
    assert [r[0] for r in frame.select(values.as_integer(F.col("s"))).collect()] == [72, -3, None, None]


def evaluate(spark, column, **given):
    frame = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given))
    return frame.select(column).first()[0]


@pytest.mark.parametrize(
    ("domain", "expected"),
    [("Counter", "counter"), ("my-Domain.1_x", "mydomain1_x"), ("é!", ""), ("a" * 200, "a" * 128)],
)
def test_sanitize_domain(spark, domain, expected):
    assert evaluate(spark, text.sanitize_domain(F.col("d")), d=domain) == expected


def test_data_stream_and_name(spark):
    stream = text.data_stream(F.col("d"))
    assert evaluate(spark, stream, d="counter").asDict() == {
        "type": fixed.STREAM_TYPE,
        "dataset": fixed.DATASET_PREFIX + ".counter",
        "namespace": fixed.STREAM_NAMESPACE,
    }
    expected = f"{fixed.STREAM_TYPE}-{fixed.DATASET_PREFIX}.counter-{fixed.STREAM_NAMESPACE}"
    assert evaluate(spark, text.stream_name(stream), d="counter") == expected


def test_split_entity_id(spark):
    for entity_id, domain, object_id in [("light.a", "light", "a"), ("x.y.z", "x", "y.z")]:
        assert evaluate(spark, text.domain_of(F.col("e")), e=entity_id) == domain
        assert evaluate(spark, text.object_id_of(F.col("e")), e=entity_id) == object_id


@pytest.mark.parametrize(
    ("preferred", "fallback", "expected"),
    [("New", "Original", "New"), (None, "Original", "Original"), ("New", None, "New"), (None, None, None), ("", "Original", "Original")],
)
def test_first_filled(spark, preferred, fallback, expected):
    column = text.first_filled(F.col("a"), F.col("b"))
    assert evaluate(spark, column, a=preferred, b=fallback) == expected


@pytest.mark.parametrize(
    ("time", "expected"),
    [("2023-04-12 12:00:00", "2023-04-12T12:00:00+00:00"), ("2023-04-12 12:00:00.00012", "2023-04-12T12:00:00.000120+00:00")],
)
def test_iso_utc(spark, time, expected):
    assert evaluate(spark, text.iso_utc(F.col("t").cast("timestamp")), t=time) == expected


def test_keyword_cap(spark):
    assert evaluate(spark, rules.keyword(F.col("t")), t="é" * 1024) == "é" * 1024
    assert evaluate(spark, rules.keyword(F.col("t")), t="x" * 1025) is None


@pytest.mark.parametrize(
    ("given", "accepted"),
    [
        ("10:20:30", True), ("10:20:30.123456", True), ("10:20:30.123Z", True), ("10:20:30+02:00", True),
        ("10:20:30.12", False), ("25:00:00", False), ("10:20", False), ("", False),
    ],
)
def test_clock_time(spark, given, accepted):
    assert evaluate(spark, rules.clock_time(F.col("t")), t=given) == (given if accepted else None)


def test_strict_date(spark):
    assert evaluate(spark, rules.strict_date(F.col("t")), t="2024-02-29") == date(2024, 2, 29)
    assert evaluate(spark, rules.strict_date(F.col("t")), t="2024-2-9") is None
    assert evaluate(spark, rules.strict_date(F.col("t")), t="2023-02-29") is None
    assert evaluate(spark, rules.tolerant(F.col("t"), "float"), t="1.5x") is None


@pytest.mark.parametrize("given", ["2024-04-12T12:00:00Z\n", "2024-04-12\n"])
def test_a_line_end_is_no_part_of_a_time(spark, given):
    frame = spark.createDataFrame([(given,)], "v string")
    row = frame.select(
        values.as_datetime(F.col("v")).isNull().alias("moment"), rules.strict_date(F.col("v")).isNull().alias("date")
    ).first()
    assert row["moment"] and row["date"]


def test_a_line_end_is_no_part_of_a_clock_time(spark):
    frame = spark.createDataFrame([("12:00:00",), ("12:00:00\n",)], "v string")
    assert [row[0] for row in frame.select(rules.clock_time(F.col("v"))).collect()] == ["12:00:00", None]
