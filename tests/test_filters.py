from itertools import product

import pytest
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.operators import enrich, filters
from entity_events.settings import Settings, StaticFields, Targets
from tests import home

READING = "entity_id string, time timestamp, seq long, state string, attributes string, reason string"


@pytest.fixture(scope="module")
def lookup(make_registry):
    registry = make_registry([home.entity()], [home.device()], home.areas(), home.FLOORS)
    lookup = enrich.details_lookup(registry)
    return lookup.with_rows(lookup.rows.cache())


def reading(spark, reason=fixed.STATE, entity_id=home.ENTITY_ID):
    return spark.createDataFrame([(entity_id, None, 1, "on", "{}", reason)], READING)


def passes(spark, lookup, settings, **given):
    rows = reading(spark, **given)
    passed = filters.accepted(rows, lookup, settings).count() == 1
    reason = filters.audited(rows, lookup, settings).first()["filter_reason"]
    assert passed == (reason == filters.PASSED)
    return passed, reason


GRID = list(
    product(
        [[home.ENTITY_LABELS[0]], [home.DEVICE_LABELS[0]], []],
        [["bench"], []],
        [[home.DEVICE_ID], []],
        [[home.ENTITY_ID], []],
    )
)


def targets(grid_row):
    labels, areas, devices, entities = grid_row
    return Targets.of(
        {"label_id": labels, "area_id": areas, "device_id": devices, "entity_id": entities}
    )


def first_rule(grid_row):
    labels, areas, devices, entities = grid_row
    if entities:
        return "entity"
    if areas:
        return "area"
    if labels and labels[0] in home.ENTITY_LABELS:
        return "entity label"
    if devices:
        return "device"
    return "device label" if labels else None


def rule_table(spark, grid_row):
    kinds = ("label", "area", "device", "entity")
    rows = [(kind, i) for kind, ids in zip(kinds, grid_row) for i in ids]
    return spark.createDataFrame([*rows, *rows, ("label", None), ("area", "nowhere")], filters.RULE_TABLE)


@pytest.mark.parametrize("include_on, exclude_on", [(True, False), (False, True), (True, True)])
def test_rule_tables_decide_like_lists(spark, lookup, include_on, exclude_on):
    for number, grid_row in enumerate(GRID):
        other = GRID[(7 * number + 3) % len(GRID)]
        settings = Settings(include_enabled=include_on, exclude_enabled=exclude_on, include=targets(grid_row), exclude=targets(other))
        tables = (rule_table(spark, row) if on else None for row, on in ((grid_row, include_on), (other, exclude_on)))
        decided = filters.decided_by_tables(lookup, *tables)
        got = decided.rows.select("target_decision").collect()
        assert got == filters.with_rules(lookup.rows, settings).select("target_decision").collect(), (grid_row, other)
    # Whoever uses the lookup goes by its decisions.
    nothing = filters.decided_by_tables(lookup, include=spark.createDataFrame([], filters.RULE_TABLE))
    assert passes(spark, nothing, Settings()) == (False, filters.NOT_INCLUDED)
    assert passes(spark, filters.decided_by_tables(lookup), Settings()) == (True, filters.PASSED)


@pytest.mark.parametrize("grid_row", GRID)
def test_target_rules_switched_on_and_off(spark, lookup, grid_row):
    rule, given = first_rule(grid_row), targets(grid_row)
    rules = {
        name: filters.with_rules(lookup.rows, settings).first()["target_decision"]
        for name, settings in {
            "exclude": Settings(exclude_enabled=True, exclude=given),
            "include": Settings(include_enabled=True, include=given),
            "off": Settings(exclude=given, include=given),
        }.items()
    }
    assert rules == {
        "exclude": f"excluded by {rule}" if rule else filters.PASSED,
        "include": filters.PASSED if rule else filters.NOT_INCLUDED,
        "off": filters.PASSED,
    }


HIT, MISS = Targets(entity_ids=(home.ENTITY_ID,)), Targets(entity_ids=("other.entity",))


@pytest.mark.parametrize(
    ("include_on", "include_hits", "exclude_on", "exclude_hits"), list(product([True, False], repeat=4))
)
def test_include_and_exclude_together(spark, lookup, include_on, include_hits, exclude_on, exclude_hits):
    settings = Settings(
        include_enabled=include_on,
        include=HIT if include_hits else MISS,
        exclude_enabled=exclude_on,
        exclude=HIT if exclude_hits else MISS,
    )
    expected = (include_hits or not include_on) and not (exclude_on and exclude_hits)
    assert passes(spark, lookup, settings)[0] == expected


@pytest.mark.parametrize(
    ("reason", "listed", "expected"),
    [
        (fixed.POLLING, (), True),
        (fixed.STATE, (fixed.STATE,), True),
        (fixed.ATTRIBUTE, (fixed.ATTRIBUTE,), True),
        (fixed.STATE, (fixed.STATE, fixed.ATTRIBUTE), True),
        (fixed.ATTRIBUTE, (fixed.STATE,), False),
        (fixed.STATE, (fixed.ATTRIBUTE,), False),
    ],
)
def test_change_types(spark, lookup, reason, listed, expected):
    passed, why = passes(spark, lookup, Settings(change_types=listed), reason=reason)
    assert passed == expected
    assert why == (filters.PASSED if expected else filters.CHANGE_TYPE)


def test_unregistered_entity(spark, lookup):
    assert passes(spark, lookup, Settings(), entity_id="light.gone") == (False, filters.NOT_REGISTERED)


def test_inclusion_with_nothing_listed_passes_nothing(spark, lookup):
    assert passes(spark, lookup, Settings(include_enabled=True)) == (False, filters.NOT_INCLUDED)


def test_area_of_the_device_does_not_count(spark, lookup):
    settings = Settings(include_enabled=True, include=Targets(area_ids=("shed",)))
    assert not passes(spark, lookup, settings)[0]


def test_device_rules_need_a_device_row(spark, make_registry):
    registry = make_registry([home.entity(labels=False)], [], home.areas(), home.FLOORS)
    lookup = enrich.details_lookup(registry)
    settings = Settings(exclude_enabled=True, exclude=Targets(device_ids=(home.DEVICE_ID,)))
    assert passes(spark, lookup, settings)[0]


def test_reason_counts(spark, lookup):
    rows = reading(spark).unionByName(reading(spark, entity_id="x.y")).unionByName(reading(spark))
    counts = filters.reason_counts(filters.audited(rows, lookup, Settings())).collect()
    assert {r["filter_reason"]: r["readings"] for r in counts} == {
        filters.PASSED: 2,
        filters.NOT_REGISTERED: 1,
    }


def test_settings_from_options():
    assert Settings.from_options({}) == Settings()
    options = {
        "polling_frequency": 0,
        "publish_frequency": 2,
        "change_detection_type": ["state"],
        "tags": ["a"],
        "include_targets": True,
        "targets_to_include": {"area_id": ["kitchen"]},
        "debug_attribute_filtering": True,
    }
    settings = Settings.from_options(options)
    assert (settings.poll_seconds, settings.publish_seconds) == (0, 2)
    assert settings.include == Targets(area_ids=("kitchen",))
    assert settings.exclude == Targets()
    assert settings.audit_attributes
    for wrong in ({"change_detection_type": ["STATE"]}, {"polling_frequency": -1}):
        with pytest.raises(ValueError):
            Settings.from_options(wrong)


def test_static_fields_leave_out_what_is_not_set():
    assert StaticFields().dotted() == {}
    assert StaticFields(longitude=0.0, latitude=0.0).dotted() == {"host.location": [0.0, 0.0]}
    assert StaticFields("1", "", None, "h", 1.0, None, ("t",)).dotted() == {
        "agent.version": "1",
        "host.hostname": "h",
        "tags": ["t"],
    }
