"""Which readings are published.

Target rules look only at the entity and its device, so they are worked out once per entity on the
details table; readings meet them in the join they need anyway. For rules the area is the entity's
own, never the device's, and device rules apply only where the device row exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.operators.skew import Lookup
from entity_events.settings import Settings, Targets

PASSED = "passed"
CHANGE_TYPE = "change type not listed"
NOT_REGISTERED = "entity not registered"
NOT_INCLUDED = "not included"


def change_type_passes(reason: Column, change_types: Sequence[str]) -> Column:
    """Polled readings always pass; others need their reason in the list."""
    return reason.isin(fixed.POLLING, *change_types)


def registered(readings: DataFrame, lookup: Lookup) -> DataFrame:
    """Readings of registered entities, without adding columns."""
    return lookup.with_rows(lookup.rows.select("entity_id")).join(readings, "left_semi")


def matching_rule(targets: Targets) -> Column:
    """First rule the entity meets (entity, area, entity label, device, device label), else null.

    Written over the columns of the details table; an empty list never matches.
    """
    details = F.col("details")
    labels = F.array(*map(F.lit, targets.label_ids)).cast("array<string>")
    return (
        F.when(F.col("entity_id").isin(*targets.entity_ids), "entity")
        .when(F.col("area_id").isin(*targets.area_ids), "area")
        .when(F.arrays_overlap(details["labels"], labels), "entity label")
        .when(details["device"]["id"].isin(*targets.device_ids), "device")
        .when(F.arrays_overlap(details["device"]["labels"], labels), "device label")
    )


#: Kinds of a rule in a rule table, in the order in which an entity is held against them.
RULE_KINDS = ("entity", "area", "entity label", "device", "device label")

#: Columns of a rule table: ``kind`` is entity, area, label or device.
RULE_TABLE = "kind string, id string"


def _rule_keys(details: DataFrame) -> DataFrame:
    """What the rules of a table can meet of each entity: (entity_id, place in ``RULE_KINDS``, kind, id)."""
    found = F.col("details")
    keys = [
        (F.array("entity_id"), "entity"),
        (F.array("area_id"), "area"),
        (found["labels"], "label"),
        (F.array(found["device"]["id"]), "device"),
        (found["device"]["labels"], "label"),
    ]
    def listed(ids: Column, place: int, kind: str) -> Column:
        ids = F.coalesce(ids, F.array().cast("array<string>"))
        return F.transform(ids, lambda i: F.struct(F.lit(place).alias("place"), F.lit(kind).alias("kind"), i.alias("id")))

    each = [listed(ids, place, kind) for place, (ids, kind) in enumerate(keys)]
    return details.select("entity_id", F.inline(F.concat(*each)))


def _first_rules(details: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """(entity_id, name): place of the first rule of a table that an entity meets; entities without one are absent.

    Both sides are joined by kind and id, so a table of millions of ids is as good as a short one: Spark
    broadcasts the smaller side by its measured size or shuffles both, splitting a label that very many
    entities have.
    """
    wanted = rules.select("kind", "id").where(F.col("id").isNotNull()).distinct()
    return _rule_keys(details).join(wanted, ["kind", "id"]).groupBy("entity_id").agg(F.min("place").alias(name))


def decided_by_tables(lookup: Lookup, include: DataFrame | None = None, exclude: DataFrame | None = None) -> Lookup:
    """A lookup whose entities carry the decision of rule tables (:data:`RULE_TABLE`), in place of literal lists.

    It is used like any other, and its decisions are those that the literal form gives: exclusion first, then
    inclusion where there is such a table. The rules of the settings are not looked at.
    """
    rows = lookup.rows
    decision = F.lit(PASSED)
    if include is not None:
        rows = rows.join(_first_rules(lookup.rows, include, "_include"), "entity_id", "left")
        decision = F.when(F.col("_include").isNull(), NOT_INCLUDED).otherwise(decision)
    if exclude is not None:
        rows = rows.join(_first_rules(lookup.rows, exclude, "_exclude"), "entity_id", "left")
        rule = F.get(F.array(*map(F.lit, RULE_KINDS)), F.col("_exclude"))
        decision = F.when(rule.isNotNull(), F.concat(F.lit("excluded by "), rule)).otherwise(decision)
    return lookup.with_rows(rows.withColumn("target_decision", decision).drop("_include", "_exclude"))


def with_rules(details: DataFrame, settings: Settings) -> DataFrame:
    """Add ``target_decision`` to the details table: the first rule that decides, else ``passed``.

    Exclusion is tested before inclusion. Inclusion that is switched on with nothing listed passes
    nothing. A table that has been :func:`decided_by_tables` keeps its decisions.
    """
    if "target_decision" in details.columns:
        return details
    decision = F.lit(PASSED)
    if settings.include_enabled:
        decision = F.when(matching_rule(settings.include).isNull(), NOT_INCLUDED).otherwise(decision)
    if settings.exclude_enabled:
        excluded = matching_rule(settings.exclude)
        decision = F.when(
            excluded.isNotNull(), F.concat(F.lit("excluded by "), excluded)
        ).otherwise(decision)
    return details.withColumn("target_decision", decision)


def _passing(lookup: Lookup, settings: Settings) -> DataFrame:
    return with_rules(lookup.rows, settings).where(F.col("target_decision") == PASSED)


def targeted(readings: DataFrame, lookup: Lookup, settings: Settings) -> DataFrame:
    """Readings of the entities that pass the target rules, without adding columns.

    Keeps or drops an entity as a whole, so it may run before readings are compared with each other
    and spares the others that shuffle.
    """
    entities = _passing(lookup, settings).select("entity_id")
    return lookup.with_rows(entities).join(readings, "left_semi")


def accepted(readings: DataFrame, lookup: Lookup, settings: Settings) -> DataFrame:
    """Readings that pass every rule, with their ``details``.

    The reason test runs on the scan; registration and target rules are one inner join with the
    entities that pass.
    """
    passing = _passing(lookup, settings).select("entity_id", "details")
    wanted = readings.where(change_type_passes(F.col("reason"), settings.change_types))
    return lookup.with_rows(passing).join(wanted, "inner")


def audited(readings: DataFrame, lookup: Lookup, settings: Settings) -> DataFrame:
    """Every reading with ``filter_reason``: the first rule that decided, ``passed`` if none did."""
    rules = with_rules(lookup.rows, settings).select("entity_id", "target_decision")
    reason = F.when(
        ~change_type_passes(F.col("reason"), settings.change_types), CHANGE_TYPE
    ).otherwise(F.coalesce(F.col("target_decision"), F.lit(NOT_REGISTERED)))
    joined = lookup.with_rows(rules).join(readings, "left")
    return joined.withColumn("filter_reason", reason).drop("target_decision")


def reason_counts(audit: DataFrame) -> DataFrame:
    """Number of readings per deciding rule."""
    return audit.groupBy("filter_reason").agg(F.count(F.lit(1)).alias("readings"))
