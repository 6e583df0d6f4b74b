"""Registry joins: one denormalised row per entity, then one join per reading."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity_events.functions.text import first_filled, sorted_labels
from entity_events.operators.skew import BROADCAST_BYTES, Lookup


@dataclass(frozen=True)
class Registry:
    """The four keyed registry tables."""

    entities: DataFrame
    devices: DataFrame
    areas: DataFrame
    floors: DataFrame


#: Groups that rows without an id are spread over in a join by that id.
_STRAY_GROUPS = 1 << 16

#: Entities that one task details, about, where the details are kept and read again.
ENTITIES_IN_TASK = 50_000


def _left_by_id(rows: DataFrame, side: DataFrame, key: str, side_key: str) -> DataFrame:
    """Left join by an id that many rows lack; ``side_key`` goes.

    Rows without the id meet nothing. A shuffled join would bring them all to one task, so each is dealt out by
    its entity; the first letter of a key keeps these apart from the keys of ids.
    """
    dealt = F.concat(F.lit("-"), F.pmod(F.xxhash64("entity_id"), F.lit(_STRAY_GROUPS)))
    given = rows.withColumn("_given", F.coalesce(F.concat(F.lit("+"), key), dealt))
    sought = side.withColumn("_sought", F.concat(F.lit("+"), side_key)).drop(side_key)
    return given.join(sought, F.col("_given") == F.col("_sought"), "left").drop("_given", "_sought")


def with_device(entities: DataFrame, devices: DataFrame) -> DataFrame:
    """Attach the device of each entity; without a device row the entity stays, device null."""
    device = devices.select(
        F.col("id").alias("_device_id"),
        F.struct(
            "id",
            first_filled(F.col("name_by_user"), F.col("name")).alias("name"),
            sorted_labels(F.col("labels")).alias("labels"),
            "area_id",
        ).alias("device"),
    )
    return _left_by_id(entities, device, "device_id", "_device_id")


def areas_with_floor(areas: DataFrame, floors: DataFrame) -> DataFrame:
    """One struct per area, its floor inside; areas without a floor row stay."""
    floor = floors.select("floor_id", F.struct(F.col("floor_id").alias("id"), "name").alias("floor"))
    return areas.join(floor, "floor_id", "left").select(
        F.col("id").alias("area_id"), F.struct("id", "name", "floor").alias("area")
    )


def with_area(rows: DataFrame, areas: DataFrame, key: str, into: str) -> DataFrame:
    """Attach an area struct (from :func:`areas_with_floor`) by the given id column."""
    keyed = areas.select(F.col("area_id").alias("_area_id"), F.col("area").alias(into))
    return _left_by_id(rows, keyed, key, "_area_id")


def _filled(labels: Column) -> Column:
    return F.when(F.size(labels) > 0, labels)


def _dealt(entities: DataFrame, in_task: int) -> DataFrame:
    """Entities in tasks of about ``in_task``: a registry may come in one file, and details are far larger than it."""
    tasks = -(-entities.count() // in_task)
    return entities.repartition(tasks, "entity_id", "device_id", "area_id") if tasks > 1 else entities


def entity_details(registry: Registry, in_task: int | None = None) -> DataFrame:
    """One row per registered entity: ``entity_id``, rule inputs, and the nested ``details``.

    The small registry tables are joined to each other here, once, so that readings need a single
    join. The device, area and floor sides are plain scans whose sizes Spark knows. With ``in_task``, a
    task details about that many entities, however many files they come in.
    """
    areas = areas_with_floor(registry.areas, registry.floors)
    entities = _dealt(registry.entities, in_task) if in_task else registry.entities
    wide = with_device(entities, registry.devices)
    wide = with_area(wide, areas, "area_id", "entity_area")
    wide = wide.withColumn("device_area_id", F.col("device.area_id"))
    wide = with_area(wide, areas, "device_area_id", "device_area")
    device = F.col("device")
    details = F.struct(
        F.col("entity_id").alias("id"),
        first_filled(F.col("name"), F.col("original_name")).alias("name"),
        "domain",
        F.col("entity_area").alias("area"),
        first_filled(F.col("device_class"), F.col("original_device_class")).alias("device_class"),
        F.when(
            device.isNotNull(),
            F.struct(
                device["id"].alias("id"),
                device["name"].alias("name"),
                F.col("device_area").alias("area"),
                _filled(device["labels"]).alias("labels"),
            ),
        ).alias("device"),
        _filled(sorted_labels(F.col("labels"))).alias("labels"),
        "platform",
        "unit_of_measurement",
    )
    return wide.select("entity_id", "area_id", details.alias("details"))


def details_lookup(registry: Registry, limit: int = BROADCAST_BYTES) -> Lookup:
    """Entity details ready to be joined, with their size measured."""
    return Lookup.measured(entity_details(registry), "entity_id", limit)
