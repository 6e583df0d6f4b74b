"""Readings from change events and polls, and the reason each one is gathered for."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.operators.skew import HOT_ROWS, with_neighbours

TICKS_AT_ONCE = 4096


def drop_removals(events: DataFrame) -> DataFrame:
    """Leave out events that tell an entity was removed; lines that could not be read are none."""
    present = F.col("new_state").isNotNull()
    if schemas.UNREADABLE_LINE in events.columns:
        present = present | F.col(schemas.UNREADABLE_LINE).isNotNull()
    return events.where(present)


def classify_events(events: DataFrame) -> DataFrame:
    """Readings with a reason from events that carry the old state: no state of our own is needed.

    Lines that could not be read stay, with nothing but their text; they end in the quarantine.
    """
    old, new = F.col("old_state"), F.col("new_state")
    changed = old.isNull() | ~old["state"].eqNullSafe(new["state"])
    reason = F.when(new.isNull(), None).when(changed, fixed.STATE).otherwise(fixed.ATTRIBUTE)
    seq = F.when(new.isNotNull(), F.coalesce(F.unix_micros(new["last_updated"]), F.lit(0)))
    return drop_removals(events).select(
        new["entity_id"].alias("entity_id"),
        F.col("time_fired").alias("time"),
        seq.alias("seq"),
        new["state"].alias("state"),
        new["attributes"].alias("attributes"),
        reason.alias("reason"),
        *(name for name in events.columns if name == schemas.UNREADABLE_LINE),
    )


def classify_readings(readings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the reason to readings that carry only the new state.

    The first reading of an entity, or one whose text differs from the reading before it, is a
    state change; any other is an attribute change.
    """
    seen = with_neighbours(readings, "entity_id", "time", ["state"], previous=True, hot_rows=hot_rows)
    before = F.col("previous")
    changed = before.isNull() | ~before["state"].eqNullSafe(F.col("state"))
    return seen.withColumn("reason", F.when(changed, fixed.STATE).otherwise(fixed.ATTRIBUTE)).drop(
        "previous"
    )


def latest_state(readings: DataFrame) -> DataFrame:
    """Newest reading per entity; reduced before the shuffle, so a hot entity costs no more."""
    rest = [name for name in readings.columns if name != "entity_id"]
    newest = F.max_by(F.struct(*rest), F.struct("time", "seq")).alias("newest")
    return readings.groupBy("entity_id").agg(newest).select("entity_id", "newest.*")


def poll(latest: DataFrame, now: datetime) -> DataFrame:
    """Every current state, stamped with one moment."""
    return latest.withColumns({"time": F.lit(now).cast("timestamp"), "reason": F.lit(fixed.POLLING)})


def poll_replay(
    readings: DataFrame,
    start: datetime,
    end: datetime,
    seconds: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """What polling every ``seconds`` from ``start`` to ``end`` (both included) would have gathered.

    A reading is current from its own time until just before the next one, so it is given out once
    for each tick in that range. Needs no join; each reading expands on its own.
    """
    if seconds <= 0:
        raise ValueError("the poll interval must be positive")
    step = F.lit(seconds * 1_000_000)
    origin, last = (F.unix_micros(F.lit(t).cast("timestamp")) for t in (start, end))
    known = with_neighbours(
        readings, "entity_id", "time", ["time"], following=True, hot_rows=hot_rows
    )
    valid_to = F.unix_micros(F.col("following.time"))
    first_tick = F.greatest(F.ceil((F.unix_micros("time") - origin) / step), F.lit(0))
    end_tick = F.floor((last - origin) / step)
    last_tick = F.least(F.coalesce(F.ceil((valid_to - origin) / step) - 1, end_tick), end_tick)
    # Long silences expand in two steps, so that no row holds more than TICKS_AT_ONCE of them.
    starts = F.when(first_tick <= last_tick, F.sequence(first_tick, last_tick, F.lit(TICKS_AT_ONCE)))
    stretches = known.withColumn("_last_tick", last_tick).withColumn("_tick", F.explode(starts))
    end_of_stretch = F.least(F.col("_tick") + (TICKS_AT_ONCE - 1), F.col("_last_tick"))
    return (
        stretches.withColumn("_tick", F.explode(F.sequence("_tick", end_of_stretch)))
        .withColumn("time", F.timestamp_micros(origin + F.col("_tick") * step))
        .withColumn("reason", F.lit(fixed.POLLING))
        .drop("_tick", "_last_tick", "following")
    )


def poll_at(readings: DataFrame, ticks: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """What polling at each ``time`` of ``ticks`` would have gathered, whatever their spacing.

    For the few ticks of a micro-batch: they travel as one sorted array, and each reading takes those from
    its own time until just before the next reading.
    """
    known = with_neighbours(
        readings, "entity_id", "time", ["time"], following=True, hot_rows=hot_rows
    )
    known = known.withColumn("_moments", ticks.agg(F.array_sort(F.collect_set("time"))).scalar())
    until = F.col("following.time")
    current = F.filter(
        "_moments", lambda tick: (tick >= F.col("time")) & (until.isNull() | (tick < until))
    )
    return (
        known.withColumn("time", F.explode(current))
        .withColumn("reason", F.lit(fixed.POLLING))
        .drop("following", "_moments")
    )


def merge(changes: DataFrame, polled: DataFrame) -> DataFrame:
    """Changes and polls as one feed; duplicates stay."""
    return changes.unionByName(polled)
