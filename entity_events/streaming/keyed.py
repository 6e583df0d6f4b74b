"""Stream operators that keep state per entity, so that a batch costs only the entities it has readings of.

The entities are dealt into groups by a hash, and the states of a group are one row of the state store: a call to
Python costs far more than an entity, so there is one call a group and not one an entity. The number of groups is
fixed with the checkpoint. State lives in Spark's state store and follows the query's checkpoint, so it survives
restarts and is never ahead of the output. The rows of one group in one micro-batch are put in order in one task; the
source's limits per trigger bound how many those are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from entity_events import fixed_values as fixed
from entity_events import schemas

if TYPE_CHECKING:
    import pandas as pd

#: Stands for a missing time or number in the order of readings; before all others.
_NONE = -(2**63)

#: Groups that entities, and rows without one, are dealt into.
GROUPS = 1 << 12


def _ordered(readings: DataFrame) -> DataFrame:
    """Times and numbers as whole numbers without nulls, which Python workers take exactly."""
    at = F.coalesce(F.unix_micros("time"), F.lit(_NONE))
    return readings.withColumns({"_at": at, "_order": F.coalesce("seq", F.lit(_NONE))}).drop("time", "seq")


def _restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    at, order = F.col("_at"), F.col("_order")
    times = {"time": F.timestamp_micros(F.when(at != _NONE, at)), "seq": F.when(order != _NONE, order)}
    return rows.withColumns(times).select(*columns)


def _by_group(rows: DataFrame, groups: int):
    """Rows grouped so that those of an entity are together; those without one, which need no order, are spread."""
    dealt = F.when(F.col("entity_id").isNotNull(), F.xxhash64("entity_id"))
    stray = F.xxhash64("_at", "_order", *_lines(rows))
    return rows.withColumn("_group", F.pmod(F.coalesce(dealt, stray), F.lit(groups))).groupBy("_group")


def _lines(rows: DataFrame) -> list[str]:
    return [schemas.UNREADABLE_LINE] if schemas.UNREADABLE_LINE in rows.columns else []


def _columns(chunks: Iterator[pd.DataFrame], *names: str) -> tuple[pd.DataFrame, list[list]]:
    """The rows of a group in this micro-batch, and some columns of them as lists."""
    import pandas as pd

    parts = list(chunks)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return batch, [batch[name].tolist() for name in names]


def _kept(state: GroupState) -> dict[str, tuple]:
    """What a group keeps of its entities: the first column of the state names them."""
    if not state.exists:
        return {}
    names, *values = state.get
    return dict(zip(names, zip(*values)))


def _keep(state: GroupState, kept: dict[str, tuple]) -> None:
    if kept:
        state.update((list(kept), *map(list, zip(*kept.values()))))


def first_arrivals(readings: DataFrame, delay: str) -> DataFrame:
    """Of the readings of an entity at one instant the first to arrive, as long as copies follow within ``delay``.

    A point is remembered until the watermark, ``delay`` behind the newest reading, has passed it; readings older
    than the watermark are left out and counted, see :func:`left_out`. Rows without a time, such as lines that could
    not be read, have no point: all of them stay.
    """
    pointless = F.when(F.col("time").isNull(), F.uuid())
    points = readings.withColumn("_pointless", pointless).withWatermark("time", delay)
    return points.dropDuplicatesWithinWatermark(["entity_id", "time", "_pointless"]).drop("_pointless")


def left_out(query: StreamingQuery) -> dict[str, int]:
    """How many readings a running query left out: later than the watermark, and copies of one seen."""
    late = copies = 0
    for progress in query.recentProgress:
        for operator in progress.stateOperators:
            late += operator.numRowsDroppedByWatermark
            copies += int(operator.customMetrics.get("numDroppedDuplicateRows", 0))
    return {"late": late, "copies": copies}


def classified(readings: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Add the reason to a stream of readings that carry only the new state.

    The state of an entity is its newest reading. A batch is compared in the order of its times, with that reading in
    its place; a reading that arrives after a newer one of an earlier batch, and is the oldest of its own, has no
    predecessor and counts as a state change.
    """
    rows = _ordered(readings)
    kinds = T.StructType([*rows.schema.fields, T.StructField("reason", T.StringType())])

    def assign(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, (entities, times, orders, states) = _columns(chunks, "entity_id", "_at", "_order", "state")
        kept = _kept(state)
        reasons: list[str | None] = [None] * len(entities)
        known = (i for i, entity in enumerate(entities) if entity is not None)
        for entity, places in groupby(
            sorted(known, key=lambda i: (entities[i], times[i], orders[i])), key=entities.__getitem__
        ):
            before, carried = None, kept.get(entity)
            for i in places:
                here = (times[i], orders[i], states[i])
                if carried is not None and carried[:2] <= here[:2]:
                    before, carried = carried, None
                changed = before is None or before[2] != here[2]
                reasons[i] = fixed.STATE if changed else fixed.ATTRIBUTE
                before = here
            if carried is None:
                kept[entity] = before
        _keep(state, kept)
        yield batch.assign(reason=reasons)[kinds.names]

    found = _by_group(rows, groups).applyInPandasWithState(
        assign,
        kinds,
        "entities array<string>, at array<long>, number array<long>, state array<string>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return _restored(found, [*readings.columns, "reason"])


def running_deviation(series: DataFrame, deviates: Column, minutes: int, groups: int = GROUPS) -> DataFrame:
    """Tell of runs of deviating values of a stream while they last, each once.

    ``series`` has entity_id, time and seq. A run is told with the first reading at which it spans ``minutes``: its
    ``started``, and that reading's time as ``reached``. The state of an entity is the start of its run, its newest
    place and whether the run was told. A reading older than the newest of an earlier batch is left out.
    """
    rows = _ordered(series.withColumn("deviates", F.coalesce(deviates, F.lit(False))))
    rows = rows.select("entity_id", "_at", "_order", "deviates")
    least = minutes * 60_000_000

    def follow(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pandas as pd

        _, (entities, times, orders, outs) = _columns(chunks, "entity_id", "_at", "_order", "deviates")
        kept = _kept(state)
        alerts = []
        for i in sorted(range(len(entities)), key=lambda i: (times[i], orders[i])):
            entity, time, order = entities[i], times[i], orders[i]
            at, number, started, told = kept.get(entity, (_NONE, _NONE, _NONE, False))
            if (time, order) < (at, number):
                continue
            if not outs[i]:
                started, told = _NONE, False
            else:
                if started == _NONE:
                    started = time
                if not told and time - started >= least:
                    told = True
                    alerts.append((entity, started, time))
            kept[entity] = (time, order, started, told)
        _keep(state, kept)
        yield pd.DataFrame(alerts, columns=["entity_id", "_started", "_reached"])

    known = rows.where(F.col("entity_id").isNotNull() & (F.col("_at") != _NONE))
    found = _by_group(known, groups).applyInPandasWithState(
        follow,
        "entity_id string, _started long, _reached long",
        "entities array<string>, at array<long>, number array<long>, started array<long>, told array<boolean>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    moment = lambda name: F.timestamp_micros(f"_{name}").alias(name)
    return found.select("entity_id", moment("started"), moment("reached"))
