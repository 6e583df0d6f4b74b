"""From readings to documents: filter, enrich, format."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from entity_events.operators import changes, documents, filters, quality
from entity_events.operators.skew import Lookup
from entity_events.settings import Settings, StaticFields

#: A step of the user's own between building documents and storing them.
Hook = Callable[[DataFrame], DataFrame]

#: Columns that place a document in the table and order it there.
REQUIRED = ("timestamp", "object_id", "data_stream", "seq")


def publish(
    readings: DataFrame,
    lookup: Lookup,
    settings: Settings | None = None,
    static: StaticFields | None = None,
    trusted: bool = False,
    hooks: Sequence[Hook] = (),
) -> DataFrame:
    """Documents of the readings (with ``reason``) that pass the rules; map-side but for the join.

    Readings whose attributes are no JSON object are left to :func:`quality.quarantined`. A feed that
    is ``trusted`` to have none skips that test, so queries that use no attribute never read them. Tags of
    the settings are used where the static fields give none. ``hooks`` change the documents at the end, see
    :func:`hooked`.
    """
    settings, static = settings or Settings(), static or StaticFields()
    if settings.tags and not static.tags:
        static = replace(static, tags=settings.tags)
    checked = readings if trusted else quality.readable(readings)
    return hooked(documents.build(filters.accepted(checked, lookup, settings), static), hooks)


def hooked(published: DataFrame, hooks: Sequence[Hook]) -> DataFrame:
    """The documents after all hooks, in order.

    A hook takes and returns documents; it may add, change and drop columns and rows. The columns that place a
    document in the table must stay, with their types; a hook that loses one is refused by name.
    """
    for hook in hooks:
        kinds = {name: published.schema[name].dataType for name in REQUIRED}
        published = hook(published)
        lost = [name for name, kind in kinds.items() if name not in published.columns or published.schema[name].dataType != kind]
        if lost:
            raise ValueError(f"hook {getattr(hook, '__name__', hook)} loses or changes {', '.join(lost)}")
    return published


def classify_and_publish(
    readings: DataFrame,
    lookup: Lookup,
    settings: Settings | None = None,
    static: StaticFields | None = None,
    trusted: bool = False,
    hooks: Sequence[Hook] = (),
) -> DataFrame:
    """Documents of readings that carry only their new state.

    Entities the rules refuse are left out before the shuffle that compares each reading with the
    one before it.
    """
    settings = settings or Settings()
    wanted = filters.targeted(readings, lookup, settings)
    return publish(changes.classify_readings(wanted), lookup, settings, static, trusted, hooks)
