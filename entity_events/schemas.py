"""Declared schemas of the inputs; nothing is inferred from files."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_text, _time, _labels = T.StringType(), T.TimestampType(), T.ArrayType(T.StringType())

STATE = _struct(
    ("entity_id", _text),
    ("state", _text),
    ("attributes", _text),
    ("last_changed", _time),
    ("last_updated", _time),
)

#: A change event as fired by the source system; a null ``new_state`` is a removal.
CHANGE_EVENT = _struct(("time_fired", _time), ("old_state", STATE), ("new_state", STATE))

#: Column with the text of a feed line that is not a change event; null beside one that is.
UNREADABLE_LINE = "unreadable_line"

#: One reading of one entity. ``seq`` breaks ties between readings of the same instant.
READING = _struct(
    ("entity_id", _text),
    ("time", _time),
    ("seq", T.LongType()),
    ("state", _text),
    ("attributes", _text),
)

ENTITY = _struct(
    ("entity_id", _text),
    ("domain", _text),
    ("object_id", _text),
    ("name", _text),
    ("original_name", _text),
    ("device_class", _text),
    ("original_device_class", _text),
    ("area_id", _text),
    ("device_id", _text),
    ("labels", _labels),
    ("platform", _text),
    ("unit_of_measurement", _text),
)

DEVICE = _struct(
    ("id", _text),
    ("name", _text),
    ("name_by_user", _text),
    ("area_id", _text),
    ("labels", _labels),
)

AREA = _struct(("id", _text), ("name", _text), ("floor_id", _text))

FLOOR = _struct(("floor_id", _text), ("name", _text))

_cause = _struct(("type", _text), ("reason", _text))
_failure = _struct(("type", _text), ("reason", _text), ("caused_by", _cause))
_outcome = _struct(
    ("_index", _text),
    ("_id", _text),
    ("status", T.IntegerType()),
    ("result", _text),
    ("error", _failure),
)

#: Answer of a bulk append: one item per row, keyed by the operation name.
BULK_RESPONSE = _struct(
    ("errors", T.BooleanType()),
    ("took", T.LongType()),
    ("items", T.ArrayType(T.MapType(T.StringType(), _outcome))),
)

#: Append-only log of published streams: the newest row per name is current.
MANIFEST = _struct(
    ("name", _text),
    ("schema_version", T.IntegerType()),
    ("generation", T.IntegerType()),
)
