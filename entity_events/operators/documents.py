"""Documents: the published form of a reading, nested for analysis and flat for storage."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entity_events import fixed_values as fixed
from entity_events.functions import attributes as attrs
from entity_events.functions import rules, text, values
from entity_events.settings import StaticFields

#: Dotted names of the top-level columns that do not keep their own name.
FIELD_NAMES = {
    "timestamp": fixed.TIMESTAMP_FIELD,
    "entity": fixed.ENTITY_FIELD,
    "attributes": fixed.ATTRIBUTES_FIELD,
    "value": fixed.ENTITY_FIELD + ".value",
    "valueas": fixed.ENTITY_FIELD + ".valueas",
    "object_id": fixed.ENTITY_FIELD + ".object.id",
}


def build(accepted: DataFrame, static: StaticFields | None = None) -> DataFrame:
    """Readings with ``details`` and ``reason`` to documents; one projection, no shuffle.

    ``attributes`` is a map of variants, ``valueas`` has one branch filled, and what is empty is null.
    """
    accepted = accepted.withColumn("_parsed", attrs.parse(F.col("attributes")))
    raw = F.col("_parsed")
    object_id = text.object_id_of(F.col("entity_id"))
    details = F.col("details")
    set_names = F.col("set_names") if "set_names" in accepted.columns else None
    detail_fields = accepted.schema["details"].dataType.fieldNames()
    documents = accepted.select(
        F.col("time").alias("timestamp"),
        F.struct(
            text.action_text(F.col("reason")).alias("action"),
            F.lit(fixed.EVENT_KIND).alias("kind"),
            text.event_type(F.col("reason")).alias("type"),
        ).alias("event"),
        F.struct(
            *(details[name].alias(name) for name in detail_fields),
            attrs.friendly_name(raw, object_id).alias("friendly_name"),
            attrs.location(raw).alias("location"),
        ).alias("entity"),
        attrs.published_filled(F.col("attributes"), set_names, raw).alias("attributes"),
        F.col("state").alias("value"),
        values.coerce(F.col("state")).alias("valueas"),
        object_id.alias("object_id"),
        text.data_stream(text.domain_of(F.col("entity_id"))).alias("data_stream"),
        F.col("seq"),
    )
    return with_static(documents, static or StaticFields())


def with_static(documents: DataFrame, static: StaticFields) -> DataFrame:
    """Add the run-level constants as columns; fields without a value stay out."""
    return documents.withColumns(
        {name: _literal(value) for name, value in _nested(static.dotted()).items()}
    )


def _nested(dotted: Mapping[str, Any]) -> dict[str, Any]:
    tree: dict[str, Any] = {}
    for name, value in dotted.items():
        *parents, leaf = name.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = value
    return tree


def _literal(value: Any) -> Column:
    if isinstance(value, Mapping):
        return F.struct(*(_literal(inner).alias(name) for name, inner in value.items()))
    return F.lit(value)


def _leaves(column: Column, kind: T.DataType, name: str) -> Iterator[tuple[str, Column, T.DataType]]:
    if isinstance(kind, T.StructType):
        for inner in kind.fields:
            yield from _leaves(column[inner.name], inner.dataType, f"{name}.{inner.name}")
    else:
        yield name, column, kind


def flat_fields(
    df: DataFrame, names: Mapping[str, str] | None = None
) -> list[tuple[str, Column, T.DataType]]:
    """Dotted name, column and type of every leaf; lists and maps count as leaves."""
    names = names or {}
    return [
        leaf
        for field in df.schema.fields
        for leaf in _leaves(
            F.col(f"`{field.name}`"), field.dataType, names.get(field.name, field.name)
        )
    ]


def flatten(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Nested records to one column per leaf, named by its dotted path."""
    return df.select(*(column.alias(name) for name, column, _ in flat_fields(df, names)))


def keep_columns(
    flat: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()
) -> DataFrame:
    """Columns that are listed or start with a listed prefix; nothing listed keeps none."""
    kept = [
        name for name in flat.columns if name in names or any(name.startswith(p) for p in prefixes)
    ]
    return flat.select(*(F.col(f"`{name}`") for name in kept))


def _blank_to_null(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(column) > 0, column)
    return column


def skip_empty_columns(flat: DataFrame) -> DataFrame:
    """Empty lists and maps to null; 0, false and "" stay."""
    return flat.select(
        *(
            _blank_to_null(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            for f in flat.schema.fields
        )
    )


def prepare(
    df: DataFrame, names: Mapping[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Flatten, keep the listed columns (all when none is listed), and null what is empty."""
    flat = flatten(df, names)
    return skip_empty_columns(keep_columns(flat, keep) if keep else flat)


def override(flat: DataFrame, fields: Mapping[str, Any]) -> DataFrame:
    """Set constant fields on a flat document; they win over fields of the same name."""
    return flat.withColumns({name: F.lit(value) for name, value in fields.items()})


def with_search_columns(documents: DataFrame) -> DataFrame:
    """Documents with the columns that searches use beside the published ones, in one struct ``search``.

    ``value_keyword`` is the exact-match form of the state and absent for long ones; ``integer`` is the whole part
    of a number; ``date`` and ``time`` are the parts of a date-time state in their strict forms, each absent where
    the text is malformed; ``attributes`` holds the exact-match form of each attribute's text. What cannot be read
    as its column's type is left out of that column alone, and the document stays.
    """
    state = F.col("value")
    texts = attrs.as_text(F.col("attributes"))
    kept = F.map_filter(texts, lambda _, given: rules.keyword(given).isNotNull())
    return documents.withColumn(
        "search",
        F.struct(
            rules.keyword(state).alias("value_keyword"),
            values.as_integer(state).alias("integer"),
            rules.strict_date(F.substring_index(state, "T", 1)).alias("date"),
            rules.clock_time(F.substr(state, F.instr(state, "T") + 1)).alias("time"),
            kept.alias("attributes"),
        ),
    )


def document_line(documents: DataFrame) -> Column:
    """Flat JSON text of a document: dotted names, compact, without empty fields."""
    stored = documents.drop("seq")
    before: list[Column] = []
    after: list[Column] = []
    side = before
    for name, column, kind in flat_fields(stored, FIELD_NAMES):
        if name == fixed.ATTRIBUTES_FIELD:
            side = after
            continue
        column = text.iso_utc(column) if name == fixed.TIMESTAMP_FIELD else column
        side.append(_blank_to_null(column, kind).alias(name))
    named = F.transform_keys(
        F.col("attributes"), lambda key, _: F.concat(F.lit(fixed.ATTRIBUTES_FIELD + "."), key)
    )
    parts = [F.to_json(F.struct(*before)), F.to_json(named), F.to_json(F.struct(*after))]
    inner = [F.nullif(F.substr(p, F.lit(2), F.length(p) - 2), F.lit("")) for p in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))
