r"""Attributes: parsing, filtering, key normalisation and nested values.

Attributes arrive as one JSON object per reading. They are kept as ``map<string, variant>``, so a
number stays a number, any attribute can be read as text, and users can cast the ones they care
about. Key order is the order in the document, which decides collisions.
"""

from collections.abc import Mapping, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.functions.ascii import closest_ascii

#: Reasons an attribute is not published.
SKIPPED_NAME = "skipped name"
BLANK_NAME = "blank name"

_VISIBLE = r"(?U)[^\s\x1c-\x1f]"
_NORMAL_NAME = "^[a-z0-9]++(?:_++[a-z0-9]++)*+\\z"
_LETTERS = r"(?s)\\u[0-9a-fA-F]{4}|\\.|[\x00-\x5B\x5D-\x7F]++|[^\x00-\x7F]"
#: ASCII characters other than word characters, then the capitals.
_SPACED = "".join(c for c in map(chr, range(128)) if not c.isalnum() and c != "_") + ascii_uppercase
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[{}]|[^"{}]++'


def parse(attributes: Column) -> Column:
    """JSON object text to ``map<string, variant>``."""
    return F.from_json(attributes, "map<string,variant>")


def reject_reason(key: Column) -> Column:
    """Why an attribute with this name is left out, null where it is kept.

    The blank test looks at the name as given: a name of punctuation only passes it, and normalises
    to the empty name later.
    """
    return F.when(key.isin(*fixed.SKIPPED_ATTRIBUTES), SKIPPED_NAME).when(
        ~key.rlike(_VISIBLE), BLANK_NAME
    )


def keep_publishable(attributes: Column) -> Column:
    """Drop attributes that have a reject reason."""
    return F.map_filter(attributes, lambda key, _: reject_reason(key).isNull())


def rejected(attributes: Column) -> Column:
    """Name and reason of each attribute that is left out: ``array<struct<key, reason>>``."""
    audited = F.transform(
        F.map_keys(attributes), lambda key: F.struct(key.alias("key"), reject_reason(key).alias("reason"))
    )
    return F.filter(audited, lambda entry: entry["reason"].isNotNull())


def normalize_name(name: Column) -> Column:
    """Closest ASCII spelling, other characters as single ``_``, trimmed and lowercase.

    Most names are in this form already and are only tested. What is no letter, digit or ``_`` becomes a space
    character by character, which costs far less than a pattern that matches each stretch; only longer stretches
    are matched.
    """
    spaced = F.translate(closest_ascii(name), _SPACED, " " * (len(_SPACED) - 26) + ascii_lowercase)
    words = F.translate(F.regexp_replace(spaced, " {2,}", " "), " ", "_")
    return F.when(name.rlike(_NORMAL_NAME), name).otherwise(F.btrim(words, F.lit("_")))


def collisions(attributes: Column) -> Column:
    """How many publishable attributes lose their value to a later one of the same name."""
    names = F.transform(F.map_keys(keep_publishable(attributes)), normalize_name)
    return F.size(names) - F.size(F.array_distinct(names))


def _ascii_text(token: Column) -> Column:
    """A JSON string with every letter beyond ASCII written as ``\\uxxxx`` of its UTF-16 units, in lower case."""

    def written(letter: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(letter, "UTF-16BE"))), "(.{4})", r"\\u$1")
        escape = F.concat(F.lit("\\u"), F.lower(F.substring(letter, 3, 4)))
        beyond = letter.rlike(r"[^\x00-\x7F]")
        return F.when(beyond, units).when(F.startswith(letter, F.lit("\\u")), escape).otherwise(letter)

    letters = F.regexp_extract_all(token, F.lit(_LETTERS), F.lit(0))
    return F.when(token.rlike(r"[^\x00-\x7F]|\\u"), F.array_join(F.transform(letters, written), "")).otherwise(token)


def _escaped(token: Column, depth: Column) -> Column:
    """JSON text quoted ``depth`` times over."""
    slashes = F.pow(F.lit(2), depth).cast("int")
    doubled = F.replace(token, F.lit("\\"), F.repeat(F.lit("\\"), slashes))
    return F.replace(doubled, F.lit('"'), F.concat(F.repeat(F.lit("\\"), slashes - 1), F.lit('"')))


def objects_as_text(value: Column) -> Column:
    """Rewrite JSON so that every object in it becomes a string holding its JSON text.

    An object inside an object is text inside text, at any depth. The text is walked token by token
    with the current object depth as state; ``, `` and ``: `` are the separators inside objects.
    """

    def step(state: Column, token: Column) -> Column:
        depth, out = state["depth"], state["out"]
        inner = F.when(F.startswith(token, F.lit('"')), _ascii_text(token)).otherwise(
            F.regexp_replace(token, "([,:])", "$1 ")
        )
        piece = (
            F.when(token == "{", F.concat(_escaped(F.lit('"'), depth), token))
            .when(token == "}", F.concat(token, _escaped(F.lit('"'), depth - 1)))
            .when(depth == 0, token)
            .otherwise(_escaped(inner, depth))
        )
        turn = F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        return F.struct((depth + turn).alias("depth"), F.concat(out, piece).alias("out"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))
    tokens = F.regexp_extract_all(value, F.lit(_TOKEN), F.lit(0))
    return F.aggregate(tokens, start, step, lambda state: state["out"])


def sorted_set(value: Column) -> Column:
    """Sort a JSON array and drop its repeats: numbers by value, other values by text."""
    items = F.transform(value.try_cast("array<variant>"), lambda item: F.to_json(item))

    def order(left: Column, right: Column) -> Column:
        a, b = left.try_cast("double"), right.try_cast("double")
        return (
            F.when((a < b) | (F.coalesce(a == b, F.lit(False)) & (left < right)), -1)
            .when((a > b) | (F.coalesce(a == b, F.lit(False)) & (left > right)), 1)
            .when(a.isNotNull() & b.isNull(), -1)
            .when(a.isNull() & b.isNotNull(), 1)
            .when(left < right, -1)
            .when(left > right, 1)
            .otherwise(0)
        )

    ordered = F.array_sort(F.array_distinct(items), order)
    return F.parse_json(F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")))


def _value_by_value(attributes: Column, parsed: Column, set_names: Column | None) -> Column:
    """Rewrite values one by one: objects to text, listed arrays to sorted sets."""
    # The text map keeps the key order inside nested objects, the variant does not.
    texts = F.map_entries(F.from_json(attributes, "map<string,string>"))

    def rewritten(entry: Column, text: Column) -> Column:
        value = entry["value"]
        new = F.when(
            F.to_json(value).rlike(r"^[\[{].*\{|^\{"), F.parse_json(objects_as_text(text["value"]))
        )
        if set_names is not None:
            new = new.when(F.array_contains(set_names, entry["key"]), sorted_set(value))
        return F.struct(entry["key"].alias("key"), new.otherwise(value).alias("value"))

    return F.map_from_entries(F.zip_with(F.map_entries(parsed), texts, rewritten))


def _rewritten(attributes: Column, parsed: Column, set_names: Column | None) -> Column:
    """Values in their published form, under the names as given.

    Readings with neither a nested object nor a set, nearly all of them, are left as they are.
    """
    special = F.contains(F.ltrim(attributes, F.lit("{ \t\r\n")), F.lit("{"))
    if set_names is not None:
        special = special | (F.size(set_names) > 0)
    return F.when(special, _value_by_value(attributes, parsed, set_names)).otherwise(parsed)


def published(attributes: Column, set_names: Column | None = None) -> Column:
    """Attribute JSON text to the published map.

    Leaves out rejected names, normalises the rest (the later of two equal names stays), writes
    objects as text, and sorts the arrays listed in ``set_names``, which stand for sets.
    """
    values = _rewritten(attributes, parse(attributes), set_names)
    return F.transform_keys(keep_publishable(values), lambda name, _: normalize_name(name))


def _not_null(_: Column, value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _not_empty(_: Column, value: Column) -> Column:
    return ~F.to_json(value).isin("[]", "{}")


def skip_empty(attributes: Column) -> Column:
    """Drop attributes that are null, an empty list or an empty object; 0, false and "" stay."""
    return F.map_filter(F.map_filter(attributes, _not_null), _not_empty)


def published_filled(attributes: Column, set_names: Column | None, parsed: Column) -> Column:
    """:func:`published` without the empty values, given the parsed text as well."""
    values = _rewritten(attributes, parsed, set_names)
    named = F.transform_keys(keep_publishable(values), lambda name, _: normalize_name(name))
    return skip_empty(named)


def keep_names(
    attributes: Column, names: Sequence[str] = (), prefixes: Sequence[str] = ()
) -> Column:
    """Keep entries whose name is listed or starts with a listed prefix; nothing listed keeps none."""

    def wanted(key: Column, _: Column) -> Column:
        tests = [key.isin(*names)] if names else []
        tests += [F.startswith(key, F.lit(prefix)) for prefix in prefixes]
        found = F.lit(False)
        for test in tests:
            found = found | test
        return found

    return F.map_filter(attributes, wanted)


def as_text(attributes: Column) -> Column:
    """Every attribute readable as text: ``map<string, string>``."""
    return F.transform_values(attributes, lambda _, value: value.try_cast("string"))


def typed(attributes: Column, types: Mapping[str, str]) -> list[Column]:
    """User-typed attributes as columns; a value that does not fit its type is null."""
    return [
        F.try_variant_get(attributes[name], "$", kind).alias(name) for name, kind in types.items()
    ]


def friendly_name(attributes: Column, object_id: Column) -> Column:
    """Display name: the ``friendly_name`` attribute, else the object id with spaces."""
    given = F.try_variant_get(attributes["friendly_name"], "$", "string")
    return F.coalesce(F.nullif(given, F.lit("")), F.replace(object_id, F.lit("_"), F.lit(" ")))


def location(attributes: Column) -> Column:
    """``[longitude, latitude]``, absent unless both are set; 0 counts as not set."""
    longitude, latitude = (
        F.try_variant_get(attributes[name], "$", "double") for name in ("longitude", "latitude")
    )
    return F.when((longitude != 0) & (latitude != 0), F.array(longitude, latitude))
