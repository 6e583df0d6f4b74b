r"""Typed readings of a free-text state.

A bare ``try_cast`` accepts more and less than a decimal literal should (``1d`` parses, ``1_000``
does not, ``inf`` does), so each cast stands behind a pattern. The repetitions are possessive:
a long text that almost matches fails without backtracking.
"""

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed

#: White space and decimal digits beyond ASCII that a number may have, from the Unicode database.
_WIDE_SPACES = "".join(chr(i) for i in range(0x80, sys.maxunicode + 1) if chr(i).isspace())
_WIDE_DIGITS = "".join(chr(i) for i in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd")
_NARROW = " " * len(_WIDE_SPACES) + "".join(str(unicodedata.decimal(digit)) for digit in _WIDE_DIGITS)

_DIGITS = r"\d++(?:_\d++)*+"
_NUMBER = rf"^\s*+[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*+$"

# date, then optionally: separator, hour:minute, seconds, fraction, offset
_DATETIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
    r"(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?)?)?\z"
)

# Rewrites that bring an accepted date-time text into its full ISO form, in this order.
_FULL_FORM = (
    (r"^(.{10})$", "$1T00:00:00"),  # a date alone is midnight
    (r"^(.{10}) ", "$1T"),
    (r"^(.{16})(?!:)", "$1:00"),  # no seconds
    (r"\.0+(?!\d)", ""),  # a zero fraction is not written
    (r"(\.\d+)", "$100000"),  # other fractions have six digits
    (r"(\.\d{6})\d+", "$1"),
    (r"(?:Z|[+-]00(?::?00)?)$", "+00:00"),
    (r"([+-]\d{2})$", "$1:00"),
    (r"([+-]\d{2})(\d{2})$", "$1:$2"),
)


def as_boolean(text: Column) -> Column:
    """True and false words, case-sensitive; null for any other text."""
    return F.when(text.isin(*fixed.TRUE_WORDS), F.lit(True)).when(
        text.isin(*fixed.FALSE_WORDS), F.lit(False)
    )


def as_number(text: Column) -> Column:
    """Finite decimal value of a number text (digit groups with ``_`` allowed), else null.

    Digits and white space of any script count; only texts that have such letters are rewritten for it.
    """
    narrow = F.translate(text, _WIDE_SPACES + _WIDE_DIGITS, _NARROW)
    text = F.when(text.rlike(r"[^\x00-\x7F]"), narrow).otherwise(text)
    number = F.regexp_replace(F.when(text.rlike(_NUMBER), text), r"[_\s]", "").try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_datetime(text: Column) -> Column:
    """Date-time parts of an ISO text, else null: ``struct<datetime, date, time>``.

    Parts are taken from the text, so the offset that was written stays and no session zone is
    involved. A text without a clock part means midnight.
    """
    full = F.when(text.rlike(_DATETIME), text)
    for pattern, replacement in _FULL_FORM:
        full = F.regexp_replace(full, pattern, replacement)

    def parts(moment: Column) -> Column:
        local = F.substring(moment, 1, 19).try_cast("timestamp_ntz")
        return F.when(
            local.isNotNull(),
            F.struct(
                moment.alias("datetime"),
                local.cast("date").alias("date"),
                F.regexp_extract(moment, "T([0-9:.]+)", 1).alias("time"),
            ),
        )

    return _bound(full, parts)


_BRANCHES = {
    "boolean": "boolean",
    "float": "double",
    "datetime": "string",
    "date": "date",
    "time": "string",
    "string": "string",
}


def _only(**filled: Column) -> Column:
    """Struct of all branches with only the given ones filled."""
    return F.struct(
        *(filled.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _BRANCHES.items())
    )


def coerce(text: Column) -> Column:
    """First reading that fits: boolean, number, date-time, else the text itself.

    Exactly one branch of the returned struct is filled (the three date-time fields are one branch),
    and a later branch is not computed once an earlier one fits.
    """
    flag, number = as_boolean(text), as_number(text)

    def moment_or_text(moment: Column) -> Column:
        return F.when(
            moment.isNotNull(),
            _only(datetime=moment["datetime"], date=moment["date"], time=moment["time"]),
        ).otherwise(_only(string=text))

    return (
        F.when(flag.isNotNull(), _only(boolean=flag))
        .when(number.isNotNull(), _only(float=number))
        .otherwise(_bound(as_datetime(text), moment_or_text))
    )


def as_integer(text: Column) -> Column:
    """Whole part of a number text for analyses; other text and overflow give null."""
    return as_number(text).try_cast("int")
