"""Column rules of the published schema."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed

_CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d"
_ZONE = r"(?:Z|[+-]\d{2}:?\d{2})"


def keyword(text: Column) -> Column:
    """Exact-match form of a text: absent above the keyword limit, the text column itself stays."""
    return F.when(F.char_length(text) <= fixed.KEYWORD_LIMIT, text)


def tolerant(text: Column, kind: str) -> Column:
    """Number of the given type, null where the text is malformed."""
    return text.try_cast(kind)


def strict_date(text: Column) -> Column:
    """Calendar date written as ``yyyy-MM-dd``, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text).try_cast("date")


def clock_time(text: Column) -> Column:
    """Clock text in one of the four accepted forms, else null.

    The forms are hour, minute and second alone, with six fraction digits, with a zone, and with
    a fraction and a zone.
    """
    return F.when(text.rlike(rf"^{_CLOCK}(?:\.\d{{6}}|(?:\.\d{{1,9}})?{_ZONE})?\z"), text)
