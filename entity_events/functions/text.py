"""Names, identifiers, labels and time text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed


def sanitize_domain(domain: Column) -> Column:
    """Lowercase, keep ``a-z 0-9 _``, and cut to the dataset-name limit."""
    kept = F.regexp_replace(F.lower(domain), "[^a-z0-9_]", "")
    return F.substring(kept, 1, fixed.DATASET_NAME_LIMIT)


def data_stream(domain: Column) -> Column:
    """Return the ``type / dataset / namespace`` triple a domain is published under."""
    return F.struct(
        F.lit(fixed.STREAM_TYPE).alias("type"),
        F.concat(F.lit(fixed.DATASET_PREFIX + "."), sanitize_domain(domain)).alias("dataset"),
        F.lit(fixed.STREAM_NAMESPACE).alias("namespace"),
    )


def stream_name(stream: Column) -> Column:
    """Join a triple into the name of its stream."""
    return F.concat_ws("-", stream["type"], stream["dataset"], stream["namespace"])


def domain_of(entity_id: Column) -> Column:
    """Part of an entity id before the first dot."""
    return F.substring_index(entity_id, ".", 1)


def object_id_of(entity_id: Column) -> Column:
    """Part of an entity id after the first dot."""
    return F.substr(entity_id, F.instr(entity_id, ".") + F.lit(1))


def first_filled(preferred: Column, fallback: Column) -> Column:
    """Take the preferred text, or the fallback where it is null or empty."""
    return F.coalesce(F.nullif(preferred, F.lit("")), fallback)


def sorted_labels(labels: Column) -> Column:
    """Labels in ascending order."""
    return F.array_sort(labels)


def iso_utc(time: Column) -> Column:
    """ISO text of an instant; microseconds only where they are not zero."""
    full = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.replace(full, F.lit(".000000"), F.lit("")), F.lit("+00:00"))


def action_text(reason: Column) -> Column:
    """Published wording of a reason; whatever is no change counts as a poll."""
    return (
        F.when(reason == fixed.STATE, fixed.ACTION_TEXT[fixed.STATE])
        .when(reason == fixed.ATTRIBUTE, fixed.ACTION_TEXT[fixed.ATTRIBUTE])
        .otherwise(fixed.ACTION_TEXT[fixed.POLLING])
    )


def event_type(reason: Column) -> Column:
    """``info`` for polled readings, ``change`` for the rest."""
    return F.when(reason == fixed.POLLING, fixed.POLL_TYPE).otherwise(fixed.CHANGE_TYPE)
