"""Analyses of published documents.

The kinds of analysis are the usual dashboard panels and alerts; window widths and aggregates are
choices of this library.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entity_events.operators.skew import HOT_ROWS, with_neighbours, with_segments

VALUE = "valueas.float"


def search(
    documents: DataFrame,
    start: datetime,
    end: datetime,
    columns: Sequence[str],
    condition: Column | None = None,
) -> DataFrame:
    """Chosen columns of the documents in ``[start, end)`` that meet the condition."""
    found = documents.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    if "event_date" in documents.columns:
        first, last = (moment.astimezone(UTC).date() for moment in (start, end))
        found = found.where(F.col("event_date").between(F.lit(first), F.lit(last)))
    if condition is not None:
        found = found.where(condition)
    return found.select(*columns)


def value_over_time(
    documents: DataFrame, condition: Column | None = None, width: str = "1 hour"
) -> DataFrame:
    """Average, minimum, maximum and number of numeric values per entity and time bucket.

    The condition picks the entities: by id, by friendly name, or by area. On a stream of documents with a
    watermark, each bucket is given out once, when the watermark has passed its end.
    """
    numeric = documents.where(F.col(VALUE).isNotNull())
    if condition is not None:
        numeric = numeric.where(condition)
    value = F.col(VALUE)
    return (
        numeric.groupBy(F.col("entity.id").alias("entity_id"), F.window("timestamp", width))
        .agg(
            F.avg(value).alias("average"),
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
            F.count(value).alias("readings"),
        )
        .select("entity_id", F.col("window.start").alias("bucket"), "average", "lowest", "highest", "readings")
    )


def _series(documents: DataFrame, *columns: Column) -> DataFrame:
    return documents.select(F.col("entity.id").alias("entity_id"), "timestamp", "seq", *columns)


def time_in_state(documents: DataFrame, until: datetime, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Seconds each entity spent in each state per UTC day.

    A state lasts until the next reading of its entity, the last one until ``until``. An interval
    that crosses midnight counts for each of its days.
    """
    series = _series(documents, F.col("value").alias("state"))
    spans = with_neighbours(
        series, "entity_id", "timestamp", ["timestamp"], following=True, hot_rows=hot_rows
    )
    last = F.unix_micros(F.lit(until).cast("timestamp"))
    start = F.unix_micros("timestamp")
    end = F.least(F.coalesce(F.unix_micros("following.timestamp"), last), last)
    spans = spans.select("entity_id", "state", start.alias("start"), end.alias("end")).where(
        "end > start"
    )
    first_day, last_day = (F.timestamp_micros(c).cast("date") for c in (F.col("start"), F.col("end") - 1))
    days = spans.withColumn("day", F.explode(F.sequence(first_day, last_day)))
    midnight = F.unix_micros(F.col("day").cast("timestamp"))
    next_midnight = F.unix_micros(F.date_add("day", 1).cast("timestamp"))
    inside = F.least("end", next_midnight) - F.greatest("start", midnight)
    return (
        days.groupBy("entity_id", "state", "day")
        .agg(F.sum(inside).alias("micros"))
        .select("entity_id", "state", "day", (F.col("micros") / 1_000_000).alias("seconds"))
    )


def panel(documents: DataFrame, entities: Sequence[str], width: str = "1 hour") -> DataFrame:
    """Average value of several entities side by side on one time axis."""
    chosen = documents.where(F.col("entity.id").isin(*entities) & F.col(VALUE).isNotNull())
    return (
        chosen.groupBy(F.window("timestamp", width)["start"].alias("bucket"))
        .pivot("entity.id", list(entities))
        .agg(F.avg(VALUE))
    )


def sustained_deviation(
    documents: DataFrame, deviates: Column, minutes: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Runs of consecutive deviating values that span at least ``minutes``.

    A run ends at its last deviating reading. Readings of a run have the same number of readings before
    them that do not deviate: one running count per entity, and one aggregate of narrow rows. A hot entity
    is counted segment by segment, and each segment begins from the counts of those before it.
    """
    numeric = documents.where(F.col(VALUE).isNotNull())
    series = _series(numeric, F.coalesce(deviates, F.lit(False)).alias("deviates"))
    cut, any_hot = with_segments(series, "entity_id", "timestamp", hot_rows)
    calm = (~F.col("deviates")).cast("long")
    inside = Window.partitionBy("entity_id", "_segment").orderBy("timestamp", "seq")
    counted = cut.withColumn("run", F.sum(calm).over(inside))
    if any_hot:
        along = Window.partitionBy("entity_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
        totals = cut.where("_segment > 0").groupBy("entity_id", "_segment").agg(F.sum(calm).alias("calm"))
        before = totals.select("entity_id", "_segment", F.sum("calm").over(along).alias("before"))
        counted = counted.join(before, ["entity_id", "_segment"], "left")
        counted = counted.withColumn("run", F.col("run") + F.coalesce("before", F.lit(0)))
    runs = counted.where("deviates").groupBy("entity_id", "run")
    runs = runs.agg(F.min("timestamp").alias("started"), F.max("timestamp").alias("ended")).drop("run")
    micros = F.unix_micros("ended") - F.unix_micros("started")
    return runs.where(micros >= minutes * 60_000_000)


def threshold_breaches(
    documents: DataFrame, by: Sequence[Column], low: float, high: float, width: str = "1 hour"
) -> DataFrame:
    """Groups and time buckets whose values leave ``[low, high]``; on a stream with a watermark, once they are over."""
    numeric = documents.where(F.col(VALUE).isNotNull())
    buckets = numeric.groupBy(*by, F.window("timestamp", width)).agg(F.min(VALUE).alias("lowest"), F.max(VALUE).alias("highest"))
    groups = [name for name in buckets.columns if name not in ("window", "lowest", "highest")]
    return buckets.where((F.col("lowest") < low) | (F.col("highest") > high)).select(
        *groups, F.col("window.start").alias("bucket"), "lowest", "highest"
    )


def trend_partials(documents: DataFrame) -> DataFrame:
    """Sums that trends can be had from after the documents are gone: a row per floor, area and month.

    ``total`` and ``readings`` add up; ``sketch`` merges and gives quantiles within about 1.7 hundredths of rank.
    """
    value = F.col(VALUE)
    return (
        documents.where(value.isNotNull())
        .groupBy(
            F.col("entity.area.floor.name").alias("floor"),
            F.col("entity.area.name").alias("area"),
            F.trunc("timestamp", "month").alias("month"),
        )
        .agg(F.sum(value).alias("total"), F.count(value).alias("readings"), F.kll_sketch_agg_double(value).alias("sketch"))
    )


def record_trend(documents: DataFrame, path: str, batch: str) -> None:
    """Write the partials of a batch of documents in a folder of its own; a batch that is run again replaces them."""
    trend_partials(documents).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def recorded_trend(partials: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The trend of all recorded batches, with quantiles of each row (``quantiles``, in the order asked for).

    Means are exact whatever the batches were; levels are those of :func:`trend`. Partials are merged per month
    first, so the rollup repeats one sketch a month.
    """
    monthly = partials.groupBy("floor", "area", "month").agg(
        F.sum("total").alias("total"), F.sum("readings").alias("readings"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    levels = monthly.rollup("floor", "area", "month").agg(
        F.grouping_id().alias("level"),
        F.sum("total").alias("total"),
        F.sum("readings").alias("readings"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    at = F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in quantiles))
    average = (F.col("total") / F.col("readings")).alias("average")
    return levels.where(F.col("readings").isNotNull()).select(
        "floor", "area", "month", "level", average, "readings", at.alias("quantiles")
    )


def trend(documents: DataFrame) -> DataFrame:
    """Monthly averages per floor and area, with totals per area, per floor and overall.

    ``level`` tells the rows apart: 0 month, 1 area, 3 floor, 7 overall. Values are summed per month
    first, so the rollup repeats only those sums.
    """
    monthly = (
        documents.where(F.col(VALUE).isNotNull())
        .groupBy(
            F.col("entity.area.floor.name").alias("floor"),
            F.col("entity.area.name").alias("area"),
            F.trunc("timestamp", "month").alias("month"),
        )
        .agg(F.sum(VALUE).alias("total"), F.count(VALUE).alias("readings"))
    )
    return (
        monthly.rollup("floor", "area", "month")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("total").alias("total"),
            F.sum("readings").alias("readings"),
        )
        .select("floor", "area", "month", "level", (F.col("total") / F.col("readings")).alias("average"), "readings")
    )


def tagged(documents: DataFrame, tag: str) -> DataFrame:
    """Documents that carry a tag; none do where the run set no tags."""
    if "tags" not in documents.columns:
        return documents.where(F.lit(False))
    return documents.where(F.array_contains("tags", tag))


def latest_value(documents: DataFrame) -> DataFrame:
    """Newest value of each entity."""
    newest = F.max_by(F.struct("timestamp", "value"), F.struct("timestamp", "seq")).alias("newest")
    return documents.groupBy(F.col("entity.id").alias("entity_id")).agg(newest).select(
        "entity_id", "newest.*"
    )
