"""Joins and neighbour lookups that hold when one key owns a large share of the rows.

A key is *hot* when it has more than ``hot_rows`` rows. Hot keys are found by counting, with partial
aggregation before the shuffle; there are at most as many as ``rows / hot_rows``, and every one of them is
split. Their table is broadcast where its size, known from the count, allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
BROADCAST_BYTES = 128 << 20


def _hot_keys(df: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame, int, int]:
    """Keys with more than ``hot_rows`` rows (key, _parts), their number, and the most parts of one."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    hot = counted.select(key, F.ceil(F.col("_rows") / F.lit(hot_rows)).alias("_parts"))
    keys, most = hot.agg(F.count(F.lit(1)), F.coalesce(F.max("_parts"), F.lit(0))).first()
    return hot, keys, most


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast a table of a known number of rows where it is small enough."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def measured_bytes(df: DataFrame) -> int:
    """Size of a table by one aggregate over it: the bytes of its rows written as JSON."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key, joined by broadcast where its measured size allows it."""

    rows: DataFrame
    key: str
    small: bool

    @classmethod
    def measured(cls, rows: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> Lookup:
        return cls(rows, key, measured_bytes(rows) <= limit)

    def with_rows(self, rows: DataFrame) -> Lookup:
        """The same lookup over rows that are no larger, such as a subset."""
        return Lookup(rows, self.key, self.small)

    def join(
        self,
        left: DataFrame,
        how: str,
        spread: Sequence[str] = ("time", "seq"),
        hot_rows: int = HOT_ROWS,
    ) -> DataFrame:
        """Join ``left`` to the lookup.

        Beyond the broadcast limit both sides are shuffled by key, and the rows of a hot key are
        spread over several parts by a hash of ``spread``; only the lookup rows of hot keys are
        repeated, once per part.
        """
        if self.small:
            return left.join(F.broadcast(self.rows), self.key, how)
        hot, keys, _ = _hot_keys(left, self.key, hot_rows)
        if not keys:
            return left.join(self.rows, self.key, how)
        hot = _small(hot, keys, 64)
        part = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0))
        spread_left = left.join(hot, self.key, "left").withColumn("_part", part)
        last_part = F.coalesce(F.col("_parts"), F.lit(1)) - 1
        repeated = (
            self.rows.join(hot, self.key, "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part)))
            .drop("_parts")
        )
        return spread_left.drop("_parts").join(repeated, [self.key, "_part"], how).drop("_part")


def _cuts(rows: DataFrame, by: Sequence[str], value: Column, parts: int) -> DataFrame:
    """Per group of ``by`` the values that divide its rows into about ``parts`` equal shares."""
    shares = [i / parts for i in range(1, parts)]
    return rows.groupBy(*by).agg(F.percentile_approx(value, shares, 20 * parts).alias("_cuts"))


def _below(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut < value))


def with_segments(
    df: DataFrame, key: str, time: str, hot_rows: int, tie: str | None = "seq"
) -> tuple[DataFrame, bool]:
    """Add ``_segment``: 1, 2, ... along the order of a hot key, about ``hot_rows`` rows each; 0 for others.

    Also tells whether there is any hot key. Segments end at quantiles of the key's times, so bursts and
    outliers do not matter. An instant that holds more rows than a segment should is a segment of its own
    and is divided further along ``tie``.
    """
    hot, keys, most = _hot_keys(df, key, hot_rows)
    if not keys:
        return df.withColumn("_segment", F.lit(0)), False
    micros = F.unix_micros(F.col(time))
    parts = max(2, 2 * most)
    rows = df.join(_small(hot, keys, 64), key, "left_semi")
    cuts = _cuts(rows, [key], micros, parts)
    # A cut that occurs twice is an instant with more rows than a share.
    cuts = cuts.select(
        key,
        F.array_distinct("_cuts").alias("_ends"),
        F.array_distinct(
            F.filter("_cuts", lambda cut, i: (i > 0) & (cut == F.get("_cuts", i - 1)))
        ).alias("_instants"),
    )
    cut = df.join(_small(cuts, keys, 64 + 16 * parts), key, "left")
    crowded = F.coalesce(F.array_contains("_instants", micros), F.lit(False))
    place = 2 * _below(F.col("_ends"), micros) + crowded.cast("int")
    cut = cut.withColumn("_place", F.coalesce(place, F.lit(-1))).withColumn("_crowded", crowded)
    segment = F.when(F.col("_ends").isNull(), F.lit(0)).otherwise(F.col("_place").cast("long") * parts + 1)
    if tie:
        inner = _cuts(cut.where("_crowded"), [key, "_place"], F.col(tie), parts)
        inner = inner.select(key, "_place", F.col("_cuts").alias("_inner"))
        cut = cut.join(_small(inner, keys * parts, 64 + 8 * parts), [key, "_place"], "left")
        segment = segment + F.coalesce(_below(F.array_distinct("_inner"), F.col(tie)), F.lit(0))
    return cut.withColumn("_segment", segment).select(*(F.col(name) for name in df.columns), "_segment"), True


def with_neighbours(
    df: DataFrame,
    key: str,
    time: str,
    values: Sequence[str],
    *,
    tie: str | None = "seq",
    previous: bool = False,
    following: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``previous`` and/or ``following``: the ``values`` of the next row of the key in time.

    A row without such a neighbour gets null. The history of a hot key is cut into segments of about
    ``hot_rows`` rows that are ordered independently; the row next to a segment border is taken from the
    first and last row of each segment, a table of one row per segment. Without hot keys there is nothing
    to cut or to join.
    """
    order = [time] + ([tie] if tie else [])
    cut, any_hot = with_segments(df, key, time, hot_rows, tie)
    taken, position = F.struct(*values), F.struct(*order)
    before = after = F.lit(None)
    out = cut
    if any_hot:
        borders = (
            cut.where("_segment > 0")
            .groupBy(key, "_segment")
            .agg(
                F.min_by(taken, position).alias("_first"),
                F.max_by(taken, position).alias("_last"),
            )
        )
        along = Window.partitionBy(key).orderBy("_segment")
        borders = borders.select(
            key,
            "_segment",
            F.lag("_last").over(along).alias("_before"),
            F.lead("_first").over(along).alias("_after"),
        )
        out = cut.join(borders, [key, "_segment"], "left")
        before, after = F.col("_before"), F.col("_after")
    within = Window.partitionBy(key, "_segment").orderBy(*order)
    if previous:
        out = out.withColumn("previous", F.coalesce(F.lag(taken).over(within), before))
    if following:
        out = out.withColumn("following", F.coalesce(F.lead(taken).over(within), after))
    return out.drop("_segment", "_before", "_after")
