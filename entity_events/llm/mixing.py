"""Mixing sources to target weights.

Words are summed per source, targets are set by weight, and each source's repetition rate is its target
over its size. A document is emitted ``floor(rate)`` times, plus once more when its hash-seeded draw is
below the fraction of the rate. Built-in functions only.

Plan: one partial aggregate of (source, words) per input split, window functions over the table of
sources (one row per source), and a join of that table back to the documents. The table is written once and
broadcast up to a measured size; beyond it Spark shuffles, splitting a hot source by its adaptive skew join.
Documents are never grouped.

Defined results: a null text has no words; a null source is a source of its own, last in order; a null
``doc_id`` draws like the text ``null``; rows with the same ``doc_id`` share a draw; a source without
words has target 0 and rate 0; an empty table gives no rows. Other columns pass through untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entity_events.llm.common import joinable, unit_draw, word_count

#: Relative weights given to the sources in order of their names, repeated as often as needed.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix as a share of the words there are.
SHARE = 1.5
#: No source is repeated more than this often on average; a document never more than its ceiling.
MOST = 2.0
SEED = "mix-0"


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Size, weight, target and rate of every source of ``sized`` (source, size).

    A target above ``most`` times its source's size stops there, and what is left over goes to the other
    sources by weight. Seen from the sources in order of limit per weight, those that stop come first; the
    level the others share follows from sums before and after each place. The window has one row per
    source: it is the list of sources that somebody gave weights to, not data that grows with documents.
    """
    # Whole numbers up to 2**53 are exact as doubles, in whatever order they are added.
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    sources = (
        sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("place", F.row_number().over(Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))))
    )
    in_order = Window.orderBy("place")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = in_order.rowsBetween(0, Window.unboundedFollowing)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / F.sum("weight").over(from_here))
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    sources = sources.withColumn("shared", level)
    target = F.least("limit", F.coalesce(F.col("shared") * F.col("weight"), F.col("limit")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.withColumn("target", target).withColumn("rate", rate).select(
        "source", "source_size", "weight", "target", "rate"
    )


def copies(doc_id: Column, rate: Column, seed: str = SEED) -> Column:
    """How often the mix takes a document: floor of the rate, once more with its fraction as probability."""
    whole = F.floor(rate)
    return whole + F.when(unit_draw(seed, doc_id) < rate - whole, 1).otherwise(0)


def planned(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Every document as ``row`` (all its columns) with size, source_size, target and copies."""
    # The raw columns sit in one struct, so that names of theirs cannot clash with ours.
    sized = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col("source"),
        F.col("doc_id"),
        word_count(F.col("text")).alias("size"),
    )
    targets = joinable(source_targets(sized, weights, share, most).withColumnRenamed("source", "named"), "targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("named")), "left")
    return joined.select(
        "row", "doc_id", "size", "source_size", "target", copies(F.col("doc_id"), F.col("rate"), seed).alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` and ``copy``, each row as often as the mix takes it.

    A column of ``docs`` that is named ``copy`` is replaced.
    """
    plan = planned(docs, **options).where("copies > 0")
    number = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("number")
    names = [F.col(f"row.`{name}`").alias(name) for name in docs.columns if name != "copy"]
    return plan.select("row", number).select(*names, F.col("number").alias("copy"))
