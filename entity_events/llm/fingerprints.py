"""Document fingerprints by winnowing, with built-in functions only.

A text is a list of units: words, cut after ``LONGEST`` code points, and single letters of scripts that put
no spaces between words. Every ``GRAM`` consecutive units have a hash that is rolled along the text; of every
``WINDOW`` consecutive hashes the smallest is chosen, the rightmost on ties, and kept with its place. Any two
texts that share ``GRAM + WINDOW - 1`` consecutive units share a chosen hash.

Defined results: a null or empty text has no units and an empty fingerprint; a text of fewer than ``GRAM``
units has one hash over all of them, one of fewer than ``WINDOW`` hashes is one window; two empty
fingerprints are alike (1.0), an empty one and another are not (0.0); equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4
#: A power of two: the place inside a window takes the low bits of a hash.
WINDOW = 8
LONGEST = 16

_SINGLE = r"฀-๿぀-ヿ㐀-鿿豈-﫿\x{20000}-\x{3FFFF}"
UNIT = rf"[{_SINGLE}]|[^\x20\x09-\x0D{_SINGLE}]{{1,{LONGEST}}}"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def gram_hashes(text: Column) -> Column:
    """Hashes of all grams of a text, their low bits clear."""
    units = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))

    def rolled(hashes: Column) -> Column:
        last = F.greatest(F.size(hashes) - GRAM, F.lit(0))
        grams = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(GRAM))).bitwiseAND(F.lit(-WINDOW)),
        )
        return F.when(F.size(hashes) > 0, grams).otherwise(F.expr("CAST(array() AS array<bigint>)"))

    return _let(units, rolled)


def fingerprint(text: Column) -> Column:
    """``hashes`` and ``places`` (from 0, in units) that winnowing chooses from a text, in order."""

    def winnowed(grams: Column) -> Column:
        # Low bits fall from left to right, so the smallest of equal hashes is the rightmost.
        def place(start: Column) -> Column:
            keys = (F.get(grams, start + j).bitwiseOR(F.lit(WINDOW - 1 - j)) for j in range(WINDOW))
            return (start + (WINDOW - 1) - F.least(*keys).bitwiseAND(F.lit(WINDOW - 1))).cast("int")

        starts = F.sequence(F.lit(0), F.greatest(F.size(grams) - WINDOW, F.lit(0)))
        places = F.when(F.size(grams) > 0, F.array_distinct(F.transform(starts, place)))
        places = F.coalesce(places, F.expr("CAST(array() AS array<int>)"))
        return _let(
            places,
            lambda chosen: F.struct(F.transform(chosen, lambda i: F.get(grams, i)).alias("hashes"), chosen.alias("places")),
        )

    return _let(gram_hashes(text), winnowed)


def as_text(fingerprint: Column) -> Column:
    """``hash:place`` of every choice, comma-joined."""
    pairs = F.zip_with(fingerprint["hashes"], fingerprint["places"], lambda h, p: F.concat(F.hex(h), F.lit(":"), p))
    return F.array_join(pairs, ",")


def likeness(one: Column, other: Column) -> Column:
    """Share of the hashes of two fingerprints that both have."""
    both = F.size(F.array_intersect(one["hashes"], other["hashes"]))
    either = F.size(F.array_union(one["hashes"], other["hashes"]))
    return F.when(either > 0, both / either).otherwise(F.lit(1.0))


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``doc_id``, ``text``, ``print``, and ``next_text``, ``next_print`` of the document after it by id.

    Documents are dealt into ranges of ids that hold about as many rows each, by quantiles of the ids; each
    range is sorted on its own, with a copy of the next range's first row at its end, the last range with a
    copy of the very first row. One shuffle of texts. Null ids come last; rows with one
    id are ordered by text.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    cuts = sorted(set(cuts or []))
    # The number of cuts at or below the id; nulls lie in a range of their own.
    part = F.size(F.filter(F.array(*(F.lit(cut).cast("long") for cut in cuts)), lambda cut: cut <= F.col("doc_id")))
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(part if cuts else F.lit(0))
    docs = docs.withColumn("part", part.cast("int"))

    # The first row of each range also goes to the range before it, as its border; one row a range.
    first_ids = docs.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    in_order = Window.orderBy("part")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(in_order), F.last("part").over(everything))
    borders = first_ids.select(F.col("part").alias("first_of"), "first_id", before.alias("border_of"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("part") == F.col("first_of"))
    firsts = docs.join(F.broadcast(borders), same).groupBy("border_of", "doc_id").agg(F.min("text").alias("text"))
    firsts = firsts.select("doc_id", "text", F.col("border_of").alias("part"), F.lit(True).alias("border"))

    ranges = docs.withColumn("border", F.lit(False)).unionByName(firsts)
    ranges = ranges.repartition(len(cuts) + 2, "part").withColumn("print", fingerprint(F.col("text")))
    by_id = Window.partitionBy("part").orderBy("border", F.asc_nulls_last("doc_id"), "text")
    ranges = ranges.select("*", F.lead("text").over(by_id).alias("next_text"), F.lead("print").over(by_id).alias("next_print"))
    return ranges.where(~F.col("border")).select("doc_id", "text", "print", "next_text", "next_print")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter of code points replaced by the first as many of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))
