"""Benchmark decontamination by winnowing.

Texts are words, in lower case. Every ``GRAM`` consecutive words have a hash; of every ``WINDOW - GRAM + 1``
consecutive hashes the smallest is a fingerprint, the rightmost on ties. Both sides choose by content alone,
so any ``WINDOW`` words that a document shares with an item contain a fingerprint that both chose: no shared
window is missed. Fingerprints are joined, and each hit is extended to both sides while the words agree; a
run of ``WINDOW`` words or more is contamination. An item with fewer words is one window of its own length,
found by its own hash.

Plan: items are fingerprinted into a small table. Its hashes also fill a bitmap of fixed size
(``FILTER_BITS``), which each task uses to drop fingerprints that no item has before any shuffle; it only
lets too many through, never too few. What is left, a few rows per copied passage, is joined with the items'
table by fingerprint: broadcast or shuffled by measured size, with hot fingerprints split by the adaptive
skew join. Per document its runs and items are gathered into a small table, which documents meet in one join:
broadcast up to a measured size, so that texts are shuffled only beyond it.

Defined results: a null or empty text has no words, no hits and is clean; items without words match nothing;
null document ids and repeated rows get a result each; items of one id count once; an empty benchmark leaves
every document clean; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity_events.llm.common import ALPHANUMERIC, Texts, Words, gram_hashes, joinable, mix, small_batches, text_slices, words_of

WINDOW = 13
GRAM = 7
CHOICES = WINDOW - GRAM + 1
#: Words to each side of a fingerprint that a window around it can reach.
REACH = WINDOW - GRAM

#: Contaminated: words in shared windows are at least one in so many.
SHARE = 20

FILTER_BITS = 24

#: Words in Java's notation, before A-Z are put in lower case.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def chosen(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: of each window of grams from ``starts``, the smallest, rightmost on ties."""
    if not len(starts):
        return starts
    best, place = grams[starts], starts.copy()
    for step in range(1, CHOICES):
        other = grams[starts + step]
        better = other <= best
        best = np.where(better, other, best)
        place = np.where(better, starts + step, place)
    return np.unique(place)


def _window_starts(words: Words, length: int) -> np.ndarray:
    """Places from where ``length`` words lie in one text."""
    n = len(words.hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[:n] == words.text[length - 1 :])


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - FILTER_BITS)
    return (hashes >> shift).astype(np.int64), (mix(hashes) >> shift).astype(np.int64)


def _short_hash(words: Words, starts: np.ndarray, length: int) -> np.ndarray:
    return gram_hashes(words.hashes, length)[starts] if len(starts) else np.zeros(0, np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _context(words: Words, places: np.ndarray) -> pa.Array:
    """Hashes of the words from ``REACH`` before each place to ``REACH`` after its gram, 0 outside its text."""
    width = WINDOW + REACH
    around = places[:, None] + np.arange(-REACH, GRAM + REACH)[None, :]
    inside = np.clip(around, 0, max(0, len(words.hashes) - 1))
    same = (around == inside) & (words.text[inside] == words.text[places][:, None])
    values = np.where(same, words.hashes[inside], np.uint64(0))
    offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, _signed(values.ravel()))


_COLUMNS = ["length", "hash", "place", "around", "places"]
_SCHEMA = "length int, hash long, place int, around array<long>, places array<int>"


def _first_words(words: Words) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(words.counts)])[:-1]


def _rows(texts: Texts, lengths: list[int], bitmap: np.ndarray | None) -> tuple[np.ndarray, list[pa.Array]]:
    """Fingerprints of a slice, and short windows of the given lengths: the text of each row, and its columns.

    With a bitmap, only hashes that it lets through; without (for items), a text shorter than the window
    gives one row of its own length instead.
    """
    words = words_of(texts, texts.lower(), ALPHANUMERIC)
    first = _first_words(words)
    grams = gram_hashes(words.hashes, GRAM)
    places = chosen(grams, _window_starts(words, WINDOW))
    if bitmap is not None and len(places):
        one, two = _slots(grams[places])
        places = places[bitmap[one] & bitmap[two]]
    owner = [words.text[places]]
    length = [np.full(len(places), WINDOW, np.int32)]
    hashes = [grams[places] if len(places) else np.zeros(0, np.uint64)]
    spots: list[list[int]] = []
    for short in lengths:
        starts = _window_starts(words, short)
        if bitmap is None:
            starts = starts[words.counts[words.text[starts]] == short]
        found = _short_hash(words, starts, short)
        if bitmap is not None and len(found):
            one, two = _slots(found)
            kept = bitmap[one] & bitmap[two]
            starts, found = starts[kept], found[kept]
        if not len(starts):
            continue
        # One row for all places that a text has the same short window at.
        order = np.lexsort((starts, found, words.text[starts]))
        starts, found = starts[order], found[order]
        text = words.text[starts]
        fresh = np.concatenate([[True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])])
        groups = np.split(starts - first[text], np.flatnonzero(fresh)[1:])
        owner.append(text[fresh])
        length.append(np.full(int(fresh.sum()), short, np.int32))
        hashes.append(found[fresh])
        spots += [group.tolist() for group in groups]
    n_short = len(spots)
    place = np.concatenate([places - first[words.text[places]], np.zeros(n_short, np.int64)]).astype(np.int32)
    around = pa.concat_arrays([_context(words, places), pa.array([[]] * n_short, pa.list_(pa.int64()))])
    columns = [
        pa.array(np.concatenate(length)),
        _signed(np.concatenate(hashes)),
        pa.array(place),
        around,
        pa.array([[]] * len(places) + spots, pa.list_(pa.int32())),
    ]
    return np.concatenate(owner), columns


def _windows(df: DataFrame, keys: list[str], lengths: list[int], packed: np.ndarray | None) -> DataFrame:
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if packed is None else np.unpackbits(packed, bitorder="little").astype(bool)
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                owner, columns = _rows(texts, lengths, bitmap)
                if len(owner):
                    at = pa.array(owner + texts.first)
                    yield pa.RecordBatch.from_arrays([*(batch.column(key).take(at) for key in keys), *columns], [*keys, *_COLUMNS])

    named = [f"{key} {df.schema[key].dataType.simpleString()}" for key in keys]
    return df.select(*keys, "text").mapInArrow(emitted, ", ".join([*named, _SCHEMA]))


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The filter over the hashes of ``windows``, eight bits a byte.

    Gathered as at most ``2 ** FILTER_BITS / 64`` numbers; tasks get it packed.
    """

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for slots in _slots(batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)):
                bits[slots] = True
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        cells = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(packed[cells])], ["cell", "bits"])

    cells = windows.select("hash").mapInArrow(filled, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    gathered = cells.toArrow()
    packed = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    packed[gathered.column("cell").to_numpy()] = gathered.column("bits").to_numpy()
    return packed.view(np.uint8)


def _agree(eq: Column, start: int, backwards: bool) -> Column:
    """How many of the ``REACH`` entries of ``eq`` from place ``start`` are true without a break."""
    part = F.slice(eq, start, REACH)
    part = F.reverse(part) if backwards else part
    broken = F.array_position(part, F.lit(False)).cast("int")
    return F.when(broken == 0, REACH).otherwise(broken - 1)


def _runs(found: DataFrame, items: DataFrame) -> DataFrame:
    """Shared runs of words: doc_id, text_hash, item_id, start, end (in words of the document)."""
    theirs = items.select("item_id", F.col("length").alias("its_length"), F.col("hash").alias("its_hash"), F.col("around").alias("its_around"))
    met = found.join(theirs, (F.col("hash") == F.col("its_hash")) & (F.col("length") == F.col("its_length")))
    keys = ["doc_id", "text_hash", "item_id"]
    eq = F.zip_with("around", "its_around", lambda a, b: (a == b) & (a != 0))
    long = met.where(F.col("length") == WINDOW).withColumn("eq", eq)
    # The words of the gram are compared too: an equal hash alone is not a hit.
    long = long.where(F.forall(F.slice("eq", REACH + 1, GRAM), lambda same: same))
    left, right = _agree(F.col("eq"), 1, True), _agree(F.col("eq"), REACH + GRAM + 1, False)
    long = long.select(*keys, (F.col("place") - left).alias("start"), (F.col("place") + GRAM + right).alias("end"))
    long = long.where(F.col("end") - F.col("start") >= WINDOW)
    short = met.where(F.col("length") < WINDOW).select(*keys, "length", F.explode("places").alias("start"))
    return long.unionByName(short.select(*keys, "start", (F.col("start") + F.col("length")).alias("end")))


def _covered(runs: Column) -> Column:
    """Places covered by a sorted array of runs."""
    start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("total"))

    def step(state: Column, run: Column) -> Column:
        fresh = F.greatest(F.lit(0), run["end"] - F.greatest(run["start"], state["until"]))
        return F.struct(F.greatest(state["until"], run["end"]).alias("until"), (state["total"] + fresh).alias("total"))

    return F.aggregate(runs, start, step, lambda state: state["total"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document ``row`` (all its columns), doc_id, n_words, n_hit, items (ids as sorted texts), contaminated.

    ``docs`` has doc_id and text, ``items`` item_id and text.
    """
    small_batches(docs.sparkSession)
    short = list(range(1, WINDOW))
    known = _windows(items.select(F.col("item_id").cast("string").alias("item_id"), "text"), ["item_id"], short, None)
    lengths = sorted(row.length for row in known.select("length").distinct().collect() if row.length < WINDOW)
    bitmap = _bitmap(known)

    text_hash = F.xxhash64("text").alias("text_hash")
    found = _windows(docs.select("doc_id", text_hash, "text"), ["doc_id", "text_hash"], lengths, bitmap)
    runs = _runs(found, known)
    by_text = runs.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    by_text = by_text.select("hit_id", "hit_hash", _covered(F.col("runs")).alias("covered"), "items")
    by_text = joinable(by_text, "contamination")
    names = [f"`{name}`" for name in docs.columns]
    counted = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    base = docs.select(F.struct(*names).alias("row"), "doc_id", text_hash, counted.alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    n_hit = F.coalesce("covered", F.lit(0)).cast("long")
    return base.join(by_text, same, "left").select(
        "row",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that are contaminated; all columns of ``docs``."""
    return contamination(docs, items).where(~F.col("contaminated")).select("row.*")
