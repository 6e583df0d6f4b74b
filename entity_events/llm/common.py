"""Helpers of the training-data operators: reading tables, batches of texts as bytes, words and their hashes.

Words are found and hashed by numpy over the UTF-8 bytes of many texts at once. Both word rules in use
(runs without ASCII white space; runs of ASCII letters, digits and anything beyond ASCII) are rules on
bytes, so no text is decoded for them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes; a longer single text is one pass of its own.
SLICE_BYTES = 1 << 20

#: Rows that a Python worker gets at a time.
BATCH_ROWS = 1000

#: Measured bytes up to which a side of a join is broadcast.
BROADCAST_BYTES = 64 << 20

#: Words as runs without ASCII white space, in the notation of Java, Python and RE2.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where that is unset, as in tests, below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediate"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table in the shared folder and go on from the files.

    What follows reads the files however often it needs them and whichever executors are lost.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joinable(df: DataFrame, name: str) -> DataFrame:
    """A small side of a join, written once, and broadcast where its measured size allows it.

    Beyond that size Spark shuffles both sides and splits hot keys by its adaptive skew join.
    """
    side = written(df, name)
    size = side.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(side) if size <= BROADCAST_BYTES else side


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers few at a time, so that a worker's memory is bounded by few long texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def unit_draw(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only; the same in any SQL engine with SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), *(F.coalesce(key.cast("string"), F.lit("null")) for key in keys))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


# Texts as bytes


def _byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, bool)
    for first, last in ranges:
        flags[first : last + 1] = True
    return flags


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

NOT_SPACE = ~_byte_table((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Texts:
    """UTF-8 bytes of some texts, one after the other; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        return _LOWER[self.data]


def text_slices(column: pa.Array) -> Iterator[Texts]:
    """The texts of a column in slices of about ``SLICE_BYTES``, in order; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    rows = len(column)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + rows + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), rows)
        yield Texts(at, everything[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


# Words and hashes: unsigned 64-bit numbers, sums and products wrap around.

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def _powers(n: int, inverse: bool) -> np.ndarray:
    known = _POWERS[inverse]
    if len(known) < n:
        base = np.full(max(n, SLICE_BYTES + 1), _INVERSE if inverse else BASE, np.uint64)
        base[0] = 1
        known = np.cumprod(base)
        if n <= SLICE_BYTES + 1:
            _POWERS[inverse] = known
    return known[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble the bits of each number, one to one."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a slice of texts in order: hash of each, its text, and the number of words of every text."""

    hashes: np.ndarray
    text: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(texts: Texts, data: np.ndarray, word_bytes: np.ndarray) -> Words:
    """Find the runs of ``word_bytes`` in ``data``, which has the length and borders of the texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, np.zeros(len(texts), np.int64), none, none)
    inside = word_bytes[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    first = texts.offsets[:-1][texts.offsets[:-1] < n]
    begins[first] = inside[first]
    last = texts.offsets[1:][texts.offsets[1:] > 0] - 1
    finishes[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    counts = np.searchsorted(starts, texts.offsets[1:]) - np.searchsorted(starts, texts.offsets[:-1])
    owner = np.repeat(np.arange(len(texts)), counts)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), owner, counts, starts, ends)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(n, False)
    terms[~inside] = 0
    sums = np.add.reduceat(terms, starts) * _powers(n, True)[starts]
    return Words(mix(sums), owner, counts, starts, ends)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words, by place of the first; shorter input has none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= np.uint64(BASE)
        total += hashes[j : j + n]
    return mix(total)


def unsigned(column: pa.Array) -> np.ndarray:
    """Numbers stored as signed longs, as the unsigned numbers of the same bits."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
