"""Hard negatives of anchors by Four-Russians scoring: exact integer inner products from table lookups.

Vectors are whole numbers. Candidates are held as bit planes: for each bit of their components (two's complement),
one byte for every eight dimensions. For an anchor and eight dimensions, a table holds the sum of every subset of
the anchor's eight components, so the byte of a plane is an index into it. The sums of all groups, shifted by the
plane and added, the top plane subtracted, are the full and exact inner product.

Plan: rows are numbered and written once, and packed once into rows of bit planes. Anchors are dealt by hash into
blocks of about ``BLOCK_ANCHORS``, which bounds what is broadcast; each block meets all packs in a map without a
shuffle. First the best rows of the same label are sought, then, with their scores as bounds, those of other
labels. Both searches run on one pack in ``SAMPLE`` before: the last place there is a lower bound of the last place
over all rows, so tasks give out little more than ``SAMPLE`` rows for each place, however many tasks there are. A
window of few rows an anchor ranks them. Each anchor sees each row: nothing is approximate.

Defined results: rows without a label, vector, or with a component that is null or not finite take no part; a null
``vec_id`` is no anchor and comes last among ties; rows with equal ids are rows of their own (an anchor's copy is
another row, and an anchor that is there twice gives its rows twice); shorter vectors count as filled with zeros;
components stop at the ends of 64-bit numbers and sums beyond them wrap around; no anchors or an empty table give
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entity_events.llm.common import shared_path, written

#: Anchors of a block on average, and of one set of tables (8 kB an anchor with 64 dimensions).
BLOCK_ANCHORS = 16_384
TABLE_ANCHORS = 256
#: Candidates of a pack at most, and from how many on a pack ends where the label does.
PACK_ROWS = 2048
PACK_LEAST = 128
#: One pack in so many is searched before all of them.
SAMPLE = 16

POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of the positive's: at least, at most.
LOW, HIGH = 50, 95

_SMALLEST, _LARGEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_PACK = "pack long, n int, dims int, bits int, labels binary, rows binary, ids binary, known binary, planes binary"
_FOUND = "ask long, anchor_id long, positive_id long, positive_score long, score long, vec_id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def prepared(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part, numbered and written once."""
    value = F.col("embedding")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = embeddings.where(F.col("label").isNotNull() & value.isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"), whole.alias("vector")
    )
    return written(rows, "negatives-rows")


# Packs: candidates as bit planes


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of a batch as a matrix, filled with zeros to a multiple of eight dimensions."""
    lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = -(-max(int(lengths.max(initial=0)), 1) // 8) * 8
    matrix = np.zeros((len(lengths), dims), np.int64)
    matrix[np.arange(dims) < lengths[:, None]] = values
    return matrix


def planes_of(matrix: np.ndarray) -> np.ndarray:
    """Bytes by (bit, group of eight dimensions, row); the last bit is the sign."""
    widest = max(int(matrix.max(initial=0)), ~int(matrix.min(initial=0)), 0)
    bits = widest.bit_length() + 1
    planes = [np.packbits(((matrix >> bit) & 1).astype(np.uint8), axis=1, bitorder="little").T for bit in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def _cuts(labels: np.ndarray) -> list[int]:
    """Where the packs of rows in order of their labels end."""
    ends, start = [], 0
    changes = [*(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    for change in changes:
        while change - start > PACK_ROWS:
            start += PACK_ROWS
            ends.append(start)
        if change - start >= PACK_LEAST or change == len(labels):
            start = change
            ends.append(change)
    return ends


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = batch["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        labels, rows = labels[order], batch["row"].to_numpy()[order]
        known = batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)[order]
        ids = batch["vec_id"].fill_null(0).to_numpy()[order]
        matrix = _matrix(batch["vector"])[order]
        start = 0
        for end in _cuts(labels):
            part = slice(start, end)
            planes = planes_of(matrix[part])
            columns = [labels[part], rows[part], ids[part], known[part].astype(np.int8), planes]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(rows[start])], pa.int64()),
                    *(pa.array([number], pa.int32()) for number in (end - start, matrix.shape[1], len(planes))),
                    *(pa.array([column.tobytes()], pa.binary()) for column in columns),
                ],
                names=["pack", "n", "dims", "bits", "labels", "rows", "ids", "known", "planes"],
            )
            start = end


def packed(rows: DataFrame) -> DataFrame:
    """The rows as packs of bit planes, written once."""
    return written(rows.mapInArrow(_packs, _PACK), "negatives-packs")


# Scores


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of every subset of an anchor's components by (group of eight dimensions, subset, anchor)."""
    n, dims = anchors.shape
    tables = np.zeros((dims // 8, 256, n), anchors.dtype)
    for group in range(dims // 8):
        for bit in range(8):
            half = 1 << bit
            np.add(tables[group, :half], anchors[:, 8 * group + bit], out=tables[group, half : 2 * half])
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products by (candidate, anchor): lookups of all planes from the top, doubled and added."""
    bits, groups, n = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for bit in range(bits - 1, -1, -1):
        if bit == bits - 2:
            np.negative(total, out=total)  # the plane of the signs counts downwards
        total += total
        for group in range(min(groups, len(tables))):
            np.take(tables[group], planes[bit, group], axis=0, out=found, mode="clip")
            total += found
    return -total if bits == 1 else total


@dataclass
class Asks:
    """What a search looks for: up to ``slots`` ranges of scores for each anchor, and ``k`` rows of each.

    Anchors are in order of their labels. A slot without a range has ``low`` above ``high``.
    """

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    positive_ids: np.ndarray
    positive_known: np.ndarray
    positive_scores: np.ndarray
    k: int
    same_label: bool


class _Best:
    """The best rows that a task has seen for every ask: higher scores first, then smaller ids, missing ids last."""

    def __init__(self, asks: Asks):
        n = asks.low.size
        self.k = asks.k
        self.low = asks.low.reshape(-1).copy()
        self.count = np.zeros(n, np.int64)
        self.score = np.zeros((n, self.k), np.int64)
        self.id = np.zeros((n, self.k), np.int64)
        self.known = np.zeros((n, self.k), np.int8)

    def add(self, ask: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        touched = np.unique(ask)
        old, place = np.nonzero(np.arange(self.k) < self.count[touched][:, None])
        before = touched[old]
        ask = np.concatenate([before, ask])
        score = np.concatenate([self.score[before, place], score])
        ids = np.concatenate([self.id[before, place], ids])
        known = np.concatenate([self.known[before, place], known])
        # ~score falls as the score rises and, unlike -score, fits for every number.
        order = np.lexsort((ids, 1 - known, ~score, ask))
        ask, score, ids, known = ask[order], score[order], ids[order], known[order]
        starts = np.searchsorted(ask, touched)
        rank = np.arange(len(ask)) - np.repeat(starts, np.diff([*starts, len(ask)]))
        best = rank < self.k
        ask, rank = ask[best], rank[best]
        self.score[ask, rank], self.id[ask, rank], self.known[ask, rank] = score[best], ids[best], known[best]
        self.count[touched] = np.minimum(np.diff([*starts, len(score)]), self.k)
        full = touched[self.count[touched] == self.k]
        self.low[full] = np.maximum(self.low[full], self.score[full, self.k - 1])


def _search_pack(asks: Asks, best: _Best, first: int, tables: np.ndarray, row: dict) -> None:
    n, last = row["n"], first + tables.shape[2]
    labels = np.frombuffer(row["labels"], np.int64)
    theirs = asks.labels[first:last]
    # Both are in order, so the ends tell whether labels can be equal, or can differ.
    if asks.same_label and (labels[-1] < theirs[0] or theirs[-1] < labels[0]):
        return
    if not asks.same_label and labels[0] == labels[-1] == theirs[0] == theirs[-1]:
        return
    planes = np.frombuffer(row["planes"], np.uint8).reshape(row["bits"], -1, n)
    found = scores(tables, planes)
    equal = labels[:, None] == theirs
    allowed = equal if asks.same_label else ~equal
    if asks.same_label:
        rows = np.frombuffer(row["rows"], np.int64)
        mine = asks.rows[first:last]
        sorter = np.argsort(mine)
        at = np.minimum(np.searchsorted(mine, rows, sorter=sorter), len(mine) - 1)
        own = np.flatnonzero(mine[sorter[at]] == rows)
        allowed[own, sorter[at[own]]] = False
    ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], np.int8)
    slots = asks.low.shape[1]
    low = best.low.reshape(-1, slots)[first:last]
    high = asks.high[first:last]
    hits = []
    for slot in range(slots):
        at, anchor = np.nonzero((found >= low[:, slot]) & (found <= high[:, slot]) & allowed)
        hits.append((at, anchor, (first + anchor) * slots + slot))
    at, anchor, ask = (np.concatenate(parts) for parts in zip(*hits))
    if len(at):
        best.add(ask, found[at, anchor].astype(np.int64), ids[at], known[at])


def _narrowed(vectors: np.ndarray, planes_bits: int) -> np.ndarray:
    """The anchors as 32-bit numbers where no sum on the way can leave them, else as they are."""
    reach = np.abs(vectors.astype(np.float64)).sum(axis=1).max(initial=0) * 2.0 ** (planes_bits + 1)
    return vectors.astype(np.int32) if reach < 2**31 else vectors


def _searching(shared) -> object:
    """The map over packs that gives out each task's best rows for every ask."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks: Asks = shared.value
        best = _Best(asks)
        for batch in batches:
            packs = batch.to_pylist()
            if not packs:
                continue
            bits = max(row["bits"] for row in packs)
            for first in range(0, len(asks.rows), TABLE_ANCHORS):
                tables = subset_sums(_narrowed(asks.vectors[first : first + TABLE_ANCHORS], bits))
                for row in packs:
                    _search_pack(asks, best, first, tables, row)
        ask, place = np.nonzero(np.arange(best.k) < best.count[:, None])
        slots = asks.low.shape[1]
        anchor, slot = ask // slots, ask % slots
        known = asks.positive_known[anchor, slot] == 0, best.known[ask, place] == 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ask),
                pa.array(asks.ids[anchor]),
                pa.array(asks.positive_ids[anchor, slot], mask=known[0]),
                pa.array(asks.positive_scores[anchor, slot]),
                pa.array(best.score[ask, place]),
                pa.array(best.id[ask, place], mask=known[1]),
            ],
            names=["ask", "anchor_id", "positive_id", "positive_score", "score", "vec_id"],
        )

    return search


def _found(packs: DataFrame, asks: Asks) -> DataFrame:
    """The best ``asks.k`` rows of ``packs`` for every ask, with ``rank``.

    The asks of a block are broadcast: at most a few times ``BLOCK_ANCHORS`` vectors and ranges.
    """
    shared = packs.sparkSession.sparkContext.broadcast(asks)
    in_order = Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    each = packs.mapInArrow(_searching(shared), _FOUND)
    return each.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= asks.k)


def _with_bounds(packs: DataFrame, asks: Asks) -> Asks:
    """The asks with the last place of a sample of packs as lower bound, where the sample fills all places."""
    sample = packs.where(F.pmod(F.xxhash64("pack"), F.lit(SAMPLE)) == 0)
    last = _found(sample, asks).where(F.col("rank") == asks.k).select("ask", "score").toArrow()
    low = asks.low.reshape(-1).copy()
    low[last["ask"].to_numpy()] = last["score"].to_numpy()
    asks.low = low.reshape(asks.low.shape)
    return asks


def _anchors(rows: DataFrame) -> Asks:
    """The asks of a block's positives."""
    block = rows.toArrow().combine_chunks().sort_by([("label", "ascending"), ("row", "ascending")]).combine_chunks()
    n = block.num_rows
    vectors = _matrix(block["vector"].combine_chunks())
    column = lambda name: block[name].to_numpy()
    return Asks(
        rows=column("row"),
        ids=column("vec_id"),
        labels=column("label"),
        vectors=vectors,
        low=np.full((n, 1), _SMALLEST),
        high=np.full((n, 1), _LARGEST),
        positive_ids=np.zeros((n, 1), np.int64),
        positive_known=np.zeros((n, 1), np.int8),
        positive_scores=np.zeros((n, 1), np.int64),
        k=POSITIVES,
        same_label=True,
    )


def _for_negatives(asks: Asks, positives: pa.Table, low: int, high: int, k: int) -> Asks:
    """The asks of a block's negatives: a range of scores for every positive."""
    n = len(asks.rows)
    shape = (n, asks.k)
    lows, highs = np.ones(shape, np.int64), np.zeros(shape, np.int64)
    ids, known, given = np.zeros(shape, np.int64), np.zeros(shape, np.int8), np.zeros(shape, np.int64)
    place = positives["ask"].to_numpy(), positives["rank"].to_numpy() - 1
    score = positives["score"].to_numpy()
    ids[place], given[place] = positives["vec_id"].fill_null(0).to_numpy(), score
    known[place] = positives["vec_id"].is_valid().to_numpy()
    wide = score.astype(object)  # products that 64 bits may not hold
    lows[place] = np.maximum(-((-low * wide) // 100), _SMALLEST).astype(np.int64)
    highs[place] = np.minimum((high * wide) // 100, _LARGEST).astype(np.int64)
    return Asks(asks.rows, asks.ids, asks.labels, asks.vectors, lows, highs, ids, known, given, k, same_label=False)


def mined(
    embeddings: DataFrame,
    anchor: Column,
    relabelled: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """The hard negatives of every row for which ``anchor`` holds.

    For each of its first ``positives`` rows of the same label: the first ``negatives`` rows of other labels whose
    score lies between ``low`` and ``high`` hundredths of the positive's. ``relabelled`` is the label to go by.
    """
    spark = embeddings.sparkSession
    label = F.col("label") if relabelled is None else relabelled
    rows = prepared(embeddings.select("vec_id", label.alias("label"), "embedding"))
    packs = packed(rows)
    anchors = rows.where(anchor & F.col("vec_id").isNotNull())
    blocks = -(-anchors.count() // BLOCK_ANCHORS)
    path = shared_path(spark, "negatives")
    for block in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        asks = _anchors(mine)
        if not len(asks.rows):
            continue
        asks.k = positives
        first = _found(packs, _with_bounds(packs, asks)).select("ask", "rank", "score", "vec_id").toArrow()
        second = _for_negatives(asks, first, low, high, negatives)
        found = _found(packs, _with_bounds(packs, second))
        found.select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return _read(spark, path, blocks)


def _read(spark: SparkSession, path: str, blocks: int) -> DataFrame:
    return spark.read.schema(RESULT).parquet(path) if blocks else spark.createDataFrame([], RESULT)
