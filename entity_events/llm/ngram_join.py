"""N-gram Jaccard join: partition of the universe and the pigeonhole principle, verified exactly.

A document is its set of distinct five-word shingles. Two sets link when at least 80 in 100 of their shingles
are common. Such sets differ in at most ``H`` shingles, a bound that follows from their sizes. Sizes fall into
bands, and each band divides all shingles by hash into ``H + 1 + SPARE`` segments: of two sets that link, more
than ``SPARE`` segments hold the same shingles. A set is indexed by the subset it has in every segment of its
own band, and of the bands of smaller sets that it could link with. Empty segments say nothing and are left
out, which is safe while no more than ``SPARE`` are.

Sets that share a subset are candidates. Each is first verified with one member of the group, its pivot. Of a
small group the pairs that are not both linked to the pivot follow. Large groups (more than ``LARGE`` members:
passages that many documents share, families of copies) are left out like empty segments: what is lost there
is made up for elsewhere, by what it costs. A set that leaves out more than ``SPARE`` segments raises as many
of its best other segments from the same subset to subsets that differ in one shingle, through the one-deletion
neighbourhoods of both sides. Where a set has too few other segments even for that, the sets of its family of
groups are compared block by block, by products of incidence matrices; and it shows all its subsets, those in
large groups too, to the neighbourhoods of sets that could still raise. (Of two sets that both could, the one
with more left out raises enough segments that neither leaves out.) Sets that have too few because nearly all
their segments are empty are one family a band. So no link is lost, and no group is ever written out as all
its pairs.

Plan: one pass computes sets and subsets in ``mapInArrow``, free of repeats within a batch, and packs them by
bucket of their hash, so the shuffle moves few and large rows of 12 bytes a subset; a bucket is worked out by
sorting. Candidates are first held against the sizes of their sets and sketches of a few bits a shingle, which
never rule out a link; then the sets of what is left are computed anew and sent to the groups that compare
them. Links join as components by
alternating large-star and small-star steps over a table in the shared folder; the driver sees counts only.
The number of buckets follows ``spark.sql.shuffle.partitions``, which bounds a bucket only on average: all sets
that share one subset have one signature and meet in one task, which no setting splits.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing, not even
its like; fewer than five words are one shingle; equal sets are one class and link; a repeated row is a member
of its class; null ids get the component of their class, which is null where no member has an id; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events.llm.common import NOT_SPACE, Texts, gram_hashes, joinable, mix, small_batches, text_slices, words_of, written

SHINGLE = 5
#: Sets link when SIMILAR[1] * common >= SIMILAR[0] * all.
SIMILAR = (80, 100)
#: Sizes of the first set of a band and of the next band are in this ratio.
BAND_RATIO = 1.4
LARGE = 64
#: Tags of a large group in one row, about.
TAGS_IN_ROW = 4096
BLOCK = 256
BUCKETS_PER_PARTITION = 16
PACKED_AT_ONCE = 1 << 20
#: Pairs with one common set that are verified in one group.
CHUNK = 128

_U = np.uint64


# Sets


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted, and where each text's begin (one more entry at the end)."""
    words = words_of(texts, texts.lower(), NOT_SPACE)
    n = len(words.hashes) - SHINGLE + 1
    starts = np.flatnonzero(words.text[:n] == words.text[SHINGLE - 1 :]) if n > 0 else np.zeros(0, np.int64)
    values = [gram_hashes(words.hashes, SHINGLE)[starts] if len(starts) else np.zeros(0, _U)]
    owner = [words.text[starts]]
    first = np.concatenate([[0], np.cumsum(words.counts)])[:-1]
    for length in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            values.append(gram_hashes(words.hashes, length)[first[short]] + _U(length))
            owner.append(short)
    value, text = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(texts) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each set's values; 0 for empty sets."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _identities(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart, whatever the order of their shingles."""
    return mix(_sums(mix(values + _U(1)), offsets)), mix(_sums(mix(values ^ _U(0x5BF03635)), offsets))


# Bands and segments


def _band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(-(-starts[-1] * BAND_RATIO // 1))))
    return np.array(starts)


BANDS = _band_starts()


def _differences(size: np.ndarray) -> np.ndarray:
    """The most shingles in which a set of ``size`` and a linked larger one differ."""
    part, whole = SIMILAR
    return (size + size * whole // part) * (whole - part) // (whole + part)


H = _differences(BANDS[1:] - 1)
SPARE = -(-H * 8 // 100) + 2
SEGMENTS = H + 1 + SPARE


def bands_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last band in which sets of these sizes are indexed: that of the smallest partner, and their own."""
    part, whole = SIMILAR
    smallest = -(-sizes * part // whole)
    return np.searchsorted(BANDS, smallest, "right") - 1, np.searchsorted(BANDS, sizes, "right") - 1


class Subsets:
    """Non-empty subsets of sets by segment of one band: set, segment, number of shingles and signature."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, band: int):
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        segments = int(SEGMENTS[band])
        # Shingles are sorted, so those of a segment lie together.
        segment = ((values >> _U(32)) * _U(segments) >> _U(32)).astype(np.int64)
        fresh = np.ones(len(values), bool)
        fresh[1:] = (segment[1:] != segment[:-1]) | (owner[1:] != owner[:-1])
        begins = np.flatnonzero(fresh)
        self.offsets = np.append(begins, len(values))
        self.owner, self.segment = owner[begins], segment[begins]
        self.sizes = np.diff(self.offsets)
        self.terms = mix(values)
        self.sums = _sums(self.terms, self.offsets)
        self._salt = mix(self.segment.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(band + 1))
        self.signatures = mix(self.sums + self._salt)
        self.empty = segments - np.bincount(self.owner, minlength=len(sizes))

    def deletions(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of the chosen subsets without one of their shingles, and the subset of each."""
        subset = np.repeat(np.arange(len(self.sizes)), self.sizes)
        at = np.flatnonzero(chosen[subset])
        subset = subset[at]
        return mix(self.sums[subset] - self.terms[at] + self._salt[subset]), subset


def _taken(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the sets, in order."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(int(ends[-1])) + np.repeat(offsets[rows] - ends[:-1], sizes)
    return values[at], ends


# Buckets: signatures with the tag of their set, packed by part of their hash

_PACKED = "bucket int, signatures binary, tags binary, flags binary"

#: Flags of a signature: indexed only, or looked for as well; or not a signature but a mark on a set.
INDEXED, PROBED, MARKED = 0, 1, 2


def _code(signatures: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """32 bits to choose the bucket by, and 32 bits of band and hash to tell subsets apart inside it.

    Different subsets may rarely fall together; that makes candidates, which are verified.
    """
    return signatures >> _U(32), ((signatures & _U((1 << 25) - 1)) | _U(band << 25)).astype(np.uint32)


class Packer:
    """Collects signatures and packs them by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, ...]] = []

    def __len__(self) -> int:
        return sum(len(part[0]) for part in self.parts)

    def add(self, signatures: np.ndarray, band: int, tags: np.ndarray, flags: np.ndarray | None = None) -> None:
        high, code = _code(signatures, band)
        bucket = (high * _U(self.buckets) >> _U(32)).astype(np.int32)
        flags = np.zeros(len(code), np.uint8) if flags is None else flags.astype(np.uint8)
        self.parts.append((bucket, code, tags, flags))

    def mark(self, band: int, tags: np.ndarray) -> None:
        """Note that these sets leave out too much of a band."""
        bucket = (mix(tags.view(_U)) >> _U(32)) * _U(self.buckets) >> _U(32)
        code = np.full(len(tags), band << 25, np.uint32)
        self.parts.append((bucket.astype(np.int32), code, tags, np.full(len(tags), MARKED, np.uint8)))

    def batch(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        bucket, code, tags, flags = (np.concatenate(column) for column in zip(*self.parts))
        self.parts = []
        order = np.argsort(bucket, kind="stable")
        bucket, code, tags, flags = bucket[order], code[order], tags[order], flags[order]
        begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        columns = [pa.array(bucket[begins])]
        for values in (code, tags, flags):
            ends = np.append(begins, len(bucket)) * values.itemsize
            offsets = pa.py_buffer(ends.astype(np.int32))
            columns.append(pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(values)]))
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "signatures", "tags", "flags"])


_MEMBERS = "band int, gid long, size int, pivot long, tag long, flag boolean"


@dataclass
class _Bucket:
    """The signatures of a bucket in order, one row a signature and set, and the groups that have two or more."""

    bucket: int
    code: np.ndarray
    tags: np.ndarray
    probed: np.ndarray
    group: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray
    marks: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, table: pa.Table) -> _Bucket:
        code, tags, flags = (
            np.concatenate([np.frombuffer(blob.as_buffer(), kind) for blob in table.column(name).combine_chunks()])
            for name, kind in (("signatures", np.uint32), ("tags", np.int64), ("flags", np.uint8))
        )
        marked = flags == MARKED
        marks = code[marked], tags[marked]
        code, tags, flags = code[~marked], tags[~marked], flags[~marked]
        order = np.lexsort((PROBED - flags, tags, code))
        code, tags, flags = code[order], tags[order], flags[order]
        fresh = np.ones(len(code), bool)
        fresh[1:] = (code[1:] != code[:-1]) | (tags[1:] != tags[:-1])
        code, tags, flags = code[fresh], tags[fresh], flags[fresh]
        begins = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        sizes = np.diff(np.append(begins, len(code)))
        group = np.repeat(np.arange(len(begins)), sizes)
        return cls(table.column("bucket")[0].as_py(), code, tags, flags == PROBED, group, begins, sizes, marks)

    def members(self, kept: np.ndarray) -> dict[str, np.ndarray]:
        """The kept rows with group and pivot, and the marked sets with ``gid`` -1."""
        group, code = self.group[kept], self.code[kept]
        none = np.zeros(len(self.marks[0]), np.int64)
        return {
            "band": (np.concatenate([code, self.marks[0]]) >> 25).astype(np.int32),
            "gid": np.concatenate([(np.int64(self.bucket) << 32) | code.astype(np.int64), none - 1]),
            "size": np.concatenate([self.sizes[group], none + 1]).astype(np.int32),
            "pivot": np.concatenate([self.tags[self.begins[group]], self.marks[1]]),
            "tag": np.concatenate([self.tags[kept], self.marks[1]]),
            "flag": np.concatenate([self.probed[kept], none > 0]),
        }


def _groups(table: pa.Table) -> pa.Table:
    """Groups of at least two sets that have a signature of one bucket; of each its members and its pivot.

    Marked sets are passed on with ``gid`` -1.
    """
    found = _Bucket.of(table)
    columns = found.members(found.sizes[found.group] > 1)
    return pa.table({name: pa.array(values) for name, values in columns.items()})


_NEAR = f"{_MEMBERS}, part int, tags array<long>"


def _parts(tags: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The tags of a large group by hash, in as many parts as give about ``TAGS_IN_ROW`` or fewer each.

    A part is known by the number of parts and its own: groups of about a size are cut alike.
    """
    parts = 1 << max(0, int(np.ceil(np.log2(len(tags) / TAGS_IN_ROW))))
    owner = (mix(tags.view(_U)) & _U(parts - 1)).astype(np.int64)
    for part in range(parts):
        yield parts + part, tags[owner == part]


def _near_groups(table: pa.Table) -> pa.Table:
    """The same of groups that some member looks for, but large ones as rows of many tags each.

    A large group gives one row for about every ``TAGS_IN_ROW`` of its tags, see :func:`_family_ties`.
    """
    found = _Bucket.of(table)
    sought = np.bincount(found.group, found.probed, len(found.sizes)) > 0
    few = found.sizes <= LARGE
    columns = found.members((sought & few & (found.sizes > 1))[found.group])
    small = {name: pa.array(values) for name, values in columns.items()}
    small["part"] = pa.nulls(len(small["gid"]), pa.int32())
    small["tags"] = pa.nulls(len(small["gid"]), pa.list_(pa.int64()))
    parts = [
        (found.tags[begin], *part)
        for begin, size in zip(found.begins[sought & ~few].tolist(), found.sizes[sought & ~few].tolist())
        for part in _parts(found.tags[begin : begin + size])
    ]
    large = {name: pa.nulls(len(parts), column.type) for name, column in small.items()}
    for place, name in enumerate(("pivot", "part", "tags")):
        large[name] = pa.array([row[place] for row in parts], small[name].type)
    return pa.concat_tables([pa.table(small), pa.table(large)])


def _family_ties(near: DataFrame) -> DataFrame:
    """(pivot, tag) of all members of large groups.

    What the members of a family share, they share under very many signatures, with few strays each. Of the groups of
    a pivot the largest is taken apart, of the others only what it does not have.
    """
    shared = near.where("tags is not null").select("pivot", "part", "tags").distinct()
    most = shared.groupBy("pivot", "part").agg(F.max_by("tags", F.size("tags")).alias("most"))
    others = shared.join(most, ["pivot", "part"]).select("pivot", F.array_except("tags", "most").alias("tags"))
    ties = most.select("pivot", F.col("most").alias("tags")).unionByName(others.where(F.size("tags") > 0))
    return ties.select("pivot", F.explode("tags").alias("tag"))


def _buckets(spark: SparkSession) -> int:
    return BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _grouped(packed: DataFrame) -> DataFrame:
    return packed.groupBy("bucket").applyInArrow(_groups, _MEMBERS)


def _near_grouped(packed: DataFrame) -> DataFrame:
    return packed.groupBy("bucket").applyInArrow(_near_groups, _NEAR)


# Passes over the texts

_CLASS = (
    "text_hash long, n_shingles long, tag long, key string, sketch array<long>, slack array<struct<band:int,slack:int>>"
)


def _sketches(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Parities of each set's shingles by parts of the universe, at least two parts a shingle.

    Two sets differ in at least as many shingles as their sketches do in bits. The number of parts is a power
    of two, so a sketch is folded to half its parts by an exclusive or of its halves.
    """
    sizes = np.diff(offsets)
    bits = np.int64(64) << np.ceil(np.log2(np.maximum(sizes, 32) / 32)).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    part = (values & (bits[owner] - 1).astype(_U)).astype(np.int64)
    odd = np.bincount(begins[owner] + part, minlength=int(begins[-1])) & 1
    packed = np.packbits(odd.astype(bool), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array((begins // 64).astype(np.int32)), pa.array(packed))


def _slack(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Per set and band that it is indexed in (band, slack): how many more segments it could leave out."""
    lowest, own = bands_of(np.diff(offsets))
    found: list[list[dict]] = [[] for _ in lowest]
    some = np.flatnonzero(np.diff(offsets))
    for band in range(int(lowest[some].min()), int(own.max()) + 1) if len(some) else ():
        rows = some[(lowest[some] <= band) & (band <= own[some])]
        if len(rows):
            empty = Subsets(*_taken(values, offsets, rows), band).empty
            for row, spare in zip(rows.tolist(), (SPARE[band] - empty).tolist()):
                found[row].append({"band": band, "slack": spare})
    return pa.array(found, pa.list_(pa.struct([("band", pa.int32()), ("slack", pa.int32())])))


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, tag, key, sketch and slack of every row.

    Tag and key (text of 128 bits) name its class.
    """

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                values, offsets = shingle_sets(texts)
                tag, more = _identities(values, offsets)
                keys = [f"{a:016x}{b:016x}" for a, b in zip(tag.tolist(), more.tolist())]
                part = batch.slice(texts.first, len(texts))
                columns = [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(np.diff(offsets)),
                    pa.array(tag.view(np.int64)),
                    pa.array(keys),
                    _sketches(values, offsets),
                    _slack(values, offsets),
                ]
                names = ["doc_id", "text_hash", "n_shingles", "tag", "key", "sketch", "slack"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(described, f"doc_id {kind}, {_CLASS}")


def _unique_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shingles, borders and tags of the sets of a batch, equal ones once, empty ones never."""
    seen: set[int] = set()
    for texts in text_slices(column):
        values, offsets = shingle_sets(texts)
        tags = _identities(values, offsets)[0].view(np.int64)
        sizes = np.diff(offsets)
        rows = [i for i, tag in enumerate(tags.tolist()) if sizes[i] and not (tag in seen or seen.add(tag))]
        if rows:
            rows = np.array(rows)
            yield (*_taken(values, offsets, rows), tags[rows])


def _indexed(docs: DataFrame, buckets: int) -> DataFrame:
    """Signatures of all sets by bucket."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in batches:
            for values, offsets, tags in _unique_sets(batch.column("text")):
                lowest, own = bands_of(np.diff(offsets))
                for band in range(int(lowest.min()), int(own.max()) + 1):
                    rows = np.flatnonzero((lowest <= band) & (band <= own))
                    if len(rows):
                        subsets = Subsets(*_taken(values, offsets, rows), band)
                        packer.add(subsets.signatures, band, tags[rows][subsets.owner])
                if len(packer) >= PACKED_AT_ONCE:
                    yield from packer.batch()
        yield from packer.batch()

    return docs.select("text").mapInArrow(indexed, _PACKED)


def _texts_of(docs: DataFrame, classes: DataFrame, jobs: DataFrame) -> DataFrame:
    """One text of every class with the columns of ``jobs`` (one row a tag) and its key."""
    jobs = jobs.join(classes.select("tag", "key", "any.doc_id", "any.text_hash").toDF("tag", "key", "of_id", "of_hash"), "tag")
    jobs = joinable(jobs, "jobs")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    return docs.join(jobs, same).drop("doc_id", "text_hash", "of_id", "of_hash")


def _once(seen: set[str], keys: pa.Array) -> np.ndarray:
    """Places of the keys that a task has not met yet: repeated rows have one id and one text."""
    return np.array([i for i, key in enumerate(keys.to_pylist()) if not (key in seen or seen.add(key))], np.int64)


def _pair_jobs(pairs: DataFrame) -> DataFrame:
    """Work on pairs (one, two): in groups of ``one`` (block 0) and at most about ``CHUNK`` others (block 1)."""
    counted = pairs.groupBy("one").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))

    def group(chunk: Column) -> Column:
        family = F.concat(F.lit(PAIRS), F.hex("one"))
        return F.struct(family.alias("family"), chunk.alias("x"), F.lit(0).alias("y")).alias("group")

    chunk = F.pmod(F.xxhash64("two"), F.col("chunks")).cast("int")
    others = pairs.join(counted, "one").select(F.col("two").alias("tag"), group(chunk), F.lit(1).alias("block"))
    ones = counted.select("one", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return others.unionByName(ones.select(F.col("one").alias("tag"), group(F.col("chunk")), F.lit(0).alias("block")))


def _block_jobs(families: DataFrame) -> DataFrame:
    """Work on families (family, tag): blocks of about ``BLOCK`` sets, each pair of blocks a group."""
    counted = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = families.join(counted, "family").withColumn("block", F.pmod(F.xxhash64("tag"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("family", "tag", "block", other.alias("other"))
    x, y = F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    return dealt.select("tag", F.struct(F.concat(F.lit(BLOCKS), "family").alias("family"), x, y).alias("group"), "block")


_GROUP = "family string, x int, y int"
PAIRS, BLOCKS = "p", "b"


def _compared(docs: DataFrame, classes: DataFrame, jobs: DataFrame) -> DataFrame:
    """Links (a, b: keys; one, two: tags) that the work ``jobs`` (tag, group, block) finds.

    Each set is computed where its text is read and goes straight to the groups that need it.
    """

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            fresh = _once(seen, batch.column("key"))
            batch = batch.take(pa.array(fresh))
            for texts in text_slices(batch.column("text")):
                values, offsets = shingle_sets(texts)
                rows: list[tuple] = []
                part = batch.slice(texts.first, len(texts)).select(["tag", "key", "groups"]).to_pylist()
                for row, start, end in zip(part, offsets[:-1], offsets[1:]):
                    blob = values[start:end].tobytes()
                    for g in row["groups"]:
                        group = g["group"]
                        rows.append((group["family"], group["x"], group["y"], g["block"], row["tag"], row["key"], blob))
                        if len(rows) >= 1000:
                            yield _sent_batch(rows)
                            rows = []
                yield _sent_batch(rows)

    listed = jobs.groupBy("tag").agg(F.collect_list(F.struct("group", "block")).alias("groups"))
    sets = _texts_of(docs, classes, listed).mapInArrow(sent, f"{_GROUP}, block int, tag long, key string, shingles binary")
    return sets.groupBy("family", "x", "y").applyInArrow(_group_links, "a string, b string, one long, two long")


def _sent_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    names = ["family", "x", "y", "block", "tag", "key", "shingles"]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names)


def _group_links(table: pa.Table) -> pa.Table:
    keys, tags = table.column("key").to_pylist(), table.column("tag").to_pylist()
    sets = [np.frombuffer(blob.as_buffer(), _U) for blob in table.column("shingles").combine_chunks()]
    blocks = table.column("block").to_numpy()
    if table.column("family")[0].as_py().startswith(PAIRS):
        found = _links_to_first(sets, blocks)
    else:
        found = _links_between(sets, blocks)
    return pa.table(
        {
            "a": pa.array([keys[i] for i, _ in found], pa.string()),
            "b": pa.array([keys[j] for _, j in found], pa.string()),
            "one": pa.array([tags[i] for i, _ in found], pa.int64()),
            "two": pa.array([tags[j] for _, j in found], pa.int64()),
        }
    )


def _links_to_first(sets: list[np.ndarray], blocks: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of block 0 and sets of block 1, each pair compared."""
    part, whole = SIMILAR
    found = []
    for i in np.flatnonzero(blocks == 0):
        for j in np.flatnonzero(blocks == 1):
            both = np.concatenate([sets[i], sets[j]])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            if whole * common >= part * (len(both) - common):
                found.append((i, j))
    return found


def _links_between(sets: list[np.ndarray], blocks: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the links between two blocks, or inside one, by products of incidence matrices."""
    part, whole = SIMILAR
    sizes = np.array([len(each) for each in sets])
    shingle, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, len(shingle), 4096):
        inside = (at >= start) & (at < start + 4096)
        incidence = np.zeros((len(sets), 4096), np.float32)
        incidence[owner[inside], at[inside] - start] = 1
        common += incidence @ incidence.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = np.triu(whole * common >= part * union, 1)
    if (blocks != blocks[0]).any():
        linked &= blocks[:, None] != blocks[None, :]
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i, j in np.argwhere(linked).tolist():
        x, y = find(i), find(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            found.append((i, j))
    return found


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (one, two: tags) that sizes and sketches do not rule out."""
    part, whole = SIMILAR
    narrow = classes.select("tag", F.struct(F.col("n_shingles").alias("n"), "sketch").alias("c"))
    met = pairs.join(narrow.toDF("one", "a"), "one").join(narrow.toDF("two", "b"), "two")

    def differing(x: Column, y: Column) -> Column:
        return F.zip_with(x, y, lambda one, other: one.bitwiseXOR(other))

    def folded(x: Column, y: Column) -> Column:
        """``x``, at half its size where that is the size of ``y``."""
        half = F.size(y)
        return F.when(F.size(x) > half, differing(F.slice(x, 1, half), F.slice(x, half + 1, half))).otherwise(x)

    x, y = F.col("a.sketch"), F.col("b.sketch")
    differences = F.aggregate(
        differing(folded(x, y), folded(y, x)),
        F.lit(0),
        lambda total, bits: total + F.bit_count(bits),
    )
    n_a, n_b = F.col("a.n"), F.col("b.n")
    met = met.where(whole * F.least(n_a, n_b) >= part * F.greatest(n_a, n_b))
    met = met.where(differences * (whole + part) <= (n_a + n_b) * (whole - part))
    return met.select("one", "two").distinct()


# Groups that are too large to be told apart by one segment


def _raised(docs: DataFrame, classes: DataFrame, left_out: DataFrame, buckets: int) -> DataFrame:
    """One-deletion signatures of sets that leave out more than ``SPARE`` segments of a band.

    ``left_out`` has tag, band and gids (of large groups). Sets that have too few other segments to raise are
    marked.
    """

    def raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            batch = batch.take(pa.array(_once(seen, batch.column("key"))))
            packer = Packer(buckets)
            for texts in text_slices(batch.column("text")):
                values, offsets = shingle_sets(texts)
                part = batch.slice(texts.first, len(texts)).select(["tag", "bands"]).to_pylist()
                for row, start, end in zip(part, offsets[:-1], offsets[1:]):
                    for left in row["bands"]:
                        _raise(packer, values[start:end], row["tag"], left["band"], left["gids"])
            yield from packer.batch()

    listed = left_out.groupBy("tag").agg(F.collect_list(F.struct("band", "gids")).alias("bands"))
    return _texts_of(docs, classes, listed).mapInArrow(raised, _PACKED)


def _raise(packer: Packer, values: np.ndarray, tag: int, band: int, gids: list[int] | None) -> None:
    """Add the one-deletion signatures of one set and band, flagged where the set looks for partners by them."""
    subsets = Subsets(values, np.array([0, len(values)]), band)
    high, code = _code(subsets.signatures, band)
    gid = ((high * _U(packer.buckets) >> _U(32)) << _U(32) | code.astype(_U)).astype(np.int64)
    large = np.isin(gid, np.array(gids or [], np.int64))
    needed = int(subsets.empty[0]) + int(large.sum()) - int(SPARE[band])
    usable = ~large & (subsets.sizes > 1)
    # Larger subsets cost less: fewer sets come within one shingle of them.
    best = np.zeros(len(usable), bool)
    best[np.argsort(np.where(usable, -subsets.sizes, 1), kind="stable")[:needed]] = True
    best &= usable
    shown = ~large
    if best.sum() < needed:
        best[:] = False
        # Sets that are not marked may meet this one only where it is in large groups.
        shown[:] = True
        packer.mark(band, np.array([tag]))
    # Without its only shingle a subset is empty, and empty segments are not raised.
    signatures, subset = subsets.deletions(shown & (subsets.sizes > 1))
    packer.add(signatures, band, np.full(len(subset), tag), best[subset])
    packer.add(subsets.signatures[shown], band, np.full(int(shown.sum()), tag), best[shown])


# Components


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, and no centre has one of its own."""
    roles = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")).distinct())
    return roles.groupBy("node").agg(F.count(F.lit(1)).alias("roles")).where("roles > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node it reaches) of every node of ``links`` (a, b).

    Each large-star step ties all larger neighbours of a node to its smallest neighbour, each small-star step
    all smaller ones; the links become stars around the smallest nodes in a few rounds. A node with very many
    links is one row of minima after partial aggregation, and its links are an ordinary join side.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("b", "low"), F.struct(F.col("a").alias("b"), "low"))).alias("n"))
        small = small.select(F.col("n.b").alias("a"), F.col("n.low").alias("b")).where("a <> b").distinct()
        links = written(small, "links")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


# The join


def _untied_pairs(small: DataFrame, stars: DataFrame, refuted: DataFrame) -> DataFrame:
    """Pairs (one, two) in groups of ``small`` (gid, pivot, tag) that ``stars`` (one: pivot, two) stood for in vain.

    Both were to be tied to their pivot, and of one the star is ``refuted``. All other pairs of these groups were
    there before.
    """
    tied = small.join(stars.toDF("pivot", "tag"), ["pivot", "tag"], "left_semi").select("gid", F.col("tag").alias("two"))
    untied = small.join(refuted.toDF("pivot", "tag"), ["pivot", "tag"], "left_semi").select("gid", F.col("tag").alias("one"))
    met = untied.join(tied, "gid").where("one <> two")
    return met.select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct()


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b: keys of classes) whose components are those of all links."""
    spark = docs.sparkSession
    buckets = _buckets(spark)
    members = written(_grouped(_indexed(docs, buckets)), "groups")

    stars = members.where("tag <> pivot").select(F.col("pivot").alias("one"), F.col("tag").alias("two")).distinct()
    stars = written(_possible(stars, classes), "stars")

    # Pairs of small groups but for those that may both be tied (one: pivot, two) to their pivot.
    small = members.where((F.col("size") <= LARGE) & (F.col("size") > 2)).select("gid", "pivot", "tag")
    tied = stars.select(F.col("one").alias("pivot"), F.col("two").alias("tag"), F.lit(True).alias("tied"))
    dealt = small.join(tied, ["pivot", "tag"], "left")
    dealt = dealt.select("gid", "tag", F.coalesce("tied", F.col("tag") == F.col("pivot")).alias("tied"))
    other = dealt.select("gid", F.col("tag").alias("two"), F.col("tied").alias("both"))
    loose = dealt.join(other, "gid").where((F.col("tag") < F.col("two")) & ~(F.col("tied") & F.col("both")))
    loose = loose.select(F.col("tag").alias("one"), "two").distinct()

    # Sets that leave out too much: by empty segments, and by large groups.
    slack = classes.select("tag", F.explode("slack").alias("s")).select("tag", "s.band", "s.slack")
    large = members.where(F.col("size") > LARGE).groupBy("tag", "band").agg(F.collect_set("gid").alias("gids"))
    left_out = slack.join(large, ["tag", "band"], "left")
    left_out = left_out.where(F.coalesce(F.size("gids"), F.lit(0)) > F.col("slack")).select("tag", "band", "gids")
    left_out = written(left_out, "left-out")

    # If all possible stars hold, these are the pairs that remain.
    first = written(stars.unionByName(_possible(loose, classes)).distinct(), "pairs")
    links = written(_compared(docs, classes, _pair_jobs(first)), "links")
    # Where a star did not hold, the pairs that it stood for follow, with all work on what was left out.
    refuted = written(stars.join(links.select("one", "two").distinct(), ["one", "two"], "left_anti"), "refuted")
    pairs = _possible(_untied_pairs(small, stars, refuted), classes)
    blocks = None
    if not left_out.isEmpty():
        near = written(_near_grouped(_raised(docs, classes, left_out, buckets)), "near")
        marked = near.where("gid < 0").select("tag", "band").distinct()
        saturated = marked.select("tag").distinct()
        one = near.where(F.col("flag") & (F.col("gid") >= 0)).select("gid", F.col("tag").alias("one"))
        two = near.where("gid >= 0").select("gid", F.col("tag").alias("two"))
        found = one.join(two, "gid").where("one <> two")
        found = found.select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct()
        pairs = pairs.unionByName(_possible(found, classes)).distinct()
        # What no segment tells apart: families of sets that are tied by large groups.
        crowded = members.where(F.col("size") > LARGE).join(saturated, "tag", "left_semi").select("pivot", "tag")
        crowded = crowded.union(_family_ties(near))
        # Two that have too few segments may have only empty ones in common.
        bare = marked.join(slack.where("slack < 0"), ["tag", "band"], "left_semi")
        lowest = bare.groupBy("band").agg(F.min("tag").alias("pivot"))
        crowded = written(crowded.union(bare.join(lowest, "band").select("pivot", "tag")).distinct(), "crowded")
        if not crowded.isEmpty():
            ties = crowded.select(F.lpad(F.hex("tag"), 16, "0").alias("a"), F.lpad(F.hex("pivot"), 16, "0").alias("b"))
            family = components(ties).toDF("hex", "family")
            inside = crowded.select("tag").distinct().withColumn("hex", F.lpad(F.hex("tag"), 16, "0"))
            blocks = _block_jobs(written(inside.join(family, "hex").select("family", "tag"), "families"))
    # Pairs are unordered; those verified before are left out in either order.
    known = first.unionByName(first.select(F.col("two").alias("one"), F.col("one").alias("two")))
    jobs = _pair_jobs(written(pairs.join(known, ["one", "two"], "left_anti"), "later-pairs"))
    jobs = jobs if blocks is None else jobs.unionByName(blocks)
    return links.unionByName(_compared(docs, classes, jobs)).select("a", "b")


def _with_components(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (null without shingles) and its smallest id, of every document."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = written(_described(docs), "classes")
    classes = rows.where("n_shingles > 0").groupBy("tag", "key").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "text_hash")).alias("any"),
        *(F.first(name).alias(name) for name in ("n_shingles", "sketch", "slack")),
    )
    classes = written(classes, "distinct-classes")
    found = components(_links(docs, classes)).toDF("key", "component")
    least = classes.join(found, "key", "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    ids = least.groupBy("component").agg(F.min("least").alias("least_id"))
    by_class = least.join(ids, "component").select(F.col("key").alias("of_key"), "component", "least_id")
    filled = (F.col("key") == F.col("of_key")) & (F.col("n_shingles") > 0)
    return rows.join(by_class, filled, "left").select("doc_id", "text_hash", "n_shingles", "component", "least_id")


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id that it reaches) of every document (doc_id, text)."""
    own = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    return _with_components(docs).select("doc_id", "n_shingles", own.alias("component_id"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, and all without shingles; all columns."""
    found = _with_components(docs).where("n_shingles > 0").groupBy("component", "doc_id", "text_hash")
    found = found.agg(F.count(F.lit(1)).alias("rows"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = found.groupBy("component").agg(F.min(order).alias("best"))
    found = found.join(best, "component").withColumn("stays", order == F.col("best"))
    # Only what goes, or is there several times, is listed.
    listed = found.where(~F.col("stays") | (F.col("rows") > 1))
    listed = joinable(listed.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "stays"), "dropped")
    names = [F.col(f"`{name}`") for name in docs.columns]
    wrapped = docs.select(F.struct(*names).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    met = wrapped.join(listed, same, "left")
    once = met.where("stays").dropDuplicates(["doc_id", "text_hash"])
    return met.where("stays is null").select("row.*").unionByName(once.select("row.*"))
