"""Secret scans with corpus-wide ownership frequency.

Each text is scanned for assignments (``api_key = ...``), access keys and long runs of hexadecimal digits.
Beyond these, any long run of key letters is a candidate. What a candidate is worth depends on the corpus:
the hashes of candidate values are counted by distinct repositories and distinct owners. A value that many
owners have, or that is in many repositories even of one owner, is a copied example; a value that stays with one
owner and few repositories, and whose letters look random, looks live. Live-looking candidates become spans of
the kind ``live`` besides those found by the rules. Spans of the rules are kept and masked whatever their counts.

Plan: one pass of ``mapInArrow`` finds the spans and candidates of each text. Candidate hashes are freed of
repeats by (hash, owner, repository) with partial aggregation before the shuffle, counted in two steps, and
only the live ones are joined back, so a value that a third of all documents share is one row per owner and
repository. The spans are a small table that documents meet in one join, broadcast up to a measured size, so
that texts are shuffled only beyond it.

Defined results: a null or empty text has no spans; null ids, owners and repositories count as values of
their own; repeated rows are found repeatedly and do not count as further owners; an empty table gives no
rows; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity_events.llm.common import Texts, joinable, small_batches, text_slices, written

#: Kinds in the order that spans with one start are listed in.
KINDS = ("assign", "access", "hex", "live")

# The rules of the base kinds, on bytes: all they match is ASCII, and only ASCII letters have two cases.
ASSIGN = re.compile(
    rb"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LETTERS, ACCESS_LETTERS, HEX_LETTERS = 12, 18, 16

#: A live-looking candidate has at least so many letters, from at least three of the classes lower, upper,
#: digit, and at least so many bits a letter.
KEY_LETTERS, KEY_CLASSES, KEY_BITS = 20, 3, 3.5
#: Owners from which on a value is a copied example.
EXAMPLE_OWNERS = 2
#: Repositories from which on a value is a copied example, even under one owner.
EXAMPLE_REPOSITORIES = 100

MASK = "[SECRET]"

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_KEY = np.zeros(256, bool)
_KEY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True

FOUND = "array<struct<start:int,end:int,kind:string,value:string>>"


def _runs(flags: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` flagged bytes inside single texts."""
    padded = np.zeros(len(flags) + 2, np.int8)
    padded[1:-1] = flags
    steps = np.diff(padded)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(flags))])
    cut = inner[flags[inner] & flags[inner - 1]]
    starts = np.sort(np.concatenate([starts, cut]))
    ends = np.sort(np.concatenate([ends, cut]))
    long = ends - starts >= least
    return starts[long], ends[long]


def _looks_random(value: bytes) -> bool:
    classes = any(97 <= b <= 122 for b in value) + any(65 <= b <= 90 for b in value) + any(48 <= b <= 57 for b in value)
    if classes < KEY_CLASSES:
        return False
    counts = np.bincount(np.frombuffer(value, np.uint8))
    shares = counts[counts > 0] / len(value)
    return float(-(shares * np.log2(shares)).sum()) >= KEY_BITS


def _value_hash(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()[:32]


def _scan(texts: Texts) -> dict[int, list[tuple[int, int, str, str]]]:
    """Spans by text of the slice, with positions in code points."""
    data = texts.data.tobytes()
    offsets = texts.offsets
    raw: list[tuple[int, int, int, bytes]] = []
    for i in range(len(texts)):
        for match in ASSIGN.finditer(data, int(offsets[i]), int(offsets[i + 1])):
            if len(match[2]) >= ASSIGN_LETTERS:
                raw.append((match.start(), match.end(), 0, match[2]))
    if b"AKIA" in data:
        for i in range(len(texts)):
            for match in ACCESS.finditer(data, int(offsets[i]), int(offsets[i + 1])):
                if match.end() - match.start() >= ACCESS_LETTERS:
                    raw.append((match.start(), match.end(), 1, match[0]))
    for start, end in zip(*_runs(_HEX[texts.data], offsets, HEX_LETTERS)):
        raw.append((int(start), int(end), 2, data[start:end]))
    keys = _KEY[texts.data]
    starts, ends = _runs(keys, offsets, KEY_LETTERS)
    if len(starts):
        digits = np.concatenate([[0], np.cumsum(_DIGIT[texts.data])])
        some = digits[ends] > digits[starts]
        for start, end in zip(starts[some], ends[some]):
            value = data[start:end]
            if _looks_random(value):
                raw.append((int(start), int(end), 3, value))
    found: dict[int, list[tuple[int, int, str, str]]] = {}
    for start, end, kind, value in sorted(raw):
        i = int(np.searchsorted(offsets, start, "right")) - 1
        begin = int(offsets[i])
        before = len(data[begin:start].decode("utf-8"))
        found.setdefault(i, []).append(
            (before, before + len(data[start:end].decode("utf-8")), KINDS[kind], _value_hash(value))
        )
    return found


def found_spans(docs: DataFrame, *kept: str) -> DataFrame:
    """The columns ``kept`` and ``found``: spans of the base kinds, and ``live`` candidates, of each text."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])
        )
        for batch in batches:
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for texts in text_slices(batch.column("text")):
                for i, found in _scan(texts).items():
                    spans[texts.first + i] = [dict(zip(("start", "end", "kind", "value"), span)) for span in found]
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*kept, "found"])

    small_batches(docs.sparkSession)
    source = docs.select(*dict.fromkeys([*kept, "text"]))
    schema = [f"`{name}` {source.schema[name].dataType.simpleString()}" for name in kept]
    return source.mapInArrow(scanned, ", ".join([*schema, f"found {FOUND}"]))


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """Distinct owners and repositories of every candidate value of ``found``."""
    value = F.explode("found.value").alias("value")
    pairs = found.select(value, F.col(owner).alias("owner"), F.col(repository).alias("repository"))
    # Distinct first: a value copied everywhere leaves each map task as few rows.
    pairs = pairs.distinct()
    by_owner = pairs.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
    )


def _without_overlap(span: Column, base: Column) -> Column:
    """Whether a candidate lies apart from all base spans."""
    return ~F.exists(base, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"]))


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``spans`` (start, end, kind, owners, live) of every text that has any.

    Base spans stay whatever their value; a candidate stays where its value has fewer than
    ``example_owners`` owners and ``example_repositories`` repositories and where no base span covers it.
    """

    def live(span: Column) -> Column:
        return (span["owners"] < example_owners) & (span["repositories"] < example_repositories)

    needed = list(dict.fromkeys(["doc_id", "text_hash", owner, repository]))
    found = found_spans(keyed(docs).select(*dict.fromkeys([*needed, "text"])), *needed)
    # Two uses follow; the texts are scanned once. Only texts with a span leave rows.
    found = written(found.where(F.size("found") > 0), "secret-spans")
    owners = ownership(found, owner, repository).withColumnRenamed("value", "counted")
    each = found.select("doc_id", "text_hash", F.posexplode("found").alias("place", "span")).distinct()
    each = each.join(owners, F.col("span.value") == F.col("counted"), "left")
    joined = each.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("place", "span", "owners", "repositories"))).alias("all")
    )
    base = F.filter("all", lambda s: s["span"]["kind"] != "live")
    joined = joined.withColumn("base", F.transform(base, lambda s: s["span"]))
    kept = F.filter(
        "all",
        lambda s: (s["span"]["kind"] != "live")
        | (live(s) & _without_overlap(s["span"], F.col("base"))),
    )
    spans = F.transform(
        kept,
        lambda s: F.struct(
            s["span"]["start"].alias("start"),
            s["span"]["end"].alias("end"),
            s["span"]["kind"].alias("kind"),
            s["owners"].alias("owners"),
            live(s).alias("live"),
        ),
    )
    return joined.select("doc_id", "text_hash", spans.alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with the hash that tells texts with one ``doc_id`` apart."""
    return docs.withColumn("text_hash", F.xxhash64("text"))


def with_spans(docs: DataFrame, **options) -> DataFrame:
    """``row`` (all columns of a document), ``doc_id`` and ``spans``, an empty list where nothing was found."""
    names = [f"`{name}`" for name in docs.columns]
    wrapped = keyed(docs.select(F.struct(*names).alias("row"), "doc_id", "text"))
    spans = scan(docs, **options).withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    spans = joinable(spans, "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,kind:string,owners:bigint,live:boolean>>)")
    return wrapped.join(spans, same, "left").select("row", "doc_id", F.coalesce("spans", none).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with ``MASK`` in place of every span; spans that overlap give one mask."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        longer = F.concat(state["done"], between, F.lit(MASK))
        fresh = F.when(span["start"] >= state["at"], longer).otherwise(state["done"])
        return F.struct(fresh.alias("done"), F.greatest(span["end"], state["at"]).alias("at"))

    return F.aggregate(
        spans, start, step, lambda state: F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text)))
    )


def redacted(docs: DataFrame, **options) -> DataFrame:
    """The documents with masked texts, all columns as they were; ``n_chars`` is counted anew where masked."""
    found = with_spans(docs, **options)
    some = F.size("spans") > 0
    text = masked(F.col("row.text"), F.col("spans"))
    found = found.withColumn("masked", F.when(some, text).otherwise(F.col("row.text")))
    columns = []
    for field in docs.schema:
        column = F.col(f"row.`{field.name}`")
        if field.name == "text":
            column = F.col("masked")
        elif field.name == "n_chars":
            column = F.when(some, F.length("masked")).otherwise(column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return found.select(*columns)
