"""Alignment of two tokenizers' tokens over the same bytes, by skipping along diagonals.

Both encodings of a text are arrays of byte offsets at which tokens end. While tokens match one to one, the two
arrays are equal at a fixed shift of their indices. Exponential probing compares ever longer slices at the current
shift and then halves the last one, so a stretch of one-to-one tokens is jumped over in a few comparisons of
slices. Where the ends differ, the irregular group is walked token by token until both end at one offset, and the
shift is updated. Tokens of a group are linked where their byte ranges overlap.

Neither library merges across the ends of the pieces that the first cuts a text into, words mostly: the second does
not where its vocabulary holds no token with the two neighbours there. So ids of pieces are kept per worker for both.
A text with an end that a merge could cross is encoded whole. Texts are aligned many at a time, one after the other,
and their groups are written by numpy.

Plan: one map encodes and aligns, and gives out the links of each text as pairs of ids with counts. A task cuts
what it gives out into blocks of ``BLOCK_BYTES`` of text and sums the pairs of each. Only those sums, not the links
of each text, are added up over the corpus, compared with the best of their B id, and sent back to the block, where
they meet its texts in one cogroup of bounded size. What the map gave out is written once.

Defined results: a null or empty text, and one whose tokens do not spell a space and the text in either encoding
(the other model changes some characters), has no tokens and zeros; equal rows and null ids are rows of their own;
an empty table gives no rows; other columns are not read. A text longer than a block is a block of its own.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entity_events.llm.common import shared_path, small_batches
from entity_events.llm.token_counts import KEPT_PIECES, PIECES, _byte_letters

#: Bytes of text of a block.
BLOCK_BYTES = 8 << 20

#: Bytes of text that are aligned at once; a longer single text is aligned on its own.
ALIGNED_BYTES = 1 << 18

#: Letters of the longest piece whose ids a worker keeps.
_SHORT = 64

_NONE = np.zeros(0, np.int32)
_FIRST, _LAST = itemgetter(0), itemgetter(-1)

_ALIGNED = (
    "summary boolean, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs array<long>, counts array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class TokenPair:
    """Two tokenizers: ids of a text, and the bytes that each id stands for."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings inside a text are text
        self.a.no_padding()
        self.a.no_truncation()
        with open(byte_level, encoding="utf-8") as file:
            added = {token["id"] for token in json.load(file)["added_tokens"]}
        letters = _byte_letters()
        spelled = {
            i: token.encode() if i in added else bytes(letters[letter] for letter in token)
            for token, i in self.a.get_vocab().items()
        }
        self.a_bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.b = SentencePieceProcessor(model_file=pieces)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
            if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, each))) for each in (self.a_bytes, self.b_bytes))
        #: Decimal ids as bytes of a number, lowest first, and their lengths.
        names = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = np.array([int.from_bytes(name, "little") for name in names], np.uint64)
        self.digits = np.array(list(map(len, names)), np.uint64)
        self._known: dict[str, tuple[bytes, bytes]] = {}
        self._letters = {byte: letter for letter, byte in letters.items()}
        self._lead = self._crossed = None
        if _splits(pieces):
            kinds = (self.b.is_byte, self.b.is_control, self.b.is_unknown)
            ids = [i for i in range(len(self.b_bytes)) if not any(is_kind(i) for is_kind in kinds)]
            spellings = [self.b.id_to_piece(i).replace("▁", " ") for i in ids]
            #: Neighbours that a token of B may hold; between others no merge ever crosses.
            self._crossed = {pair for spelling in spellings for pair in pairwise(spelling)}
            used = set().union(*spellings)
            #: A letter of no token, which keeps what follows apart from the space that the library adds.
            self._lead = next((x for x in ("\n", *map(chr, range(0xE000, 0xF900))) if x not in used), None)
            self._led = len(self.b.encode(self._lead or ""))

    def _inside(self, piece: str) -> list[int]:
        """Ids in B of a piece inside a text, where no merge crosses its ends."""
        if piece[0] == " " and len(piece) > 1:
            return self.b.encode(piece[1:])  # the library adds the space
        return self.b.encode(self._lead + piece)[self._led :]

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        """Ids of a piece in both, by the libraries; none in B where they do not spell it. Short pieces are kept."""
        data = piece.encode()
        a = [token.id for token in self.a.model.tokenize(data.decode("latin-1").translate(self._letters))]
        b = self._inside(piece) if self._lead else []
        if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
            b = []
        ids = array("i", a).tobytes(), array("i", b).tobytes()
        if len(piece) <= _SHORT:
            if len(self._known) >= KEPT_PIECES:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and the text in both; none where the tokens' bytes are not these."""
        if not text:
            return _NONE, _NONE
        whole = f" {text}"
        pieces = PIECES.findall(whole)
        known, piece_ids = self._known.get, self._piece
        each_a, each_b = zip(*[known(piece) or piece_ids(piece) for piece in pieces])
        a = np.frombuffer(b"".join(each_a), np.int32)
        if all(each_b) and self._crossed.isdisjoint(zip(map(_LAST, pieces), map(_FIRST, islice(pieces, 1, None)))):
            return a, np.frombuffer(b"".join(each_b), np.int32)
        b = self.b.encode(text)  # a merge may cross the end of a piece, or a piece is not spelled
        data = whole.encode()
        if b"".join([self.a_bytes[i] for i in a]) != data or b"".join([self.b_bytes[i] for i in b]) != data:
            return _NONE, _NONE
        return a, np.array(b, np.int32)


def _splits(pieces: str) -> bool:
    """Whether B's model merges neighbours only and changes no letter of a text before, so that parts stand alone."""
    try:
        from sentencepiece.sentencepiece_model_pb2 import ModelProto
    except ImportError:  # it needs protobuf
        return False
    with open(pieces, "rb") as file:
        model = ModelProto.FromString(file.read())
    rules, trained = model.normalizer_spec, model.trainer_spec
    changes = rules.precompiled_charsmap or rules.remove_extra_whitespaces or trained.treat_whitespace_as_suffix
    return bool(
        trained.model_type == trained.BPE and rules.add_dummy_prefix and rules.escape_whitespaces and not changes
    )


@functools.lru_cache(maxsize=1)
def token_pair(byte_level: str, pieces: str) -> TokenPair:
    return TokenPair(byte_level, pieces)


def _stretch(a: list[int], b: list[int], i: int, j: int) -> int:
    """Number of equal ends from ``a[i]`` and ``b[j]`` on, the first known to be equal, the last not."""
    x, y, step = i + 1, j + 1, 1
    if a[x] != b[y]:
        return 1
    while a[x : x + step] == b[y : y + step]:
        x += step
        y += step
        step *= 2
    while step > 1:
        step //= 2
        if a[x : x + step] == b[y : y + step]:
            x += step
            y += step
    return x - i


def groups(a: list[int], b: list[int]) -> Iterator[tuple[int, int, int, int, list[tuple[int, int]] | None]]:
    """Parts of two arrays of ends that reach the same last end: ``a[i:k]`` against ``b[j:m]``.

    Without links, the tokens of a part match one to one, each a group; else the part is one group with the places
    of its overlapping tokens.
    """
    i = j = 0
    size = len(a)
    a, b = [*a, -1], [*b, -2]  # no stretch goes beyond these
    while i < size:
        x, y = a[i], b[j]
        if x == y:
            n = _stretch(a, b, i, j)
            yield i, i + n, j, j + n, None
            i += n
            j += n
            continue
        k, m = i, j
        links = [(k, m)]
        while x != y:
            if x < y:
                k += 1
                x = a[k]
            else:
                m += 1
                y = b[m]
            links.append((k, m))
        k += 1
        m += 1
        yield i, k, j, m, links
        i, j = k, m


def _along(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each of ``first`` on, as many as its length."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(first - before, lengths) + np.arange(lengths.sum())


class Alignments:
    """Groups and links of some texts, aligned one after the other as if they were one.

    At the end of a text tokens of both end, so no group goes beyond it. ``pairs`` and ``counts`` are those of text
    ``t`` from ``ends[t]`` to ``ends[t + 1]``.
    """

    def __init__(self, pair: TokenPair, texts: list[str | None]):
        encoded = [pair.encoded(text) for text in texts]
        a, b = (np.concatenate([each[side] for each in encoded]).astype(np.int64) for side in range(2))
        self.n_a, self.n_b = (np.array([len(each[side]) for each in encoded], np.int64) for side in range(2))
        a_first: list[int] = []
        b_first: list[int] = []
        stretches: list[int] = []
        crossing: list[tuple[int, int]] = []
        for i, k, j, _, links in groups(np.cumsum(pair.a_sizes[a]).tolist(), np.cumsum(pair.b_sizes[b]).tolist()):
            a_first.append(i)
            b_first.append(j)
            if links is None:
                stretches.append(k - i)
            else:
                stretches.append(0)
                crossing += links
        matched = np.array(stretches, np.int64)
        lengths = np.maximum(matched, 1)
        a_starts, b_starts = (_along(np.array(first, np.int64), lengths) for first in (a_first, b_first))
        straight = np.repeat(matched > 0, lengths)
        places = np.fromiter(chain.from_iterable(crossing), np.int64, 2 * len(crossing)).reshape(-1, 2)
        left = np.concatenate([a_starts[straight], places[:, 0]])
        right = np.concatenate([b_starts[straight], places[:, 1]])
        text = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups, self.n_links = (np.bincount(text[at], minlength=len(texts)) for at in (a_starts, left))
        self.digests = self._digests(pair, a, b, a_starts, b_starts)
        size = len(pair.a_bytes) * len(pair.b_bytes)
        codes, self.counts = np.unique(
            text[left] * size + a[left] * len(pair.b_bytes) + b[right], return_counts=True
        )
        self.ends = np.searchsorted(codes, np.arange(len(texts) + 1) * size)
        self.pairs = codes % size

    def _digests(
        self, pair: TokenPair, a: np.ndarray, b: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray
    ) -> list[str]:
        """Digest of the groups of each text: every token is one number of its name and the sign that follows it."""
        written = np.zeros(len(a) + len(b), np.dtype("<u8"))
        long = np.zeros(len(written), np.int64)
        # A token of A has those of B of earlier groups before it, and one of B those of A of its own group as well.
        befores = b_starts, np.append(a_starts[1:], len(a))
        for ids, starts, before, sign in zip((a, b), (a_starts, b_starts), befores, b"|;"):
            begins = np.zeros(len(ids) + 1, np.int64)
            begins[starts] = 1
            begins[-1] = 1
            at = np.arange(len(ids)) + before[np.cumsum(begins[:-1]) - 1] if len(ids) else starts
            signs = np.where(begins[1:] == 1, np.uint64(sign), np.uint64(ord(",")))
            digits = pair.digits[ids]
            written[at] = pair.names[ids] | (signs << (digits * np.uint64(8)))
            long[at] = digits + np.uint64(1)
        body = written.view(np.uint8)
        body = body[body != 0].tobytes()
        ends = np.append(0, np.cumsum(long))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [hashlib.sha256(body[x : y - 1]).hexdigest() if y > x else "" for x, y in pairwise(ends)]


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without the search for cycles of objects: aligning makes many small ones, and none in a cycle."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def _packed(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in order and their counts, as steps, compressed."""
    body = np.diff(pairs, prepend=0).astype(np.int64).tobytes() + counts.astype(np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
    half = len(body) // 2
    return np.cumsum(body[:half]), body[half:]


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate(pairs), return_inverse=True)
    return codes, np.bincount(where, np.concatenate(counts), len(codes)).astype(np.int64)


def _aligning(byte_level: str, pieces: str, block_bytes: int) -> object:
    """The map from texts to their alignments, with a row of summed pairs at the end of every block."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(byte_level, pieces)
        block = TaskContext.get().partitionId() << 33
        size, waiting, pairs, counts = 0, [], [], []
        names = [field.split(" ")[0] for field in _ALIGNED.split(", ")]
        kinds = [
            pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())
        ]

        def given(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def summary() -> tuple:
            codes, sums = _summed(pairs, counts)
            return True, block, None, 0, 0, 0, 0, "", None, codes, sums

        def found() -> list[tuple]:
            """Rows of the texts that wait; their pairs join those of the block."""
            ids, texts = zip(*waiting)
            waiting.clear()
            with _uncollected():
                each = Alignments(pair, texts)
            numbers = (column.tolist() for column in (each.n_a, each.n_b, each.n_groups, each.n_links))
            links = [_packed(each.pairs[x:y], each.counts[x:y]) for x, y in pairwise(each.ends.tolist())]
            if len(each.pairs):
                pairs.append(each.pairs)
                counts.append(each.counts)
            if len(pairs) >= 8:  # merge now and then, so that what is kept stays small
                codes, sums = _summed(pairs, counts)
                pairs[:], counts[:] = [codes], [sums]
            none = [None] * len(ids)
            return list(zip([False] * len(ids), [block] * len(ids), ids, *numbers, each.digests, links, none, none))

        for batch in batches:
            rows, waits = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text.as_py()
                waiting.append((doc_id.as_py(), text))
                waits += len(text or "")
                size += len(text or "")
                if size >= block_bytes or waits >= ALIGNED_BYTES:
                    rows += found()
                    waits = 0
                if size >= block_bytes:
                    if pairs:
                        rows.append(summary())
                    block, size, pairs, counts = block + 1, 0, [], []
            if waiting:
                rows += found()
            if rows:
                yield given(rows)
        if pairs:
            yield given([summary()])

    return align


def _looked_up(texts: pa.Table, corpus: pa.Table) -> pa.Table:
    """Texts of a block with what the corpus-wide counts say of their links."""
    order = np.argsort(corpus["pair"].to_numpy())
    pairs, totals = corpus["pair"].to_numpy()[order], corpus["total"].to_numpy()[order]
    best = corpus["best"].to_numpy()[order]
    n_best, count_sum = [], []
    for links in texts["links"]:
        codes, counts = _unpacked(links.as_py())
        at = np.searchsorted(pairs, codes)
        n_best.append(int(counts[best[at] == 1].sum()))
        count_sum.append(int((counts * totals[at]).sum()))
    columns = [texts[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    columns += [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), texts["groups_sha256"]]
    return pa.table(columns, names=[field.split(" ")[0] for field in RESULT.split(", ")])


def pair_counts(summaries: DataFrame, b_size: int) -> DataFrame:
    """(pair, total, best) over the corpus, from (block, pair, n): ``best`` where no pair of the B id has more."""
    totals = summaries.groupBy((F.col("pair") % b_size).alias("b"), "pair").agg(F.sum("n").alias("total"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    best = (F.col("total") == F.col("most")).cast("long").alias("best")
    return totals.join(most, "b").select("pair", "total", best)


def aligned(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document the tokens, groups and links of both encodings, and how common its links are in the corpus."""
    spark = docs.sparkSession
    small_batches(spark)
    path = shared_path(spark, "alignments")
    docs.select("doc_id", "text").mapInArrow(_aligning(byte_level, pieces, block_bytes), _ALIGNED).write.partitionBy(
        "summary"
    ).parquet(path)
    texts, sums = (spark.read.schema(_ALIGNED).parquet(path) for _ in range(2))
    texts = texts.where(~F.col("summary")).drop("summary", "pairs", "counts")
    sums = sums.where(F.col("summary")).select("block", F.arrays_zip("pairs", "counts").alias("each"))
    each = sums.select("block", F.inline("each").alias("pair", "n"))
    b_size = len(token_pair(byte_level, pieces).b_bytes)
    known = each.select("block", "pair").join(pair_counts(each, b_size), "pair")
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_looked_up, RESULT)
