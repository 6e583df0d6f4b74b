"""Token counts of a byte-level BPE vocabulary by dynamic programming over prefixes.

A sequence of tokens is what the vocabulary's merges give for its bytes exactly if every two neighbours
are what the merges give for their bytes. So the encoding of a prefix is the encoding of a shorter prefix
plus one token, and the last token and the count of every prefix follow from those of shorter ones. A text
falls into pieces (words with their space, numbers, signs, white space) that merges do not cross; counts at
piece ends are running sums, and counts inside a piece come from its own table. From these tables, counts
of any prefix, truncation to a budget and checks of a budget are answered without encoding again.

Plan: one pass of ``mapInArrow`` over the texts, no shuffle. Tables of pieces are kept per Python worker,
up to ``KEPT_PIECES``; then they start anew, which costs time and changes no result.

Defined results: a null text counts as empty and has 0 bytes and 0 tokens; rows with equal ids are counted
one by one; a null id stays null; an empty table gives no rows; columns other than those named are not read.
A special string of the vocabulary inside a text is one token, which is the default of its library.
"""

from __future__ import annotations

import functools
import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: How the vocabulary's library cuts texts into pieces: a fixed pattern, published with the vocabulary.
PIECES = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Pieces and token pairs whose results a worker keeps.
KEPT_PIECES = 400_000

LIMIT = 1024


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, then 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, and the prefix tables of pieces seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = _byte_letters()
        spelled = lambda token: bytes(letters[letter] for letter in token)
        model = described["model"]
        self.ids = {spelled(token): i for token, i in model["vocab"].items()}
        merges = (merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"])
        self.merges = {(spelled(a), spelled(b)): rank for rank, (a, b) in enumerate(merges)}
        self.formed: dict[bytes, int] = {}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        for (a, b), rank in self.merges.items():
            if self.formed.setdefault(a + b, rank) == rank:
                self.halves[a + b] = (a, b)
        self.longest = max(map(len, self.ids))
        self.special = [token["content"] for token in described["added_tokens"]]
        self._split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._follows: dict[tuple[bytes, bytes], bool] = {}
        self._tables: dict[str, tuple[int, ...]] = {}
        self.totals = _Totals(self)

    def follows(self, before: bytes, token: bytes) -> bool:
        """Whether the merges, run over both tokens' bytes, leave the two as they are.

        Each token grew by merges of falling rank towards its edge. Two edge parts touch from when the later
        of them is formed until one of them is absorbed; a merge across the border that comes before that
        would have happened. Equal ranks are carried out from the left, so the left part goes first.
        """
        if not before:
            return True
        known = self._follows.get((before, token))
        if known is None:
            if len(self._follows) >= KEPT_PIECES:
                self._follows.clear()
            known = self._follows[before, token] = self._stay_apart(before, token)
        return known

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        merges, formed, halves = self.merges, self.formed, self.halves
        never = len(merges)
        left_absorbed = right_absorbed = never
        while True:
            across = merges.get((left, right), never)
            if across < left_absorbed and across <= right_absorbed:
                return False
            left_formed, right_formed = formed.get(left, -1), formed.get(right, -1)
            if left_formed == right_formed == -1:
                return True
            if left_formed > right_formed:
                left_absorbed, left = left_formed, halves[left][1]
            else:
                right_absorbed, right = right_formed, halves[right][0]

    def table(self, piece: str) -> tuple[int, ...]:
        """Number of tokens of every prefix of a piece, by its length in bytes."""
        known = self._tables.get(piece)
        if known is None:
            if len(self._tables) >= KEPT_PIECES:
                self._tables.clear()
            known = self._tables[piece] = self._count(piece.encode())
        return known

    def _count(self, data: bytes) -> tuple[int, ...]:
        ids, known, longest = self.ids, self._follows, self.longest
        counts, last = [0], [b""]
        for end in range(1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = data[start:end]
                if token in ids:
                    before = last[start]
                    apart = known.get((before, token))
                    if apart or (apart is None and self.follows(before, token)):
                        break
            else:
                raise ValueError("a byte is not in the vocabulary")
            counts.append(counts[start] + 1)
            last.append(token)
        return tuple(counts)

    def ordinary(self, text: str) -> int:
        """Tokens of a text in which special strings mean nothing."""
        return sum(map(self.totals.__getitem__, PIECES.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self._split is None or not any(string in text for string in self.special):
            return self.ordinary(text)
        segments = self._split.split(text)
        return sum(map(self.ordinary, segments)) + len(segments) - 1

    def prefixes(self, text: str) -> Prefixes:
        """Exact counts at all prefixes of a text."""
        return Prefixes(self, text)


class _Totals(dict):
    """Tokens of whole pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        if len(self) >= KEPT_PIECES:
            self.clear()
        total = self[piece] = self.vocabulary._count(piece.encode())[-1]
        return total


class Prefixes:
    """Token counts of every prefix of one text.

    ``starts[i]`` is where piece ``i`` begins, in code points, and ``before[i]`` the tokens of all pieces
    before it; both have one more entry for the end of the text.
    """

    def __init__(self, vocabulary: Vocabulary, text: str):
        self.vocabulary, self.text = vocabulary, text
        self.pieces: list[str] = []
        self.is_special: list[bool] = []
        at = 0
        for match in vocabulary._split.finditer(text) if vocabulary._split else ():
            self._add(text[at : match.start()])
            self.pieces.append(match.group())
            self.is_special.append(True)
            at = match.end()
        self._add(text[at:])
        self.starts = [0, *accumulate(map(len, self.pieces))]
        totals = vocabulary.totals
        sizes = (1 if special else totals[piece] for piece, special in zip(self.pieces, self.is_special))
        self.before = [0, *accumulate(sizes)]

    def _add(self, segment: str) -> None:
        found = PIECES.findall(segment)
        self.pieces += found
        self.is_special += [False] * len(found)

    def __getitem__(self, cut: int) -> int:
        """Tokens of the first ``cut`` code points taken as a text of their own."""
        i = bisect_left(self.starts, cut)
        if self.starts[i] == cut and not self._runs_on(i, cut):
            return self.before[i]
        i -= 1
        piece, inside = self.pieces[i], cut - self.starts[i]
        whole_rule = not self.is_special[i] and piece[0] != "'" and not piece[:inside][-1].isspace()
        if whole_rule:
            return self.before[i] + self.vocabulary.table(piece)[len(piece[:inside].encode())]
        i = self._back(i, cut)
        return self.before[i] + self.vocabulary.ordinary(self.text[self.starts[i] : cut])

    def _runs_on(self, i: int, cut: int) -> bool:
        """Whether white space that ends the prefix also goes on after it, so that pieces fall differently."""
        return 0 < i < len(self.pieces) and self.text[cut - 1].isspace() and not self.is_special[i - 1]

    def _back(self, i: int, cut: int) -> int:
        """The last piece before the cut from where the prefix falls into pieces as the whole text does."""
        if self.is_special[i] and i and not self.is_special[i - 1]:
            i -= 1
        while i and self.pieces[i][0].isspace() and self.pieces[i - 1].isspace() and not self.is_special[i - 1]:
            i -= 1
        return i

    def longest(self, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens."""
        if self.before[-1] <= budget:
            return len(self.text)
        i = bisect_right(self.before, budget)
        cut = self.starts[min(i + 1, len(self.starts) - 1)]
        while cut and self[cut] > budget:
            cut -= 1
        return cut


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per Python worker."""
    return Vocabulary(path)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every whole text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            counts = [tokens.count(text.as_py()) for text in texts]
            lengths = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lengths, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per document the ends of its pieces, in code points, and the tokens up to each of them."""

    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path)
        for batch in batches:
            tables = [tokens.prefixes(text.as_py() or "") for text in batch.column("text")]
            ends = pa.array([table.starts[1:] for table in tables], pa.list_(pa.int32()))
            counts = pa.array([table.before[1:] for table in tables], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ends, counts], ["doc_id", "ends", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tabled, f"doc_id {kind}, ends array<int>, tokens array<int>")


def truncated(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """The documents with each text cut to its longest prefix of at most ``budget`` tokens; null stays null."""
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path)
        at = names.index("text")
        for batch in batches:
            kept = [
                text if text is None else text[: tokens.prefixes(text).longest(budget)]
                for text in batch.column(at).to_pylist()
            ]
            columns = batch.columns
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(cut, docs.schema)
