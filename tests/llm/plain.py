"""Plain versions of the training-data operators, to compare with on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: str | None) -> str:
    return (text or "").translate(str.maketrans(_UPPER, _LOWER))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(lower(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def linked(a: frozenset, b: frozenset) -> bool:
    common = len(a & b)
    return 100 * common >= 80 * (len(a) + len(b) - common)


def near_components(rows) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), all pairs compared."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    return [(doc_id, len(sets[i]), min(x for x in ids[find(i)] if x is not None)) for i, (doc_id, _) in enumerate(rows)]


def contamination(text: str | None, items: dict) -> tuple:
    """(n_words, n_hit, items) of a text."""
    words = ALPHANUMERIC.findall(lower(text))
    hit, found = set(), set()
    for item_id, item in items.items():
        theirs = ALPHANUMERIC.findall(lower(item))
        size = min(13, len(theirs))
        windows = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base secrets."""
    text = text or ""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def winnowed(units: list, gram: int, window: int, hash_of) -> list[int]:
    """Places that winnowing chooses: smallest hash of each window, rightmost on ties."""
    if not units:
        return []
    hashes = [hash_of(units[i : i + gram]) for i in range(max(1, len(units) - gram + 1))]
    chosen = set()
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start : start + window]
        chosen.add(start + max(i for i, value in enumerate(part) if value == min(part)))
    return sorted(chosen)
