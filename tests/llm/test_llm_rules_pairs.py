"""Quality rules, hard negatives and token alignment against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from entity_events.llm import alignment, hard_negatives, quality_rules
from tests.llm import plain

# Quality rules


def plain_measures(text):
    text = text or ""
    words = plain.WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if plain.WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(letter in "#*$%&|<>" for letter in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_are_those_of_a_plain_count(make):
    rng = random.Random(5)
    units = ["a", "b", "éa", "😀", "#x", "|", "*", "\t", "\n", "\n", "\r\n", " ", "\x0b", " ", "a b", "c", "A A A"]
    texts = [None, "", " ", "\n\n", "a a a", "a a a a", "x y z x y z", "l\nl\nl \n l"]
    texts += [" ".join(rng.choice(units) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts.append("word " * 40_000 + " ".join(f"u{i}" for i in range(60_000)))
    docs = make(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.select("doc_id", quality_rules.measures(F.col("text")).alias("m")).select("doc_id", *(f"m.{n}" for n in BASE)).collect()
    assert {row[0]: tuple(row)[1:] for row in rows} == {i: plain_measures(text) for i, text in enumerate(texts)}


def plain_model(counts, rules, rounds):
    """Expectation-maximisation over {votes: n}; the quality of each."""
    share, on_good, on_bad = quality_rules.START
    good, bad = [on_good] * rules, [on_bad] * rules

    def posterior(votes):
        odds = math.log(share / (1 - share))
        for vote, right, caught in zip(votes, good, bad):
            odds += {2: math.log(right / (1 - caught)), 0: math.log((1 - right) / caught), 1: 0.0}[vote]
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        p = {votes: posterior(votes) for votes in counts}
        total = sum(counts.values())
        share = (sum(n * p[v] for v, n in counts.items()) + 1) / (total + 2)
        said = lambda rule, vote, of: sum(n * of(p[v]) for v, n in counts.items() if v[rule] == vote)  # noqa: B023, E731
        good = [(said(r, 2, lambda x: x) + 1) / (said(r, 2, lambda x: x) + said(r, 0, lambda x: x) + 2) for r in range(rules)]
        caught = [(said(r, 0, lambda x: 1 - x) + 1) / (said(r, 2, lambda x: 1 - x) + said(r, 0, lambda x: 1 - x) + 2) for r in range(rules)]
        bad = [max(c, 1 - g) for c, g in zip(caught, good)]
    return {votes: posterior(votes) for votes in counts}


def test_qualities_are_those_of_a_plain_estimation(make):
    rng = random.Random(2)
    rules = len(quality_rules.RULES)
    rows = []
    for _ in range(400):
        good = rng.random() < 0.8
        votes = [rng.choice([2, 2, 2, 2, 1] if good else [0, 0, 2, 1]) for _ in range(rules)]
        rows.append(tuple(votes))
    patterns = [(sum(vote * 3**i for i, vote in enumerate(votes)),) for votes in rows]
    got = quality_rules.pattern_qualities(make(patterns, "pattern int")).collect()
    want = plain_model(Counter(rows), rules, quality_rules.ROUNDS)
    assert len(got) == len(want)
    for row in got:
        votes = tuple(row.pattern // 3**i % 3 for i in range(rules))
        assert row.quality == pytest.approx(want[votes], abs=1e-9)


def test_junk_goes_and_prose_stays(make):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(12)) + "." for _ in range(n // 12))
    kinds = {
        "prose": lambda: prose(200),
        "caps": lambda: " ".join(f"{word().upper()}!!" for _ in range(150)),
        "pipes": lambda: " | ".join(word() for _ in range(150)),
        "signs": lambda: " ".join(word() + rng.choice(["###", "%%%", "&&&"]) for _ in range(150)),
        "repeats": lambda: " ".join(f"{w} {w} {w} {w} {w} {w}" for w in (word() for _ in range(30))),
        "short": lambda: prose(24),
    }
    rows = [(i, kinds[kind](), kind, "q", 7) for i, kind in enumerate(["prose"] * 300 + list(kinds)[1:] * 12)]
    rows += [(1000, None, "short", "q", 7), (None, "", "short", "q", 7), (5, rows[5][1], "prose", "q", 7)]
    # Columns with names that the operator uses itself.
    docs = make(rows, "doc_id long, text string, kept string, quality string, n_words int")
    judged = quality_rules.assessed(docs).select("row.kept", F.col("kept").alias("verdict"), "base_failed").collect()
    assert Counter((row.kept, row.verdict) for row in judged) == {
        ("prose", True): 301, ("short", False): 14, **{(kind, False): 12 for kind in ("caps", "pipes", "signs", "repeats")}
    }
    kept = quality_rules.good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 301
    assert quality_rules.assessed(docs.limit(0)).count() == 0


# Hard negatives


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for dims, low, high in ((8, -1, 1), (64, -160, 160), (24, -(2**40), 2**40), (16, 0, 1), (8, -(2**62), 2**62)):
        anchors, candidates = (rng.integers(low, high, (n, dims), endpoint=True) for n in (5, 33))
        with np.errstate(over="ignore"):
            want = candidates @ anchors.T
        planes = hard_negatives.planes_of(candidates)
        assert (hard_negatives.scores(hard_negatives.subset_sums(anchors), planes) == want).all()
        narrow = hard_negatives._narrowed(anchors, len(planes))
        assert (hard_negatives.scores(hard_negatives.subset_sums(narrow), planes) == want).all()
    zeros = hard_negatives.planes_of(np.zeros((3, 8), np.int64))
    assert (hard_negatives.scores(hard_negatives.subset_sums(np.ones((2, 8), np.int64)), zeros) == 0).all()


def plain_negatives(rows, anchor, positives=5, negatives=3):
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(np.float32(x).item() * 256) for x in vector]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    rank = lambda row: (-row[0], row[1] is None, row[1] or 0)
    found = []
    for i, (anchor_id, label, vector) in enumerate(usable):
        if anchor_id is None or not anchor(anchor_id):
            continue
        others = [(score(vector, v), vec_id, other) for j, (vec_id, other, v) in enumerate(usable) if j != i]
        for p_score, p_id, _ in sorted((row for row in others if row[2] == label), key=rank)[:positives]:
            hard = [row for row in others if row[2] != label and 50 * p_score <= 100 * row[0] <= 95 * p_score]
            for turn, (n_score, n_id, _) in enumerate(sorted(hard, key=rank)[:negatives], 1):
                found.append((anchor_id, p_id, turn, n_id, p_score, n_score))
    return sorted(found, key=str)


@pytest.mark.parametrize("block, sample", [(16_384, 16), (3, 1)])
def test_negatives_are_those_of_comparing_all_rows(make, monkeypatch, block, sample):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
    rng = random.Random(4)
    vector = lambda: [rng.uniform(-0.4, 0.6) for _ in range(12)]
    rows = [(i, vector(), rng.randrange(4)) for i in range(150)]
    common = vector()
    rows += [(1000 + i, common, rng.randrange(3)) for i in range(60)]  # ties
    rows += rows[:10] + rows[:10]  # repeated rows, anchors among them
    rows += [(2000, None, 1), (2010, vector(), None), (2020, [0.1, None, 0.2], 1), (2030, [float("nan")] * 12, 1)]
    rows += [(2040, [float("inf")] * 12, 1), (2050, [], 1), (2060, vector()[:5], 2), (2070, vector() + [0.5] * 9, 0)]
    rows += [(None, vector(), 1), (None, common, 2), (-10, vector(), 3)]
    table = make([(*row, 0, "x") for row in rows], "vec_id long, embedding array<float>, label int, ask long, row string")
    got = hard_negatives.mined(table.repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_no_anchors_or_one_label(make):
    table = make([(i, [0.1 * i] * 3, 1) for i in range(30)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mined(table, F.col("vec_id") == 99).count() == 0
    assert hard_negatives.mined(table, F.col("vec_id") % 10 == 0).count() == 0


# Alignment


def test_groups_end_where_both_ends_meet():
    rng = random.Random(8)
    for _ in range(300):
        size = rng.randrange(1, 60)
        cut = lambda dense, size=size: sorted({size, *(i for i in range(1, size) if rng.random() < dense)})  # noqa: B023, E731
        a, b = cut(rng.choice([0.1, 0.6, 1.0])), cut(rng.choice([0.1, 0.6, 1.0]))
        ends, links = [], set()
        for i, k, j, m, crossing in alignment.groups(a, b):
            ends += [a[x] for x in range(i, k)] if crossing is None else [a[k - 1]]
            assert crossing is not None or a[i:k] == b[j:m]
            links |= set(crossing if crossing is not None else zip(range(i, k), range(j, m)))
        assert ends == sorted(set(a) & set(b))
        assert links == overlaps(a, b)


def overlaps(a, b):
    starts = lambda ends: [0, *ends[:-1]]
    return {
        (x, y)
        for x, (s, e) in enumerate(zip(starts(a), a))
        for y, (t, f) in enumerate(zip(starts(b), b))
        if max(s, t) < min(e, f)
    }


class PlainPair:
    """Tokens with their bytes, straight from both libraries."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [i for i in range(256) if i not in printable]
        self.letters = {**{chr(i): i for i in printable}, **{chr(256 + n): i for n, i in enumerate(rest)}}

    def tokens(self, text):
        text = text or ""
        whole = f" {text}"
        a = self.a.encode(whole, add_special_tokens=False)
        spelled = [bytes(self.letters[x] for x in token) for token in a.tokens]
        pieces = [(i, self.b.id_to_piece(i)) for i in self.b.encode(text)]
        also = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not text or b"".join(spelled) != whole.encode() or b"".join(also) != whole.encode():
            return [], [], [], []
        ends = lambda parts: np.cumsum([len(part) for part in parts]).tolist()
        return a.ids, ends(spelled), [i for i, _ in pieces], ends(also)


def plain_alignment(texts):
    pair = PlainPair()
    found, totals = [], Counter()
    for text in texts:
        a, a_ends, b, b_ends = pair.tokens(text)
        links = [(a[x], b[y]) for x, y in sorted(overlaps(a_ends, b_ends))]
        totals.update(links)
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            k, m = a_ends.index(end) + 1, b_ends.index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((len(a), len(b), len(groups), links, digest))
    most = Counter()
    for (_, b), n in totals.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n, len(links), sum(totals[x] == most[x[1]] for x in links), sum(totals[x] for x in links), digest)
        for n_a, n_b, n, links, digest in found
    ]


@pytest.mark.parametrize("block_bytes", [1, 500, alignment.BLOCK_BYTES])
def test_alignment_is_that_of_comparing_all_tokens(make, block_bytes):
    rng = random.Random(6)
    units = ["the", " tokenization", "é", "ß", " 漢字", "😀", "\n", "\t", "  ", "12345", "'s", "<|endoftext|>", "</s>", "<s>", "▁"]
    units += ["\r\n", "aaaaaaaa", "don't", " ", "́", "x" * 70, "<0x41>", "ﬁ"]
    texts = [None, "", " ", "a", "▁", "\x00", "naïve"] + [
        "".join(rng.choice(units) for _ in range(rng.randrange(1, 25))) for _ in range(80)
    ]
    texts += [texts[20]] * 3
    rows = [(i if i != 9 else None, text, "x", 1) for i, text in enumerate(texts)]
    docs = make(rows, "doc_id long, text string, block string, n_a int").repartition(3)
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    got = alignment.aligned(docs, *paths, block_bytes=block_bytes).collect()
    want = plain_alignment(texts)
    assert sorted(map(str, map(tuple, got))) == sorted(str((i if i != 9 else None, *row)) for i, row in enumerate(want))
    assert any(row[0] for row in want) and want[4][0] == 0


def test_a_long_text_is_aligned(make):
    text = " ".join(f"word{i % 977}" for i in range(150_000))
    docs = make([(1, text), (2, None)], "doc_id long, text string")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = {row.doc_id: row for row in alignment.aligned(docs, *paths).collect()}
    assert rows[1].n_links >= rows[1].n_a > 300_000 and rows[1].n_groups > 150_000
    assert (rows[2].n_a, rows[2].n_links, rows[2].groups_sha256) == (0, 0, "")


PAIR_PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_known_pieces_are_not_encoded_again():
    pair = alignment.TokenPair(*PAIR_PATHS)
    text = "A naïve tokenization, of 123 words.\nAnd more"
    a, _, b, _ = PlainPair().tokens(text)
    assert [ids.tolist() for ids in pair.encoded(text)] == [a, b]
    pair.a = pair.b = None
    assert [ids.tolist() for ids in pair.encoded(text)] == [a, b]
    assert [ids.tolist() for ids in pair.encoded("more words, of")] != [[], []]


def test_merges_across_pieces_are_those_of_the_whole_text():
    pair, plain = alignment.TokenPair(*PAIR_PATHS), PlainPair()
    texts = ["call();\r\n}\r\n", "a    b", "  x", "don'table's'sure", "m².", " \r\r", "x\r", "'s", " ", "\n", "x\u3000 y"]
    for text in texts:
        a, _, b, _ = plain.tokens(text)
        assert a and [ids.tolist() for ids in pair.encoded(text)] == [a, b], text
    assert [len(ids) for ids in pair.encoded("word ▁ word")] == [0, 0]


def test_texts_aligned_together_are_as_alone():
    pair = alignment.TokenPair(*PAIR_PATHS)
    texts = [None, "", "one two", "▁", "naïve 漢字", "one two", "\x00", ""]
    together = alignment.Alignments(pair, texts)
    for t, text in enumerate(texts):
        alone = alignment.Alignments(pair, [text])
        for name in ("n_a", "n_b", "n_groups", "n_links", "digests"):
            assert getattr(together, name)[t] == getattr(alone, name)[0]
        part = slice(together.ends[t], together.ends[t + 1])
        assert together.pairs[part].tolist() == alone.pairs.tolist()
        assert together.counts[part].tolist() == alone.counts.tolist()
