"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult or threat (with a weight), target, negation, reported speech, anything else. Five
small transducers read the symbols of a clause: two put out the weights of insults and threats, one raises them
once a target was named, one turns them down for a few words after a negation, and one turns them down after a
verb of reported speech or a quotation mark. Their composition is one table of states and factors. A clause is
scored by the sum of its weighted outputs, a text by the scores of its matched clauses through a logistic
function, so single words count only by what their clause makes of them.

Words of targets, negation, reported speech and threats are short fixed lists. The insults are learned: words,
and beginnings of words of ``STEMS`` bytes, that labelled toxic documents have and clean ones lack, with the
log odds as weight. Learning takes a bounded sample: ``SAMPLE`` labelled documents of each class, the first by
hash of their ids. Weights of the logistic function are fitted on halves whose insults come from the other
half.

Plan: labels meet ids of documents in one join of narrow rows, the sample is limited per class before its
shuffle, and only its texts are fetched. Scoring is one pass of ``mapInArrow``, no shuffle, over whole texts.

Defined results: a null or empty text has no clauses and gets the score of that; a document without a label
is scored alike; repeated rows are scored alike; labels of unknown documents are ignored; of several labels of
one document a toxic one counts; when no labels of both classes are there, only the fixed lists count; an
empty table gives no rows; with ``carry`` other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from entity_events.llm.common import ALPHANUMERIC, BASE, Texts, Words, mix, small_batches, text_slices, words_of

SAMPLE = 2500
#: Lengths of the beginnings of words that may carry a weight, in bytes.
STEMS = (4, 5, 6)
#: A learned entry has so many places in toxic documents at least, also as a share of their number, and the
#: lower bound of its log odds lies above this.
LEAST_PLACES, LEAST_SHARE, LEAST_ODDS, DEVIATIONS = 3, 0.01, 1.5, 2.0
MOST_ENTRIES = 20_000
LIMIT = 0.5

# Symbols of the grammar.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

THREATS = "kill hurt destroy attack burn töten schlagen vernichten tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours u he she they them du dich dir euch ihr tu toi te vous ton ta tú usted ustedes vosotros"
NEGATIONS = "not no never isn't without kein keine nicht nie pas jamais sans nunca jamás sin"
REPORTS = "said says quoted reported claims wrote sagte sagt schrieb dit dijo dice"
THREAT_WEIGHT = 1.0

#: Factors of the grammar: after a target, within so many words after a negation, in reported speech.
TARGETED, NEGATED, REACH, REPORTED = 1.5, 0.4, 3, 0.6

_BREAK = np.zeros(256, bool)
_BREAK[list(b".!?;:\n")] = True


@dataclass
class Transducer:
    """For every state and symbol, the next state and the factor put on an output."""

    moves: np.ndarray
    factors: np.ndarray

    def composed(self, other: Transducer) -> Transducer:
        """Both read the same symbols; factors multiply."""
        size = len(other.moves)
        moves = (self.moves[:, None, :] * size + other.moves[None, :, :]).reshape(-1, self.moves.shape[1])
        factors = (self.factors[:, None, :] * other.factors[None, :, :]).reshape(-1, self.moves.shape[1])
        return Transducer(moves, factors)


def _latch(symbol: int, factor: float) -> Transducer:
    """Outputs get the factor from the first such symbol of the clause on."""
    moves = np.array([[0] * 6, [1] * 6])
    moves[0, symbol] = 1
    return Transducer(moves, np.array([[1.0] * 6, [factor] * 6]))


def _window(symbol: int, factor: float, reach: int) -> Transducer:
    """Outputs get the factor in the ``reach`` words after such a symbol."""
    moves = np.repeat(np.maximum(np.arange(reach + 1) - 1, 0)[:, None], 6, axis=1)
    moves[:, symbol] = reach
    factors = np.ones((reach + 1, 6))
    factors[1:] = factor
    return Transducer(moves, factors)


def _emit(symbol: int) -> Transducer:
    """Lets the weight of one symbol through."""
    factors = np.zeros((1, 6))
    factors[0, symbol] = 1.0
    return Transducer(np.zeros((1, 6), int), factors)


def grammar() -> Transducer:
    matched = Transducer(_emit(INSULT).moves, _emit(INSULT).factors + _emit(THREAT).factors)
    target = _latch(TARGET, TARGETED)
    return matched.composed(target).composed(_window(NEGATION, NEGATED, REACH)).composed(_latch(REPORT, REPORTED))


# Words as hashes, and entries of the lexicon


def _prefix_hashes(data: np.ndarray, words: Words, length: int) -> np.ndarray:
    """Hash of the first ``length`` bytes of every word, 0 for words that are not longer."""
    long = words.ends - words.starts > length
    starts = words.starts[long]
    sums = np.zeros(len(starts), np.uint64)
    for j in range(length):
        sums = sums * np.uint64(BASE) + data[starts + j] + np.uint64(1)
    hashes = np.zeros(len(words.hashes), np.uint64)
    hashes[long] = mix(sums ^ np.uint64(length << 56))
    return hashes


def _entries(data: np.ndarray, words: Words) -> list[np.ndarray]:
    """For every word the entries that may carry a weight: the word itself and its beginnings."""
    return [words.hashes, *(_prefix_hashes(data, words, length) for length in STEMS)]


def _fixed(listed: str) -> np.ndarray:
    column = pa.array([listed], pa.string())
    [texts] = text_slices(column)
    return words_of(texts, texts.lower(), ALPHANUMERIC).hashes


class _Lookup:
    """Values by hash: a bit table turns most words away before the sorted keys are searched."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = np.zeros(1 << 18, bool)
        self.bits[(self.keys >> np.uint64(46)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are keys, and their values."""
        at = np.flatnonzero(self.bits[(hashes >> np.uint64(46)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], self.values[:0]
        spot = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        known = self.keys[spot] == hashes[at]
        return at[known], self.values[spot[known]]


class Lexicon:
    """Symbols of the fixed lists, and weights of the learned entries."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        fixed = [(THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)]
        hashes = [(symbol, value) for symbol, listed in fixed for value in _fixed(listed)]
        self.symbols = _Lookup(np.array([v for _, v in hashes], np.uint64), np.array([s for s, _ in hashes], np.int8))
        self.weights = _Lookup(keys, weights)

    def read(self, texts: Texts) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
        """Words of a slice with their clause numbers, symbols and weights."""
        data = texts.lower()
        words = words_of(texts, data, ALPHANUMERIC)
        n = len(words.hashes)
        symbols, weights = np.zeros(n, np.int8), np.zeros(n)
        at, found = self.symbols.find(words.hashes)
        symbols[at] = found
        weights[symbols == THREAT] = THREAT_WEIGHT
        for entry in _entries(data, words):
            at, found = self.weights.find(entry)
            weights[at] = np.maximum(weights[at], found)
            symbols[at] = INSULT
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
        quotes = np.concatenate([[0], np.cumsum(data == ord('"'))])
        fresh = np.ones(n, bool)
        fresh[1:] = (breaks[words.starts[1:]] != breaks[words.starts[:-1]]) | (words.text[1:] != words.text[:-1])
        quoted = np.zeros(n, bool)
        quoted[1:] = quotes[words.starts[1:]] != quotes[words.starts[:-1]]
        symbols[quoted & (symbols == OTHER)] = REPORT
        return words, np.cumsum(fresh) - 1, symbols, weights


def clause_scores(texts: Texts, lexicon: Lexicon, machine: Transducer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts and scores of the clauses with an output, and the words of every text."""
    words, clause, symbols, weights = lexicon.read(texts)
    hits = np.flatnonzero((symbols == INSULT) | (symbols == THREAT))
    owner, scores = [], []
    moves, factors = machine.moves.tolist(), machine.factors.tolist()
    for number in np.unique(clause[hits]):
        first, last = np.searchsorted(clause, number), np.searchsorted(clause, number, "right")
        state, score = 0, 0.0
        for symbol, weight in zip(symbols[first:last].tolist(), weights[first:last].tolist()):
            score += weight * factors[state][symbol]
            state = moves[state][symbol]
        owner.append(words.text[first])
        scores.append(score)
    return np.array(owner, np.int64), np.array(scores), words.counts


def _features(texts: Texts, lexicon: Lexicon, machine: Transducer) -> np.ndarray:
    """Per text: 1, the words of a text with matches, its best clause and the sum of its clauses, as logarithms.

    Chance matches grow with the length of a text.
    """
    owner, scores, counts = clause_scores(texts, lexicon, machine)
    n = len(texts)
    best = np.zeros(n)
    np.maximum.at(best, owner, scores)
    matched = np.where(best > 0, np.log1p(counts), 0.0)
    return np.stack([np.ones(n), matched, np.log1p(best), np.log1p(np.bincount(owner, scores, n))], axis=1)


# Learning


def _parts(texts: list[str]) -> Iterator[tuple[Words, list[np.ndarray], int]]:
    """Words of slices of the texts with their entries, and the number of texts before each slice."""
    before = 0
    for part in text_slices(pa.array(texts, pa.string())):
        data = part.lower()
        words = words_of(part, data, ALPHANUMERIC)
        yield words, _entries(data, words), before
        before += len(part)


def _document_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Entries and the number of documents that have each."""
    found = [np.zeros(0, np.uint64)]
    for words, entries, before in _parts(texts):
        owner = words.text.astype(np.uint64) + np.uint64(before)
        found += [_distinct(entry[entry != 0], owner[entry != 0])[0] for entry in entries]
    return np.unique(np.concatenate(found), return_counts=True)


def _context_counts(texts: list[str], keys: np.ndarray) -> np.ndarray:
    """Number of different words before each of the sorted entries ``keys``.

    Copies of a text repeat an entry in one context; a word of the language of insults has many.
    """
    wanted = _Lookup(keys, keys)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for words, entries, _ in _parts(texts):
        context = np.roll(words.hashes, 1)
        context[:1] = 0
        for entry in entries:
            at, key = wanted.find(entry)
            found.append(_distinct(key, context[at]))
    everywhere = _distinct(*(np.concatenate(column) for column in zip(*found)))[0]
    return np.bincount(np.searchsorted(keys, everywhere), minlength=len(keys))


def _distinct(entries: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs without repeats."""
    _, first = np.unique(mix(entries * np.uint64(BASE) + mix(others)), return_index=True)
    return entries[first], others[first]


def _learned_lexicon(toxic: list[str], clean: list[str]) -> Lexicon:
    keys, inside = _document_counts(toxic)
    other, outside = _document_counts(clean)
    spot = np.minimum(np.searchsorted(other, keys), max(len(other) - 1, 0))
    n_clean = np.where(other[spot] == keys, outside[spot], 0) if len(other) else np.zeros(len(keys))
    least = max(LEAST_PLACES, LEAST_SHARE * len(toxic))

    def judged(support: np.ndarray, n_clean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, c = support + 0.5, n_clean + 0.5
        odds = np.log(a / (len(toxic) + 1)) - np.log(c / (len(clean) + 1))
        bound = odds - DEVIATIONS * np.sqrt(1 / a + 1 / c)
        return np.flatnonzero((support >= least) & (bound > LEAST_ODDS)), odds, bound

    # Support can only fall by contexts, so contexts are counted for what passes without them.
    some, _, _ = judged(inside, n_clean)
    keys, inside, n_clean = keys[some], inside[some], n_clean[some]
    kept, odds, bound = judged(np.minimum(inside, _context_counts(toxic, keys)), n_clean)
    kept = kept[np.argsort(-bound[kept], kind="stable")[:MOST_ENTRIES]]
    return Lexicon(keys[kept], odds[kept])


@dataclass
class Model:
    lexicon: Lexicon
    machine: Transducer
    weights: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(texts, self.lexicon, self.machine) @ self.weights, -30, 30)))


def _all_features(texts: list[str], lexicon: Lexicon, machine: Transducer) -> np.ndarray:
    parts = [_features(part, lexicon, machine) for part in text_slices(pa.array(texts, pa.string()))]
    return np.concatenate(parts) if parts else np.zeros((0, 4))


def _logistic(features: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge; a higher clause score never makes a text less toxic."""
    weights = np.zeros(features.shape[1])
    used = np.arange(features.shape[1])
    while True:
        part, ridge = features[:, used], 0.1 * np.eye(len(used))
        found = np.zeros(len(used))
        for _ in range(40):
            chance = 1 / (1 + np.exp(-np.clip(part @ found, -30, 30)))
            slope = part.T @ (chance - truth) + ridge @ found
            curve = (part * (chance * (1 - chance) + 1e-6)[:, None]).T @ part + ridge
            found -= np.clip(np.linalg.solve(curve, slope), -2, 2)
        falling = np.flatnonzero((found < 0) & (used > 1))
        if not len(falling):
            weights[used] = found
            return weights
        used = np.delete(used, falling[np.argmin(found[falling])])


def learn(toxic: list[str], clean: list[str]) -> Model:
    machine = grammar()
    lexicon = _learned_lexicon(toxic, clean)
    if not toxic or not clean:
        return Model(lexicon, machine, np.array([-4.0, 0.0, 1.0, 1.0]))
    features, truth = [], []
    for half in range(2):
        other = _learned_lexicon(toxic[1 - half :: 2], clean[1 - half :: 2])
        for texts, label in ((toxic[half::2], 1.0), (clean[half::2], 0.0)):
            features.append(_all_features(texts, other, machine))
            truth.append(np.full(len(texts), label))
    return Model(lexicon, machine, _logistic(np.concatenate(features), np.concatenate(truth)))


def training_sample(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> DataFrame:
    """``text`` and ``toxic`` of at most ``sample`` labelled documents of each class, whole."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").alias("toxic"))
    ids = docs.where(learnable).select("doc_id").join(marks, F.col("doc_id") == F.col("labelled")).select("doc_id", "toxic")
    turn = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = ids.withColumn("turn", turn).where(F.col("turn") <= sample).select(F.col("doc_id").alias("chosen"), "toxic")
    # Bounded: ``sample`` ids a class.
    return docs.join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("chosen")).select("text", "toxic")


def scored(
    docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE, carry: bool = False
) -> DataFrame:
    """``doc_id`` and ``score`` of every document (doc_id, text); with ``carry`` also ``row``, all its columns.

    ``labels`` has doc_id and toxic (0 or 1); ``learnable`` tells the documents whose label may be learned from.
    """
    small_batches(docs.sparkSession)
    known = training_sample(docs.select("doc_id", "text"), labels, learnable, sample).collect()
    texts = {label: sorted(row.text or "" for row in known if row.toxic == label) for label in (0, 1)}
    model = learn(texts[1], texts[0])
    if not carry:
        docs = docs.select("doc_id", "text")
    names = [f"`{name}`" for name in docs.columns]
    wrapped = docs.select(F.struct(*names).alias("row"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            score = np.zeros(batch.num_rows)
            for part in text_slices(pc.struct_field(row, "text")):
                score[part.first : part.first + len(part)] = model.scores(part)
            ids = pc.struct_field(row, "doc_id")
            columns = [row, ids, pa.array(score)] if carry else [ids, pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "score"][-len(columns) :])

    schema = StructType([wrapped.schema["row"]] if carry else [])
    schema = schema.add("doc_id", docs.schema["doc_id"].dataType).add("score", DoubleType())
    return wrapped.mapInArrow(judged, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, learnable: Column) -> DataFrame:
    """The documents that are scored below the limit; all columns of ``docs``."""
    return scored(docs, labels, learnable, carry=True).where(F.col("score") < LIMIT).select("row.*")
