"""Language of code-switched text by a linear-chain conditional random field over its words.

Each word has features: its letter trigrams with marks for its ends (so beginnings and endings are features),
and the word itself as a lexicon entry. Feature weights and transitions between the languages of neighbouring
words are learned together. Forward-backward gives every word a distribution over languages; a text is given
the language with the largest share of its words.

Learning takes a bounded sample: of each language ``SAMPLE`` whole documents, the first by hash of their ids.
As labels are per document, training sequences are spliced from pieces of documents of different languages,
so transitions are seen and labelled too. The features are hashed, so the model has ``2 ** FEATURE_BITS``
weights a language, whatever the corpus.

Plan: the sample is chosen on (id, lang) with a limit per language that Spark applies before its shuffle,
and only its texts are fetched. Prediction is one pass of ``mapInArrow``, no shuffle. Texts of a batch are cut
into blocks that go through forward-backward side by side, with exact messages between the blocks of a text,
so a very long text costs no more per word than others.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is everything when nothing
could be learned; a null id is not held out and not learned from; repeated rows are predicted alike; an empty
table gives no rows. Languages are a short list: the model grows with their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entity_events.llm.common import ALPHANUMERIC, Texts, Words, mix, small_batches, text_slices, words_of

UNKNOWN = "und"

SAMPLE = 300
FEATURE_BITS = 18
BLOCK = 32

#: Training: spliced sequences per step, their words, steps, and the words of a piece.
SEQUENCES, LENGTH, STEPS = 64, 64, 160
PIECES = (4, 40)
RATE, SHRINK = 0.3, 1e-6
SEED = 7


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


# Features


def _features(texts: Texts) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a slice, the feature of every letter in them, and where each word's letters begin."""
    data = texts.lower()
    words = words_of(texts, data, ALPHANUMERIC)
    if not len(words.hashes):
        return words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty_like(data), np.empty_like(data)
    before[1:], after[:-1] = data[:-1], data[1:]
    before[words.starts], after[words.ends - 1] = 0, 0
    lengths = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.repeat(words.starts - begins, lengths) + np.arange(int(lengths.sum()))
    code = (before[inside].astype(np.uint64) << np.uint64(16)) | (data[inside].astype(np.uint64) << np.uint64(8))
    code |= after[inside].astype(np.uint64)
    return words, _slot(mix(code)), begins


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


@dataclass
class Field:
    """The learned field: languages, weights of features, and scores of transitions."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Words, letters: np.ndarray, begins: np.ndarray) -> np.ndarray:
        scores = np.add.reduceat(self.weights[letters], begins, axis=0)
        return scores + self.weights[_slot(words.hashes)]

    def shares(self, texts: Texts) -> np.ndarray:
        """Per text the share of each language among its words; zeros where it has none."""
        words, letters, begins = _features(texts)
        total = np.zeros((len(texts), len(self.languages)))
        if len(words.hashes):
            marginals = _marginals(self.emissions(words, letters, begins), words.counts, self.transitions)
            some = np.flatnonzero(words.counts)
            first = np.concatenate([[0], np.cumsum(words.counts)[:-1]])[some]
            total[some] = np.add.reduceat(marginals, first, axis=0)
        return total / np.maximum(words.counts, 1)[:, None]


def _scaled(values: np.ndarray) -> np.ndarray:
    """Messages matter up to a factor; keep their largest entry at 1."""
    flat = values.reshape(len(values), -1)
    return values / flat.max(axis=1).reshape(-1, *[1] * (values.ndim - 1))


def _marginals(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Distribution over labels of every word, for texts of ``counts`` words that lie one after the other.

    Texts are cut into blocks of ``BLOCK`` words. The steps of a block multiply to one matrix; messages pass
    from block to block by these matrices, then all blocks are worked out side by side.
    """
    labels = scores.shape[1]
    emitted = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-9
    step = np.exp(transitions - transitions.max())
    counts = counts[counts > 0]
    blocks = -(-counts // BLOCK)
    first_word = np.concatenate([[0], np.cumsum(counts)[:-1]])
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    inner = np.arange(int(blocks.sum())) - np.repeat(first_block, blocks)
    start = np.repeat(first_word, blocks) + inner * BLOCK
    size = np.minimum(BLOCK, np.repeat(first_word + counts, blocks) - start)

    # Words by (place in block, block); blocks in order of falling size, so that the live ones come first.
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(BLOCK)]
    product = np.broadcast_to(np.eye(labels), (len(size), labels, labels)).copy()
    for t in range(BLOCK):
        if not (n := live[t]):
            break
        product[:n] = _scaled((product[:n] @ step) * emitted[start[:n] + t][:, None, :])

    # Messages into each block from the left and from the right, over the blocks of all texts in step.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_length = np.argsort(-blocks, kind="stable")
    falling = blocks[by_length]
    from_left = np.ones((len(size), labels))
    from_right = np.ones((len(size), labels))
    for k in range(1, int(falling[0])):
        n = int(np.searchsorted(-falling, -k, "left"))
        here = place[first_block[by_length[:n]] + k]
        past = place[first_block[by_length[:n]] + k - 1]
        from_left[here] = _scaled(np.einsum("bi,bij->bj", from_left[past], product[past]))
    for k in range(int(falling[0]) - 2, -1, -1):
        n = int(np.searchsorted(-falling, -(k + 1), "left"))
        here = place[first_block[by_length[:n]] + k]
        later = place[first_block[by_length[:n]] + k + 1]
        from_right[here] = _scaled(np.einsum("bij,bj->bi", product[later], from_right[later]))

    forward = np.empty_like(emitted)
    message = from_left
    for t in range(BLOCK):
        if not (n := live[t]):
            break
        message = _scaled((message[:n] @ step) * emitted[start[:n] + t])
        forward[start[:n] + t] = message
    message = from_right.copy()
    for t in range(BLOCK - 1, -1, -1):
        if not (n := live[t]):
            continue
        at = start[:n] + t
        seen = message[:n]
        forward[at] *= seen
        message[:n] = _scaled((seen * emitted[at]) @ step.T)
    return forward / forward.sum(axis=1, keepdims=True)


# Learning


def learn(texts: list[str], languages: list[str]) -> Field:
    """Fit weights and transitions by maximum likelihood on spliced sequences (adaptive gradient steps)."""
    names = sorted(set(languages))
    rng = np.random.default_rng(SEED)
    labels = len(names)
    weights = np.zeros((1 << FEATURE_BITS, labels))
    transitions = np.zeros((labels, labels))
    pools = []
    for name in names:
        column = pa.array([text for text, language in zip(texts, languages) if language == name], pa.string())
        parts = [_features(each) for each in text_slices(column)]
        hashes = np.concatenate([_slot(words.hashes) for words, _, _ in parts])
        letters = np.concatenate([found for _, found, _ in parts])
        lengths = np.concatenate([words.ends - words.starts for words, _, _ in parts])
        pools.append((hashes, letters, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)))
    filled = [i for i, pool in enumerate(pools) if len(pool[0])]
    if not filled:
        return Field([], weights[:, :0], transitions[:0, :0])

    squares, step_squares = np.full_like(weights, 1e-8), np.full_like(transitions, 1e-8)
    counts = np.full(SEQUENCES, LENGTH)
    for _ in range(STEPS):
        features, owner, truth = _spliced(pools, filled, rng)
        n = len(truth)
        scores = np.stack([np.bincount(owner, weights[features, j], n) for j in range(labels)], axis=1)
        marginals = _marginals(scores, counts, transitions)
        pairs = _pair_marginals(scores, marginals, transitions)
        error = marginals.copy()
        error[np.arange(n), truth] -= 1
        touched, at = np.unique(features, return_inverse=True)
        gradient = np.stack([np.bincount(at, error[owner, j], len(touched)) for j in range(labels)], axis=1)
        gradient = gradient / SEQUENCES + SHRINK * weights[touched]
        squares[touched] += gradient**2
        weights[touched] -= RATE * gradient / np.sqrt(squares[touched])
        rows = truth.reshape(SEQUENCES, LENGTH)
        seen = np.zeros((labels, labels))
        np.add.at(seen, (rows[:, :-1].ravel(), rows[:, 1:].ravel()), 1)
        change = (pairs - seen) / SEQUENCES
        step_squares += change**2
        transitions -= RATE * change / np.sqrt(step_squares)
    return Field(names, weights.astype(np.float32), transitions)


def _spliced(pools: list, filled: list[int], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words of spliced sequences, the word of each feature, and the label of each word."""
    features, owner, truth = [], [], []
    word = 0
    for _ in range(SEQUENCES):
        left = LENGTH
        while left:
            label = int(rng.choice(filled))
            hashes, letters, ends = pools[label]
            size = min(left, int(rng.integers(*PIECES)), len(hashes))
            start = int(rng.integers(0, len(hashes) - size + 1))
            found = letters[ends[start] : ends[start + size]]
            lengths = np.diff(ends[start : start + size + 1])
            features += [found, hashes[start : start + size]]
            owner += [np.repeat(np.arange(word, word + size), lengths), np.arange(word, word + size)]
            truth.append(np.full(size, label))
            word += size
            left -= size
    return np.concatenate(features), np.concatenate(owner), np.concatenate(truth)


def _pair_marginals(scores: np.ndarray, marginals: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected number of each transition inside the spliced sequences.

    From the marginals alone: a forward pass gives the distribution of the word before, given what comes up to
    it, and each backward step splits a word's marginal among the labels before it.
    """
    labels = scores.shape[1]
    emitted = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(SEQUENCES, LENGTH, labels)
    step = np.exp(transitions - transitions.max())
    given = marginals.reshape(SEQUENCES, LENGTH, labels)
    message = np.ones((SEQUENCES, labels))
    total = np.zeros((labels, labels))
    for t in range(LENGTH):
        reached = message[:, :, None] * step[None]
        if t:
            arrived = reached / reached.sum(axis=1, keepdims=True)
            total += (arrived * given[:, t][:, None, :]).sum(axis=0)
        message = _scaled(reached.sum(axis=1) * emitted[:, t])
    return total


def training_sample(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> DataFrame:
    """``text`` and ``lang`` of at most ``sample`` documents of each language, whole."""
    known = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("doc_id", "lang").withColumn("turn", turn).where(F.col("turn") <= sample)
    # Bounded: ``sample`` ids a language.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang")).distinct())
    same = (F.col("doc_id") == F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang"))
    return known.join(chosen, same, "left_semi").select("text", "lang")


def predicted(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document (doc_id, text, lang).

    ``learnable`` tells the documents whose ``lang`` may be learned from.
    """
    small_batches(docs.sparkSession)
    rows = sorted(tuple(row) for row in training_sample(docs, learnable, sample).collect())
    field = learn([text for text, _ in rows], [language for _, language in rows])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*field.languages, UNKNOWN], object)
        for batch in batches:
            best = np.full(batch.num_rows, len(field.languages))
            score = np.zeros(batch.num_rows)
            if field.languages:
                for texts in text_slices(batch.column("text")):
                    shares = field.shares(texts)
                    part = slice(texts.first, texts.first + len(texts))
                    best[part], score[part] = shares.argmax(axis=1), shares.max(axis=1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            best[~letters], score[~letters] = len(field.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(np.clip(score, 0.0, 1.0))],
                ["doc_id", "lang_pred", "score"],
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", letters).mapInArrow(scored, f"doc_id {kind}, lang_pred string, score double")
