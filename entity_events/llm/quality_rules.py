"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one measure of a text and votes good, bad, or not at all. How often a rule is right about good
and about bad texts is not given: expectation-maximisation estimates it, and the share of good texts, from how the
votes of all documents agree. A document's quality is the posterior probability that it is good, given its votes;
a rule that abstains says nothing. Built-in functions only.

Plan: one pass measures every text and writes the measures (with the columns to carry) once. The votes of
``R`` rules are one number below ``3 ** R``, so a partial aggregate leaves at most that many rows, 19,683 for the
nine rules, whatever the corpus. They become one row, on which the estimation runs as one expression, and the
posteriors of the vote patterns are a join side with the same bound on its rows. Documents are never shuffled.

Repeats inside a text are found by sorting its three-word windows, so the time is that of a sort of the text.

Defined results: a null text has no words; a text without words has zeros and fails the base rules; equal rows are
judged one by one and alike; null ids and other columns pass through inside ``row``, whatever their names; an empty
table gives no rows. With a single vote pattern the posterior follows the starting values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity_events.llm.common import WORD, written

#: Words below which, and percentage of repeated words above which, a text is never kept.
FEWEST_WORDS = 50
MOST_REPEATED = 50

#: Rounds of expectation-maximisation, and the posterior from which a document is kept.
ROUNDS = 30
LIMIT = 0.5

#: Where the estimation starts: share of good texts, and how often a rule that votes is right about good and about
#: bad ones. Rules are written to leave good texts alone and each to see one kind of bad ones.
START = (0.8, 0.995, 0.3)

_SIGNS = "[#*$%&|<>]"
_SPACES = " \t\n\x0b\x0c\r"
_BAD, _ABSTAIN, _GOOD = 0, 1, 2


@dataclass(frozen=True)
class Rule:
    """A measure of a text; ``bad`` and ``good`` are conditions on it, where neither holds the rule abstains."""

    name: str
    measure: Callable[[Column], Column]
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]

    def vote(self, measures: Column) -> Column:
        value = self.measure(measures)
        chosen = F.when(self.bad(value), _BAD).when(self.good(value), _GOOD)
        return chosen.otherwise(_ABSTAIN)


def _share(count: str, of: str = "n_words") -> Callable[[Column], Column]:
    """A count over another; null, on which rules abstain, where there is nothing to divide by."""
    return lambda m: F.when(m[of] > 0, m[count] / m[of])


def _low_is_good(name: str, count: str, good: float, bad: float, of: str = "n_words") -> Rule:
    return Rule(name, _share(count, of), lambda v: v > bad, lambda v: v < good)


RULES: tuple[Rule, ...] = (
    Rule("length", lambda m: m["n_words"], lambda v: v < FEWEST_WORDS, lambda v: v.between(100, 100_000)),
    Rule("word_length", _share("word_chars"), lambda v: (v < 2) | (v > 15), lambda v: v.between(3, 10)),
    _low_is_good("signs", "n_symbols", 0.02, 0.1),
    _low_is_good("lines", "n_dup_lines", 0.1, 0.6, of="n_lines"),
    _low_is_good("repeats", "n_repeat_words", 0.2, 0.4),
    _low_is_good("capitals", "n_capitals", 0.1, 0.4),
    _low_is_good("marks", "n_marks", 0.02, 0.1),
    _low_is_good("separators", "n_separators", 0.02, 0.1),
    _low_is_good("endings", "n_endings", 0.05, 0.2),
)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Number of words inside three-word windows that the list has twice or more."""

    def window(i: Column) -> Column:
        gram = F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return F.struct(gram.alias("gram"), i.alias("at"))

    def repeated(ordered: Column) -> Column:
        def same(a: Column, place: Column) -> Column:
            return a["gram"] == F.get(ordered, place)["gram"]

        starts = F.filter(ordered, lambda a, k: F.coalesce(same(a, k - 1), F.lit(False)) | F.coalesce(same(a, k + 1), F.lit(False)))
        places = F.transform(starts, lambda a: F.array(a["at"], a["at"] + 1, a["at"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))
    return F.when(F.size(words) >= 3, _with(windows, repeated)).otherwise(0)


def measures(text: Column) -> Column:
    """All measures of a text as one struct of longs.

    Besides those of the base rules: ``n_lines`` (lines with a word), ``n_capitals`` (runs of two or more capital
    letters), ``n_marks`` (runs of two or more end marks), ``n_separators`` (words without a letter or digit),
    ``n_endings`` (words that end in a sign other than usual punctuation).
    """

    def of_words(words: Column, whole: Column) -> Column:
        lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD))
        ending = r"""[^\x20\x09-\x0D\p{L}\p{N}.,;:!?'")\]](?![^\x20\x09-\x0D])"""
        apart = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}\p{N}]+(?![^\x20\x09-\x0D])"
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.translate(whole, _SPACES, "")),
            "n_symbols": F.regexp_count(whole, F.lit(_SIGNS)),
            "n_dup_lines": _with(lines, lambda each: F.size(each) - F.size(F.array_distinct(each))),
            "n_repeat_words": _repeat_words(words),
            "n_lines": F.size(lines),
            "n_capitals": F.regexp_count(whole, F.lit(r"\p{Lu}{2,}")),
            "n_marks": F.regexp_count(whole, F.lit("[.!?]{2,}")),
            "n_separators": F.regexp_count(whole, F.lit(apart)),
            "n_endings": F.regexp_count(whole, F.lit(ending)),
        }
        return F.struct(*(count.cast("long").alias(name) for name, count in counts.items()))

    whole = F.coalesce(text, F.lit(""))
    return _with(whole, lambda t: _with(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda words: of_words(words, t)))


def pattern(measured: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The votes of all rules as one number, a digit to base three for each rule."""
    total = F.lit(0)
    for place, rule in enumerate(rules):
        total = total + rule.vote(measured) * F.lit(3**place)
    return total.cast("int")


def _digit(pattern: Column, place: int) -> Column:
    return F.pmod(F.floor(pattern / F.lit(3**place)), F.lit(3)).cast("int")


def _posterior(votes: Column, model: Column, rules: int) -> Column:
    """Probability of a good text given its votes: a struct (share, on_good, on_bad) is the model."""
    odds = F.log(model["share"]) - F.log(1 - model["share"])
    for place in range(rules):
        right, caught = model["on_good"][place], model["on_bad"][place]
        vote = votes[place]
        said_good = F.log(right) - F.log(1 - caught)
        said_bad = F.log(1 - right) - F.log(caught)
        odds = odds + F.when(vote == _GOOD, said_good).when(vote == _BAD, said_bad).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def _fitted(seen: Column, rules: int, rounds: int) -> Column:
    """The model that expectation-maximisation reaches on an array of (votes, n)."""
    share, on_good, on_bad = START
    doubles = lambda values: F.array(*(F.lit(float(value)) for value in values))
    start = F.struct(
        F.lit(share).alias("share"), doubles([on_good] * rules).alias("on_good"), doubles([on_bad] * rules).alias("on_bad")
    )

    def total(rows: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda so_far, row: so_far + value(row))

    def estimated(rows: Column) -> Column:
        """Shares of weighted votes; one vote of each kind is added, so that none is certain."""
        good, bad = [], []
        for place in range(rules):
            said = lambda row, vote, place=place: F.when(row["votes"][place] == vote, 1.0).otherwise(0.0)
            right = total(rows, lambda row: row["good"] * said(row, _GOOD))
            missed = total(rows, lambda row: row["good"] * said(row, _BAD))
            caught = total(rows, lambda row: row["bad"] * said(row, _BAD))
            let = total(rows, lambda row: row["bad"] * said(row, _GOOD))
            good.append((right + 1) / (right + missed + 2))
            # A rule is never taken to be worse than none: it must not vote bad on good texts more than on bad ones.
            bad.append((caught + 1) / (caught + let + 2))
        n_good, n_bad = total(rows, lambda row: row["good"]), total(rows, lambda row: row["bad"])
        kept = [F.greatest(b, 1 - g) for g, b in zip(good, bad)]
        return F.struct(
            ((n_good + 1) / (n_good + n_bad + 2)).alias("share"), F.array(*good).alias("on_good"), F.array(*kept).alias("on_bad")
        )

    def round_of(model: Column, _: Column) -> Column:
        def weighed(row: Column) -> Column:
            return _with(
                _posterior(row["votes"], model, rules),
                lambda p: F.struct(row["votes"].alias("votes"), (row["n"] * p).alias("good"), (row["n"] * (1 - p)).alias("bad")),
            )

        return _with(F.transform(seen, weighed), estimated)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, round_of)


def pattern_qualities(measured: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, quality) of every vote pattern in ``measured``, which has a column ``pattern``."""
    n = len(rules)
    counted = measured.groupBy("pattern").agg(F.count(F.lit(1)).cast("double").alias("n"))
    votes = F.array(*(_digit(F.col("pattern"), place) for place in range(n)))
    rows = counted.agg(F.sort_array(F.collect_list(F.struct("pattern", votes.alias("votes"), "n"))).alias("seen"))
    rows = rows.withColumn("model", _fitted(F.col("seen"), n, rounds))
    each = rows.select("model", F.explode("seen").alias("one"))
    return each.select("one.pattern", _posterior(F.col("one.votes"), F.col("model"), n).alias("quality"))


def assessed(docs: DataFrame, carry: Sequence[str] | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every document as ``row`` (its columns, or those to ``carry``) with its measures, ``votes``, ``quality`` and ``kept``.

    ``base_failed`` holds for texts of too few words or too many repeated ones; they are not kept either.
    """
    names = docs.columns if carry is None else carry
    row = F.struct(*(F.col(f"`{name}`") for name in names)).alias("row")
    found = docs.select(row, measures(F.col("text")).alias("measured"))
    found = written(found.withColumn("pattern", pattern(F.col("measured"), rules)), "quality-measures")
    qualities = F.broadcast(pattern_qualities(found, rules))  # at most 3 ** rules rows
    words, repeated = F.col("measured.n_words"), F.col("measured.n_repeat_words")
    failed = (words < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED * words)
    votes = F.struct(*((_digit(F.col("pattern"), i) - 1).alias(rule.name) for i, rule in enumerate(rules)))
    return found.join(qualities, "pattern").select(
        "row",
        "measured.*",
        votes.alias("votes"),
        "quality",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= LIMIT)).alias("kept"),
    )


def good_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that are kept, with their columns."""
    return assessed(docs, rules=rules).where("kept").select("row.*")
