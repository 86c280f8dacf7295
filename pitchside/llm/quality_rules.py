"""Operator 12: quality rules combined by weak supervision (DataFrame functions only).

Rules look at one text each and vote good (1), bad (-1) or abstain (0).  No rule decides by itself:
how often each is right on good and on bad documents is estimated from how the rules agree,
without labels, and a document is kept if its posterior probability of being good reaches one half.

The model.  Given the kind of a document, the rules vote independently; a rule that votes is
right with an accuracy of its own, and abstaining says nothing.  Expectation-maximisation alternates
the posterior of every vote pattern with the expected share of right votes.  The belief that a rule is
mostly right weighs as much as its votes do, at any number of documents: this names the two kinds,
and one group of faulty texts cannot make the rules for other faults worthless.

Plan.  Votes are a projection.  Documents are counted by vote pattern (with a combine before the
shuffle); there are at most 3 ** rules patterns whatever the input, and only this table is
read again in the rounds.  The fitted accuracies are a few dozen numbers, put into one more projection.

Repeated windows are found inside the row: packed numbers of hash and start are sorted, neighbours of
one hash are compared word by word, and, should two different windows share a hash, the words
themselves are sorted.

Defined cases: a null text has no words; a text without words fails the base and all rules
abstain but the one on its length; repeated rows and rows without an id are judged each by its
text; an empty table gives an empty result, and its model is the prior.  Columns whose names the
result makes are replaced, all others are carried, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import materialize

#: Fixed characters: ASCII blanks, symbols counted by the base.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: How often a rule is believed to be right.  The belief weighs as much as the votes of the rule itself.
BELIEF = 0.9
SHARE = 0.8  # of good documents, before the first round
ROUNDS = 50
TOLERANCE = 1e-5
EDGE = 1e-4  # accuracies and shares stay this far from 0 and 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body or its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def _covered(places: Column, width: int) -> Column:
    """Number of places covered by windows that start at the given places."""
    def count(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.when(k == F.size(p) - 1, width).otherwise(F.least(F.lit(width), F.get(p, k + 1) - x)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)

    return let(F.array_sort(F.array_distinct(places)), count)


def _repeated_places(words: Column, width: int) -> Column:
    """Starts of the windows that occur twice, found by sorting the windows' words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.struct(
        F.concat_ws(" ", F.slice(words, i + 1, width)).alias("key"), i.cast("long").alias("i")))

    def marked(s: Column) -> Column:
        return F.filter(F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["key"] == x["key"]) | (F.get(s, k + 1)["key"] == x["key"]), x["i"])), lambda i: i.isNotNull())

    return let(F.array_sort(pairs), marked)


PLACE_BITS = 24  # a packed window: hash above, start below


def with_repeat_words(df: DataFrame, words: str = "_words", name: str = "n_repeat_words", width: int = WINDOW) -> DataFrame:
    """Add the number of words inside windows of ``width`` words that occur at least twice.

    Windows are packed as numbers (hash, start) and sorted as such; neighbours of one hash are compared word by word,
    and where two differ (or a text has more words than a start has bits) the windows' words are sorted."""
    w, s, low = F.col(words), F.col("_sorted"), (1 << PLACE_BITS) - 1
    enough = (F.size(w) > width) & (F.size(w) <= low)
    packed = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: (
        F.xxhash64(*[F.get(w, i + k) for k in range(width)]).bitwiseAND(~low)).bitwiseOR(i.cast("long")))
    high = lambda k: F.shiftright(F.get(s, k), PLACE_BITS)
    place = lambda k: F.get(s, k).bitwiseAND(low)           # noqa: E731
    slice_at = lambda i: F.slice(w, i.cast("int") + 1, width)
    equal = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda k: high(k) == high(k + 1))
    clash = F.exists(F.col("_equal"), lambda k: slice_at(place(k)) != slice_at(place(k + 1)))
    places = F.flatten(F.transform(F.col("_equal"), lambda k: F.array(place(k), place(k + 1))))
    none = F.lit(0).cast("long")
    return (df.withColumn("_packed", F.when(enough, packed))
            .withColumn("_sorted", F.sort_array("_packed"))
            .withColumn("_equal", F.when(F.size(s) > 1, equal))
            .withColumn(name, F.when(F.size(w) <= width, none)
                        .when((F.size(w) > low) | clash, _covered(_repeated_places(w, width), width))
                        .when(F.size("_equal") > 0, _covered(places, width)).otherwise(none))
            .drop("_packed", "_sorted", "_equal"))


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def with_measures(docs: DataFrame) -> DataFrame:
    """``_text``, ``_words`` and the measures that the base and the rules read.

    ``_odd`` is what is left of the words without small letters: a short text, so that capitals, symbols
    and sentence ends are counted without reading the whole text again."""
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = with_repeat_words(docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
                            .withColumn("_words", words_of(F.col("_text"))))
    out = (out.withColumn("_lines", lines)
           .withColumn("_tight", F.array_join("_words", ""))
           .withColumn("_odd", F.regexp_replace("_tight", r"\p{Ll}+", ""))
           .withColumns({"n_words": F.size("_words").cast("long"), "word_chars": F.length("_tight").cast("long"),
                         "n_symbols": (F.length("_odd") - F.length(_without(F.col("_odd"), SYMBOLS))).cast("long"),
                         "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")}))
    return out.withColumns({
        "_n_lines": F.size("_lines").cast("long"),
        "_n_small": F.col("word_chars") - F.length("_odd"),
        "_n_other": F.length(F.regexp_replace("_odd", r"\p{L}+", "")),
        "_n_ends": F.length("_odd") - F.length(_without(F.col("_odd"), ".!?")),
        "_n_short": F.size(F.filter("_words", lambda w: F.length(w) <= 3)),
    }).withColumn("_n_letters", F.col("word_chars") - F.col("_n_other"))


@dataclass(frozen=True)
class Rule:
    """Votes bad beyond ``bad`` and, if it has ``good``, good inside it; else it abstains.

    Most rules know one defect: that it is absent says nothing, so they have no ``good``."""

    name: str
    value: Column
    bad: tuple[float, float]
    good: tuple[float, float] | None = None

    def vote(self) -> Column:
        vote = F.when((self.value < self.bad[0]) | (self.value > self.bad[1]), -1)
        if self.good:
            vote = vote.when(self.value.between(*self.good), 1)
        return F.coalesce(vote, F.lit(0)).cast("int")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.nullif(F.col(whole), F.lit(0))


def rules() -> list[Rule]:
    """The rules, on shares that mean the same for short and long texts.  A share of nothing abstains."""
    far = float("inf")
    marks = (F.col("_n_other") - F.col("_n_ends")) / F.nullif(F.col("n_words"), F.lit(0))
    return [
        Rule("length", F.col("n_words").cast("double"), (10, far)),
        Rule("word_length", _share("word_chars", "n_words"), (2.5, 12.0)),
        Rule("symbols", _share("n_symbols", "n_words"), (0, 0.10)),
        Rule("repeated_lines", _share("n_dup_lines", "_n_lines"), (0, 0.30)),
        Rule("repeated_windows", _share("n_repeat_words", "n_words"), (0, 0.20)),
        Rule("letters", _share("_n_letters", "word_chars"), (0.88, 1.0)),
        Rule("capitals", 1 - _share("_n_small", "_n_letters"), (0, 0.50)),
        Rule("sentence_ends", _share("_n_ends", "n_words"), (0.005, 0.50)),
        Rule("short_words", _share("_n_short", "n_words"), (0.05, 0.90), good=(0.15, 0.47)),
        Rule("marks", marks, (0, 0.30)),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def add_votes(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed`` and one ``vote_<rule>`` a rule."""
    return with_measures(docs).withColumns({"base_failed": base_failed()} | {f"vote_{r.name}": r.vote() for r in rules()})


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and for each rule how often it is right when it votes."""

    share: float
    accuracy: dict[str, float]
    rounds: int = 0

    def log_odds(self) -> Column:
        """Log odds of good against bad, from the vote columns: one table of addends, read by rule and vote."""
        addends = []
        for right in self.accuracy.values():
            odds = math.log(right / (1 - right))
            addends += [-odds, 0.0, odds]
        addends[:3] = [x + math.log(self.share / (1 - self.share)) for x in addends[:3]]
        # looked up by a column, so that the plan of every round is the same and compiled once
        votes = [F.get(F.lit(addends), F.col(f"vote_{name}") + (3 * k + 1)) for k, name in enumerate(self.accuracy)]
        return reduce(lambda a, b: a + b, votes)

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def _inside(x: float) -> float:
    return min(max(x, EDGE), 1 - EDGE)


def fit(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over the counted vote patterns of all documents."""
    votes = [f"vote_{n}" for n in names]
    patterns = materialize(voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions(*votes), "vote_patterns")
    model = VoteModel(SHARE, {n: BELIEF for n in names})
    for step in range(1, rounds + 1):
        good, bad = F.col("n") * F.col("good"), F.col("n") * (1 - F.col("good"))
        sums = [F.sum(good).alias("good"), F.sum("n").alias("all")]
        for n in names:
            vote = F.col(f"vote_{n}")
            sums += [F.sum(F.when(vote == 1, good).when(vote == -1, bad)).alias(f"right_{n}"), F.sum(F.when(vote != 0, F.col("n"))).alias(f"voted_{n}")]
        r = {k: v or 0.0 for k, v in patterns.withColumn("good", model.posterior()).agg(*sums).first().asDict().items()}
        if not r["all"]:
            return model
        accuracy = {n: _inside((r[f"right_{n}"] / r[f"voted_{n}"] + BELIEF) / 2) if r[f"voted_{n}"] else BELIEF for n in names}
        found = VoteModel(_inside(r["good"] / r["all"]), accuracy, step)
        moved = max(abs(a - b) for a, b in zip([found.share, *accuracy.values()], [model.share, *model.accuracy.values()]))
        model = found
        if moved < TOLERANCE:
            break
    return model


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judge(docs: DataFrame, columns: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The named columns of ``docs`` (default: all) with the measures, the votes, ``posterior`` (of being good) and ``kept``.

    Measures and votes are computed once and written with the columns that are carried."""
    names = [r.name for r in rules()]
    made = [*MEASURES, *[f"vote_{n}" for n in names]]
    carried = [c for c in (columns or docs.columns) if c not in {*made, "posterior", "kept"}]
    row = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.struct(F.lit(0).alias("none"))
    voted = materialize(add_votes(docs.select(row.alias("_row"), "text")).select("_row", *made), "quality_votes")
    model = fit(voted, names)
    return (voted.withColumn("posterior", model.posterior())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
            .select(*[F.col("_row").getField(c).alias(c) for c in carried], *made, "posterior", "kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all")
    return judge(docs.select(row, "text"), ["_all"], threshold).where("kept").select("_all.*")
