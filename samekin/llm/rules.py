"""Quality rules combined by weak supervision.

Each rule votes for a document, against it, or abstains. Instead of asking for all rules to pass,
expectation-maximisation estimates from the votes alone how often each rule votes which way on good
and on bad documents, and the posterior probability of a document being good decides.

All of it is DataFrame expressions. The only rows that leave Spark are the counts of distinct vote
patterns, three to the power of the number of rules at most, taken over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.store import written

# White space besides the blank, symbols, words of a window, and the base limits.
OTHER_SPACE = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

CUT = 0.5
EM_ROUNDS = 200
# Where the estimate starts: each vote's probability given a bad and a good document, for rules
# that vote both ways and for rules that only know a defect.
START = {-1: (0.2, 0.02), 0: (0.3, 0.38), 1: (0.5, 0.6)}
START_DEFECT = {-1: (0.1, 0.001), 0: (0.898, 0.997), 1: (0.002, 0.002)}
# How much the start weighs against the votes. Rules that find different defects seldom vote on the
# same document, so votes alone would not tie them together.
PRIOR_SHARE = 0.5
PRIOR_GOOD = 0.8


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, characters: str, by: str = "") -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are no white space, in order."""
    return F.array_remove(F.split(without(text, OTHER_SPACE, " "), " "), "")


def _covered(windows: Column) -> Column:
    """How many words lie in a window whose hash occurs twice, from the windows' hashes in order:
    sort them with their places, keep those with an equal neighbour, add up the places they cover."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        def equal(x: Column, at: Column) -> Column:
            return F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))

        found = F.filter(s, lambda x, j: equal(x, j - 1) | equal(x, j + 1))
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words"))

    def add(so_far: Column, place: Column) -> Column:
        more = F.least(F.lit(WINDOW), place - so_far["last"])
        return F.struct(place.alias("last"), (so_far["words"] + more).alias("words"))

    return F.aggregate(bound(placed, twice), start, add, lambda end: end["words"])


def repeated_words(words: Column) -> Column:
    """Words in a window of five that is found at least twice, first ones included."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))
        )

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) > WINDOW, bound(bound(words, windows), counted)).otherwise(
        F.lit(0).cast("long")
    )


def measured(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The counts that base and rules look at, for each row's whole text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    first = docs.select(F.col(id_column), text.alias("_text"), words_of(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(without(line, OTHER_SPACE + " ")) > 0)

    def line_counts(kept: Column) -> Column:
        distinct = F.size(F.array_distinct(kept))
        return F.struct(F.size(kept).alias("n"), (F.size(kept) - distinct).alias("twice"))

    def characters(of: str) -> Column:
        return (F.length("_text") - F.length(without(F.col("_text"), of))).cast("long")

    return first.select(
        id_column,
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(F.col("_text"), OTHER_SPACE + " ")).cast("long").alias("word_chars"),
        characters(SYMBOLS).alias("n_symbols"),
        bound(lines, line_counts).alias("_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("_distinct"),
        F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long").alias("_capitals"),
        characters("!").alias("_shouts"),
        characters(".").alias("_stops"),
    ).select(
        id_column,
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("_lines.twice").cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("_lines.n").cast("long").alias("_n_lines"),
        "_distinct",
        "_capitals",
        "_shouts",
        "_stops",
    )


@dataclass(frozen=True)
class Rule:
    """Votes against a document where ``bad`` holds, for it where ``good`` does, else abstains."""

    name: str
    bad: Column
    good: Column | None = None

    def vote(self) -> Column:
        good = F.lit(False) if self.good is None else self.good
        return F.when(self.bad, -1).when(good, 1).otherwise(0).cast("int")

    def start(self) -> dict[int, tuple[float, float]]:
        return START_DEFECT if self.good is None else START


def default_rules() -> list[Rule]:
    # Of a text without words every share is 0.
    words = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / words
    symbols, shouts = F.col("n_symbols") / words, F.col("_shouts") / words
    twice = F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))
    repeats, distinct = F.col("n_repeat_words") / words, F.col("_distinct") / words
    capitals = F.col("_capitals") / F.greatest(F.col("word_chars"), F.lit(1))
    stops = F.col("_stops") / words
    return [
        # What speaks for a document as well as against it.
        Rule("length", words < LEAST_WORDS, words >= 60),
        Rule("word_length", (length < 2) | (length > 14), length.between(3.5, 9)),
        Rule("sentences", (stops == 0) & (words >= 60), stops.between(0.02, 0.3)),
        # Defects: without one there is nothing to say.
        Rule("symbols", symbols > 0.1),
        Rule("lines", twice > 0.3),
        Rule("repeats", repeats > 0.2),
        Rule("distinct", (distinct < 0.35) & words.between(40, 500)),
        Rule("capitals", capitals > 0.25),
        Rule("shouts", shouts > 0.1),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``prior`` of good, and for each rule the probability of each vote given bad and good."""

    prior: float
    given: list[dict[int, tuple[float, float]]]

    def log_odds(self, votes: list[Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, table in zip(votes, self.given):
            weights = {v: math.log(good / bad) for v, (bad, good) in table.items()}
            total += (
                F.when(vote == 1, weights[1]).when(vote == -1, weights[-1]).otherwise(weights[0])
            )
        return total

    def accuracy(self, rule: int) -> tuple[float, float]:
        """How often the rule, when it votes, is right about bad and about good documents."""
        table = self.given[rule]
        return (
            table[-1][0] / (table[-1][0] + table[1][0]),
            table[1][1] / (table[-1][1] + table[1][1]),
        )


def _shares(votes: dict[int, list[float]], least: float) -> dict[int, tuple[float, float]]:
    """Probabilities from counts. A vote against is at least ``least`` times as likely for a bad
    document, a vote for at least as likely for a good one; where the counts say otherwise, the
    probabilities nearest to that with the same total are taken."""
    sums = [sum(v[c] for v in votes.values()) for c in (0, 1)]
    against, for_it = ([votes[v][c] / sums[c] for c in (0, 1)] for v in (-1, 1))
    if against[0] < least * against[1]:
        low = sum(votes[-1]) / (least * sums[0] + sums[1])
        against = [min(0.9, least * low), low]
    if for_it[1] < for_it[0]:
        for_it = [sum(votes[1]) / sum(sums)] * 2
    silent = [max(1e-6, 1 - against[c] - for_it[c]) for c in (0, 1)]
    return {-1: tuple(against), 0: tuple(silent), 1: tuple(for_it)}


def estimate(patterns: dict[tuple[int, ...], int], starts: list[dict]) -> VoteModel:
    """Expectation-maximisation over counted vote patterns. It starts from rules that seldom vote
    against a good document, which settles which class is the good one, and keeps to two limits: no
    rule is worse than chance, and a rule that only knows a defect is at least as telling as at the
    start. Without any pattern the start is the result."""
    prior = PRIOR_GOOD
    given = list(starts)
    total = sum(patterns.values())
    for _ in range(EM_ROUNDS if total else 0):
        sums = [PRIOR_SHARE * total * (1 - PRIOR_GOOD), PRIOR_SHARE * total * PRIOR_GOOD]
        seen = [{v: [p * s for p, s in zip(start[v], sums)] for v in start} for start in starts]
        for votes, count in sorted(patterns.items()):
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(table[v][1] / table[v][0]) for v, table in zip(votes, given)
            )
            good = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            sums[0] += count * (1 - good)
            sums[1] += count * good
            for v, table in zip(votes, seen):
                table[v][0] += count * (1 - good)
                table[v][1] += count * good
        before, prior = prior, sums[1] / (sums[0] + sums[1])
        given = [
            _shares(table, start[-1][0] / start[-1][1] if start is START_DEFECT else 1.0)
            for table, start in zip(seen, starts)
        ]
        if abs(prior - before) < 1e-9:
            break
    return VoteModel(prior, given)


def weak_supervision(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    cut: float = CUT,
) -> DataFrame:
    """For every row: the five counts, ``base_failed``, ``posterior`` and ``kept``: whether the
    base did not fail and the posterior is ``cut`` at least.

    Null and empty texts have no words: all counts are 0 and the base fails. Repeated rows count as often as they occur. No rows give no rows. Other columns
    are not read. The counts are computed once, as a narrow table in the shared folder.
    """
    rules = default_rules() if rules is None else rules
    table = written(measured(docs, id_column, text_column), "counts")
    names = [f"_vote{i}" for i in range(len(rules))]
    voted = table.withColumns({n: r.vote() for n, r in zip(names, rules)})
    counted = voted.groupBy(*names).count().collect()
    model = estimate({tuple(r[:-1]): r["count"] for r in counted}, [rule.start() for rule in rules])
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    posterior = 1 / (1 + F.exp(-model.log_odds([F.col(n) for n in names])))
    return voted.select(
        id_column,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        posterior.alias("posterior"),
        (~base & (posterior >= cut)).alias("kept"),
    )
