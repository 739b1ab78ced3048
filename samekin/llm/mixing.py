"""Mixing sources to target weights with soft membership.

A classifier learnt from the labels table gives every document posterior probabilities of the
domains, from its style and from the words that tell a domain from the others. Document rates, how
often each document is to be seen, are the nonnegative least-squares solution of: expected tokens of each domain = its target. The gradient is distributed: each step
sums the expected tokens over all documents, and only those few sums come to the driver.

All of it is DataFrame expressions and aggregations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.rules import OTHER_SPACE, SYMBOLS, bound, without
from samekin.llm.store import written

# Domains by the two labels (quality, toxic), and the share of the tokens each is to have.
DOMAINS = {"good": (1, 0), "poor": (0, 0), "toxic": (None, 1)}
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
# Tokens of the mixture for each token of the corpus.
EPOCHS = 1.0
STEPS = 30
# Relative distance of every domain from its target at which the steps end.
CLOSE = 1e-4
# The steps end, too, when none moves a domain's tokens by more than this share.
STILL = 5e-4
# The least share of all tokens that a domain must have to be mixed.
REACHABLE = 1e-6
# Variances are at least this, so that a feature that never varies in a class stays finite.
LEAST_VARIANCE = 1e-3
# The variances of all labelled documents count as those of so many in each class.
POOLED_ROWS = 4.0
# Labelled documents of a domain, at most about, in which words are counted.
WORD_ROWS = 3_000
# Leading letters of a word that make a feature besides the word, and the most letters that count.
STEMS = (3, 4, 5)
WORD_CHARS = 24
# Features used: at most so many, those most tied to a domain, by at least this log likelihood ratio
# (twice it is a chi-square), and so many times as frequent there as in the others. Words that are
# just frequent would only tell how long a text is.
VOCABULARY = 2_048
BUCKETS = 256
LEAST_TIE = 12.0
LEAST_LIFT = 4.0


# What style counts besides words, and how many of them a text has to one word.
MARKS = {"symbols": SYMBOLS, "shouts": "!", "stops": ".,"}
CAPITALS = "A-Z"


def dissected(docs: DataFrame, text: Column, kept: Column) -> DataFrame:
    """``_kept`` (any column of ``docs``) and what the features are made of: ``_words``, ``_distinct``
    ones, ``_letters`` (characters but white space) and ``_marks`` (the capitals and marks in order).
    A text is gone through once for its words and once for its marks."""
    marks = F.regexp_replace("_text", f"[^{CAPITALS}{''.join(MARKS.values())}]+", "")
    spaced = docs.select(kept.alias("_kept"), text.alias("_text")).select(
        "_kept", marks.alias("_marks"), without(F.col("_text"), OTHER_SPACE, " ").alias("_spaced")
    )
    return spaced.select(
        "_kept",
        "_marks",
        F.array_remove(F.split("_spaced", " "), "").alias("_words"),
        F.length(without(F.col("_spaced"), " ")).alias("_letters"),
    ).withColumn("_distinct", F.array_distinct("_words"))


def style() -> dict[str, Column]:
    """Numbers that describe a text, from the columns of :func:`dissected`; roots and logarithms bring them
    near a normal distribution."""
    n = F.greatest(F.size("_words"), F.lit(1)).cast("double")
    letters = F.greatest(F.col("_letters"), F.lit(1)).cast("double")
    marks = F.col("_marks")

    def share(characters: str) -> Column:
        return F.sqrt((F.length(marks) - F.length(without(marks, characters))) / n)

    # Distinct words fall with the length by a power law; the exponent does not.
    distinct = F.greatest(F.size("_distinct"), F.lit(1)).cast("double")
    capitals = F.length(without(marks, "".join(MARKS.values())))
    return {
        "length": F.log1p(n),
        "word_length": F.log(letters / n),
        "variety": F.log(distinct) / F.log(n + 1),
        **{name: share(characters) for name, characters in MARKS.items()},
        "capitals": F.sqrt(capitals / letters),
    }


FEATURES = ("length", "word_length", "variety", "symbols", "shouts", "stops", "capitals")


def known_domains(labels: DataFrame, id_column: str) -> DataFrame:
    """``_id``, ``_domain`` (its number) and ``_quality`` of the labels that fit a domain."""
    quality, toxic = F.col("quality"), F.col("toxic")
    domain = F.lit(None).cast("int")
    for i, (q, t) in reversed(list(enumerate(DOMAINS.values()))):
        fits = (toxic == t) & (F.lit(True) if q is None else quality == q)
        domain = F.when(fits, i).otherwise(domain)
    known = labels.select(F.col(id_column).alias("_id"), domain.alias("_domain"), quality.alias("_quality"))
    return known.dropna(subset=["_id", "_domain"])


def told(words: Column) -> Column:
    """Hashes of the distinct ones of ``words``, lower case and letters only, and of their first
    letters."""
    letters = F.regexp_replace(F.lower(F.array_join(words, " ")), r"[^\p{L} ]+", "")
    cleaned = F.array_remove(F.array_distinct(F.split(letters, " ")), "")

    def hashed(found: Column, n: int) -> Column:
        # The number of letters tells a stem from a word.
        return F.transform(found, lambda w: F.xxhash64(F.substring(w, 1, n), F.lit(n)))

    return bound(cleaned, lambda found: F.concat(*[hashed(found, n) for n in (*STEMS, WORD_CHARS)]))


@dataclass(frozen=True)
class Words:
    """``names``: hashes of the features used; ``present``: for every domain what each of them adds
    to its log likelihood; ``none``: the log likelihoods of a text that has none of them."""

    names: list[int]
    present: list[list[float]]
    none: list[float]

    def likelihoods(self) -> Column:
        """An array of log likelihoods, one a domain, from the column ``_distinct``."""
        if not self.names:
            return F.array(*map(F.lit, self.none))
        # The names lie in buckets, so that a look-up reads a few of them.
        buckets = [name % BUCKETS for name in self.names]
        order = sorted(range(len(buckets)), key=lambda i: (buckets[i], i))
        names = F.lit(np.array([self.names[i] for i in order], np.int64))
        begins = F.lit(np.searchsorted([buckets[i] for i in order], np.arange(BUCKETS + 1)).astype(np.int32))
        values = [F.lit(np.array([v[i] for i in order])) for v in self.present]

        def place(name: Column) -> Column:
            bucket = F.pmod(name, F.lit(BUCKETS)).cast("int")
            begin, end = F.get(begins, bucket), F.get(begins, bucket + 1)
            within = F.array_position(F.slice(names, begin + 1, end - begin), name)
            return (begin + within - 1).cast("int")

        def summed(places: Column, none: float, table: Column) -> Column:
            return F.aggregate(places, F.lit(none), lambda s, at: s + F.get(table, at))

        return bound(
            F.transform(F.array_intersect(told(F.col("_distinct")), names), place),
            lambda places: F.array(*[summed(places, n, t) for n, t in zip(self.none, values)]),
        )


def train_words(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> Words:
    """Log odds of words and stems, from all labelled documents of a domain or about ``WORD_ROWS`` of
    them, chosen by a hash of the id. What is collected is the vocabulary."""
    known = known_domains(labels, id_column)
    sizes = {r["_domain"]: r["count"] for r in known.groupBy("_domain").count().collect()}
    place = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    for k, size in sizes.items():
        share = F.when(F.col("_domain") == k, WORD_ROWS / size).otherwise(share)
    few = F.broadcast(known.where(place < share).select("_id", "_domain"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(F.col(id_column).alias("_id"), text.alias("_text")).join(few, "_id")
    found = dissected(texts, F.col("_text"), F.col("_domain"))
    told_of = F.array_distinct(told(F.col("_distinct")))
    sample = written(found.select(F.col("_kept").alias("_domain"), told_of.alias("_told")), "words")
    of = range(len(DOMAINS))
    counted = sample.groupBy("_domain").count().collect()
    rows = [sum(r["count"] for r in counted if r["_domain"] == k) for k in of]
    total = sum(rows)
    if sum(n > 0 for n in rows) < 2:
        return Words([], [], [0.0] * len(DOMAINS))
    seen = (
        sample.select("_domain", F.explode("_told").alias("_name"))
        .groupBy("_name")
        .agg(F.count("*").alias("_all"), *[F.count_if(F.col("_domain") == k).alias(f"_c{k}") for k in of])
    )

    def tie(k: int) -> Column:
        """Of one rate for the domain and one for the others against one for both."""
        own, every = F.col(f"_c{k}"), F.col("_all")
        n, rest = rows[k], total - rows[k]
        if not n or not rest:
            return F.lit(0.0)
        ratio = F.lit(0.0)
        for size, has in ((n, own), (rest, every - own)):
            for found, among in ((has, every), (size - has, total - every)):
                one = found * F.log(found * total / (among * float(size)))
                ratio += F.when(found > 0, one).otherwise(0.0)
        lift = (own + 0.5) / (n + 1) >= LEAST_LIFT * (every - own + 0.5) / (rest + 1)
        return F.when(lift, ratio).otherwise(0.0)

    best = (
        seen.withColumn("_tie", F.greatest(*[tie(k) for k in of]))
        .where(F.col("_tie") >= LEAST_TIE / 2)
        .orderBy(F.desc("_tie"), "_name")
        .limit(VOCABULARY)
        .collect()
    )
    present, none = [[] for _ in of], [0.0] * len(DOMAINS)
    for r in best:
        for k in of:
            p = (r[f"_c{k}"] + 0.5 * r["_all"] / total + 0.05) / (rows[k] + 0.6)
            present[k].append(math.log(p / (1 - p)) if rows[k] else 0.0)
            none[k] += math.log(1 - p) if rows[k] else 0.0
    return Words([r["_name"] for r in best], present, none)


@dataclass(frozen=True)
class DomainModel:
    """Domains consist of parts, by the quality label, so that junk that is toxic is not held against
    a domain that is mostly prose. ``parts``: for each the number of its domain, the log of its share,
    and mean and variance of each style feature, which are normal densities."""

    parts: list[tuple[int, float, list[float], list[float]]]

    def posteriors(self) -> Column:
        """An array, in the order of ``DOMAINS``, from the features' columns. A domain without a
        labelled document has none; without any labels everything is of the first."""
        if not self.parts:
            return F.array(*[F.lit(float(k == 0)) for k in range(len(DOMAINS))])
        logs = []
        for domain, share, means, variances in self.parts:
            total = F.lit(share) + F.get("_likelihoods", F.lit(domain))
            for name, m, v in zip(FEATURES, means, variances):
                away = F.col(f"_{name}") - m
                total += -(away * away) / (2 * v) - 0.5 * math.log(v)
            logs.append(total)

        def shares(values: Column) -> Column:
            most = F.array_max(values)
            return bound(F.transform(values, lambda x: F.exp(x - most)), by_domain)

        def by_domain(powers: Column) -> Column:
            def summed(domains: list[int]) -> Column:
                return sum((F.get(powers, F.lit(i)) for i in domains), F.lit(0.0))

            total = summed(range(len(self.parts)))
            return F.array(
                *[
                    summed([i for i, part in enumerate(self.parts) if part[0] == k]) / total
                    for k in range(len(DOMAINS))
                ]
            )

        return bound(F.array(*logs), shares)


def described(docs: DataFrame, words: Words, kept: Column, text_column: str) -> DataFrame:
    """``_kept``, ``_tokens`` (words) and the features of each row's whole text."""
    first = dissected(docs, F.coalesce(F.col(text_column), F.lit("")), kept)
    return first.select(
        "_kept",
        F.size("_words").cast("long").alias("_tokens"),
        words.likelihoods().alias("_likelihoods"),
        *[number.alias(f"_{name}") for name, number in style().items()],
    )


def train_domains(table: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DomainModel:
    """Shares, means and variances over all labelled documents, in one aggregation."""
    sums = [F.mean(f"_{n}").alias(f"m_{n}") for n in FEATURES]
    sums += [F.var_pop(f"_{n}").alias(f"v_{n}") for n in FEATURES]
    rows = (
        table.join(known_domains(labels, id_column), F.col("_kept") == F.col("_id"))
        .groupBy("_domain", "_quality")
        .agg(F.count("*").alias("rows"), *sums)
        .orderBy("_domain", "_quality")
        .collect()
    )
    total = sum(r["rows"] for r in rows)
    pooled = {}
    for n in FEATURES:
        mean = sum(r["rows"] * r[f"m_{n}"] for r in rows) / max(1, total)
        pooled[n] = sum(r["rows"] * (r[f"v_{n}"] + (r[f"m_{n}"] - mean) ** 2) for r in rows) / max(1, total)
    parts = []
    for r in rows:
        weight = r["rows"] + POOLED_ROWS
        variances = [(r["rows"] * r[f"v_{n}"] + POOLED_ROWS * pooled[n]) / weight for n in FEATURES]
        parts.append(
            (
                r["_domain"],
                math.log(r["rows"] / total),
                [r[f"m_{n}"] for n in FEATURES],
                [max(LEAST_VARIANCE, v) for v in variances],
            )
        )
    return DomainModel(parts)


@dataclass(frozen=True)
class Rates:
    """The steps taken: for each, what every domain adds to the rate of a document that is wholly of
    it. ``totals``: the expected tokens of each domain at the end; ``wanted``: its target."""

    least: float
    steps: list[list[float]]
    totals: list[float]
    wanted: list[float]

    def rate(self) -> Column:
        """From the column ``_shares``, projected after each step."""
        rate = F.lit(1.0)
        for step in self.steps:
            moved = sum((F.get("_shares", F.lit(k)) * x for k, x in enumerate(step)), F.lit(0.0))
            rate = F.greatest(F.lit(self.least), rate + moved)
        return rate


def fit_rates(
    table: DataFrame, targets: dict[str, float], epochs: float | None = EPOCHS, least: float = 0.0
) -> Rates:
    """Projected gradient steps on the squared relative errors of the domains, each weighted by the
    domain's size, so that the step length is 1 whatever the sizes. ``table`` has ``_tokens`` and
    ``_shares``. A domain with next to no expected tokens cannot be reached: it is left out, and
    the other targets are scaled up. Without ``epochs`` there are as many as the domain needs that is
    largest for its target, so that no domain has to shrink: with a ``least`` of 1 all can be met."""

    def totals(rates: Rates) -> list[float]:
        weight = F.col("_tokens") * rates.rate()
        row = table.agg(
            *[F.sum(weight * F.get("_shares", F.lit(k))).alias(f"t{k}") for k in range(len(targets))]
        ).first()
        return [float(x or 0.0) for x in row]

    rates = Rates(least, [], [], [])
    sizes = now = totals(rates)
    there = [s > REACHABLE * sum(sizes) for s in sizes]
    shares = [w if t else 0.0 for w, t in zip(targets.values(), there)]
    wanted = [w / (sum(shares) or 1.0) * sum(sizes) for w in shares]
    if epochs is None:
        epochs = max((s / w for s, w in zip(sizes, wanted) if w), default=1.0)
    wanted = [w * epochs for w in wanted]
    for _ in range(STEPS):
        step = [(w - n) / s if t else 0.0 for w, n, s, t in zip(wanted, now, sizes, there)]
        if all(abs(x) * s <= CLOSE * w for x, s, w in zip(step, sizes, wanted)):
            break
        rates = Rates(least, [*rates.steps, step], now, wanted)
        before, now = now, totals(rates)
        # Held back by the least rate, say: nothing moves to speak of.
        if all(abs(n - b) <= STILL * s for n, b, s in zip(now, before, sizes)):
            break
    return Rates(least, rates.steps, now, wanted)


def copies(rate: Column, *keys: Column) -> Column:
    """A whole number with the rate as its mean, the same for the same document every time."""
    place = F.pmod(F.xxhash64(*keys, F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + place).cast("long")


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    epochs: float | None = EPOCHS,
    least: float = 0.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """For every row: ``tokens`` (words), ``p_<domain>``, ``rate`` and ``copies``.

    Null and empty texts have no tokens; they get a rate by their posteriors but weigh nothing.
    Labels with nulls or without a document are not used. Repeated rows each count and get the same
    rate. No rows give no rows. Other columns are not read. Rates are at least ``least``; where
    that keeps a target out of reach, the nearest mixture in the same sense is the result.
    """
    words = train_words(docs, labels, id_column, text_column)
    table = written(described(docs, words, F.col(id_column), text_column), "style")
    model = train_domains(table, labels, id_column)
    shared = written(table.select(F.col("_kept").alias("_id"), "_tokens", model.posteriors().alias("_shares")), "shares")
    rates = fit_rates(shared, targets, epochs, least)
    rated = shared.withColumn("rate", rates.rate())
    return rated.select(
        F.col("_id").alias(id_column),
        F.col("_tokens").alias("tokens"),
        *[F.get("_shares", F.lit(k)).alias(f"p_{name}") for k, name in enumerate(targets)],
        "rate",
        copies(F.col("rate"), F.col("_id")).alias("copies"),
    )


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    epochs: float | None = EPOCHS,
    least: float = 0.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with their columns. The rate is
    computed beside the row, not matched by id, so that rows with the same id are told apart."""
    words = train_words(docs, labels, id_column, text_column)
    table = written(described(docs, words, F.col(id_column), text_column), "style")
    model = train_domains(table, labels, id_column)
    shared = written(table.select("_tokens", model.posteriors().alias("_shares")), "shares")
    rates = fit_rates(shared, targets, epochs, least)
    # The row as a whole, so that none of its columns can be called like a feature.
    featured = described(docs, words, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), text_column)
    rated = featured.select("_kept", model.posteriors().alias("_shares"))
    row = [F.col(f"_kept.`{c}`") for c in docs.columns]
    times = copies(rates.rate(), F.col(f"_kept.`{id_column}`"), F.col(f"_kept.`{text_column}`"))
    # Without a filter on the number of copies: the optimizer would move it down to the scan and work
    # out posteriors and features anew for each time that the rate refers to them.
    each = F.when(times > 0, F.sequence(F.lit(1).cast("long"), times))
    return rated.select("_kept", F.explode_outer(each).alias("_copy")).where(F.col("_copy").isNotNull()).select(*row)
