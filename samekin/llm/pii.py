"""Personal data by candidate gradient boosting.

High-recall generators propose spans, which may overlap. Each candidate gets yes-or-no features of
its format and of the words before it. Boosted stumps score those that the strict base patterns leave
open; a threshold calibrated for precision decides what is redacted. The stumps are fitted to
candidates that the base refuses and to base matches rewritten without what the base requires: as
national numbers, spelt out, with other marks; and, as wrong ones, to lookalikes made of them.

All of it is DataFrame expressions. Features are binary, so fitting needs only the counts of
distinct feature patterns, two to the power of their number at most, over all candidates.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.rules import bound
from samekin.llm.store import set_aside

# The base patterns. Possessive loops match the same spans without backtracking, and
# an email or ip is only looked for where a run of its characters, or the text, or the search after
# a match begins: an earlier start always gives the longer match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
# What a text must have for the pattern to be tried.
NEEDS = {"email": "@", "phone": "+"}
KINDS = list(BASE)

# Generators of candidates: anything around an at sign, spelt-out emails, and groups of digits with or without marks.
WIDE = r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++"
SPELT = (
    r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+\x20?[(\[{]\x20?at\x20?[)\]}]\x20?[A-Z0-9-]{1,64}+"
    r"(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?[A-Z0-9-]{1,64}+|\.[A-Z0-9-]{1,64}+)++"
)
DIGITS = r"(?<![0-9A-Za-z])[(+]?[0-9](?:[\x20().-]{0,2}+[0-9])++"
BRACKETED = r"\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?"
BROKEN_IP = rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:{BRACKETED}[0-9]{{1,3}}){{3}}(?![0-9])"
# Words before a candidate that tell what it is.
CONTEXT = {
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|whatsapp)\b[^A-Za-z0-9]*+$",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|amex)\b[^A-Za-z0-9]*+$",
    "email": r"(?i)\b(?:email|mail|contact|write|reach)\b[^A-Za-z0-9]*+$",
}
CONTEXT_CHARS = 32
# How the name of a host ends.
ENDING = r"(?i)(?:\.|[(\[{]\x20?dot\x20?[)\]}]\x20?)(?:com|org|net|edu|gov|info|\p{L}{2})[^\p{L}0-9]*$"
# Of runs of digits that are no cards one in ten passes the check digit: for each nine that fail.
FAILED_FOR_ONE = 9.0

ROUNDS = 24
RATE = 0.5
# Redacted are candidates whose pattern, by the calibration, is right at least this often.
PRECISION = 0.98
# Counts added to both sides of a leaf or of a calibrated share.
SMOOTHING = 2.0
# A pattern of fewer cases does not lower the threshold.
LEAST_CASES = 20


SPAN = "struct<kind:string,start:int,end:int,match:string>"
# Spans are collected in blocks of this many, so that a text of very many is not copied for each.
BLOCK = 256


def _none(kind: str = SPAN) -> Column:
    return F.array().cast(f"array<{kind}>")


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as structs of kind, start, end (code points) and the match.
    The places follow from the lengths of the matches and of the gaps between them."""

    def placed(both: Column) -> Column:
        found, gaps = both["found"], both["gaps"]
        n = F.size(found)

        def add(so_far: Column, i: Column) -> Column:
            match = F.get(found, i)
            start = so_far["at"] + F.length(F.get(gaps, i))
            span = F.struct(
                F.lit(kind).alias("kind"),
                start.alias("start"),
                (start + F.length(match)).alias("end"),
                match.alias("match"),
            )
            return F.struct(
                (start + F.length(match)).alias("at"), F.array_append(so_far["spans"], span).alias("spans")
            )

        def add_block(so_far: Column, block: Column) -> Column:
            places = F.sequence(block * BLOCK, F.least(n, (block + 1) * BLOCK) - 1)
            begin = F.struct(so_far["at"].alias("at"), _none().alias("spans"))
            return bound(
                F.aggregate(places, begin, add),
                lambda end: F.struct(
                    end["at"].alias("at"), F.array_append(so_far["blocks"], end["spans"]).alias("blocks")
                ),
            )

        blocks = F.sequence(F.lit(0), F.ceil(n / BLOCK).cast("int") - 1)
        begin = F.struct(F.lit(0).alias("at"), _none(f"array<{SPAN}>").alias("blocks"))
        return F.when(n == 0, _none()).otherwise(
            F.aggregate(blocks, begin, add_block, lambda end: F.flatten(end["blocks"]))
        )

    return bound(
        F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
            F.split(text, pattern, -1).alias("gaps"),
        ),
        placed,
    )


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The check digit of payment cards, for a string of digits."""

    def value(digit: Column, i: Column) -> Column:
        number = digit.cast("int")
        twice = F.when(number > 4, 2 * number - 9).otherwise(2 * number)
        return F.when(i % 2 == 1, twice).otherwise(number)

    values = F.transform(F.split(F.reverse(digits), ""), value)
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "ip":
        def small(part: Column) -> Column:
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        length = F.length(_digits(match))
        return F.when(length.between(12, 19), passes_luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _tried(text: Column, needs: Column, spans: Column) -> Column:
    return F.when(needs, spans).otherwise(_none())


def _valid_only(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["match"]))


def base_spans(text: Column) -> Column:
    """The valid spans of the base patterns, by start and then by kind as listed."""
    has_digit = F.regexp_like(text, F.lit("[0-9]"))
    found = []
    for kind, pattern in BASE.items():
        needs = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else has_digit
        found.append(_tried(text, needs, _valid_only(_spans(text, pattern, kind), kind)))
    return ordered(F.concat(*found))


def ordered(spans: Column) -> Column:
    """By start, then by kind as listed, then by end."""
    listed = F.array(*[F.lit(k) for k in KINDS])

    def key(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.array_position(listed, s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            s["match"].alias("match"),
        )

    def back(s: Column) -> Column:
        return F.struct(*[s[n].alias(n) for n in ("kind", "start", "end", "match")])

    return F.transform(F.array_sort(F.transform(spans, key)), back)


def candidates(text: Column) -> Column:
    """Spans of the generators: wide patterns, each for the kind it may be. They overlap."""
    found = []
    for kind, pattern, needs in (
        ("email", WIDE, F.contains(text, F.lit("@"))),
        ("email", SPELT, F.regexp_like(text, F.lit(r"(?i)[(\[{] ?at ?[)\]}]"))),
        ("phone", DIGITS, F.regexp_like(text, F.lit(r"[0-9][ ().0-9-]{5}"))),
        ("ip", BROKEN_IP, F.regexp_like(text, F.lit(rf"(?i)[0-9]{BRACKETED}[0-9]"))),
    ):
        found.append(_tried(text, needs, _spans(text, pattern, kind)))
    wide, spelt, digits, broken = found
    as_card = F.transform(
        digits,
        lambda s: F.struct(F.lit("card").alias("kind"), *[s[n].alias(n) for n in ("start", "end", "match")]),
    )
    return F.concat(wide, spelt, digits, as_card, broken)


@dataclass(frozen=True)
class Feature:
    name: str
    test: Callable[[Column, Column], Column]


def candidate_features() -> list[Feature]:
    """Tests of a span's match and of the text before it. None repeats the checks that settle the
    labels: no check digit and no exact count of digits."""

    def count(match: Column) -> Column:
        return F.length(_digits(match))

    return [
        Feature("bracket", lambda m, b: F.contains(m, F.lit("("))),
        Feature("blank", lambda m, b: F.contains(m, F.lit(" "))),
        Feature("hyphen", lambda m, b: F.contains(m, F.lit("-"))),
        Feature("dot", lambda m, b: F.contains(m, F.lit("."))),
        Feature("spelt", lambda m, b: F.regexp_like(m, F.lit(r"(?i)[(\[{] ?at ?[)\]}]"))),
        Feature("grouped", lambda m, b: F.regexp_like(m, F.lit(r"(?<![0-9])[0-9]{3}[) .-]{1,2}[0-9]{3}[ .-][0-9]{4}$"))),
        Feature("fours", lambda m, b: F.regexp_like(m, F.lit(r"^[0-9]{4}([ .-]{1,2}[0-9]{4}){2}"))),
        Feature("ending", lambda m, b: F.regexp_like(m, F.lit(ENDING))),
        Feature("single", lambda m, b: ~F.regexp_like(m, F.lit("[0-9][0-9]"))),
        Feature("short", lambda m, b: count(m) < 9),
        Feature("long", lambda m, b: count(m) >= 12),
        Feature("very_long", lambda m, b: count(m) > 16),
        Feature("said_phone", lambda m, b: F.regexp_like(b, F.lit(CONTEXT["phone"]))),
        Feature("said_card", lambda m, b: F.regexp_like(b, F.lit(CONTEXT["card"]))),
        Feature("said_email", lambda m, b: F.regexp_like(b, F.lit(CONTEXT["email"]))),
    ]


@dataclass(frozen=True)
class Boosted:
    """Stumps ``(feature, weight if absent, weight if present)``, a start, and the least score that
    is redacted (infinite: none)."""

    start: float
    stumps: list[tuple[int, float, float]]
    threshold: float

    def score(self, bits: list[Column]) -> Column:
        total = F.lit(self.start)
        for feature, absent, present in self.stumps:
            total += F.when(bits[feature], present).otherwise(absent)
        return total


def boost(counts: dict[tuple[bool, ...], tuple[float, float]], features: int) -> Boosted:
    """Gradient boosting of the log loss with Newton leaves, over feature patterns with their
    numbers of wrong and right candidates. The threshold is the lowest score at which the
    smoothed share of right ones among all candidates that reach it is at least ``PRECISION``,
    above any pattern that is right less often by itself. Without right ones it is infinite."""
    right = sum(c[1] for c in counts.values())
    wrong = sum(c[0] for c in counts.values())
    start = math.log((right + SMOOTHING) / (wrong + SMOOTHING))
    scores = {bits: start for bits in counts}
    stumps = []
    for _ in range(ROUNDS):
        best = None
        for f in range(features):
            sums = [[0.0, SMOOTHING / 4], [0.0, SMOOTHING / 4]]
            for bits, (no, yes) in counts.items():
                p = 1 / (1 + math.exp(-scores[bits]))
                sums[bits[f]][0] += yes - (no + yes) * p
                sums[bits[f]][1] += (no + yes) * p * (1 - p)
            gain = sum(g * g / h for g, h in sums)
            if best is None or gain > best[0] + 1e-12:
                best = gain, f, *(RATE * max(-4.0, min(4.0, g / h)) for g, h in sums)
        if best is None or best[0] < 1e-6:
            break
        stumps.append(best[1:])
        for bits in scores:
            scores[bits] += best[3] if bits[best[1]] else best[2]
    threshold, no, yes = math.inf, 0.0, 0.0
    for bits in sorted(counts, key=lambda b: -scores[b]):
        if counts[bits][1] < PRECISION * sum(counts[bits]):
            break
        no, yes = no + counts[bits][0], yes + counts[bits][1]
        if yes / (no + yes + SMOOTHING) >= PRECISION and sum(counts[bits]) >= LEAST_CASES:
            threshold = scores[bits] - 1e-9
    return Boosted(start, stumps, threshold)


_SPAN = ("kind", "start", "end", "match")


def _overlaps(s: Column, other: Column) -> Column:
    return (s["start"] < other["end"]) & (other["start"] < s["end"])


def _described(text: Column, base: Column, found: Column) -> Column:
    """Candidates with their features and, where the base settles it, their label: 1 for one that
    overlaps a base span of its kind, 0 for one that overlaps only others or fails its kind's check."""
    features = candidate_features()

    def described(both: Column) -> Column:
        def one(s: Column) -> Column:
            begin = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
            before = F.substring(text, begin + 1, s["start"] - begin)
            same = F.exists(both["base"], lambda b: (b["kind"] == s["kind"]) & _overlaps(b, s))
            other = F.exists(both["base"], lambda b: _overlaps(b, s))
            return F.struct(
                *[s[n].alias(n) for n in _SPAN],
                F.when(same, 1).when(other | _refused(s), 0).alias("label"),
                *[f.test(F.ltrim(s["match"], F.lit("+")), before).alias(f.name) for f in features],
            )

        return F.transform(both["candidates"], one)

    both = F.struct(base.alias("base"), found.alias("candidates"))
    return F.when(F.size(found) > 0, bound(both, described))


def _rewritten(s: Column) -> Column:
    """A base match as it might stand without what the base requires, and lookalikes of it: an array
    of structs of match and label."""
    match = s["match"]

    def made(*forms: tuple[Column, int]) -> Column:
        return F.array(*[F.struct(m.alias("match"), F.lit(right).alias("label")) for m, right in forms])

    def by(pattern: str, put: str, of: Column = match) -> Column:
        return F.regexp_replace(of, pattern, put)

    at, dot = " (at) ", " (dot) "
    national = by(r"^\+[0-9]{1,3}(?=[^0-9])[ .-]*", "")
    national = by(r"^\+", "", national)
    host = by("^.*@", "")
    first = by(r"\..*$", "", host)
    email = made(
        (match, 1),
        (F.concat(by("@.*$", ""), F.lit(at), F.replace(host, F.lit("."), F.lit(dot))), 1),
        (F.concat(by("@.*$", ""), F.lit("[at]"), host), 1),
        # A handle, a name without an ending, and two sentences around a word in brackets.
        (F.concat(by("@.*$", ""), F.lit("@"), first), 0),
        (F.concat(by("@.*$", ""), F.lit("@"), first, F.lit(".5")), 0),
        (F.concat(by("@.*$", ""), F.lit(at), first, F.lit(".Then")), 0),
    )
    bare = F.translate(national, "()", "")
    digits = _digits(national)
    phone = made(
        (national, 1),
        (bare, 1),
        (F.translate(bare, " ", "-"), 1),
        # A plain number, a date with an hour, and a number of a book.
        (digits, 0),
        (by("^(.{4})(.{2})(.{2})(.*)$", "$1-$2-$3 $4", digits), 0),
        (by("^(.)(.{2})(.*)(.)$", "$1-$2-$3-$4", digits), 0),
        (by("^(.{3})(.{3})(.*)$", "$1.$2.$3", F.substring(digits, 1, 9)), 0),
    )
    fours = F.regexp_replace(_digits(match), "(.{4})(?=.)", "$1.")
    card = made((fours, 1), (F.replace(fours, F.lit("."), F.lit("  ")), 1), (by("^(.{4})(.*)(.)$", "$1.$2.$3", _digits(match)), 0))
    single = by("[0-9]*([0-9])", "$1")
    ip = made(
        (F.replace(match, F.lit("."), F.lit("[.]")), 1),
        (F.replace(match, F.lit("."), F.lit(dot)), 1),
        # Numbers of sections.
        (F.replace(single, F.lit("."), F.lit("[.]")), 0),
        (F.replace(single, F.lit("."), F.lit(dot)), 0),
    )
    of = {"email": email, "phone": phone, "card": card, "ip": ip}
    every = of["email"]
    for kind in KINDS[1:]:
        every = F.when(s["kind"] == kind, of[kind]).otherwise(every)
    return every


def _lessons(text: Column, base: Column, found: Column) -> Column:
    """What the models learn from: candidates with label 0, and base matches rewritten."""
    features = candidate_features()

    def lessons(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, begin + 1, s["start"] - begin)
        return F.transform(
            _rewritten(s),
            lambda made: F.struct(
                s["kind"].alias("kind"),
                made["label"].alias("label"),
                *[f.test(made["match"], before).alias(f.name) for f in features],
            ),
        )

    def plain(s: Column) -> Column:
        return F.struct(*[s[n].alias(n) for n in ("kind", "label", *[f.name for f in features])])

    described = _described(text, base, found)
    nothing = F.filter(described, lambda s: F.lit(False))
    refused = F.filter(F.coalesce(described, nothing), lambda s: s["label"] == 0)
    return F.concat(F.flatten(F.transform(base, lessons)), F.transform(refused, plain))


def train_pii(docs: DataFrame, text_column: str = "text") -> dict[str, Boosted]:
    """A model for each kind of candidate, from the refused candidates and the base matches of all
    rows. What is collected are counts of feature patterns. Kinds without a base match add nothing."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    names = [f.name for f in candidate_features()]
    found = docs.select(
        text.alias("_text"), base_spans(text).alias("_base"), candidates(text).alias("_found")
    ).where((F.size("_found") > 0) | (F.size("_base") > 0))
    one = F.explode(_lessons(F.col("_text"), F.col("_base"), F.col("_found")))
    counted = (
        found.select(one.alias("_one"))
        .groupBy("_one.kind", "_one.label", *[f"_one.{n}" for n in names])
        .count()
        .collect()
    )
    models = {}
    for kind in sorted({r[0] for r in counted}):
        counts: dict[tuple, list[float]] = {}
        for row in counted:
            if row[0] == kind:
                counts.setdefault(tuple(map(bool, row[2:-1])), [0.0, 0.0])[row[1]] += (
                    row["count"] / (FAILED_FOR_ONE if kind == "card" and row[1] == 0 else 1.0)
                )
        models[kind] = boost(dict(sorted(counts.items())), len(names))
    return models


def personal_spans(
    docs: DataFrame, models: dict[str, Boosted], text_column: str = "text"
) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of spans (kind, start, end in code points, match).

    Base spans always stay. A candidate is added if the base neither overlaps nor refuses it and
    its kind's model scores it at the calibrated threshold or above. Null and empty texts have no
    spans, repeated rows are treated alike, no rows give no rows. Columns of ``docs`` called
    ``base`` or ``added`` are replaced.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    names = [f.name for f in candidate_features()]
    plain = docs.drop("base", "added")
    found = plain.withColumns({"base": base_spans(text), "_candidates": candidates(text)})
    marked = found.withColumn("_one", _described(text, F.col("base"), F.col("_candidates")))

    def stays(s: Column) -> Column:
        passes = F.lit(False)
        for kind, model in models.items():
            if model.threshold < math.inf:
                high = model.score([s[n] for n in names]) >= model.threshold
                passes = F.when(s["kind"] == kind, high).otherwise(passes)
        return s["label"].isNull() & passes

    chosen = F.transform(
        F.filter("_one", stays), lambda s: F.struct(*[s[n].alias(n) for n in _SPAN])
    )
    added = F.coalesce(F.array_distinct(chosen), _none())
    return marked.select(*plain.columns, "base", added.alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by the first one's kind in brackets."""

    def add(so_far: Column, s: Column) -> Column:
        apart = s["start"] >= so_far["at"]
        gap = F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        more = F.when(apart, F.concat(so_far["parts"], F.array(gap, mark))).otherwise(so_far["parts"])
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), more.alias("parts"))

    def end(so_far: Column) -> Column:
        rest = F.substring(text, so_far["at"] + 1, F.length(text) - so_far["at"])
        return F.concat(F.array_join(so_far["parts"], ""), rest)

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.when(F.size(spans) > 0, F.aggregate(ordered(spans), begin, add, end)).otherwise(text)


def without_personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with all spans, base and added, redacted in the text. A null text stays null, an empty
    one empty; repeated rows stay repeated; no rows give no rows. Other columns may have any name."""
    aside, back = set_aside(docs, {"base", "added", "_one", "_candidates"})
    text = next((new for new, old in back.items() if old == text_column), text_column)
    marked = personal_spans(aside, train_pii(aside, text), text)
    spans = F.concat("base", "added")
    found = marked.withColumn(text, redacted(F.col(text), spans)).select(*aside.columns)
    return found.withColumnsRenamed(back)


def _refused(s: Column) -> Column:
    """A run of digits that looks like its kind and fails the check of it."""
    digits = _digits(s["match"])
    card = (s["kind"] == "card") & F.length(digits).between(12, 19) & ~passes_luhn(digits)
    odd = (s["kind"] == "card") & ~F.length(digits).between(12, 19)
    phone = (s["kind"] == "phone") & ~F.length(digits).between(9, 15)
    ip = (s["kind"] == "ip") & ~valid("ip", F.regexp_replace(s["match"], "[^0-9]+", "."))
    return F.coalesce(card | odd | ip, F.lit(False)) | phone
