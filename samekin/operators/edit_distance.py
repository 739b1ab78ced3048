"""Pairs of similar names by segments, without comparing all names with each other.

A similarity threshold bounds the number k of edits that a name of m letters may be away from a longer
one. Cut into k + 1 segments, one of them is left whole by any k edits, and it stands in the longer name
not farther from its own place than the insertions and deletions before and behind it allow. So the
segments of the shorter name are joined with those parts of the longer one, by length and number of the
segment, and what meets is verified by the edit distance itself.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.functions.similarity import name_similarity
from samekin.operators.matching import split_crowded
from samekin.operators.pairs import TILE_ROWS

SEGMENT = ["_length", "_number", "_segment"]
# Names of equal length with at most so many edits and letters are covered by keys.
COVERED_EDITS = 2
COVERED_LETTERS = 24


def always_similar(threshold: float) -> bool:
    """Whether the threshold lets all names pass, whatever they are."""
    return threshold <= 0.0


def _loss(threshold: float) -> float:
    """The largest share of the longer name's letters that edits may take. Similarities are rounded to
    two decimals before they are compared."""
    return 1.0 - math.ceil(threshold * 100 - 1e-9) / 100 + 0.005 + 1e-9


def most_edits(shorter: Column, threshold: float) -> Column:
    """The most edits between a name of so many letters and any longer one that is similar to it."""
    loss = _loss(threshold)
    return F.floor(shorter * F.lit(loss / (1.0 - loss))).cast("int")


def _edits_between(length: int, threshold: float) -> int:
    """The most edits that leave two names of this length similar, rounded as similarities are."""
    edits = 0
    while edits < length:
        similarity = Decimal(repr(1.0 - (edits + 1) / length)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        if float(similarity) < threshold:
            break
        edits += 1
    return edits


def covered_lengths(threshold: float) -> dict[int, int]:
    """The lengths whose names :func:`cover_keys` is for, with the edits between two of them."""
    edits = {length: _edits_between(length, threshold) for length in range(1, COVERED_LETTERS + 1)}
    return {length: most for length, most in edits.items() if most <= COVERED_EDITS}


def cover_keys(
    name: Column, prefix: Column, suffix: Column, lengths: dict[int, int], few: bool = False
) -> Column:
    """Keys of a name, such that two different names of one of the ``lengths`` are similar if and only if
    they share a key. All names begin with the same ``prefix`` letters and end with the same ``suffix``.
    With ``few``, only some of the keys, linear in the letters, which leave out every letter once.

    Names with two edits differ by two letters, or by one that is deleted and one that is inserted. So a
    key is the name without the letters at two places, or without a letter wherever it was. A single edit
    is a letter at one place. What all names have in common stays out of it: it changes no distance.
    """
    length = F.length(name)
    core = F.substring(name, prefix + 1, length - prefix - suffix)
    letters = F.length(core)
    edits = F.coalesce(*[F.when(length == n, F.lit(most)) for n, most in lengths.items()], F.lit(0))
    none = F.array().cast("array<string>")

    def without(text: Column, place: Column) -> Column:
        return F.concat(F.substring(text, F.lit(1), place - 1), F.substring(text, place + 1, F.length(text)))

    def key(kind: Column, rest: Column) -> Column:
        return F.concat_ws(":", length.cast("string"), kind, rest)

    def pairs_with(second: Column) -> Column:
        shorter = without(core, second)
        return F.transform(
            F.sequence(F.lit(1), second - 1),
            lambda first: key(F.concat_ws(",", first.cast("string"), second.cast("string")), without(shorter, first)),
        )

    places = F.sequence(F.lit(1), letters)
    one = F.transform(places, lambda place: key(place.cast("string"), without(core, place)))
    if few:
        # Two letters side by side; the last two overlap those before where the letters are odd in number.
        seconds = F.sequence(F.least(F.lit(2), letters), letters, F.lit(2))
        ends = F.array_distinct(F.concat(seconds, F.array(letters)))
        beside = F.transform(
            ends,
            lambda second: key(
                F.concat_ws(",", (second - 1).cast("string"), second.cast("string")),
                without(without(core, second), second - 1),
            ),
        )
        return (
            F.when((edits == 0) | (letters < 1), none).when((edits == 1) | (letters < 2), one).otherwise(beside)
        )
    two = F.flatten(F.transform(F.sequence(F.lit(2), letters), pairs_with))
    moved = F.array_distinct(F.transform(places, lambda place: key(F.lit("-"), without(core, place))))
    return (
        F.when((edits == 0) | (letters < 1), none)
        .when((edits == 1) | (letters < 2), one)
        .otherwise(F.concat(two, moved))
    )


def _cut(length: Column, edits: Column, number: Column) -> tuple[Column, Column]:
    """Where a segment of a name of this length begins, from 0, and its size; the last ones are longer
    by a letter if the length does not divide."""
    parts = edits + 1
    size = F.floor(length / parts).cast("int")
    short = parts - F.pmod(length, parts)
    return number * size + F.greatest(F.lit(0), number - short), size + (number >= short).cast("int")


def _places(begin: Column, edits: Column, longer_by: Column) -> Column:
    """Where in the longer name a whole segment may begin: those before it shift it, and those behind
    have to make up for the rest of the difference in length."""
    back = F.floor((edits - longer_by) / 2).cast("int")
    ahead = F.floor((edits + longer_by) / 2).cast("int")
    return F.sequence(F.greatest(begin - back, F.lit(0)), begin + ahead)


def _segments(name: Column, threshold: float) -> Column:
    """What a name offers as the shorter one. A name with fewer letters than segments offers the empty
    segment, which every longer name of a fitting length has."""
    length = F.length(name)
    edits = most_edits(length, threshold)

    def segment(number: Column) -> Column:
        begin, size = _cut(length, edits, number)
        return F.struct(
            length.alias("length"), number.alias("number"), F.substring(name, begin + 1, size).alias("segment")
        )

    whole = F.array(F.struct(length.alias("length"), F.lit(0).alias("number"), F.lit("").alias("segment")))
    return F.when(edits >= length, whole).otherwise(F.transform(F.sequence(F.lit(0), edits), segment))


def _sought(name: Column, threshold: float, covered: list[int]) -> Column:
    """What a name looks for as the longer one; not for names of its own length if that is covered."""
    length = F.length(name)
    least = F.ceil(length * F.lit(1.0 - _loss(threshold))).cast("int")

    def of_length(shorter: Column) -> Column:
        edits = most_edits(shorter, threshold)

        def of_segment(number: Column) -> Column:
            begin, size = _cut(shorter, edits, number)
            return F.transform(
                _places(begin, edits, length - shorter),
                lambda at: F.struct(
                    shorter.alias("length"), number.alias("number"), F.substring(name, at + 1, size).alias("segment")
                ),
            )

        whole = F.array(
            F.struct(shorter.alias("length"), F.lit(0).alias("number"), F.lit("").alias("segment"))
        )
        cut = F.flatten(F.transform(F.sequence(F.lit(0), edits), of_segment))
        return F.when(edits >= shorter, whole).otherwise(cut)

    lengths = F.filter(
        F.sequence(F.least(least, length), length),
        lambda shorter: (length - shorter <= most_edits(shorter, threshold))
        & ((shorter < length) | ~length.isin(covered)),
    )
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def _first_shared(shorter: Column, longer: Column, number: Column, threshold: float) -> Column:
    """Whether no earlier segment is shared, so that a pair comes up once."""
    length = F.length(shorter)
    edits = most_edits(length, threshold)

    def shared(earlier: Column) -> Column:
        begin, size = _cut(length, edits, earlier)
        segment = F.substring(shorter, begin + 1, size)
        places = _places(begin, edits, F.length(longer) - length)
        return F.exists(places, lambda at: F.substring(longer, at + 1, size) == segment)

    earlier = F.sequence(F.lit(0), F.greatest(number - 1, F.lit(0)))
    return (number == 0) | ~F.exists(earlier, shared)


def similar_names(
    shorter: DataFrame,
    longer: DataFrame,
    equal: list[str],
    name: str,
    threshold: float,
    id_column: str = "txId",
    tile_rows: int | None = TILE_ROWS,
    covered: list[int] | None = None,
) -> DataFrame:
    """Rows ``l`` of ``shorter`` and ``r`` of ``longer`` with equal ``equal`` columns and similar but
    different names, where ``l`` has the shorter name, or the smaller one of two equally long names. Each
    such pair of rows comes up once. Names are taken as they are; a missing one is similar to nothing.

    Joining a table with itself thus gives each unordered pair once. Segments that many names share are
    split on both sides into tiles of ``tile_rows``. The threshold has to keep some names apart. Pairs of
    names of one length are left out if it is ``covered``.
    """
    if always_similar(threshold):
        raise ValueError(f"all names pass a threshold of {threshold}")

    def keyed(rows: DataFrame, keys: Column) -> DataFrame:
        named = rows.where(F.col(name).isNotNull()).withColumn("_key", F.explode(keys))
        fields = zip(SEGMENT, ("length", "number", "segment"))
        return named.withColumns({c: F.col(f"_key.{f}") for c, f in fields}).drop("_key")

    left = keyed(shorter, _segments(F.col(name), threshold))
    right = keyed(longer, _sought(F.col(name), threshold, covered or []))
    join = [*equal, *SEGMENT]
    if tile_rows is not None:
        left, right = split_crowded(left, right, join, tile_rows, id_column)
    on = F.lit(True)
    for column in join:
        on &= F.col(f"l.{column}") == F.col(f"r.{column}")
    l_name, r_name = F.col(f"l.{name}"), F.col(f"r.{name}")
    on &= (F.length(l_name) < F.length(r_name)) | (l_name < r_name)
    on &= name_similarity(l_name, r_name) >= F.lit(threshold)
    on &= _first_shared(l_name, r_name, F.col("l._number"), threshold)
    return left.alias("l").join(right.alias("r"), on)
