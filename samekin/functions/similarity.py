"""Facts about a pair of transactions, as column expressions. No thresholds here."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# So near to half a hundredth, products by a hundred do not tell to which side a number rounds.
NEAR_HALF = 1e-6
# Rounding to two decimals adds so much at most.
HALF_HUNDREDTH = 0.005
# A sketch has 256 bits.
SKETCH_WORDS = ("a", "b", "c", "d")
EDIT_FLIPS = 4
MORE_EDITS = (1 << 31) - 1


def _hundredths(value: Column) -> Column:
    """``value`` to two decimals, by arithmetic, for numbers from 0 to 2 that are not near half a hundredth."""
    return F.floor(value * 100.0 + 0.5).cast("double") / F.lit(100.0)


def two_decimals(value: Column) -> Column:
    """``F.round(value, 2)``, which goes through decimals, taken only where arithmetic might differ."""
    rest = F.abs(value * 100.0 - F.floor(value * 100.0) - 0.5)
    plain = (value >= 0.0) & (value <= 2.0) & (rest > NEAR_HALF)
    return F.when(plain, _hundredths(value)).otherwise(F.round(value, 2))


def name_similarity(
    left: Column, right: Column, left_core: Column | None = None, right_core: Column | None = None
) -> Column:
    """1 - edit distance / longer length, to two decimals, of two normalized names.

    Equal names skip the edit distance. A missing name is similar to nothing. Cores are the names without
    letters that both begin or end with, which have the same distance.
    """
    cores = [left, right] if left_core is None else [left_core, right_core]
    return _name_similarity(left, right, F.levenshtein(*cores))


@F.arrow_udf(T.StructType([T.StructField(word, T.LongType()) for word in SKETCH_WORDS]))
def name_sketch(names: pa.Array) -> pa.Array:
    """The parity of a name's letter pairs, of the name between two spaces, in each of 256 places they
    fall into. An edit takes away two pairs and adds two at most, so it flips ``EDIT_FLIPS`` bits at most.
    Null for a missing name."""
    texts = ["" if name is None else name for name in names.to_pylist()]
    letters = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    pairs = letters[:-1].astype(np.uint64) * np.uint64(0x1FFFFF) + letters[1:]
    # Spread by a product with an odd number, and read off its upper bits.
    place = pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)
    bits = np.uint64(1) << (place & np.uint64(63))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(sizes) - sizes
    columns = []
    for word in range(len(SKETCH_WORDS)):
        own = np.where(place >> np.uint64(6) == word, bits, np.uint64(0))
        parity = np.bitwise_xor.reduceat(own, first) if len(texts) else own[:0]
        columns.append(pa.array(parity.view(np.int64)))
    return pa.StructArray.from_arrays(columns, list(SKETCH_WORDS), mask=names.is_null())


def name_similarity_from(
    least: float, left: Column, right: Column, left_sketch: Column, right_sketch: Column
) -> Column:
    """:func:`name_similarity` where it is ``least`` or more, and something smaller elsewhere. The edit
    distance is not computed if the sketches differ in more bits than the edits left for ``least`` could
    flip, and not beyond so many edits."""
    longer = F.greatest(F.length(left), F.length(right))
    edits = F.floor(longer * F.lit(1.0 + HALF_HUNDREDTH - least) + F.lit(NEAR_HALF)).cast("int")
    words = [F.bit_count(left_sketch[w].bitwiseXOR(right_sketch[w])) for w in SKETCH_WORDS]
    apart = F.coalesce(reduce(add, words) > edits * F.lit(EDIT_FLIPS), F.lit(False)) & (left != right)
    # -1 stands for more edits; as a number beyond all lengths it needs no second look.
    distance = F.pmod(F.call_function("levenshtein", left, right, edits), F.lit(MORE_EDITS))
    similarity = F.greatest(F.lit(0.0), _name_similarity(left, right, distance))
    return F.when(apart, F.lit(0.0)).otherwise(similarity)


def _name_similarity(left: Column, right: Column, distance: Column) -> Column:
    longer = F.greatest(F.length(left), F.length(right))
    ratio = 1.0 - F.try_divide(distance.cast("double"), longer.cast("double"))
    return (
        F.when(left.isNull() | right.isNull(), F.lit(0.0))
        .when(left == right, F.lit(1.0))
        # Half a hundredth takes a length that eight divides.
        .when(F.pmod(longer, F.lit(8)) != 0, _hundredths(ratio))
        .otherwise(F.round(ratio, 2))
    )


def equal_values(left: Column, right: Column) -> Column:
    """Equality that is false, not null, when a side is missing."""
    return F.coalesce(left == right, F.lit(False))


def amount_relative_difference(left: Column, right: Column) -> Column:
    """|a - b| over the mean magnitude, to two decimals; two zero amounts do not differ."""
    mean = (F.abs(left) + F.abs(right)) / 2.0
    difference = F.abs(left - right)
    return F.when(mean == 0.0, F.lit(0.0)).otherwise(two_decimals(F.try_divide(difference, mean)))


def time_distance(left: Column, right: Column) -> Column:
    return F.abs(left - right)
