"""Counting pairs that are close in time and amount, without meeting them.

Blocks are cut into cells of time and log amount. A row sits in its own cell and is offered to the cells
from which it can be reached: those of the same time with smaller amounts, and those of the time before.
Every pair is thus counted from one of its rows, in that row's cell. There, sorted amounts turn the
amounts within tolerance into a range of places; all rows of the same time cell are close in time, and
how many of a range of later rows are early enough tells an order-statistic array, bit by bit of their
times. The work grows with the rows times the logarithm of a cell's rows, whatever they hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samekin.operators.matching import (
    CELL_WIDTH,
    amount_sign,
    floor_div,
    largest_passing_difference,
    log_amount,
    log_ratio,
)
from samekin.plans.policy import DecisionPolicy

# Rows counted at once; a larger cell is still taken whole.
ROWS_TOGETHER = 1 << 17
# A row seeks from its own cell, is offered there from a cell of higher amounts, or from a later one.
OWN, HIGHER, LATER = 0, 1, 2


def close_below(passing: float) -> float:
    """Differences round to ``passing`` or less exactly if they are less than this. Rounding is half up,
    on the shortest decimal that stands for a number."""
    return float(f"{passing + 0.005:.3f}")


def is_close(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Whether amounts of equal sign, given by their sizes, are close: the same arithmetic as in the
    facts of a pair."""
    mean = (a + b) / 2.0
    difference = np.abs(a - b)
    return np.where(mean == 0.0, True, np.divide(difference, mean, where=mean != 0.0, out=np.ones_like(mean)) < bound)


def count_at_most(
    ranks: np.ndarray, weights: np.ndarray, low: np.ndarray, high: np.ndarray, limit: np.ndarray
) -> np.ndarray:
    """For each query the sum of ``weights`` at the places from ``low`` up to ``high`` whose rank is
    below ``limit``. The array is cut in two by one bit of the ranks after the other, highest first, and
    a query follows the half its limit lies in."""
    total = np.zeros(len(low), np.int64)
    if not len(ranks) or not len(low):
        return total
    bits = int(max(ranks.max(), limit.max())).bit_length()
    for bit in reversed(range(bits)):
        zero = (ranks >> bit & 1) == 0
        before = np.concatenate(([0], np.cumsum(zero)))
        weighed = np.concatenate(([0], np.cumsum(np.where(zero, weights, 0))))
        up = (limit >> bit & 1) == 1
        total += np.where(up, weighed[high] - weighed[low], 0)
        low, high = (np.where(up, before[-1] + at - before[at], before[at]) for at in (low, high))
        order = np.concatenate((np.flatnonzero(zero), np.flatnonzero(~zero)))
        ranks, weights = ranks[order], weights[order]
    return total


class _Places:
    """Rows sorted by cell and amount, to find amounts in."""

    def __init__(self, cell: np.ndarray, size: np.ndarray) -> None:
        self.cell, self.size = cell, size
        self.values = np.unique(size)
        rank = np.searchsorted(self.values, size)
        self.keys = cell * (len(self.values) + 1) + rank

    def first_from(self, cell: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first place of each cell with at least this size."""
        return np.searchsorted(self.keys, cell * (len(self.values) + 1) + np.searchsorted(self.values, size))

    def settle(self, place: np.ndarray, cell: np.ndarray, size: np.ndarray, bound: float, top: bool) -> np.ndarray:
        """Move places found by a rounded limit to where closeness really ends: the first place behind
        the close ones (``top``), or the first close one."""
        place = place.copy()
        while True:
            for step in (-1, 1):
                at = place - 1 if step < 0 else place
                inside = (at >= 0) & (at < len(self.cell))
                at = np.where(inside, at, 0)
                inside &= self.cell[at] == cell if len(self.cell) else False
                close = inside & is_close(self.size[at], size, bound) if len(self.cell) else inside
                above = self.size[at] >= size if len(self.cell) else inside
                # Above the seeker close rows belong in front of the place, below it behind.
                if top:
                    wrong = inside & above & (~close if step < 0 else close)
                else:
                    wrong = inside & ~above & (close if step < 0 else ~close)
                place = place + np.where(wrong, step, 0)
                moved = wrong.any()
                if moved:
                    break
            if not moved:
                return place


def pairs_in_cells(
    cell: np.ndarray, role: np.ndarray, size: np.ndarray, at: np.ndarray, members: np.ndarray, reach: int, bound: float
) -> np.ndarray:
    """For each row the number of its pairs: 0 for those that are only offered. Rows come sorted by
    ``cell`` and ``size``; ``members`` says how many a row stands for."""
    limit = (2.0 + bound) / (2.0 - bound)
    found = np.zeros(len(cell), np.int64)
    seekers = np.flatnonzero(role == OWN)
    own_cell, own_size = cell[seekers], size[seekers]

    # The same time: those behind the seeker up to the last close amount.
    now = np.flatnonzero(role != LATER)
    places = _Places(cell[now], size[now])
    ends = places.settle(places.first_from(own_cell, own_size * limit), own_cell, own_size, bound, True)
    sums = np.concatenate(([0], np.cumsum(members[now])))
    found[seekers] += sums[ends] - sums[np.searchsorted(now, seekers) + 1]

    # Later: both ways in amount, as far as they are early enough.
    later = np.flatnonzero(role == LATER)
    if len(later):
        places = _Places(cell[later], size[later])
        low = places.settle(places.first_from(own_cell, own_size / limit), own_cell, own_size, bound, False)
        high = places.settle(places.first_from(own_cell, own_size * limit), own_cell, own_size, bound, True)
        times = np.unique(at[later])
        ranks = np.searchsorted(times, at[later])
        until = np.searchsorted(times, at[seekers] + reach, "right")
        found[seekers] += count_at_most(ranks, members[later], low, np.maximum(low, high), until)
    return found


def count_close_pairs(points: DataFrame, block: list[str], policy: DecisionPolicy, sign: str) -> DataFrame:
    """``sign``, ``pairs``: how many pairs of different ``points`` of a block (and type, if required)
    are close in time and amount, added up in parts. ``points`` have amount, eventTime, typeNorm,
    ``members`` (rows they stand for; a pair counts as the product) and ``sign``, the same all over a
    block.

    A task holds the distinct points of one cell and of those next to it.
    """
    spark = points.sparkSession
    passing = largest_passing_difference(policy.amount_relative_tolerance)
    result = "sign int, pairs decimal(38,0)"
    if passing is None:
        return spark.createDataFrame([], result)
    reach, bound = policy.max_step_distance, close_below(passing)
    span = log_ratio(passing + 0.005) + 1e-9
    time = floor_div(F.col("eventTime"), reach + 1)
    position = log_amount(F.col("amount"))

    def cell(shift: float):
        return F.floor((position + shift) / (CELL_WIDTH * span))

    def placed(time, amounts, role: int):
        return F.transform(amounts, lambda a: F.struct(time.alias("time"), a.alias("amount"), F.lit(role).alias("role")))

    below = F.filter(F.sequence(cell(-span), cell(0.0)), lambda a: a < cell(0.0))
    offers = F.concat(
        placed(time, F.array(cell(0.0)), OWN),
        placed(time, below, HIGHER),
        placed(time - 1, F.sequence(cell(-span), cell(span)), LATER),
    )
    kind = F.col("typeNorm") if policy.require_type_match else F.lit("")
    spread = points.withColumn("_in", F.explode(offers))
    where = [*block, kind, amount_sign(F.col("amount")), F.col("_in.time"), F.col("_in.amount")]
    # The cell by two hashes, as what it is made of is wide.
    rows = spread.select(
        F.xxhash64(*where).alias("cell"),
        F.xxhash64(F.lit(1), *where).alias("cell2"),
        F.col("_in.role").alias("role"),
        F.abs("amount").alias("size"),
        F.col("eventTime").alias("at"),
        F.col("members").cast("long").alias("members"),
        F.col(sign).cast("int").alias("sign"),
    )

    def counted(table: pa.Table) -> pa.RecordBatch:
        """Of whole cells."""
        columns = {c: table[c].to_numpy() for c in table.column_names}
        new = np.zeros(len(table), np.int64)
        new[1:] = (np.diff(columns["cell"]) != 0) | (np.diff(columns["cell2"]) != 0)
        members = columns["members"]
        pairs = pairs_in_cells(
            np.cumsum(new), columns["role"], columns["size"], columns["at"], members, reach, bound
        )
        # Products are added as Python's integers, which have no limit.
        totals: dict[int, int] = {}
        for value in np.unique(columns["sign"]):
            own = (columns["sign"] == value) & (pairs > 0)
            large = int(pairs.max(initial=0)) * int(members.max(initial=0)) * len(pairs) >= 1 << 62
            kind = object if large else np.int64
            totals[int(value)] = int((pairs[own].astype(kind) * members[own].astype(kind)).sum())
        return pa.RecordBatch.from_pydict(
            {
                "sign": pa.array(list(totals), pa.int32()),
                "pairs": pa.array([str(t) for t in totals.values()], pa.string()),
            }
        )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < ROWS_TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            names = table["cell"].to_numpy(), table["cell2"].to_numpy()
            other = np.flatnonzero((names[0] != names[0][-1]) | (names[1] != names[1][-1]))
            # The last cell may go on.
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield counted(table.slice(0, cut))
            held, count = table.slice(cut).to_batches(), len(table) - cut
        if count:
            yield counted(pa.Table.from_batches(held).combine_chunks())

    dealt = rows.repartition("cell", "cell2").sortWithinPartitions("cell", "cell2", "size")
    parts = dealt.mapInArrow(made, "sign int, pairs string")
    return parts.select("sign", F.col("pairs").cast("decimal(38,0)").alias("pairs"))
