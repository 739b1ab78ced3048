"""Matched pairs straight from the transactions, without building the losing candidates.

Two rows can only match if they are close in time and in amount. Both axes are cut into cells; the
left row looks into its own cell, the right row is copied to every cell its reach touches, and cell
equality joins the block key as a join key. Work follows the matches, not the block sizes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from samekin.operators.blocking import (
    BLOCK,
    BlockingPass,
    first_pass_only,
    pass_key,
    per_pass,
    with_pass_keys,
)
from samekin.operators.decisions import evidence
from samekin.operators.pairs import TILE_ROWS, one_row_per_id, repeated_keys
from samekin.operators.scoring import facts, with_match_features
from samekin.operators.skew import sized_join
from samekin.plans.policy import IDENTIFIER, DecisionPolicy
from samekin.session import scratch_path

# Cells are this many reaches wide, so that a right row seldom needs more than two copies an axis.
CELL_WIDTH = 4


def floor_div(value: Column, width: int) -> Column:
    """Integer division that rounds down, exact for the whole range of long."""
    width = F.lit(width).cast("long")
    return F.call_function("div", value - F.pmod(value, width), width)


def largest_passing_difference(tolerance: float) -> float | None:
    """The largest two-decimal relative difference that is below ``tolerance``."""
    passing = [k / 100 for k in range(0, 201) if k / 100 < tolerance]
    return passing[-1] if passing else None


def log_ratio(difference: float) -> float:
    """Distance on the log axis of two amounts with this relative difference."""
    return math.log((2.0 + difference) / (2.0 - difference))


def amount_sign(amount: Column) -> Column:
    return F.signum(amount).cast("int")


def log_amount(amount: Column) -> Column:
    """Position on the log axis; zero amounts have a sign of their own and sit at 0."""
    return F.when(amount == 0.0, F.lit(0.0)).otherwise(F.ln(F.abs(amount)))


def _time_cells(time: Column, reach: int) -> tuple[Column, Column]:
    width = max(CELL_WIDTH * reach, 1)
    touched = F.sequence(floor_div(time - reach, width), floor_div(time + reach, width))
    return floor_div(time, width), touched


def _amount_cells(amount: Column, passing: float) -> tuple[Column, Column]:
    reach = log_ratio(passing + 0.005) + 1e-9
    at = log_amount(amount)

    def cell(position: Column) -> Column:
        return F.floor(position / (CELL_WIDTH * reach))

    return cell(at), F.sequence(cell(at - reach), cell(at + reach))


@dataclass
class Prepared:
    """One row for each id with what blocking and matching need, written once and read by every stage.
    ``rows`` counts them, ``loaded`` the transactions they stand for."""

    table: DataFrame
    rows: int
    loaded: int


def keyed_rows(transactions: DataFrame, passes: tuple[BlockingPass, ...]) -> DataFrame:
    """One row for each id, with normalized columns and pass keys; as it is if it has them."""
    if pass_key(0) in transactions.columns:
        return transactions
    return with_pass_keys(with_match_features(one_row_per_id(transactions)), passes)


def prepared(transactions: DataFrame, passes: tuple[BlockingPass, ...]) -> Prepared:
    """:func:`keyed_rows`, narrow, in the shared folder. The source is scanned once for its ids and once
    for the rows, which are counted as they are written."""
    spark = transactions.sparkSession
    repeated = repeated_keys(transactions, ["txId"])
    keyed = with_pass_keys(with_match_features(one_row_per_id(transactions, repeated)), passes)
    features = ["nameNorm", "walletNorm", "typeNorm"]
    keys = [pass_key(i) for i in range(len(passes))]
    narrow = keyed.select("txId", "amount", "eventTime", *features, *keys)
    path, seen = scratch_path(spark, "prepared"), Observation()
    narrow.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = seen.get["rows"]
    loaded = transactions.count() if repeated.rows else rows
    return Prepared(spark.read.schema(narrow.schema).parquet(path), rows, loaded)


def with_match_keys(
    transactions: DataFrame, policy: DecisionPolicy, passes: tuple[BlockingPass, ...]
) -> DataFrame:
    """The narrow row matching needs: id, amount, time, pass keys and those of the normalized
    columns that the policy looks at. Rows that cannot match anything, for want of an amount, a
    time or a required type, are left out, and rows with the same id are one."""
    identifiers = policy.evidence_mode == IDENTIFIER
    wanted = {"nameNorm": identifiers, "walletNorm": identifiers, "typeNorm": policy.require_type_match}
    keyed = keyed_rows(transactions, passes)
    usable = F.col("amount").isNotNull() & F.col("eventTime").isNotNull()
    if policy.require_type_match:
        usable &= F.col("typeNorm").isNotNull()
    return keyed.where(usable).select(
        "txId",
        "amount",
        "eventTime",
        *[F.col(c) if used else F.lit(None).cast("string").alias(c) for c, used in wanted.items()],
        *[pass_key(i) for i in range(len(passes))],
    )


def split_crowded(
    left: DataFrame, right: DataFrame, cell: list[str], tile_rows: int, id_column: str = "txId"
) -> tuple[DataFrame, DataFrame]:
    """Spread the rows of crowded cells over parts on both sides; each left part meets each right
    part in a join of its own, so no task compares more than a tile of either."""

    def parts(side: DataFrame, name: str) -> DataFrame:
        sizes = side.groupBy(*cell).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias(name))
        return sizes.where(F.col(name) > 1)

    crowded = parts(left, "_lparts").join(parts(right, "_rparts"), cell, "full")
    crowded = crowded.na.fill(1, ["_lparts", "_rparts"])
    if crowded.isEmpty():
        return left, right

    def spread(side: DataFrame, own: str, other: str) -> DataFrame:
        known = sized_join(side, crowded, cell, "left").na.fill(1, ["_lparts", "_rparts"])
        place = F.pmod(F.xxhash64(id_column), F.col(f"_{own}parts")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"_{other}parts") - 1))
        return known.withColumn(f"_{own}part", place).withColumn(f"_{other}part", every)

    left, right = spread(left, "l", "r"), spread(right, "r", "l")
    cell += ["_lpart", "_rpart"]
    return left, right


def matching_join(
    rows: DataFrame,
    block: list[str],
    policy: DecisionPolicy,
    condition: Column | None = None,
    tile_rows: int | None = TILE_ROWS,
) -> DataFrame:
    """Matching rows ``l``, ``r`` with equal ``block`` columns, each unordered pair once with
    ``l.txId < r.txId`` as strings, as far as they meet ``condition``. Cells of more than
    ``tile_rows`` rows are split; None says that blocks are known to be smaller."""
    passing = largest_passing_difference(policy.amount_relative_tolerance)
    if passing is None:
        rows, passing = rows.where(F.lit(False)), 0.0
    own_time, near_times = _time_cells(F.col("eventTime"), policy.max_step_distance)
    own_amount, near_amounts = _amount_cells(F.col("amount"), passing)
    rows = rows.withColumn("_sign", amount_sign(F.col("amount")))
    left = rows.withColumn("_time", own_time).withColumn("_amount", own_amount)
    right = rows.withColumn("_time", F.explode(near_times))
    right = right.withColumn("_amount", F.explode(near_amounts))

    equal = [*block, "_sign", "_time", "_amount"]
    if policy.require_type_match:
        equal.append("typeNorm")
    if tile_rows is not None:
        left, right = split_crowded(left, right, equal, tile_rows)
    known = facts("l", "r")
    # What is tested first is cheap and holds for few pairs of a cell.
    on = known["timeDistance"] <= F.lit(policy.max_step_distance)
    on &= F.col("l.txId") < F.col("r.txId")
    for column in equal:
        on &= F.col(f"l.{column}") == F.col(f"r.{column}")
    if condition is not None:
        on &= condition
    on &= evidence(known, policy).matched
    return left.alias("l").join(right.alias("r"), on)


def block_matches(
    rows: DataFrame,
    policy: DecisionPolicy,
    condition: Column | None = None,
    tile_rows: int | None = TILE_ROWS,
) -> DataFrame:
    """Matched pairs inside the blocks of ``per_pass`` rows, as ``src``, ``dst``."""
    return matching_join(rows, BLOCK, policy, condition, tile_rows).select(
        F.col("l.txId").alias("src"), F.col("r.txId").alias("dst")
    )


def matched_edges_direct(
    transactions: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...],
    tile_rows: int | None = TILE_ROWS,
) -> DataFrame:
    """The same edges as candidates, scores, decisions and ``matched_edges`` give, each once.

    A pair is left to the first pass that has it, so nothing needs to be
    deduplicated afterwards.
    """
    rows = per_pass(with_match_keys(transactions, policy, passes), list(range(len(passes))))
    return block_matches(rows, policy, first_pass_only(passes), tile_rows)
