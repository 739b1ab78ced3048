"""A small set of edges with the same connected components as all matched pairs.

Entities only need to know who hangs together, so the matched pairs, whose number grows with the
square of a group, are never listed. Each block is cut into cells so small that any two rows of a
cell match each other for certain:

* inside a cell, every row is linked to the cell's smallest id: one edge a row;
* between neighbouring cells, one edge at most, if some row of one matches some row of the other.
  That is read off the extremes of the cells, or, where these leave it open, off a running extreme
  over the distinct times of the two cells.

Where a match also asks for an equal wallet or a similar name, cells are those of one wallet, and those
of one name. Cells of similar names, found by an edit-distance join, are neighbours like others. Where
many names meet, rows also form cells by what is left of their names without an edit or two: names that
agree in it are all similar, so these cells are linked like those of one wallet, in linear work. A few such
keys a name hang most rows together; the others are taken for rows outside the largest components alone,
and for what is near them.

Cells are made by an aggregation with map-side combine, so a group holding a third of all rows is
reduced to a handful of values before anything is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samekin.functions.similarity import amount_relative_difference, name_similarity
from samekin.functions.text import common_prefix
from samekin.operators.blocking import BLOCK, BlockingPass, per_pass
from samekin.operators.components import contract_to_stars
from samekin.operators.edit_distance import always_similar, cover_keys, covered_lengths, similar_names
from samekin.operators.matching import (
    amount_sign,
    block_matches,
    floor_div,
    largest_passing_difference,
    log_amount,
    log_ratio,
    with_match_keys,
)
from samekin.operators.skew import (
    HOT_ROWS,
    Keep,
    Lookup,
    hot_keys,
    lookup_join,
    measured,
    recomputed,
    sized_join,
)
from samekin.plans.policy import BEHAVIORAL, DecisionPolicy

# A cell is as wide as a certain match reaches. The reach of a possible match is a little more, so
# matching rows may be up to two cells apart in amount, and one in time.
AMOUNT_STEPS = 2

# Rows that differ in one of these never match.
KIND = [*BLOCK, "_type", "_sign"]
PLACE = [*KIND, "_time", "_amount"]
# All rows of a cell agree in whom they are from, if that matters.
CELL = [*PLACE, "_who"]
# Cells of one place with more names than this look for similar ones by segments.
NAMES_TOGETHER = 256
# Neighbours meet in wide cells of so many cells in time and in amount.
WIDE_TIME, WIDE_AMOUNT = 4, 8


def _cell(policy: DecisionPolicy, passing: float) -> dict[str, Column]:
    """Where a row's cell lies in its block."""
    # Half a hundredth more would still round to the passing value; stop short of that edge so
    # that rounding errors of the logarithm cannot let in a row that does not match.
    width = log_ratio(passing + 0.0045)
    return {
        "_type": F.col("typeNorm") if policy.require_type_match else F.lit(""),
        "_sign": amount_sign(F.col("amount")),
        "_time": floor_div(F.col("eventTime"), policy.max_step_distance + 1),
        "_amount": F.floor(log_amount(F.col("amount")) / width),
    }


def _with_cells(rows: DataFrame, policy: DecisionPolicy, passing: float) -> DataFrame:
    return rows.select(
        "txId",
        *BLOCK,
        F.abs("amount").alias("_size"),
        F.col("eventTime").alias("_at"),
        *[where.alias(name) for name, where in _cell(policy, passing).items()],
        (F.col("_who") if "_who" in rows.columns else F.lit("")).alias("_who"),
    )


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL).agg(
        F.min("txId").alias("rep"),
        F.count("*").alias("members"),
        F.min("_at").alias("first"),
        F.max("_at").alias("last"),
        F.min("_size").alias("low"),
        F.max("_size").alias("high"),
    )


def _close(left: Column, right: Column, policy: DecisionPolicy) -> Column:
    tolerance = F.lit(policy.amount_relative_tolerance)
    return amount_relative_difference(left, right) < tolerance


def _members(rows: DataFrame, cells: DataFrame, hot_rows: int) -> DataFrame:
    """The rows of cells that have more than one, each with the cell's smallest id."""
    shared = cells.where(F.col("members") > 1)
    hot = None
    if not shared.where(F.col("members") > hot_rows).isEmpty():
        hot = hot_keys(rows, CELL, hot_rows)
    return lookup_join(rows, shared.select(*CELL, "rep"), CELL, "inner", hot)


def _looked(cells: DataFrame, looks: list[tuple[int, int]]) -> DataFrame:
    """``cells`` once for each of ``looks``, moved to the place they look at."""
    look = F.explode(
        F.array(*[F.struct(F.lit(t).alias("later"), F.lit(s).alias("step")) for t, s in looks])
    )
    return cells.withColumn("_look", look).withColumns(
        {
            "_later": F.col("_look.later"),
            "_step": F.col("_look.step"),
            "_time": F.col("_time") + F.col("_look.later"),
            "_amount": F.col("_amount") + F.col("_look.step"),
        }
    )


def _reaching(
    met: DataFrame, policy: DecisionPolicy, later: Column | None = None, step: Column | None = None
) -> DataFrame:
    """The pairs of cells ``a``, ``b`` whose extremes allow a match; ``later`` and ``step`` (``a._later``
    and ``a._step``) say where ``b`` lies. ``sure`` tells that there is one; otherwise it depends on which
    amounts go with which times."""
    later = F.col("a._later") if later is None else later
    step = F.col("a._step") if step is None else step
    in_time = F.col("b.first") - F.col("a.last") <= F.lit(policy.max_step_distance)
    in_amount = (
        F.when(step > 0, _close(F.col("a.high"), F.col("b.low"), policy))
        .when(step < 0, _close(F.col("a.low"), F.col("b.high"), policy))
        .otherwise(F.lit(True))
    )
    one_time = (F.col("a.first") == F.col("a.last")) & (F.col("b.first") == F.col("b.last"))
    same_time = later == 0
    return met.where(in_amount & (same_time | in_time)).select(
        F.col("a._pass").alias("_pass"),
        F.col("a.rep").alias("a"),
        F.col("b.rep").alias("b"),
        F.col("a._who").alias("a_who"),
        F.col("b._who").alias("b_who"),
        (step > 0).alias("upward"),
        (same_time | (step == 0) | one_time).alias("sure"),
    )


def _all_equal(columns: list[str], left: str, right: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns])


AMOUNT_REACH = range(-AMOUNT_STEPS, AMOUNT_STEPS + 1)
# ``a`` is the earlier cell, or the lower one at the same time.
AHEAD = [(0, s) for s in AMOUNT_REACH if s > 0] + [(1, s) for s in AMOUNT_REACH]
AROUND = [(t, s) for t in (-1, 0, 1) for s in AMOUNT_REACH]


def _wide(time: Column, amount: Column) -> list[Column]:
    return [floor_div(time, WIDE_TIME), floor_div(amount, WIDE_AMOUNT)]


def _neighbours(cells: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """Pairs of neighbouring cells. They meet in wide cells: ``a`` in its own, ``b`` in all from which it
    can be seen, mostly one or two. The join is on equality, and a wide cell holds a bounded number of
    cells."""
    time, amount = F.col("_time"), F.col("_amount")
    own = _wide(time, amount)
    first, last = _wide(time - 1, amount - AMOUNT_STEPS), _wide(time, amount + AMOUNT_STEPS)
    looking = cells.withColumns({"_wtime": own[0], "_wamount": own[1]})
    seen = cells.withColumn("_wtime", F.explode(F.sequence(first[0], last[0])))
    seen = seen.withColumn("_wamount", F.explode(F.sequence(first[1], last[1])))
    later = F.col("b._time") - F.col("a._time")
    step = F.col("b._amount") - F.col("a._amount")
    alike = [c for c in CELL if c not in ("_time", "_amount")]
    on = _all_equal([*alike, "_wtime", "_wamount"], "a", "b")
    on &= later.between(0, 1) & step.between(-AMOUNT_STEPS, AMOUNT_STEPS) & ((later == 1) | (step > 0))
    return _reaching(looking.alias("a").join(seen.alias("b"), on), policy, later, step)


def _crowded_places(cells: DataFrame, names_together: int) -> DataFrame:
    sizes = cells.groupBy(*PLACE).agg(F.count("*").alias("_names"))
    return sizes.where(F.col("_names") > names_together).select(*PLACE)


def _covered_blocks(cells: DataFrame, crowded: DataFrame, lengths: dict[int, int]) -> Lookup:
    """The blocks with crowded places: how many letters all names of a block have in common at the
    beginning (``_prefix``) and, behind that, at the end (``_suffix``), and whether all its pairs of names
    are of one length that is covered (``_alike``). The smallest and the largest of some texts begin in
    common with what all of them do."""
    blocks = measured(crowded.select(*BLOCK).distinct())
    name = F.col("_who")
    ends = sized_join(cells, blocks, BLOCK, "left_semi").groupBy(*BLOCK).agg(
        F.min(name).alias("_low"),
        F.max(name).alias("_high"),
        F.min(F.reverse(name)).alias("_rlow"),
        F.max(F.reverse(name)).alias("_rhigh"),
        F.min(F.length(name)).alias("_shortest"),
        F.max(F.length(name)).alias("_longest"),
    )
    prefixed = ends.withColumn("_prefix", common_prefix(F.col("_low"), F.col("_high")))
    suffix = F.least(common_prefix(F.col("_rlow"), F.col("_rhigh")), F.col("_shortest") - F.col("_prefix"))
    one = (F.col("_shortest") == F.col("_longest")) & F.col("_longest").isin(list(lengths))
    return measured(prefixed.select(*BLOCK, "_prefix", suffix.alias("_suffix"), one.alias("_alike")))


def _by_cover(rows: DataFrame, blocks: Lookup, lengths: dict[int, int], few: bool = False) -> DataFrame:
    """``rows`` once for each cover key of their name, or for a ``few`` of them, in place of the name."""
    known = sized_join(rows, blocks, BLOCK, "inner")
    keys = cover_keys(F.col("_who"), F.col("_prefix"), F.col("_suffix"), lengths, few)
    return known.withColumn("_who", F.explode(keys)).select(*rows.columns)


def _outside_largest(placed: DataFrame, mapping: DataFrame, hot_rows: int) -> DataFrame:
    """The ``placed`` rows that are not in the component which most rows of their kind are in."""
    rows = placed.select("txId", *CELL)
    labels = mapping.select("txId", F.col("resolvedEntityId").alias("_label"))
    hot = hot_keys(rows, "txId", hot_rows)
    known = lookup_join(rows, labels, "txId", "left", hot)
    known = known.withColumn("_label", F.coalesce("_label", "txId"))
    sizes = known.groupBy(*KIND, "_label").agg(F.count("*").alias("_rows"))
    largest = sizes.groupBy(*KIND).agg(F.max_by("_label", F.struct("_rows", "_label")).alias("_largest"))
    beside = sized_join(known, largest, KIND, "inner").where(F.col("_label") != F.col("_largest"))
    return beside.select(*rows.columns)


def _near(
    rows: DataFrame, outside: DataFrame, blocks: Lookup, lengths: dict[int, int], policy: DecisionPolicy, passing: float
) -> DataFrame:
    """``rows`` once for each cover key that a row of ``outside``, in a cell around theirs, has as well. They
    are looked for by wide cells, first without keys, so that rows far from all ``outside`` get none."""
    place = [*KIND, "_wtime", "_wamount"]
    time, amount = F.col("_time"), F.col("_amount")
    first, last = _wide(time - 1, amount - AMOUNT_STEPS), _wide(time + 1, amount + AMOUNT_STEPS)
    around = _by_cover(outside, blocks, lengths).withColumn("_wtime", F.explode(F.sequence(first[0], last[0])))
    around = around.withColumn("_wamount", F.explode(F.sequence(first[1], last[1])))
    sought = measured(around.select(*place, "_who").distinct())
    own = _wide(time, amount)
    cells = rows.withColumns(_cell(policy, passing)).withColumns({"_wtime": own[0], "_wamount": own[1]})
    close = sized_join(cells, sought.table.select(*place).distinct(), place, "left_semi")
    return sized_join(_by_cover(close, blocks, lengths), sought, [*place, "_who"], "left_semi").select(*rows.columns)


def _cover_links(
    rows: DataFrame,
    links: DataFrame,
    blocks: Lookup,
    lengths: dict[int, int],
    policy: DecisionPolicy,
    passing: float,
    keep: Keep,
    hot_rows: int,
) -> DataFrame:
    """``links`` and those among names that share a cover key, or others with the same components.

    A few keys already hang most rows together. Rows of one kind never match those of another, and
    a link within a component says nothing new, so all keys are needed only for the rows outside the
    component that most rows of their kind are in, and for what is near these and shares a key with them.
    """
    some = block_links(_by_cover(rows, blocks, lengths, few=True), policy, keep, hot_rows)
    mapping = measured(contract_to_stars(links.unionByName(some), hot_rows).mapping).table
    stars = mapping.where(F.col("txId") != F.col("resolvedEntityId")).select(
        F.col("resolvedEntityId").alias("src"), F.col("txId").alias("dst")
    )
    named = sized_join(rows, blocks, BLOCK, "left_semi")
    outside = measured(_outside_largest(_with_cells(named, policy, passing), mapping, hot_rows))
    if not outside.rows:
        return stars
    near = keep(_near(rows, outside.table, blocks, lengths, policy, passing))
    return stars.unionByName(block_links(near, policy, keep, hot_rows))


def _similar_neighbours(
    cells: DataFrame, policy: DecisionPolicy, crowded: DataFrame | None, blocks: Lookup | None, lengths: dict[int, int]
) -> DataFrame:
    """Pairs of cells of different but similar names that are neighbours, or at the same place, without
    those of equal ``lengths`` in covered ``blocks``.

    Places with few names compare these with each other. Where either place is ``crowded``, an
    edit-distance join finds the similar ones.
    """
    threshold = policy.name_similarity_threshold
    some = crowded is not None
    covered = F.lit(False)
    if some:
        cells = sized_join(cells, blocks, BLOCK, "left").where(~F.coalesce("_alike", F.lit(False)))
        cells = sized_join(cells, crowded.withColumn("_crowded", F.lit(True)), PLACE, "left")
        cells = cells.na.fill(False, ["_crowded"])
        equal = F.length("a._who") == F.length("b._who")
        covered = F.col("a._prefix").isNotNull() & equal & F.length("a._who").isin(list(lengths))
    else:
        cells = cells.withColumn("_crowded", F.lit(False))
    either = F.col("a._crowded") | F.col("b._crowded")
    a_name, b_name = F.col("a._who"), F.col("b._who")
    # At the same place either could be a.
    once = (a_name != b_name) & ((F.col("a._later") != 0) | (F.col("a._step") != 0) | (a_name < b_name))
    on = _all_equal(PLACE, "a", "b") & ~either & once & ~covered & (name_similarity(a_name, b_name) >= F.lit(threshold))
    met = _looked(cells, [(0, 0), *AHEAD]).alias("a").join(cells.alias("b"), on)
    found = _reaching(met, policy)
    if not some:
        return found
    near = _looked(crowded, AROUND).select(*PLACE).distinct()
    around = sized_join(cells, near, PLACE, "left_semi")
    # Whoever has the shorter name looks around; which of the two is a follows from where it finds b.
    looking = _looked(around, AROUND)
    pairs = similar_names(looking, around, PLACE, "_who", threshold, "rep", covered=list(lengths))
    later, step = F.col("l._later"), F.col("l._step")
    looker_first = (later > 0) | ((later == 0) & (step >= 0))
    columns = ["_pass", "_who", "rep", "first", "last", "low", "high"]
    sides = {
        side: F.struct(
            *[F.when(first, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in columns],
            F.abs(later).alias("_later"),
            F.when(looker_first, step).otherwise(-step).alias("_step"),
        )
        for side, first in (("a", looker_first), ("b", ~looker_first))
    }
    placed = pairs.where(F.col("l._crowded") | F.col("r._crowded")).select(
        *[side.alias(name) for name, side in sides.items()]
    )
    return found.unionByName(_reaching(placed, policy))


def _settled_by_sweep(open_pairs: DataFrame, moments: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """The open neighbour pairs that do have a match.

    Cell ``b`` is the later one. A row of ``a`` at time t reaches rows of ``b`` up to t + max
    step; of these only the one nearest in amount matters, and since the cells do not overlap in
    amount that is the running minimum or maximum. One sorted pass over both cells' distinct times
    decides, and there are at most twice the step window of them.
    """
    reach = F.lit(policy.max_step_distance).cast("long")
    # The same id can stand for a cell in each pass, and for each whom its row is from there.
    pair = ["_pass", "a", "b", "a_who", "b_who", "upward"]

    def of(end: str) -> DataFrame:
        return moments.withColumnsRenamed({"rep": end, "_who": f"{end}_who"})

    seekers = open_pairs.join(of("a"), ["_pass", "a", "a_who"]).select(
        *pair,
        (F.col("_at") + reach).alias("until"),
        F.lit(1).alias("role"),
        F.when(F.col("upward"), F.col("high")).otherwise(F.col("low")).alias("edge"),
    )
    offers = open_pairs.join(of("b"), ["_pass", "b", "b_who"]).select(
        *pair,
        F.col("_at").alias("until"),
        F.lit(0).alias("role"),
        F.when(F.col("upward"), F.col("low")).otherwise(F.col("high")).alias("edge"),
    )
    order = W.partitionBy(*pair).orderBy("until", "role")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    offered = F.when(F.col("role") == 0, F.col("edge"))
    nearest = F.when(F.col("upward"), F.min(offered).over(running)).otherwise(
        F.max(offered).over(running)
    )
    return (
        seekers.unionByName(offers)
        .withColumn("nearest", nearest)
        .where((F.col("role") == 1) & _close(F.col("edge"), F.col("nearest"), policy))
        .select("a", "b")
        .distinct()
    )


def block_links(
    rows: DataFrame,
    policy: DecisionPolicy,
    keep: Keep = recomputed,
    hot_rows: int = HOT_ROWS,
    names: Column | None = None,
    names_together: int = NAMES_TOGETHER,
) -> DataFrame:
    """Links inside the blocks of ``per_pass`` rows, where closeness in time and amount (and
    type) is all it takes to match; with a column ``_who`` only among rows that agree in it, and, if
    ``names`` says that a cell's ``_who`` is a name, among similar names."""
    passing = largest_passing_difference(policy.amount_relative_tolerance)
    if passing is None:
        return block_matches(rows, policy)
    placed = _with_cells(rows, policy, passing)
    cells = keep(_cells(placed))
    members = _members(placed, cells, hot_rows)
    neighbours = _neighbours(cells, policy)
    blocks = None
    if names is not None:
        named = cells.where(names)
        lengths = covered_lengths(policy.name_similarity_threshold)
        crowded = _crowded_places(named, names_together)
        if crowded.isEmpty():
            crowded = None
        else:
            blocks = _covered_blocks(named, crowded, lengths)
        similar = _similar_neighbours(named, policy, crowded, blocks, lengths)
        neighbours = neighbours.unionByName(similar)
    neighbours = keep(neighbours)

    ends = [F.col("a").alias("src"), F.col("b").alias("dst")]
    open_pairs = neighbours.where(~F.col("sure")).drop("sure")
    settled = open_pairs.isEmpty()
    if not settled:
        # Read for their links and, on both sides of open pairs, for their extremes.
        members = keep(members)
    inside = members.where(F.col("txId") != F.col("rep")).select(
        F.col("rep").alias("src"), F.col("txId").alias("dst")
    )
    links = inside.unionByName(neighbours.where("sure").select(*ends))
    if not settled:
        # The extremes at each distinct time, for the pairs of cells still open.
        moments = (
            members.groupBy("_pass", "_who", "rep", "_at")
            .agg(F.min("_size").alias("low"), F.max("_size").alias("high"))
            .unionByName(
                cells.where(F.col("members") == 1).select(
                    "_pass", "_who", "rep", F.col("first").alias("_at"), "low", "high"
                )
            )
        )
        links = links.unionByName(_settled_by_sweep(open_pairs, moments, policy).select(*ends))
    if blocks is None:
        return links
    return _cover_links(rows.where(names), links, blocks, lengths, policy, passing, keep, hot_rows)


def _identified(rows: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """``rows`` by whom they are from: once under their name and, if wallets count, once under their
    wallet. ``_pass`` tells names (even) from wallets (odd)."""
    whose = ["nameNorm"] + (["walletNorm"] if policy.wallet_match_enabled else [])
    look = F.explode(
        F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("who")) for i, c in enumerate(whose)])
    )
    return (
        rows.withColumn("_in", look)
        .where(F.col("_in.who").isNotNull())
        .withColumns({"_pass": 2 * F.col("_pass") + F.col("_in.kind"), "_who": F.col("_in.who")})
        .drop("_in")
    )


def connecting_edges(
    transactions: DataFrame,
    policy: DecisionPolicy,
    passes: tuple[BlockingPass, ...],
    keep: Keep = recomputed,
    hot_rows: int = HOT_ROWS,
    names_together: int = NAMES_TOGETHER,
) -> DataFrame:
    """Edges ``src``, ``dst`` with the connected components of the full matched graph.

    Blocks are linked by cells, whatever their size. In identifier mode a pair also needs a similar name
    or the same wallet: a pass whose blocks share one name has that for free, in any other pass cells
    are those of a name or a wallet.
    """
    rows = keep(with_match_keys(transactions, policy, passes))
    every = list(range(len(passes)))
    unnamed = policy.evidence_mode == BEHAVIORAL or always_similar(policy.name_similarity_threshold)
    close = [i for i, blocking in enumerate(passes) if unnamed or blocking.same_name]
    identified = [i for i in every if i not in close]
    parts = []
    if close:
        parts.append(block_links(per_pass(rows, close), policy, keep, hot_rows))
    if identified:
        whose = _identified(per_pass(rows, identified), policy)
        named = F.col("_pass") % 2 == 0
        parts.append(block_links(whose, policy, keep, hot_rows, named, names_together))
    return reduce(lambda x, y: x.unionByName(y), parts)
