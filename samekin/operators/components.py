"""Connected components of an edge table (``src``, ``dst``), labelled by the smallest id."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samekin.operators.skew import HOT_ROWS, hot_keys, lookup_join, measured
from samekin.session import release, scratch_path

MAX_ROUNDS = 100
# Above this many edges, those of leaves are set aside before the rounds.
LEAF_ROWS = 200_000
# Tables of a number or two a row are broadcast up to so many rows.
BROADCAST_NUMBERS = 1_000_000


@dataclass
class Components:
    """``mapping`` has txId and resolvedEntityId; ``rounds`` the number of changes per round."""

    mapping: DataFrame
    rounds: list[int] = field(default_factory=list)


def symmetric_edges(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, once, without self-loops."""
    forth = edges.where(F.col("src") != F.col("dst")).select("src", "dst")
    back = forth.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return forth.unionByName(back).distinct()


@dataclass
class _Round:
    """A table written to the shared folder, and metrics read on the way."""

    table: DataFrame
    path: str
    seen: dict

    def release(self) -> None:
        release(self.table.sparkSession, self.path)


def _cut(df: DataFrame, **metrics) -> _Round:
    """Materialize as Parquet in the shared folder. Whoever makes the next round from it releases it
    once that is written, so one round is kept and a lost executor costs at most one."""
    spark = df.sparkSession
    path = scratch_path(spark, "round")
    if not metrics:
        df.write.parquet(path)
        return _Round(spark.read.schema(df.schema).parquet(path), path, {})
    observation = Observation()
    df.observe(observation, *[m.alias(name) for name, m in metrics.items()]).write.parquet(path)
    return _Round(spark.read.schema(df.schema).parquet(path), path, observation.get)


def number_ids(ids: DataFrame) -> DataFrame:
    """The different ids of a column ``id`` with numbers ``n`` in their order. Only once it is written do the
    numbers stay the same."""
    return ids.orderBy("id").withColumn("n", F.monotonically_increasing_id())


def named_back(mapping: DataFrame, numbers: DataFrame, rows: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A mapping of ``rows`` numbers at most as one of the ids that :func:`number_ids` gave them for."""

    def named(end: str) -> DataFrame:
        return numbers.select(F.col("n").alias(end), F.col("id").alias("_id"))

    hot = _hot(mapping, "resolvedEntityId", rows, hot_rows)
    entities = lookup_join(mapping, named("resolvedEntityId"), "resolvedEntityId", "inner", hot)
    entities = entities.select("txId", F.col("_id").alias("resolvedEntityId"))
    return entities.join(named("txId"), "txId").select(F.col("_id").alias("txId"), "resolvedEntityId")


def _numbered(first: DataFrame, rows: int, hot_rows: int) -> tuple[_Round, _Round]:
    """Ids with numbers in their order (``id``, ``n``), and ids with their number and that of their label.
    Numbers are compared, shuffled and aggregated by hash, where texts have to be sorted."""
    if isinstance(first.schema["id"].dataType, T.LongType):
        # They are numbers already.
        return _cut(first.select("id", F.col("id").alias("n"))), _cut(first.select("id", F.col("id").alias("n"), "label"))
    numbers = _cut(number_ids(first.select("id")))
    own = first.join(numbers.table, "id")
    named = numbers.table.select(F.col("id").alias("label"), F.col("n").alias("_label"))
    known = lookup_join(own, named, "label", "inner", _hot(first, "label", rows, hot_rows))
    return numbers, _cut(known.select("id", "n", F.col("_label").alias("label")))


def _unsettled(pairs: DataFrame, hot_rows: int) -> DataFrame:
    """Those of ``pairs`` that may still change a label after the first round.

    All ids of one label are neighbours of that label's id, so labels joined by a pair hang together as
    the ids do, and the smallest label of such a group is the last one of all its ids. Pairs both of whose
    ends have it already are of no more use.
    """
    across = pairs.where(F.col("hi_label") != F.col("lo_label"))
    across = across.select(F.col("hi_label").alias("src"), F.col("lo_label").alias("dst"))
    last = contract_to_stars(across, hot_rows).mapping.where(F.col("txId") != F.col("resolvedEntityId"))
    unsettled = measured(last.select(F.col("txId").alias("_label"), F.lit(True).alias("_open")))
    for end in ("hi", "lo"):
        key = f"{end}_label"
        found = unsettled.table.select(F.col("_label").alias(key), F.col("_open").alias(f"_{end}"))
        if unsettled.rows <= BROADCAST_NUMBERS:
            pairs = pairs.join(F.broadcast(found), key, "left")
        else:
            pairs = lookup_join(pairs, found, key, "left", hot_keys(pairs, key, hot_rows))
    return pairs.where(F.col("_hi").isNotNull() | F.col("_lo").isNotNull())


def propagate_labels(
    edges: DataFrame, hot_rows: int = HOT_ROWS, settle_rows: int = LEAF_ROWS
) -> Components:
    """Plain propagation: in each round an id takes the smallest label of its neighbours, until a
    round changes nothing. It takes as many rounds as the longest shortest path has edges.

    Only labels that changed in a round are sent on in the next one. The first round is an aggregation of
    the edges. Above ``settle_rows`` edges, those whose ends both have their last label by then are set
    aside, so dense groups, which have most edges, take no part in the rounds.
    """
    ends, count = [F.col("src"), F.col("dst")], F.count(F.lit(1))
    oriented = edges.where(F.col("src") != F.col("dst")).select(
        F.greatest(*ends).alias("hi"), F.least(*ends).alias("lo")
    )
    pairs = _cut(oriented, rows=count)
    nearest = pairs.table.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("label"))
    alone = pairs.table.select(F.col("lo").alias("id")).distinct().withColumn("label", F.col("id"))
    first = nearest.unionByName(alone).groupBy("id").agg(F.min("label").alias("label"))
    first = _cut(first, rows=count, changed=F.count_if(F.col("label") != F.col("id")))
    rounds = [first.seen["changed"]]
    numbers, ids = _numbered(first.table, first.seen["rows"], hot_rows)
    first.release()

    between = pairs.table
    for end in ("hi", "lo"):
        known = ids.table.select(
            F.col("id").alias(end), F.col("n").alias(f"{end}_n"), F.col("label").alias(f"{end}_label")
        )
        hot = _hot(pairs.table, end, pairs.seen["rows"], hot_rows)
        between = lookup_join(between, known, end, "inner", hot).drop(end)
    between = _cut(between)
    large = pairs.seen["rows"] > settle_rows
    pairs.release()
    active = _unsettled(between.table, hot_rows) if large else between.table
    active = active.select(F.col("hi_n").alias("src"), F.col("lo_n").alias("dst"))
    both = _cut(symmetric_edges(active), rows=count)
    between.release()

    taking_part = both.table.select(F.col("src").alias("n")).distinct()
    labels = ids.table.join(taking_part, "n", "left_semi").select(
        "n", "label", (F.col("label") != F.col("n")).alias("changed")
    )
    last = _cut(labels)
    hot = hot_keys(both.table, "src", hot_rows) if both.seen["rows"] > hot_rows else None
    while rounds[-1] > 0:
        moved = last.table.where("changed").select(F.col("n").alias("src"), "label")
        if rounds[-1] <= BROADCAST_NUMBERS:
            offers = both.table.join(F.broadcast(moved), "src")
        else:
            offers = lookup_join(both.table, moved, "src", "inner", hot)
        offers = offers.select(F.col("dst").alias("n"), "label", F.lit(None).cast("long").alias("own"))
        merged = (
            last.table.select("n", "label", F.col("label").alias("own"))
            .unionByName(offers)
            .groupBy("n")
            .agg(F.min("label").alias("label"), F.max("own").alias("own"))
            .select("n", "label", (F.col("label") != F.col("own")).alias("changed"))
        )
        current = _cut(merged, changed=F.count_if(F.col("changed")))
        last.release()
        last = current
        rounds.append(current.seen["changed"])
    both.release()
    later = last.table.select("n", F.col("label").alias("_later"))
    final = ids.table.join(later, "n", "left")
    final = final.select("id", F.coalesce("_later", "label").alias("n"))
    if isinstance(ids.table.schema["id"].dataType, T.LongType):
        return Components(final.select(F.col("id").alias("txId"), F.col("n").alias("resolvedEntityId")), rounds)
    names = numbers.table.select("n", F.col("id").alias("resolvedEntityId"))
    mapping = lookup_join(final, names, "n", "inner", _hot(final, "n", first.seen["rows"], hot_rows))
    return Components(mapping.select(F.col("id").alias("txId"), "resolvedEntityId"), rounds)


def _hot(current: DataFrame, key: str, rows: int, hot_rows: int) -> list[int] | None:
    return hot_keys(current, key, hot_rows) if rows > hot_rows else None


def _star_round(current: DataFrame, rows: int, hot_rows: int) -> DataFrame:
    """One large-star and one small-star step; ``moved`` marks edges that are new."""
    # Large-star: the larger neighbours of an id move to that id's smallest neighbour.
    nearest = current.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("root"))
    large = lookup_join(current, nearest, "lo", "left", _hot(current, "lo", rows, hot_rows))
    large = large.select(
        "hi", F.coalesce("root", "lo").alias("lo"), F.col("root").isNotNull().alias("moved")
    )
    # Small-star: an id and its smaller neighbours move to the smallest of them.
    nearest = large.groupBy("hi").agg(F.min("lo").alias("root"))
    joined = lookup_join(large, nearest, "hi", "inner", _hot(current, "hi", rows, hot_rows))
    moved = F.col("moved") | (F.col("lo") != F.col("root"))
    star = F.array(
        *[
            F.struct(F.col(end).alias("hi"), F.col("root").alias("lo"), moved.alias("moved"))
            for end in ("hi", "lo")
        ]
    )
    return (
        joined.select(F.explode(star).alias("edge"))
        .select("edge.*")
        .where(F.col("hi") != F.col("lo"))
        .groupBy("hi", "lo")
        .agg(F.max("moved").alias("moved"))
    )


def _leaves(current: DataFrame) -> DataFrame:
    """Edges whose larger end has no other edge. They follow their smaller end whatever the
    rest does, so they need not take part in the rounds."""
    single = F.count("*").alias("edges")
    once = current.groupBy("hi").agg(F.min("lo").alias("lo"), single).where("edges = 1")
    inner = current.select(F.col("lo").alias("hi")).distinct()
    return once.join(inner, "hi", "left_anti").select("hi", "lo")


def _with_leaves(mapping: DataFrame, leaves: DataFrame, rows: int, hot_rows: int) -> DataFrame:
    labels = mapping.select(F.col("txId").alias("lo"), F.col("resolvedEntityId").alias("label"))
    hot = _hot(leaves, "lo", rows, hot_rows)
    followed = lookup_join(leaves, labels, "lo", "left", hot).select(
        "hi", "lo", F.coalesce("label", "lo").alias("resolvedEntityId"), F.col("label").isNull().alias("alone")
    )
    ends = followed.select(F.col("hi").alias("txId"), "resolvedEntityId")
    centres = followed.where("alone").select(F.col("lo").alias("txId"), "resolvedEntityId")
    return mapping.unionByName(ends).unionByName(centres.distinct())


def contract_to_stars(
    edges: DataFrame, hot_rows: int = HOT_ROWS, leaf_rows: int = LEAF_ROWS
) -> Components:
    """Components to convergence by alternating large-star and small-star steps (Kiveris et al.,
    Connected Components in MapReduce and Beyond, 2014).

    Edges run from the larger id ``hi`` to the smaller ``lo``. The number of rounds grows with
    the logarithm of the longest path, not with its length, and the edge table does not grow.
    """
    ends = [F.col("src"), F.col("dst")]
    oriented = (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest(*ends).alias("hi"), F.least(*ends).alias("lo"))
        .distinct()
    )
    count = F.count(F.lit(1))
    last = _cut(oriented, rows=count)
    leaves = None
    if last.seen["rows"] > leaf_rows:
        leaves = _cut(_leaves(last.table), rows=count)
        hot = _hot(last.table, "hi", last.seen["rows"], hot_rows)
        inner = lookup_join(last.table, leaves.table.select("hi"), "hi", "left_anti", hot)
        following = _cut(inner, rows=count)
        last.release()
        last = following
    rounds: list[int] = []
    while last.seen["rows"] and (not rounds or rounds[-1] > 0):
        if len(rounds) == MAX_ROUNDS:
            raise RuntimeError(f"no convergence within {MAX_ROUNDS} rounds")
        step = _star_round(last.table.select("hi", "lo"), last.seen["rows"], hot_rows)
        following = _cut(step, rows=count, moved=F.count_if(F.col("moved")))
        last.release()
        last = following
        rounds.append(last.seen["moved"])
    current = last.table
    outer = current.select(F.col("hi").alias("txId"), F.col("lo").alias("resolvedEntityId"))
    roots = current.select(F.col("lo").alias("txId"), F.col("lo").alias("resolvedEntityId"))
    mapping = outer.unionByName(roots.distinct())
    if leaves is not None:
        mapping = _with_leaves(mapping, leaves.table, leaves.seen["rows"], hot_rows)
    return Components(mapping, rounds)


def grow_components(mapping: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> Components:
    """The components of an earlier ``mapping`` (as :class:`Components` has it) and more ``edges``,
    without the edges that the mapping came from: every id is replaced by its entity first, so only
    edges between entities, or to new ids, are contracted."""
    entity = mapping.select(F.col("txId").alias("_id"), F.col("resolvedEntityId").alias("_root"))

    def rooted(edges: DataFrame, end: str) -> DataFrame:
        hot = hot_keys(edges, end, hot_rows)
        named = lookup_join(edges, entity.withColumnRenamed("_id", end), end, "left", hot)
        return named.withColumn(end, F.coalesce("_root", end)).drop("_root")

    between = rooted(rooted(edges.select("src", "dst"), "src"), "dst")
    grown = contract_to_stars(between, hot_rows)
    moved = grown.mapping.select(F.col("txId").alias("_root"), F.col("resolvedEntityId").alias("_now"))
    old = lookup_join(entity, moved, "_root", "left", hot_keys(entity, "_root", hot_rows)).select(
        F.col("_id").alias("txId"), F.coalesce("_now", "_root").alias("resolvedEntityId")
    )
    new = grown.mapping.join(mapping.select("txId"), "txId", "left_anti")
    return Components(old.unionByName(new), grown.rounds)


def resolve_components(edges: DataFrame, hot_rows: int = HOT_ROWS) -> Components:
    """Map every id of ``edges`` to its entity, the smallest id it hangs together with."""
    return contract_to_stars(edges, hot_rows)
