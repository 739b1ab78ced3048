"""Exact top-k inner-product search by columnar branch and bound.

Candidates are dealt into blocks of bounded size and held vertically: one row of a block's matrix
is one dimension of all its vectors. For a query the distances grow dimension block by dimension
block. After each, Cauchy-Schwarz on the mass that remains in query and candidate bounds what the
rest can add; candidates that cannot reach the k-th best score any more are compacted away.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Vectors in one block of candidates, and queries in one block of queries.
CANDIDATE_ROWS = 16_384
QUERY_ROWS = 1_024
# Dimensions added between two prunings.
DIMENSIONS = 8
# Queries whose first dimension block is multiplied together.
TOGETHER = 32
LONG = np.iinfo(np.int64)

_BLOCK = "block int, ids binary, sizes binary, numbers binary, width int"
_FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) for each component; beyond the range of long it saturates."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(math.inf), F.lit(False))
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _pack(block: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: ids ascending, sizes, all components in the narrowest integers.
    Of rows with the same id the one with the smallest vector stays."""
    rows = sorted(zip(block["id"], map(tuple, block["vector"])))
    rows = [r for r, before in zip(rows, [None, *rows]) if before is None or before[0] != r[0]]
    numbers = np.array([x for _, vector in rows for x in vector], np.int64)
    reach = max(abs(int(numbers.min())), abs(int(numbers.max()))) if len(numbers) else 0
    width = next((w for w in (1, 2, 4) if reach < 1 << (8 * w - 1)), 8)
    return pd.DataFrame(
        {
            "block": [int(block["block"].iloc[0])],
            "ids": [np.array([i for i, _ in rows], np.int64).tobytes()],
            "sizes": [np.array([len(v) for _, v in rows], np.int32).tobytes()],
            "numbers": [numbers.astype(f"i{width}").tobytes()],
            "width": [width],
        }
    )


def _unpack(row) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix (a vector a row) for each number of dimensions."""
    ids, sizes = np.frombuffer(row.ids, np.int64), np.frombuffer(row.sizes, np.int32)
    numbers = np.frombuffer(row.numbers, f"i{row.width}").astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    found = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        matrix = numbers[starts[at][:, None] + np.arange(size)[None, :]]
        found[int(size)] = ids[at], matrix
    return found


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _exact_scores(queries, matrix):
    """Inner products beyond 53 bits, by Python's integers, saturated to long."""
    wide = queries.astype(object) @ matrix.T.astype(object)
    return np.clip(wide, LONG.min, LONG.max).astype(np.int64)


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    matrix: np.ndarray,
    k: int,
    dimensions: int = DIMENSIONS,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best among one block, its own id left out."""
    n, d = matrix.shape
    reach = float(np.abs(matrix).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if d == 0 or d * reach >= 2.0**53:
        for i, query_id in enumerate(query_ids):
            scores = _exact_scores(queries[i : i + 1], matrix)[0]
            others = np.flatnonzero(ids != query_id)
            # Not by negation: the smallest long has no positive counterpart.
            order = np.lexsort((ids[others], ~scores[others]))[:k]
            yield query_id, ids[others[order]], scores[others[order]]
        return

    # Heavy dimensions first: the mass that remains then falls fastest.
    order = np.argsort(-(matrix.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    columns = np.ascontiguousarray(matrix[:, order].T, np.float64)
    queries = np.ascontiguousarray(queries[:, order], np.float64)
    starts = list(range(0, d, dimensions))
    mass = np.add.reduceat(columns**2, starts, axis=0)
    mass = np.sqrt(np.cumsum(mass[::-1], axis=0)[::-1])
    own = np.sqrt(np.cumsum(np.add.reduceat(queries**2, starts, axis=1)[:, ::-1], axis=1)[:, ::-1])
    seeds = min(n, 4 * k)
    for first in range(0, len(query_ids), TOGETHER):
        some = queries[first : first + TOGETHER]
        begun = some[:, :dimensions] @ columns[:dimensions]
        for i, query in enumerate(some, first):
            partial = begun[i - first]
            partial[ids == query_ids[i]] = -np.inf
            tried = np.argpartition(-partial, seeds - 1)[:seeds]
            tried = tried[partial[tried] > -np.inf]
            least = -np.inf
            if len(tried) >= k:
                scores = query @ columns[:, tried]
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
            alive = np.flatnonzero(partial > -np.inf)
            partial = partial[alive]
            for j, start in enumerate(starts):
                if j:
                    block = columns[start : start + dimensions]
                    partial = partial + query[start : start + dimensions] @ block[:, alive]
                if j + 1 < len(starts):
                    # The slack covers rounding of the bound; partial sums are exact.
                    bound = partial + own[i, j + 1] * mass[j + 1][alive] * (1 + 1e-9) + 1e-6
                    stays = bound >= least
                    alive, partial = alive[stays], partial[stays]
            chosen = _best(ids[alive], partial, k)
            yield query_ids[i], ids[alive[chosen]], partial[chosen].astype(np.int64)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row that meets
    ``is_query`` the k other rows with the highest inner product of quantised components, all if
    there are fewer; equal scores go by the smaller id.

    Query blocks meet candidate blocks, both of bounded size, so a task holds one of each
    whatever the table's size; what is sent is bounded by k rows a query and block.

    Vectors that are null, hold a null, NaN or infinite component, or have no id take no part.
    Of several rows with the same id one takes part, that with the smallest vector. Only vectors
    of equal length are compared; an empty vector scores 0 with other empty ones. Components
    and scores beyond the range of long saturate. No rows give no rows. Other columns are not read.
    """
    rows = vectors.where(F.col(id_column).isNotNull() & usable(F.col(vector_column)))
    asked = vectors.where(is_query)
    blocks = max(1, math.ceil(vectors.count() / candidate_rows))
    query_blocks = max(1, math.ceil(asked.count() / query_rows))

    def packed(table: DataFrame, count: int, seed: int) -> DataFrame:
        key = F.col(id_column).cast("long")
        dealt = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(count)).cast("int")
        return (
            table.select(
                dealt.alias("block"),
                key.alias("id"),
                quantised(F.col(vector_column), scale).alias("vector"),
            )
            .groupBy("block")
            .applyInPandas(_pack, _BLOCK)
        )

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    candidates = packed(rows, blocks, 1).withColumn("other", every(query_blocks))
    queries = packed(rows.where(is_query), query_blocks, 2).select(
        every(blocks).alias("block"), F.col("block").alias("other"), "ids", "sizes", "numbers", "width"
    )

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            held = _unpack(candidates.iloc[0])
            for size, (query_ids, wanted) in _unpack(queries.iloc[0]).items():
                if size in held:
                    found += search_block(query_ids, wanted, *held[size], k)
        return pd.DataFrame(
            {
                "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64),
                "vec_id": np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)]),
                "score": np.concatenate([np.zeros(0, np.int64), *(f[2] for f in found)]),
            }
        )

    near = (
        queries.groupBy("block", "other")
        .cogroup(candidates.groupBy("block", "other"))
        .applyInPandas(search, _FOUND)
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
