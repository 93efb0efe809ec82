"""Nearest neighbours by a block matrix join: int8 tiles bound the distances, doubles settle them."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcredit.llm.common import group_arrow

NEAREST = 10
#: Rows of a block of queries and of a block of candidates, on average.
QUERY_ROWS = 1_024
CANDIDATE_ROWS = 8_192
#: Candidates of one tile.
TILE = 2_048
#: Slack for the rounding of the bounds themselves, relative to the numbers they are made of.
ROUNDING = 1e-5


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite throughout and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, the squared length of the coded row and the length of the error."""
    peak = np.abs(vectors).max(axis=1)
    scale = peak / 127
    scale[scale == 0] = 1  # of the smallest numbers: all codes are zero, the error is the vector itself
    codes = np.clip(np.rint(vectors / scale[:, None]), -127, 127)
    coded = codes * scale[:, None]
    with np.errstate(over="ignore"):
        error = np.sqrt(((vectors - coded) ** 2).sum(axis=1))
        return codes.astype(np.int8), scale, (coded**2).sum(axis=1), error


def tile_bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the distance of each row of a to each row of b, from their int8 codes.

    The distance of two vectors differs from that of their coded forms by the sum of their errors at
    most. Products of codes are whole numbers; in floats of 32 bits their sums are exact up to 2 ** 24.
    Where squares pass the range of doubles there is no bound: such pairs are never ruled out.
    """
    (qa, sa, la, ea), (qb, sb, lb, eb) = a, b
    exact = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        squares = la[:, None] + lb[None, :]
        inner = np.maximum(squares - 2 * (sa[:, None] * sb[None, :]) * product, 0)
        middle = np.sqrt(inner)
        slack = ea[:, None] + eb[None, :] + ROUNDING * np.sqrt(squares)
        lower, upper = np.maximum(middle - slack, 0), middle + slack
    bounded = np.isfinite(upper) & np.isfinite(lower)
    return np.where(bounded, lower, 0), np.where(bounded, upper, np.inf)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of a to the same row of b; squares are added in order, as SQL does."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        with np.errstate(over="ignore"):
            step = a[:, k] - b[:, k]
            total += step * step
    return np.sqrt(total)


def block_nearest(q_ids, queries, c_ids, candidates, k: int):
    """The k nearest candidates of each query: one heap per query takes the exact distances of the pairs
    that the bounds do not rule out, tile by tile."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]  # of (-distance, -id): the worst on top
    limit = np.full(len(q_ids), np.inf)
    coded = quantise(queries)
    for first in range(0, len(c_ids), TILE):
        rows = candidates[first : first + TILE]
        ids = c_ids[first : first + TILE]
        lower, upper = tile_bounds(coded, quantise(rows))
        own = q_ids[:, None] == ids[None, :]
        upper[own] = np.inf
        if len(ids) > k:
            # No candidate beyond the k-th smallest upper bound can be among the k nearest.
            limit = np.minimum(limit, np.partition(upper, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((lower <= limit[:, None]) & ~own)
        for begin in range(0, len(i), 1 << 16):
            a, b = i[begin : begin + (1 << 16)], j[begin : begin + (1 << 16)]
            distance = distances(queries[a], rows[b])
            for row, d, name in zip(a.tolist(), distance.tolist(), ids[b].tolist(), strict=True):
                heap = heaps[row]
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -name))
                elif (-d, -name) > heap[0]:
                    heapq.heapreplace(heap, (-d, -name))
        full = [h for h, heap in enumerate(heaps) if len(heap) == k]
        limit[full] = np.minimum(limit[full], [-heaps[h][0][0] for h in full])
    return heaps


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block, one row for each id: of several rows the smallest vector."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(ids), -1)
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*vectors.T[::-1], ids))
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        ids, vectors = ids[order], vectors[order]
    return ids, vectors


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = NEAREST,
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """The k rows with the smallest Euclidean distance to each query row, exactly.

    Queries are the rows that meet `is_query`, candidates all rows with another id; both in blocks. Each
    block of queries meets each block of candidates once: queries are dealt to the columns of a grid,
    candidates to its rows, and a cell of the grid holds one block of each. Blocks are of bounded size
    and cut by a hash of the id, so equal vectors spread. In a cell int8 products give bounds of the
    distance, pairs within them are measured in double precision, and a heap per query merges them; the
    best of each cell are merged by a ranked window that keeps k rows per task before its shuffle.

    Rows whose vector is null, empty, zero or not finite throughout take no part, nor do rows without
    an id; vectors of different length never meet. Of several rows with one id and length the one with the
    smallest vector counts, and a query is never its own neighbour. Returns query_id, rank (from 1, ties to the smaller id), vec_id
    and score; queries with fewer than k candidates have fewer rows. Other columns are not carried.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("dim", F.size("vector"))
    asked, there = rows.agg(F.count_if("asks"), F.count(F.lit(1))).first()
    columns, lines = max(1, -(-asked // query_rows)), max(1, -(-there // candidate_rows))
    queries = (
        rows.where("asks")
        .withColumn("column", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(columns)))
        .withColumn("line", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lines - 1).cast("long"))))
    )
    candidates = rows.withColumn("line", F.pmod(F.xxhash64("vec_id"), F.lit(lines))).withColumn(
        "column", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long")))
    )

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            (q_ids, q), (c_ids, c) = _matrix(left), _matrix(right)
            heaps = block_nearest(q_ids, q, c_ids, c, k)
            out = [(int(i), -name, -d) for i, heap in zip(q_ids, heaps, strict=True) for d, name in heap]
        ids, names, scores = zip(*out, strict=True) if out else ((), (), ())
        return pa.table(
            {
                "query_id": pa.array(ids, pa.int64()),
                "vec_id": pa.array(names, pa.int64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    key = ("dim", "column", "line")
    best = group_arrow(
        queries.select(*key, "vec_id", "vector"),
        candidates.select(*key, "vec_id", "vector"),
        key,
        cell,
        "query_id long, vec_id long, score double",
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
