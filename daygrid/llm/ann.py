"""Approximate nearest neighbours: collision counting over single projections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.vectors import matrix, usable_rows

#: Projections, each with an array sorted by its values.
PROJECTIONS = 64
#: First half-width of a query's window in units of the data's scale, and its growth by round.
WIDTH, GROWTH = 0.9, 1.15
#: Share of the projections whose windows must hold a vector before it is verified.
COLLISIONS = 0.75
#: A block's search ends once this share of its distinct vectors, and no fewer than k, was verified.
VERIFIED = 0.3
#: Vectors and queries of a block; places in a block of vectors are 16-bit numbers.
BLOCK, QUERIES = 8_192, 1_024


def _lifted(x: np.ndarray, bound: float) -> np.ndarray:
    """One more component that makes all norms equal, so near means large inner product."""
    rest = np.sqrt(np.maximum(bound * bound - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _projections(rng: np.random.Generator, width: int) -> np.ndarray:
    """Random directions, orthogonal as far as the width allows, so that each counts for itself."""
    made = [np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(-(-PROJECTIONS // width))]
    return np.hstack(made)[:, :PROJECTIONS] * np.sqrt(width)


def _inner_products(
    points: np.ndarray, query: np.ndarray, k: int, longest: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may be among the k nearest, and their inner products.

    A matrix product's rounding depends on a row's place, so equal vectors could differ in it.
    It only sorts out rows that are clearly farther; the sums that are returned don't depend
    on the place. No row is longer than ``longest``.
    """
    rows = np.arange(len(points))
    if len(points) > k:
        rough = points @ query
        slack = 1e-9 * longest * np.linalg.norm(query)
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        rows = rows[~(rough < least - slack)]
    return rows, (points[rows] * query).sum(axis=1)


def collision_candidates(
    points: np.ndarray, queries: np.ndarray, k: int, seed: int = 5
) -> Iterator[np.ndarray]:
    """For each query the rows of ``points`` that collide often enough to be verified.

    A window around the query's value grows in every sorted array by virtual rehashing; a
    vector's collisions are the windows that hold its place in the sorted arrays.
    """
    rng = np.random.default_rng(seed)
    n, width = points.shape
    scale = np.abs(points).max() or 1.0
    points, queries = points / scale, queries / scale
    bound = np.sqrt((points * points).sum(axis=1).max())
    norms = np.linalg.norm(queries, axis=1, keepdims=True)
    aimed = queries / np.where(norms > 0, norms, 1) * bound  # a query's length changes no order
    lines = _projections(rng, width + 1)
    values = _lifted(points, bound) @ lines
    order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
    sorted_values = np.take_along_axis(values, order, axis=0)
    arrays = np.ascontiguousarray(sorted_values.T)
    places = np.empty((PROJECTIONS, n), dtype=np.uint16)  # of every vector in every sorted array
    np.put_along_axis(places, order.T, np.arange(n, dtype=np.uint16)[None, :], axis=1)
    centres = np.hstack([aimed, np.zeros((len(aimed), 1))]) @ lines
    needed, enough = COLLISIONS * PROJECTIONS, min(n, max(k, int(np.ceil(VERIFIED * n))))
    radius = WIDTH * (bound or 1.0)
    limits = []
    while True:
        half = radius * GROWTH ** len(limits)
        low = [np.searchsorted(a, centres[:, p] - half) for p, a in enumerate(arrays)]
        high = [np.searchsorted(a, centres[:, p] + half, "right") for p, a in enumerate(arrays)]
        begin, size = np.array(low), np.array(high) - np.array(low)
        limits.append((begin.astype(np.uint16), size.astype(np.uint16)))
        if (size == n).all():
            break
    for q in range(len(queries)):
        # Collisions only grow with the windows, so halving finds the first round with enough.
        low, high, found = 0, len(limits) - 1, None
        while low < high or found is None:
            middle = (low + high) // 2
            begin, size = limits[middle]
            # Places before a window wrap around to large numbers, so one comparison is enough.
            inside = places - begin[:, q, None] < size[:, q, None]
            near = np.nonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8) >= needed)[0]
            if len(near) >= enough or low == high:
                high, found = middle, near
            else:
                low = middle + 1
        yield found


class _Classes:
    """Distinct vectors of a block, and for each the ``most`` rows of smallest id that have it."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, most: int):
        keys = np.ascontiguousarray(points + 0.0)  # no negative zeros
        _, first, kind = np.unique(
            keys.view(np.dtype((np.void, keys.shape[1] * keys.itemsize))).ravel(),
            return_index=True, return_inverse=True,
        )
        self.points, self.kind = keys[first], kind
        self.sizes = np.bincount(kind, minlength=len(first))
        by_id = np.lexsort((ids, kind))
        begins = np.cumsum(self.sizes) - self.sizes
        rank = np.arange(len(kind)) - begins[kind[by_id]]
        self.rows = by_id[rank < most]
        self.held = np.minimum(self.sizes, most)
        self.begins = np.cumsum(self.held) - self.held

    def expand(self, classes: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the classes, and the score of each."""
        counts = self.held[classes]
        shift = self.begins[classes] - (np.cumsum(counts) - counts)
        return self.rows[np.repeat(shift, counts) + np.arange(counts.sum())], np.repeat(scores, counts)


def _search(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, rows = left["vec_id"].to_numpy(), left["row"].to_numpy()
            by_width = left["v"].map(len)
            for width, asked in right.groupby(right["v"].map(len)):
                here = (by_width == width).to_numpy()
                if not here.any():
                    continue
                points, queries = matrix(left["v"][here]), matrix(asked["v"])
                own_ids, own_rows = ids[here], rows[here]
                longest = np.linalg.norm(points, axis=1).max()
                # Copies count once in the search. A query's own row is one of k + 1 at most.
                distinct = _Classes(points, own_ids, k + 1)
                place = {row: at for at, row in enumerate(own_rows.tolist())}
                found = collision_candidates(distinct.points, queries, k + 1)
                for query_id, query_row, query, near in zip(
                    asked["vec_id"], asked["row"], queries, found, strict=True
                ):
                    own = distinct.kind[place[query_row]] if query_row in place else -1
                    if own >= 0 and distinct.sizes[own] == 1:
                        near = near[near != own]
                    close, scores = _inner_products(distinct.points[near], query, k, longest)
                    near, scores = distinct.expand(near[close], scores)
                    others = own_rows[near] != query_row
                    near, scores = near[others], scores[others]
                    best = np.lexsort((own_ids[near], -scores))[:k]
                    count = len(best)
                    out.append(
                        (np.full(count, query_row), np.full(count, query_id), own_ids[near][best], scores[best])
                    )
        names = {"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * len(names)
        return pd.DataFrame(dict(zip(names, columns, strict=True))).astype(names)

    return run


def nearest(
    frame: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id ``every`` divides its k nearest found.

    Nearness is the inner product of the original vectors in double precision; ties go to the
    smaller vec_id. Vectors that are null, zero or hold null or non-finite components, and
    rows without an id, take no part; vectors of unequal length never meet. A row that repeats
    an id is a query and a candidate of its own. Equal vectors of a block are searched once. Fewer candidates than k give fewer rows.
    Queries and vectors are split into blocks of bounded size by a hash of row and id; each
    pair of a vector block and a query block is a task, and only k rows of it go on.
    """
    rows = (
        usable_rows(frame, id_col, vector_col)
        .where("vec_id is not null")
        .withColumn("row", F.monotonically_increasing_id())
    )
    asked = rows.where(F.col("vec_id") % every == 0)
    sizes = rows.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")
    ).first()
    blocks = max(1, -(-sizes["n"] // BLOCK))
    query_blocks = max(1, -(-sizes["q"] // QUERIES))

    def block(count):
        return F.pmod(F.xxhash64("vec_id", "row"), F.lit(count)).cast("int")

    def numbers(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    points = rows.withColumn("b", block(blocks)).withColumn("q", numbers(query_blocks))
    queries = asked.withColumn("q", block(query_blocks)).withColumn("b", numbers(blocks))
    found = (
        points.groupBy("b", "q")
        .cogroup(queries.groupBy("b", "q"))
        .applyInPandas(_search(k), "query_row long, query_id long, vec_id long, score double")
    )
    nearest_first = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
