"""Nearest-neighbour and radius joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.ordered import exact_quantiles
from sparkmine.functions.vectors import NARROW, distances, floor_terms, matrix, paired_squares, powers
from sparkmine.lineage import cut
from sparkmine.operators.blocks import (
    Block,
    build_blocks,
    choose_pivots,
    chunked_rows,
    every_pair,
    join_blocks,
    knn_reach,
    pairs_within,
)
from sparkmine.operators.grid import grid_for, join_cells


class _Best:
    """The ``k`` best candidates of every row of a block; new ones wait until there are as many, then all are ranked."""

    def __init__(self, n: int, k: int):
        self.far, self.near = np.full((n, k), np.inf), np.zeros((n, k), np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        if len(rows):
            self.new.append((rows, dist, ids))
            self.waiting += len(rows)
        if self.waiting >= self.far.size:
            self.rank()

    def rank(self) -> None:
        if not self.waiting:
            return
        k = self.far.shape[1]
        rows, dist, ids = (np.concatenate(part) for part in zip(*self.new))
        self.new, self.waiting = [], 0
        hit, at = np.unique(rows, return_inverse=True)
        # the candidates so far and the new ones of every row, the k best by distance and id
        row = np.concatenate([np.repeat(np.arange(len(hit)), k), at])
        dist = np.concatenate([self.far[hit].ravel(), dist])
        other = np.concatenate([self.near[hit].ravel(), ids])
        order = np.lexsort((other, dist, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(hit)))[row]
        best = order[place < k]
        self.far[hit], self.near[hit] = dist[best].reshape(-1, k), other[best].reshape(-1, k)


Candidates = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]  # rows of one block, rows of the other, powers


def _compared(a: Block, b: Block, open_: np.ndarray, far: np.ndarray, k: int, p: int, skip: bool) -> Candidates:
    """Pairs that may be among the ``k`` nearest of the ``open_`` rows of ``a``, from the distances of all pairs."""
    for s in chunked_rows(len(open_), len(b.ids)):
        own = open_[s]
        d = powers(a.xs[own], b.xs, p)
        limit = far[own] ** 2 * (1 + 1e-12) if p == 2 else far[own]
        blank = np.isinf(limit)
        if blank.any() and d.shape[1] > k:  # no k candidates yet: the k-th of this block is the limit
            if skip:
                d[a.tags[own][:, None] == b.tags[None, :]] = np.inf
            limit = np.where(blank, np.partition(d, k - 1, axis=1)[:, k - 1], limit)
        found = np.flatnonzero(d <= limit[:, None])
        rows, cols = own[found // d.shape[1]], found % d.shape[1]
        reached = d.ravel()[found]
        keep = np.isfinite(reached)
        if skip:
            keep &= a.tags[rows] != b.tags[cols]
        yield rows[keep], cols[keep], reached[keep]


def _sifted(a: Block, b: Block, open_: np.ndarray, far: np.ndarray, k: int, p: int, skip: bool) -> Candidates:
    """The same pairs of wide rows: floors of all squares in single precision, squares of the pairs whose floor is within the limit."""
    ours, theirs = open_[np.isfinite(a.xs[open_]).all(axis=1)], np.flatnonzero(np.isfinite(b.xs).all(axis=1))
    if not len(ours) or not len(theirs):  # other rows are at no finite distance
        return
    xs = b.xs[theirs]
    terms = floor_terms(a.xs[ours], xs)
    if terms is None:
        yield from _compared(a, b, open_, far, k, p, skip)
        return
    f, g, scale = terms
    tags = b.tags[theirs]
    for s in chunked_rows(len(ours), len(theirs), 1 << 18):
        own = ours[s]
        low = f[s] @ g
        limit = far[own] ** 2 * (1 + 1e-12)
        blank = np.flatnonzero(np.isinf(limit))
        if len(blank) and low.shape[1] > k:  # no k candidates yet: the farthest of the k with the lowest floors is the limit
            some = low[blank]
            if skip:
                some[a.tags[own[blank]][:, None] == tags[None, :]] = np.inf
            first = np.argpartition(some, k - 1, axis=1)[:, :k]
            top = paired_squares(a.xs, xs, np.repeat(own[blank], k), first.ravel()).reshape(-1, k)
            limit[blank] = np.where(np.isfinite(np.take_along_axis(some, first, axis=1)), top, np.inf).max(axis=1)
        with np.errstate(over="ignore"):
            most = np.nextafter((limit / scale).astype(np.float32), np.float32(np.inf))
        found = np.flatnonzero(low <= most[:, None])
        rows, cols = own[found // low.shape[1]], found % low.shape[1]
        if skip:
            other = a.tags[rows] != tags[cols]
            rows, cols = rows[other], cols[other]
        reached = paired_squares(a.xs, xs, rows, cols)
        keep = reached <= limit[np.searchsorted(own, rows)]
        keep &= np.isfinite(reached)
        yield rows[keep], theirs[cols[keep]], reached[keep]


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    *,
    id_col: str,
    x_col: str,
    k: int,
    p: int = 2,
    skip_same: str | None = None,
) -> DataFrame:
    """The ``k`` nearest corpus rows of each query: ``(id, neighbor, distance, rank)``.

    Ties go to the smaller neighbour id. With ``skip_same`` a corpus row is ignored
    when it shares that column's value with the query (the id for a self join, a
    fold number for cross-validation). Exact: corpus cells are skipped only when the
    triangle inequality rules them out.
    """
    self_join = skip_same == id_col
    tag = None if self_join else skip_same
    # Only the first copies of one vector can be among anyone's k nearest; the rank
    # limit is applied before the shuffle, so a hot group of copies stays small.
    copy_key = [x_col] + ([tag] if tag else [])
    keep = k + 1 if self_join else k
    w = Window.partitionBy(*copy_key).orderBy(id_col)
    firsts = corpus.withColumn("_copy", F.row_number().over(w)).filter(F.col("_copy") <= keep).drop("_copy")
    pivots = choose_pivots(corpus, id_col, x_col)
    q = build_blocks(queries, id_col, x_col, pivots=pivots, tag=tag, p=p)
    c = build_blocks(firsts, id_col, x_col, pivots=pivots, tag=tag, p=p)
    skip = skip_same is not None

    def nearest(a: Block, b: Block) -> None:
        if not len(a.ids) or not len(b.ids):
            return
        if a.kept is None:
            a.kept = _Best(len(a.ids), k)
        best = a.kept
        middle = b.xs.mean(axis=0, keepdims=True)
        out_to = distances(b.xs, middle, p).max()
        # only rows whose candidates the block may improve; NaN compares as it may
        open_ = np.flatnonzero(~(distances(a.xs, middle, p)[:, 0] - out_to > best.far[:, -1] * (1 + 1e-9) + 1e-9))
        sift = _sifted if p == 2 and a.xs.shape[1] > NARROW else _compared
        for rows, cols, reached in sift(a, b, open_, best.far[:, -1], k, p, skip):
            best.add(rows, np.sqrt(reached) if p == 2 else reached, b.ids[cols])

    def closest(a: Block) -> pd.DataFrame:
        if a.kept is None:
            return pd.DataFrame({"id": [], "neighbor": [], "distance": []})
        a.kept.rank()
        far, near = a.kept.far, a.kept.near
        rows, cols = np.nonzero(np.isfinite(far))
        return pd.DataFrame({"id": a.ids[rows], "neighbor": near[rows, cols], "distance": far[rows, cols]})

    found = join_blocks(
        q, c, pairs_within(q, c, knn_reach(q, c, k)), nearest, "id bigint, neighbor bigint, distance double", tell=closest
    )
    best = Window.partitionBy("id").orderBy("distance", "neighbor")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("id", "neighbor", "distance", F.col("rank").cast("int").alias("rank"))
    )


def k_nearest(df: DataFrame, *, id_col: str, x_col: str, k: int, p: int = 2) -> DataFrame:
    """``k`` nearest *other* rows of every row."""
    return knn_join(df, df, id_col=id_col, x_col=x_col, k=k, p=p, skip_same=id_col)


def distance_profile(df: DataFrame, *, id_col: str, x_col: str, p: int = 2) -> DataFrame:
    """All-pairs distances, reduced per row: ``(id, n_others, sum, min, max, mean)``.

    Every pair is computed, but a block pair only sends one row per id.
    """
    b = build_blocks(df, id_col, x_col, pivots=np.zeros((0, 0)), p=p)

    def summarise(q: Block, c: Block) -> pd.DataFrame:
        parts = []
        for s in chunked_rows(len(q.ids), len(c.ids)):
            d = distances(q.xs[s], c.xs, p)
            own = q.ids[s][:, None] == c.ids[None, :]
            parts.append(pd.DataFrame({
                "id": q.ids[s], "n": (~own).sum(axis=1), "total": np.where(own, 0.0, d).sum(axis=1),
                "low": np.where(own, np.inf, d).min(axis=1), "high": np.where(own, -np.inf, d).max(axis=1),
            }))
        return pd.concat(parts, ignore_index=True)

    tiles = join_blocks(b, b, every_pair(b, b), summarise,
                        "id bigint, n bigint, total double, low double, high double",
                        lambda d: d.groupby("id", as_index=False).agg({"n": "sum", "total": "sum", "low": "min", "high": "max"}))
    return tiles.groupBy("id").agg(
        F.sum("n").alias("n_others"), F.sum("total").alias("sum_distance"), F.min("low").alias("min_distance"),
        F.max("high").alias("max_distance"), (F.sum("total") / F.sum("n")).alias("mean_distance"),
    ).select(
        "id", "n_others", "sum_distance",
        *[F.when(F.col("n_others") > 0, F.col(c)).alias(c) for c in ("min_distance", "max_distance", "mean_distance")],
    )


def nearest_center(df: DataFrame, centers: Sequence[Sequence[float]], *, x_col: str, p: int = 2,
                   into: tuple[str, str] = ("cluster", "distance")) -> DataFrame:
    """Add the index of the nearest centre (lowest index on ties) and its distance."""
    points = np.array(centers, dtype=float)

    @F.arrow_udf("struct<cluster:int,distance:double>")
    def assign(x: pa.Array) -> pa.Array:
        d = distances(matrix(x), points, p) if len(x) else np.zeros((0, len(points)))
        cluster = d.argmin(axis=1).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(cluster), pa.array(d[np.arange(len(d)), cluster])], names=["cluster", "distance"]
        )

    return df.withColumn("_a", assign(F.col(x_col).cast("array<double>"))).select(
        *df.columns, F.col("_a.cluster").alias(into[0]), F.col("_a.distance").alias(into[1])
    )


def radius_profile(df: DataFrame, *, id_col: str, x_col: str, eps: float, p: int = 2,
                   weight: str | None = None) -> DataFrame:
    """Rows within ``eps`` (inclusive) of each row, itself excluded.

    ``(id, n_neighbors, first_neighbor, last_neighbor, sum_distance)``: the
    neighbourhood is summarised per block pair instead of listed, since inside a
    dense group the list would hold every pair.
    """
    rows = cut(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x"),
                         (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")))
    grid = grid_for(rows, "x", eps)
    b = grid.blocks(rows, "id", "x", val="w")

    def count(q: Block, c: Block) -> pd.DataFrame:
        parts = []
        for s in chunked_rows(len(q.ids), len(c.ids)):
            d = distances(q.xs[s], c.xs, p)
            near = (d <= eps) & (q.ids[s][:, None] != c.ids[None, :])
            hit = near.any(axis=1)
            near, ids = near[hit], q.ids[s][hit]
            order = np.argsort(c.ids)
            ranked, sorted_ids = near[:, order], c.ids[order]
            parts.append(pd.DataFrame({
                "id": ids, "n": near @ c.vals, "first": sorted_ids[ranked.argmax(axis=1)],
                "last": sorted_ids[len(sorted_ids) - 1 - ranked[:, ::-1].argmax(axis=1)],
                "total": np.where(near, d[hit], 0.0).sum(axis=1),
            }))
        return pd.concat(parts, ignore_index=True)

    found = join_cells(b, b, grid.width, count, "id bigint, n double, first bigint, last bigint, total double",
                       lambda d: d.groupby("id", as_index=False).agg({"n": "sum", "first": "min", "last": "max", "total": "sum"}))
    summed = found.groupBy("id").agg(
        F.sum("n").alias("n"), F.min("first").alias("first_neighbor"), F.max("last").alias("last_neighbor"),
        F.sum("total").alias("total"),
    )
    return rows.select("id").join(summed, "id", "left").select(
        "id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_neighbors"), "first_neighbor", "last_neighbor",
        F.coalesce("total", F.lit(0.0)).alias("sum_distance"),
    )


def k_distance(df: DataFrame, *, id_col: str, x_col: str, min_pts: int, p: int = 2) -> DataFrame:
    """Distance to the ``min_pts - 1``-th other row: ``(id, k_distance)``.

    A row counts as its own first neighbour here, unlike in the density clustering.
    """
    nn = k_nearest(df, id_col=id_col, x_col=x_col, k=min_pts - 1, p=p)
    return nn.filter(F.col("rank") == min_pts - 1).select("id", F.col("distance").alias("k_distance"))


def k_distance_percentiles(kdist: DataFrame, qs: Sequence[float] = (0.25, 0.5, 0.75, 0.9)) -> list[float]:
    return exact_quantiles(kdist, ["k_distance"], qs)[(None, "k_distance")]
