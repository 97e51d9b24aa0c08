"""Density clustering and its radius sweep."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.ordered import running_sums
from sparkmine.functions.vectors import distances
from sparkmine.lineage import cut, scoped, small_table
from sparkmine.operators.blocks import Block, chunked_rows
from sparkmine.operators.cluster_quality import scores
from sparkmine.operators.components import connected_components, number_by_order
from sparkmine.operators.grid import grid_for, join_cells
from sparkmine.operators.neighbors import k_distance_percentiles, k_nearest

NOISE = 0


def _forest(n: int, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest connected node for each of ``n`` nodes of a task-local edge list."""
    root = np.arange(n)
    while len(rows):
        left, right = root[rows], root[cols]
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while (root[root] != root).any():
            root = root[root]
        apart = root[rows] != root[cols]
        rows, cols = rows[apart], cols[apart]
    return np.arange(n), root


def dbscan(df: DataFrame, *, id_col: str, x_col: str, eps: float, min_pts: int) -> DataFrame:
    """``(id, cluster, is_core)``; noise is cluster 0, clusters count from 1.

    A core row has at least ``min_pts`` *other* rows within ``eps``. Clusters are
    the components of core rows, numbered by their smallest core id; a border row
    takes the smallest cluster that reaches it.

    Copies of a vector are one weighted point while comparing. A block pair yields
    neighbour counts, a spanning forest of its core points, or the smallest cluster
    in reach, never the pairs themselves.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x"))
    points = cut(rows.groupBy("x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")))
    grid = grid_for(points, "x", eps)
    all_blocks = grid.blocks(points, "rep", "x", val="w")

    def count(q: Block, c: Block) -> pd.DataFrame:
        parts = []
        for s in chunked_rows(len(q.ids), len(c.ids)):
            parts.append(pd.DataFrame({"rep": q.ids[s], "n": (distances(q.xs[s], c.xs) <= eps) @ c.vals}))
        return pd.concat(parts, ignore_index=True)

    weights = join_cells(all_blocks, all_blocks, grid.width, count, "rep bigint, n double",
                         lambda d: d.groupby("rep", as_index=False).agg({"n": "sum"})).groupBy("rep").agg(
        (F.sum("n") - 1).alias("others")
    )
    core = cut(points.join(weights.filter(F.col("others") >= min_pts), "rep").select("rep", "x"))
    if core.isEmpty():
        return rows.select("id", F.lit(NOISE).alias("cluster"), F.lit(False).alias("is_core"))

    core_blocks = grid.blocks(core, "rep", "x")

    def forest(q: Block, c: Block) -> pd.DataFrame:
        ids = np.concatenate([q.ids, c.ids])
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        rows_, cols_ = [], []
        node, root = np.arange(len(ids)), np.arange(len(ids))
        for s in chunked_rows(len(q.ids), len(c.ids)):
            r, k = np.nonzero(distances(q.xs[s], c.xs) <= eps)
            rows_ = np.concatenate([node, place[: len(q.ids)][s][r]])
            cols_ = np.concatenate([root, place[len(q.ids):][k]])
            node, root = _forest(len(ids), rows_, cols_)
        sorted_ids = ids[order]
        return pd.DataFrame({"a": sorted_ids[node], "b": sorted_ids[root]}).query("a != b")

    linked = connected_components(join_cells(core_blocks, core_blocks, grid.width, forest, "a bigint, b bigint", symmetric=True))
    roots = core.select(F.col("rep").alias("id")).join(linked, "id", "left").select(
        F.col("id").alias("rep"), F.coalesce("root", "id").alias("root")
    )
    numbered = cut(
        roots.join(number_by_order(roots, "root"), "root").select("rep", F.col("number").alias("cluster")).join(core, "rep")
    )

    border = points.join(core.select("rep"), "rep", "left_anti")
    q = grid.blocks(border, "rep", "x")
    c = grid.blocks(numbered, "rep", "x", tag="cluster")

    def reach(a: Block, b: Block) -> pd.DataFrame:
        parts = []
        far = np.iinfo(np.int64).max
        for s in chunked_rows(len(a.ids), len(b.ids)):
            low = np.where(distances(a.xs[s], b.xs) <= eps, b.tags[None, :], far).min(axis=1)
            parts.append(pd.DataFrame({"rep": a.ids[s], "cluster": low})[low < far])
        return pd.concat(parts, ignore_index=True)

    reached = join_cells(q, c, grid.width, reach, "rep bigint, cluster bigint",
                         lambda d: d.groupby("rep", as_index=False).agg({"cluster": "min"})).groupBy(
        "rep").agg(F.min("cluster").alias("cluster"))
    labels = (
        numbered.select("x", F.col("cluster").cast("int").alias("cluster"), F.lit(True).alias("is_core"))
        .union(border.join(reached, "rep", "left").select(
            "x", F.coalesce(F.col("cluster").cast("int"), F.lit(NOISE)), F.lit(False)))
    )
    return rows.join(labels, "x").select("id", "cluster", "is_core")


def _levels_of(block: Block, other: Block, radii: np.ndarray):
    """Pairs of two blocks by level, some rows at a time: slices of ``block`` with the first radius that covers each pair."""
    for s in chunked_rows(len(block.ids), len(other.ids)):
        yield s, np.searchsorted(radii, distances(block.xs[s], other.xs), side="left")


def _joined(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots after joining ``u`` with ``v``, and the edges between former roots that do it."""
    a, b = root[u], root[v]
    apart = a != b
    if not apart.any():
        return root, u[:0], u[:0]
    _, new = _forest(len(root), a[apart], b[apart])
    moved = np.flatnonzero((root == np.arange(len(root))) & (new != root))
    return new[root], moved, new[moved]


def reachability(points: DataFrame, radii: Sequence[float]) -> DataFrame:
    """A spanning forest by mutual reachability: ``(a, b, level, border)``, from one comparison at the largest radius.

    ``points`` is ``(rep, x, level)``: the first radius at which a point is core, or their number if it never is. Two cores
    are joined from the level on at which both are core and the radius covers them (``border`` false): the edges up to
    a level connect what the radius of that level connects. A point that is not core yet reaches core ``b`` from the
    level on (``border`` true). A block pair keeps a forest of its cores and one edge for each tree that a point reaches.
    """
    steps = np.asarray(radii, dtype=float)
    never = len(steps)
    grid = grid_for(points, "x", float(steps[-1]))
    blocks = grid.blocks(points, "rep", "x", tag="level")

    def compare(q: Block, c: Block) -> pd.DataFrame:
        ids, place = np.unique(np.concatenate([q.ids, c.ids]), return_inverse=True)
        at_q, at_c = place[:len(q.ids)], place[len(q.ids):]
        n = len(ids)
        forest = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in steps]
        reached: list[set[int]] = [set() for _ in steps]
        for s, near in _levels_of(q, c, steps):
            both = np.maximum(np.maximum(near, q.tags[s][:, None]), c.tags[None])
            root, roots = np.arange(n), []
            for level in range(never):
                row, col = np.nonzero(both == level)
                u = np.concatenate([forest[level][0], at_q[s][row]])
                v = np.concatenate([forest[level][1], at_c[col]])
                root, one, two = _joined(root, u, v)
                forest[level] = (one, two)
                roots.append(root)
            for own, core, core_at, own_tags, core_tags, flip in ((at_q[s], c, at_c, q.tags[s], c.tags, False), (at_c, q, at_q[s], c.tags, q.tags[s], True)):
                from_level = np.maximum(near.T if flip else near, core_tags[None])
                from_level = np.where(from_level < own_tags[:, None], from_level, never)
                for level in range(never):
                    row, col = np.nonzero(from_level == level)
                    if len(row):
                        reached[level].update((own[row] * n + roots[level][core_at[col]]).tolist())
        parts = [pd.DataFrame({"a": ids[u], "b": ids[v], "level": level, "border": False}) for level, (u, v) in enumerate(forest)]
        before: np.ndarray = np.zeros(0, np.int64)
        root = np.arange(n)
        for level, some in enumerate(reached):
            root, _, _ = _joined(root, *forest[level])
            code = np.fromiter(some, dtype=np.int64, count=len(some))
            code = np.unique(code // n * n + root[code % n]) if len(code) else code
            before = np.unique(before // n * n + root[before % n]) if len(before) else before
            new = np.setdiff1d(code, before, assume_unique=True)
            parts.append(pd.DataFrame({"a": ids[new // n], "b": ids[new % n], "level": level, "border": True}))
            before = np.concatenate([before, new])
        return pd.concat(parts, ignore_index=True).astype({"level": "int32"})

    return join_cells(blocks, blocks, grid.width, compare, "a bigint, b bigint, level int, border boolean", symmetric=True)


def dbscan_levels(df: DataFrame, *, id_col: str, x_col: str, radii: Sequence[float], min_pts: int, core_distance: DataFrame | None = None) -> DataFrame:
    """``(id, level, cluster)`` for every row and every radius (ascending), as ``dbscan`` labels it at that radius.

    ``core_distance`` ``(id, distance)`` is the distance to the ``min_pts``-th other row; a row without one is never core.
    All radii are cuts of one forest: one comparison of the rows, one component search and one numbering serve them all.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x"))
    if core_distance is None:
        core_distance = k_nearest(df, id_col=id_col, x_col=x_col, k=min_pts).filter(F.col("rank") == min_pts).select("id", "distance")
    never = len(radii)
    level = F.when(F.col("distance").isNull(), never).otherwise(sum(((F.col("distance") > r).cast("int") for r in radii), F.lit(0)))
    points = cut(rows.join(core_distance, "id", "left").groupBy("x").agg(F.min("id").alias("rep"), F.min(level).cast("int").alias("level")))
    edges = cut(reachability(points, radii))
    upto = lambda last: F.explode(F.sequence(F.col("level"), last)).alias("at")
    joined = edges.filter("NOT border").select("a", "b", upto(F.lit(never - 1))).select(
        F.struct("at", F.col("a").alias("id")).alias("a"), F.struct("at", F.col("b").alias("id")).alias("b"))
    roots = connected_components(joined).select("id.at", F.col("id.id").alias("rep"), F.col("root.id").alias("root"))
    cores = points.filter(F.col("level") < never).select("rep", upto(F.lit(never - 1)))
    cores = cut(cores.join(roots, ["at", "rep"], "left").select("at", "rep", F.coalesce("root", "rep").alias("root")))
    distinct = cores.select("at", "root").distinct().withColumn("_one", F.lit(1))
    names = running_sums(distinct, ["at"], "root", ["_one"]).select("at", "root", F.col("cum__one").cast("int").alias("cluster"))
    numbered = cut(cores.join(names, ["at", "root"]).select("at", "rep", "cluster"))
    own = points.select(F.col("rep").alias("a"), F.col("level").alias("own"))
    border = edges.filter("border").join(own, "a").select("a", F.col("b").alias("rep"), upto(F.col("own") - 1))
    reached = border.join(numbered, ["at", "rep"]).groupBy("at", F.col("a").alias("rep")).agg(F.min("cluster").alias("cluster"))
    labels = numbered.union(reached).join(points.select("rep", "x"), "rep").select("at", "x", "cluster")
    every = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(never - 1))))
    return every.join(labels, ["at", "x"], "left").select("id", F.col("at").alias("level"), F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


@scoped
def sweep_eps(df: DataFrame, *, id_col: str, x_col: str, min_pts: int = 5) -> tuple[DataFrame, float]:
    """DBSCAN at six radii taken from the k-distance percentiles: results and the best radius.

    Scores cover clusters of two rows or more and need at least two of them, otherwise they are -1. The best silhouette
    wins; without any score, the radius with the most clusters does. One neighbour join gives the radii and the core
    distances, one comparison the labels of all radii.
    """
    df = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x")).persist()
    try:
        near = cut(k_nearest(df, id_col="id", x_col="x", k=min_pts).filter(F.col("rank") >= min_pts - 1))
        kd = near.filter(F.col("rank") == min_pts - 1).select("id", F.col("distance").alias("k_distance"))
        p25, p50, p75, p90 = k_distance_percentiles(kd)
        radii = [p25, p50, p75, p90, 1.5 * p90, 2.0 * p90]
        core = near.filter(F.col("rank") == min_pts).select("id", "distance")
        found = cut(dbscan_levels(df, id_col="id", x_col="x", radii=radii, min_pts=min_pts, core_distance=core))
        sizes = cut(found.groupBy("level", "cluster").agg(F.count(F.lit(1)).alias("n")))
        real = F.col("cluster") != NOISE
        told = {r["level"]: r for r in sizes.groupBy("level").agg(
            F.count_if(real).alias("clusters"), F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("noise"), F.count_if(real & (F.col("n") >= 2)).alias("valid")).collect()}
        valid = sizes.filter(real & (F.col("n") >= 2)).select("level", "cluster")
        rows = []
        for level, eps in enumerate(radii):
            n = told[level]
            result = (-1.0, -1.0, -1.0)
            if n["clusters"] > 1 and n["valid"] > 1:
                own = found.join(valid, ["level", "cluster"], "left_semi").filter(F.col("level") == level)
                result = scores(cut(df.join(own.select("id", "cluster"), "id")), id_col="id", x_col="x", cluster_col="cluster")
            rows.append((float(eps), n["clusters"], n["noise"], *result))
    finally:
        df.unpersist()
    scored = [r for r in rows if r[3] > -1 and r[1] > 0]
    best = max(scored, key=lambda r: r[3]) if scored else max(rows, key=lambda r: r[1])  # the first of equals
    first = rows.index(best)
    results = small_table(
        df.sparkSession, [(i + 1, *r, i == first) for i, r in enumerate(rows)],
        "step int, eps double, n_clusters bigint, n_noise bigint, silhouette double, calinski_harabasz double, "
        "davies_bouldin double, is_best boolean",
    )
    return results, best[0]
