"""Cluster quality: silhouette, Calinski-Harabasz, Davies-Bouldin, contingency, sizes, sweeps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.lineage import cut, scoped, small_table
from sparkmine.functions.joins import null_safe_join
from sparkmine.functions.vectors import distances, matrix, minkowski
from sparkmine.operators.blocks import BROADCAST_BYTES, Block, build_blocks, chunked_rows, cluster_blocks, every_pair, join_blocks
from sparkmine.operators.kmeans import lloyd_many, seed_centers
from sparkmine.operators.neighbors import nearest_center
from sparkmine.operators.sampling import sample_exact

FEW_CLUSTERS = 1024
FEW_LABELS = 32  # label combinations whose distance sums are columns of one row
SUMS = "id bigint, cluster bigint, other bigint, total double, n bigint"


def _distance_sums(a: Block, b: Block, sizes: np.ndarray | None = None) -> pd.DataFrame:
    """Distance sum and row count per (row of ``a``, cluster of ``b``).

    With the full cluster ``sizes`` of ``b``'s rows, a row only reports its own
    cluster, the nearest of the clusters that are complete in ``b``, and the parts
    of clusters that are not.
    """
    order = np.argsort(b.tags, kind="stable")
    clusters, first, size = np.unique(b.tags[order], return_index=True, return_counts=True)
    xs, sizes = b.xs[order], None if sizes is None else sizes[order]
    parts = []
    for s in chunked_rows(len(a.ids), len(b.ids)):
        total = np.add.reduceat(distances(a.xs[s], xs), first, axis=1)
        if sizes is None:
            wanted = np.ones(total.shape, dtype=bool)
        else:
            own = a.tags[s][:, None] == clusters[None, :]
            whole = size == sizes[first]
            wanted = own | ~whole[None, :]
            mean = np.where(wanted, np.inf, total / size)
            rows, best = np.arange(len(mean)), mean.argmin(axis=1)
            found = np.isfinite(mean[rows, best])
            wanted[rows[found], best[found]] = True
        r, k = np.nonzero(wanted)
        parts.append(pd.DataFrame({
            "id": a.ids[s][r], "cluster": a.tags[s][r], "other": clusters[k], "total": total[r, k], "n": size[k].astype(np.int64),
        }))
    return pd.concat(parts, ignore_index=True)


class _Sums:
    """What the rows of a block keep: sums to their own cluster, to the nearest other one, and to clusters of several blocks."""

    def __init__(self, n: int):
        self.own, self.own_n = np.zeros(n), np.zeros(n, np.int64)
        self.mean, self.total, self.n, self.other = np.full(n, np.inf), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def take(self, s: slice, tags: np.ndarray, total: np.ndarray, clusters: np.ndarray, size: np.ndarray, whole: np.ndarray) -> None:
        """Distance sums ``total`` of the rows ``s`` to ``clusters``, of which a block holds ``size`` rows, or all if ``whole``."""
        for j in np.flatnonzero(~whole):
            sums, n = self.parts.setdefault(int(clusters[j]), (np.zeros(len(self.own)), np.zeros(len(self.own), np.int64)))
            sums[s] += total[:, j]
            n[s] += size[j]
        if not whole.any():
            return
        if not whole.all():
            total, clusters, size = total[:, whole], clusters[whole], size[whole]
        mean = total / size
        at = np.minimum(np.searchsorted(clusters, tags), len(clusters) - 1)
        own = np.flatnonzero(clusters[at] == tags)
        self.own[s][own], self.own_n[s][own] = total[own, at[own]], size[at[own]]
        mean[own, at[own]] = np.inf
        best = mean.argmin(axis=1)
        found = mean[np.arange(len(mean)), best]
        better = np.flatnonzero(found < self.mean[s])
        best = best[better]
        self.mean[s][better], self.total[s][better], self.n[s][better], self.other[s][better] = (
            found[better], total[better, best], size[best], clusters[best])

    def told(self, ids: np.ndarray, tags: np.ndarray) -> pd.DataFrame:
        own, near = np.flatnonzero(self.own_n), np.flatnonzero(np.isfinite(self.mean))
        found = [(own, tags[own], self.own[own], self.own_n[own]), (near, self.other[near], self.total[near], self.n[near])]
        for cluster, (sums, n) in self.parts.items():
            some = np.flatnonzero(n)
            found.append((some, np.full(len(some), cluster), sums[some], n[some]))
        rows, other, total, n = (np.concatenate(part) for part in zip(*found))
        return pd.DataFrame({"id": ids[rows], "cluster": tags[rows], "other": other, "total": total, "n": n})


def _meet(q: Block, c: Block) -> None:
    """Distance sums of the rows of either block to the clusters of the other one, each distance taken once; ``vals`` are cluster sizes."""
    for block in (q, c):
        if block.kept is None:
            block.kept = _Sums(len(block.ids))

    def clusters(b: Block) -> tuple[np.ndarray, ...]:  # a block is in the order of its tags
        tags, first, size = np.unique(b.tags, return_index=True, return_counts=True)
        return first, tags, size, size == b.vals[first]

    first, *theirs = clusters(c)
    _, *ours = clusters(q)
    to_ours = np.zeros((len(ours[0]), len(c.ids)))
    for s in chunked_rows(len(q.ids), len(c.ids)):
        d = distances(q.xs[s], c.xs)
        q.kept.take(s, q.tags[s], np.add.reduceat(d, first, axis=1), *theirs)
        if c is not q:
            own, start = np.unique(q.tags[s], return_index=True)
            to_ours[np.searchsorted(ours[0], own)] += np.add.reduceat(d, start, axis=0)
    if c is not q:
        c.kept.take(slice(0, len(c.ids)), c.tags, to_ours.T, *ours)


def _met(block: Block) -> pd.DataFrame:
    return (block.kept or _Sums(0)).told(block.ids, block.tags)


def _block_sums(q_rows: DataFrame | None, c_rows: DataFrame) -> DataFrame:
    """Sums by block pairs; ``q_rows`` is the asked part of ``c_rows (id, x, cluster)``, or all of it: then a pair of rows is compared once."""
    sizes = c_rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sized = c_rows.join(sizes, "cluster")
    n, width = c_rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    c, _ = cluster_blocks(sized, n, width or 1)
    if q_rows is None:
        return join_blocks(c, c, every_pair(c, c), _meet, SUMS, tell=_met, both=True)
    q = build_blocks(q_rows, "id", "x", tag="cluster", pivots=np.zeros((0, 0)))
    return join_blocks(q, c, every_pair(q, c), lambda a, b: _distance_sums(a, b, b.vals), SUMS,
                       lambda d: d.groupby(["id", "cluster", "other"], as_index=False).agg({"total": "sum", "n": "sum"}))


def _sample_sums(c_rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The same sums for a sample. A sample of checked size travels to the rows, which are then
    only scanned; each task adds up its batches. A larger one is joined block by block."""
    rows, width = asked.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    clusters = c_rows.agg(F.approx_count_distinct("cluster")).first()[0]
    if rows * ((width or 0) + 2 + 4 * clusters) * 8 > BROADCAST_BYTES:
        return _block_sums(asked, c_rows)
    held = asked.toArrow().combine_chunks()
    part = lambda t, x: Block(t.column("id").to_numpy(), x, t.column("cluster").to_numpy(), np.zeros(0))
    q = part(held, matrix(held.column("x").combine_chunks()) if rows else np.zeros((0, width or 1)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows and len(q.ids):
                found = _distance_sums(q, part(batch, matrix(batch.column("x")))).set_index(["id", "cluster", "other"])
                total = found if total is None else total.add(found, fill_value=0)
        if total is not None:
            yield pa.RecordBatch.from_pandas(total.astype({"n": "int64"}).reset_index(), preserve_index=False)

    return c_rows.mapInArrow(scan, SUMS)


def _few_sums(rows: DataFrame, labels: Sequence[str]) -> tuple[list, DataFrame] | None:
    """Distance sums per row for several labellings of ``rows (id, x, labels...)``, from one comparison of all pairs.

    ``((labels..., size) by code, (id, code, n, s0, s1, ...))``: a code is a combination of labels, ``si`` the distance to all
    rows of code i, ``n`` the rows compared. None if there are more than ``FEW_LABELS`` codes, or a null label.
    """
    codes = [tuple(r) for r in rows.groupBy(*labels).agg(F.count(F.lit(1))).limit(FEW_LABELS + 1).collect()]
    if not 0 < len(codes) <= FEW_LABELS or any(v is None for c in codes for v in c):
        return None
    codes.sort()
    known = small_table(rows.sparkSession, [(*c[:-1], i) for i, c in enumerate(codes)], ", ".join(f"{n} bigint" for n in labels) + ", code bigint")
    coded = rows.join(F.broadcast(known), list(labels)).select("id", "x", "code")
    b = build_blocks(coded, "id", "x", tag="code", pivots=np.zeros((0, 0)))
    width = len(codes)

    def meet(q: Block, c: Block) -> None:
        for block in (q, c):
            if block.kept is None:
                block.kept = np.zeros((len(block.ids), width + 1))
        theirs, first = np.unique(c.tags, return_index=True)  # a block is in the order of its tags
        for s in chunked_rows(len(q.ids), len(c.ids)):
            d = distances(q.xs[s], c.xs)
            q.kept[s, theirs] += np.add.reduceat(d, first, axis=1)
            if c is not q:
                own, start = np.unique(q.tags[s], return_index=True)
                for code, low, high in zip(own, start, [*start[1:], len(d)]):
                    c.kept[:, code] += d[low:high].sum(axis=0)
        q.kept[:, width] += len(c.ids)
        if c is not q:
            c.kept[:, width] += len(q.ids)

    def told(block: Block) -> pd.DataFrame:
        sums = block.kept if block.kept is not None else np.zeros((0, width + 1))
        n = len(sums)
        return pd.DataFrame({"id": block.ids[:n], "code": block.tags[:n], "n": sums[:, width].astype(np.int64), **{f"s{i}": sums[:, i] for i in range(width)}})

    schema = "id bigint, code bigint, n bigint, " + ", ".join(f"s{i} double" for i in range(width))
    tiles = join_blocks(b, b, every_pair(b, b), meet, schema, tell=told, both=True)
    return codes, tiles.groupBy("id", "code").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])


def _means_of(codes: list, sums: DataFrame, label: int) -> DataFrame:
    """``(id, cluster, a, b)`` of one labelling from the sums of all: mean distance within the cluster and to the nearest other."""
    clusters = sorted({c[label] for c in codes})
    size = {v: sum(c[-1] for c in codes if c[label] == v) for v in clusters}
    total = sum(size.values())
    of_code = F.array(*[F.lit(c[label]).cast("bigint") for c in codes])
    to = [sum((F.col(f"s{i}") for i, c in enumerate(codes) if c[label] == v), F.lit(0.0)).alias(f"t{j}") for j, v in enumerate(clusters)]
    per = sums.select("id", F.element_at(of_code, (F.col("code") + 1).cast("int")).alias("cluster"), "n", *to).groupBy("id", "cluster").agg(
        F.sum("n").alias("n"), *[F.sum(f"t{j}").alias(f"t{j}") for j in range(len(clusters))])
    times = F.col("n") / F.lit(total)  # rows of this id
    within, others = F.lit(None).cast("double"), []
    for j, v in enumerate(clusters):
        here, n = F.col("cluster") == F.lit(v), F.round(times * F.lit(size[v]))
        within = F.when(here & (n > 1), F.col(f"t{j}") / (n - 1)).otherwise(within)
        others.append(F.when(~here, F.col(f"t{j}") / n))
    nearest = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
    return per.select("id", "cluster", within.alias("a"), nearest.alias("b"))


def _scored(ab: DataFrame) -> DataFrame:
    """Silhouettes of ``(id, cluster, a, b)``; a cluster of one has no ``a``."""
    alone = F.col("a").isNull()
    a = F.when(alone, 0.0).otherwise(F.col("a"))
    b = F.when(alone, 0.0).otherwise(F.coalesce("b", "a"))
    top = F.greatest("a", "b")
    return ab.select("id", "cluster", a.alias("a"), b.alias("b")).withColumn(
        "silhouette", F.when(top > 0, (F.col("b") - F.col("a")) / top).otherwise(0.0)
    )


def silhouette_rows(df: DataFrame, *, id_col: str, x_col: str, cluster_col: str,
                    sample: DataFrame | None = None) -> DataFrame:
    """Euclidean silhouette per sampled row against *all* rows: ``(id, cluster, a, b, silhouette)``.

    A block pair is reduced to a few distance sums per row. A cluster of one scores 0. With a sample, only clusters that occur in it count as neighbours.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x"),
                     F.col(cluster_col).cast("bigint").alias("cluster"))
    if sample is None:
        few = _few_sums(rows, ["cluster"])
        if few is not None:
            return _scored(_means_of(*few, 0))
        tiles = _block_sums(None, rows)
    else:
        chosen = sample.select(F.col(id_col).cast("bigint").alias("id")).distinct()
        asked = rows.join(chosen, "id", "left_semi")
        present = asked.select(F.col("cluster").alias("other")).distinct()
        neighbours = rows.join(present.withColumnRenamed("other", "cluster"), "cluster", "left_semi")
        tiles = _sample_sums(neighbours, asked)
    per_pair = tiles.groupBy("id", "cluster", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("other") == F.col("cluster")
    return _scored(per_pair.groupBy("id", "cluster").agg(
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    ))


def silhouette(df: DataFrame, *, id_col: str, x_col: str, cluster_col: str, sample: DataFrame | None = None) -> DataFrame:
    """Mean silhouette: one row ``(n_rows, silhouette)``."""
    rows = silhouette_rows(df, id_col=id_col, x_col=x_col, cluster_col=cluster_col, sample=sample)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("silhouette").alias("silhouette"))


def silhouettes(df: DataFrame, *, id_col: str, x_col: str, cluster_cols: Sequence[str]) -> list[float | None]:
    """Mean silhouette over all rows for each of several labellings, whose distances are taken once where the labels are few."""
    names = [f"c{i}" for i in range(len(cluster_cols))]
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x"),
                     *[F.col(c).cast("bigint").alias(n) for c, n in zip(cluster_cols, names)])
    few = _few_sums(rows, names)
    if few is None:
        return [silhouette(df, id_col=id_col, x_col=x_col, cluster_col=c).first()["silhouette"] for c in cluster_cols]
    codes, sums = few[0], cut(few[1])
    return [_scored(_means_of(codes, sums, i)).agg(F.avg("silhouette")).first()[0] for i in range(len(names))]


def _moments(df: DataFrame, *, x_col: str, cluster_col: str) -> DataFrame:
    """Size, mean and variance per cluster and dimension, combined before the shuffle."""
    return (
        df.select(F.col(cluster_col).alias("cluster"), F.posexplode(F.col(x_col).cast("array<double>")).alias("dim", "v"))
        .groupBy("cluster", "dim").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("center"), F.var_pop("v").alias("spread"))
    )


def centroid_table(df: DataFrame, *, x_col: str, cluster_col: str) -> DataFrame:
    """``(cluster, n, center)`` with the centre as one vector."""
    # the list holds one entry per dimension
    ordered = F.array_sort(F.collect_list(F.struct("dim", "center")))
    return _moments(df, x_col=x_col, cluster_col=cluster_col).groupBy("cluster").agg(
        F.max("n").alias("n"), F.transform(ordered, lambda s: s["center"]).alias("center"))


def calinski_harabasz(df: DataFrame, *, x_col: str, cluster_col: str) -> DataFrame:
    """``(n_rows, n_clusters, between, within, calinski_harabasz)`` from one pass of per-cluster moments."""
    per = _moments(df, x_col=x_col, cluster_col=cluster_col)
    all_rows = Window.partitionBy("dim")  # one row per cluster
    per = per.withColumn("g", F.sum(F.col("n") * F.col("center")).over(all_rows) / F.sum("n").over(all_rows))
    gap = F.col("center") - F.col("g")
    totals = per.agg(
        F.sum(F.when(F.col("dim") == 0, F.col("n"))).alias("n_rows"), F.count_if(F.col("dim") == 0).alias("n_clusters"),
        F.sum(F.col("n") * gap * gap).alias("between"), F.sum(F.col("n") * F.col("spread")).alias("within"),
    )
    score = (F.col("between") / (F.col("n_clusters") - 1)) / (F.col("within") / (F.col("n_rows") - F.col("n_clusters")))
    return totals.withColumn("calinski_harabasz", F.when(F.col("n_clusters") > 1, F.when(F.col("within") == 0, 1.0).otherwise(score)))


def _worst_ratios(own: np.ndarray, centers: np.ndarray, spread: np.ndarray, others: np.ndarray, other_centers: np.ndarray,
                  other_spread: np.ndarray) -> np.ndarray:
    gap = distances(centers, other_centers)
    sums = spread[:, None] + other_spread[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(gap > 0, sums / gap, np.where(sums > 0, np.inf, 0.0))
    ratio[own[:, None] == others[None, :]] = -np.inf
    return ratio.max(axis=1)


def davies_bouldin(df: DataFrame, *, x_col: str, cluster_col: str) -> DataFrame:
    """``(n_clusters, davies_bouldin)``.

    Up to ``FEW_CLUSTERS`` centres are compared as one small model; more are
    compared as block pairs.
    """
    table = cut(centroid_table(df, x_col=x_col, cluster_col=cluster_col))
    spread = (
        df.select(F.col(cluster_col).alias("cluster"), F.col(x_col).cast("array<double>").alias("x")).join(table, "cluster")
        .groupBy("cluster").agg(F.avg(minkowski(F.col("x"), F.col("center"))).alias("s"))
    )
    packed = table.join(spread, "cluster").select(F.col("cluster").cast("bigint").alias("cluster"), "center", "s")
    if table.count() <= FEW_CLUSTERS:
        rows = packed.collect()
        if len(rows) < 2:
            return small_table(df.sparkSession, [(len(rows), None)], "n_clusters bigint, davies_bouldin double")
        ids, centers, s = np.array([r["cluster"] for r in rows]), np.array([r["center"] for r in rows]), np.array([r["s"] for r in rows])
        value = float(_worst_ratios(ids, centers, s, ids, centers, s).mean())
        return small_table(df.sparkSession, [(len(rows), value)], "n_clusters bigint, davies_bouldin double")
    b = build_blocks(packed, "cluster", "center", val="s", pivots=np.zeros((0, 0)))

    def worst(q: Block, c: Block) -> pd.DataFrame:
        return pd.DataFrame({"cluster": q.ids, "ratio": _worst_ratios(q.ids, q.xs, q.vals, c.ids, c.xs, c.vals)})

    tiles = join_blocks(b, b, every_pair(b, b), worst, "cluster bigint, ratio double")
    per = tiles.groupBy("cluster").agg(F.max("ratio").alias("ratio"))
    return per.agg(F.count(F.lit(1)).alias("n_clusters"), F.avg("ratio").alias("davies_bouldin"))


def scores(df: DataFrame, *, id_col: str, x_col: str, cluster_col: str, sample: DataFrame | None = None) -> tuple:
    """``(silhouette, calinski_harabasz, davies_bouldin)`` as plain numbers."""
    s = silhouette(df, id_col=id_col, x_col=x_col, cluster_col=cluster_col, sample=sample).first()["silhouette"]
    return s, *indices(df, x_col=x_col, cluster_col=cluster_col)


def indices(df: DataFrame, *, x_col: str, cluster_col: str) -> tuple:
    ch = calinski_harabasz(df, x_col=x_col, cluster_col=cluster_col).first()["calinski_harabasz"]
    db = davies_bouldin(df, x_col=x_col, cluster_col=cluster_col).first()["davies_bouldin"]
    return ch, db


@scoped
def sweep_kmeans(df: DataFrame, *, id_col: str, x_col: str, ks: Sequence[int], seed: int = 42,
                 sample_rows: int | None = None, max_iter: int = 300) -> DataFrame:
    """One row per k with its three scores; the first best silhouette is marked.

    The silhouette is taken over all rows, or over ``sample_rows`` sampled ones against all rows.

    Seeding is sequential, so the centres for the largest k serve every smaller one,
    and all k iterate in the same passes.
    """
    df = df.select(id_col, x_col).persist()
    try:
        seeds = seed_centers(df, id_col=id_col, x_col=x_col, k=max(ks), seed=seed)
        rows = []
        fits = lloyd_many(df, [seeds[:k] for k in ks], x_col=x_col, max_iter=max_iter)
        sample = sample_exact(df, sample_rows, id_col=id_col, seed=seed) if sample_rows else None
        every = df
        for i, fit in enumerate(fits):
            every = nearest_center(every, fit.assigned, x_col=x_col, into=(f"k{i}", "_to")).drop("_to")
        whole = None if sample else silhouettes(every, id_col=id_col, x_col=x_col, cluster_cols=[f"k{i}" for i in range(len(fits))])
        for i, (k, fit) in enumerate(zip(ks, fits)):
            labelled = fit.transform(df, x_col)
            mean = whole[i] if whole else silhouette(labelled, id_col=id_col, x_col=x_col, cluster_col="cluster", sample=sample).first()["silhouette"]
            rows.append((k, fit.iterations, mean, *indices(labelled, x_col=x_col, cluster_col="cluster")))
    finally:
        df.unpersist()
    return mark_best(small_table(df.sparkSession,
        rows, "k int, iterations int, silhouette double, calinski_harabasz double, davies_bouldin double"
    ), "k")


def mark_best(results: DataFrame, order: str) -> DataFrame:
    """Flag the row with the highest silhouette; the first in ``order`` wins ties."""
    best = results.agg(F.max_by(order, F.struct(F.coalesce("silhouette", F.lit(-1.0)), -F.col(order))).alias("_best"))
    return results.join(F.broadcast(best)).withColumn("is_best", F.col(order) == F.col("_best")).drop("_best")


def contingency(df: DataFrame, *, cluster_col: str, label_col: str) -> DataFrame:
    """Rows per (cluster, label) with the label's share of its cluster."""
    counts = df.groupBy(F.col(cluster_col).alias("cluster"), F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("cluster").agg(F.sum("n").alias("cluster_size"))
    return null_safe_join(counts, sizes, ["cluster"]).withColumn("share", F.col("n") / F.col("cluster_size"))


def purity(df: DataFrame, *, cluster_col: str, label_col: str) -> DataFrame:
    counts = df.groupBy(cluster_col, label_col).agg(F.count(F.lit(1)).alias("n"))
    tops = counts.groupBy(cluster_col).agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return tops.agg(F.sum("n").alias("n_rows"), (F.sum("top") / F.sum("n")).alias("purity"))


def cluster_sizes(df: DataFrame, *, cluster_col: str, noise: int = 0) -> DataFrame:
    """Size of every cluster, noise marked: ``(cluster, n, is_noise)``."""
    return df.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "is_noise", F.col("cluster") == noise
    )


def cluster_summary(df: DataFrame, *, cluster_col: str, noise: int = 0) -> DataFrame:
    sizes = cluster_sizes(df, cluster_col=cluster_col, noise=noise)
    return sizes.agg(
        F.count_if(~F.col("is_noise")).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col("is_noise"), F.col("n"))), F.lit(0)).alias("n_noise"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )
