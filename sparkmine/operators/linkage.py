"""Average-linkage agglomeration by rounds of mutual-nearest-neighbour merges.

While there are more than ``MANY`` clusters, a round looks for the nearest cluster of those that need a new one and keeps no
sums, so that tables stay as long as the rows. Narrow rows: centres and spreads bound the mean distances, and only clusters
that may be nearest are summed up. Wide rows: floors of all mean distances come from single precision, block pair by block
pair, and dense groups are merged beforehand, each by one task. Up to ``MANY``, distances are taken once. From then on every cluster is a row that holds its sums of distances to all live clusters, its
nearest cluster and the height of that merge: sums of merged clusters add up, so a round adds rows and columns together
and looks for a new nearest only where a cluster, or its nearest, has merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.vectors import NARROW, distances, floor_terms, paired_squares, powers, squared_l2
from sparkmine.lineage import cut, scoped, small_table
from sparkmine.operators.blocks import Block, build_blocks, choose_pivots, chunked_rows, cluster_blocks, every_pair, join_blocks, knn_reach, pairs_within
from sparkmine.operators.cluster_quality import indices, mark_best, silhouette, silhouettes
from sparkmine.operators.components import connected_components, number_by_order
from sparkmine.operators.neighbors import k_nearest, knn_join

FEW = 32  # clusters whose last merges one task makes
MANY = 4096  # clusters whose sums of all pairs are kept
MERGES = "height double, a bigint, b bigint, round int"
STATE = "cluster bigint, size bigint, near bigint, height double, totals binary"
PARTS = "cluster bigint, place binary, part binary"
FOUND = "cluster bigint, other bigint, total double, height double, whole boolean"
NEARLY = 1e-9  # margin of bounds, relative and absolute
PAIR_COST = 1000  # distances in a block that take as long as one pair of clusters on its own
PART_ROWS = 2048  # rows of one cluster that are summed up at a time
SMALL = 16  # clusters of up to as many rows are summed up side by side
NEIGHBOURS = 8  # links of a row to the rows around it
STEPS = (0.6, 0.25, 0.08)  # shares of the links that join rows to groups, one after the other


@dataclass
class Live:
    """Clusters in the order of the sums, with their sizes: as long as one row of the sums."""

    ids: np.ndarray
    sizes: np.ndarray

    def nearest(self, cluster: np.ndarray, size: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest cluster and mean distance of each row; of equal ones the lowest id, so that both ends agree on a pair."""
        mean = totals / (size[:, None] * self.sizes[None])
        rows = np.arange(len(cluster))
        mean[rows, np.searchsorted(self.ids, cluster)] = np.inf
        best = mean.argmin(axis=1)
        return self.ids[best], mean[rows, best]


def _cluster_sums(a: Block, b: Block) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...], np.ndarray]:
    """Clusters of two blocks ``(id, rows they stand for, whole)`` and the sums of the distances between their rows, which come in the order of the clusters.

    The last entry of a vector is its weight, the number of rows that it stands for.
    """
    def clusters(x: Block) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray, bool]:
        ids, first, n = np.unique(x.tags, return_index=True, return_counts=True)
        weight = x.xs[:, -1]
        return (ids, np.add.reduceat(weight, first), n == x.vals[first]), first, weight, bool((weight != 1).any())

    (of_a, first_a, weight_a, heavy_a), (of_b, first_b, weight_b, heavy_b) = clusters(a), clusters(b)
    code = np.searchsorted(of_a[0], a.tags)
    total = np.zeros((len(of_a[0]), len(of_b[0])))
    for s in chunked_rows(len(a.ids), len(b.ids)):
        d = distances(a.xs[s, :-1], b.xs[:, :-1])
        d = np.add.reduceat(d * weight_b if heavy_b else d, first_b, axis=1)
        own, first = np.unique(code[s], return_index=True)
        total[own] += np.add.reduceat(d * weight_a[s, None] if heavy_a else d, first, axis=0)
    return of_a, of_b, total


def _blocks_of(members: DataFrame, table: DataFrame, width: int):
    n = table.agg(F.sum("rows")).first()[0] or 0
    return cluster_blocks(members.join(table.select("cluster", F.col("rows").alias("size")), "cluster"), n, width + 1)[0]


class _Rows:
    """The rows of whole clusters of a block, in an order in which their sums need few additions of long vectors.

    Clusters of up to ``SMALL`` rows come first, the larger before the smaller: the first row of each, then the second of
    those that have one, and so on. Larger clusters follow, each with its rows together.
    """

    def __init__(self, x: Block, some: np.ndarray):
        tags = x.tags[some]
        ids, first, n = np.unique(tags, return_index=True, return_counts=True)
        order = np.argsort(np.where(n > SMALL, 0, -n) + np.where(n > SMALL, 1, 0), kind="stable")
        self.ids, first, self.n = ids[order], first[order], n[order]
        self.few = int((self.n <= SMALL).sum())
        small = self.n[: self.few]
        self.ranks = [int((small > r).sum()) for r in range(int(small.max(initial=0)))]
        rows = [first[:m] + r for r, m in enumerate(self.ranks)]
        self.starts = np.cumsum(np.r_[0, self.ranks]).astype(int)  # of the ranks, then of the larger clusters
        rows += [np.arange(f, f + k) for f, k in zip(first[self.few:], self.n[self.few:])]
        self.large = (self.starts[-1] + np.cumsum(np.r_[0, self.n[self.few:]])).astype(int)
        at = np.concatenate(rows)
        self.xs = x.xs[some][at]
        self.weight = self.xs[:, -1]
        self.heavy = bool((self.weight != 1).any())
        self.first, self.listed = first, x.xs[some]  # the rows cluster by cluster
        self.size = np.add.reduceat(self.listed[:, -1], np.sort(first))[np.argsort(np.argsort(first))]

    def across(self, d: np.ndarray) -> np.ndarray:
        """Sums over the columns of each cluster."""
        total = np.zeros((len(d), len(self.ids)), d.dtype)
        for r, m in enumerate(self.ranks):
            total[:, :m] += d[:, self.starts[r]: self.starts[r] + m]
        if self.few < len(self.ids):
            total[:, self.few:] = np.add.reduceat(d[:, self.starts[-1]:], self.large[:-1] - self.starts[-1], axis=1)
        return total

    def down(self, total: np.ndarray, s: slice, d: np.ndarray) -> None:
        """Add the rows ``s`` to the sums of their clusters."""
        pieces = [(self.starts[r], self.starts[r] + m, 0) for r, m in enumerate(self.ranks)]
        for low, high, to in pieces:
            lo, hi = max(low, s.start), min(high, s.stop)
            if lo < hi:
                total[to + lo - low: to + hi - low] += d[lo - s.start: hi - s.start]
        for k in range(len(self.large) - 1):
            lo, hi = max(self.large[k], s.start), min(self.large[k + 1], s.stop)
            if lo < hi:
                total[self.few + k] += d[lo - s.start: hi - s.start].sum(axis=0)

    def lists(self, clusters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.listed, self.first[clusters], self.n[clusters]


def _sifted(a: _Rows, b: _Rows, near: np.ndarray, height: np.ndarray) -> bool:
    """Lower ``height``, and set ``near``, where a cluster of ``b`` is nearer: floors of all mean distances in single precision,
    the distances of those clusters whose floor is within the lowest so far. False if squares overflow.
    """
    terms = floor_terms(a.xs[:, :-1], b.xs[:, :-1])
    if terms is None:
        return False
    f, g, scale = terms
    total = np.zeros((len(a.ids), len(b.ids)), np.float32)
    weight_a, weight_b = a.weight.astype(np.float32), b.weight.astype(np.float32)
    for s in chunked_rows(len(f), len(b.xs), 1 << 18):
        d = f[s] @ g
        np.maximum(d, 0, out=d)
        np.sqrt(d, out=d)
        if b.heavy:
            d *= weight_b
        d = b.across(d)
        a.down(total, s, d * weight_a[s, None] if a.heavy else d)
    # roots, weights and the sums of a cluster round; twice as much is taken off
    less = math.sqrt(scale) * (1 - 2.0 ** -23 * (int(a.n.max()) + int(b.n.max()) + 16))
    unit_a, unit_b = (less / a.size).astype(np.float32), (1 / b.size).astype(np.float32)
    place = np.argsort(b.ids)
    spot = place[np.minimum(np.searchsorted(b.ids, a.ids, sorter=place), len(place) - 1)]
    own = np.flatnonzero(b.ids[spot] == a.ids)
    total *= unit_a[:, None]
    total *= unit_b
    total[own, spot[own]] = np.inf

    def told(rows: np.ndarray, cols: np.ndarray) -> None:
        mean = _ragged_sums(a.lists(rows), b.lists(cols)) / (a.size[rows] * b.size[cols])
        order = np.lexsort((b.ids[cols], mean, rows))
        rows, cols, mean = rows[order], cols[order], mean[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, int)
        rows, cols, mean = rows[first], cols[first], mean[first]
        better = (mean < height[rows]) | ((mean == height[rows]) & (b.ids[cols] < near[rows]))
        height[rows[better]], near[rows[better]] = mean[better], b.ids[cols[better]]

    best = total.argmin(axis=1)
    rows = np.flatnonzero(total[np.arange(len(best)), best] <= height)
    rows = rows[np.isfinite(total[rows, best[rows]])]
    told(rows, best[rows])
    total[rows, best[rows]] = np.inf
    limit = np.nextafter(height.astype(np.float32), np.float32(np.inf))
    told(*np.nonzero((total <= limit[:, None]) & np.isfinite(total)))
    return True


def _part(x: Block, some: np.ndarray) -> Block:
    return Block(x.ids[some], x.xs[some], x.tags[some], x.vals[some])


def _nearest(members: DataFrame, table: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """``(cluster, near, height)`` of the ``asked`` part of ``table``, from the rows ``members (id, x, cluster)`` of all.

    Clusters that lie whole in two blocks are compared there and a block keeps the nearest only; parts of larger ones, of
    which there are few, pass on their sums.
    """
    q, c = _blocks_of(members, asked, width), _blocks_of(members, table, width)

    def summed(a: Block, b: Block) -> pd.DataFrame:
        if not len(a.ids) or not len(b.ids):
            return pd.DataFrame({"cluster": [], "other": [], "total": [], "height": [], "whole": []})
        (ids, size, all_a), (others, sizes_b, all_b), total = _cluster_sums(a, b)
        pairs = size[:, None] * sizes_b[None]
        apart, whole = ids[:, None] != others[None], all_a[:, None] & all_b[None]
        mean = np.where(whole & apart, total / pairs, np.inf)
        rows, best = np.arange(len(ids)), mean.argmin(axis=1)
        wanted = apart & ~whole
        wanted[rows, best] |= np.isfinite(mean[rows, best])
        r, k = np.nonzero(wanted)
        return pd.DataFrame({"cluster": ids[r], "other": others[k], "total": total[r, k], "height": mean[r, k], "whole": whole[r, k]})

    def whole_rows(x: Block) -> np.ndarray:
        _, code, n = np.unique(x.tags, return_inverse=True, return_counts=True)
        return n[code] == x.vals

    def compare(a: Block, b: Block) -> pd.DataFrame | None:
        if width <= NARROW or not (np.isfinite(a.xs).all() and np.isfinite(b.xs).all()):
            return summed(a, b)
        all_a, all_b = whole_rows(a), whole_rows(b)
        parts = [summed(_part(a, ~all_a), b), summed(_part(a, all_a), _part(b, ~all_b))]
        if all_a.any() and all_b.any():
            if a.kept is None:
                rows = _Rows(a, all_a)
                a.kept = rows, np.full(len(rows.ids), -1), np.full(len(rows.ids), np.inf)
            if b.kept is None:  # other blocks of the task meet it as well
                b.kept = _Rows(b, all_b)
            if not _sifted(a.kept[0], b.kept, *a.kept[1:]):
                return summed(a, b)
        parts = [p for p in parts if len(p)]
        return pd.concat(parts, ignore_index=True) if parts else None

    def kept(found: pd.DataFrame) -> pd.DataFrame:
        parts = found[~found["whole"]].groupby(["cluster", "other", "height", "whole"], as_index=False).agg({"total": "sum"})
        full = found[found["whole"]].sort_values(["cluster", "height", "other"]).drop_duplicates("cluster")
        return pd.concat([d[found.columns] for d in (full, parts) if len(d)], ignore_index=True)

    def told(a: Block) -> pd.DataFrame | None:
        if a.kept is None:
            return None
        rows, near, height = a.kept
        some = np.isfinite(height)
        return pd.DataFrame({"cluster": rows.ids[some], "other": near[some], "total": np.zeros(some.sum()), "height": height[some], "whole": True})

    found = cut(join_blocks(q, c, every_pair(q, c), compare, FOUND, kept, tell=told, copied=False))
    return _lowest(found.filter("whole").select("cluster", "other", "height").union(_means(found.filter("NOT whole"), table)))


def _means(parts: DataFrame, table: DataFrame) -> DataFrame:
    """``(cluster, other, height)`` from sums of distances ``(cluster, other, total)`` that come in parts."""
    size = table.select("cluster", "size")
    summed = parts.groupBy("cluster", "other").agg(F.sum("total").alias("total")).join(size, "cluster")
    paired = summed.join(size.select(F.col("cluster").alias("other"), F.col("size").alias("other_size")), "other")
    return paired.select("cluster", "other", (F.col("total") / (F.col("size") * F.col("other_size"))).alias("height"))


def _lowest(found: DataFrame) -> DataFrame:
    return found.groupBy("cluster").agg(F.min(F.struct("height", "other")).alias("best")).select(
        "cluster", F.col("best.other").alias("near"), F.col("best.height").alias("height"))


class _Near:
    """What the clusters of a block keep: the lowest mean square to another cluster, and the clusters whose centre lies within it."""

    def __init__(self, n: int):
        self.best = np.full(n, np.inf)
        self.found: list[tuple[np.ndarray, ...]] = []


def _candidates(table: DataFrame, asked: DataFrame) -> DataFrame:
    """``(cluster, other, low, high)``: the clusters that may be nearest to the ``asked`` part of ``table (cluster, centre, spread)``.

    A mean distance lies between the distance of the centres and the root of the mean square, which the centres and the mean
    squares around them (``spread``) give. Both bounds need no rows, and cells of centres skip what is too far.
    """
    pivots = choose_pivots(table, "cluster", "centre", cell_rows=128, most=512)
    c = build_blocks(table, "cluster", "centre", val="spread", pivots=pivots)
    q = c if asked is table else build_blocks(asked, "cluster", "centre", val="spread", like=c)
    widest = table.agg(F.max("spread")).first()[0] or 0.0
    far = knn_reach(q, c, 2)

    def compare(a: Block, b: Block) -> None:
        if a.kept is None:
            a.kept = _Near(len(a.ids))
        best = a.kept.best
        middle = b.xs.mean(axis=0, keepdims=True)
        out_to = distances(b.xs, middle).max()
        away = distances(a.xs, middle)[:, 0]
        open_ = np.flatnonzero(~(away - out_to > np.sqrt(best) * (1 + NEARLY) + NEARLY))
        place = np.searchsorted(b.ids, a.ids)
        place[b.ids[np.minimum(place, len(b.ids) - 1)] != a.ids] = -1
        for s in chunked_rows(len(open_), len(b.ids)):
            own = open_[s]
            low = powers(a.xs[own], b.xs)
            high = low + a.vals[own, None]
            high += b.vals
            here = np.flatnonzero(place[own] >= 0)
            low[here, place[own[here]]] = high[here, place[own[here]]] = np.inf
            best[own] = np.minimum(best[own], high.min(axis=1))
            limit = best[own] * (1 + NEARLY) + NEARLY
            r, k = np.nonzero((low <= limit[:, None]) & np.isfinite(low))
            a.kept.found.append((own[r], b.ids[k], low[r, k], high[r, k]))

    def told(a: Block) -> pd.DataFrame:
        if a.kept is None or not a.kept.found:
            return pd.DataFrame({"cluster": [], "other": [], "low": [], "high": []})
        rows, others, low, high = (np.concatenate(part) for part in zip(*a.kept.found))
        keep = low <= a.kept.best[rows] * (1 + NEARLY) + NEARLY
        return pd.DataFrame({"cluster": a.ids[rows[keep]], "other": others[keep], "low": np.sqrt(low[keep]), "high": np.sqrt(high[keep])})

    found = cut(join_blocks(q, c, pairs_within(q, c, lambda i: math.sqrt(far(i) ** 2 + 2 * widest)), compare,
                            "cluster bigint, other bigint, low double, high double", tell=told))
    most = found.groupBy("cluster").agg(F.min("high").alias("most"))
    return found.join(most, "cluster").filter(F.col("low") <= F.col("most") * (1 + NEARLY) + NEARLY).drop("most")


def _pair_sums(pairs: DataFrame, members: DataFrame, table: DataFrame, width: int) -> DataFrame:
    """Sums of the distances between the rows of the listed ``pairs (cluster, other)``, in parts: ``(cluster, other, total)``."""
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / PART_ROWS))
    packs = cut(members.join(table.select("cluster", "rows"), "cluster").groupBy("cluster", part.alias("part")).agg(
        F.flatten(F.collect_list("x")).alias("xs")))  # at most about PART_ROWS rows
    joined = pairs.join(packs.select("cluster", F.col("xs").alias("ours")), "cluster").join(
        packs.select(F.col("cluster").alias("other"), F.col("xs").alias("theirs")), "other")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = _ragged_sums(*(_ragged(batch.column(side), width + 1) for side in ("ours", "theirs")))
                yield pa.RecordBatch.from_arrays([batch.column("cluster"), batch.column("other"), pa.array(total)], names=["cluster", "other", "total"])

    return joined.select("cluster", "other", "ours", "theirs").mapInArrow(sums, "cluster bigint, other bigint, total double")


def _ragged(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all lists, and the first row and the number of rows of each."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) // width
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), np.cumsum(n) - n, n


def _ragged_sums(ours: tuple[np.ndarray, ...], theirs: tuple[np.ndarray, ...]) -> np.ndarray:
    """Weighted distance sums of the rows of each list to the rows of its partner; small lists are taken together."""
    (a, from_a, n_a), (b, from_b, n_b) = ours, theirs
    work, total = n_a * n_b, np.zeros(len(n_a))
    for i in np.flatnonzero(work > 256):
        x, y = a[from_a[i]: from_a[i] + n_a[i]], b[from_b[i]: from_b[i] + n_b[i]]
        for s in chunked_rows(len(x), len(y)):
            total[i] += x[s, -1] @ distances(x[s, :-1], y[:, :-1]) @ y[:, -1]
    small = np.flatnonzero((work > 0) & (work <= 256))
    for start in range(0, len(small), 4096):
        i = small[start: start + 4096]
        first = np.cumsum(work[i]) - work[i]
        of = np.repeat(np.arange(len(i)), work[i])
        k = np.arange(len(of)) - first[of]
        rows, cols = from_a[i][of] + k // n_b[i][of], from_b[i][of] + k % n_b[i][of]
        d = np.sqrt(paired_squares(a[:, :-1], b[:, :-1], rows, cols))
        total[i] = np.add.reduceat(d * a[rows, -1] * b[cols, -1], first)
    return total


def _closest(members: DataFrame, table: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """The same as ``_nearest``. Where the bounds leave few candidates, only those are summed up."""
    if "centre" not in table.columns:
        return _nearest(members, table, asked, width)
    sized = table.select("cluster", F.col("rows").alias("n"))
    wanted = cut(_candidates(table, asked).join(sized, "cluster").join(sized.select(F.col("cluster").alias("other"), F.col("n").alias("m")), "other"))
    work = wanted.agg(F.sum(F.col("n") * F.col("m")), F.count(F.lit(1))).first()
    whole = asked.agg(F.sum("rows")).first()[0] * table.agg(F.sum("rows")).first()[0]
    if (work[0] or 0) * 8 + (work[1] or 0) * PAIR_COST > whole:
        return _nearest(members, table, asked, width)
    single = (F.col("n") == 1) & (F.col("m") == 1)
    summed = _pair_sums(wanted.filter(~single).select("cluster", "other"), members, table, width)
    return _lowest(wanted.filter(single).select("cluster", "other", F.col("high").alias("height")).union(_means(summed, table)))


def _measured(members: DataFrame, width: int) -> DataFrame:
    """``(cluster, size, rows)`` of the members and, for narrow rows, centre and spread: the mean square around it."""
    weight = F.element_at("x", -1)
    sums = [F.sum(F.col("x")[i] * weight).alias(f"s{i}") for i in range(width)] if width <= NARROW else []
    table = members.groupBy("cluster").agg(F.sum(weight).cast("bigint").alias("size"), F.count(F.lit(1)).alias("rows"), *sums, *([F.first("x").alias("one")] if sums else []))
    if not sums:
        return cut(table)
    centre = F.when(F.col("rows") == 1, F.slice("one", 1, width)).otherwise(F.array(*[F.col(f"s{i}") / F.col("size") for i in range(width)]))
    table = cut(table.select("cluster", "size", "rows", centre.alias("centre")))
    around = members.join(table, "cluster").groupBy("cluster").agg(
        (F.sum(squared_l2(F.slice("x", 1, width), F.col("centre")) * weight) / F.first("size")).alias("spread"))
    return cut(table.join(around, "cluster"))


def _joined_table(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The table after merging every ``b`` of ``pairs`` into its ``a``."""
    names = [c for c in table.columns if c != "cluster"]
    gone = pairs.select(F.col("b").alias("cluster"), "a").join(table, "cluster").select(F.col("a").alias("cluster"), *[F.col(c).alias(f"b_{c}") for c in names])
    left = table.join(pairs.select(F.col("b").alias("cluster")), "cluster", "left_anti").join(gone, "cluster", "left")
    left = left.withColumn("share", F.col("b_size") / (F.col("size") + F.col("b_size")))
    one, share = F.col("share").isNull(), F.col("share")
    out = {"size": F.col("size") + F.col("b_size"), "rows": F.col("rows") + F.col("b_rows")}
    if "centre" in names:
        out["centre"] = F.zip_with("centre", "b_centre", lambda x, y: x + (y - x) * share)
        out["spread"] = F.col("spread") * (1 - share) + F.col("b_spread") * share + squared_l2(F.col("centre"), F.col("b_centre")) * share * (1 - share)
    return cut(left.select("cluster", *[F.when(one, F.col(c)).otherwise(out[c]).alias(c) for c in names]))


def _groups(rows: DataFrame) -> DataFrame:
    """``(id, root)``: rows linked by short steps to near neighbours, in groups of 2 to ``MANY``; rows of larger ones take shorter steps."""
    links = cut(k_nearest(rows, id_col="id", x_col="x", k=NEIGHBOURS).select("id", "neighbor", "distance"))
    steps = links.agg(F.percentile_approx("distance", F.array(*[F.lit(s) for s in STEPS]))).first()[0] or []
    groups = small_table(rows.sparkSession, [], "id bigint, root bigint")
    for step in sorted(set(steps), reverse=True):
        roots = cut(connected_components(links.filter(F.col("distance") <= step).select(F.col("id").alias("a"), F.col("neighbor").alias("b"))))
        large = cut(roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MANY))
        groups = groups.union(roots.join(large, "root", "left_anti").select("id", "root"))
        if large.isEmpty():
            break
        links = cut(links.join(roots.join(large, "root", "left_semi"), "id", "left_semi"))
    return cut(groups)


def _merged_inside(pdf: pd.DataFrame) -> pd.DataFrame:
    """The merges of one group that no row outside can take part in, and the cluster of each row.

    ``apart`` is the distance to the nearest row outside. Mean distances to clusters outside stay above the mean of it over the
    rows of a cluster, whatever merges there, so clusters that are each other's nearest below both bounds merge in any order.
    """
    pdf = pdf.sort_values("id")
    ids, weight, apart = pdf["id"].to_numpy(np.int64), pdf["weight"].to_numpy(float), pdf["apart"].fillna(np.inf).to_numpy(float)
    x = np.stack(pdf["x"].to_numpy())
    n = len(ids)
    mean = np.empty((n, n))
    for s in chunked_rows(n, n):
        mean[s] = distances(x[s], x)
    mean = np.minimum(mean, mean.T)  # rounding must not tell the ends of a pair apart
    np.fill_diagonal(mean, np.inf)
    every = np.arange(n)
    near = mean.argmin(axis=1)
    height = mean[every, near]
    into, merges = every.copy(), []
    while True:
        limit = np.minimum(apart, apart[near]) * (1 - NEARLY)
        a = np.flatnonzero((near[near] == every) & (every < near) & (height < limit))
        if not len(a):
            break
        b = near[a]
        for i, j in zip(a, b):
            merges.append((height[i], ids[i], ids[j]))
            share = weight[j] / (weight[i] + weight[j])
            row = mean[i] * (1 - share) + mean[j] * share
            row[i] = row[j] = np.inf
            mean[i], mean[:, i] = row, row
            mean[j] = mean[:, j] = np.inf
            apart[i] = apart[i] * (1 - share) + apart[j] * share if np.isfinite(apart[i] + apart[j]) else np.inf
            weight[i] += weight[j]
            into[j], height[j], near[j] = i, np.inf, j
        moved = np.zeros(n, dtype=bool)
        moved[a] = moved[b] = True
        again = np.flatnonzero((moved | moved[near]) & (into == every))
        for s in chunked_rows(len(again), n, 1 << 20):
            rows = again[s]
            near[rows] = mean[rows].argmin(axis=1)
            height[rows] = mean[rows, near[rows]]
    while (into != into[into]).any():
        into = into[into]
    kept = pd.DataFrame({"id": ids, "cluster": ids[into]})
    return pd.concat([kept, pd.DataFrame(merges, columns=["height", "a", "b"])], ignore_index=True).reindex(
        columns=["id", "cluster", "height", "a", "b"]).astype({c: "Int64" for c in ("id", "cluster", "a", "b")}).astype({"height": float})


def _first_merges(points: DataFrame, width: int) -> tuple[DataFrame, list[DataFrame]]:
    """Merges that need no rounds: ``(id, x, cluster)`` of weighted rows, the last entry of ``x`` their weight, and the merges.

    Copies of one vector become one weighted row. Then groups of wide rows, whose rounds compare all rows, are merged by one task
    each, as far as no row outside can take part: a dense group, which grows by a row at a time, would take as many rounds as it has rows.
    """
    firsts = cut(points.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")))
    copies = points.join(firsts.filter("weight > 1").select("x", F.col("id").alias("a")), "x").filter("id <> a")
    rounds = [cut(copies.select(F.lit(0.0).alias("height"), "a", F.col("id").alias("b"), F.lit(1).alias("round")))]
    weighted = lambda d: d.select("id", F.concat("x", F.array(F.col("weight").cast("double"))).alias("x"), F.coalesce("cluster", "id").alias("cluster"))
    if width <= NARROW or firsts.count() <= MANY:
        return cut(weighted(firsts.withColumn("cluster", F.lit(None).cast("bigint")))), rounds
    grouped = cut(firsts.join(_groups(firsts), "id", "left").withColumn("tag", F.coalesce("root", "id")))
    inside = grouped.filter("root IS NOT NULL")
    away = knn_join(inside, grouped, id_col="id", x_col="x", k=1, skip_same="tag").select("id", F.col("distance").alias("apart"))
    merged = cut(inside.join(away, "id", "left").select("id", "x", "weight", "apart", "root").groupBy("root").applyInPandas(
        lambda pdf: _merged_inside(pdf), "id bigint, cluster bigint, height double, a bigint, b bigint"))
    rounds.append(merged.filter("a IS NOT NULL").select("height", "a", "b", F.lit(2).alias("round")))
    return cut(weighted(firsts.join(merged.filter("id IS NOT NULL").select("id", "cluster"), "id", "left"))), rounds


def _merged_rows(points: DataFrame, n: int, width: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Rounds that keep no sums, until at most ``MANY`` clusters are left: their rows, their sizes and the merges of each round."""
    odd = F.exists("x", lambda v: F.isnan(v) | v.isNull() | (F.abs(v) == float("inf")))
    ids, plain = points.agg(F.count_distinct("id"), F.count_if(~odd & (F.size("x") == width))).first()
    if ids == n == plain:
        members, rounds = _first_merges(points, width)
        table = _measured(members, width)
    else:
        members, rounds = cut(points.select("id", F.concat("x", F.array(F.lit(1.0))).alias("x"), F.col("id").alias("cluster"))), []
        table = cut(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.count(F.lit(1)).alias("rows")))
    n = table.count()
    state = cut(_closest(members, table, table, width)) if n > MANY else None
    while n > MANY:
        pairs = cut(_mutual(state))
        merged = pairs.count()
        if not merged:  # rounding kept the ends of equal means from agreeing: the first lowest pair is theirs
            both = [F.least("cluster", "near").alias("a"), F.greatest("cluster", "near").alias("b")]
            pairs, merged = cut(state.select("height", *both).orderBy("height", "a", "b").limit(1)), 1
        rounds.append(pairs.select("height", "a", "b", F.lit(len(rounds) + 1).alias("round")))
        into = pairs.select(F.col("b").alias("cluster"), F.col("a").alias("into"))
        members = cut(members.join(into, "cluster", "left").select("id", "x", F.coalesce("into", "cluster").alias("cluster")))
        table, n = _joined_table(table, pairs), n - merged
        if n > MANY:
            moved = pairs.select(F.explode(F.array("a", "b")).alias("cluster"))
            fresh = cut(state.join(moved, "cluster", "left_anti").join(moved.withColumnRenamed("cluster", "near"), "near", "left_anti"))
            stale = cut(table.join(fresh, "cluster", "left_anti"))
            state = cut(fresh.select("cluster", "near", "height").union(_closest(members, table, stale, width)))
    return members, table.select("cluster", "size", "rows"), rounds


def _first_sums(points: DataFrame, live: Live) -> DataFrame:
    """The state of single rows: every distance once, block pair by block pair."""
    blocks = build_blocks(points, "id", "x", pivots=np.zeros((0, 0)))

    def part(q: Block, c: Block) -> pd.DataFrame:
        place = np.searchsorted(live.ids, c.ids).astype(np.int32).tobytes()
        rows = [d.tobytes() for s in chunked_rows(len(q.ids), len(c.ids)) for d in distances(q.xs[s], c.xs)]
        return pd.DataFrame({"cluster": q.ids, "place": [place] * len(rows), "part": rows})

    return _whole_rows(join_blocks(blocks, blocks, every_pair(blocks, blocks), part, PARTS), live)


def _sums_of(members: DataFrame, table: DataFrame, width: int, live: Live) -> DataFrame:
    """The state of clusters of several rows, which may come in parts; the distances of two blocks are taken once, for the clusters of both."""
    blocks = _blocks_of(members, table, width)

    def told(ids: np.ndarray, others: np.ndarray, total: np.ndarray) -> pd.DataFrame:
        place = np.searchsorted(live.ids, others).astype(np.int32).tobytes()
        return pd.DataFrame({"cluster": ids, "place": [place] * len(ids), "part": [t.tobytes() for t in total]})

    def part(q: Block, c: Block) -> pd.DataFrame:
        (ids, _, _), (others, _, _), total = _cluster_sums(q, c)
        ours = told(ids, others, total)
        return ours if c is q else pd.concat([ours, told(others, ids, total.T)], ignore_index=True)

    return _whole_rows(join_blocks(blocks, blocks, every_pair(blocks, blocks), part, PARTS, both=True), live, in_parts=True)


def _whole_rows(parts: DataFrame, live: Live, in_parts: bool = False) -> DataFrame:
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, row = None, np.zeros(0)

        def told() -> pa.RecordBatch:
            size = live.sizes[np.searchsorted(live.ids, [at])]
            near, height = live.nearest(np.array([at]), size, row[None])
            return _batch(np.array([at]), size, near, height, row[None])

        for batch in batches:
            for cluster, place, piece in zip(batch.column("cluster").to_pylist(), batch.column("place"), batch.column("part")):
                if cluster != at:
                    if at is not None:
                        yield told()
                    at, row = cluster, np.zeros(len(live.ids))
                at_piece, sums = np.frombuffer(place.as_buffer(), dtype=np.int32), np.frombuffer(piece.as_buffer())
                row[at_piece] = row[at_piece] + sums if in_parts else sums
        if at is not None:
            yield told()

    return parts.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(whole, STATE)


def _batch(cluster: np.ndarray, size: np.ndarray, near: np.ndarray, height: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cluster), pa.array(size), pa.array(near), pa.array(height), pa.array([t.tobytes() for t in totals], pa.binary())],
        names=["cluster", "size", "near", "height", "totals"])


def _read(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    cluster, size, near, height = (batch.column(c).to_numpy() for c in ("cluster", "size", "near", "height"))
    return cluster, size, near, height, np.frombuffer(b"".join(batch.column("totals").to_pylist())).reshape(-1, width)


def _mutual(state: DataFrame) -> DataFrame:
    """Pairs that are each other's nearest: ``(height, a, b)``. Both ends chose a pair exactly when it shows up twice."""
    return state.groupBy(F.least("cluster", "near").alias("a"), F.greatest("cluster", "near").alias("b")).agg(
        F.min("height").alias("height"), F.count(F.lit(1)).alias("votes")).filter("votes = 2").select("height", "a", "b")


def _merged(state: DataFrame, live: Live, a: np.ndarray, b: np.ndarray) -> tuple[DataFrame, Live]:
    """The state after merging every ``b`` into its ``a``: columns are added in place, rows after one exchange."""
    at_a, at_b = np.searchsorted(live.ids, a), np.searchsorted(live.ids, b)
    sizes = live.sizes.copy()
    sizes[at_a] += sizes[at_b]
    after = Live(np.delete(live.ids, at_b), np.delete(sizes, at_b))
    order = np.argsort(b)
    from_b, to_a = b[order], a[order]
    moved = np.sort(np.concatenate([a, b]))
    width = len(live.ids)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, size, near, height, totals = _read(batch, width)
            totals = totals.copy()
            totals[:, at_a] += totals[:, at_b]
            totals = np.delete(totals, at_b, axis=1)
            stale = np.isin(cluster, moved) | np.isin(near, moved)
            k = np.minimum(np.searchsorted(from_b, cluster), len(from_b) - 1)
            into = np.where(from_b[k] == cluster, to_a[k], cluster)
            yield _batch(into, size, np.where(stale, -1, near), np.where(stale, np.nan, height), totals)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None

        def added(batch: pa.RecordBatch) -> pa.RecordBatch:
            cluster, size, near, height, totals = _read(batch, len(after.ids))
            first = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
            cluster, near, height = cluster[first], near[first].copy(), height[first].copy()
            size, totals = np.add.reduceat(size, first), np.add.reduceat(totals, first, axis=0)
            again = np.flatnonzero(np.isnan(height))
            if len(again) and len(after.ids) > 1:
                near[again], height[again] = after.nearest(cluster[again], size[again], totals[again])
            return _batch(cluster, size, near, height, totals)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cluster = batch.column("cluster").to_numpy()
            last = int(np.searchsorted(cluster, cluster[-1]))  # a pair may go on in the next batch
            if last:
                yield added(batch.slice(0, last))
            held = batch.slice(last)
        if held is not None:
            yield added(held)

    return state.mapInArrow(columns, STATE).repartition("cluster").sortWithinPartitions("cluster").mapInArrow(rows, STATE), after


def _finish(state: DataFrame, live: Live, turn: int) -> DataFrame:
    """The merges of the last few clusters, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cluster, size, _, _, total = (np.concatenate(x) for x in zip(*(_read(b, len(live.ids)) for b in batches if b.num_rows)))
        order = np.argsort(cluster)
        names, size, total = cluster[order], size[order].astype(float), total[order].copy()
        np.fill_diagonal(total, np.inf)
        out = []
        for _ in range(len(names) - 1):
            mean = total / (size[:, None] * size[None, :])
            i, j = sorted(np.unravel_index(mean.argmin(), mean.shape))
            out.append((float(mean[i, j]), int(names[i]), int(names[j]), turn))
            total[i] += total[j]
            total[:, i] = total[i]
            total[i, i] = np.inf
            total[j] = total[:, j] = np.inf
            size[i] += size[j]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["height", "a", "b", "round"]).astype({"round": "int32"}), preserve_index=False)

    return state.coalesce(1).mapInArrow(run, MERGES)


def dendrogram(df: DataFrame, *, id_col: str, x_col: str) -> DataFrame:
    """All ``n - 1`` merges ``(height, a, b, round)``; ``b`` joins ``a``, the smaller id.

    Average linkage is reducible, so every mutual-nearest pair can merge in the same round and the tree equals the one
    built a merge at a time. Beyond ``MANY`` clusters no sums are kept; the last ``FEW`` are merged by one task. Up to one row there is nothing to merge.
    """
    points = cut(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x")))
    n, width = points.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    spark = df.sparkSession
    if n < 2:
        return small_table(spark, [], MERGES)
    rounds: list[DataFrame] = []
    if n > MANY:
        members, table, rounds = _merged_rows(points, n, width)
        held = table.orderBy("cluster").toArrow()
        live = Live(held.column("cluster").to_numpy(), held.column("size").to_numpy().copy())
        first = _sums_of(members, table, width, live)
    else:
        ids = np.sort(points.select("id").toArrow().column("id").to_numpy())
        live = Live(ids, np.ones(len(ids), dtype=np.int64))
        first = _first_sums(points, live)
    state, found, turn = cut(first), [], len(rounds)
    while len(live.ids) > FEW:
        turn += 1
        pairs = _mutual(state).toArrow()
        found += [(h, a, b, turn) for h, a, b in zip(*(pairs.column(c).to_pylist() for c in ("height", "a", "b")))]
        merged, live = _merged(state, live, pairs.column("a").to_numpy(), pairs.column("b").to_numpy())
        state = cut(merged)
    merges = reduce(DataFrame.union, rounds, small_table(spark, found, MERGES))
    return merges.union(cut(_finish(state, live, turn + 1))) if len(live.ids) > 1 else merges


def cut_tree(df: DataFrame, merges: DataFrame, *, id_col: str, k: int) -> DataFrame:
    """Cut to ``k`` clusters: ``(id, cluster)``, numbered from 0 by their smallest id.

    The ``k - 1`` highest merges are undone; each remaining one is a parent pointer,
    and pointers are doubled until they reach the roots.
    """
    undone = merges.orderBy(F.desc("height"), F.desc("a"), F.desc("b")).limit(k - 1).select("b")
    parent = merges.join(undone, "b", "left_anti").select(F.col("b").alias("id"), F.col("a").alias("up"))
    links = cut(df.select(F.col(id_col).cast("bigint").alias("id")).join(parent, "id", "left").select(
        "id", F.coalesce("up", "id").alias("up")))
    while True:
        above = links.select(F.col("id").alias("up"), F.col("up").alias("top"))
        nxt = cut(links.join(above, "up").select("id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
        moved = nxt.filter("moved").isEmpty()
        links = nxt.select("id", "up")
        if moved:
            break
    names = number_by_order(links, "up", start=0)
    return links.join(names.withColumnRenamed("root", "up"), "up").select("id", F.col("number").alias("cluster"))


def average_linkage(df: DataFrame, *, id_col: str, x_col: str, k: int) -> DataFrame:
    return cut_tree(df, dendrogram(df, id_col=id_col, x_col=x_col), id_col=id_col, k=k)


@scoped
def sweep_linkage(df: DataFrame, *, id_col: str, x_col: str, ks: Sequence[int]) -> DataFrame:
    """Scores per k from one dendrogram, the first best silhouette marked; the silhouettes of all k share the distances."""
    tree = cut(dendrogram(df, id_col=id_col, x_col=x_col))
    base = cut(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(x_col).cast("array<double>").alias("x")))
    cuts = [cut(cut_tree(df, tree, id_col=id_col, k=k)) for k in ks]
    labelled = [base.join(c, "id") for c in cuts]
    if base.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        every, names = base, [f"k{i}" for i in range(len(cuts))]
        for c, name in zip(cuts, names):
            every = every.join(c.withColumnRenamed("cluster", name), "id")
        means = silhouettes(cut(every), id_col="id", x_col="x", cluster_cols=names)
    else:
        means = [silhouette(d, id_col="id", x_col="x", cluster_col="cluster").first()["silhouette"] for d in labelled]
    rows = [(k, mean, *indices(d, x_col="x", cluster_col="cluster")) for k, mean, d in zip(ks, means, labelled)]
    return mark_best(small_table(df.sparkSession,
        rows, "k int, silhouette double, calinski_harabasz double, davies_bouldin double"), "k")
