"""Neighbours, clustering and quality against brute force on small inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmine.functions import vectors
from sparkmine.operators import blocks, cluster_quality, components, dbscan, grid, kmeans, linkage, neighbors


def frame(spark, x, extra=None):
    rows = [(i, [float(v) for v in r], *([extra[i]] if extra is not None else [])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>" + (", tag int" if extra is not None else "")).repartition(5)


def gaps(x, p=2):
    diff = np.abs(x[:, None] - x[None])
    return np.sqrt((diff ** 2).sum(-1)) if p == 2 else diff.sum(-1)


def nearest(d, k, same=None):
    d = d.copy()
    d[np.eye(len(d), dtype=bool) if same is None else same] = np.inf
    out = set()
    for i, row in enumerate(d):
        order = sorted((v, j) for j, v in enumerate(row) if np.isfinite(v))[:k]
        out |= {(i, j, r + 1) for r, (_, j) in enumerate(order)}
    return out


@pytest.fixture
def many_cells(monkeypatch):
    """Make a few hundred rows fill several cells and blocks."""
    monkeypatch.setattr(blocks, "CELL_ROWS", 25)
    monkeypatch.setattr(grid, "CELL_ROWS", 25)
    monkeypatch.setattr(grid, "MAX_BLOCK_ROWS", 40)
    real = blocks._measure
    monkeypatch.setattr(blocks, "_measure", lambda placed, tagged, block_rows, pivots: real(placed, tagged, 40, pivots))


def sample(seed=0, n=300, copies=100):
    """Two blobs; a third of the rows are copies of one vector."""
    rng = np.random.default_rng(seed)
    x = np.round(np.concatenate([rng.normal(0, 1, ((n - copies) // 2, 2)), rng.normal(8, 1, ((n - copies) // 2, 2))]), 3)
    return np.concatenate([x, np.tile(x[0], (copies, 1))])


@pytest.mark.parametrize("p", [1, 2])
def test_knn_with_pruned_cells_and_hot_copies(spark, many_cells, p):
    x = sample()
    got = neighbors.k_nearest(frame(spark, x), id_col="id", x_col="x", k=4, p=p).collect()
    assert {(r["id"], r["neighbor"], r["rank"]) for r in got} == nearest(gaps(x, p), 4)


def test_knn_prunes_cells(spark, many_cells):
    df = frame(spark, sample())
    b = blocks.build_blocks(df, "id", "x")
    kept = blocks.pairs_within(b, b, blocks.knn_reach(b, b, 4))
    assert len(b.cells) > 4 and len(kept) < len(b.cells) ** 2


def test_knn_across_folds(spark, many_cells):
    x = sample(1)
    fold = (np.arange(len(x)) * 7 % 3).astype(int)
    df = frame(spark, x, [int(f) for f in fold])
    got = neighbors.knn_join(df, df, id_col="id", x_col="x", k=3, skip_same="tag").collect()
    assert {(r["id"], r["neighbor"], r["rank"]) for r in got} == nearest(gaps(x), 3, fold[:, None] == fold[None])


def test_more_neighbors_than_rows(spark):
    assert neighbors.k_nearest(frame(spark, np.array([[0.0], [1.0], [3.0]])), id_col="id", x_col="x", k=9).count() == 6


def test_large_sides_join_without_broadcast(spark, many_cells, monkeypatch):
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    x = sample(2)
    got = neighbors.k_nearest(frame(spark, x), id_col="id", x_col="x", k=3).collect()
    assert {(r["id"], r["neighbor"], r["rank"]) for r in got} == nearest(gaps(x), 3)


def test_radius_profile(spark, many_cells):
    x = sample(3)
    near = (gaps(x) <= 0.5) & ~np.eye(len(x), dtype=bool)
    for r in neighbors.radius_profile(frame(spark, x), id_col="id", x_col="x", eps=0.5).collect():
        found = np.nonzero(near[r["id"]])[0]
        assert r["n_neighbors"] == len(found)
        assert (r["first_neighbor"], r["last_neighbor"]) == ((found[0], found[-1]) if len(found) else (None, None))


def sequential_dbscan(x, eps, min_pts):
    near = (gaps(x) <= eps) & ~np.eye(len(x), dtype=bool)
    core, label, current = near.sum(1) >= min_pts, np.zeros(len(x), int), 0
    for i in range(len(x)):
        if label[i] or not core[i]:
            continue
        current += 1
        label[i], todo = current, [i]
        while todo:
            for j in np.nonzero(near[todo.pop()])[0]:
                if not label[j]:
                    label[j] = current
                    if core[j]:
                        todo.append(j)
    return label


@pytest.mark.parametrize("seed,eps,min_pts", [(0, 0.5, 4), (1, 0.3, 3), (2, 1.0, 8)])
def test_dbscan_equals_sequential(spark, many_cells, seed, eps, min_pts):
    x = sample(seed)
    got = {r["id"]: r["cluster"] for r in dbscan.dbscan(frame(spark, x), id_col="id", x_col="x", eps=eps, min_pts=min_pts).collect()}
    assert [got[i] for i in range(len(x))] == sequential_dbscan(x, eps, min_pts).tolist()


def test_dbscan_border_between_two_clusters_and_all_noise(spark):
    line = np.array([[0.0], [0.1], [0.2], [1.2], [2.2], [2.3], [2.4]])
    got = {r["id"]: r["cluster"] for r in dbscan.dbscan(frame(spark, line), id_col="id", x_col="x", eps=1.0, min_pts=3).collect()}
    assert [got[i] for i in range(7)] == sequential_dbscan(line, 1.0, 3).tolist()
    lonely = dbscan.dbscan(frame(spark, np.arange(5.0)[:, None]), id_col="id", x_col="x", eps=0.1, min_pts=2).collect()
    assert {r["cluster"] for r in lonely} == {0}


def test_components_on_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1301)]
    edges = spark.createDataFrame(chain + star, "a bigint, b bigint")
    got = {r["id"]: r["root"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1301)}}


def greedy_average(x, k):
    n, d = len(x), gaps(x)
    total, size, groups = d.copy(), np.ones(n), {i: [i] for i in range(n)}
    np.fill_diagonal(total, np.inf)
    while len(groups) > k:
        mean = total / (size[:, None] * size[None])
        i, j = sorted(np.unravel_index(mean.argmin(), mean.shape))
        total[i] += total[j]
        total[:, i] = total[i]
        total[i, i] = np.inf
        total[j] = total[:, j] = np.inf
        size[i] += size[j]
        groups[i] += groups.pop(j)
    label = np.zeros(n, int)
    for c, i in enumerate(sorted(groups)):
        label[groups[i]] = c
    return label


def test_average_linkage_equals_greedy(spark, monkeypatch):
    monkeypatch.setattr(linkage, "FEW", 4)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (150, 3)), rng.normal(4, 0.1, (250, 3))])  # one cluster outgrows a block
    df = frame(spark, x)
    tree = linkage.dendrogram(df, id_col="id", x_col="x")
    assert tree.count() == len(x) - 1
    for k in (2, 5):
        got = {r["id"]: r["cluster"] for r in linkage.cut_tree(df, tree, id_col="id", k=k).collect()}
        assert [got[i] for i in range(len(x))] == greedy_average(x, k).tolist()


def plain_lloyd(x, centers, rounds):
    label = np.zeros(len(x), int)
    for _ in range(rounds):
        new = gaps(np.concatenate([x, centers]))[: len(x), len(x):].argmin(1)
        if (new == label).all():
            break
        label = new
        centers = np.array([x[label == c].mean(0) if (label == c).any() else centers[c] for c in range(len(centers))])
    return label, centers


def test_lloyd_runs_side_by_side(spark):
    x = sample(4)
    df = frame(spark, x)
    starts = [x[[0, 150]], x[[3, 120, 199]], np.array([[0.0, 0.0], [50.0, 50.0]])]
    for fit, start in zip(kmeans.lloyd_many(df, [s.tolist() for s in starts], x_col="x"), starts):
        label, centers = plain_lloyd(x, start, 300)
        assert np.allclose(fit.centers, centers)
        got = {r["id"]: r["cluster"] for r in fit.transform(df, "x").collect()}
        assert [got[i] for i in range(len(x))] == label.tolist()


def test_silhouette_edges(spark):
    x = np.array([[0.0], [0.2], [5.0], [5.1], [99.0]])
    df = frame(spark, x, [1, 1, 2, 2, 3])
    rows = {r["id"]: r["silhouette"] for r in cluster_quality.silhouette_rows(df, id_col="id", x_col="x", cluster_col="tag").collect()}
    assert rows[4] == 0.0 and all(0.9 < rows[i] <= 1 for i in range(4))
    one = df.withColumn("tag", F.lit(1))
    assert cluster_quality.silhouette(one, id_col="id", x_col="x", cluster_col="tag").first()["silhouette"] == 0.0


def test_davies_bouldin_by_blocks(spark, monkeypatch):
    df = frame(spark, sample(6), [i % 7 for i in range(300)])
    few = cluster_quality.davies_bouldin(df, x_col="x", cluster_col="tag").first()
    monkeypatch.setattr(cluster_quality, "FEW_CLUSTERS", 0)
    many = cluster_quality.davies_bouldin(df, x_col="x", cluster_col="tag").first()
    assert few["n_clusters"] == many["n_clusters"] == 7 and abs(few["davies_bouldin"] - many["davies_bouldin"]) < 1e-9


def plain_silhouette(x, label, present=None):
    d, out = gaps(x), []
    for i in range(len(x)):
        own = (label == label[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min((d[i, label == c].mean() for c in set(label if present is None else present) if c != label[i]), default=a)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


@pytest.mark.parametrize("clusters", [2, 60])
def test_silhouette_with_split_and_whole_clusters(spark, clusters):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 3))
    label = np.where(rng.random(700) < 0.5, 0, rng.integers(1, clusters, 700))  # cluster 0 outgrows a block
    df = frame(spark, x, label.tolist())
    got = {r["id"]: r["silhouette"] for r in cluster_quality.silhouette_rows(df, id_col="id", x_col="x", cluster_col="tag").collect()}
    want = plain_silhouette(x, label)
    assert np.allclose([got[i] for i in range(700)], want)
    some = df.filter("id % 3 = 0")
    part = {r["id"]: r["silhouette"] for r in cluster_quality.silhouette_rows(df, id_col="id", x_col="x", cluster_col="tag", sample=some).collect()}
    want = plain_silhouette(x, label, label[::3])  # only clusters of the sample are neighbours
    assert len(part) == 234 and np.allclose([part[i] for i in sorted(part)], want[sorted(part)])


def test_large_sample_is_joined_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster_quality, "BROADCAST_BYTES", 0)
    x = sample(7, 90, 30)
    label = np.arange(90) % 4
    df = frame(spark, x, label.tolist())
    got = {r["id"]: r["silhouette"] for r in cluster_quality.silhouette_rows(df, id_col="id", x_col="x", cluster_col="tag", sample=df).collect()}
    assert np.allclose([got[i] for i in range(90)], plain_silhouette(x, label))


def test_kmeans_sweep_marks_the_best(spark):
    df = frame(spark, sample(8, 120, 30))
    rows = cluster_quality.sweep_kmeans(df, id_col="id", x_col="x", ks=(2, 3), sample_rows=None).orderBy("k").collect()
    for r in rows:
        fit = kmeans.kmeans(df, id_col="id", x_col="x", k=r["k"])
        labelled = fit.transform(df, "x")
        found = cluster_quality.scores(labelled, id_col="id", x_col="x", cluster_col="cluster")
        assert np.allclose(found, (r["silhouette"], r["calinski_harabasz"], r["davies_bouldin"]))
    best = max(rows, key=lambda r: r["silhouette"])
    assert [r["is_best"] for r in rows] == [r is best for r in rows]


def test_eps_sweep_equals_sequential(spark):
    x = sample(10, 60, 8)
    results, best = dbscan.sweep_eps(frame(spark, x), id_col="id", x_col="x", min_pts=4)
    d = gaps(x)
    kd = np.sort(d, axis=1)[:, 3]
    p = np.quantile(kd, [0.25, 0.5, 0.75, 0.9])
    for r, eps in zip(results.orderBy("step").collect(), [*p, 1.5 * p[3], 2 * p[3]]):
        label = sequential_dbscan(x, eps, 4)
        kept = [c for c in set(label) - {0} if (label == c).sum() >= 2]
        assert r["eps"] == pytest.approx(eps) and r["n_noise"] == (label == 0).sum() and r["n_clusters"] == len(set(label) - {0})
        mask = np.isin(label, kept)
        want = plain_silhouette(x[mask], label[mask]).mean() if len(kept) > 1 else -1.0
        assert r["silhouette"] == pytest.approx(want)
        assert r["is_best"] == (r["eps"] == best)


def test_stripes_equal_copies_and_move_each_block_to_the_stripes_only(spark, many_cells, monkeypatch):
    """Both sides too large to copy: same neighbours and sums, and one exchange of payloads before the comparison."""
    x = sample(3)
    df = frame(spark, x, (np.arange(len(x)) % 3).tolist())
    run = lambda: (
        set(map(tuple, neighbors.k_nearest(df, id_col="id", x_col="x", k=4).select("id", "neighbor", "rank").collect())),
        sorted((r["id"], round(r["sum_distance"], 6), r["n_others"]) for r in neighbors.distance_profile(df, id_col="id", x_col="x").collect()),
        sorted((r["id"], round(r["silhouette"], 9)) for r in cluster_quality.silhouette_rows(df, id_col="id", x_col="x", cluster_col="tag").collect()))
    copied = run()
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "STRIPE_BYTES", 2500)
    assert run() == copied
    b = blocks.build_blocks(df, "id", "x")
    tiles = blocks.join_blocks(b, b, blocks.every_pair(b, b), lambda q, c: None, "id bigint")
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Union")[0] and plan.split("Union")[0].count("Exchange") == 1


@pytest.mark.parametrize("copied", [True, False])
def test_block_pairs_are_dealt_to_more_tasks_and_pass_on_one_result_a_block(spark, many_cells, monkeypatch, copied):
    """The work of a task is bounded, and a task passes on the best candidates of a query block, not those of every pair."""
    monkeypatch.setattr(blocks, "TASK_PAIRS", 1500, raising=False)
    monkeypatch.setattr(blocks, "STRIPE_ROWS", 40, raising=False)
    if not copied:
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    b = blocks.build_blocks(frame(spark, sample(6)), "id", "x", pivots=np.zeros((0, 0)), block_rows=40)
    pairs = blocks.every_pair(b, b)
    told = lambda q, c: pd.DataFrame({"id": q.ids, "n": len(c.ids)})
    merge = lambda d: d.groupby("id", as_index=False).agg({"n": "sum"})
    out = blocks.join_blocks(b, b, pairs, told, "id bigint, n bigint", merge).withColumn("task", F.spark_partition_id()).collect()
    n, tasks = b.rows, {r["task"] for r in out}
    assert len(tasks) > 32  # four for each core is what one task list of fixed length had
    assert len(out) == len({(r["id"], r["task"]) for r in out})
    assert {i: sum(r["n"] for r in out if r["id"] == i) for i in range(n)} == dict.fromkeys(range(n), n)


@pytest.mark.parametrize("both", [False, True])
def test_results_kept_in_the_blocks_are_told_once_a_task(spark, many_cells, both):
    """With ``tell`` a block's result is told when its pairs are done; with ``both`` a pair is compared once for its two blocks."""
    b = blocks.build_blocks(frame(spark, sample(7)), "id", "x", pivots=np.zeros((0, 0)), block_rows=40)

    def meet(q, c):
        q.kept = (0 if q.kept is None else q.kept) + len(c.ids)
        if both and q is not c:
            c.kept = (0 if c.kept is None else c.kept) + len(q.ids)

    told = lambda q: pd.DataFrame({"id": q.ids, "n": q.kept})
    out = blocks.join_blocks(b, b, blocks.every_pair(b, b), meet, "id bigint, n bigint", tell=told, both=both)
    met = {}
    for r in out.collect():
        met[r["id"]] = met.get(r["id"], 0) + r["n"]
    assert met == dict.fromkeys(range(b.rows), b.rows)


def test_silhouettes_of_several_labellings_take_the_distances_once(spark, many_cells, monkeypatch):
    x, n = sample(8), 300
    labels = np.stack([np.arange(n) % 2, np.arange(n) % 3, np.where(np.arange(n) == 7, 5, 4)], axis=1)
    df = frame(spark, x).join(spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(labels)], "id bigint, a int, b int, c int"), "id")
    joins, real = [], cluster_quality.join_blocks
    monkeypatch.setattr(cluster_quality, "join_blocks", lambda *a, **o: joins.append(1) or real(*a, **o))
    got = cluster_quality.silhouettes(df, id_col="id", x_col="x", cluster_cols=["a", "b", "c"])
    assert len(joins) == 1
    assert np.allclose(got, [plain_silhouette(x, labels[:, i]).mean() for i in range(3)])


def test_crowded_cell_is_dealt_to_many_tasks(spark, many_cells, monkeypatch):
    """One cell that holds all rows is compared by many tasks, each pair of blocks once."""
    monkeypatch.setattr(grid, "TILE", 2, raising=False)
    df = frame(spark, np.random.default_rng(3).random((400, 2)) * 0.1 + 0.2)
    cells = grid.Grid(1.0, 2)
    b = cells.blocks(df, "id", "x")
    told = lambda q, c: pd.DataFrame({"id": q.ids, "n": len(c.ids)})
    merge = lambda d: d.groupby("id", as_index=False).agg({"n": "sum"})
    joined = grid.join_cells(b, b, 2, told, "id bigint, n bigint", merge)
    out = joined.withColumn("task", F.spark_partition_id()).collect()
    assert {i: sum(r["n"] for r in out if r["id"] == i) for i in range(400)} == dict.fromkeys(range(400), 400)
    assert len({r["task"] for r in out}) > 4
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString().split("Union")[0]


def test_grid_cells_follow_the_rows_and_split_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(grid, "CELL_ROWS", 20)
    monkeypatch.setattr(grid, "MAX_BLOCK_ROWS", 30)
    rng = np.random.default_rng(8)
    cells = []
    for n in (100, 400):
        x = rng.random((n, 2)) * 10
        x[: n // 3] = 5.0
        df = frame(spark, x)
        g = grid.grid_for(df, "x", 0.1)
        packed = g.blocks(df, "id", "x").selectExpr("gx", "gy", "length(ids) / 8 AS n").collect()
        assert sum(r["n"] for r in packed) == n and max(r["n"] for r in packed) <= 60
        cells.append(len({(r["gx"], r["gy"]) for r in packed}))
    assert cells[1] > 2 * cells[0]


def wide_sample(kind, n=260, width=24, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    x[n // 2:n // 2 + 60] = x[0]  # copies, and near copies
    x[-30:] = x[1] + rng.normal(size=(30, width)) * 1e-7
    return {"plain": x, "offset": x * 1e-3 + 1e6, "outlier": np.concatenate([x, x[:1] * 1e9]), "tiny": x * 1e-160,
            "huge": np.concatenate([x, x[:1] * 1e200])}[kind]


@pytest.mark.parametrize("kind", ["plain", "offset", "outlier", "tiny", "huge"])
def test_floors_stay_below_squares(kind):
    x = wide_sample(kind)
    with np.errstate(over="ignore"):
        exact = ((x[:, None] - x[None]) ** 2).sum(-1)
    terms = vectors.floor_terms(x, x)
    if kind == "huge":
        assert terms is None
        return
    f, g, scale = terms
    low = (f @ g).astype(float) * scale
    assert (low <= exact).all() and (exact - low).max() < 1e-4 * scale


@pytest.mark.parametrize("kind", ["plain", "offset", "outlier", "huge"])
@pytest.mark.parametrize("stripes", [False, True])
def test_wide_neighbors_equal_brute_force(spark, many_cells, monkeypatch, kind, stripes):
    if stripes:
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    x = wide_sample(kind)
    with np.errstate(over="ignore", invalid="ignore"):
        exact = gaps(x)
    fold = (np.arange(len(x)) * 7 % 3).astype(int)
    df = frame(spark, x, [int(f) for f in fold])
    got = neighbors.k_nearest(df, id_col="id", x_col="x", k=4).collect()
    assert {(r["id"], r["neighbor"], r["rank"]) for r in got} == nearest(exact, 4)
    across = neighbors.knn_join(df, df, id_col="id", x_col="x", k=5, skip_same="tag").collect()
    assert {(r["id"], r["neighbor"], r["rank"]) for r in across} == nearest(exact, 5, fold[:, None] == fold[None])


def test_rows_without_a_finite_distance_have_no_neighbors(spark):
    x = wide_sample("plain", 200)
    x[3, 0], x[4, 1] = np.nan, np.inf
    got = {(r["id"], r["neighbor"], r["rank"]) for r in neighbors.k_nearest(frame(spark, x), id_col="id", x_col="x", k=3).collect()}
    rest = np.delete(np.arange(200), [3, 4])
    assert got == {(rest[i], rest[j], r) for i, j, r in nearest(gaps(x[rest]), 3)}


def test_wide_neighbors_take_few_squares(monkeypatch):
    x, taken = np.random.default_rng(6).normal(size=(4000, 64)), []
    real = vectors.paired_squares
    monkeypatch.setattr(neighbors, "paired_squares", lambda a, b, rows, cols: taken.append(len(rows)) or real(a, b, rows, cols))
    monkeypatch.setattr(neighbors, "powers", lambda *_: pytest.fail("all squares were taken in double precision"))
    part = [blocks.Block(np.arange(i, i + 1000), x[i:i + 1000], np.arange(i, i + 1000), np.ones(1000)) for i in range(0, 4000, 1000)]
    best = neighbors._Best(1000, 5)
    for b in part:
        for rows, cols, reached in neighbors._sifted(part[0], b, np.arange(1000), best.far[:, -1], 5, 2, True):
            best.add(rows, np.sqrt(reached), b.ids[cols])
    best.rank()
    assert {(i, j, r + 1) for i in range(1000) for r, j in enumerate(best.near[i])} == {t for t in nearest(gaps(x), 5) if t[0] < 1000}
    assert sum(taken) < 4_000_000 / 100


def silhouettes_of(x, label):
    d, out = gaps(x), []
    for i, own in enumerate(label):
        mean = {c: d[i, label == c].sum() / ((label == c).sum() - (c == own) or 1) for c in set(label)}
        a, b = mean.pop(own), min(mean.values())
        out.append(0.0 if (label == own).sum() == 1 or not max(a, b) else (b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("small", [4, 7, 1])
def test_silhouettes_of_many_clusters_equal_brute_force(spark, small):
    """One cluster of several blocks, one of two, and many small ones: whole in their block."""
    rng = np.random.default_rng(small)
    label = np.concatenate([np.zeros(400, int), np.ones(150, int), 2 + np.arange(280) // small])
    x = rng.normal(size=(label.max() + 1, 2))[label] * 3 + rng.normal(size=(len(label), 2))
    got = cluster_quality.silhouette_rows(frame(spark, x, [int(v) for v in label]), id_col="id", x_col="x", cluster_col="tag").collect()
    found = {r["id"]: r["silhouette"] for r in got}
    assert len(got) == len(x)
    np.testing.assert_allclose([found[i] for i in range(len(x))], silhouettes_of(x, label), atol=1e-9)


def test_silhouettes_take_each_distance_once(monkeypatch):
    rng, taken = np.random.default_rng(8), []
    x, label = rng.normal(size=(900, 2)), np.sort(rng.integers(0, 90, 900))
    label[:300] = 0
    real = cluster_quality.distances
    monkeypatch.setattr(cluster_quality, "distances", lambda a, b: taken.append(len(a) * len(b)) or real(a, b))
    size = np.bincount(label)[label].astype(float)
    cuts = [0, 150, 480, 900]  # the first cluster lies in two blocks
    cuts[2] = int(np.searchsorted(label, label[480]))
    part = [blocks.Block(np.arange(i, j), x[i:j], label[i:j], size[i:j]) for i, j in zip(cuts, cuts[1:])]
    for i, q in enumerate(part):
        for c in part[i:]:
            cluster_quality._meet(q, c)
    assert sum(taken) == (900 ** 2 + sum(len(b.ids) ** 2 for b in part)) // 2
    rows = pd.concat([cluster_quality._met(b) for b in part]).groupby(["id", "cluster", "other"], as_index=False).sum()
    own = rows[rows["cluster"] == rows["other"]].set_index("id")
    a = (own["total"] / (own["n"] - 1)).sort_index()
    b = (rows["total"] / rows["n"])[rows["cluster"] != rows["other"]].groupby(rows["id"]).min().sort_index()
    np.testing.assert_allclose(((b - a) / np.maximum(a, b)).to_numpy(), silhouettes_of(x, label), atol=1e-9)
