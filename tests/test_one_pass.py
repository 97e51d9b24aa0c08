"""Operators that serve many models, columns, radii or merges from one structure, against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import classify, dbscan, eda, linkage, metrics, moments, reduction, stacked, trees, tuning

RNG = np.random.default_rng(31)


def vectors(spark, x, **columns):
    rows = [(i, [None if np.isnan(v) else float(v) for v in row], *(c[i] for c in columns.values())) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>" + "".join(f", {k} int" for k in columns))


# linkage


def test_linkage_takes_every_distance_once(spark, monkeypatch):
    cells = spark.sparkContext.accumulator(0)
    real = linkage.distances

    def counted(a, b):
        cells.add(len(a) * len(b))
        return real(a, b)

    monkeypatch.setattr(linkage, "distances", counted)
    x = RNG.normal(size=(300, 3))
    merges = linkage.dendrogram(vectors(spark, x), id_col="id", x_col="x").collect()
    assert len(merges) == 299 and max(r["round"] for r in merges) > 5
    assert cells.value == 300 * 300


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_linkage_of_few_rows(spark, n):
    df = spark.createDataFrame([(k, [float(k * k)]) for k in range(n)], "id bigint, x array<double>")
    assert linkage.dendrogram(df, id_col="id", x_col="x").count() == max(n - 1, 0)


def test_linkage_of_copies(spark, monkeypatch):
    monkeypatch.setattr(linkage, "FEW", 3)
    x = np.repeat(RNG.normal(size=(5, 2)), 12, axis=0)
    merges = linkage.dendrogram(vectors(spark, x), id_col="id", x_col="x").collect()
    assert len(merges) == 59 and sum(r["height"] < 1e-9 for r in merges) == 55


def test_linkage_of_many_rows_keeps_no_sums(spark, monkeypatch):
    """Rounds that sum anew and rounds on kept sums make the same tree; clusters may outgrow a block, ids may be far apart."""
    x = np.concatenate([RNG.normal(size=(250, 3)), RNG.normal(6, 0.1, size=(300, 3)), np.full((40, 3), 3.0)])
    df = vectors(spark, x).withColumn("id", F.col("id") * 7 - 1000)
    read = lambda: sorted((r["a"], r["b"], round(r["height"], 9)) for r in linkage.dendrogram(df, id_col="id", x_col="x").collect())
    kept = read()
    monkeypatch.setattr(linkage, "MANY", 12)
    monkeypatch.setattr(linkage, "FEW", 4)
    widest = []
    real = linkage._whole_rows
    monkeypatch.setattr(linkage, "_whole_rows", lambda parts, live, in_parts=False: widest.append(len(live.ids)) or real(parts, live, in_parts))
    assert read() == kept and max(widest) <= 12


# density clustering at several radii


@pytest.mark.parametrize("width", [1, 2, 5])
def test_levels_equal_single_runs(spark, width):
    x = np.concatenate([RNG.normal(k, 0.4, size=(40, width)) for k in (0, 2, 5)] + [RNG.uniform(-2, 7, size=(40, width))])
    x[:6] = x[0]  # copies
    radii = np.quantile([np.linalg.norm(a - b) for a in x[::3] for b in x[1::3]], [0.005, 0.02, 0.08, 0.2]).tolist()
    df = vectors(spark, x)
    got = {(r["level"], r["id"]): r["cluster"] for r in dbscan.dbscan_levels(df, id_col="id", x_col="x", radii=radii, min_pts=4).collect()}
    for level, eps in enumerate(radii):
        want = {r["id"]: r["cluster"] for r in dbscan.dbscan(df, id_col="id", x_col="x", eps=eps, min_pts=4).collect()}
        assert {k: got[level, k] for k in want} == want


def test_levels_without_rows_or_cores(spark):
    df = spark.createDataFrame([(k, [100.0 * k]) for k in range(5)], "id bigint, x array<double>")
    got = dbscan.dbscan_levels(df, id_col="id", x_col="x", radii=[1.0, 2.0], min_pts=2).collect()
    assert len(got) == 10 and {r["cluster"] for r in got} == {0}
    assert dbscan.dbscan_levels(df.limit(0), id_col="id", x_col="x", radii=[1.0], min_pts=2).count() == 0


# trees


def test_rows_without_a_label_take_no_part(spark):
    rows = [(i, float(i), [0, None, 1, None][i % 4] if i < 8 else int(i > 12)) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, a double, label int")
    whole = trees.tree_table(df, trees.grow_tree(df, id_col="id", numeric=["a"], categorical=[], label_col="label", max_depth=4)).collect()
    known = df.filter("label IS NOT NULL")
    want = trees.tree_table(known, trees.grow_tree(known, id_col="id", numeric=["a"], categorical=[], label_col="label", max_depth=4)).collect()
    assert sorted(whole) == sorted(want) and len(whole) > 3
    probe = spark.createDataFrame([(0, 0.0, 0), (1, 0.0, None), (2, 1.0, 1), (3, 1.0, None)], "id bigint, a double, label int")
    assert len(trees.grow_tree(probe, id_col="id", numeric=["a"], categorical=[], label_col="label").nodes) == 3
    empty = trees.grow_tree(df.limit(0), id_col="id", numeric=["a"], categorical=[], label_col="label")
    assert empty.nodes == []


def test_jobs_do_not_depend_on_the_number_of_trees(spark):
    df = spark.createDataFrame([(i, float(RNG.normal()), float(RNG.normal()), int(RNG.integers(3))) for i in range(200)], "id bigint, a double, b double, label int")
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n in (2, 12):
        spark.sparkContext.setJobGroup(f"forest-{n}", "forest")
        forest = trees.exact_forest(df, id_col="id", features=["a", "b"], label_col="label", n_trees=n, subset=1, max_depth=3)
        jobs.append(len(tracker.getJobIdsForGroup(f"forest-{n}")))
        assert {r["tree"] for r in forest.nodes} == set(range(n))
        votes = trees.tree_votes(df, forest, id_col="id")
        assert votes.count() == 200 * n
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs[1] <= jobs[0] + 4


def test_prediction_stops_at_unseen_values(spark):
    rows = [(i, "pqr"[i % 3], float(i), int(i % 3 == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, c string, a double, label int")
    tree = trees.grow_tree(df, id_col="id", numeric=["a"], categorical=["c"], label_col="label", max_depth=2)
    probe = spark.createDataFrame([(0, "p", 1.0, 5), (1, "new", 1.0, 5), (2, None, None, 5)], "id bigint, c string, a double, extra int")
    got = {r["id"]: r["prediction"] for r in tree.predict(probe).collect()}
    assert got == {0: 1, 1: 0, 2: 0} and tree.predict(probe).columns == ["id", "c", "a", "extra", "prediction"]


# stacked linear models


def classes_in_space(n=240, width=6, k=3):
    centre = RNG.normal(size=(k, width)) * 1.2
    y = RNG.integers(0, k, n)
    return centre[y] + RNG.normal(size=(n, width)), y


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_stacked_models_equal_separate_ones(spark, loss):
    x, y = classes_in_space()
    fold = np.arange(len(y)) % 3
    df = vectors(spark, x, label=y.tolist(), fold=fold.tolist())
    penalties = [0.05, 2.0]
    both = stacked.fit_stack(df, x_col="x", label_col="label", penalties=penalties, fold_col="fold", n_folds=3, loss=loss)
    for i, c in enumerate(penalties):
        for f in range(3):
            alone = stacked.fit_stack(df.filter(F.col("fold") != f), x_col="x", label_col="label", penalties=[c], loss=loss)
            task = slice((i * 3 + f) * 3, (i * 3 + f + 1) * 3)
            assert np.allclose(both.weights[:, task], alone.weights, atol=1e-5)


def test_stacked_search_scores_as_library_fits_do(spark):
    x, y = classes_in_space(360, 5, 3)
    df = vectors(spark, x, label=y.tolist(), fold=(np.arange(len(y)) % 3).tolist())
    params = [{"C": 0.02}, {"C": 1.0}]
    ours = {r["candidate"]: r for r in stacked.search_linear(df, params, id_col="id", x_col="x", label_col="label", fold_col="fold", n_folds=3, loss="logistic").collect()}

    def library(train, test, p, fold):
        from pyspark.ml.classification import LogisticRegression, OneVsRest

        one = LogisticRegression(regParam=1.0 / (p["C"] * train.count()), standardization=False, maxIter=200, tol=1e-9)
        return OneVsRest(classifier=one).fit(train).transform(test)

    rows = classify.with_vector(df, "x").select("id", "features", "label", "fold")
    for r in tuning.search(rows, library, params, fold_col="fold", label_col="label", n_folds=3).collect():
        assert abs(r["mean_score"] - ours[r["candidate"]]["mean_score"]) <= 1e-3


def test_hinge_reaches_the_library_objective(spark):
    x, y = classes_in_space(300, 4, 2)
    df = vectors(spark, x, label=y.tolist())
    w = stacked.fit_stack(df, x_col="x", label_col="label", penalties=[1.0]).weights[:, 1]
    model = classify.linear_svm(classify.with_vector(df, "x"), C=1.0, max_iter=200).models[1]

    def objective(v, b):
        return np.maximum(0, 1 - np.where(y == 1, 1, -1) * (x @ v + b)).mean() + 0.5 / len(y) * v @ v

    assert objective(w[:-1], w[-1]) <= objective(np.array(model.coefficients), model.intercept) + 1e-3


def test_stacked_odd_rows(spark):
    x, y = classes_in_space(60, 3, 2)
    labels = [None if k % 10 == 0 else int(v) for k, v in enumerate(y)]
    df = vectors(spark, x, label=labels, fold=[int(k < 30) for k in range(60)])
    got = stacked.search_linear(df, [{"C": 1.0}], id_col="id", x_col="x", label_col="label", fold_col="fold", n_folds=2).collect()
    assert len(got) == 1 and 0 <= got[0]["mean_score"] <= 1
    with pytest.raises(ValueError):
        stacked.fit_stack(df.limit(0), x_col="x", label_col="label", penalties=[1.0])


def test_summaries_by_group_equal_single_ones(spark):
    rows = [(int(RNG.integers(2)), int(RNG.integers(3)), int(RNG.integers(3))) for _ in range(80)]
    df = spark.createDataFrame(rows, "g int, label int, prediction int")
    by = {r["g"]: tuple(r)[1:] for r in metrics.summary(df, label_col="label", prediction_col="prediction", by=["g"]).collect()}
    for g in (0, 1):
        one = tuple(metrics.summary(df.filter(F.col("g") == g), label_col="label", prediction_col="prediction").first())
        assert np.allclose(by[g], one)


# many columns


def test_pair_statistics_equal_pandas(spark):
    x = RNG.normal(size=(90, 11))
    x[:, 3] = 2.0
    x[RNG.random(x.shape) < 0.2] = np.nan
    x[:, 7] = np.nan
    got = {(r["a"], r["b"]): (r["n"], r["covariance"], r["r"]) for r in moments.pair_statistics(vectors(spark, x).repartition(5), "x", tile=4).collect()}
    table = pd.DataFrame(x)
    r, cov, seen = table.corr(), table.cov(), (~np.isnan(x)).astype(int)
    assert set(got) == {(a, b) for a in range(11) for b in range(a, 11)}
    for (a, b), (n, c, v) in got.items():
        assert n == (seen[:, a] * seen[:, b]).sum()
        assert (c is None) == bool(np.isnan(cov[a][b])) and (c is None or abs(c - cov[a][b]) < 1e-9)
        assert (v is None) == bool(np.isnan(r[a][b])) and (v is None or abs(v - r[a][b]) < 1e-9)


def test_correlation_of_many_columns(spark):
    x = RNG.normal(size=(50, 12))
    names = [f"c{k}" for k in range(12)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names))
    wide = {(r["a"], r["b"]): r["r"] for r in eda.correlation(df, names, narrow=5).collect()}
    few = {(r["a"], r["b"]): r["r"] for r in eda.correlation(df, names).collect()}
    assert set(wide) == set(few) and all(abs(wide[k] - few[k]) < 1e-9 for k in few)


def plain_pca(x, k):
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    v = vt[:k].T
    top = np.abs(v).argmax(axis=0)
    return v * np.where(v[top, np.arange(k)] < 0, -1, 1), s[:k] ** 2 / (s ** 2).sum()


def test_components_of_a_wide_table(spark):
    """As many columns as an encoded table has: the plan names none of them."""
    width, n = 2400, 150
    x = RNG.normal(size=(n, 6)) * [9, 7, 5, 3, 2, 1] @ RNG.normal(size=(6, width)) + RNG.normal(size=(n, width)) * 0.1
    df = vectors(spark, x)
    want, ratios = plain_pca(x, 3)
    found = reduction.fit_pca(df, x_col="x", k=3)
    assert np.allclose(found.loadings, want, atol=1e-6) and np.allclose(found.ratios, ratios, atol=1e-8)
    plan = moments.tiles(df, "x", moments.columns(df, "x"))._jdf.queryExecution().toString()
    assert len(plan) < 20_000
    at = reduction.WIDE
    try:
        reduction.WIDE = 100
        sought = reduction.fit_pca(df, x_col="x", k=3)
    finally:
        reduction.WIDE = at
    assert np.allclose(sought.loadings, want, atol=1e-5) and np.allclose(sought.ratios, ratios, atol=1e-7)


def test_components_of_no_rows_and_of_holes(spark):
    empty = vectors(spark, np.zeros((0, 3)))
    assert reduction.fit_pca(empty, x_col="x", k=2).ratios == []
    assert moments.pair_statistics(empty, "x").count() == 0
    with pytest.raises(ValueError):
        reduction.fit_pca(vectors(spark, np.array([[1.0, np.nan], [2.0, 3.0]])), x_col="x", k=1)


def merged_one_by_one(x, ids):
    far = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(far, np.inf)
    weight, out = np.ones(len(x)), []
    for _ in range(len(x) - 1):
        i, j = sorted(np.unravel_index(far.argmin(), far.shape))
        out.append((int(ids[i]), int(ids[j]), round(float(far[i, j]), 9)))
        row = (far[i] * weight[i] + far[j] * weight[j]) / (weight[i] + weight[j])
        row[[i, j]] = np.inf
        far[i], far[:, i] = row, row
        far[j] = far[:, j] = np.inf
        weight[i] += weight[j]
    return sorted(out)


@pytest.mark.parametrize("width", [2, 16])
def test_linkage_of_copies_and_dense_groups_takes_few_rounds(spark, monkeypatch, width):
    """A group that grows by a row at a time is no reason for a round for each of its rows."""
    rng = np.random.default_rng(7)
    x = np.concatenate([np.repeat(rng.normal(size=(1, width)), 150, axis=0), rng.normal(size=(60, width))])
    if width > linkage.NARROW:
        x = np.concatenate([x, 50 + 0.01 * rng.normal(size=(60, width)) * rng.uniform(0.2, 1, size=(60, 1))])
    monkeypatch.setattr(linkage, "MANY", 61)
    merges = linkage.dendrogram(vectors(spark, x), id_col="id", x_col="x").collect()
    copies = lambda rows: sorted(r for r in rows if r[2] > 0)
    assert copies((r["a"], r["b"], round(r["height"], 9)) for r in merges) == copies(merged_one_by_one(x, np.arange(len(x))))
    assert len(merges) == len(x) - 1 and max(r["round"] for r in merges) < 30


def test_linkage_of_narrow_rows_sums_up_candidates_only(spark, monkeypatch):
    cells = spark.sparkContext.accumulator(0)
    real = linkage._ragged_sums

    def counted(ours, theirs):
        cells.add(int((ours[2] * theirs[2]).sum()))
        return real(ours, theirs)

    monkeypatch.setattr(linkage, "_ragged_sums", counted)
    monkeypatch.setattr(linkage, "_nearest", None)  # never all rows
    monkeypatch.setattr(linkage, "MANY", 150)
    monkeypatch.setattr(linkage, "PAIR_COST", 0)
    x = np.random.default_rng(8).normal(size=(500, 2))
    merges = linkage.dendrogram(vectors(spark, x), id_col="id", x_col="x").collect()
    assert sorted((r["a"], r["b"], round(r["height"], 9)) for r in merges) == merged_one_by_one(x, np.arange(500))
    assert 0 < cells.value < 500 * 500 / 2
