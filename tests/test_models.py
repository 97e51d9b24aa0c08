"""Trees, outliers, metrics, selection, classifiers and search against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import classify, feature_select, metrics, outliers, trees, tuning


def plain_gini(y):
    _, c = np.unique(y, return_counts=True)
    return 1 - ((c / c.sum()) ** 2).sum()


def plain_tree(num, cat, y, depth):
    """Predictor grown by trying every threshold; features in order, first best wins."""
    classes, counts = np.unique(y, return_counts=True)
    top = sorted((c for c, n in zip(classes, counts) if n == counts.max()), key=str)[0]
    if len(classes) == 1 or depth == 0:
        return lambda n, c: top
    best = None
    for f in range(num.shape[1]):
        order = np.argsort(num[:, f], kind="stable")
        v, l = num[order, f], y[order]
        mine = None
        for i in range(1, len(v)):
            if v[i] != v[i - 1] and l[i] != l[i - 1]:
                g = round((i * plain_gini(l[:i]) + (len(l) - i) * plain_gini(l[i:])) / len(l), 12)
                if mine is None or g < mine[0]:
                    mine = (g, ("num", f, (v[i] + v[i - 1]) / 2))
        if mine and (best is None or mine[0] < best[0]):
            best = mine
    for f in range(cat.shape[1]):
        seen = np.unique(cat[:, f])
        if len(seen) > 1:
            g = round(sum((cat[:, f] == s).mean() * plain_gini(y[cat[:, f] == s]) for s in seen), 12)
            if best is None or g < best[0]:
                best = (g, ("cat", f, seen))
    if best is None:
        return lambda n, c: top
    kind, f, at = best[1]
    if kind == "num":
        left = num[:, f] < at
        low, high = (plain_tree(num[m], cat[m], y[m], depth - 1) for m in (left, ~left))
        return lambda n, c: low(n, c) if n[f] < at else high(n, c)
    kids = {s: plain_tree(num[cat[:, f] == s], cat[cat[:, f] == s], y[cat[:, f] == s], depth - 1) for s in at}
    return lambda n, c: kids[c[f]](n, c) if c[f] in kids else top


def test_exact_tree_equals_plain_recursion(spark):
    rng = np.random.default_rng(0)
    n = 300
    num = np.round(rng.normal(size=(n, 2)), 1)
    cat = rng.choice(["p", "q", "r"], size=(n, 1))
    y = ((num[:, 0] > 0.3).astype(int) + (cat[:, 0] == "q") * (num[:, 1] < 0)).astype(int)
    y[rng.random(n) < 0.1] = 2
    df = spark.createDataFrame([(i, float(a), float(b), str(c[0]), int(t)) for i, ((a, b), c, t) in enumerate(zip(num, cat, y))],
                               "id bigint, a double, b double, c string, label int")
    tree = trees.grow_tree(df, id_col="id", numeric=["a", "b"], categorical=["c"], label_col="label", max_depth=3)
    want = plain_tree(num, cat, y, 3)
    got = {r["id"]: r["prediction"] for r in tree.predict(df).collect()}
    assert [got[i] for i in range(n)] == [want(num[i], cat[i]) for i in range(n)]
    odd = spark.createDataFrame([(0, None, None, "unseen", 0)], df.schema)
    assert tree.predict(odd).first()["prediction"] is not None


def test_tree_stops_when_pure_or_small(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(6)], "id bigint, a double, label int")
    pure = trees.grow_tree(df.withColumn("label", F.lit(1)), id_col="id", numeric=["a"], categorical=[], label_col="label")
    assert len(pure.nodes) == 1
    small = trees.grow_tree(df, id_col="id", numeric=["a"], categorical=[], label_col="label", min_samples_split=7)
    assert len(small.nodes) == 1


def test_hard_vote_ties_take_the_smallest_class(spark):
    votes = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (2, 0, 1), (2, 1, 1)], "id bigint, tree int, prediction int")
    got = {r["id"]: (r["prediction"], r["probability"]) for r in trees.hard_vote(votes, [0, 1, 2]).collect()}
    assert got == {1: (0, [0.5, 0.0, 0.5]), 2: (1, [0.0, 1.0, 0.0])}


def vectors(spark, x, **extra):
    names = "".join(f", {k} int" for k in extra)
    return spark.createDataFrame([(i, [float(v) for v in r], *[int(e[i]) for e in extra.values()]) for i, r in enumerate(x)],
                                 "id bigint, x array<double>" + names).repartition(4)


def test_envelope_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3)) @ rng.normal(size=(3, 3)) + [1e4, -3, 0]
    env = outliers.fit_envelope(vectors(spark, x), x_col="x", contamination=0.1)
    cov = np.cov(x.T) + 1e-6 * np.eye(3)
    assert np.allclose(env.location, x.mean(0)) and np.allclose(env.covariance, cov)
    d = np.sqrt(np.einsum("ij,jk,ik->i", x - x.mean(0), np.linalg.inv(cov), x - x.mean(0)))
    assert env.threshold == pytest.approx(np.quantile(d, 0.9))
    scored = env.score(vectors(spark, x), id_col="id", x_col="x").collect()
    assert sum(r["prediction"] == -1 for r in scored) == 50
    with pytest.raises(ValueError):
        outliers.fit_envelope(vectors(spark, x), x_col="x", contamination=0.5)


def test_isolation_forest_finds_far_rows(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(400, 3)), rng.normal(size=(5, 3)) + 12])
    df = vectors(spark, x)
    got = outliers.isolation_forest(df, id_col="id", x_col="x", contamination=0.0125, n_trees=40, max_samples=64).collect()
    assert {r["id"] for r in got if r["is_outlier"]} >= {400, 401, 402, 403, 404}
    assert all(0 < r["anomaly"] < 1 for r in got)
    again = outliers.isolation_forest(df.repartition(9), id_col="id", x_col="x", contamination=0.0125, n_trees=40, max_samples=64).collect()
    assert sorted((r["id"], r["anomaly"]) for r in got) == sorted((r["id"], r["anomaly"]) for r in again)
    same = outliers.isolation_forest(vectors(spark, np.ones((50, 2))), id_col="id", x_col="x", n_trees=5).collect()
    assert not any(r["is_outlier"] for r in same)


def test_average_path():
    assert outliers.average_path(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert outliers.average_path(np.array([256]))[0] == pytest.approx(10.244770920)


def test_lof_leaves_unsampled_rows_unscored(spark):
    df = vectors(spark, np.random.default_rng(5).normal(size=(60, 2)))
    rows = outliers.lof_outliers(df, id_col="id", x_col="x", k=5, sample=df.filter("id < 40")).collect()
    assert len(rows) == 60 and all(r["sampled"] == (r["id"] < 40) for r in rows)


def scores(spark, rows):
    return spark.createDataFrame(rows, "truth int, score double")


def test_auc_ties_and_missing_class(spark):
    value = lambda rows: metrics.auc(scores(spark, rows), truth_col="truth", score_col="score").first()["auc"]
    assert value([(1, 0.5), (0, 0.5), (0, 0.5)]) == 0.5
    assert value([(1, 0.9), (0, 0.1)]) == 1.0
    assert value([(1, 0.9)]) is None
    rng = np.random.default_rng(6)
    rows = [(int(t), float(round(v + 0.3 * t, 1))) for t, v in zip(rng.integers(0, 2, 300), rng.random(300))]
    assert value(rows) == pytest.approx(value([(t, float(np.exp(5 * s))) for t, s in rows]))


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (0, 0)], "label int, prediction int")
    s = metrics.summary(df, label_col="label", prediction_col="prediction").first()
    assert (s["accuracy"], s["recall"], s["precision"]) == (0.5, 0.5, 0.25)
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion(df, [0, 1, 2], label_col="label", prediction_col="prediction").collect()}
    assert len(cells) == 9 and cells[(1, 0)] == 1 and cells[(2, 2)] == 0


def informative(spark, n=300):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, 8))
    x[:, 2] += 3 * y
    x[:, 5] -= 3 * y
    return classify.with_vector(vectors(spark, x, label=y), "x")


def test_selection_keeps_informative_features(spark):
    df = informative(spark)
    names = [f"f{i}" for i in range(8)]
    weak = feature_select.select_l1(df, names, features_col="features", label_col="label", C=0.02)
    assert {2, 5} >= set(weak.selected) and weak.selected
    strong = feature_select.select_l1(df, names, features_col="features", label_col="label", C=10.0)
    assert len(strong.selected) > len(weak.selected)
    kept = feature_select.select_recursive(df, names, features_col="features", label_col="label", n_features=2, step=3)
    assert kept.selected == [2, 5] and max(kept.scores) == 3.0
    rows = feature_select.compare_feature_sets(df.filter("id % 4 > 0"), df.filter("id % 4 = 0"), kept, features_col="features", label_col="label").collect()
    assert all(r["accuracy"] > 0.9 for r in rows)


def test_classifiers_separate_two_blobs(spark):
    df = informative(spark)
    train, test = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    right = lambda out: out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert right(classify.linear_svm(train).transform(test)) > 0.9
    assert right(classify.logistic(train).transform(test)) > 0.9
    for kind in ("rbf", "poly", "sigmoid"):
        lifted, model = classify.kernel_svm(train.drop("features"), id_col="id", x_col="x", label_col="label", kind=kind, landmarks=60)
        assert right(model.transform(lifted.transform(test.drop("features"), "x"))) > 0.8, kind


def test_kernel_map_reproduces_the_kernel(spark):
    x = np.random.default_rng(8).normal(size=(40, 3))
    df = vectors(spark, x)
    lifted = classify.fit_kernel_map(df, id_col="id", x_col="x", kind="rbf", gamma=0.5, landmarks=40)
    z = np.array([r["features"].toArray() for r in lifted.transform(df, "x").orderBy("id").collect()])
    assert np.allclose(z @ z.T, classify.kernel(x, x, "rbf", 0.5, 3, 0.0), atol=1e-6)


def test_search_over_folds(spark):
    df = informative(spark).withColumn("fold", (F.col("id") % 3).cast("int"))
    fit = lambda tr, te, p, fold: classify.logistic(tr, C=p["C"], max_iter=10).transform(te)
    results = tuning.search(df, fit, tuning.random_draws({"C": (0.01, 10.0)}, 2, seed=1), fold_col="fold", label_col="label", n_folds=3)
    rows = results.collect()
    assert len(rows) == 2 and all(0.9 < r["mean_score"] <= 1 for r in rows)
    assert tuning.best_candidate(results) in (0, 1)
    assert tuning.grid_of({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
