"""Cross-validation, grid and random search, search reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import cut, scoped, small_table
from sparkmine.operators.classify import NEAR_ZERO
from sparkmine.operators.metrics import summary
from sparkmine.operators.neighbors import knn_join

METRICS = ("accuracy", "precision", "recall", "f1")


def knn_fold_votes(df: DataFrame, *, id_col: str, x_col: str, label_col: str, fold_col: str, ks: Sequence[int],
                   weights: Sequence[str] = ("uniform", "distance"), p: int = 2) -> DataFrame:
    """Out-of-fold predictions for every (k, weights): ``(id, fold, label, weights, k, prediction)``.

    One neighbour join at the largest k, restricted to other folds, serves the whole
    grid: each neighbour casts its vote in every k that reaches its rank.
    """
    nn = knn_join(df, df, id_col=id_col, x_col=x_col, k=max(ks), p=p, skip_same=fold_col)
    labels = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(fold_col).alias("fold"), F.col(label_col).cast("int").alias("label"))
    voted = nn.join(labels.select(F.col("id").alias("neighbor"), F.col("label").alias("vote")), "neighbor")
    grid = F.explode(F.filter(F.array(*[F.lit(int(k)) for k in ks]), lambda k: k >= F.col("rank")))
    weight = F.explode(F.array(*[F.struct(
        F.lit(w).alias("weights"), (F.lit(1.0) if w == "uniform" else 1.0 / (F.col("distance") + F.lit(NEAR_ZERO))).alias("w")) for w in weights]))
    votes = voted.withColumn("k", grid).withColumn("s", weight).groupBy("id", "k", "s.weights", "vote").agg(F.sum("s.w").alias("w"))
    picked = votes.groupBy("id", "k", "weights").agg(F.min_by("vote", F.struct(-F.col("w"), F.col("vote"))).alias("prediction"))
    return picked.join(labels, "id").select("id", "fold", "label", "weights", "k", "prediction")


def fold_accuracy(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., fold, accuracy)``."""
    hit = F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)
    return predictions.groupBy(*by, "fold").agg(F.avg(hit).alias("accuracy"))


def mean_over_folds(per_fold: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., mean_accuracy, std_accuracy)`` with the population deviation."""
    return per_fold.groupBy(*by).agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"))


def grid_search_knn(df: DataFrame, *, id_col: str, x_col: str, label_col: str, fold_col: str, ks: Sequence[int],
                    weights: Sequence[str] = ("uniform", "distance"), ps: Sequence[int] = (2,)) -> DataFrame:
    """``(p, weights, k, mean_accuracy, std_accuracy)`` for the whole grid, one join per metric p."""
    out = None
    for p in ps:
        votes = knn_fold_votes(df, id_col=id_col, x_col=x_col, label_col=label_col, fold_col=fold_col, ks=ks, weights=weights, p=p)
        part = mean_over_folds(fold_accuracy(votes, ["weights", "k"]), ["weights", "k"]).select(
            F.lit(p).alias("p"), "weights", "k", "mean_accuracy", "std_accuracy")
        out = part if out is None else out.union(part)
    return out


def random_draws(space: Mapping[str, object], n: int, seed: int = 42) -> list[dict]:
    """``n`` parameter maps; a list is drawn from, a ``(low, high)`` tuple is a uniform range."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        out.append({k: float(rng.uniform(*v)) if isinstance(v, tuple) else v[int(rng.integers(len(v)))] for k, v in space.items()})
    return out


def grid_of(space: Mapping[str, Sequence]) -> list[dict]:
    maps: list[dict] = [{}]
    for key, values in space.items():
        maps = [{**m, key: v} for m in maps for v in values]
    return maps


@scoped
def cross_validate(df: DataFrame, fit_predict: Callable[[DataFrame, DataFrame, dict, int], DataFrame], params: Sequence[dict], *,
                   fold_col: str, label_col: str, n_folds: int, scoring: str = "accuracy", parallelism: int = 4) -> DataFrame:
    """Score every parameter map on every fold: ``(candidate, fold, score)``.

    ``fit_predict(train, test, params, fold)`` returns the test rows with a
    ``prediction``. Fits are submitted from a few driver threads; Spark runs them.
    """
    df = cut(df)
    present = sorted(r[0] for r in df.select(fold_col).distinct().limit(n_folds + 1).collect())
    if present != list(range(n_folds)):
        raise ValueError(f"folds {present} do not match n_folds={n_folds}")

    def one(task: tuple[int, int]) -> tuple:
        i, fold = task
        predicted = fit_predict(df.filter(F.col(fold_col) != fold), df.filter(F.col(fold_col) == fold), params[i], fold)
        return i, fold, float(summary(predicted, label_col=label_col, prediction_col="prediction").first()[scoring] or 0.0)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(one, [(i, f) for i in range(len(params)) for f in range(n_folds)]))
    return small_table(df.sparkSession, rows, "candidate int, fold int, score double")


def search(df: DataFrame, fit_predict: Callable, params: Sequence[dict], **kw) -> DataFrame:
    """``(candidate, params, mean_score, std_score)`` per parameter map."""
    scored = cross_validate(df, fit_predict, params, **kw)
    text = small_table(df.sparkSession, [(i, ", ".join(f"{k}={v}" for k, v in sorted(p.items()))) for i, p in enumerate(params)],
                                           "candidate int, params string")
    return scored.groupBy("candidate").agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score")).join(
        F.broadcast(text), "candidate").select("candidate", "params", "mean_score", "std_score")


def best_candidate(results: DataFrame) -> int:
    return results.orderBy(F.desc("mean_score"), "candidate").first()["candidate"]


def search_report(results: DataFrame, *, score: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """Top ``n`` rows with rank; equal scores follow ``order``. Ranks are given to parameter maps, not rows."""
    from pyspark.sql import Window

    w = Window.orderBy(F.desc(score), *order)  # one row per parameter map
    return results.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).withColumn("is_best", F.col("rank") == 1)


def accuracy_curves(results: DataFrame) -> DataFrame:
    """Accuracy against k per (p, weights): ``(p, weights, ks, accuracies)``."""
    # one list entry per tried k
    points = F.array_sort(F.collect_list(F.struct("k", "mean_accuracy")))
    return results.groupBy("p", "weights").agg(points.alias("s")).select("p", "weights", F.col("s.k").alias("ks"), F.col("s.mean_accuracy").alias("accuracies"))


def compare_models(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    """Two metric rows side by side: ``(metric, baseline, tuned, difference, percent)``."""
    melt = lambda d, name: d.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias(name)) for m in METRICS])).alias("s")).select("s.*")
    both = melt(baseline, "baseline").join(melt(tuned, "tuned"), "metric")
    return both.withColumn("difference", F.col("tuned") - F.col("baseline")).withColumn(
        "percent", F.when(F.col("baseline") != 0, 100 * F.col("difference") / F.col("baseline")))


def train_test_gap(train: DataFrame, test: DataFrame) -> DataFrame:
    return compare_models(test, train).select("metric", F.col("tuned").alias("train"), F.col("baseline").alias("test"), F.col("difference").alias("gap"))


def refit_knn(train: DataFrame, test: DataFrame, results: DataFrame, *, id_col: str, x_col: str, label_col: str) -> DataFrame:
    """Hold-out metrics of the best grid row on all training rows."""
    from sparkmine.operators.classify import knn_classify

    best = results.orderBy(F.desc(F.round("mean_accuracy", 12)), "p", F.desc("weights"), "k").first()
    predicted = knn_classify(train, test, id_col=id_col, x_col=x_col, label_col=label_col, k=best["k"], weights=best["weights"], p=best["p"])
    joined = test.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label")).join(predicted, "id")
    return summary(joined, label_col="label", prediction_col="prediction")


def correct_projection(projected: DataFrame, predictions: DataFrame, *, id_col: str) -> DataFrame:
    """Projected coordinates with label, prediction and whether they agree."""
    return projected.withColumnRenamed(id_col, "id").join(
        predictions.select("id", "label", "prediction", (F.col("label") == F.col("prediction")).alias("correct")), "id")
