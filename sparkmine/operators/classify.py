"""Classifiers: nearest-neighbour votes, linear and kernel support vectors, logistic baseline."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.keys import hash_key
from sparkmine.functions.vectors import list_array, matrix
from sparkmine.operators.neighbors import knn_join

NEAR_ZERO = 1e-8


def knn_vote(neighbors: DataFrame, labels: DataFrame, *, id_col: str, label_col: str, weights: str = "uniform", k: int | None = None) -> DataFrame:
    """``(id, prediction)`` from a neighbour table; equal votes go to the smallest label.

    ``k`` uses only the first ``k`` ranks, so one join at the largest k serves all.
    """
    used = neighbors if k is None else neighbors.filter(F.col("rank") <= k)
    known = labels.select(F.col(id_col).alias("neighbor"), F.col(label_col).cast("int").alias("label"))
    w = F.lit(1.0) if weights == "uniform" else 1.0 / (F.col("distance") + F.lit(NEAR_ZERO))
    votes = used.join(known, "neighbor").groupBy("id", "label").agg(F.sum(w).alias("w"))
    return votes.groupBy("id").agg(F.min_by("label", F.struct(-F.col("w"), F.col("label"))).alias("prediction"))


def knn_classify(train: DataFrame, test: DataFrame, *, id_col: str, x_col: str, label_col: str, k: int = 5, weights: str = "uniform", p: int = 2) -> DataFrame:
    nn = knn_join(test, train, id_col=id_col, x_col=x_col, k=k, p=p)
    return knn_vote(nn, train, id_col=id_col, label_col=label_col, weights=weights)


def with_vector(df: DataFrame, x_col: str, into: str = "features") -> DataFrame:
    return df.withColumn(into, array_to_vector(F.col(x_col).cast("array<double>")))


def linear_svm(train: DataFrame, *, features_col: str = "features", label_col: str = "label", C: float = 1.0, max_iter: int = 50, parallelism: int = 4):
    """Linear support vectors, one against the rest."""
    svc = LinearSVC(regParam=1.0 / (C * max(1, train.count())), maxIter=max_iter, standardization=False)
    return OneVsRest(classifier=svc, featuresCol=features_col, labelCol=label_col, parallelism=parallelism).fit(train)


def logistic(train: DataFrame, *, features_col: str = "features", label_col: str = "label", C: float = 1.0, max_iter: int = 100):
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, regParam=1.0 / (C * max(1, train.count())),
                              standardization=False, maxIter=max_iter).fit(train)


def kernel_gamma(df: DataFrame, x_col: str, gamma: str | float) -> float:
    """``scale`` = 1 / (d * var of all entries), ``auto`` = 1 / d, or the number itself."""
    if not isinstance(gamma, str):
        return float(gamma)
    width = df.select(F.size(x_col)).first()[0]
    if gamma == "auto":
        return 1.0 / width
    var = df.select(F.explode(F.col(x_col).cast("array<double>")).alias("v")).agg(F.var_pop("v")).first()[0]
    return 1.0 / (width * var) if var else 1.0 / width


def kernel(a: np.ndarray, b: np.ndarray, kind: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    inner = a @ b.T
    if kind == "rbf":
        sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * inner
        return np.exp(-gamma * np.maximum(sq, 0.0))
    if kind == "poly":
        return (gamma * inner + coef0) ** degree
    if kind == "sigmoid":
        return np.tanh(gamma * inner + coef0)
    return inner


@dataclass
class KernelMap:
    """Nyström feature map: kernel values against landmarks, whitened."""

    landmarks: np.ndarray
    whitening: np.ndarray
    kind: str
    gamma: float
    degree: int
    coef0: float

    def transform(self, df: DataFrame, x_col: str, *, into: str = "features") -> DataFrame:
        landmarks, whitening = self.landmarks, self.whitening
        kind, gamma, degree, coef0 = self.kind, self.gamma, self.degree, self.coef0

        @F.arrow_udf("array<double>")
        def lift(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            return list_array(kernel(matrix(x), landmarks, kind, gamma, degree, coef0) @ whitening)

        return df.withColumn(into, array_to_vector(lift(F.col(x_col).cast("array<double>"))))


def fit_kernel_map(df: DataFrame, *, id_col: str, x_col: str, kind: str = "rbf", gamma: str | float = "scale", degree: int = 3,
                   coef0: float = 0.0, landmarks: int = 128, seed: int = 42) -> KernelMap:
    """Landmarks are hash-chosen rows (their number is the model's size)."""
    g = kernel_gamma(df, x_col, gamma)
    picked = df.select(id_col, F.col(x_col).cast("array<double>").alias("x")).orderBy(hash_key(F.col(id_col), f"landmark-{seed}"), id_col).limit(landmarks).collect()
    points = np.array([r["x"] for r in picked])
    values, vectors = np.linalg.eigh(kernel(points, points, kind, g, degree, coef0))
    keep = values > 1e-10 * max(1e-300, values.max())  # indefinite kernels lose their negative part
    return KernelMap(points, vectors[:, keep] / np.sqrt(values[keep]), kind, g, degree, coef0)


def kernel_svm(train: DataFrame, *, id_col: str, x_col: str, label_col: str, kind: str = "rbf", C: float = 1.0, gamma: str | float = "scale",
               degree: int = 3, landmarks: int = 128, max_iter: int = 50, seed: int = 42):
    """Returns ``(map, model)``; predict with ``model.transform(map.transform(df, x_col))``."""
    lifted = fit_kernel_map(train, id_col=id_col, x_col=x_col, kind=kind, gamma=gamma, degree=degree, landmarks=landmarks, seed=seed)
    features = lifted.transform(train, x_col).persist()
    try:
        return lifted, linear_svm(features, label_col=label_col, C=C, max_iter=max_iter)
    finally:
        features.unpersist()
