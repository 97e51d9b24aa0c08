"""Feature selection: L1 logistic, recursive elimination, mutual information, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import small_table
from sparkmine.functions.ordered import exact_quantiles

WEIGHT_FLOOR = 1e-5


@dataclass
class Selection:
    """Scores per feature and the chosen positions."""

    features: list[str]
    scores: list[float]
    selected: list[int]

    def table(self, df: DataFrame) -> DataFrame:
        chosen = set(self.selected)
        rows = [(f, float(s), i in chosen) for i, (f, s) in enumerate(zip(self.features, self.scores))]
        return small_table(df.sparkSession, rows, "feature string, score double, selected boolean")

    def apply(self, df: DataFrame, *, features_col: str, into: str = "selected_features") -> DataFrame:
        return VectorSlicer(inputCol=features_col, outputCol=into, indices=self.selected).transform(df)


def _logistic(n: int, C: float, l1: float, *, features_col: str, label_col: str, max_iter: int) -> LogisticRegression:
    # C weighs the summed loss, Spark's penalty weighs against the mean loss
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, regParam=1.0 / (C * n), elasticNetParam=l1,
                              standardization=False, maxIter=max_iter)


def select_l1(df: DataFrame, names: Sequence[str], *, features_col: str, label_col: str, C: float = 0.1, max_iter: int = 100) -> Selection:
    """Keep features whose L1 weight is at least 1e-5; several classes use the mean absolute weight."""
    model = _logistic(df.count(), C, 1.0, features_col=features_col, label_col=label_col, max_iter=max_iter).fit(df)
    weights = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    return Selection(list(names), weights.tolist(), np.nonzero(weights >= WEIGHT_FLOOR)[0].tolist())


def select_recursive(df: DataFrame, names: Sequence[str], *, features_col: str, label_col: str, n_features: int, step: int = 10,
                     max_iter: int = 50) -> Selection:
    """Drop the ``step`` weakest features per round; the score is the elimination rank (1 = kept)."""
    if n_features <= 0:
        raise ValueError("n_features must be positive")
    n_features = min(n_features, len(names))
    left, n = list(range(len(names))), df.count()
    rounds: list[list[int]] = []
    base = df.select(label_col, features_col).persist()
    try:
        while len(left) > n_features:
            sliced = VectorSlicer(inputCol=features_col, outputCol="_left", indices=left).transform(base)
            model = _logistic(n, 1.0, 0.0, features_col="_left", label_col=label_col, max_iter=max_iter).fit(sliced)
            power = (model.coefficientMatrix.toArray() ** 2).sum(axis=0)
            drop = min(step, len(left) - n_features)
            weakest = np.lexsort((np.arange(len(left)), power))[:drop]
            rounds.append([left[i] for i in weakest])
            left = [f for i, f in enumerate(left) if i not in set(weakest.tolist())]
    finally:
        base.unpersist()
    rank = [1.0] * len(names)
    for i, dropped in enumerate(rounds):
        for f in dropped:
            rank[f] = float(len(rounds) - i + 1)
    return Selection(list(names), rank, left)


def quantile_bin(column: str, edges: Sequence[float]) -> Column:
    """Number of inner edges below the value: the bin of a numeric column."""
    out = F.lit(0)
    for e in sorted(set(edges)):
        out = out + F.when(F.col(column) > float(e), 1).otherwise(0)
    return F.when(F.col(column).isNotNull(), out)


def mutual_information(df: DataFrame, *, discrete: Sequence[str], numeric: Sequence[str], label_col: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information with the label in nats: ``(feature, score)``.

    Numeric columns are cut at their inner quantiles. All features share one
    aggregate over (feature, value, label).
    """
    qs = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(df, list(numeric), qs) if numeric else {}
    value = {c: F.col(c).cast("string") for c in discrete}
    value.update({c: quantile_bin(c, [e for e in edges[(None, c)] if e is not None]).cast("string") for c in numeric})
    long = df.select(F.col(label_col).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), v.alias("value")) for c, v in value.items()])).alias("m")
    ).select("label", "m.*").filter("value IS NOT NULL")
    joint = long.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    # sum n log n over each margin: I = (S_xy - S_x - S_y + N log N) / N; the joint counts go through one set of groupings
    side = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    value, label = F.col("value"), F.col("label").cast("string")
    margins = joint.select("feature", "n", F.explode(F.array(
        side("xy", F.struct(value.alias("value"), label.alias("label"))), side("x", F.struct(value.alias("value"), F.lit(None).cast("string").alias("label"))),
        side("y", F.struct(F.lit(None).cast("string").alias("value"), label.alias("label"))))).alias("m")).groupBy("feature", "m.kind", "m.key").agg(F.sum("n").alias("n"))
    log_sum = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n") * F.log(F.col("n").cast("double")))).alias(f"s{kind}")
    j = margins.groupBy("feature").agg(log_sum("xy"), log_sum("x"), log_sum("y"), F.sum(F.when(F.col("kind") == "x", F.col("n"))).alias("n"))
    score = (F.col("sxy") - F.col("sx") - F.col("sy")) / F.col("n") + F.log(F.col("n").cast("double"))
    return j.select("feature", F.greatest(score, F.lit(0.0)).alias("score"))


def select_top(scored: DataFrame, n: int) -> DataFrame:
    """Ranked report ``(feature, score, selected)`` with the first ``n`` selected."""
    top = scored.orderBy(F.desc("score"), "feature").limit(n).select("feature", F.lit(True).alias("selected"))
    return scored.join(top, "feature", "left").select("feature", "score", F.coalesce("selected", F.lit(False)).alias("selected"))


def ranked_report(scored: DataFrame, n: int = 20, *, ascending: bool = False) -> DataFrame:
    order = F.asc("score") if ascending else F.desc("score")
    return scored.orderBy(order, "feature").limit(n)


def compare_feature_sets(train: DataFrame, test: DataFrame, selection: Selection, *, features_col: str, label_col: str, max_iter: int = 50) -> DataFrame:
    """Test accuracy of an L2 logistic model on all and on the selected features."""
    n = train.count()
    evaluate = MulticlassClassificationEvaluator(labelCol=label_col, metricName="accuracy")

    def fitted(tr: DataFrame, te: DataFrame, col: str) -> float:
        model = _logistic(n, 1.0, 0.0, features_col=col, label_col=label_col, max_iter=max_iter).fit(tr)
        return float(evaluate.evaluate(model.transform(te)))

    rows = [("all", len(selection.features), fitted(train, test, features_col))]
    if selection.selected:
        sliced = [selection.apply(d, features_col=features_col) for d in (train, test)]
        rows.append(("selected", len(selection.selected), fitted(*sliced, "selected_features")))
    else:  # nothing kept: the model is its intercept, which is the most frequent class
        top = train.groupBy(label_col).count().agg(F.min_by(label_col, F.struct(-F.col("count"), label_col))).first()[0]
        rows.append(("selected", 0, float(test.agg(F.avg((F.col(label_col) == top).cast("double"))).first()[0] or 0.0)))
    return small_table(train.sparkSession, rows, "features string, n_features int, accuracy double")
