"""Classification metrics from counts: reports, confusion matrices, ROC curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import small_table
from sparkmine.functions.joins import null_safe_join
from sparkmine.functions.ordered import ROWS_PER_WINDOW, running_sums


def _counts(df: DataFrame, label_col: str, prediction_col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label_col).cast("int").alias("label"), F.col(prediction_col).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def per_class(df: DataFrame, *, label_col: str, prediction_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., label, precision, recall, f1, support)`` for classes seen as label or prediction; 0/0 counts as 0."""
    counts = _counts(df, label_col, prediction_col, by)
    sides = counts.select(*by, F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select(*by, "s.*")
    t = sides.groupBy(*by, "label").agg(F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    rated = t.withColumn("precision", _ratio(F.col("hit"), F.col("predicted"))).withColumn("recall", _ratio(F.col("hit"), F.col("support")))
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.select(*by, "label", "precision", "recall", f1.alias("f1"), "support", "hit")


def summary(df: DataFrame, *, label_col: str, prediction_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n_rows, accuracy, precision, recall, f1)``, the last three weighted by support."""
    p = per_class(df, label_col=label_col, prediction_col=prediction_col, by=by)
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return p.groupBy(*by).agg(F.sum("support").alias("n_rows"), (F.sum("hit") / F.sum("support")).alias("accuracy"),
                 weighted("precision"), weighted("recall"), weighted("f1"))


def report(df: DataFrame, *, label_col: str, prediction_col: str) -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg``: ``(class, precision, recall, f1, support)``."""
    p = per_class(df, label_col=label_col, prediction_col=prediction_col)
    names = ("precision", "recall", "f1")
    rows = p.select(F.col("label").cast("string").alias("class"), *names, "support")
    macro = p.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = p.agg(*[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names], F.sum("support").alias("support"))
    return rows.union(macro.select(F.lit("macro avg"), *names, "support")).union(weighted.select(F.lit("weighted avg"), *names, "support"))


def confusion(df: DataFrame, labels: Sequence[int], *, label_col: str, prediction_col: str) -> DataFrame:
    """Long confusion matrix over the given labels, absent cells as 0."""
    counts = _counts(df, label_col, prediction_col)
    spark = df.sparkSession
    grid = small_table(spark, [(int(a), int(b)) for a in labels for b in labels], "label int, prediction int")
    return grid.join(counts, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def _score_counts(df: DataFrame, by: Sequence[str], truth: Column, score_col: str, rows_per_window: int) -> DataFrame:
    counted = df.groupBy(*by, F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg"))
    return running_sums(counted, by, "score", ["pos", "neg"], descending=True, rows_per_window=rows_per_window)


def roc_points(df: DataFrame, *, truth_col: str, score_col: str, by: Sequence[str] = (), rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """``(by..., threshold, tp, fp, tpr, fpr)`` per distinct score, highest first.

    Scores are counted per value before they are ordered.
    """
    placed = _score_counts(df, list(by), F.col(truth_col) == 1, score_col, rows_per_window)
    totals = placed.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("neg").alias("m"))
    joined = null_safe_join(placed, totals, list(by))
    return joined.select(*by, F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                         _ratio(F.col("cum_pos"), F.col("p")).alias("tpr"), _ratio(F.col("cum_neg"), F.col("m")).alias("fpr"))


def auc(df: DataFrame, *, truth_col: str, score_col: str, by: Sequence[str] = (), rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """``(by..., n_pos, n_neg, auc)``; a tie between the classes counts half. Null when a class is missing."""
    placed = _score_counts(df, list(by), F.col(truth_col) == 1, score_col, rows_per_window)
    area = F.sum(F.col("neg") * ((F.col("cum_pos") - F.col("pos")) + F.col("pos") / 2))
    return placed.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), area.alias("area")).select(
        *by, "n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("area") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def one_vs_rest(df: DataFrame, labels: Sequence[int], *, label_col: str, probability_col: str) -> DataFrame:
    """One row per (row, class): ``(class, truth, score)`` from an ``array<double>`` of class probabilities."""
    return df.select(F.explode(F.array(*[F.struct(
        F.lit(int(c)).alias("class"), F.when(F.col(label_col) == int(c), 1).otherwise(0).alias("truth"),
        F.col(probability_col)[i].alias("score")) for i, c in enumerate(labels)])).alias("s")).select("s.*")


def multiclass_roc(df: DataFrame, labels: Sequence[int], *, label_col: str, probability_col: str) -> DataFrame:
    """Curve points of every class against the rest and of the micro average: ``(curve, threshold, tp, fp, tpr, fpr)``."""
    long = one_vs_rest(df, labels, label_col=label_col, probability_col=probability_col)
    each = roc_points(long, truth_col="truth", score_col="score", by=["class"])
    micro = roc_points(long, truth_col="truth", score_col="score")
    return each.withColumn("curve", F.concat(F.lit("class "), F.col("class").cast("string"))).drop("class").unionByName(
        micro.withColumn("curve", F.lit("micro")))


def multiclass_auc(df: DataFrame, labels: Sequence[int], *, label_col: str, probability_col: str) -> DataFrame:
    """AUC per class, their support-weighted mean and the micro average: ``(average, auc)``."""
    long = one_vs_rest(df, labels, label_col=label_col, probability_col=probability_col)
    each = auc(long, truth_col="truth", score_col="score", by=["class"])
    micro = auc(long, truth_col="truth", score_col="score").select(F.lit("micro").alias("average"), "auc")
    weighted = each.agg((F.sum(F.col("auc") * F.col("n_pos")) / F.sum(F.when(F.col("auc").isNotNull(), F.col("n_pos")))).alias("auc"))
    return each.select(F.concat(F.lit("class "), F.col("class").cast("string")).alias("average"), "auc").union(
        weighted.select(F.lit("weighted"), "auc")).union(micro)
