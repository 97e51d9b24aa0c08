"""Chart data: distributions, histograms, correlations, box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import small_table
from sparkmine.functions.joins import null_safe_join, side_table
from sparkmine.functions.ordered import ACCURACY, ROWS_PER_WINDOW, SMALL_GROUP, exact_quantiles
from sparkmine.operators.moments import pair_statistics

NARROW = 32  # columns whose pairs are counted by one expression each


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """``(label, n, share)`` sorted by label."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("label", "n", (F.col("n") / F.col("total")).alias("share")).orderBy("label")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins per column: ``(column, bin, lo, hi, n)``; the last bin is closed, empty bins are listed."""
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}"))]).first()
    ranges = []
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None:
            ranges.append((c, lo, hi) if hi > lo else (c, lo - 0.5, hi + 0.5))
    spark = df.sparkSession
    limits = small_table(spark, ranges, "column string, c_lo double, c_hi double")
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("m")
    ).select("m.*").filter("x IS NOT NULL")
    width = (F.col("c_hi") - F.col("c_lo")) / bins
    # one limits row per column
    counted = melted.join(F.broadcast(limits), "column").groupBy(
        "column", F.least(F.floor((F.col("x") - F.col("c_lo")) / width), F.lit(bins - 1)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["column", "bin"], "left").select(
        "column", "bin", (F.col("c_lo") + F.col("bin") * width).alias("lo"),
        (F.col("c_lo") + (F.col("bin") + 1) * width).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlation(df: DataFrame, columns: Sequence[str], *, narrow: int = NARROW) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form ``(a, b, r)`` with ``a <= b`` in column order.

    More than ``narrow`` columns travel as one vector and are counted in tiles, without an expression for each pair.
    """
    if len(columns) > narrow:
        found = pair_statistics(df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x")), "x")
        names = small_table(df.sparkSession, list(enumerate(columns)), "k int, name string")
        side = lambda k: F.broadcast(names.select(F.col("k").alias(k), F.col("name").alias(f"_{k}")))
        return found.join(side("a"), "a").join(side("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"), "r")
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    x = [F.col(c).cast("double") for c in columns]
    row = df.agg(*[F.corr(x[i], x[j]).alias(f"r{i}_{j}") for i, j in pairs])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"r{i}_{j}").alias("r")) for i, j in pairs
    ])).alias("p")).select("p.*")


def boxplot(df: DataFrame, columns: Sequence[str], label_col: str, *, small: int = SMALL_GROUP, accuracy: int = ACCURACY,
            rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """Per class and column: quartiles, whiskers at the last value within 1.5 IQR, outlier count; a null class is a class."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=label_col, small=small, accuracy=accuracy, rows_per_window=rows_per_window)
    label_type = df.schema[label_col].dataType.simpleString()
    rows = [(g, c, *v) for (g, c), v in quartiles.items() if v[0] is not None]
    boxes = side_table(df.sparkSession, rows, f"label {label_type}, column string, q1 double, median double, q3 double")
    melted = df.select(F.col(label_col).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("m")
    ).select("label", "m.*").filter("x IS NOT NULL")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("x").between(F.col("q1") - reach, F.col("q3") + reach)
    return null_safe_join(melted, boxes, ["label", "column"]).groupBy("label", "column", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"), F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"),
    )


def projection_by_class(projected: DataFrame, labels: DataFrame, *, id_col: str, label_col: str) -> DataFrame:
    """Projected coordinates with their class, the data of a coloured scatter plot."""
    return projected.join(labels.select(id_col, F.col(label_col).alias("label")), id_col)
