"""Deterministic samples, splits, folds, bootstraps and feature subsets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import small_table
from sparkmine.functions.joins import null_safe_join, side_table
from sparkmine.functions.keys import WIDE_BITS, hash_key, uniform, wide_key
from sparkmine.functions.ordered import key_cuts

POISSON_TERMS = 12  # more draws have a chance below 1e-10, less than the step of the 32-bit key that is inverted


def sample_exact(df: DataFrame, n: int, *, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all rows if fewer), those with the smallest hash of their id.

    The cut-off key is found by counting, so no task sorts or holds the sample.
    """
    keyed = df.withColumn("_key", wide_key(F.col(id_col), seed))
    limit = key_cuts(keyed, "_key", {0: n}, bits=WIDE_BITS)[0]
    return keyed.filter(F.col("_key") <= limit).drop("_key")


def stratified_split(df: DataFrame, *, id_col: str, label_col: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``; every class gives ``round(test_share * size)`` rows to the test side; a null label is a class."""
    keyed = df.withColumn("_key", wide_key(F.col(id_col), seed))
    sizes = keyed.groupBy(label_col).count().collect()  # one row per class
    wanted = {r[label_col]: math.floor(test_share * r["count"] + 0.5) for r in sizes}
    cuts = key_cuts(keyed, "_key", wanted, by=label_col, bits=WIDE_BITS)
    label_type = df.schema[label_col].dataType.simpleString()
    limits = side_table(df.sparkSession, list(cuts.items()), f"{label_col} {label_type}, _cut bigint")
    return null_safe_join(keyed, limits, [label_col]).withColumn("is_test", F.col("_key") <= F.col("_cut")).select(
        *df.columns, "is_test"
    )


def fold_of(id_col: str, k: int, seed: int = 42) -> Column:
    """Fold number ``0..k-1`` of a row, from a hash of its id."""
    return F.pmod(hash_key(F.col(id_col), seed), F.lit(k)).cast("int")


def kfold(df: DataFrame, k: int, *, id_col: str, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", fold_of(id_col, k, seed))


def poisson_weight(u: Column) -> Column:
    """Poisson(1) draw by inverting its distribution at ``u``."""
    weight, mass, below = F.lit(0), math.exp(-1.0), 0.0
    for i in range(1, POISSON_TERMS + 1):
        below += mass
        weight = weight + F.when(u > below, 1).otherwise(0)
        mass /= i
    return weight


def bootstrap(df: DataFrame, n_trees: int, *, id_col: str, seed: int = 42) -> DataFrame:
    """Rows drawn for each tree with their multiplicity: adds ``tree`` and ``weight >= 1``.

    Draw counts of a bootstrap are Poisson(1) in the limit, so each row decides on
    its own and nothing is shuffled.
    """
    seeds = F.concat(F.lit(f"{seed}-"), F.col("tree").cast("string"))
    return (
        df.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
        .withColumn("weight", poisson_weight(uniform(F.col(id_col), seeds))).filter("weight > 0")
    )


def feature_subsets(df: DataFrame, features: Sequence[str], n_trees: int, size: int, *, seed: int = 42) -> DataFrame:
    """``size`` features per tree without replacement: ``(tree, feature)``."""
    spark = df.sparkSession
    grid = small_table(spark, [(t, f) for t in range(n_trees) for f in features], "tree int, feature string")
    key = hash_key(F.concat_ws("-", F.col("feature"), F.col("tree").cast("string")), seed)
    ranked = F.slice(F.array_sort(F.collect_list(F.struct(key.alias("key"), "feature"))), 1, size)
    # one list entry per feature name
    return grid.groupBy("tree").agg(ranked.alias("s")).select("tree", F.explode("s.feature").alias("feature"))


def bagged_means(df: DataFrame, features: Sequence[str], *, id_col: str, n_trees: int, size: int, seed: int = 42) -> DataFrame:
    """Bootstrap mean of each tree's own features: ``(tree, feature, n_drawn, mean)``."""
    chosen = feature_subsets(df, features, n_trees, size, seed=seed)
    drawn = bootstrap(df.select(id_col, *features), n_trees, id_col=id_col, seed=seed)
    sums = drawn.groupBy("tree").agg(F.sum("weight").alias("n_drawn"), *[
        F.sum(F.col(f).cast("double") * F.col("weight")).alias(f"_{i}") for i, f in enumerate(features)])
    long = sums.select("tree", "n_drawn", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.col(f"_{i}") / F.col("n_drawn")).alias("mean")) for i, f in enumerate(features)
    ])).alias("m")).select("tree", "m.feature", "n_drawn", "m.mean")
    return long.join(chosen, ["tree", "feature"], "left_semi")
