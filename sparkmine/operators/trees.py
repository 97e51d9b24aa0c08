"""Impurity, exact split search, level-wise trees, forests and votes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.joins import BROADCAST_ROWS, null_safe_join
from sparkmine.functions.ordered import running_sums
from sparkmine.lineage import cut, small_table
from sparkmine.operators.sampling import bootstrap, feature_subsets

EPS = 1e-12


def impurity_of(counts: Sequence[Column], total: Column, criterion: str) -> Column:
    """Gini or entropy (base 2) of class counts given as columns."""
    shares = [F.coalesce(c, F.lit(0)) / total for c in counts]
    if criterion == "gini":
        out = F.lit(1.0)
        for s in shares:
            out = out - s * s
        return out
    out = F.lit(0.0)
    for s in shares:
        out = out - s * F.log2(s + F.lit(EPS))
    return out


def impurity(df: DataFrame, *, label_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, gini, entropy)``; a null group is a group, a null label a class."""
    counts = df.groupBy(*by, F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("c"))
    totals = counts.groupBy(*by).agg(F.sum("c").alias("n"))
    share = F.col("c") / F.col("n")
    joined = null_safe_join(counts, totals, list(by))
    return joined.groupBy(*by, "n").agg(
        (1.0 - F.sum(share * share)).alias("gini"), (-F.sum(share * F.log2(share + F.lit(EPS)))).alias("entropy"))


def majority_class(df: DataFrame, *, label_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent class; ties go to the first in string order. ``(by..., majority, n)``."""
    counts = df.groupBy(*by, F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(*by).agg(
        F.min_by("_label", F.struct(-F.col("c"), F.col("_label").cast("string"))).alias("majority"), F.sum("c").alias("n"))


def _melt(df: DataFrame, features: Sequence[str], keep: Sequence[str], kind: str) -> DataFrame:
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features])).alias("m")
    ).select(*keep, "m.feature", "m.value")


def _class_counts(classes: Sequence, weight_col: str | None) -> list[Column]:
    """Weighted rows of each class, as ``c0, c1, ...``."""
    w = F.col(weight_col) if weight_col else F.lit(1)
    return [F.sum(F.when(F.col("_label") == c, w).otherwise(0)).alias(f"c{i}") for i, c in enumerate(classes)]


def _offered(long: DataFrame, subset: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """The melted rows of the features that a tree was given."""
    return long if subset is None else long.join(F.broadcast(subset), [*by[:1], "feature"], "left_semi")


def numeric_splits(df: DataFrame, features: Sequence[str], *, id_col: str, label_col: str, classes: Sequence,
                   by: Sequence[str] = (), criterion: str = "gini", weight_col: str | None = None, subset: DataFrame | None = None) -> DataFrame:
    """Best threshold per (group, feature): ``(by..., feature, threshold, impurity)``.

    Rows become class counts per distinct value first; running sums over values give the left side of every threshold.
    A threshold is tried between two values when the last row of one and the first row of the next, by id, differ in
    class. Rows without a value or without a label take no part. ``subset`` ``(by[0], feature)`` restricts the features of a group.
    """
    by = list(by)
    keep = [*by, "_id", "_label", *([weight_col] if weight_col else [])]
    long = _melt(df.withColumn("_id", F.col(id_col)).withColumn("_label", F.col(label_col)), features, keep, "double")
    names = [f"c{i}" for i in range(len(classes))]
    values = _offered(long.filter("value IS NOT NULL AND _label IS NOT NULL"), subset, by).groupBy(*by, "feature", "value").agg(
        F.min_by("_label", "_id").alias("first"), F.max_by("_label", "_id").alias("last"), *_class_counts(classes, weight_col))
    key = [*by, "feature"]
    values = values.withColumn("_row", F.lit(1))
    placed = cut(running_sums(values, key, "value", [*names, "_row"]))
    totals = placed.groupBy(*key).agg(*[F.sum(n).alias(f"all_{n}") for n in names])
    # the next value of a group is the row whose position is one higher
    following = placed.select(*key, (F.col("cum__row") - 1).alias("cum__row"), F.col("value").alias("next_value"), F.col("first").alias("next_first"))
    pairs = placed.join(following, [*key, "cum__row"]).filter(F.col("last") != F.col("next_first")).join(few_broadcast(totals), key)
    left = [F.col(f"cum_{n}") for n in names]
    right = [F.col(f"all_{n}") - F.col(f"cum_{n}") for n in names]
    n_left, n_right = sum(left, F.lit(0)), sum(right, F.lit(0))
    after = (n_left * impurity_of(left, n_left, criterion) + n_right * impurity_of(right, n_right, criterion)) / (n_left + n_right)
    # impurities that differ by rounding only count as equal, the lower threshold wins
    scored = pairs.select(*key, ((F.col("value") + F.col("next_value")) / 2).alias("threshold"), after.alias("impurity"))
    return scored.groupBy(*key).agg(F.min_by(F.struct("threshold", "impurity"), F.struct(F.round("impurity", 12), "threshold")).alias("s")).select(
        *key, "s.threshold", "s.impurity")


def categorical_splits(df: DataFrame, features: Sequence[str], *, label_col: str, classes: Sequence, by: Sequence[str] = (),
                       criterion: str = "gini", weight_col: str | None = None, subset: DataFrame | None = None) -> DataFrame:
    """Multi-way split per (group, feature): ``(by..., feature, n_values, impurity)``; a null is its own value.

    Rows without a label take no part.
    """
    by = list(by)
    keep = [*by, "_label", *([weight_col] if weight_col else [])]
    long = _melt(df.withColumn("_label", F.col(label_col)), features, keep, "string").filter("_label IS NOT NULL")
    counts = _offered(long, subset, by).groupBy(*by, "feature", "value").agg(*_class_counts(classes, weight_col))
    own = [F.col(f"c{i}") for i in range(len(classes))]
    each = counts.withColumn("n", sum(own, F.lit(0))).withColumn("imp", impurity_of(own, F.col("n"), criterion))
    return each.groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("n_values"), (F.sum(F.col("n") * F.col("imp")) / F.sum("n")).alias("impurity")
    ).filter("n_values > 1")


def few_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side of one row per node or feature if its counted rows are few; a shuffled side beyond."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


NODES = "tree int, node int, depth int, size bigint, majority {label}, feature string, threshold double, n_children int"
EDGES = "tree int, node int, key string, child int"


@dataclass
class Forest:
    """Trees as two tables: nodes with their split, and children by key (``l``, ``ge``, ``=value`` or ``?`` for a missing one).

    A row is at a node of each tree; one join a level with the children of that level moves the rows of all trees on.
    """

    nodes_table: DataFrame
    edges: DataFrame
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    levels: int

    @property
    def nodes(self) -> list:
        """The model's rows."""
        return self.nodes_table.collect()

    def route(self, df: DataFrame, n_trees: int = 1) -> DataFrame:
        """``df`` with ``tree`` and the ``majority`` of the node reached; an unseen category or a missing number stops where it is."""
        split = self.nodes_table.select("tree", F.col("node").alias("child"), F.col("feature").alias("_next"), F.col("threshold").alias("_at"), "majority")
        steps = few_broadcast(cut(self.edges.join(split, ["tree", "child"])))
        root = self.nodes_table.filter("node = 0").select("tree", F.col("node").alias("_node"), F.col("feature").alias("_feature"), F.col("threshold").alias("_threshold"), "majority")
        rows = df.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).join(F.broadcast(root), "tree")
        for _ in range(self.levels):
            rows = rows.withColumn("_key", split_key(self.numeric, self.categorical))
            step = steps.select("tree", F.col("node").alias("_node"), F.col("key").alias("_key"), "child", "_next", "_at", F.col("majority").alias("_majority"))
            found = F.col("child").isNotNull()
            # a row that stops keeps its class and has no key any more
            rows = rows.join(step, ["tree", "_node", "_key"], "left").select(
                *df.columns, "tree", F.coalesce("child", "_node").alias("_node"), F.when(found, F.col("_next")).alias("_feature"),
                F.when(found, F.col("_at")).alias("_threshold"), F.when(found, F.col("_majority")).otherwise(F.col("majority")).alias("majority"))
        return rows.select(*df.columns, "tree", "majority")

    def predict(self, df: DataFrame, *, into: str = "prediction") -> DataFrame:
        """Class of the node that the first tree reaches."""
        return self.route(df).select(*df.columns, F.col("majority").alias(into))


def split_key(numeric: Sequence[str], categorical: Sequence[str]) -> Column:
    """Which child a row asks for, given the ``_feature`` and ``_threshold`` of its node: null without a split or for a missing number."""
    value = lambda names, kind: F.element_at(F.create_map(*[x for f in names for x in (F.lit(f), F.col(f).cast(kind))]), F.col("_feature")) if names else F.lit(None).cast(kind)
    x, v = value(numeric, "double"), value(categorical, "string")
    by_number = F.when(x < F.col("_threshold"), "l").when(x >= F.col("_threshold"), "ge")
    by_value = F.when(F.col("_feature").isNotNull(), F.coalesce(F.concat(F.lit("="), v), F.lit("?")))
    return F.when(F.col("_threshold").isNotNull(), by_number).otherwise(by_value)


def _grow(rows: DataFrame, subset: DataFrame | None, *, numeric: Sequence[str], categorical: Sequence[str], classes: Sequence, label_type: str,
          max_depth: int, min_samples_split: int, criterion: str) -> Forest:
    """Trees over ``rows (tree, _id, _label, _w, features...)``, all of them a level at a time.

    The node of a row is part of the row; class counts are keyed by tree, node, feature and value for all trees
    together, and one join with the new children moves the rows on, so jobs do not depend on the number of trees or nodes.
    """
    spark, features = rows.sparkSession, [*numeric, *categorical]
    if not classes:  # no row has a label
        return Forest(small_table(spark, [], NODES.format(label=label_type)), small_table(spark, [], EDGES), tuple(numeric), tuple(categorical), 0)
    position = F.element_at(F.create_map(*[x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i))]), F.col("feature")) if features else F.lit(0)
    state = rows.withColumn("node", F.lit(0))
    key = ["tree", "node"]
    nodes, edges, levels = [], small_table(spark, [], EDGES), 0
    for depth in range(max_depth + 1):
        stats = state.groupBy(*key).agg(*_class_counts(classes, "_w"))
        own = [F.col(f"c{i}") for i in range(len(classes))]
        top = F.greatest(*own) if len(own) > 1 else own[0]
        majority = F.lit(None).cast(label_type)
        for c, n in sorted(zip(classes, own), key=lambda p: str(p[0]), reverse=True):  # the first by string order wins
            majority = F.when(n == top, F.lit(c).cast(label_type)).otherwise(majority)
        size = sum(own, F.lit(0)).cast("bigint")
        told = cut(stats.select(*key, F.lit(depth).alias("depth"), size.alias("size"), majority.alias("majority"), ((size > top) & (size >= min_samples_split)).alias("open")))
        asked = told.filter("open").select(*key)
        if depth == max_depth or not features or asked.isEmpty():
            nodes.append(told.select(*key, "depth", "size", "majority", F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("threshold"), F.lit(0).alias("n_children")))
            break
        searched = cut(state.join(few_broadcast(asked), key, "left_semi"))
        found = []
        if numeric:
            found.append(numeric_splits(searched, numeric, id_col="_id", label_col="_label", classes=classes, by=key, criterion=criterion, weight_col="_w", subset=subset).select(
                *key, "feature", "threshold", "impurity"))
        if categorical:
            found.append(categorical_splits(searched, categorical, label_col="_label", classes=classes, by=key, criterion=criterion, weight_col="_w", subset=subset).select(
                *key, "feature", F.lit(None).cast("double").alias("threshold"), "impurity"))
        every = found[0] if len(found) == 1 else found[0].union(found[1])
        # highest gain first, then column order
        best = cut(every.groupBy(*key).agg(F.min_by(F.struct("feature", "threshold"), F.struct(F.round("impurity", 12), position)).alias("s")).select(*key, "s.*"))
        split = few_broadcast(best.select(*key, F.col("feature").alias("_feature"), F.col("threshold").alias("_threshold")))
        keyed = searched.join(split, key).withColumn("_key", split_key(numeric, categorical)).filter("_key IS NOT NULL")
        # children are numbered node by node: left before right, values in order with a missing one first
        order = F.struct("node", F.when(F.col("_key") == "l", 0).when(F.col("_key") == "ge", 1).when(F.col("_key") == "?", 0).otherwise(1), "_key")
        before = told.groupBy("tree").agg(F.max("node").alias("last"))
        number = F.row_number().over(Window.partitionBy("tree").orderBy(order))  # one row per child
        made = cut(keyed.select(*key, "_key").distinct().join(F.broadcast(before), "tree").select(
            *key, F.col("_key").alias("key"), (F.col("last") + number).cast("int").alias("child")))
        counted = made.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("n_children"))
        nodes.append(told.select(*key, "depth", "size", "majority").join(best, key, "left").join(counted, key, "left").select(
            *key, "depth", "size", "majority", "feature", "threshold", F.coalesce("n_children", F.lit(0)).alias("n_children")))
        edges, levels = edges.union(made), levels + 1
        state = keyed.join(few_broadcast(made.withColumnRenamed("key", "_key")), [*key, "_key"]).drop("node", "_key", "_feature", "_threshold").withColumnRenamed("child", "node")
    table = nodes[0]
    for n in nodes[1:]:
        table = table.union(n)
    return Forest(cut(table), cut(edges), tuple(numeric), tuple(categorical), levels)


def grow_tree(df: DataFrame, *, id_col: str, numeric: Sequence[str], categorical: Sequence[str], label_col: str,
              max_depth: int = 5, min_samples_split: int = 2, criterion: str = "gini") -> Forest:
    """Exact tree, one split search per level for all open nodes together. Rows without a label take no part."""
    rows = df.filter(F.col(label_col).isNotNull()).select(
        F.lit(0).alias("tree"), F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.lit(1).cast("bigint").alias("_w"), *numeric, *categorical)
    return _grow(rows, None, numeric=numeric, categorical=categorical, classes=_classes(df, label_col), label_type=df.schema[label_col].dataType.simpleString(),
                 max_depth=max_depth, min_samples_split=max(2, min_samples_split), criterion=criterion)


def _classes(df: DataFrame, label_col: str) -> list:
    """The classes; their number is the width of every count."""
    return [r[0] for r in df.filter(F.col(label_col).isNotNull()).select(label_col).distinct().orderBy(label_col).collect()]


def tree_table(df: DataFrame, tree: Forest) -> DataFrame:
    """Nodes of a tree: ``(node, depth, size, majority, feature, threshold, n_children)``."""
    return tree.nodes_table.select("node", "depth", "size", F.col("majority").cast("string").alias("majority"), "feature", "threshold", "n_children")


def ml_tree(train: DataFrame, *, features_col: str, label_col: str, max_depth: int = 5, criterion: str = "gini", max_bins: int = 32,
            min_instances: int = 1, seed: int = 42):
    return DecisionTreeClassifier(featuresCol=features_col, labelCol=label_col, maxDepth=min(max_depth, 30), impurity=criterion,
                                  maxBins=max_bins, minInstancesPerNode=min_instances, seed=seed).fit(train)


def ml_forest(train: DataFrame, *, features_col: str, label_col: str, n_trees: int = 20, max_depth: int = 10, criterion: str = "gini",
              subset: str = "sqrt", seed: int = 42):
    """Random forest with a feature subset per node."""
    return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=n_trees, maxDepth=min(max_depth, 30),
                                  impurity=criterion, featureSubsetStrategy=subset, seed=seed).fit(train)


def feature_importances(df: DataFrame, model, names: Sequence[str]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return small_table(df.sparkSession, rows, "feature string, importance double")


def subset_size(n: int, rule: int | str) -> int:
    """Number of features a tree sees: a number, ``sqrt``, ``log2`` or ``all``."""
    size = {"sqrt": math.isqrt(n), "log2": int(math.log2(max(n, 1))), "all": n}.get(rule, rule)
    return max(1, min(n, int(size)))


def exact_forest(df: DataFrame, *, id_col: str, features: Sequence[str], label_col: str, n_trees: int, subset: int | str = "sqrt", max_depth: int = 5,
                 categorical: Sequence[str] = (), criterion: str = "gini", min_samples_split: int = 2, seed: int = 42) -> Forest:
    """Per-tree bootstrap and per-tree feature subset, all trees grown exactly and together.

    ``features`` are all columns, those also named in ``categorical`` split by value. Rows without a label take no part.
    """
    chosen = cut(feature_subsets(df, features, n_trees, subset_size(len(features), subset), seed=seed))
    drawn = bootstrap(df.filter(F.col(label_col).isNotNull()).select(id_col, label_col, *features), n_trees, id_col=id_col, seed=seed)
    rows = cut(drawn.select("tree", F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col("weight").cast("bigint").alias("_w"), *features))
    order = sorted(features)
    return _grow(rows, chosen, numeric=[f for f in order if f not in categorical], categorical=[f for f in order if f in categorical], classes=_classes(df, label_col),
                 label_type=df.schema[label_col].dataType.simpleString(), max_depth=max_depth, min_samples_split=max(2, min_samples_split), criterion=criterion)


def tree_votes(df: DataFrame, forest: Forest, *, id_col: str) -> DataFrame:
    """``(id, tree, prediction)``."""
    n_trees = forest.nodes_table.agg(F.max("tree")).first()[0]
    rows = forest.route(df.select(id_col, *forest.numeric, *forest.categorical), 1 if n_trees is None else n_trees + 1)
    return rows.select(F.col(id_col).alias("id"), "tree", F.col("majority").alias("prediction"))


def hard_vote(votes: DataFrame, classes: Sequence[int]) -> DataFrame:
    """Majority of tree votes with vote shares: ``(id, prediction, n_votes, probability)``; ties go to the smallest class."""
    per = votes.groupBy("id").agg(F.count(F.lit(1)).alias("n_votes"), *[
        F.count_if(F.col("prediction") == c).alias(f"v{i}") for i, c in enumerate(classes)])
    top = F.greatest(*[F.col(f"v{i}") for i in range(len(classes))]) if len(classes) > 1 else F.col("v0")
    winner = F.lit(None).cast("int")
    for i in reversed(range(len(classes))):
        winner = F.when(F.col(f"v{i}") == top, F.lit(int(classes[i]))).otherwise(winner)
    return per.select("id", winner.alias("prediction"), "n_votes", F.array(*[
        F.col(f"v{i}") / F.col("n_votes") for i in range(len(classes))]).alias("probability"))
