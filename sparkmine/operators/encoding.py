"""Categorical encoding, scaling and assembling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.ordered import ROWS_PER_WINDOW, running_sums


def cardinalities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_distinct)``, nulls not counted.

    Values are made distinct per (column, value) before the shuffle, then counted.
    """
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("m"))
    counts = melted.select("m.column", "m.value").groupBy("column", "value").count()
    return counts.groupBy("column").agg(F.count("value").alias("n_distinct"))


def routing(df: DataFrame, columns: Sequence[str], *, cut: int = 10, inclusive: bool = False) -> DataFrame:
    """``(column, n_distinct, encoding)``: few values get label codes, many get one-hot.

    ``inclusive`` puts a column with exactly ``cut`` values on the label side.
    """
    few = F.col("n_distinct") <= cut if inclusive else F.col("n_distinct") < cut
    return cardinalities(df, columns).withColumn("encoding", F.when(few, "label").otherwise("onehot"))


def fit_routing(df: DataFrame, columns: Sequence[str], *, cut: int = 10, inclusive: bool = False) -> tuple[dict[str, str], dict[str, list]]:
    """The same decision as a dict, and the values of the label columns, from one more pass.

    Exact distinct values are only taken where the approximate count is near the cut.
    """
    if not columns:
        return {}, {}
    rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    near = [c for c in columns if rough[c] <= 4 * cut]  # so at most a few dozen values each
    seen: dict[str, list] = {c: [] for c in near}
    if near:
        melted = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in near])).alias("m"))
        for r in melted.select("m.*").distinct().collect():
            seen[r["column"]].append(r["value"])
    few = lambda c: c in seen and (n := sum(v is not None for v in seen[c])) <= cut and (inclusive or n < cut)
    return {c: "label" if few(c) else "onehot" for c in columns}, {c: v for c, v in seen.items() if few(c)}


def label_codes(df: DataFrame, column: str, *, rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """``(value, code)``: codes from 0 in sorted value order, one row per distinct value."""
    values = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct().withColumn("_one", F.lit(1))
    ranked = running_sums(values, [], "value", ["_one"], rows_per_window=rows_per_window)
    return ranked.select("value", (F.col("cum__one") - 1).cast("int").alias("code"))


def label_encode(df: DataFrame, column: str, *, into: str, rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    codes = label_codes(df, column, rows_per_window=rows_per_window).withColumnRenamed("value", column).withColumnRenamed("code", into)
    return df.join(codes, column, "left")


def fit_one_hot(df: DataFrame, columns: Sequence[str]) -> tuple[PipelineModel, dict[str, list[str]]]:
    """Fit string columns to one sparse vector ``<column>_hot`` each.

    The alphabetically first category is the dropped one: its index is moved to the
    end, where the encoder drops it. Null and unseen values become the all-zero
    vector. Returns the model and each column's kept categories in order.
    """
    codes, slots = [f"{c}_code" for c in columns], [f"{c}_slot" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    labels = indexer.labelsArray
    shift = ", ".join(
        f"CASE WHEN {c} = 0 OR {c} >= {len(v)} THEN {max(len(v) - 1, 0)} ELSE {c} - 1 END AS {s}"
        for c, s, v in zip(codes, slots, labels)
    )
    move = SQLTransformer(statement=f"SELECT *, {shift} FROM __THIS__")
    encoder = OneHotEncoder(inputCols=slots, outputCols=[f"{c}_hot" for c in columns], dropLast=True)
    # the encoder learns sizes from the largest index, so it is fitted on one row holding them
    largest = df.sparkSession.range(1).select(*[F.lit(float(max(len(v) - 1, 0))).alias(s) for s, v in zip(slots, labels)])
    model = PipelineModel(stages=[indexer, move, encoder.fit(largest)])
    return model, {c: list(v[1:]) for c, v in zip(columns, labels)}


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    model, _ = fit_one_hot(df, columns)
    hot = model.transform(df)
    return hot.select(*df.columns, *[f"{c}_hot" for c in columns])


def scaling_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one pass."""
    if not columns:
        return {}
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(columns)}


def scaled(column: str, mean: float, deviation: float) -> Column:
    """``(x - mean) / deviation``; a constant column becomes 0."""
    x = F.col(column).cast("double")
    return F.when(x.isNotNull(), F.lit(0.0)) if deviation == 0 else (x - F.lit(mean)) / F.lit(deviation)


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = scaling_stats(df, columns)
    return df.select(*[scaled(c, *stats[c]).alias(c) if c in stats else F.col(c) for c in df.columns])


def assemble(df: DataFrame, columns: Sequence[str], *, into: str = "features") -> DataFrame:
    """Dense ``array<double>`` of the columns in order."""
    return df.withColumn(into, F.array(*[F.col(c).cast("double") for c in columns]))
