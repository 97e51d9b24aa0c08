"""Profiling and cleaning of wide tables. Fits collect per-column statistics only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.functions.ordered import exact_quantiles


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def select_by_type(df: DataFrame, kind: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the ``numeric`` or ``string`` columns (and those in ``keep``); no job is run."""
    chosen = numeric_columns(df) if kind == "numeric" else string_columns(df)
    return df.select([c for c in df.columns if c in chosen or c in keep])


def select_by_index(df: DataFrame, indices: Sequence[int], *, keep: Sequence[str] = ()) -> DataFrame:
    """Keep feature columns by position; columns in ``keep`` stay and are not counted."""
    features = [c for c in df.columns if c not in keep]
    return df.select(*keep, *[features[i] for i in indices])


def _per_column(df: DataFrame, values: Mapping[str, Column], name: str) -> DataFrame:
    """One aggregate per column, as rows ``(column, <name>)``: one pass, one output row per column."""
    row = df.agg(*[v.alias(f"_{i}") for i, v in enumerate(values.values())])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias(name)) for i, c in enumerate(values)])
    return row.select(F.explode(pairs).alias("p")).select("p.column", f"p.{name}")


def profile(df: DataFrame) -> DataFrame:
    """``(column, type, n_rows, non_null)``."""
    rows = F.count(F.lit(1))
    stats = {f.name: F.struct(F.lit(f.dataType.simpleString()).alias("type"), rows.alias("n_rows"),
                              F.count(f.name).alias("non_null")) for f in df.schema}
    return _per_column(df, stats, "s").select("column", "s.type", "s.n_rows", "s.non_null")


def placeholder_to_null(df: DataFrame, placeholders: Sequence[str] = ("?",)) -> DataFrame:
    """Null out placeholder strings in every string column."""
    strings = set(string_columns(df))
    return df.select(*[
        F.when(~F.col(c).isin(*placeholders), F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def _top(counts: DataFrame, n: int) -> DataFrame:
    # one row per column of the table
    return counts.orderBy(F.desc("n"), "column").limit(n)


def missing_counts(df: DataFrame, top: int = 15) -> DataFrame:
    return _top(_per_column(df, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "n"), top)


def placeholder_counts(df: DataFrame, placeholder: str = "?", top: int = 15) -> DataFrame:
    strings = set(string_columns(df))
    counts = {c: F.count_if(F.col(c) == placeholder) if c in strings else F.count_if(F.lit(False)) for c in df.columns}
    return _top(_per_column(df, counts, "n"), top)


def kept_columns(df: DataFrame, *, min_present: float | None = None, max_missing: float | None = None) -> list[str]:
    """Columns that pass the sparse-column rule.

    ``min_present``: at least that share of rows is non-null. ``max_missing``: at
    most that share is null. The two differ at the boundary.
    """
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in df.columns]).first()
    n = row["_n"]
    if min_present is not None:
        return [c for c in df.columns if row[c] >= min_present * n]
    return [c for c in df.columns if n == 0 or (n - row[c]) / n <= max_missing]


def drop_sparse(df: DataFrame, **rule: float) -> DataFrame:
    return df.select(*kept_columns(df, **rule))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_strings(df: DataFrame, value: str = "Unknown") -> DataFrame:
    return df.fillna(value, subset=string_columns(df)) if string_columns(df) else df


def medians(df: DataFrame, columns: Sequence[str], **sizes: int) -> dict[str, float]:
    """Exact median per column; 0.0 for a column without values. ``sizes`` go to ``exact_quantiles``."""
    found = exact_quantiles(df, columns, [0.5], **sizes) if columns else {}
    return {c: (found[(None, c)][0] if found.get((None, c)) and found[(None, c)][0] is not None else 0.0) for c in columns}


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns
    ])


def impute_median(df: DataFrame, columns: Sequence[str], **sizes: int) -> DataFrame:
    return fill_values(df, medians(df, columns, **sizes))


def drop_ids(df: DataFrame, columns: Sequence[str], *, keep: str | None = None) -> DataFrame:
    """Drop identifier columns that exist; ``keep`` stays as the row id."""
    return df.drop(*[c for c in columns if c != keep])


def map_values(column: str, mapping: Mapping[str, int]) -> Column:
    """Map labels to integers; a value outside the mapping becomes null."""
    expr = F.lit(None).cast("int")
    for value, code in mapping.items():
        expr = F.when(F.col(column) == value, F.lit(code)).otherwise(expr)
    return expr
