"""Joins in which a null key is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.lineage import small_table

#: most rows of a driver-made table (statistics, limits, model parts) that are broadcast; more are shuffled
BROADCAST_ROWS = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` with null equal to null; without columns every row meets the one row of ``right``."""
    if not on:
        return left.join(F.broadcast(right))
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in on])


def side_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Driver rows as the small side of a join: broadcast up to ``BROADCAST_ROWS``, shuffled beyond."""
    table = small_table(spark, rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table
