"""Deterministic pseudo-random keys: the same id and seed give the same number anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_RANGE = 4294967296  # 2**32
WIDE_BITS = 60


def _digits(id_col: Column, seed, n: int) -> Column:
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat_ws("-", id_col.cast("string"), seed.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, n), 16, 10).cast("bigint")


def hash_key(id_col: Column, seed) -> Column:
    """32-bit key in ``[0, 2**32)``."""
    return _digits(id_col, seed, 8)


def wide_key(id_col: Column, seed) -> Column:
    """60-bit key, wide enough that ties do not matter when cutting at a rank."""
    return _digits(id_col, seed, 15)


def uniform(id_col: Column, seed) -> Column:
    """Uniform number in the open interval (0, 1)."""
    return (hash_key(id_col, seed) + F.lit(0.5)) / F.lit(float(KEY_RANGE))
