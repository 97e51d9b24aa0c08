"""Helpers shared by the corpus operators: written intermediate tables and bounded Arrow slices."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.lineage import passing_path, scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a finished write are removed at once instead of at the next collection."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def kept(df: DataFrame, name: str = "kept", *, lasting: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, its shuffle files go.

    Inside a ``scratch_scope`` the table goes with the scope unless it is ``lasting``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) if lasting else passing_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``limit`` bytes a piece; one long row may be a piece of its own."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, n]):
        yield batch.slice(int(a), int(b - a))


def held_out(doc_id) -> F.Column:
    """True for the fifth of the documents that no model may learn from; a null id is held out as well."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def given_back() -> None:
    """Return freed memory to the system at the end of a task: a worker goes on with other operators, beside other workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
