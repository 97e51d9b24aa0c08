"""Cutting lineage and finding the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is only
    made in local mode, where every task runs on this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(own)
    return own


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch tables of the running operator", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that ``cut`` writes inside, once the caller holds a result that no longer reads them."""
    paths: list[str] = []
    before = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(before)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scoped(operator: Callable) -> Callable:
    """For operators whose result is made of driver values: their scratch tables go when they return."""

    @wraps(operator)
    def run(df: DataFrame, *args, **options):
        with scratch_scope(df.sparkSession):
            return operator(df, *args, **options)

    return run


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and drop its lineage: a table written to the shared folder.

    A written table survives lost executors, and its real size feeds the next join
    choice; a checkpointed frame would carry old estimates and constraints along.
    """
    path = passing_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def passing_path(spark: SparkSession, name: str) -> str:
    """A new path that the scope of the running operator drops."""
    path = scratch_path(spark, name)
    if (held := _SCOPE.get()) is not None:
        held.append(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under one folder per application so it can be dropped as a whole."""
    return f"{scratch_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A handful of driver rows (statistics, cell pairs, model parts) as a local relation of known size."""
    kind = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in kind]
    arrow = pa.table({
        f.name: pa.array(list(c), type=to_arrow_type(f.dataType)) for f, c in zip(kind, columns)
    })
    return spark.createDataFrame(arrow, schema=kind)
