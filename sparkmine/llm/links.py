"""Links inside bounded blocks: forests instead of pair lists, and counts instead of pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import given_back, kept
from sparkmine.operators.components import connected_components


#: cells of a matrix that are worked on at a time
CELLS = 1 << 18


def lowest(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches over a square matrix of links; some rows at a time, to hold little."""
    n = len(linked)
    label = np.arange(n, dtype=np.int32)
    step = max(1, CELLS // max(1, n))
    while True:
        new = label.copy()
        for k in range(0, n, step):
            np.minimum(new[k:k + step], np.where(linked[k:k + step], label[None], np.int32(n)).min(axis=1, initial=n), out=new[k:k + step])
        new = new[new]
        if (new == label).all():
            return label.astype(np.int64)
        label = new


def unit_forest(units: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the units whose rows the links join, fewer than there are units."""
    unit, of = np.unique(units, return_inverse=True)
    if len(unit) == len(units):
        order = np.argsort(units, kind="stable")
        return forest(units[order], linked[np.ix_(order, order)])
    between = np.zeros((len(unit), len(unit)), dtype=bool)
    row, col = np.nonzero(linked)
    between[of[row], of[col]] = True
    return forest(unit, between)


def forest(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join exactly what the links join: every id to the smallest index it reaches."""
    root = lowest(linked)
    other = np.flatnonzero(root != np.arange(len(root)))
    return ids[other], ids[root[other]]


def forest_between(left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for links between two different blocks."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return left[:0], right[:0]
    part = linked[np.ix_(rows, cols)]
    n, m = part.shape
    step = max(1, CELLS // m)
    label = np.arange(n, dtype=np.int32)
    while True:
        other = np.full(m, n, dtype=np.int32)
        for k in range(0, n, step):
            np.minimum(other, np.where(part[k:k + step], label[k:k + step, None], np.int32(n)).min(axis=0), out=other)
        new = label.copy()
        for k in range(0, n, step):
            np.minimum(new[k:k + step], np.where(part[k:k + step], other[None], np.int32(n)).min(axis=1), out=new[k:k + step])
        if (new == label).all():
            break
        label = new
    first = part.argmax(axis=1)  # some right-hand partner of each row keeps the row in its tree
    return np.concatenate([left[rows], right[cols]]), np.concatenate([right[cols[first]], left[rows[other]]])


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows ordered by ``keys`` as one table for each key; only the open one is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        ends = np.r_[cut, batch.num_rows]
        for a, b in zip(np.r_[0, cut], ends):
            held.append(batch.slice(int(a), int(b - a)))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def component_of(edges: DataFrame, name: str = "component") -> DataFrame:
    """``(id, <name>)`` for the ends of ``edges (a, b)``: the smallest id of their component."""
    return kept(connected_components(edges).select("id", F.col("root").alias(name)), name)


def tiled_links(members: DataFrame, group: str, load: str, limit: int, payload: list[str], compare: Callable, schema: str) -> DataFrame:
    """Compare all members of a group, in tiles of two stripes of bounded load, and return what ``compare`` emits.

    ``members`` has ``id``, ``group``, ``load`` and ``payload``. A group is cut by a hash of the id into stripes of
    about ``limit`` load; a stripe meets every stripe of its group once, so a row is sent as often as its group has
    stripes and a task holds two stripes. ``compare(left, right)`` gets Arrow tables (``right`` is None inside a
    stripe) and yields record batches.
    """
    size = members.groupBy(group).agg(F.ceil(F.sum(load) / limit).cast("int").alias("_stripes"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    placed = members.join(size, group).withColumn("_s", F.pmod(F.xxhash64("id", F.lit(41)), F.col("_stripes")).cast("int"))
    tiles = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_stripes") - 1))).select(
        group, F.least("_s", "_o").alias("_i"), F.greatest("_s", "_o").alias("_j"), (F.col("_s") > F.col("_o")).cast("int").alias("_side"), "id", *payload)
    keys = [group, "_i", "_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            if table.column("_i")[0] == table.column("_j")[0]:
                if table.num_rows > 1:
                    yield from compare(table, None)
                continue
            side = table.column("_side").to_numpy()
            left, right = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
            if left.num_rows and right.num_rows:
                yield from compare(left, right)
        given_back()

    return tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
