"""Radius joins over a grid: cells on the leading one or two dimensions, joined with their neighbours.

A cell is at least as wide as the radius, so two rows within it lie in the same or in touching cells, whatever the
norm. Cells and their sizes stay in tables: their number grows with the rows, and nothing about them is collected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import cut
from sparkmine.operators.blocks import CELL_ROWS, MAX_BLOCK_ROWS, PACKED, Block, _block, _gathered, _pack

KEY = ["gx", "gy"]
TILE = 4  # blocks of a crowded cell that one task takes of either side
TASK_PAIRS = 1 << 31  # row pairs of one task if all its blocks were full


@dataclass
class Grid:
    side: float
    width: int

    def blocks(self, df: DataFrame, id_col: str, x_col: str, *, tag: str | None = None, val: str | None = None) -> DataFrame:
        """``(gx, gy, ids, xs, tags, vals)``; a crowded cell is cut into several blocks by a hash of the id."""
        x = F.col(x_col).cast("array<double>")
        cell = lambda k: F.floor(F.try_element_at(x, F.lit(k)) / F.lit(self.side)).cast("bigint") if self.width >= k else F.lit(0).cast("bigint")
        rows = df.select(
            cell(1).alias("gx"), cell(2).alias("gy"), F.col(id_col).cast("bigint").alias("id"), x.alias("x"),
            F.col(tag or id_col).cast("bigint").alias("tag"), (F.col(val).cast("double") if val else F.lit(1.0)).alias("val"))
        sizes = rows.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / MAX_BLOCK_ROWS).alias("_chunks"))
        dealt = rows.join(sizes, KEY).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("_chunks")).cast("int"))

        def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return _pack(pdf.assign(cell=0)).assign(gx=key[0], gy=key[1])

        return dealt.drop("_chunks").groupBy(*KEY, "chunk").applyInPandas(pack, f"{PACKED}, gx bigint, gy bigint").select(*KEY, "ids", "xs", "tags", "vals")


def grid_for(df: DataFrame, x_col: str, eps: float) -> Grid:
    """Cells no narrower than ``eps``, wider where that leaves fewer than about ``CELL_ROWS`` rows in each."""
    x = F.col(x_col)
    spread = lambda k: F.max(F.try_element_at(x, F.lit(k))) - F.min(F.try_element_at(x, F.lit(k)))
    n, width, a, b = df.agg(F.count(F.lit(1)), F.max(F.size(x)), spread(1), spread(2)).first()
    width, n = width or 1, n or 1
    share = min(1.0, CELL_ROWS / n)
    side = (a or 0.0) * share if width == 1 else math.sqrt(max(a or 0.0, eps) * max(b or 0.0, eps) * share)
    return Grid(max(eps * (1 + 1e-9), side, 1e-300), width)


def join_cells(q: DataFrame, c: DataFrame, width: int, compare: Callable[[Block, Block], pd.DataFrame], schema: str,
               merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None, *, symmetric: bool = False) -> DataFrame:
    """Run ``compare`` on all blocks of the same or touching cells; with ``symmetric``, once for each two cells.

    A cell of many blocks is dealt into tiles of about ``TILE`` blocks on either side, and the tiles to a number of tasks
    that follows the block pairs. Blocks are exchanged, not copied through the driver; a task holds the query blocks of a
    tile and streams the others.
    """
    spark = q.sparkSession
    q, c = (cut(q),) * 2 if q is c else (cut(q), cut(c))
    near = [(i, j) for i in (-1, 0, 1) for j in ((-1, 0, 1) if width > 1 else (0,)) if not symmetric or (i, j) >= (0, 0)]
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near]))

    def moved(b: DataFrame) -> DataFrame:
        shifted = b.withColumn("_o", around)
        return shifted.withColumn("gx", F.col("gx") + F.col("_o.i")).withColumn("gy", F.col("gy") + F.col("_o.j")).drop("_o")

    tiles = lambda b, name: b.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))
    rows = tiles(q, "own")
    cells = cut(tiles(c, "cols").join(moved(rows).groupBy(*KEY).agg(F.max("own").alias("rows")), KEY))
    pairs = (cells.agg(F.sum(F.col("rows").cast("bigint") * F.col("cols"))).first()[0] or 0) * TILE * TILE * len(near) * MAX_BLOCK_ROWS ** 2
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(pairs / TASK_PAIRS))
    tile = lambda n: F.pmod(F.xxhash64("ids"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = ["ids", "xs", "tags", "vals"]
    left = moved(q.join(rows, KEY).withColumn("row", tile("own")).select(*KEY, "row", *blocks)).join(cells, KEY).withColumn("col", every("cols"))
    right = c.join(cells, KEY).withColumn("col", tile("cols")).withColumn("row", every("rows"))
    where = [*KEY, "row", "col"]
    side = lambda b, n: b.select(*where, F.lit(n).alias("side"), *blocks)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for batch in batches:
            for k, (*key, which) in enumerate(zip(*(batch.column(n).to_pylist() for n in (*where, "side")))):
                if key != at:
                    at, held = key, []
                block = _block(batch, k, width)
                if which == 0:
                    held.append(block)
                else:
                    yield from (compare(other, block) for other in held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(compared(batches), merge)

    return side(left, 0).union(side(right, 1)).repartition(tasks, *where).sortWithinPartitions(*where, "side").mapInArrow(run, schema)
