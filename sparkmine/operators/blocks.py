"""Rows packed into bounded blocks, and joins of block pairs.

Distance operators compare blocks, not rows: a block is one row holding up to a few
thousand vectors, block pairs come from equi-joins, and each task turns one pair
into a small result (k candidates per row, a sum per cluster, a spanning forest).
Blocks that cannot hold a wanted neighbour are skipped by the triangle inequality.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import small_table
from sparkmine.functions.keys import hash_key
from sparkmine.functions.vectors import distances, matrix

MAX_BLOCK_ROWS = 2048
MAX_PIVOTS = 256
CELL_ROWS = 1024
BROADCAST_BYTES = 64 << 20
STRIPE_BYTES = 64 << 20  # payload of the blocks that a task holds while others stream by
STRIPE_ROWS = 65_536  # their rows: with as many on the other side, what one task compares
TASK_PAIRS = 1 << 30  # row pairs of one task where both sides are copied


@dataclass
class Cell:
    rows: int
    usable: int  # rows left after the most frequent tag is set aside
    radius: float
    chunks: int


@dataclass
class Blocks:
    frame: DataFrame  # cell, chunk, n, ids, xs, tags, vals (binary payloads)
    cells: dict[int, Cell]
    pivots: np.ndarray
    width: int
    p: int
    gap: np.ndarray = field(init=False)

    def __post_init__(self):
        self.gap = distances(self.pivots, self.pivots, self.p) if len(self.pivots) else np.zeros((1, 1))

    @property
    def rows(self) -> int:
        return sum(c.rows for c in self.cells.values())

    @property
    def bytes(self) -> int:
        return self.rows * (self.width + 3) * 8


@dataclass
class Block:
    ids: np.ndarray
    xs: np.ndarray
    tags: np.ndarray
    vals: np.ndarray
    kept: object = None  # what a comparison keeps of the block's rows from pair to pair of one task


def choose_pivots(df: DataFrame, id_col: str, x_col: str, *, cell_rows: int = CELL_ROWS, most: int = MAX_PIVOTS) -> np.ndarray:
    """A bounded random set of rows that act as cell centres."""
    rows, width = df.agg(F.count(F.lit(1)), F.max(F.size(x_col))).first()
    width = width or 1
    count = rows // cell_rows if width <= 16 else rows // (8 * cell_rows)
    count = min(most, count)
    if count < 2:
        return np.zeros((0, width))
    picked = df.select(id_col, x_col).orderBy(hash_key(F.col(id_col), "pivot"), id_col).limit(count).collect()
    return np.unique(np.array([r[x_col] for r in picked], dtype=float), axis=0)


PACKED = "cell int, chunk int, n int, ids binary, xs binary, tags binary, vals binary"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["tag", "id"])
    return pd.DataFrame({
        "cell": [pdf["cell"].iloc[0]], "chunk": [pdf["chunk"].iloc[0]], "n": [len(pdf)],
        "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
        "xs": [np.stack(pdf["x"].to_numpy()).astype(np.float64).tobytes()],
        "tags": [pdf["tag"].to_numpy(np.int64).tobytes()],
        "vals": [pdf["val"].to_numpy(np.float64).tobytes()],
    })


def cluster_blocks(members: DataFrame, n: int, width: int) -> tuple[Blocks, int]:
    """Blocks of ``members (id, x, cluster, size)`` that keep clusters whole, and the size limit.

    A cluster up to the limit lives in one block, so its distance to a row is complete
    inside one task. A larger one is cut into parts by a hash of the id.
    """
    limit = max(128, min(MAX_BLOCK_ROWS, math.ceil(n / 4)))
    n_blocks = max(1, math.ceil(n / limit))
    part = F.when(F.col("size") > limit, F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / limit))).otherwise(F.lit(0))
    frame = members.select(
        F.lit(0).alias("cell"), F.pmod(F.xxhash64("cluster", part), F.lit(n_blocks)).cast("int").alias("chunk"), "id", "x",
        F.col("cluster").alias("tag"), F.col("size").cast("double").alias("val"),
    ).groupBy("cell", "chunk").applyInPandas(_pack, PACKED)
    return Blocks(frame, {0: Cell(n, n, 0.0, n_blocks)}, np.zeros((0, 0)), width, 2), limit


def every_pair(q: Blocks, c: Blocks) -> list[tuple[int, int, int]]:
    return [(i, j, cell.chunks) for i in q.cells for j, cell in c.cells.items()]


def build_blocks(
    df: DataFrame,
    id_col: str,
    x_col: str,
    *,
    pivots: np.ndarray | None = None,
    like: Blocks | None = None,
    tag: str | None = None,
    val: str | None = None,
    p: int = 2,
    block_rows: int | None = None,
) -> Blocks:
    """Pack ``df`` into blocks. ``tag`` defaults to the id, ``val`` to 1.0.

    With ``like``, whose rows include these, its cells and chunks are used again.

    A row's chunk is a hash of its id, so a cell that holds a third of all rows
    (copies of one vector, say) is spread over as many blocks as it needs.
    """
    base = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(x_col).cast("array<double>").alias("x"),
        F.col(tag or id_col).cast("bigint").alias("tag"),
        (F.col(val).cast("double") if val else F.lit(1.0)).alias("val"),
    )
    if like is not None:
        pivots = like.pivots
    if pivots is None:
        pivots = choose_pivots(base, "id", "x")
    if len(pivots):
        centres = pivots

        @F.arrow_udf("struct<cell:int,away:double>")
        def place(x: pa.Array) -> pa.Array:
            d = distances(matrix(x), centres, p)
            cell = d.argmin(axis=1).astype(np.int32) if len(d) else np.zeros(0, np.int32)
            away = d[np.arange(len(d)), cell] if len(d) else np.zeros(0)
            return pa.StructArray.from_arrays([pa.array(cell), pa.array(away)], names=["cell", "away"])

        placed = base.withColumn("_p", place("x")).select("*", "_p.cell", "_p.away").drop("_p")
    else:
        placed = base.select("*", F.lit(0).alias("cell"), F.lit(0.0).alias("away"))

    if like is not None:
        cells, width = like.cells, like.width
    else:
        cells, width = _measure(placed, tag is not None, block_rows, pivots)
    spread = hash_key(F.col("id"), "chunk")
    if len(cells) == 1:
        chunked = placed.withColumn("chunk", F.pmod(spread, F.lit(next(iter(cells.values())).chunks)).cast("int"))
    else:
        counts = small_table(df.sparkSession, [(c, s.chunks) for c, s in cells.items()], "cell int, chunks int")
        chunked = placed.join(F.broadcast(counts), "cell").withColumn("chunk", F.pmod(spread, F.col("chunks")).cast("int"))

    frame = (
        chunked.select("cell", "chunk", "id", "x", "tag", "val").groupBy("cell", "chunk")
        .applyInPandas(_pack, PACKED)
    )
    return Blocks(frame, cells, pivots, width, p)


def _measure(placed: DataFrame, tagged: bool, block_rows: int | None, pivots: np.ndarray) -> tuple[dict[int, Cell], int]:
    """Size, radius and chunk count per cell, and the vector width."""
    size = [F.max("away").alias("radius"), F.max(F.size("x")).alias("width")]
    if tagged:
        stats = (
            placed.groupBy("cell", "tag").agg(F.count(F.lit(1)).alias("m"), *size)
            .groupBy("cell").agg(F.sum("m").alias("n"), F.max("m").alias("top"), F.max("radius").alias("radius"),
                                 F.max("width").alias("width"))
        )
    else:
        stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("top"), *size)
    rows = stats.collect()  # at most MAX_PIVOTS rows
    limit = block_rows or max(256, min(MAX_BLOCK_ROWS, math.ceil(sum(r["n"] for r in rows) / 4)))
    cells = {r["cell"]: Cell(r["n"], r["n"] - r["top"], r["radius"], max(1, math.ceil(r["n"] / limit))) for r in rows}
    return cells, max((r["width"] for r in rows), default=pivots.shape[1] if len(pivots) else 1)


def pairs_within(q: Blocks, c: Blocks, reach: Callable[[int], float]) -> list[tuple[int, int, int]]:
    """Cell pairs ``(query cell, corpus cell, corpus chunks)`` that may hold a pair within ``reach``."""
    out = []
    for i, qi in q.cells.items():
        r = reach(i)
        for j, cj in c.cells.items():
            gap = c.gap[i, j] if len(c.pivots) else 0.0
            if gap - qi.radius - cj.radius <= r * (1 + 1e-9) + 1e-9:
                out.append((i, j, cj.chunks))
    return out


def knn_reach(q: Blocks, c: Blocks, k: int) -> Callable[[int], float]:
    """Distance within which every row of a query cell surely finds ``k`` usable corpus rows."""
    bounds = {}
    for i, qi in q.cells.items():
        gap = c.gap[i] if len(c.pivots) else np.zeros(1)
        seen, bounds[i] = 0, math.inf
        for far, usable in sorted((gap[j] + cj.radius + qi.radius, cj.usable) for j, cj in c.cells.items()):
            seen += usable
            if seen >= k:
                bounds[i] = far
                break
    return bounds.__getitem__


def join_blocks(
    q: Blocks,
    c: Blocks,
    pairs: list[tuple[int, int, int]],
    compare: Callable[[Block, Block], pd.DataFrame],
    schema: str,
    merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    *,
    tell: Callable[[Block], pd.DataFrame] | None = None,
    both: bool = False,
    copied: bool = True,
) -> DataFrame:
    """Run ``compare`` on every listed block pair, one pair at a time inside a task.

    ``merge`` reduces the collected results of several pairs to what is still needed of
    them (the best candidates, the sums so far), so a task passes on a running result for
    each query block instead of one for every pair. It must accept its own output.
    With ``tell`` the results stay in ``kept`` of the query block, which ``tell`` reads when
    its pairs are done. With ``both`` the blocks are joined with themselves, a pair is compared
    once, and ``compare`` keeps results in both of its blocks. Unless ``copied``, small sides are dealt in stripes as well:
    a block then travels once for many pairs, which pays where a pair is compared fast.
    Tasks become more, not longer, as the rows grow.
    """
    spark = q.frame.sparkSession
    width = q.width
    if both or not copied or max(q.bytes, c.bytes) > BROADCAST_BYTES:
        return _join_stripes(q, c, pairs, compare, schema, merge, tell, both)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, left = None, None
        for batch in batches:
            keys = list(zip(batch.column("q_cell").to_pylist(), batch.column("q_chunk").to_pylist()))
            for i, key in enumerate(keys):
                if key != at:  # pairs come in the order of the query block
                    if at is not None:
                        yield None, tell(left) if tell else None
                    at, left = key, _block(batch, i, width, "q_")
                yield key, compare(left, _block(batch, i, width, "c_"))
        if tell and at is not None:
            yield None, tell(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _running(results(batches), merge)

    links, tiles, work, moved = [], 0, 0, 0
    of_cell: dict[int, list[tuple[int, int]]] = {}
    for i, j, n in pairs:
        of_cell.setdefault(i, []).append((j, n))
        work += q.cells[i].rows * c.cells[j].rows
        moved += (q.cells[i].rows * n + c.cells[j].rows * q.cells[i].chunks) * (width + 3) * 8
    for i, others in of_cell.items():
        before, across = 0, sum(n for _, n in others)
        for j, n in others:
            links.append((i, j, q.cells[i].chunks, n, tiles + before, across))
            before += n
        tiles += q.cells[i].chunks * across
    spread = max(1, min(tiles, max(4 * spark.sparkContext.defaultParallelism, math.ceil(work / TASK_PAIRS), math.ceil(moved / STRIPE_BYTES))))
    side = lambda b, s: b.frame.select(
        F.col("cell").alias(f"{s}_cell"), F.col("chunk").alias(f"{s}_chunk"),
        *[F.col(name).alias(f"{s}_{name}") for name in ("ids", "xs", "tags", "vals")],
    )
    place = F.col("first") + F.col("q_chunk") * F.col("across") + F.col("c_chunk")
    index = (
        small_table(spark, links, "q_cell int, c_cell int, q_chunks int, chunks int, first bigint, across bigint")
        .withColumn("q_chunk", F.explode(F.sequence(F.lit(0), F.col("q_chunks") - 1)))
        .withColumn("c_chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("q_cell", "q_chunk", "c_cell", "c_chunk", place.alias("place"))
    )
    # both sides were measured: copy them to the tasks and deal the pairs evenly, those of one query block together
    dealt = index.repartitionById(spread, F.floor(F.col("place") * F.lit(spread) / F.lit(max(1, tiles))).cast("int")).sortWithinPartitions("place")
    joined = dealt.join(F.broadcast(side(c, "c")), ["c_cell", "c_chunk"]).join(F.broadcast(side(q, "q")), ["q_cell", "q_chunk"])
    return joined.select(
        "q_cell", "q_chunk", *[f"{s}_{name}" for s in ("q", "c") for name in ("ids", "xs", "tags", "vals")]
    ).mapInArrow(run, schema)


def _block(batch: pa.RecordBatch, i: int, width: int, prefix: str = "") -> Block:
    raw = lambda name, kind: np.frombuffer(batch.column(prefix + name)[i].as_buffer(), dtype=kind)
    ids = raw("ids", np.int64)
    return Block(ids, raw("xs", np.float64).reshape(len(ids), width), raw("tags", np.int64), raw("vals", np.float64))


def _gathered(results: Iterator[pd.DataFrame], merge: Callable[[pd.DataFrame], pd.DataFrame] | None, limit: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Results as Arrow batches; with ``merge``, one reduced result for as many pairs as fit."""
    held: list[pd.DataFrame] = []
    rows = 0
    for out in results:
        if not len(out):
            continue
        if merge is None:
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)
            continue
        held.append(out)
        rows += len(out)
        if rows > limit:
            reduced = merge(pd.concat(held, ignore_index=True))
            held, rows = [reduced], len(reduced)
            if rows > limit // 2:  # nothing left to reduce
                yield pa.RecordBatch.from_pandas(reduced, preserve_index=False)
                held, rows = [], 0
    if held:
        yield pa.RecordBatch.from_pandas(merge(pd.concat(held, ignore_index=True)), preserve_index=False)


def _running(results: Iterator[tuple], merge: Callable[[pd.DataFrame], pd.DataFrame] | None, few: int = 4, limit: int = 100_000) -> Iterator[pa.RecordBatch]:
    """``(query block, result)`` as Arrow batches; with ``merge``, one reduced result for each query block until a key of None ends them.

    A result that comes with that key is whole; a result of None was kept in its block.
    """
    held: dict[object, list[pd.DataFrame]] = {}
    told = lambda out: pa.RecordBatch.from_pandas(out, preserve_index=False)
    for key, out in results:
        if key is None:
            yield from (told(merge(pd.concat(parts, ignore_index=True))) for parts in held.values())
            held = {}
            if out is not None and len(out):
                yield told(out)
        elif out is None or not len(out):
            continue
        elif merge is None:
            yield told(out)
        else:
            parts = held.setdefault(key, [])
            parts.append(out)
            if len(parts) >= few:
                reduced = merge(pd.concat(parts, ignore_index=True))
                held[key] = [reduced]
                if len(reduced) > limit:
                    yield told(reduced)
                    del held[key]
    yield from (told(merge(pd.concat(parts, ignore_index=True))) for parts in held.values())


def _stripes(b: Blocks, own: int) -> dict[int, tuple[float, float]]:
    """First place of every cell's rows and their number, in stripes; cells that lie near each other along one axis come together."""
    order = list(b.cells)
    if len(b.pivots) > 1:
        axis = np.linalg.svd(b.pivots - b.pivots.mean(axis=0), full_matrices=False)[2][0]
        order.sort(key=lambda i: float(b.pivots[i] @ axis))
    out, seen, total = {}, 0, max(1, b.rows)
    for i in order:
        out[i] = (seen * own / total, b.cells[i].rows * own / total)
        seen += b.cells[i].rows
    return out


def _join_stripes(q: Blocks, c: Blocks, pairs: list[tuple[int, int, int]], compare: Callable, schema: str, merge: Callable | None,
                  tell: Callable | None = None, both: bool = False) -> DataFrame:
    """Sides too large to copy: each is dealt into stripes, and a task compares one stripe with one stripe.

    A stripe holds a bounded number of rows and bytes. A block travels once for every stripe of the other side that may
    matter to it, the root of the number of tasks. The task holds the blocks of its query stripe and streams the others.
    """
    spark = q.frame.sparkSession
    width = q.width
    need = lambda b: max(1, math.ceil(b.bytes / STRIPE_BYTES), math.ceil(b.rows / STRIPE_ROWS))
    blocks = lambda b: sum(x.chunks for x in b.cells.values())
    rows, cols = need(q), need(c)
    more = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism / (rows * cols)))
    rows, cols = max(rows, min(blocks(q), rows * more)), max(cols, min(blocks(c), cols * more))
    at_q, at_c = _stripes(q, rows), _stripes(c, cols)
    wanted = {(i, j) for i, j, _ in pairs}

    def stripes(at: tuple[float, float], chunks: int, own: int) -> set[int]:
        return {min(own - 1, int(at[0] + (k + 0.5) / chunks * at[1])) for k in range(chunks)}

    of_q = {i: stripes(at_q[i], x.chunks, rows) for i, x in q.cells.items()}
    of_c = {j: stripes(at_c[j], x.chunks, cols) for j, x in c.cells.items()}
    met = sorted({(r, k) for i, j in wanted for r in of_q[i] for k in of_c[j] if not both or r <= k})
    if not met:
        return small_table(spark, [], schema)

    def side(b: Blocks, at: dict[int, tuple[float, float]], own: int, first: bool) -> DataFrame:
        cells = small_table(spark, [(i, *at[i], x.chunks) for i, x in b.cells.items()], "cell int, first double, span double, chunks int")
        tasks = small_table(spark, [(p[0 if first else 1], t) for t, p in enumerate(met)], "stripe int, task int")
        stripe = F.least(F.lit(own - 1), F.floor(F.col("first") + (F.col("chunk") + 0.5) / F.col("chunks") * F.col("span"))).cast("int")
        placed = b.frame.join(F.broadcast(cells), "cell").withColumn("stripe", stripe).join(F.broadcast(tasks), "stripe")
        return placed.select("task", F.lit(0 if first else 1).alias("side"), "cell", "chunk", "ids", "xs", "tags", "vals")

    sides = side(q, at_q, rows, True).union(side(c, at_c, cols, False))

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, held = None, []
        ended = lambda: ((None, tell(left)) for _, left in held) if tell else [(None, None)]
        for batch in batches:
            task, where, cell, chunk = (batch.column(k).to_pylist() for k in ("task", "side", "cell", "chunk"))
            for i in range(batch.num_rows):
                if at != task[i]:
                    if at is not None:
                        yield from ended()
                    at, held = task[i], []
                block = _block(batch, i, width)
                own = (cell[i], chunk[i])
                if where[i] == 0:
                    held.append((own, block))
                    continue
                alike = both and met[at][0] == met[at][1]
                for key, left in held:
                    if (key[0], cell[i]) in wanted and not (alike and key > own):
                        yield key, compare(left, left if alike and key == own else block)
                if both and block.kept is not None:
                    yield None, tell(block)
        if tell and at is not None:
            yield from ended()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _running(results(batches), merge)

    return sides.repartitionById(len(met), "task").sortWithinPartitions("task", "side").mapInArrow(run, schema)


def chunked_rows(n_rows: int, n_cols: int, cells: int = 1 << 16) -> Iterator[slice]:
    """Row slices whose distance matrix stays within half a megabyte, the cache of a core."""
    step = max(1, cells // max(1, n_cols))
    for start in range(0, n_rows, step):
        yield slice(start, min(n_rows, start + step))
