"""Near-duplicate vectors by NN-descent: a neighbour graph refined through neighbours of neighbours.

Equal vectors of a label are one with a multiplicity. Random hyperplanes give a first graph; rounds of local joins
(all neighbours and reverse neighbours of a vector meet each other) improve it, and lists that are full of near
copies are doubled. Close neighbours form loose groups inside which all pairs are compared in double precision, so
links are counted exactly and no list limits them. Probes against all vectors audit the recall, more of them until enough
have a link; below the target the graph gets more hyperplanes and more rounds, and if that does not help, all vectors of
a label are compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import kept
from sparkmine.llm.links import component_of, forest, forest_between, runs, tiled_links

THRESHOLD, LOOSE = 0.98, 0.97
K, TREES, ROUNDS = 6, 6, 2
LEAF, CHUNK, STRIPE = 64, 256, 2048
#: vectors of the recall audit (compared with all rows), the recall asked for, and the attempts
PROBES, TARGET, ATTEMPTS = 1024, 0.995, 3
#: probes with a link that an audit should rest on, and the most probes that it draws for that
PARTNERED, MOST_PROBES = 32, 1 << 15


def _unit(vectors: DataFrame) -> DataFrame:
    """``id, g, x``: usable vectors scaled to length one, as doubles; ``g`` stands for label and dimension."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    x = F.col("embedding").cast("array<double>")
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(
        F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0))
    rows = usable.groupBy("vec_id").agg(F.min(F.struct("label", x.alias("x"))).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("x"):
                a = v.values.to_numpy(zero_copy_only=False)
                a = a / np.abs(a).max()
                out.append((a / np.sqrt((a * a).sum()) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("g"), pa.array(out, pa.binary())], names=["id", "g", "x"])

    return rows.select(F.col("vec_id").alias("id"), F.xxhash64("s.label", F.size("s.x")).alias("g"), F.col("s.x").alias("x")).mapInArrow(
        run, "id long, g long, x binary")


def _matrix(column, dtype=np.float64) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=dtype).reshape(len(raw), -1)


def _leaves(reps: DataFrame, sizes: DataFrame, trees: int, seed: int) -> DataFrame:
    """``leaf, id, y``: the side of every hyperplane of a tree names the leaf; ``y`` is the vector in single precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            g, bits, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "bits", "id"))
            raw = batch.column("x").to_pylist()
            width = np.array([len(r) for r in raw])
            for d in np.unique(width):
                at = np.flatnonzero(width == d)
                x = np.frombuffer(b"".join([raw[k] for k in at]), dtype=np.float64).reshape(len(at), -1)
                y = [r.tobytes() for r in x.astype(np.float32)]
                for t in range(trees):
                    plane = np.random.default_rng([seed, t]).normal(size=(x.shape[1], 20))
                    side = ((x @ plane) > 0) & (np.arange(20)[None] < bits[at, None])
                    code = side @ (1 << np.arange(20))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[at]), pa.array(code * 64 + t), pa.array(ids[at]), pa.array(y, pa.binary())], names=["g", "code", "id", "y"])

    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / LEAF)), F.lit(0)), F.lit(20)).cast("int")
    rows = reps.join(sizes.select("g", bits.alias("bits")), "g").select("g", "bits", "id", "x").mapInArrow(run, "g long, code long, id long, y binary")
    return rows.select(F.xxhash64("g", "code").alias("leaf"), "id", "y")


def _meet(rows: DataFrame, k: int) -> DataFrame:
    """All vectors of a leaf meet; each keeps its ``k`` best and every near copy up to four times as many: ``a, b, sim``.

    Large leaves are cut into chunks by a hash of the id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["leaf", "chunk"]):
            ids, first = np.unique(table.column("id").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            y = _matrix(table.column("y"), np.float32)[first]
            sim = y @ y.T
            np.fill_diagonal(sim, -2.0)
            take = min(4 * k, len(ids) - 1)
            best = np.argpartition(-sim, take - 1, axis=1)[:, :take]
            value = np.take_along_axis(sim, best, axis=1)
            place = np.argsort(np.argsort(-value, axis=1, kind="stable"), axis=1)
            row, col = np.nonzero((place < k) | (value >= LOOSE))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(ids[best[row, col]]), pa.array(value[row, col])], names=["a", "b", "sim"])

    size = rows.groupBy("leaf").count()
    cut = rows.join(size, "leaf").withColumn("chunk", F.pmod(F.xxhash64("id", "leaf"), F.ceil(F.col("count") / CHUNK))).select("leaf", "chunk", "id", "y")
    return cut.repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk").mapInArrow(run, "a long, b long, sim float")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours ``a, b, sim, room`` of every vector, and of near copies as many as it has room for.

    A list starts with room for ``4 * k`` near copies; where more are found than it holds, its room is doubled.
    """
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("room").alias("room"))
    mine = Window.partitionBy("a")
    near, had = F.count_if(F.col("sim") >= LOOSE).over(mine), F.coalesce(F.max("room").over(mine), F.lit(2 * k))
    room = F.when((near > had) | F.max("room").over(mine).isNull(), had * 2).otherwise(had)
    placed = one.select("a", "b", "sim", room.alias("room"), F.row_number().over(mine.orderBy(F.desc("sim"), "b")).alias("place"))
    return placed.filter((F.col("place") <= k) | ((F.col("sim") >= LOOSE) & (F.col("place") <= F.col("room")))).drop("place")


def neighbour_graph(reps: DataFrame, *, trees: int = TREES, rounds: int = ROUNDS, k: int = K, seed: int = 1) -> DataFrame:
    """``a, b, sim, room``: approximate nearest neighbours of equal ``g``."""
    sizes = kept(reps.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "sizes")
    single = reps.select("id", "x").mapInArrow(_to_single, "id long, y binary")
    fresh = lambda met: met.withColumn("room", F.lit(None).cast("int"))
    graph = kept(_best(fresh(_meet(_leaves(reps, sizes, trees, seed), k)), k), "graph")
    for _ in range(rounds):
        around = graph.select(F.col("a").alias("leaf"), F.col("b").alias("id")).union(
            graph.select(F.col("b").alias("leaf"), F.col("a").alias("id"))).union(graph.select(F.col("a").alias("leaf"), F.col("a").alias("id"))).distinct()
        found = _meet(around.join(single, "id").select("leaf", "id", "y"), k)
        graph = kept(_best(graph.union(fresh(found)), k), "graph")
    return graph


def _to_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = [np.frombuffer(r, dtype=np.float64).astype(np.float32).tobytes() for r in batch.column("x").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(y, pa.binary())], names=["id", "y"])


def _exact(threshold: float):
    def compare(left: pa.Table, right: pa.Table | None) -> Iterator[pa.RecordBatch]:
        a, ida, ca = _matrix(left.column("x")), left.column("id").to_numpy(), left.column("copies").to_numpy()
        b, idb, cb = (_matrix(right.column("x")), right.column("id").to_numpy(), right.column("copies").to_numpy()) if right is not None else (a, ida, ca)
        linked = a @ b.T >= threshold
        if right is None:
            np.fill_diagonal(linked, False)
            edge, weight = forest(ida, linked), (ida, linked @ cb)
        else:
            edge = forest_between(ida, idb, linked)
            weight = (np.concatenate([ida, idb]), np.concatenate([linked @ cb, ca @ linked]))
        some = weight[1] > 0
        what = np.r_[np.zeros(len(edge[0]), np.int32), np.ones(int(some.sum()), np.int32)]
        if len(what):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([edge[0], weight[0][some]])), pa.array(np.concatenate([edge[1], weight[1][some]]).astype(np.int64)), pa.array(what)],
                names=["a", "b", "what"])

    return compare


def recall(reps: DataFrame, links: DataFrame, *, threshold: float = THRESHOLD, probes: int = PROBES) -> tuple[float, int]:
    """Share of the true links of hash-chosen probes that ``links (id, others)`` counts, and the number of probes that have some.

    Every probe with a link weighs the same, however many copies it has. Up to eight times as many probes follow until
    ``PARTNERED`` of them have a link, or ``MOST_PROBES`` or all vectors were asked; without any link the share is 1.
    """
    turn = F.xxhash64("id", F.lit(51))
    share, partnered, first = 0.0, 0, 0
    while first < MOST_PROBES:
        chosen = reps.orderBy(turn, "id").limit(first + probes).select("id", "g", "x").toArrow().slice(first)
        if chosen.num_rows:
            found, some = _audit(reps, links, chosen, threshold)
            share, partnered = share + found, partnered + some
        if chosen.num_rows < probes or partnered >= PARTNERED:
            break
        first, probes = first + probes, min(8 * probes, MOST_PROBES)
    return (share / partnered if partnered else 1.0), partnered


def _audit(reps: DataFrame, links: DataFrame, chosen: pa.Table, threshold: float) -> tuple[float, int]:
    """Sum of the shares found over the probes with a true link, and their number."""
    ids, groups = chosen.column("id").to_numpy(), chosen.column("g").to_numpy()
    raw = chosen.column("x").to_pylist()
    of = {int(g): np.flatnonzero(groups == g) for g in np.unique(groups)}
    asked = {g: np.frombuffer(b"".join([raw[k] for k in at]), dtype=np.float64).reshape(len(at), -1) for g, at in of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            own, g, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "g", "copies"))
            vectors = batch.column("x").to_pylist()
            for group in np.unique(g):
                if int(group) not in of:
                    continue
                at = np.flatnonzero(g == group)
                for k in range(0, len(at), 256):
                    some = at[k:k + 256]
                    x = np.frombuffer(b"".join([vectors[i] for i in some]), dtype=np.float64).reshape(len(some), -1)
                    probe = of[int(group)]
                    linked = (asked[int(group)] @ x.T >= threshold) & (ids[probe][:, None] != own[some][None])
                    total[probe] += linked @ copies[some]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], names=["id", "true"])

    truth = reps.select("id", "g", "x", "copies").mapInArrow(run, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    row = truth.join(links, "id", "left").agg(F.sum(F.least("true", F.coalesce("others", F.lit(0))) / F.col("true")), F.count(F.lit(1))).first()
    return row[0] or 0.0, row[1]


def vector_classes(vectors: DataFrame, *, threshold: float = THRESHOLD, attempts: int = ATTEMPTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for every vec_id.

    Vectors link if their labels are equal and not null, their dimensions are equal and their cosine, in double
    precision, is ``threshold`` or more. Null, zero and not finite vectors link with nothing. Copies count as links.
    Of repeated rows of one vec_id the smallest (label, vector) counts; rows without a vec_id are left out; an
    empty table gives an empty result. If ``attempts`` graphs stay below the recall ``TARGET``, all vectors of a label
    are compared: exact, and quadratic in them.
    """
    with scratch_scope(vectors.sparkSession):
        unit = kept(_unit(vectors), "unit", lasting=True)
        reps = kept(unit.groupBy("g", "x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "reps")
        one = reps.select("id", "g", "x", "copies", F.lit(1).alias("load"))

        def linked(members: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
            found = kept(tiled_links(members, group, "load", STRIPE, ["copies", "x"], _exact(threshold), "a long, b long, what int"), "links")
            return found, kept(found.filter("what = 1").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("others")), "weights")

        graph = None
        for attempt in range(attempts):
            new = neighbour_graph(reps, trees=TREES * (attempt + 1), rounds=ROUNDS + attempt, seed=attempt + 1).select("a", "b", "sim")
            graph = new if graph is None else kept(graph.union(new), "graph")
            loose = component_of(graph.filter(F.col("sim") >= LOOSE).select("a", "b"), "loose")
            found, weight = linked(loose.join(one, "id"), "loose")
            if recall(reps, weight, threshold=threshold)[0] >= TARGET:
                break
        else:
            found, weight = linked(one, "g")
        classes = component_of(found.filter("what = 0").select("a", "b"), "component")
        per_rep = kept(reps.join(classes, "id", "left").join(weight, "id", "left").select(
            "g", "x", F.coalesce("component", "id").alias("component_id"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes", lasting=True)
    linked_rows = unit.join(per_rep, ["g", "x"]).select(F.col("id").alias("vec_id"), "component_id", "n_links")
    ids = vectors.filter("vec_id is not null").select("vec_id").distinct()
    out = ids.join(linked_rows, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


# The same by comparing every pair of a label.
SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings WHERE label IS NOT NULL),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a), links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON vec_id = low.a LEFT JOIN links ON vec_id = links.a"""
