"""Similarity self-join of texts on word shingles by chosen paths.

Texts with the same shingle set are one set with a multiplicity. A set is embedded as a fixed number of sampled
tokens (minimum hashes). In every run a set follows each of its tokens whose hash, given the path so far, is below
a bound: similar sets share such choices at every level. Paths that few sets share are compared at once, longer
ones are split further along more chosen tokens, and the deepest are compared whole, tile by tile. Sets found to
resemble each other form loose groups, inside which every pair is compared on the whole shingle sets, so links and
their numbers are exact for all that the runs bring together. Probes against all sets audit the runs; more follow
until the target is met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import given_back, kept, slices
from sparkmine.llm.links import component_of, forest, forest_between, runs, tiled_links, unit_forest
from sparkmine.llm.words import U, mix, windows, words

SHINGLE, THRESHOLD = 5, 0.8
SAMPLED, RUNS, DEPTH = 64, 8, 2
#: a token is followed with probability BRANCHING / SAMPLED on the first level and DEEPER / SAMPLED below it, so that
#: similar sets share 0.8 * BRANCHING choices at first, and one choice on average where a crowded path is split further
BRANCHING, DEEPER = 2.0, 1.25
SMALL = 64          # sets on a path that are compared at once
CHUNK = 512         # sets on a deepest path that are compared at once; a longer path goes on to tiles
TILE = 1024         # sets of one side of a tile, on average
LOOSE = 0.6         # sampled agreement that puts two sets into one group
STRIPE = 750_000    # shingles that a task holds of one stripe
ROWS = 2048         # sets of one stripe, as a comparison holds rows x rows matrices
BLOCK = 1 << 16     # shingles that are bit columns at a time
AHEAD = 1 << 20     # number of the run that goes ahead of the others
#: sets of the audit (compared with all sets by their samples), the recall asked for, and the attempts
PROBES, TARGET, ATTEMPTS = 1024, 0.995, 4
#: sampled agreement below the threshold at which the audit still asks for a pair: few pairs of the threshold agree less
MARGIN = 0.1
#: samples of a band and bands by which the audit finds sets that have a partner
BAND, BANDS = 4, 4
SLICE = 1 << 20


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted inside a text, and where each text begins.

    A text of fewer words than ``size`` is one shingle of all its words; one without words has none.
    """
    w = words(texts)
    n = len(texts)
    place, value = windows(w, size)
    count = np.diff(w.first)
    doc = w.doc[place]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.array([mix(np.array([count[d]], dtype=U) + sum(
            (mix(w.hash[w.first[d] + k:w.first[d] + k + 1] + U(k + 1)) for k in range(count[d])), np.zeros(1, dtype=U)))[0] for d in short], dtype=U)
        doc, value = np.concatenate([doc, short]), np.concatenate([value, whole])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(n + 1))


def sample_tokens(value: np.ndarray, first: np.ndarray, t: int = SAMPLED) -> np.ndarray:
    """For each set the least hash in each of ``t`` equal ranges; an empty range borrows from one chosen by hash."""
    n = len(first) - 1
    out = np.zeros((n, t), dtype=np.uint64)
    full = np.zeros((n, t), dtype=bool)
    doc = np.repeat(np.arange(n), np.diff(first))
    place = (value >> U(64 - int(np.log2(t)))).astype(np.int64)
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])]) if len(doc) else doc
    out[doc[head], place[head]] = value[head]
    full[doc[head], place[head]] = True
    some = np.diff(first) > 0
    attempt = 0
    given = full.copy()
    while not given[some].all():
        attempt += 1
        row, col = np.nonzero(~given & some[:, None])
        source = (mix((col + t * attempt).astype(U)) % U(t)).astype(np.int64)
        ok = full[row, source]
        out[row[ok], col[ok]] = out[row[ok], source[ok]]
        given[row[ok], col[ok]] = True
    return (mix(out + np.arange(t, dtype=U)) >> U(32)).astype(np.uint32)


def _sums(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of every set and two sums over it; equal ones mean equal sets."""
    one, two = np.r_[U(0), np.cumsum(value)], np.r_[U(0), np.cumsum(mix(value + U(77)))]
    return np.diff(first).astype(np.int32), (one[first[1:]] - one[first[:-1]]).view(np.int64), (two[first[1:]] - two[first[:-1]]).view(np.int64)


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                value, first = shingle_sets(part.column("text"), size)
                sig = sample_tokens(value, first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, _sums(value, first)), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "n", "k1", "k2", "sig"])

    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, n int, k1 long, k2 long, sig binary")


def _choose(sig: np.ndarray, path: np.ndarray, branching: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and new paths of the chosen tokens: those whose hash on this path is below the bound."""
    h = mix(sig.astype(U) * U(SAMPLED) + np.arange(sig.shape[1], dtype=U) + mix(path)[:, None])
    row, col = np.nonzero(h < U(int(branching / sig.shape[1] * 2.0 ** 64)))
    return row, h[row, col]


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), SAMPLED)


def _start(sets: DataFrame, runs_: int, branching: float, first: int = 0) -> DataFrame:
    """First level: every set ``(id, unit, sig)`` takes part in every run; runs are numbered from ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, ids, units = _tokens(batch.column("sig")), batch.column("id").to_numpy(), batch.column("unit").to_numpy()
            for r in range(first, first + runs_):
                row, path = _choose(sig, np.full(len(ids), r, dtype=U), branching)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[row]), pa.array(units[row])], names=["path", "id", "unit"])

    return sets.select("id", "unit", "sig").mapInArrow(run, "path long, id long, unit long")


def _deeper(rows: DataFrame, branching: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, path = _choose(_tokens(batch.column("sig")), batch.column("path").to_numpy().view(U), branching)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path.view(np.int64)), *(pa.array(batch.column(c).to_numpy()[row]) for c in ("id", "unit"))], names=["path", "id", "unit"])

    return rows.select("path", "id", "unit", "sig").mapInArrow(run, "path long, id long, unit long")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), dtype=np.uint8)
    for k in range(a.shape[1]):
        out += a[:, k, None] == b[None, :, k]
    return out


def _compare_paths(rows: DataFrame) -> DataFrame:
    """Edges between the units of a path whose sets agree loosely, a forest for each path: ``(a, b)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["path"]):
            if table.num_rows > 1:
                sig = _tokens(table.column("sig").combine_chunks())
                a, b = unit_forest(table.column("unit").to_numpy(), _agreement(sig, sig) >= LOOSE * SAMPLED)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.select("path", "unit", "sig").repartition("path").sortWithinPartitions("path").mapInArrow(run, "a long, b long")


def _compare_tiles(rows: DataFrame, sig: DataFrame) -> DataFrame:
    """The same for crowded paths, whole: all sets ``(path, id, unit, count)`` of a path meet, unless their ``unit`` is equal.

    Units are groups found before, whose sets need no edge between them any more. A unit that fills a tile on a path has
    stripes of its own, which do not meet; the sets of smaller ones are pooled. Either are dealt to stripes by a hash of the
    set, so that a stripe has about ``TILE`` rows whatever the units. A row travels once for every stripe it meets.
    """
    size = rows.groupBy("path", "unit").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") > TILE, F.col("unit"))
    chunk = lambda n: F.pmod(F.xxhash64("id", F.lit(43)), n)
    stripe = F.when(own.isNotNull(), F.xxhash64("unit", chunk(F.ceil(F.col("n") / TILE)))).otherwise(chunk(F.ceil(F.col("count") / TILE)))
    placed = kept(rows.join(size, ["path", "unit"]).select("path", "id", "unit", own.alias("own"), stripe.alias("stripe")), "placed")
    stripes = placed.select("path", "stripe", "own").distinct()
    a, b = (stripes.select("path", F.col("stripe").alias(k), F.col("own").alias(f"own_{k}")) for k in "ij")
    pairs = a.join(b, "path").filter((F.col("i") <= F.col("j")) & ~F.coalesce(F.col("own_i") == F.col("own_j"), F.lit(False)))
    side = lambda k, n: pairs.select("path", F.col(k).alias("stripe"), "i", "j", F.lit(n).alias("side"))
    meet = side("i", 0).union(side("j", 1).filter("i < j"))
    sent = placed.select("path", "id", "unit", "stripe").join(meet, ["path", "stripe"]).select("path", "i", "j", "side", "id", "unit")
    keys = ["path", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            sig, units, of = _tokens(table.column("sig").combine_chunks()), table.column("unit").to_numpy(), table.column("side").to_numpy()
            if table.column("i")[0] == table.column("j")[0]:
                one, two = unit_forest(units, _agreement(sig, sig) >= LOOSE * SAMPLED)
            else:
                one, two = forest_between(units[of == 0], units[of == 1], _agreement(sig[of == 0], sig[of == 1]) >= LOOSE * SAMPLED)
                apart = np.unique(np.stack([one, two])[:, one != two], axis=1)
                one, two = apart[0], apart[1]
            if len(one):
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=["a", "b"])
        given_back()

    full = sent.join(sig, "id").select(*keys, "side", "unit", "sig")
    return full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _shared(level: DataFrame) -> DataFrame:
    """Rows of the paths that hold sets of several units, with the number of sets on the path."""
    size = level.groupBy("path").agg(F.count(F.lit(1)).alias("count"), F.min("unit").alias("_low"), F.max("unit").alias("_high"))
    return level.join(size.filter("_low <> _high").select("path", "count"), "path")


def loose_edges(sets: DataFrame, *, runs_: int = RUNS, branching: float = BRANCHING, depth: int = DEPTH, first: int = 0) -> DataFrame:
    """Edges between units of sets ``(id, unit, sig)`` that share a chosen path and agree on most sampled tokens.

    One run more goes ahead, its paths cut into chunks by a hash, and what it joins is contracted before the others follow:
    those then only tell what joins groups, so the component search gets a few edges for a set however many runs there are.
    """
    ahead = _chunked(_shared(kept(_start(sets, 1, branching, AHEAD + first), "paths")))
    found = kept(_compare_paths(ahead.join(sets.select("id", "sig"), "id")).distinct(), "edges")
    units = kept(contracted(sets.select("id", F.col("unit").alias("a"), "unit", "sig"), found), "units")
    star = units.filter("a <> unit").select("a", F.col("unit").alias("b")).distinct()
    return star.union(_edges_of_runs(units, runs_, branching, depth, first))


def _chunked(shared: DataFrame) -> DataFrame:
    """``path, id, unit`` with paths of more than ``CHUNK`` sets cut into chunks."""
    chunks = F.ceil(F.col("count") / CHUNK)
    return shared.select(F.when(chunks > 1, F.xxhash64("path", F.pmod(F.xxhash64("id", "path"), chunks))).otherwise(F.col("path")).alias("path"), "id", "unit")


def _edges_of_runs(sets: DataFrame, runs_: int, branching: float, depth: int, first: int) -> DataFrame:
    """Edges that ``runs_`` runs find between units, each path given as a forest.

    A pair of similarity 0.8 shares no first choice in one run with probability exp(-0.8 * ``branching``), about 0.2;
    ``runs_`` runs miss fewer than three pairs in a million while the paths are not crowded. On a crowded path a shared
    choice is kept with probability 1 - exp(-1) a level: a pair all of whose paths are crowded is missed by about three
    in ten thousand, however many sets are there. Paths still longer than ``CHUNK`` on the last level are compared in
    chunks cut by a hash, which links the large groups, then whole between the groups; that is quadratic in their sets.
    A path that holds one unit only has nothing to add and is left out.
    """
    sig = sets.select("id", "sig")
    level = kept(_start(sets, runs_, branching, first), "paths")
    found = []
    for step in range(depth):
        last = step == depth - 1
        shared = kept(_shared(level), "shared") if last else _shared(level)
        few = _chunked(shared if last else shared.filter(F.col("count") <= SMALL))
        found.append(kept(_compare_paths(few.join(sig, "id")).distinct(), "edges"))
        if last:
            break
        many = shared.filter(F.col("count") > SMALL)
        level = kept(_deeper(many.join(sig, "id"), DEEPER).distinct(), "paths")
    edges = found[0]
    for e in found[1:]:
        edges = edges.union(e)
    crowded = shared.filter(F.col("count") > CHUNK)
    if crowded.isEmpty():
        return edges
    crowded = kept(contracted(crowded, edges), "crowded")
    return edges.union(kept(_compare_tiles(crowded, sig).distinct(), "edges"))


def contracted(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with every unit replaced by the smallest that ``edges`` joins it to."""
    joined = component_of(edges, "whole").withColumnRenamed("id", "unit")
    return rows.join(joined, "unit", "left").withColumn("unit", F.coalesce("whole", "unit")).drop("whole")


def _probes(sets: DataFrame, probes: int) -> DataFrame:
    """Hash-chosen sets ``(id)`` of those that share a band of samples with another set, so that most have a partner.

    The bands do not depend on the paths that the runs choose.
    """
    bands = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.substring("sig", 1 + 4 * BAND * k, 4 * BAND).alias("band")) for k in range(BANDS)]))
    shared = sets.select("id", bands.alias("b")).groupBy("b").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z")
    return shared.select(F.explode(F.array("a", "z")).alias("id")).distinct().orderBy(F.xxhash64("id", F.lit(53)), "id").limit(probes)


def recall(sets: DataFrame, *, threshold: float = THRESHOLD, probes: int = PROBES) -> tuple[float, int]:
    """Share of the pairs of probes with any set that stand in one unit, and the number of probes that have a partner.

    ``sets`` is ``(id, unit, sig)``. Pairs are those whose samples agree to ``threshold`` less ``MARGIN``, which the samples of
    nearly all pairs of that similarity do. Every probe with a partner weighs the same; without any the share is 1.
    """
    chosen = sets.select("id", "unit", "sig").join(F.broadcast(_probes(sets, probes)), "id").toArrow()
    if not chosen.num_rows:
        return 1.0, 0
    ids, groups, own = chosen.column("id").to_numpy(), chosen.column("unit").to_numpy(), _tokens(chosen.column("sig").combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true, held = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                close = _agreement(own, _tokens(part.column("sig"))) >= (threshold - MARGIN) * SAMPLED
                close &= ids[:, None] != part.column("id").to_numpy()[None]
                true += close.sum(axis=1)
                held += (close & (groups[:, None] == part.column("unit").to_numpy()[None])).sum(axis=1)
        some = true > 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(true[some]), pa.array(held[some])], names=["id", "true", "held"])

    counted = sets.select("id", "unit", "sig").mapInArrow(run, "id long, true long, held long").groupBy("id").agg((F.sum("held") / F.sum("true")).alias("share"))
    share, partnered = counted.agg(F.avg("share"), F.count(F.lit(1))).first()
    return (1.0 if share is None else share), partnered


def loose_groups(sets: DataFrame, *, threshold: float, runs_: int) -> DataFrame:
    """``id, loose`` for the sets that share a group with others, from as many runs as the audit asks for."""
    units = kept(sets.select("id", F.col("id").alias("unit"), "sig"), "units")
    for attempt in range(ATTEMPTS):
        units = kept(contracted(units, loose_edges(units, runs_=runs_, first=attempt * runs_)), "units")
        found, _ = recall(units, threshold=threshold)
        if found >= TARGET:
            several = units.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("unit")
            return units.select("id", "unit").join(several, "unit").select("id", F.col("unit").alias("loose"))
    raise RuntimeError(f"{ATTEMPTS * runs_} runs bring {found:.4f} of the audited pairs together, {TARGET} are asked for")


def _common(left: np.ndarray, right: np.ndarray, of_left: np.ndarray, of_right: np.ndarray, n: int, m: int) -> np.ndarray:
    """Number of tokens that each row of one block shares with each row of the other.

    Tokens that occur in both blocks become bits, ``BLOCK`` of them at a time, and the counts are added up.
    """
    token = np.intersect1d(np.unique(left), np.unique(right), assume_unique=True)
    out = np.zeros((n, m), dtype=np.int32)
    if not len(token):
        return out

    def shared(tokens: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(token, tokens), len(token) - 1)
        some = np.flatnonzero(token[place] == tokens)
        order = some[np.argsort(place[some], kind="stable")]
        return place[order].astype(np.int32), of[order].astype(np.int32)

    sides = [shared(left, of_left), shared(right, of_right)]
    for at in range(0, len(token), BLOCK):
        width = -(-min(BLOCK, len(token) - at) // 64) * 8
        bits = []
        for (place, of), rows in zip(sides, (n, m)):
            a, b = np.searchsorted(place, [at, at + BLOCK])
            c, r = place[a:b] - at, of[a:b]
            flat = np.zeros((rows, width), dtype=np.uint8)
            np.bitwise_or.at(flat, (r, c >> 3), np.uint8(1) << (c & 7).astype(np.uint8))
            bits.append(flat.view(np.uint64))
        step = max(1, (1 << 20) // max(1, bits[1].size))
        for k in range(0, n, step):
            out[k:k + step] += np.bitwise_count(bits[0][k:k + step, None, :] & bits[1][None]).sum(axis=2, dtype=np.int32)
    return out


def _linked(common: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Where the Jaccard similarity reaches the threshold, some rows at a time."""
    out = np.empty(common.shape, dtype=bool)
    for k in range(0, len(common), 256):
        some = common[k:k + 256]
        out[k:k + 256] = some >= threshold * (na[k:k + 256, None] + nb[None] - some) - 1e-9
    return out


def _exact(threshold: float):
    """Links of two stripes on whole sets: weights per id, and a forest."""

    def flat(table: pa.Table) -> tuple[np.ndarray, ...]:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("tokens").to_pylist()]
        n = np.array([len(x) for x in sets])
        return np.concatenate(sets), np.repeat(np.arange(len(n)), n), n, table.column("id").to_numpy(), table.column("copies").to_numpy()

    def compare(left: pa.Table, right: pa.Table | None) -> Iterator[pa.RecordBatch]:
        a, of_a, na, ida, ca = flat(left)
        b, of_b, nb, idb, cb = flat(right) if right is not None else (a, of_a, na, ida, ca)
        linked = _linked(_common(a, b, of_a, of_b, len(na), len(nb)), na, nb, threshold)
        if right is None:
            np.fill_diagonal(linked, False)
            edge = forest(ida, linked)
            weight = (ida, linked @ cb)
        else:
            edge = forest_between(ida, idb, linked)
            weight = (np.concatenate([ida, idb]), np.concatenate([linked @ cb, ca @ linked]))
        some = weight[1] > 0
        one, two = np.concatenate([edge[0], weight[0][some]]), np.concatenate([edge[1], weight[1][some]])
        what = np.r_[np.zeros(len(edge[0]), np.int8), np.ones(int(some.sum()), np.int8)]
        if len(one):
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two.astype(np.int64)), pa.array(what.astype(np.int32))], names=["a", "b", "what"])

    return compare


def _whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """Shingle sets of the texts ``(doc_id, text, loose, copies, n, k1, k2)`` that the sums ``n, k1, k2`` belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                value, first = shingle_sets(part.column("text"), size)
                own = pa.array(np.all([s == part.column(k).to_numpy() for s, k in zip(_sums(value, first), ("n", "k1", "k2"))], axis=0))
                raw = value.tobytes()
                tokens = [raw[8 * a:8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in ("doc_id", "loose", "copies")), pa.array(np.diff(first)), pa.array(tokens, pa.binary())],
                    names=["id", "loose", "copies", "load", "tokens"]).filter(own)

    return docs.mapInArrow(run, "id long, loose long, copies long, load long, tokens binary")


def jaccard_classes(docs: DataFrame, *, threshold: float = THRESHOLD, size: int = SHINGLE, runs_: int = RUNS) -> DataFrame:
    """``doc_id, class_id, n_links, kept`` for every document with an id.

    Two documents are linked if their sets of ``size``-word shingles have Jaccard similarity ``threshold`` or more;
    words are runs of non-blank characters, unchanged. ``n_links`` counts the other linked documents, copies
    included; ``class_id`` is the smallest doc_id reachable over links; the document with that id is kept.
    A text without words links with nothing; one of fewer than ``size`` words is one shingle. Rows with a null id are
    left out; repeated rows of one id are one document (its smallest sketch counts if their texts differ).
    """
    with scratch_scope(docs.sparkSession):
        sketch = kept(_sketch(docs, size).groupBy("doc_id").agg(F.min(F.struct("n", "k1", "k2", "sig")).alias("s")).select("doc_id", "s.*"), "sketch", lasting=True)
        key = ["n", "k1", "k2"]
        grouped = sketch.filter("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "sig")).alias("r"), F.count(F.lit(1)).alias("copies"))
        sets = kept(grouped.select(*key, F.col("r.doc_id").alias("id"), "copies", F.col("r.sig").alias("sig")), "sets")
        loose = loose_groups(sets, threshold=threshold, runs_=runs_).withColumnRenamed("id", "doc_id")
        chosen = kept(loose.join(sets.select(F.col("id").alias("doc_id"), "copies", *key), "doc_id"), "chosen")
        # a shuffle join at every size: what is read again grows with the documents, not with the settings
        texts = docs.select("doc_id", "text").join(chosen.hint("merge"), "doc_id")
        members = kept(_whole_sets(texts, size).dropDuplicates(["id"]), "members").withColumn("load", F.greatest("load", F.lit(-(-STRIPE // ROWS))))
        found = kept(tiled_links(members, "loose", "load", STRIPE, ["copies", "tokens"], _exact(threshold), "a long, b long, what int"), "links")
        classes = component_of(found.filter("what = 0").select("a", "b"), "class_id")
        weight = found.filter("what = 1").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("others"))
        per_set = kept(sets.select(*key, "id", "copies").join(classes, "id", "left").join(weight, "id", "left").select(
            *key, F.coalesce("class_id", "id").alias("class_id"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links")), "classes", lasting=True)
    out = sketch.select("doc_id", *key).join(per_set, key, "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")) \
        .withColumn("kept", F.col("class_id") == F.col("doc_id"))


# The same by comparing every pair that shares a shingle.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a), number AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id, coalesce(k, 0) AS n_links, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM documents LEFT JOIN low ON doc_id = low.a LEFT JOIN number ON doc_id = number.a"""
