"""Importance resampling towards a target distribution: hashed n-gram weights, then ranks by regular sampling.

Counts of hashed features over all documents and all target texts give one gain a bucket; a document's weight is the
sum of the gains of its features, and noise hashed from its id turns the weights into a draw without replacement. The
ranks come from a parallel sort: each task sorts its rows and hands in regular samples, the samples give splitters,
counts between splitters give the rank of every segment's first row, and only segments that reach into the draw are
exchanged and merged.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import kept, slices

BUCKETS, LONGEST = 10_000, 3
SHARE, LEAST = 5, 20
SLICE = 1 << 20
#: words up to this length are hashed side by side, longer ones one by one
SHORT = 64
#: rows a task sorts at a time, rows of a segment, and most regular samples that reach the driver (as many segments / 8)
RUN, SEGMENT, SAMPLES = 1 << 20, 8192, 1 << 16

U32 = np.uint32
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
ONES = U32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    r = np.arange(256, dtype=U32)
    for _ in range(8):
        r = (r >> U32(1)) ^ np.where(r & U32(1), U32(0xEDB88320), U32(0))
    return r


BYTE = _byte_table()


@lru_cache(maxsize=1)
def _zeros() -> tuple[np.ndarray, np.ndarray]:
    """What up to ``SHORT + 1`` zero bytes, and 2 ** k of them, make of each byte of a register: ``(count, place, byte)``."""
    one = np.array([[i << 8 * p for i in range(256)] for p in range(4)], dtype=U32)
    short = [one]
    for _ in range(SHORT + 1):
        short.append(BYTE[short[-1] & U32(255)] ^ (short[-1] >> U32(8)))
    powers = [short[1]]
    for _ in range(31):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.array(short), np.array(powers)


def _apply(table: np.ndarray, r: np.ndarray) -> np.ndarray:
    return table[0][r & U32(255)] ^ table[1][(r >> U32(8)) & U32(255)] ^ table[2][(r >> U32(16)) & U32(255)] ^ table[3][r >> U32(24)]


def followed(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``r`` after ``n`` more zero bytes."""
    short, powers = _zeros()
    few = np.minimum(n, SHORT + 1)
    out = short[few, 0, r & U32(255)] ^ short[few, 1, (r >> U32(8)) & U32(255)] ^ short[few, 2, (r >> U32(16)) & U32(255)] ^ short[few, 3, r >> U32(24)]
    many = np.flatnonzero(n > SHORT + 1)
    if len(many):
        left, value = n[many], r[many]
        for k in range(int(left.max()).bit_length()):
            value = np.where(left >> k & 1, _apply(powers[k], value), value)
        out[many] = value
    return out


class Words(NamedTuple):
    register: np.ndarray  # of each word's bytes, from zero
    length: np.ndarray
    doc: np.ndarray
    count: np.ndarray     # words of each text


def words(texts: pa.Array) -> Words:
    """Words of every text with the checksum registers of their bytes, A-Z in lower case; a null text has none."""
    texts = texts.fill_null("") if texts.null_count else texts
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1 + texts.offset)[texts.offset:].astype(np.int64)
    raw = texts.buffers()[2]
    data = LOWER[np.frombuffer(raw, dtype=np.uint8)[at[0]:at[-1]]] if raw is not None else np.zeros(0, dtype=np.uint8)
    at = at - at[0]
    solid = WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    start = np.flatnonzero(solid & (~np.r_[False, solid[:-1]] | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(solid & (~np.r_[solid[1:], False] | edge[1:])) + 1 if len(data) else start
    length = end - start
    register = np.zeros(len(start), dtype=U32)
    order = np.argsort(-np.minimum(length, SHORT + 1), kind="stable")
    longer = np.searchsorted(-np.minimum(length, SHORT + 1)[order], -np.arange(SHORT + 1), side="left")  # words longer than k
    long = int(longer[SHORT])
    for k in range(SHORT):
        some = order[long:longer[k]]
        if not len(some):
            break
        r = register[some]
        register[some] = BYTE[(r ^ data[start[some] + k]) & U32(255)] ^ (r >> U32(8))
    for k in order[:long].tolist():
        register[k] = zlib.crc32(data[start[k]:end[k]].tobytes()) ^ 0xFFFFFFFF
    if long:
        some = order[:long]
        register[some] ^= followed(np.full(long, ONES), length[some])
    first = np.searchsorted(start, at)
    return Words(register, length, np.searchsorted(at, start, side="right") - 1, np.diff(first))


def features(w: Words, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of one, two and three words: the bucket of each run, and the text it is in."""
    blank = followed(np.full(len(w.length), BYTE[32]), w.length) ^ w.register  # a blank and the word
    run, size, n = w.register, w.length, len(w.length)
    for k in range(1, LONGEST + 1):
        inside = np.flatnonzero(w.doc[k - 1:] == w.doc[:max(n - k + 1, 0)])
        value = run[inside] ^ followed(np.full(len(inside), ONES), size[inside]) ^ ONES
        yield (value % U32(buckets)).astype(np.int64), w.doc[k - 1:][inside]
        run, size = followed(run[:-1], w.length[k:] + 1) ^ blank[k:], size[:-1] + 1 + w.length[k:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; each task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for bucket, _ in features(words(part.column("text")), buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: 1000 times the logarithm of its smoothed share in the target over that in the source, rounded down."""
    n = len(source)
    above, below = (target + 1.0) * (source.sum() + n), (source + 1.0) * (target.sum() + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def noise(ids: list, seed: int) -> np.ndarray:
    """Hashed noise of each id, so that the highest sums are a draw without replacement; a null id hashes as an empty one."""
    h = np.array([int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16) for k in ids], dtype=float)
    return np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)


def scored(docs: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w, n = words(part.column("text")), part.num_rows
                number, weight = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                for bucket, doc in features(w, len(gain)):
                    number += np.bincount(doc, minlength=n)
                    weight += np.bincount(doc, gain[bucket], n).astype(np.int64)  # whole numbers far below 2 ** 53
                score = weight + noise(part.column("doc_id").to_pylist(), seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c) for c in (w.count.astype(np.int64), number, weight, score))],
                    names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


#: columns that order the rows: highest score, then smallest doc_id, one without doc_id last; rows equal in all are the same row
KEY = ("down", "unnamed", "id", "n_features")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select((-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("id"), "n_features")


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY])


def _sorted(keys: np.ndarray) -> np.ndarray:
    return keys[:, np.lexsort(keys[::-1])]


def segments(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Number of the segment of each key: how many splitters are not behind it."""
    both = np.concatenate([splitters, keys], axis=1)
    mark = np.r_[np.zeros(splitters.shape[1], np.int64), np.ones(keys.shape[1], np.int64)]
    order = np.lexsort((mark, *both[::-1]))  # a splitter stands before the keys that equal it
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(mark[order] == 0)
    return out[splitters.shape[1]:]


def regular_samples(rows: DataFrame, stride: int) -> np.ndarray:
    """Every ``stride``-th key of each locally sorted run, all runs sorted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        some = 0

        def told() -> pa.RecordBatch:
            ordered = _sorted(np.concatenate(held, axis=1))[:, stride // 2::stride]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in ordered], names=list(KEY))

        for batch in batches:
            held.append(_keys(batch))
            some += batch.num_rows
            if some >= RUN:
                yield told()
                held, some = [], 0
        if some:
            yield told()

    found = _keyed(rows).mapInArrow(run, ", ".join(f"{c} long" for c in KEY)).toArrow()
    return _sorted(np.stack([found.column(c).to_numpy() for c in KEY]))


def _segment_counts(rows: DataFrame, splitters: np.ndarray) -> np.ndarray:
    size = splitters.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(segments(_keys(batch), splitters), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["segment", "n"])

    found = _keyed(rows).mapInArrow(run, "segment long, n long").groupBy("segment").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[found.column("segment").to_numpy()] = found.column("n").to_numpy()
    return out


def _before(splitter: np.ndarray) -> Column:
    """Whether a row stands before the splitter in the order of ``KEY``."""
    own = ((-F.col("score")), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("n_features"))
    out = F.lit(False)
    for column, value in reversed(list(zip(own, splitter.tolist()))):
        out = (column < value) | ((column == value) & out)
    return out


def _ranked(rows: DataFrame, splitters: np.ndarray, offsets: np.ndarray, drawn: int, parts: int) -> DataFrame:
    """Exchange the rows to their segments, merge each, and number them on from the segment's offset."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(segments(_keys(batch), splitters)), *(batch.column(c) for c in names)], names=["segment", *names])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, done = -1, 0
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            for k in np.unique(segment):
                if k != at:
                    at, done = int(k), 0
                some = batch.filter(pa.array(segment == k))
                rank = offsets[at] + done + np.arange(1, some.num_rows + 1)
                done += some.num_rows
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in names), pa.array(rank, mask=rank > drawn)], names=[*names, "rank"])

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    keyed = rows.select("*", *(c.alias(k) for c, k in zip(((-F.col("score")), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0))), KEY)))
    dealt = keyed.mapInArrow(place, f"segment long, {schema}").repartitionById(parts, F.col("segment").cast("int"))
    return dealt.sortWithinPartitions("segment", F.desc("score"), F.asc_nulls_last("doc_id"), "n_features").mapInArrow(number, f"{schema}, rank long")


def resample(docs: DataFrame, target: DataFrame, *, share: int = SHARE, least: int = LEAST, buckets: int = BUCKETS, seed: int = 42,
             segment: int = SEGMENT, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``.

    ``share`` per cent (rounded down) of the documents with ``least`` words or more are drawn: those with the highest
    scores, ties to the smaller doc_id; ``rank`` counts them from 1 and is null for all others. A null or empty text has no
    words, weight 0 and is never drawn. A null doc_id hashes as an empty one and comes last among ties; rows that
    repeat a doc_id are scored and ranked one by one. An empty target gives gains all the same, by the smoothing; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    with scratch_scope(spark):
        told = kept(scored(docs, gain, seed), "scored", lasting=True)
        able = told.filter(F.col("n_words") >= least)
        n = able.count()
        drawn = share * n // 100
        if not drawn:
            return told.withColumn("rank", F.lit(None).cast("long"))
        found = regular_samples(able, max(1, n // samples))
        parts = int(max(1, min(-(-n // segment), samples // 8, found.shape[1])))
        splitters = found[:, (np.arange(1, parts) * found.shape[1]) // parts]
        sizes = _segment_counts(able, splitters)
        offsets = np.r_[0, np.cumsum(sizes)[:-1]]
        reach = int(np.searchsorted(offsets, drawn, side="left"))  # segments that begin inside the draw
    inside = F.col("n_words") >= least
    if reach < parts:
        inside &= _before(splitters[:, reach - 1])
    ranked = _ranked(told.filter(inside), splitters, offsets, drawn, reach)
    return ranked.unionByName(told.filter(~inside).withColumn("rank", F.lit(None).cast("long")))
