"""Substring deduplication: words covered by a run of words that already occurred earlier are removed.

Every run of ``size`` consecutive words is a k-mer, an edge of the token graph whose nodes are the runs one word
shorter. Edges are dealt by their minimizer (the smallest hash of a short run inside the k-mer): successive edges
with one minimizer form a nonbranching stretch inside a document, and such stretches travel as one path row
instead of one row an edge. Per minimizer, in order of source coordinates, equal paths collapse to their first
occurrence and paths that branch are compared edge by edge; the earlier edges of a first occurrence become a
mask. A join on (minimizer, path) glues the repeated paths back to every place where they occur, and the places of a
document meet its text in a second join, where they merge into long spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import kept, slices
from sparkmine.llm.words import U, mix, windows, words

SIZE, ANCHOR = 20, 6
SLICE = 1 << 20
#: paths that a task gathers before it collapses equal ones and passes them on
GATHERED = 200_000
PATH = "m long, h long, doc_id long, a int, n int"


def _paths(part: pa.RecordBatch, size: int) -> dict[str, np.ndarray]:
    """Path rows of a slice: stretches of k-mers that share an anchor."""
    w = words(part.column("text"))
    place, edge = windows(w, size)
    ids = part.column("doc_id").to_numpy(zero_copy_only=False)
    if not len(place):
        none = np.zeros(0, dtype=np.int64)
        return {"m": none, "h": none, "doc": none, "a": none, "n": none, "from": none, "edges": edge}
    span = size - ANCHOR + 1
    at, short = windows(w, ANCHOR)
    anchor = np.full(len(w.hash), np.iinfo(np.uint64).max, dtype=U)
    anchor[at] = short
    low = place + np.lib.stride_tricks.sliding_window_view(anchor, span)[place].argmin(axis=1)
    new = np.r_[True, (low[1:] != low[:-1]) | (place[1:] != place[:-1] + 1)]
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(place)])
    head, tail = edge[first], edge[first + n - 1]
    return {
        "m": anchor[low[first]].view(np.int64), "h": mix(head + mix(tail + n.astype(U))).view(np.int64),
        "doc": ids[w.doc[place[first]]], "a": place[first] - w.first[w.doc[place[first]]], "n": n, "from": first, "edges": edge,
    }


def _occurrences(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                p = _paths(part, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p["m"]), pa.array(p["h"]), pa.array(p["doc"]), pa.array(p["a"].astype(np.int32)), pa.array(p["n"].astype(np.int32))],
                    names=["m", "h", "doc_id", "a", "n"])

    return docs.mapInArrow(run, PATH)


def _collapsed(docs: DataFrame, size: int) -> DataFrame:
    """Paths with their edges; equal paths of a task are one row, at their first place, with their number."""

    def collapse(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        m, h, doc, a, n = (np.concatenate([p[k] for p in held]) for k in ("m", "h", "doc", "a", "n"))
        base = np.cumsum([0] + [len(p["edges"]) for p in held[:-1]])
        start = np.concatenate([p["from"] + b for p, b in zip(held, base)])
        edges = np.concatenate([p["edges"] for p in held])
        order = np.lexsort((a, doc, h, m))
        top = np.flatnonzero(np.r_[True, (np.diff(m[order]) != 0) | (np.diff(h[order]) != 0)]) if len(order) else order
        count = np.diff(np.r_[top, len(order)])
        pick = order[top]
        n = n[pick]
        flat = np.repeat(start[pick], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ends = np.r_[0, np.cumsum(n) * 8].astype(np.int32)
        ws = pa.Array.from_buffers(pa.binary(), len(pick), [None, pa.py_buffer(ends), pa.py_buffer(edges[flat].tobytes())])
        return pa.RecordBatch.from_arrays(
            [pa.array(m[pick]), pa.array(h[pick]), pa.array(doc[pick]), pa.array(a[pick].astype(np.int32)), pa.array(count.astype(np.int32)), ws],
            names=["m", "h", "doc_id", "a", "copies", "edges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                held.append(_paths(part, size))
                rows += len(held[-1]["m"])
                if rows >= GATHERED:
                    yield collapse(held)
                    held, rows = [], 0
        if held:
            yield collapse(held)

    return docs.mapInArrow(run, "m long, h long, doc_id long, a int, copies int, edges binary")


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of minimizer and place: for every repeated or branching path its first place and a mask.

    Bit ``j`` of the mask says that edge ``j`` of the first occurrence occurred earlier, in another path. Of an
    unfinished minimizer only the hashes of the edges and paths seen so far are held.
    """
    open_m, seen_edges, seen_paths = None, np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        m, h, doc, a, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("m", "h", "doc_id", "a", "copies"))
        ws = batch.column("edges")
        at = np.frombuffer(ws.buffers()[1], dtype=np.int32, count=len(ws) + 1 + ws.offset)[ws.offset:].astype(np.int64)
        edge = np.frombuffer(ws.buffers()[2], dtype=np.uint8)[at[0]:at[-1]].view(U)
        n = np.diff(at) // 8
        if m[0] != open_m:
            seen_edges, seen_paths = seen_edges[:0], seen_paths[:0]
        group = np.cumsum(np.r_[True, m[1:] != m[:-1]]) - 1
        goes_on = group == 0 if m[0] == open_m else np.zeros(len(m), dtype=bool)
        order = np.lexsort((np.arange(len(m)), h, m))
        top = np.r_[True, (np.diff(m[order]) != 0) | (np.diff(h[order]) != 0)]
        total = np.add.reduceat(copies[order], np.flatnonzero(top))
        rep = order[top]
        known = goes_on[rep] & np.isin(h[rep], seen_paths)
        rep, total = rep[~known], total[~known]
        back = np.argsort(rep)
        rep, total = rep[back], total[back]
        several = np.bincount(group[rep], minlength=group[-1] + 1)[group[rep]] > 1
        branching = rep[several | goes_on[rep]]
        mask = np.zeros(len(m), dtype=np.int64)
        if len(branching):
            k = n[branching]
            j = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            flat = edge[np.repeat((at[:-1] - at[0])[branching] // 8, k) + j]
            _, first = np.unique(flat, return_index=True)
            again = np.ones(len(flat), dtype=bool)
            again[first] = False
            if len(seen_edges):
                again |= np.isin(flat, seen_edges)
            np.add.at(mask, np.repeat(branching, k), np.where(again, np.int64(1) << j, 0))
        last = group == group[-1]
        tell = (total > 1) | (mask[rep] != 0) | last[rep]
        out = rep[tell]
        tail = np.flatnonzero(last)
        add_edges, add_paths = edge[(at[tail[0]] - at[0]) // 8:], h[tail]
        if m[-1] == open_m:
            add_edges, add_paths = np.concatenate([seen_edges, add_edges]), np.concatenate([seen_paths, add_paths])
        open_m, seen_edges, seen_paths = m[-1], np.unique(add_edges), np.unique(add_paths)
        yield pa.RecordBatch.from_arrays(
            [pa.array(m[out]), pa.array(h[out]), pa.array(doc[out]), pa.array(a[out]), pa.array(mask[out])],
            names=["m", "h", "first_doc", "first_a", "mask"])


def repeated_places(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """Stretches of repeated k-mers: ``doc_id, a, bits, source_doc, source_a``.

    Bit ``j`` marks the k-mer that starts at word ``a + j``; the source is the first place of the path.
    """
    if not ANCHOR < size <= ANCHOR + 60:
        raise ValueError("size out of range")
    usable = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    ordered = _collapsed(usable, size).repartition("m").sortWithinPartitions("m", "doc_id", "a")
    found = kept(ordered.mapInArrow(_resolve, "m long, h long, first_doc long, first_a int, mask long"), "paths")
    every = F.expr("shiftleft(1L, n) - 1")
    first = (F.col("doc_id") == F.col("first_doc")) & (F.col("a") == F.col("first_a"))
    return _occurrences(usable, size).join(found, ["m", "h"]).select(
        "doc_id", "a", F.when(first, F.col("mask")).otherwise(every).alias("bits"),
        F.col("first_doc").alias("source_doc"), F.col("first_a").alias("source_a")).filter("bits <> 0")


def remove_repeats(docs: DataFrame, *, size: int = SIZE, text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, with ``text``, the kept words joined by one space.

    Words are runs of anything but ASCII white space, unchanged. A word goes if some window of ``size`` words that
    covers it also starts earlier: in a smaller doc_id, or in the same document. Windows are judged on the input.
    A null or empty text has no words; one shorter than ``size`` words loses none. A repeated doc_id counts as one
    document and gets one row for each input row; a null doc_id neither repeats others nor is repeated.
    """
    with scratch_scope(docs.sparkSession):
        spots = repeated_places(docs, size=size).groupBy("doc_id").agg(F.collect_list(F.struct("a", "bits")).alias("places"))
        places = kept(spots, "places", lasting=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for raw, spots in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("places").to_pylist()):
                    all_words = (raw or b"").split()
                    left = all_words
                    if spots and all_words:
                        turn = np.zeros(len(all_words) + 1, dtype=np.int64)
                        start = np.array([s["a"] for s in spots])
                        bits = np.array([s["bits"] for s in spots])
                        hit = (bits[:, None] >> np.arange(size - ANCHOR + 1)) & 1
                        row, j = np.nonzero(hit)
                        np.add.at(turn, start[row] + j, 1)
                        np.add.at(turn, start[row] + j + size, -1)
                        gone = np.cumsum(turn)[:-1] > 0
                        left = [x for x, g in zip(all_words, gone.tolist()) if not g]
                    joined = b" ".join(left)
                    rows.append((len(all_words), len(all_words) - len(left), hashlib.sha256(joined).hexdigest(), joined))
                out = [part.column("doc_id")] + [pa.array([r[k] for r in rows], type=t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if text:
                    out.append(pa.array([r[3] for r in rows], type=pa.binary()).cast(pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if text else "")
    return docs.select("doc_id", "text").join(places, "doc_id", "left").mapInArrow(run, schema)


# The same rule in plain SQL.
SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, row_number() OVER (PARTITION BY list_slice(ws, i, i + 19) ORDER BY doc_id, i) AS rn
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS ps FROM win WHERE rn > 1 GROUP BY doc_id),
left_over AS (SELECT w.doc_id, ws, CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END AS keep
  FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(keep) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(keep, ' '), '')) AS kept_sha256 FROM left_over"""
