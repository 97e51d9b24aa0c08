"""How five quality filters interact: what each removes at each step of every order, and its Shapley value.

A document is reduced to the set of filters that it fails, so a part (a source) is at most 32 counts. Over these the
removal game is laid out: a coalition of filters is worth the documents that at least one of its members removes. The
Hart-Mas-Colell potential of every coalition follows from the potentials of the coalitions with one filter less; the
Shapley value of a filter is the potential of all five less the potential without it, and a step of an order is a
difference of two coalitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import kept

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
ORDERS = factorial(len(FILTERS))
#: parts whose rows are made at once (600 rows each)
PARTS = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, key``: the filters A to D that a text fails, as bits, and the digest of the text."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), "")
    told = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("_t")).withColumn("_w", words)
    fails = (
        F.size("_w") < 200,
        F.size(F.array_distinct("_w")) * 100 < F.size("_w") * 50,
        F.length(F.regexp_replace("_t", "[^A-Z]+", "")) * 100 > F.length("_t") * 2,
        F.col("_t").rlike("[#$%&*|]"),
    )
    mask = sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))
    return told.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("_t").cast("binary"), 256)).alias("key"))


def coalitions(counts: np.ndarray) -> np.ndarray:
    """Worth of every coalition for each row of counts by failure set: what at least one member removes."""
    sets = np.arange(COALITIONS)
    return counts @ ((sets[:, None] & sets[None]) != 0).astype(np.int64)


def potentials(worth: np.ndarray) -> np.ndarray:
    """The potentials, times the number of orders: P(S) = (v(S) + the sum of P(S without i)) / size of S, from small to large."""
    p = np.zeros_like(worth)
    for s in range(1, COALITIONS):
        members = [1 << k for k in range(len(FILTERS)) if s >> k & 1]
        p[:, s] = (ORDERS * worth[:, s] + sum(p[:, s ^ m] for m in members)) // len(members)  # 60 P(S) is a whole number
    return p


def audit(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[str, int, dict[str, np.ndarray]]]:
    """Every order and step with its measures, for parts given by their counts by failure set."""
    worth, lost_good, lost_toxic = coalitions(n), coalitions(good), coalitions(toxic)
    total, full = n.sum(axis=1), COALITIONS - 1
    p = potentials(worth)
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, start=1):
            own, after = 1 << k, before | 1 << k
            removed = worth[:, after] - worth[:, before]
            yield "".join(FILTERS[i] for i in order), step, {
                "kept": total - worth[:, after], "removed": removed, "redundant": worth[:, own] - removed,
                "unique_fails": worth[:, full] - worth[:, full ^ own], "good_lost": lost_good[:, after] - lost_good[:, before],
                "toxic_lost": lost_toxic[:, after] - lost_toxic[:, before], "shapley": p[:, full] - p[:, full ^ own]}
            before = after


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PARTS):
            some = batch.slice(at, PARTS)
            counts = np.zeros((3, some.num_rows, COALITIONS), dtype=np.int64)
            for i, cells in enumerate(some.column("cells").to_pylist()):
                for c in cells:
                    counts[:, i, c["mask"]] += c["n"], c["good"], c["toxic"]
            told = list(audit(*counts))
            size = some.num_rows
            columns = [
                pa.concat_arrays([some.column("part")] * len(told)), pa.array(np.repeat([o for o, _, _ in told], size)),
                pa.array(np.repeat(np.array([s for _, s, _ in told], dtype=np.int32), size))]
            columns += [pa.array(np.concatenate([m[name] for _, _, m in told])) for name in MEASURES]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and seven counts: one row per source, each of the 120 orders and each of its five steps.

    A: under 200 words; B: under half of the words distinct; C: over 2 % of the characters in A-Z; D: holds one of
    ``#$%&*|``; E: some row with a smaller doc_id has the same text. A null text is an empty one and equal to it; a null
    source is the empty string. A row without doc_id neither makes another row fail E nor fails it; rows that repeat a doc_id are
    counted one by one and not against each other. A document counts as good (toxic) if any of its label rows says
    so. An empty table gives no rows. Any column beside those named is ignored.
    """
    with scratch_scope(docs.sparkSession):
        rows = kept(failures(docs), "failures")
        # E by a join on (text, first doc_id): no key has more rows than one doc_id has, however many copies a text has
        first = rows.filter("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        marked = labels.filter("doc_id is not null").groupBy("doc_id").agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        copied = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
        told = rows.join(first, ["key", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + copied).alias("mask")).join(marked, "doc_id", "left")
        count = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
        cells = kept(told.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count("good"), count("toxic")), "cells", lasting=True)
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    return per_part.mapInArrow(_rows, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
marked AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CAST(len(ws) < 200 AS INT)
    + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(low < w.doc_id, false) AS INT) AS mask
  FROM w LEFT JOIN marked ON w.doc_id = marked.doc_id),
c AS MATERIALIZED (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
orders AS (SELECT '' AS o UNION ALL SELECT o || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE strpos(o, l) = 0),
steps AS (SELECT o, k AS step, CAST(1 << (ascii(o[k]) - 65) AS INT) AS own,
    CAST(list_sum(list_transform(range(1, k), lambda i: 1 << (ascii(o[i]) - 65))) AS INT) AS before
  FROM orders, range(1, 6) r(k) WHERE length(o) = 5),
told AS (SELECT part, o AS filter_order, step, own,
    sum(n) FILTER (mask & (coalesce(before, 0) | own) = 0) AS kept, sum(n) FILTER (mask & coalesce(before, 0) = 0 AND mask & own <> 0) AS removed,
    sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND mask & own <> 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER (mask & coalesce(before, 0) = 0 AND mask & own <> 0) AS good_lost,
    sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND mask & own <> 0) AS toxic_lost
  FROM c, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM told"""
