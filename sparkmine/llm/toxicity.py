"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are the density of insults from a fixed list and from a lexicon learned on labelled texts (words and
word beginnings), their nearness to second-person words, capitals, punctuation and obfuscation. All texts are read
once for the features; trees and calibration are fitted on a bounded labelled sample in numpy.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scoped
from sparkmine.llm.common import held_out, kept, slices

#: bounds of the labelled samples: texts read for the lexicon, rows that fit trees and calibration
LEXICON_TEXTS, TRAIN_ROWS, LEXICON_SIZE = 12_000, 40_000, 400
STEMS = (4, 5, 6)
INSULTS = frozenset((
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown fool fools imbecile "
    "jerk creep pig filthy vermin freak liar coward bastard bitch whore slut damn hell crap shit fuck fucking asshole dick hate kill die").split())
SECOND = frozenset("you your yours youre yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tus ti usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"[^\s]+")
EDGE = re.compile(r"^\W+|\W+$")
N_FEATURES = 14


def _plain(word: str) -> str:
    return EDGE.sub("", word.lower())


@scoped
def lexicon(docs: DataFrame, labels: DataFrame, *, texts: int = LEXICON_TEXTS) -> dict[str, float]:
    """Words and word beginnings (``stem*``) that mark toxic texts, from at most ``texts`` labelled ones chosen by hash."""
    labelled = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = labelled.count()
    if not n:
        return {}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.filter(draw < min(1.0, texts / n)).orderBy(F.xxhash64("doc_id", F.lit(21)), "doc_id").limit(texts)
    sample = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {p for w in set(text.split()) if (p := _plain(w)) and len(p) > 2}
                found |= {p[:k] + "*" for p in found for k in STEMS if len(p) >= k}
                seen[int(toxic > 0)].update(found)
                seen[int(toxic > 0)][""] += 1
        for k, c in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string()), pa.array([k] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], names=["token", "toxic", "n"])

    counts = sample.mapInArrow(run, "token string, toxic int, n long").groupBy("token").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("good"))
    counts = kept(counts, "tokens")
    total = counts.filter("token = ''").first()
    if total is None or not total["bad"] or not total["good"]:
        return {}
    ratio = F.log(((F.col("bad") + 0.5) / (total["bad"] + 1.0)) / ((F.col("good") + 0.5) / (total["good"] + 1.0)))
    least = max(4, total["bad"] // 200)
    rows = counts.filter((F.col("token") != "") & (F.col("bad") >= least) & (ratio > 2.5)).select("token", ratio.alias("w")) \
        .orderBy(F.desc("w"), "token").limit(LEXICON_SIZE).collect()
    return {r["token"]: float(r["w"]) for r in rows}


def _row(text: str, learned: dict[str, float]) -> list[float]:
    tokens = text.split()
    n = max(len(tokens), 1)
    bad, weight, hits, hidden, seconds = 0, 0.0, [], 0, []
    cache = _row.cache
    for k, t in enumerate(tokens):
        known = cache.get(t)
        if known is None:
            p = _plain(t)
            w, fixed, second = learned.get(p, 0.0), p in INSULTS, p in SECOND
            for s in STEMS:
                if len(p) >= s:
                    w = max(w, learned.get(p[:s] + "*", 0.0))
            masked = 0
            if not w and not fixed and not p.isalpha() and p:
                q = re.sub(r"\W|_", "", p.translate(LEET))
                if q in INSULTS or q in learned:
                    w, masked = max(learned.get(q, 0.0), 3.0), 1
                    fixed = q in INSULTS
            known = (w, fixed, second, masked)
            if len(cache) > 200_000:
                cache.clear()
            cache[t] = known
        if known is not _NOTHING and (known[0] or known[1]):
            weight += known[0]
            bad += known[1]
            hidden += known[3]
            hits.append(k)
        if known[2]:
            seconds.append(k)
    near = 0
    if hits and seconds:
        s = np.array(seconds)
        h = np.array(hits)
        at = np.clip(np.searchsorted(s, h), 1, len(s)) - 1
        after = np.minimum(at + 1, len(s) - 1)
        near = int(np.sum(np.minimum(np.abs(h - s[at]), np.abs(s[after] - h)) <= 5))
    chars = max(len(text), 1)
    upper = sum(map(str.isupper, tokens)) / n
    return [
        bad / n, len(hits) / n, weight / n, float(len(hits)), float(bad), weight, near / n, len(seconds) / n, upper,
        text.count("!") / chars, (text.count("?") + text.count("*") + text.count("$") + text.count("#")) / chars, hidden / n,
        float(np.log1p(n)), len(set(hits)) / max(len(hits), 1),
    ]


_NOTHING = (0.0, False, False, 0)
_row.cache = {}


def features(docs: DataFrame, learned: dict[str, float]) -> DataFrame:
    """``doc_id, x``: one dense vector for every row; a null text counts as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _row.cache = {}
        for batch in batches:
            for part in slices(batch, "text"):
                x = [_row(t or "", learned) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


class Trees(NamedTuple):
    base: float
    feature: np.ndarray    # (trees, nodes)
    threshold: np.ndarray
    value: np.ndarray      # (trees, leaves)
    depth: int
    steps_x: np.ndarray    # isotonic map from margin to probability
    steps_y: np.ndarray


def _route(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, depth: int) -> np.ndarray:
    node = np.zeros(len(x), dtype=np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
    return node - (2 ** depth - 1)


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Trees:
    """Newton boosting of the logistic loss on binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    base = float(np.log((y.sum() + 1.0) / (len(y) - y.sum() + 1.0)))
    margin = np.full(len(y), base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature, threshold, value = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            k, base_node = 2 ** level, 2 ** level - 1
            local = node - base_node
            best = np.full(k, 1e-6)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                key = local * width + code[:, j]
                sg = np.bincount(key, g, k * width).reshape(k, width).cumsum(axis=1)
                sh = np.bincount(key, h, k * width).reshape(k, width).cumsum(axis=1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = (sg ** 2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg ** 2 / (th + 1))[:, :-1]
                gain[(sh[:, :-1] < 1e-3) | (th - sh[:, :-1] < 1e-3)] = 0
                at = gain.argmax(axis=1)
                for q in np.flatnonzero(gain[np.arange(k), at] > best):
                    best[q] = gain[q, at[q]]
                    feature[t, base_node + q], threshold[t, base_node + q] = j, e[at[q]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1.0)
        margin += value[t, leaf]
    return Trees(base, feature, threshold, value, depth, np.zeros(1), np.zeros(1))


def margins(m: Trees, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), m.base)
    for f, c, v in zip(m.feature, m.threshold, m.value):
        out += v[_route(x, f, c, m.depth)]
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the means of the blocks, placed at their mean scores; equal scores are one point."""
    xs, inverse = np.unique(score, return_inverse=True)
    w, s = np.bincount(inverse).astype(float), np.bincount(inverse, y)
    blocks: list[list[float]] = []
    for x, a, b in zip(xs, w, s):
        blocks.append([x * a, a, b])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(x: np.ndarray, y: np.ndarray, pick: np.ndarray) -> Trees:
    """Trees on the rows with ``pick`` false, calibration on the others; all rows serve both where a side lacks a kind."""
    if pick.all() or not pick.any() or y[~pick].min() == y[~pick].max():
        pick = np.zeros(len(y), dtype=bool)
    m = boost(x[~pick], y[~pick])
    side = pick if pick.any() else ~pick
    steps = isotonic(margins(m, x[side]), y[side])
    return m._replace(steps_x=steps[0], steps_y=steps[1])


def score(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Several labels of one document count as toxic if any does; null labels teach nothing. A null or empty text gets
    the score of its (zero) features. Without labelled rows of both kinds every score is their share, or 0. Rows that
    repeat a doc_id are scored one by one; an empty table gives no rows.
    """
    learned = lexicon(docs, labels)
    table = kept(features(docs, learned), "features", lasting=True)
    taught = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    n = taught.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(22)), F.lit(1 << 30)) / float(1 << 30)
    rows = table.join(taught.filter(draw < min(1.0, train_rows / max(n, 1))), "doc_id").select(
        "doc_id", "x", "y", (F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(4)) == 0).alias("pick")).toArrow().sort_by("doc_id")
    y = rows.column("y").to_numpy().astype(float)
    model, share = None, float(y.mean()) if len(y) else 0.0
    if len(y) and 0 < share < 1:
        model = fit(np.array(rows.column("x").to_pylist()), y, rows.column("pick").to_numpy(zero_copy_only=False).astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.full(batch.num_rows, share)
            if model and batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
                s = np.clip(np.interp(margins(model, x), model.steps_x, model.steps_y), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
