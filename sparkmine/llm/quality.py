"""Quality classification without labels: heuristic labellers, a weak-label model and a hashed linear scorer.

Each labeller votes good, junk or nothing on a text. The vote patterns of all texts are counted; expectation
maximisation over the counts estimates how each labeller votes on good and on junk texts, and with that the
posterior of every pattern. A logistic scorer on hashed token features learns the posteriors on a bounded
sample and scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.lineage import scoped
from sparkmine.llm.common import kept, slices
from sparkmine.llm.words import U, Words, mix, words

LABELLERS = ("marks", "capitals", "bars", "repeats", "sentences", "variety", "length", "shouts")
BUCKETS = 1 << 12
#: most texts that fit the scorer, half of them likely junk
SAMPLE = 6_000
SLICE = 1 << 20
#: a labeller is built to call at most this share of the good texts junk; the estimate is held to that
FALSE_JUNK = 0.001
#: weight of an abstention: labellers that look for one defect each are far from independent when silent
SILENCE = 0.2
#: share of good texts expected beforehand, worth as much as all the votes together
PRIOR = 0.85

KIND = np.zeros(256, dtype=np.int64)  # 0 blank, 1 lower or beyond ASCII, 2 upper, 3 digit, 4 sentence mark, 5 other mark, 6 bar, 7 bang
KIND[33:128] = 5
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:] = 3, 2, 1, 1
for _c, _k in ((".", 4), (",", 4), (";", 4), (":", 4), ("?", 4), ("'", 1), ("-", 1), ('"', 4), ("(", 4), (")", 4), ("|", 6), ("!", 7)):
    KIND[ord(_c)] = _k


def _per_text(w: Words, kind: np.ndarray, k: int) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(kind == k)][w.offsets]).astype(float)


def _sums(w: Words, per_word: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0.0, np.cumsum(per_word)][w.first])


def votes(w: Words) -> np.ndarray:
    """One row a text, one column a labeller: 2 good, 1 junk, 0 no vote. A text without words is junk to all who vote."""
    kind = KIND[w.data]
    count = {k: _per_text(w, kind, k) for k in (1, 2, 3, 4, 5, 6, 7)}
    solid = np.maximum(sum(count.values()), 1)
    n = np.diff(w.first).astype(float)
    some = np.maximum(n, 1)
    same = np.r_[False, (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])] if len(w.hash) else np.zeros(0, bool)
    order = np.lexsort((w.hash, w.doc))
    fresh = np.ones(len(order), dtype=bool)
    if len(order):
        fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    distinct = np.bincount(w.doc[order[fresh]], minlength=len(n)) / some
    ends = np.isin(w.data[w.end - 1], [ord(c) for c in ".?!"]) if len(w.end) else np.zeros(0, bool)
    per_sentence = n / np.maximum(_sums(w, ends), 0.5)
    chars = _sums(w, (w.end - w.start).astype(float)) / some
    upper = count[2] / np.maximum(count[1] + count[2], 1)
    say = lambda junk, good=False: np.where(junk, 1, np.where(good, 2, 0))
    table = np.stack([
        say(count[5] / solid > 0.06),
        say(upper > 0.5),
        say(count[6] / some > 0.1),
        say(_sums(w, same.astype(float)) / some > 0.25),
        say(per_sentence > 80, per_sentence < 40),
        say((distinct < 0.15 + 4 / some) & (n >= 30)),
        say((chars > 15) | (chars < 2)),
        say(count[7] / some > 0.3),
    ], axis=1)
    table[n == 0] = 1
    return table


def em(patterns: np.ndarray, counts: np.ndarray, *, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Prior of good, vote probabilities ``(labeller, good?, vote)`` and the posterior of good for each pattern.

    Starts from, and is drawn to, labellers that rarely call a good text junk. The pull weighs as much as a tenth of the
    texts, so every pattern has a posterior. The number of good votes is kept low on purpose: labellers that all
    call running prose good would outvote the one that sees the defect.
    """
    n, m = patterns.shape
    two_sided = (patterns == 2).any(axis=0)
    pull = np.where(two_sided[:, None, None], [[[0.3, 0.3, 0.4], [0.1, 0.001, 0.899]]], [[[0.8, 0.198, 0.002], [0.997, 0.001, 0.002]]])
    vote = pull
    prior = PRIOR
    total = max(counts.sum(), 1.0)
    post = np.full(n, prior)
    for _ in range(rounds):
        vote = vote.copy()
        log = np.array([(np.log(vote[np.arange(m)[None], g, patterns]) * np.where(patterns > 0, 1.0, SILENCE)).sum(axis=1) for g in (0, 1)])
        log += np.log([[1 - prior], [prior]])
        top = np.exp(log - log.max(axis=0))
        new = top[1] / top.sum(axis=0)
        moved = np.abs(new - post).max() if n else 0.0
        post = new
        prior = float((post * counts).sum() / total + PRIOR) / 2
        for j in range(m):
            for g, share in ((0, 1 - post), (1, post)):
                tally = np.bincount(patterns[:, j], share * counts, 3) + 0.1 * total * pull[j, g]
                vote[j, g] = tally / tally.sum()
                if g and vote[j, g, 1] > FALSE_JUNK:
                    vote[j, g, [0, 2]] *= (1 - FALSE_JUNK) / (1 - vote[j, g, 1])
                    vote[j, g, 1] = FALSE_JUNK
        if moved < 1e-9:
            break
    return prior, vote, post


def hashed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every token feature: the shape of a word, alone and with its neighbour, and whether it was just said."""
    if not len(w.hash):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    kind = KIND[w.data]
    at = lambda k: kind[np.clip(k, 0, len(kind) - 1)]
    length = np.minimum(w.end - w.start, 15)
    shape = ((((at(w.start) * 8 + at(np.minimum(w.start + 1, w.end - 1))) * 8 + at(w.end - 1)) * 8 + at(np.maximum(w.end - 2, w.start))) * 16 + length).astype(U)
    near = np.zeros(len(shape), dtype=U)
    for back in (1, 2, 3):
        near[back:] |= ((w.hash[back:] == w.hash[:-back]) & (w.doc[back:] == w.doc[:-back])).astype(U) << U(back)
    before = np.r_[U(0), np.where(w.doc[1:] == w.doc[:-1], shape[:-1] >> U(4), U(0))]
    one = mix(shape * U(16) + near) % U(BUCKETS)
    two = mix((shape >> U(4)) * U(1 << 20) + before + U(1 << 60)) % U(BUCKETS)
    return np.concatenate([one, two]).astype(np.int64), np.concatenate([w.doc, w.doc])


def _means(w: Words, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the token features of every text; zero without words."""
    bucket, doc = hashed(w)
    n = len(w.offsets) - 1
    return np.bincount(doc, weights[bucket], n) / np.maximum(np.bincount(doc, minlength=n), 1)


def train(rows: list[dict], *, rounds: int = 300, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression on feature shares ``(buckets, shares)`` against soft labels, by full-batch Adam."""
    y = np.array([r["posterior"] for r in rows])
    where = np.repeat(np.arange(len(rows)), [len(r["buckets"]) for r in rows])
    bucket = np.concatenate([np.asarray(r["buckets"], dtype=np.int64) for r in rows])
    share = np.concatenate([np.asarray(r["shares"], dtype=float) for r in rows])
    weights, bias = np.zeros(BUCKETS), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    balance = np.where(y > 0.5, 0.5 / max((y > 0.5).mean(), 1e-3), 0.5 / max((y <= 0.5).mean(), 1e-3))
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(where, weights[bucket] * share, len(y)) + bias, -30, 30)))
        d = (p - y) * balance / len(y)
        g = np.r_[np.bincount(bucket, d[where] * share, BUCKETS) + 1e-5 * weights, d.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def _scan(docs: DataFrame, schema: str, keep: list[str], columns) -> DataFrame:
    """Apply ``columns(part, words)`` to slices of the texts and carry ``keep`` along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = columns(part, words(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *found.values()], names=[*keep, *found])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


PATTERN_BASE = 3 ** np.arange(len(LABELLERS))


def _pattern(w: Words) -> np.ndarray:
    return votes(w) @ PATTERN_BASE


@scoped
def fit(docs: DataFrame, *, sample: int = SAMPLE) -> tuple[np.ndarray, float] | None:
    """Weights and bias of the scorer; None for an empty table. Patterns are counted over all rows."""
    voted = kept(_scan(docs, "doc_id long, pattern long", ["doc_id"], lambda part, w: {"pattern": pa.array(_pattern(w))}), "votes")
    table = sorted((r["pattern"], r["count"]) for r in voted.groupBy("pattern").count().toLocalIterator())  # at most 3 ** 8 rows
    if not table:
        return None
    code, counts = np.array([p for p, _ in table]), np.array([c for _, c in table], dtype=float)
    _, _, post = em(code[:, None] // PATTERN_BASE % 3, counts)
    good = post >= 0.5
    half = [max(counts[good == g].sum(), 1.0) for g in (False, True)]
    posterior = dict(zip(code.tolist(), post.tolist()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    share = [min(1.0, sample / 2 / h) for h in half]
    junk = [int(c) for c, g in zip(code, good) if not g]
    chosen = voted.filter("doc_id is not null").filter(draw < F.when(F.col("pattern").isin(junk), share[0]).otherwise(share[1])).groupBy("doc_id").agg(
        F.min("pattern").alias("pattern")).orderBy(F.xxhash64("doc_id", F.lit(31))).limit(2 * sample)

    def shares(part: pa.RecordBatch, w: Words) -> dict[str, pa.Array]:
        bucket, doc = hashed(w)
        key, number = np.unique(doc * BUCKETS + bucket, return_counts=True)
        ends = np.searchsorted(key, np.arange(part.num_rows + 1) * BUCKETS).astype(np.int32)
        whole = np.bincount(doc, minlength=part.num_rows)[key // BUCKETS] if len(key) else np.zeros(0)
        return {
            "buckets": pa.ListArray.from_arrays(pa.array(ends), pa.array((key % BUCKETS).astype(np.int32))),
            "shares": pa.ListArray.from_arrays(pa.array(ends), pa.array((number / np.maximum(whole, 1)).astype(np.float32)))}

    rows = _scan(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id long, pattern long, buckets array<int>, shares array<float>", ["doc_id", "pattern"], shares)
    rows = rows.toArrow().sort_by("doc_id").to_pylist()
    for r in rows:
        r["posterior"] = posterior[r["pattern"]]
    return train(rows) if rows else None


def classify(docs: DataFrame, *, sample: int = SAMPLE, threshold: float = 0.3, keep: str = "doc_id long") -> DataFrame:
    """``score`` (probability of good) and ``good`` for every row, beside the columns named in ``keep``.

    A null, empty or blank text scores 0 and is not good. Repeated rows get equal scores; an empty table gives none.
    """
    model = fit(docs, sample=sample)
    names = [c.split()[0] for c in keep.split(",")]

    def judged(part: pa.RecordBatch, w: Words) -> dict[str, pa.Array]:
        z = np.clip(_means(w, model[0]) + model[1], -30, 30) if model else np.zeros(part.num_rows)
        score = np.where(np.diff(w.first) > 0, 1 / (1 + np.exp(-z)), 0.0)
        return {"score": pa.array(score), "good": pa.array(score >= threshold)}

    return _scan(docs, f"{keep}, score double, good boolean", names, judged)
