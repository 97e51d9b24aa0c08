"""Language identification with a small convolutional network over bytes.

Filters of widths two, three and four slide over embedded bytes of fixed-length windows, each filter keeps its
maximum over the window, a softmax layer names the language. Training is plain numpy on windows of labelled
texts; prediction runs on every window of every text in Arrow batches and averages the windows of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import held_out, slices

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 8, 6
UNKNOWN = "und"
#: most training windows of one language: the documented bound of the labelled sample
PER_LANGUAGE = 500
MOST_LANGUAGES = 500


def _classes() -> np.ndarray:
    """Bytes folded into fewer symbols: letters without case, blanks, digits, marks, and each byte beyond ASCII modulo 64."""
    out = np.zeros(256, dtype=np.int64)
    for b in range(128):
        c = chr(b)
        out[b] = 1 + ord(c.lower()) - 97 if c.isalpha() else 27 if c.isspace() else 28 if c.isdigit() else 29
    out[0] = 0
    out[128:192] = 32 + np.arange(64)
    out[192:256] = 30 + (np.arange(64) > 3)
    return out


CLASS = _classes()
SYMBOLS = 96


class Model(NamedTuple):
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]  # (width, DIM, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    shift: np.ndarray


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def byte_windows(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes of a text in rows of ``size``, the last one filled up with zeros."""
    n = max(1, -(-len(raw) // size))
    out = np.zeros(n * size, dtype=np.uint8)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out.reshape(n, size)


def train(samples: list[tuple[str, str]], *, epochs: int = 12, rate: float = 0.01, seed: int = 1) -> Model:
    """Adam on cross entropy over ``(text, language)`` windows."""
    names = sorted({g for _, g in samples})
    rng = np.random.default_rng(seed)
    pairs = [(byte_windows(t.encode("utf-8"))[0], names.index(g)) for t, g in samples]
    x, y = CLASS[np.stack([p[0] for p in pairs])], np.array([p[1] for p in pairs])
    p = [rng.normal(0, 0.3, (SYMBOLS, DIM))] + [rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS]
    p += [np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(names))), np.zeros(len(names))]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    weight = 1.0 / np.maximum(np.bincount(y, minlength=len(names)), 1)[y]
    weight *= len(y) / weight.sum()
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 64):
            rows = order[k:k + 64]
            b, n = x[rows], len(rows)
            e = p[0][b]
            pooled, where = [], []
            for f in p[1:4]:
                w = len(f)
                conv = sum(e[:, i:WINDOW - w + 1 + i] @ f[i] for i in range(w))
                where.append(conv.argmax(axis=1))
                pooled.append(conv.max(axis=1))
            z = np.concatenate(pooled, axis=1) + p[4]
            a = np.tanh(z)
            prob = _softmax(a @ p[5] + p[6])
            prob[np.arange(n), y[rows]] -= 1.0
            d = prob * (weight[rows] / n)[:, None]
            grad = [np.zeros_like(q) for q in p]
            grad[5], grad[6] = a.T @ d, d.sum(axis=0)
            dz = (d @ p[5].T) * (1 - a * a)
            grad[4] = dz.sum(axis=0)
            for j, w in enumerate(WIDTHS):
                g = dz[:, j * FILTERS:(j + 1) * FILTERS]
                for i in range(w):
                    seen = b[np.arange(n)[:, None], where[j] + i]
                    grad[1 + j][i] = np.einsum("nf,nfd->df", g, p[0][seen])
                    np.add.at(grad[0], seen, g[:, :, None] * p[1 + j][i].T[None])
            step += 1
            for q, g, m, v in zip(p, grad, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(names, p[0], p[1:4], p[4], p[5], p[6])


class Tables(NamedTuple):
    pair: np.ndarray  # for two symbols: responses of width two, and the first halves of widths three and four
    third: np.ndarray
    last: np.ndarray


def tables(m: Model) -> Tables:
    """The convolutions as sums of look-ups for neighbouring symbols."""
    part = [[m.embed @ f[i] for i in range(len(f))] for f in m.filters]
    both = lambda a, b: (a[:, None] + b[None]).reshape(SYMBOLS * SYMBOLS, FILTERS)
    pair = np.concatenate([both(*part[0]), both(part[1][0], part[1][1]), both(part[2][0], part[2][1])], axis=1)
    return Tables(pair.astype(np.float32), part[1][2].astype(np.float32), both(part[2][2], part[2][3]).astype(np.float32))


def probabilities(m: Model, t: Tables, rows: np.ndarray) -> np.ndarray:
    c = CLASS[rows].astype(np.int32)
    pair = c[:, :-1] * SYMBOLS + c[:, 1:]
    y = t.pair[pair]
    two = y[:, :, :FILTERS].max(axis=1)
    three = (y[:, :-1, FILTERS:2 * FILTERS] + t.third[c[:, 2:]]).max(axis=1)
    four = (y[:, :-2, 2 * FILTERS:] + t.last[pair[:, 2:]]).max(axis=1)
    return _softmax(np.tanh(np.concatenate([two, three, four], axis=1) + m.bias) @ m.dense + m.shift)


def training_sample(docs: DataFrame, *, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` windows of each language from texts that are not held out, chosen by hash.

    A window starts anywhere in its text. Languages are counted over all rows that are not held out first; the
    ``MOST_LANGUAGES`` with the most rows are learned (ties by name), so that the model is bounded.
    """
    told = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    usable = told.filter(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in told.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).toLocalIterator()}
    if not counts:
        return []
    draw = (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40))
    share = F.create_map(*[x for g, n in counts.items() for x in (F.lit(g), F.lit(min(1.0, 2.0 * per_language / n)))])
    at = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))) + 1
    rows = usable.filter(draw < F.element_at(share, F.col("lang"))).select(
        "doc_id", "lang", F.substring(F.col("text"), at.cast("int"), F.lit(WINDOW)).alias("window"), F.xxhash64("doc_id", F.lit(13)).alias("turn"))
    rows = rows.toArrow().sort_by([("turn", "ascending"), ("doc_id", "ascending"), ("lang", "ascending"), ("window", "ascending")]).to_pylist()
    taken: dict[str, int] = {}
    out = []
    for r in rows:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= per_language:
            out.append((r["window"], r["lang"]))
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    A null text, one without a letter, or a missing model gives ``und`` with score 0. Every byte of a text lies in
    some window; windows count by their length; of equal probabilities the first language by name wins.
    """
    look = tables(model) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                known = part.column("lettered").to_pylist()
                raw = [t.as_buffer().to_pybytes() if k and model else b"" for t, k in zip(part.column("text").cast(pa.binary()), known)]
                name, score = [UNKNOWN] * len(raw), [0.0] * len(raw)
                full = [k for k, r in enumerate(raw) if r]
                if full:
                    rows = [byte_windows(raw[k]) for k in full]
                    stacked = np.concatenate(rows)
                    prob = np.concatenate([probabilities(model, look, stacked[a:a + 1024]) for a in range(0, len(stacked), 1024)])
                    lengths = np.concatenate([np.minimum(WINDOW, len(raw[k]) - WINDOW * np.arange(len(r))) for k, r in zip(full, rows)])
                    starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
                    mean = np.add.reduceat(prob * lengths[:, None], starts, axis=0) / np.add.reduceat(lengths, starts)[:, None]
                    for k, best, p in zip(full, mean.argmax(axis=1), np.clip(mean.max(axis=1), 0.0, 1.0)):
                        name[k], score[k] = model.languages[best], float(p)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(name, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language(docs: DataFrame, *, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Train on the labelled sample and predict every row; see ``identify`` for the defined cases.

    Rows that repeat a doc_id are judged one by one, and all may be in the sample; an empty table gives no rows.
    """
    sample = training_sample(docs, per_language=per_language)
    return identify(docs, train(sample) if sample else None)
