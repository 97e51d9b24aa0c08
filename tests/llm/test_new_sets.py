"""Packing, importance resampling and the filter audit against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from sparkmine.llm import filter_audit, packing, resampling

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, rank int, length long, part string, n int"
RNG = np.random.default_rng(17)
ODD = [None, "", " ", "\n\t", "a", "ΣΑΣ Σ İstanbul ﬁ 漢字　🙂 é x\x1cy\x85z", "x" * 5000, "The " * 3000, "<|endoftext|> a<|startoftext|>b", "it's we'll 12½ don't--!?", "é" * 40, "a b"]
VOCABULARY = ["".join(RNG.choice(list("abcdefghiÄéß"), RNG.integers(1, 8))) for _ in range(300)]


def frame(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source), beside columns that clash with those of the operators."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, "k", 7, 8, "p", 9) for r in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    made = [" ".join(RNG.choice(VOCABULARY, int(n))) for n in np.exp(RNG.normal(5, 1.3, 150))]
    return list(enumerate(ODD + made + made[:3] + [" ".join(RNG.choice(VOCABULARY, 9000))]))


# packing


def token_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def sound(rows, docs, capacity=2048):
    """Every id in one piece, pieces gapless in their sequence, and no padding but what is told."""
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = {k: token_ids(tokenizer, t) for k, t in docs}
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r["doc_id"], []).append(r)
        of_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(of_doc) == set(ids) and set(of_sequence) == set(range(len(of_sequence)))
    for k, pieces in of_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = ids[k][r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids[k]) and len(own) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids[k])
    size = {}
    for k, pieces in of_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        size[k] = at
    short = [n for n in size.values() if n != capacity]
    assert len(short) < 12 and all(n & (n - 1) == 0 for n in short)


def test_packing_holds_every_id_once(spark, texts):
    got = packing.pack(frame(spark, texts).repartition(5), WORD_BPE).collect()
    sound(got, texts)
    # many copies of one length that no other length completes
    hot = [(k, "word " * 1499) for k in range(40)] + [(100 + k, "a b c") for k in range(3)]
    sound(packing.pack(frame(spark, hot).repartition(7), WORD_BPE).collect(), hot)


def test_packing_odd_rows(spark):
    assert packing.pack(frame(spark, []), WORD_BPE).count() == 0
    got = packing.pack(frame(spark, [(None, "a"), (1, "a b"), (1, "a b"), (2, None)]), WORD_BPE).collect()
    assert sum(r["length"] for r in got) == 2 + 3 + 3 + 1
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in {(r["doc_id"], r["doc_tokens"]): r for r in got}.values()) == [(0, 2), (1, 3), (2, 1)]


def test_words_equal_the_library():
    model = packing.Ids(WORD_BPE)
    for text in ODD + ["".join(RNG.choice(list("aB'sé 1½.,-\x1c\xa0İΣ́<|>"), 60)) for _ in range(300)]:
        assert model.encode(text or "").tobytes() == model.library(text or ""), text


def closest(pool, capacity):
    reach = {0}
    for length, n in pool.items():
        reach = {r + length * k for r in reach for k in range(n + 1) if r + length * k <= capacity}
    return max(reach)


def test_fill_comes_closest():
    for _ in range(200):
        capacity = int(RNG.integers(1, 60))
        pool = {int(x): int(RNG.integers(1, 4)) for x in RNG.integers(1, 40, RNG.integers(1, 6))}
        use = packing.fill(pool, capacity)
        assert all(n <= pool[x] for x, n in use.items())
        assert sum(x * n for x, n in use.items()) == closest(pool, capacity)


@pytest.mark.parametrize("histogram", [{}, {5: 1}, {33: 1000}, {63: 7, 1: 3}, {int(x): int(n) for x, n in zip(range(1, 64), RNG.integers(0, 50, 63))}])
def test_plan_holds_every_item_once(histogram):
    slots, sequences = packing.plan(histogram, 64)
    tokens, size = Counter(), Counter()
    for s in slots:
        for k in range(s.hi - s.lo):
            tokens.update((s.source, s.lo + k, s.start + i) for i in range(s.size))
            size[s.sequence + k] += s.size
    assert tokens == Counter((x, r, i) for x, n in histogram.items() for r in range(n) for i in range(x))
    assert set(size) == set(range(sequences)) and all(n <= 64 and n & (n - 1) == 0 for n in size.values())
    assert sum(n < 64 for n in size.values()) < 7


# resampling


def ngrams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(ws), [zlib.crc32(" ".join(ws[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def drawn(docs, target):
    told = {k: ngrams(t) for k, t in docs}
    source, goal = Counter(), Counter()
    for _, f in told.values():
        source.update(f)
    for t in target:
        goal.update(ngrams(t)[1])
    s, t = sum(source.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s + 10000) / ((source[b] + 1) * (t + 10000))))
    out = {}
    for k, (_, f) in told.items():
        h = int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out[k] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((k for k in out if told[k][0] >= 20), key=lambda k: (-out[k][2], k))
    for rank, k in enumerate(able[:5 * len(able) // 100], start=1):
        out[k][3] = rank
    return out


@pytest.mark.parametrize("sizes", [{}, {"segment": 4, "samples": 400}, {"segment": 1, "samples": 40}])
def test_resampling_equals_brute_force(spark, texts, sizes):
    target = [" ".join(RNG.choice(VOCABULARY[:40], 30)) for _ in range(10)] + [None, "", "q" * 70 + " Ünï " + "w" * 64]
    got = resampling.resample(frame(spark, texts).repartition(6), frame(spark, list(enumerate(target))), **sizes).collect()
    assert {r["doc_id"]: [r["n_features"], r["weight"], r["score"], r["rank"]] for r in got} == drawn(texts, target)


def test_resampling_ties_and_odd_rows(spark):
    rows = [(k, " ".join(["same"] * 30)) for k in range(50)]
    doubled = rows + rows + [(None, " ".join(["same"] * 30)), (77, None)]
    got = resampling.resample(frame(spark, doubled).repartition(9), frame(spark, []), segment=2, samples=500).collect()
    assert len(got) == 102 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]  # 5 % of 101, rounded down
    order = sorted((r for r in got if r["n_words"] >= 20), key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"]))
    assert [r["doc_id"] for r in order[:5]] == [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    empty = frame(spark, [])
    assert resampling.resample(empty, empty).count() == 0


def test_segments_by_splitters():
    keys = RNG.integers(0, 4, (4, 200))
    splitters = resampling._sorted(RNG.integers(0, 4, (4, 9)))
    want = [sum(tuple(s) <= tuple(k) for s in splitters.T) for k in keys.T]
    assert resampling.segments(keys, splitters).tolist() == want


def test_checksums_of_long_words():
    rows = ["z" * n + " end" for n in (1, 63, 64, 65, 66, 200, 4097)]
    w = resampling.words(pa.array(rows))
    got = {}
    for bucket, doc in resampling.features(w, 1 << 31):
        for b, d in zip(bucket.tolist(), doc.tolist()):
            got.setdefault(d, []).append(b)
    for k, t in enumerate(rows):
        assert sorted(got[k]) == sorted(zlib.crc32(x.encode()) % (1 << 31) for x in (*t.split(), t))


# filter audit


def audited(docs, labels):
    """Every order replayed document by document; Shapley values from all orders."""
    low = {}
    for k, t, _ in docs:
        if k is not None:
            low[t or ""] = min(low.get(t or "", k), k)
    fails = []
    for k, t, source in docs:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A"} if len(ws) < 200 else set()
        own |= {"B"} if 100 * len(set(ws)) < 50 * len(ws) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        own |= {"D"} if re.search("[#$%&*|]", t) else set()
        own |= {"E"} if k is not None and low[t] < k else set()
        fails.append((source or "", own, any(x[0] == k and x[1] == 1 for x in labels), any(x[0] == k and x[2] == 1 for x in labels)))
    out, shapley = {}, Counter()
    for part in {f[0] for f in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, x in enumerate(order, start=1):
                now = [f for f in left if x in f[1]]
                redundant = sum(x in f[1] for f in gone)
                left, gone = [f for f in left if x not in f[1]], gone + now
                unique = sum(f[1] == {x} for f in fails if f[0] == part)
                out[part, order, step] = [len(left), len(now), redundant, unique, sum(f[2] for f in now), sum(f[3] for f in now)]
                shapley[part, x] += len(now)
    return {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def test_filter_audit_equals_every_order_replayed(spark):
    long = " ".join(RNG.choice(VOCABULARY, 300))
    made = [long, long, long + " #", "A" * 50 + long, "x " * 250, "x " * 250, "short", "SHORT | x", None, "", "x " * 199, "a b " * 100]
    docs = [(k, t, [None, "", "one", "two"][k % 4]) for k, t in enumerate(made * 2)] + [(None, long, "one"), (3, "short", "two"), (3, "short", "two")]
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 24, 2)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (5, None, None), (999, 1, 1)]
    table = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, source string")
    got = filter_audit.filter_audit(frame(spark, docs).repartition(4), table).collect()
    assert {(r["part"], r["filter_order"], r["step"]): [r[m] for m in filter_audit.MEASURES] for r in got} == audited(docs, labels)
    assert filter_audit.filter_audit(frame(spark, []), table).count() == 0


def test_potentials_are_shapley_values():
    worth = filter_audit.coalitions(RNG.integers(0, 100, (6, 32)))
    p = filter_audit.potentials(worth)
    for k in range(5):
        marginal = 0
        for order in permutations(range(5)):
            before = sum(1 << i for i in order[:order.index(k)])
            marginal = marginal + worth[:, before | 1 << k] - worth[:, before]
        assert (p[:, 31] - p[:, 31 ^ 1 << k] == marginal).all()
