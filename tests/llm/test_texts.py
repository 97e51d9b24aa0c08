"""Operators that judge one text at a time: coding, secrets, language, toxicity, quality, main text."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from sparkmine.llm import language, main_text, pieces, quality, secrets, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h int, score string"
ODD = [None, "", " ", "\n\t", "a", "Ünïcödé ﬁ 漢字 🙂", "x" * 5000, "the " * 3000, "  two  spaces ", "▁ mark", "\x00nul", "é", "a b"]


def docs(spark, texts, langs=None):
    rows = [(k, t, (langs or {}).get(k), "s", 0, 1, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in pieces.encode_frame(docs(spark, texts), path, ids=True).collect()}
    library = pieces.pieces(path).library
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for k, t in enumerate(texts):
        ids = library.encode(t or "")
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == sha(",".join(map(str, ids)))
        assert got[k]["decoded_sha256"] == sha(library.decode(ids) if ids else "")
    assert pieces.encode_frame(docs(spark, []), path).count() == 0


def test_heap_and_arrays_agree():
    model = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(3)
    chunks = ["".join(rng.choice(list("theandigor▁▁"), rng.integers(1, 40))) for _ in range(300)]
    assert model.array_agenda(chunks) == [model.heap_agenda(c) for c in chunks]


def plain_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(spark, documents):
    made = ["password = hunter2hunter2", "TOKEN:'abc'", "toKen=secret=abcdefgh1", "AKIA" + "A" * 12, "AKIA123", "f" * 32 + "g" + "0" * 31, "é api_key: 12345678 é",
            "the passphrase is f9k2!xQ8zLmP, keep it", "the passphrase is correct", "bearer: 2019-10-10"]
    texts = ODD + made + [r["text"] for r in documents.limit(300).collect()]
    for r in secrets.scan(docs(spark, texts), redact="[x]").collect():
        text = texts[r["doc_id"]] or ""
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        if not r["spans"]:
            assert r["redacted"] == texts[r["doc_id"]]
    got = {r["doc_id"]: r for r in secrets.scan(docs(spark, texts), redact="[x]").collect()}
    guess = got[texts.index("the passphrase is f9k2!xQ8zLmP, keep it")]
    assert guess["spans"] == "guess:18:30" and guess["redacted"] == "the passphrase is [x], keep it"
    assert got[texts.index("the passphrase is correct")]["spans"] == "" and got[texts.index("bearer: 2019-10-10")]["spans"] == ""
    assert secrets.scan(docs(spark, [])).count() == 0


def test_secrets_are_found_whole():
    rng = np.random.default_rng(8)
    token = "".join(rng.choice(list("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"), 360))
    assert (8, 3, 368) in secrets.find(f"bearer: {token}")
    assert secrets.find("password: Tr0ub4dor&3xKp9!q") == [(0, 0, 19), (10, 3, 27)]
    assert secrets.find("pwd=XkQzPvRtYmNw") == [(4, 3, 16)] and secrets.find("pwd: Xk!Qz%Pv&RtYm") == [(5, 3, 18)]
    assert secrets.find("the password is incorrect or the secret is well-known") == []
    assert len(secrets.find("pwd: " + "z" * 200_000)) == 0


def test_guess_cost_prefers_the_cheapest_cut():
    assert secrets.guess_cost("password") < secrets.guess_cost("passw0rd!") < secrets.guess_cost("x7Qp!vZ2k")
    assert secrets.guess_cost("aaaaaaaaaaaa") < 4 and secrets.guess_cost("qwertyuiop") < 4 and secrets.guess_cost("20191010") < 6
    assert secrets.guess_cost("") == 0


def test_language(spark, documents):
    got = language.language(documents).cache()
    hit = got.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out AND lang_pred <> 'und'").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert hit > 0.97 and got.count() == documents.count()
    odd = docs(spark, [None, "", "123 456", "the and of thing and the other", "der die das und nicht", None], {3: "en", 4: "de"})
    rows = {r["doc_id"]: r for r in language.language(odd).collect()}
    assert len(rows) == 6 and all(rows[k]["lang_pred"] == "und" and rows[k]["score"] == 0 for k in (0, 1, 2, 5))
    assert language.language(docs(spark, [])).count() == 0
    assert {r["lang_pred"] for r in language.language(docs(spark, ["some words", None])).collect()} == {"und"}


def test_network_gradients_fit_and_tables_agree():
    rng = np.random.default_rng(0)
    samples = [("".join(rng.choice(list("abcd "), 200)), "x") for _ in range(60)] + [("".join(rng.choice(list("wxyz "), 200)), "y") for _ in range(60)]
    model = language.train(samples, epochs=6)
    rows = np.concatenate([language.byte_windows(t.encode()) for t, _ in samples])
    prob = language.probabilities(model, language.tables(model), rows)
    assert [model.languages[k] for k in prob.argmax(axis=1)] == [g for _, g in samples]
    # the look-up tables are the convolutions
    e = model.embed[language.CLASS[rows[:3]]]
    pooled = [sum(e[:, i:256 - len(f) + 1 + i] @ f[i] for i in range(len(f))).max(axis=1) for f in model.filters]
    z = np.tanh(np.concatenate(pooled, axis=1) + model.bias) @ model.dense + model.shift
    assert np.allclose(prob[:3], language._softmax(z), atol=1e-4)


def test_toxicity(spark, documents):
    big = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), big).join(big, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97 and np.mean([r["predicted"] for r in rows if r["toxic"]]) > 0.85
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.score(documents, labels).cache()
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert got.count() == documents.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    # the score does not depend on the lang, source or labels of the scored rows
    bare = documents.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x"))
    assert got.exceptAll(toxicity.score(bare, labels)).count() == 0
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.score(docs(spark, ODD), none).collect()} == {0.0}
    assert toxicity.score(docs(spark, []), labels).count() == 0


def test_isotonic_is_monotone_least_squares():
    rng = np.random.default_rng(1)
    s = np.sort(rng.normal(size=200))
    y = (rng.random(200) < 1 / (1 + np.exp(-2 * s))).astype(float)
    x, v = toxicity.isotonic(s, y)
    assert (np.diff(v) > 0).all() and (np.diff(x) > 0).all()
    w = np.searchsorted(np.r_[x, np.inf], s)
    assert abs(v.mean() - y.mean()) < 0.5 and len(w) == 200
    assert toxicity.isotonic(np.zeros(4), np.array([0, 1, 1, 1.0]))[1].tolist() == [0.75]


def test_boosting_separates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.boost(x, y)
    assert np.mean((toxicity.margins(model, x) > 0) == y) > 0.95


def test_quality(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.classify(documents).cache()
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == documents.count()
    assert np.mean([r["good"] for r in rows if r["quality"] == 1]) > 0.98
    assert np.mean([not r["good"] for r in rows if r["quality"] == 0]) > 0.9
    odd = quality.classify(docs(spark, ODD), keep="doc_id long, h int").collect()
    assert len(odd) == len(ODD) and all(r["h"] == 1 for r in odd)
    assert all(r["score"] == 0 and not r["good"] for r in odd if not (ODD[r["doc_id"]] or "").strip())
    assert quality.classify(docs(spark, [])).count() == 0


def test_em_recovers_labellers():
    rng = np.random.default_rng(4)
    good = rng.random(4000) < 0.85
    votes = np.stack([np.where(good, np.where(rng.random(4000) < 0.002, 1, 0), np.where(rng.random(4000) < 0.6, 1, 0)) for _ in range(4)]
                     + [np.where(good, 2, np.where(rng.random(4000) < 0.5, 2, 1))], axis=1)
    patterns, of, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    _, table, post = quality.em(patterns, counts.astype(float))
    assert np.mean((post[of.ravel()] > 0.5) == good) > 0.95
    assert (table[:4, 0, 1] > 10 * table[:4, 1, 1]).all()


def test_main_text(spark):
    model = main_text.train([])
    for source in main_text.LABELLED:
        page = main_text.parse(source)
        y = main_text._labels(page)
        assert main_text.main_text(source, model) == "\n".join(t for k, t in page.spans if y[k])
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in main_text.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(main_text.html.unescape(re.sub(r"</?[a-z][^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(filter(None, blocks)) and got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    odd = spark.createDataFrame([(1, None, None, 3), (2, "u", "", 3), (3, "u", "<p>", 3), (4, "u", "a < b &amp; c", 3), (4, "u", "a < b &amp; c", 3), (5, "u", "<div>" * 3000 + "deep", 3)],
                                "page_id long, url string, html string, text int")
    rows = main_text.extract(odd).collect()
    assert len(rows) == 6 and all(r["text"] == "" and r["n_chars"] == 0 for r in rows if r["page_id"] < 4)
    assert main_text.extract(odd.limit(0)).count() == 0


def test_messages_equal_enumeration():
    page = main_text.parse("<div><p>One, two. Three, four.</p><ul><li><a>x</a></li></ul></div><nav><a>m</a></nav>")
    model = main_text.train([])
    n = len(page.nodes)
    score = [sum(model.weight.get(f, 0.0) for f in fs) for fs in main_text.features(page)]
    mass = np.zeros((n, 2))
    for code in range(2 ** n):
        y = [(code >> k) & 1 for k in range(n)]
        w = np.exp(sum(s * v for s, v in zip(score, y)) + sum(model.edge[y[page.nodes[k].parent]][y[k]] for k in range(1, n)))
        for k in range(n):
            mass[k, y[k]] += w
    assert np.allclose(main_text.marginals(page, model), mass[:, 1] / mass.sum(axis=1))
