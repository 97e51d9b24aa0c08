"""Operators that relate rows: repeats, Jaccard join, decontamination, vector links, and the pipeline."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmine.llm import decontaminate, overlap_join, repeats, vector_links
from sparkmine.llm.links import forest, forest_between, lowest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h int, m string, id long"
RNG = np.random.default_rng(5)
VOCABULARY = ["".join(RNG.choice(list("abcdefghij"), RNG.integers(2, 7))) for _ in range(400)]


def prose(n):
    return [str(w) for w in RNG.choice(VOCABULARY, n)]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), 1, "x", 9) for k, t in rows], DOCS)


@pytest.fixture(scope="module")
def planted():
    """Passages at different offsets, copies, near copies, periodic texts, a very long text, odd spaces, empty and null texts."""
    shared, twice = prose(60), prose(25)
    rows = [(10, prose(80) + shared + prose(30)), (11, shared[5:50]), (12, prose(7) + shared[30:] + prose(9) + twice + prose(3) + twice), (13, shared),
            (14, ["a"] * 70), (15, ["a"] * 19), (16, ["a", "b"] * 40), (17, ["b", "a"] * 20), (18, prose(6000) + shared[:19]), (19, twice[:20])]
    base = prose(300)
    for k in range(60):
        copy = list(base)
        for at in RNG.integers(0, 300, RNG.integers(0, 5)):
            copy[at] = f"edit{RNG.integers(1000)}"
        rows.append((100 + k, copy))
    rows += [(200 + k, prose(RNG.integers(1, 120))) for k in range(60)]
    rows += [(300 + k, base) for k in range(8)]
    rows += [(400, ["only", "four", "words", "here"]), (401, ["only", "four", "words", "here"]), (402, ["one"])]
    texts = [(k, " ".join(w)) for k, w in rows] + [(500, None), (501, ""), (502, " \n\t "), (503, "x y z " * 30), (504, "x y z\n" * 30)]
    return texts


def removed(rows, size=20):
    seen, out = {}, {}
    for k, t in sorted(rows):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            if seen.setdefault(key, (k, i)) != (k, i):
                gone[i:i + size] = [True] * size
        left = [w for w, g in zip(words, gone) if not g]
        out[k] = (len(words), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, planted):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.remove_repeats(frame(spark, planted).repartition(7)).collect()}
    assert got == removed(planted)


def test_repeats_odd_rows(spark):
    same = " ".join(prose(40))
    rows = [(1, same), (1, same), (None, same), (2, same), (3, None)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in repeats.remove_repeats(frame(spark, rows)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 40), (3, 0)]
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_open_groups_span_batches():
    """A minimizer whose rows come in many batches is resolved as if they came in one."""
    import pyarrow as pa

    def batch(rows):
        m, h, doc, a, edges = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(m), pa.array(h), pa.array(doc), pa.array(a, pa.int32()), pa.array([1] * len(rows), pa.int32()),
                                           pa.array([np.array(e, np.uint64).tobytes() for e in edges], pa.binary())], names=["m", "h", "doc_id", "a", "copies", "edges"])

    rows = [(7, 1, 1, 0, [1, 2, 3]), (7, 2, 2, 0, [2, 3, 4]), (7, 1, 3, 5, [1, 2, 3]), (7, 3, 4, 0, [4, 5]), (8, 9, 5, 0, [6])]
    read = lambda out: {(r["m"], r["h"]): (r["first_doc"], r["mask"]) for b in out for r in b.to_pylist()}
    one, many = read(repeats._resolve(iter([batch(rows)]))), read(repeats._resolve(iter([batch([r]) for r in rows])))
    want = {(7, 1): (1, 0), (7, 2): (2, 3), (7, 3): (4, 1)}
    assert {k: v for k, v in one.items() if k in want} == want and {k: v for k, v in many.items() if k in want} == want


def classes(rows, threshold=0.8):
    sets = {}
    for k, t in rows:
        w = (t or "").encode().split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    keys, links = sorted(sets), defaultdict(int)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (find(k), links[k], find(k) == k) for k in keys}


def test_jaccard_join_equals_brute_force(spark, planted, monkeypatch):
    want = classes(planted)
    read = lambda d: {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in d.collect()}
    assert read(overlap_join.jaccard_classes(frame(spark, planted).repartition(5))) == want
    # the same with tiny stripes, chunks and direct comparisons, so that every cut is used
    monkeypatch.setattr(overlap_join, "STRIPE", 3000)
    monkeypatch.setattr(overlap_join, "SMALL", 8)
    assert read(overlap_join.jaccard_classes(frame(spark, planted))) == want


def test_jaccard_join_compares_crowded_paths_whole(spark, monkeypatch):
    """Near copies made of popular passages share only frequent shingles."""
    rng = np.random.default_rng(11)
    passages = [[f"p{k}w{i}" for i in range(30)] for k in range(24)]
    rows = []
    for k in range(350):
        words_ = [w for p in sorted(rng.choice(24, 8, replace=False)) for w in passages[p]]
        rows.append((k, " ".join(words_)))
        if k < 50:
            rows.append((1000 + k, " ".join([*words_[:-1], f"edit{k}"])))
    monkeypatch.setattr(overlap_join, "SMALL", 8)
    monkeypatch.setattr(overlap_join, "CHUNK", 8)
    monkeypatch.setattr(overlap_join, "TILE", 8, raising=False)
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in overlap_join.jaccard_classes(frame(spark, rows)).collect()}
    assert got == classes(rows)


def test_stripes_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(overlap_join, "ROWS", 16, raising=False)
    text, real, stripes = prose(25), overlap_join.tiled_links, []

    def spy(members, group, load, limit, *more):
        stripes.extend((r["n"], r["s"]) for r in members.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum(load) / limit).alias("s")).collect())
        return real(members, group, load, limit, *more)

    monkeypatch.setattr(overlap_join, "tiled_links", spy)
    rows = [(k, " ".join([*text[:-1], f"end{k}"])) for k in range(60)]
    got = {r["doc_id"]: r["n_links"] for r in overlap_join.jaccard_classes(frame(spark, rows)).collect()}
    assert set(got.values()) == {59} and all(n <= 16 * s for n, s in stripes)


def test_jaccard_audit_repeats_runs_or_fails(spark, monkeypatch):
    text = prose(60)
    rows = [(k, " ".join([*text, f"end{k}"])) for k in range(5)]
    real, firsts = overlap_join.loose_edges, []

    def blind(sets, *, first, **more):
        firsts.append(first)
        edges = real(sets, first=first, **more)
        return edges if first else edges.limit(0)

    monkeypatch.setattr(overlap_join, "loose_edges", blind)
    got = {r["doc_id"]: r["class_id"] for r in overlap_join.jaccard_classes(frame(spark, rows)).collect()}
    assert set(got.values()) == {0} and firsts == [0, overlap_join.RUNS]
    monkeypatch.setattr(overlap_join, "loose_edges", lambda sets, **more: real(sets, **more).limit(0))
    with pytest.raises(RuntimeError):
        overlap_join.jaccard_classes(frame(spark, rows))


def test_jaccard_odd_rows(spark):
    t = " ".join(prose(30))
    rows = [(1, t), (1, t), (None, t), (2, None), (3, t)]
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in overlap_join.jaccard_classes(frame(spark, rows)).collect())
    assert got == [(1, 1, 1), (2, 2, 0), (3, 1, 1)]
    assert overlap_join.jaccard_classes(frame(spark, [])).count() == 0


def test_forests_join_what_the_links_join():
    for n in (1, 5, 40):
        linked = RNG.random((n, n)) < 1.2 / n
        linked |= linked.T
        a, b = forest(np.arange(n), linked)
        own = np.zeros((n, n), bool)
        own[a, b] = own[b, a] = True
        assert (lowest(own) == lowest(linked)).all() and len(a) < n
        cross = RNG.random((n, n + 3)) < 1.0 / n
        a, b = forest_between(np.arange(n), np.arange(n, 2 * n + 3), cross)
        full, part = np.zeros((2 * n + 3,) * 2, bool), np.zeros((2 * n + 3,) * 2, bool)
        full[:n, n:], full[n:, :n] = cross, cross.T
        part[a, b] = part[b, a] = True
        assert (lowest(part) == lowest(full)).all()


ITEMS = [
    (1, "If 12 workers build a wall of 30 m in 12 days, how long do 18 workers need for the same wall in Berlin?"),
    (2, "what is the name of the long river that flows through the old town near the sea"),
    (3, "too short"), (4, None), (None, "never used as it has no id but words enough to be matched"), (5, "five words in this item"),
]


def test_leaks(spark):
    bench = spark.createDataFrame([(k, t, 1) for k, t in ITEMS], "item_id long, text string, doc_id int")
    other = "If 7 workers build a wall of 45 m in 7 days, how long do 21 workers need for the same wall in Paris?"
    broken = "If 7 workers build a wall of 45 m in 9 days, how long do 21 workers need for the same wall in Paris?"
    rows = [(1, " ".join(prose(50)) + ". " + ITEMS[0][1] + " " + " ".join(prose(40))), (2, other), (3, broken), (4, ITEMS[1][1].upper()), (5, " ".join(prose(300))),
            (6, None), (7, ""), (8, "x " + ITEMS[5][1] + " y"), (9, "too short"), (10, "12 30 12 18 " * 40), (None, ITEMS[1][1]), (11, ITEMS[1][1]), (11, ITEMS[1][1]),
            (12, " ".join(prose(3000)) + " " + ITEMS[1][1])]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    assert got == {(1, 1): "exact", (2, 1): "reparameterised", (4, 2): "exact", (8, 5): "exact", (11, 2): "exact", (12, 2): "exact"}
    left = decontaminate.without_leaks(frame(spark, rows), bench)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 3, 5, 6, 7, 9, 10] and left.columns == DOCS.replace(" string", "").replace(" long", "").replace(" int", "").split(", ")
    assert decontaminate.leaks(frame(spark, []), bench).count() == 0 and decontaminate.leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_leaks_judge_each_copy_of_an_item(spark):
    bench = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    one = ITEMS[0][1]
    two = "If 7 workers build a wall of 45 m in 7 days, how long do 21 workers need for the same wall in Paris?"
    three = "If 5 workers build a wall of 60 m in 5 days, how long do 25 workers need for the same wall in Rome?"
    bad = "If 7 workers build a wall of 45 m in 9 days, how long do 21 workers need for the same wall in Paris?"
    rows = [(1, f"{one} {two}"), (2, f"{two} {three}"), (3, f"{bad} {bad}"), (4, f"{two} {one}")]
    got = {r["doc_id"]: r["kind"] for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    assert got == {1: "exact", 2: "reparameterised", 4: "exact"}


def test_leaks_find_the_planted_items(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    windows = {}
    for r in bench.collect():
        w = r["text"].split()
        windows[r["item_id"]] = {tuple(w[i:i + 8]) for i in range(max(1, len(w) - 7))}
    want = set()
    for r in docs.collect():
        w = r["text"].split()
        mine = {tuple(w[i:i + 8]) for i in range(max(1, len(w) - 7))}
        want |= {(r["doc_id"], k) for k, v in windows.items() if len(v & mine) >= 0.5 * len(v)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert want and want <= got and len(got - want) <= 0.02 * len(want) + 1
    plan = decontaminate.leaks(docs, bench)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_vector_links_equal_brute_force(spark):
    rows, n = [], 0
    for label in (0, 1, None):
        centre = RNG.normal(size=16) * 3
        for _ in range(150):
            rows.append((n, centre + RNG.normal(size=16), label))
            n += 1
        for spread in (0.001, 0.05, 0.3, 0.6):
            base = RNG.normal(size=16) * 4
            for _ in range(40):
                rows.append((n, base + RNG.normal(size=16) * spread, label))
                n += 1
    rows = [(k, [float(np.float32(v)) for v in x], g, 1) for k, x, g in rows]
    rows += [(n + k, rows[7][1], 0, 1) for k in range(5)] + [(n + 5, None, 0, 1), (n + 6, [0.0] * 16, 0, 1), (n + 7, [1.0, None], 0, 1), (n + 8, [float("nan")] * 16, 0, 1),
                                                             (n + 9, [float("inf")] * 16, 0, 1), (n + 10, rows[7][1], 1, 1), (n + 11, [1.0, 2.0], 0, 1), (n + 12, [2.0, 4.0], 0, 1), (n + 13, [], 0, 1)]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, g int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_links.vector_classes(frame_.repartition(4)).collect()}
    ok = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links, root = defaultdict(int), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ok):
        for b in ok[i + 1:]:
            if a[2] == b[2] and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98 - 1e-12:
                links[a[0]] += 1
                links[b[0]] += 1
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    assert sum(links.values()) > 1000
    assert got == {r[0]: (links[r[0]], find(r[0]), find(r[0]) == r[0]) for r in rows}
    assert vector_links.vector_classes(frame_.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    left = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, left, sf)
        out.write.parquet(str(tmp_path / str(k)))
        before, left = left, spark.read.parquet(str(tmp_path / str(k)))
        assert k == len(corpus_pipeline.STAGES) - 1 or left.columns == columns
        rows = {r["doc_id"]: r for r in before.collect()}
        ids = {r["doc_id"] for r in left.select("doc_id").collect()}
        if k == 1:
            assert ids == {d for d, v in classes([(r["doc_id"], r["text"]) for r in rows.values()]).items() if v[2]}
        if k in (3, 4):
            assert ids == set(rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece coding"]
    assert corpus_pipeline.run(spark, sf).exceptAll(left).count() == 0


def test_stages_on_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    same = " ".join(prose(50)) + "."
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    left = frame(spark, [(1, same), (1, same), (2, same), (3, None), (4, ""), (None, same + " password = abcdefgh1"), (5, "x" * 100_000)]).select(*names)
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, sf)
        sizes.append(left.count())
    assert sizes[1:] == [sizes[1]] * 4 and sizes[0] - sizes[1] == 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []).select(*names), sf).count() == 0
