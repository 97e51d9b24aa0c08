"""Cases that once went wrong: audits, literal items, guess costs, broken markup, few labels, many languages."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import decontaminate, language, links, main_text, overlap_join, secrets, toxicity, vector_links

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kind int, k int, w long, unit long, n long"
RNG = np.random.default_rng(23)
VOCABULARY = ["".join(RNG.choice(list("abcdefghij"), RNG.integers(3, 8))) for _ in range(400)]


def frame(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 1, 1, 1, 1, 1, 1) for r in rows], DOCS)


def prose(n):
    return " ".join(RNG.choice(VOCABULARY, n))


# similarity joins


def test_jaccard_of_a_repeated_id_does_not_depend_on_order(spark):
    a, b = prose(60), prose(60)
    rows = [(1, a), (1, b), (2, a), (3, b)]
    results = []
    for some in (rows, rows[::-1]):
        found = overlap_join.jaccard_classes(frame(spark, some).coalesce(1)).collect()
        results.append(sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found))
    assert results[0] == results[1] and sum(n for _, _, n in results[0]) == 2


def test_units_of_any_size_fill_bounded_stripes(spark, monkeypatch):
    """Twenty groups of thousands of sets on one path: the tiles stay near their size, and what joins groups is found."""
    monkeypatch.setattr(overlap_join, "TILE", 64)
    sig = RNG.integers(0, 1 << 32, (20, 64), dtype=np.uint32)
    sig[1] = sig[0]
    sig[1, :10] += np.uint32(1)  # two groups that agree loosely
    rows = [(7, 1000 * u + k, 1000 * u, 2500, sig[u].tobytes()) for u in range(20) for k in range(200 if u % 2 else 50)]
    table = spark.createDataFrame(rows, "path long, id long, unit long, count long, sig binary")
    seen = []
    real = links.unit_forest
    sizes = spark.sparkContext.accumulator(0)

    def spy(units, linked):
        sizes.add(0 if len(units) <= 3 * 64 else 1)
        return real(units, linked)

    monkeypatch.setattr(overlap_join, "unit_forest", spy)
    seen = {tuple(sorted(r)) for r in overlap_join._compare_tiles(table.drop("sig"), table.select("id", "sig")).collect()}
    assert seen == {(0, 1000)} and sizes.value == 0


def test_later_runs_send_few_edges(spark, monkeypatch):
    """Near copies of one text: the runs after the first have next to nothing to tell."""
    words = prose(80).split()
    rows = []
    for k in range(600):
        own = list(words)
        own[k % 80] = f"edit{k}"
        rows.append((k, " ".join(own)))
    counted = []
    real = overlap_join.loose_edges

    def spy(sets, **more):
        edges = real(sets, **more)
        counted.append((sets.count(), edges.count()))
        return edges

    monkeypatch.setattr(overlap_join, "loose_edges", spy)
    got = overlap_join.jaccard_classes(frame(spark, rows)).collect()
    assert {r["class_id"] for r in got} == {0}
    assert sum(e for _, e in counted) <= 3 * counted[0][0]  # two paths of the first run, one edge for what is joined


def test_common_counts_tokens_in_column_blocks(monkeypatch):
    sets = [RNG.choice(np.arange(300, dtype=np.uint64), RNG.integers(0, 120), replace=False) for _ in range(30)]
    flat = lambda some: (np.concatenate(some), np.repeat(np.arange(len(some)), [len(x) for x in some]))
    want = [[len(np.intersect1d(x, y)) for y in sets[12:]] for x in sets[:12]]
    for block in (64, 100, 1 << 16):
        monkeypatch.setattr(overlap_join, "BLOCK", block)
        (a, of_a), (b, of_b) = flat(sets[:12]), flat(sets[12:])
        assert overlap_join._common(a, b, of_a, of_b, 12, 18).tolist() == want


def pairs_and_noise(spark, n, pairs):
    """Isolated pairs of near copies among vectors without any."""
    x = RNG.normal(size=(n, 16))
    for k in range(pairs):
        x[2 * k + 1] = x[2 * k] + RNG.normal(size=16) * 0.02
    rows = [(k, [float(np.float32(v)) for v in row], 0) for k, row in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def linked(x, threshold=0.98):
    y = np.array(x, dtype=np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = y @ y.T >= threshold
    return near.sum(axis=1) - 1


def test_a_blind_neighbour_graph_loses_nothing(spark, monkeypatch):
    table = pairs_and_noise(spark, 360, 90)
    want = linked([r["embedding"] for r in table.orderBy("vec_id").collect()])
    blind = lambda reps, **more: reps.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).cast("float").alias("sim"), F.lit(1).alias("room")).limit(0)
    monkeypatch.setattr(vector_links, "neighbour_graph", blind)
    got = {r["vec_id"]: r["n_links"] for r in vector_links.vector_classes(table, attempts=1).collect()}
    assert [got[k] for k in range(360)] == want.tolist() and want.sum() >= 180


def test_isolated_pairs_among_many_vectors_are_audited(spark):
    table = pairs_and_noise(spark, 50_000, 200)
    got = {r["vec_id"]: r["n_links"] for r in vector_links.vector_classes(table).collect()}
    x = np.array([r["embedding"] for r in table.filter("vec_id < 400").orderBy("vec_id").collect()], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = [k for k in range(200) if x[2 * k] @ x[2 * k + 1] >= 0.98]
    assert len(true) > 150 and sum(got[2 * k] > 0 for k in true) >= 0.95 * len(true)


# decontamination


def test_items_are_found_word_for_word(spark):
    forty = prose(40)
    bench = spark.createDataFrame(
        [(1, "What is 12 + 45 - 7?"), (2, "Rivers flow down to the big sea"), (3, forty)], "item_id long, text string")
    part = " ".join(forty.split()[9:26])
    rows = [(1, f"{prose(30)}. What is 12 + 45 - 7? {prose(9)}"), (2, f"{prose(20)} Heading\nRivers flow down to the big sea\n{prose(20)}"), (3, f"{prose(25)} {part} {prose(25)}"),
            (4, f"{prose(30)} What is 13 + 45 - 8? {prose(5)}"), (5, f"{prose(5)} {' '.join(forty.split()[9:20])} {prose(5)}"), (6, None), (7, "")]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    assert got == {(1, 1): "exact", (2, 2): "exact", (3, 3): "exact"}
    assert decontaminate.leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_literal_runs_equal_brute_force(spark):
    items = [(k, prose(int(n))) for k, n in enumerate(RNG.integers(3, 40, 30))]
    rows = []
    for k in range(200):
        words = prose(int(RNG.integers(5, 120))).split()
        _, text = items[RNG.integers(len(items))]
        a = int(RNG.integers(0, len(text.split())))
        b = int(RNG.integers(a, len(text.split()) + 1))
        at = int(RNG.integers(0, len(words)))
        rows.append((k, " ".join(words[:at] + text.split()[a:b] + words[at:])))
    want = set()
    for k, t in rows:
        d = re.findall(r"[^\W_]+", t.lower())
        for i, s in items:
            b = re.findall(r"[^\W_]+", s.lower())
            need = min(13, len(b))
            runs = {tuple(b[x:x + need]) for x in range(len(b) - need + 1)}
            if len(b) >= 4 and any(tuple(d[x:x + need]) in runs for x in range(len(d) - need + 1)):
                want.add((k, i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(frame(spark, rows), bench).filter("kind = 1").select("doc_id", "item_id", "shift", "n_windows")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.verbatim(frame(spark, rows), bench, found).collect()}
    assert got == want and len(want) > 20


def test_a_passage_in_a_third_of_the_documents(spark):
    item = "If 12 workers build a wall of 30 m in 12 days, how long do 18 workers need for the same wall in Berlin?"
    rows = [(k, f"{prose(20)} {item} {prose(20)}" if k % 3 == 0 else prose(60)) for k in range(600)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.leaks(frame(spark, rows), bench).collect()} == set(range(0, 600, 3))


# secrets


def cheapest(value, words):
    """The least cost over all segmentations, by trying them all."""
    low = value.lower()
    plain, keys = low.translate(secrets.LEET), low.translate(secrets.SHIFTED)

    def single(a, b):
        part, costs = value[a:b], []
        if b - a == 1:
            costs.append(secrets.brute_cost(part))
        for text, extra in ((low, 0.0), (plain, 0.6)):
            if b - a > 1 and text[a:b] in words:
                costs.append(math.log10(2 * words[text[a:b]]) + extra + (0.0 if part == low[a:b] else 0.3))
        if (m := secrets.DATE.match(value, a)) and m.end() == b:
            costs.append(2.1 if b - a == 4 else 4.6)
        steps = [secrets.STEPS.get(keys[i:i + 2]) for i in range(a, b - 1)]
        if len(steps) >= 2 and None not in steps:
            costs.append(2.0 + math.log10(b - a) + 0.9 * sum(x != y for x, y in zip(steps, steps[1:])))
        for size in range(1, (b - a) // 2 + 1):
            if b - a >= max(3, 2 * size) and all(value[i] == value[i + size] for i in range(a, b - size)):
                costs.append(sum(map(secrets.brute_cost, value[a:a + size])) + math.log10((b - a) / size))
        return min(costs, default=math.inf)

    best = [0.0] + [math.inf] * len(value)
    for mask in range(1 << max(len(value) - 1, 0)):  # every way to cut
        cuts = [0, *(k for k in range(1, len(value)) if mask >> k - 1 & 1), len(value)]
        best[-1] = min(best[-1], sum(single(a, b) for a, b in zip(cuts, cuts[1:])))
    return best[-1]


def test_guess_cost_equals_all_segmentations():
    words = secrets.Dictionary(["apple", "pie", "sun", "un", "as"])
    parts = ["apple", "Pie", "p1e", "sun", "1999", "qaz", "wsx", "qwe", "!@#", "aaa", "abab", "x", "7", "Z", "-"]
    for _ in range(120):
        value = "".join(RNG.choice(parts, RNG.integers(1, 4)))[:10]
        assert secrets.guess_cost(value, words=words) == pytest.approx(cheapest(value, words)), value


def test_passwords_of_letters_are_found_and_prose_stays(spark):
    words = "harmonious conditions straightforward remembering incorrect".split()
    rows = [(k, f"{words[k % 5]} {prose(20)} {words[(k + 2) % 5]}") for k in range(40)]
    for k, v in enumerate(("correcthorsebatterystaple", "kalimotepuradisowe", "Zyxaqobuventi")):
        rows += [(100 + 10 * k + c, f"the password is {v} today") for c in range(4)]  # copies do not make it a word
    rows += [(200, "the password is incorrect"), (201, "a secret is remembering harmonious"), (202, "token: straightforward"), (203, None), (204, "pwd: qazwsxedc")]
    got = {r["doc_id"]: r["n_guess"] for r in secrets.scan(frame(spark, rows)).collect()}
    assert all(got[100 + 10 * k + c] == 1 for k in range(3) for c in range(4))
    assert [got[k] for k in (200, 201, 202, 203, 204)] == [0, 0, 0, 0, 0] and not any(got[k] for k in range(40))


# languages, toxicity


def test_languages_of_held_out_rows_are_not_counted(spark, monkeypatch):
    rows = [(k, prose(30), "held" if language.held_out is None else "en") for k in range(300)]
    marked = frame(spark, rows).withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("only-held-out")).otherwise(F.col("lang")))
    model = language.train(language.training_sample(marked))
    assert model.languages == ["en"] or list(model.languages) == ["en"]
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    many = frame(spark, [(k, prose(20), f"l{k % 7}") for k in range(400)] + [(1000 + k, prose(20), "l0") for k in range(60)])
    learned = {lang for _, lang in language.training_sample(many)}
    assert len(learned) == 3 and "l0" in learned


def test_language_of_a_very_long_text(spark):
    rows = [(k, prose(30), "en") for k in range(60)] + [(100 + k, "ñandú " * 30, "es") for k in range(60)] + [(500, prose(120_000), None), (501, None, None), (502, "123", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.language(frame(spark, rows)).collect()}
    assert got[500] == "en" and got[501] == got[502] == language.UNKNOWN


def test_few_labels_on_one_side():
    x, y = RNG.normal(size=(6, toxicity.N_FEATURES)), np.array([0.0, 1, 0, 1, 1, 0])
    for pick in (np.ones(6, bool), np.zeros(6, bool), y > 0):
        m = toxicity.fit(x, y, pick)
        assert np.isfinite(toxicity.margins(m, x)).all() and len(m.steps_x)


# pages


BODY = "".join(f"<p>Sentence number {k}, about the river and the town, which is long enough to read as prose.</p>" for k in range(6))


@pytest.mark.parametrize("head", ["<head><title>x</title><body>", '<svg width="3"/>', '<iframe src="a"/>', "<iframe src='a'>", "<button>", "<object data=x>", "<select>"])
def test_markup_left_open_swallows_nothing(head):
    model = main_text.train([])
    text = main_text.main_text(f"<html>{head}<article>{BODY}</article></html>", model)
    assert text.count("Sentence number") == 6 and "<" not in text


def test_quotes_left_open_end_with_the_tag():
    page = main_text.parse(f'<article><p class="a>Second</p><p title="1 > 0" class=\'b\'>Third</p><p data-x="<b>k</b>">Fourth</p>{BODY}</article>')
    texts = [t for _, t in page.spans]
    assert texts[:3] == ["Second", "Third", "Fourth"]


def test_long_and_deep_pages_take_linear_time():
    deep = "<div>" * 20_000 + "<span>word</span></p>" * 20_000 + "<button>" * 20_000 + '<p class="' * 2000
    page = main_text.parse(deep)
    assert sum(t.count("word") for _, t in page.spans) == 20_000
    assert main_text.main_text("x " * 1_500_000, main_text.train([])) is not None
