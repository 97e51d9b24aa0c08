"""Benchmark decontamination on question templates, with DataFrame functions only.

Numbers, names and units become typed placeholders; windows of template tokens of the benchmark are hash-joined
with the windows of all documents; what matches is aligned, and the fillers of the slots must map consistently
from item to document, so a question asked again with other values is caught and a chance match of a bare pattern
is not. Literal windows of the same width (words in lower case, fillers included) go through the same join: a document
that holds an item, or a long enough run of it, word for word is caught whatever the placeholders make of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.common import kept

WINDOW, LEAST = 8, 4
#: share of the windows of an item that a document must hold, or so many of them
COVERAGE, ENOUGH = 0.5, 12
#: words of an item in a row that pass by themselves, word for word; of a shorter item all of them
VERBATIM = 13
#: share of the fillers that an item repeats which must keep one value in the document
CONSISTENT = 0.7
#: rows that may be broadcast: windows of the benchmark, matched pairs (a few dozen bytes each)
BROADCAST_ROWS = 200_000
NUMBER, NAME, UNIT = "①", "②", "③"
UNITS = (
    "percent|kilometers?|kilometres?|kilograms?|centimeters?|meters?|metres?|grams?|liters?|litres?|miles?|inches|inch|feet|foot|pounds?|ounces?|hours?|minutes?|seconds?|"
    "days?|weeks?|months?|years?|dollars?|euros?|cents?|degrees?|kmh|km|kg|cm|mm|mg|ml|lbs?|oz|mph|mi|ft|hrs?|mins?|secs?|usd|eur|m|g|l|h|s")


def tokens(text: Column, *, fillers: bool = False) -> Column:
    """Template tokens of a text; with ``fillers`` a placeholder is followed by what it stands for.

    A name is a capitalised word after a word that does not end a sentence. Both forms have the same number of tokens.
    """
    one, two = ("$1", "$2") if fillers else ("", "")
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(t, r"(\d)[.,:/](?=\d)", "$1·")
    t = F.regexp_replace(t, rf"(?<=[\p{{L}}\p{{N}},;]\s)(\p{{Lu}}\p{{Ll}}+)(?=[\s.,;:!?'\)]|$)", f" {NAME}{one} ")
    t = F.regexp_replace(t, rf"(\d[\d·]*)\s?(?i:({UNITS}))\b", f" {NUMBER}{one} {UNIT}{two} ")
    t = F.regexp_replace(t, r"(?<![①②③\d·])(\d[\d·]*)", f" {NUMBER}{one} ")
    return F.split(F.lower(t), rf"[^\p{{L}}\p{{Nd}}·{NUMBER}{NAME}{UNIT}]+")


def literals(text: Column) -> Column:
    """Words of a text in lower case: runs of letters and digits, the values that templates replace among them."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _windows(hashes: Column, lengths: dict[int, int], kind: int = 0) -> Column:
    """``(hash, pos, kind)`` of the windows of each length, at every position or every few; the array is bound once, not repeated in each window."""

    def of_length(h: Column, k: int, step: int) -> Column:
        window = lambda i: F.struct(F.xxhash64(F.slice(h, i, F.lit(k)), F.lit(k + 100 * kind)).alias("w"), i.alias("pos"), F.lit(kind).alias("kind"))
        return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(1), F.size(h) - k + 1, F.lit(step)), window)).otherwise(
            F.array().cast("array<struct<w:bigint,pos:int,kind:int>>"))

    return F.flatten(F.transform(F.array(hashes), lambda h: F.concat(F.array().cast("array<struct<w:bigint,pos:int,kind:int>>"), *(of_length(h, k, s) for k, s in lengths.items()))))


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table only if its counted rows stay under the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``w, item_id, ipos, n_windows``: distinct windows of each item that are not mostly placeholders.

    An item shorter than a window is one window of its own length; below four tokens it cannot be matched. An item that
    starts with a capital has its first window twice, with the first word as it is and as a name, as the word before it
    in a document decides which it is there.
    """
    base = benchmark.filter("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    t = F.filter(tokens(F.col("text")), lambda x: x != "")
    rows = base.select("item_id", t.alias("t"), F.col("text").rlike(r"^\s*\p{Lu}\p{Ll}").alias("capital")).filter(F.size("t") >= LEAST).withColumn(
        "k", F.least(F.size("t"), F.lit(WINDOW)))
    at = rows.select("item_id", "k", "t", "capital", F.explode(F.sequence(F.lit(1), F.size("t") - F.col("k") + 1)).alias("ipos"))
    part = F.slice("t", F.col("ipos"), F.col("k"))
    named = F.when((F.col("ipos") == 1) & F.col("capital"), F.array(part, F.concat(F.array(F.lit(NAME)), F.slice("t", F.lit(2), F.col("k") - 1))))
    at = at.select("item_id", "k", "ipos", F.explode(F.coalesce(named, F.array(part))).alias("part"))
    part = F.col("part")
    literal = F.size(F.filter(part, lambda x: ~x.isin(NUMBER, NAME, UNIT)))
    win = at.filter(literal * 2 >= F.col("k")).select(
        "item_id", "k", F.xxhash64(F.transform(part, lambda x: F.xxhash64(x)), F.col("k")).alias("w"), "ipos")
    win = win.groupBy("item_id", "k", "w").agg(F.min("ipos").alias("ipos"))
    size = win.groupBy("item_id").agg(F.count_distinct("ipos").alias("n_windows"))
    return win.join(size, "item_id")


def literal_windows(benchmark: DataFrame) -> DataFrame:
    """``w, k, item_id, ipos, n_words``: the same over the words of each item, every window of them."""
    base = benchmark.filter("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    rows = base.select("item_id", literals(F.col("text")).alias("t")).filter(F.size("t") >= LEAST).withColumn("k", F.least(F.size("t"), F.lit(WINDOW)))
    at = rows.select("item_id", "k", F.size("t").alias("n_words"), "t", F.explode(F.sequence(F.lit(1), F.size("t") - F.col("k") + 1)).alias("ipos"))
    hashes = F.transform(F.slice("t", F.col("ipos"), F.col("k")), lambda x: F.xxhash64(x))
    return at.select("item_id", "k", "n_words", F.xxhash64(hashes, F.col("k") + 100).alias("w"), "ipos")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, kind, shift, hits, first, last, n_windows``: aligned runs of matching windows, literal ones of kind 1.

    A run of ``VERBATIM`` words, or a whole shorter item, holds a literal window at every step of that length, so the
    documents need not be hashed at every word; every item window is there to meet it.
    """
    win = kept(item_windows(benchmark), "windows")
    lit = kept(literal_windows(benchmark), "literals")
    lengths = {r["k"]: 1 for r in win.select("k").distinct().orderBy("k").collect()}  # at most WINDOW - LEAST + 1 values
    step = F.greatest(F.least(F.min("n_words"), F.lit(VERBATIM)) - F.col("k") + 1, F.lit(1))
    steps = {r["k"]: r["step"] for r in lit.groupBy("k").agg(step.alias("step")).orderBy("k").collect()}
    hashes = lambda words: F.transform(words, lambda x: F.xxhash64(x))
    both = F.concat(_windows(hashes(tokens(F.col("text"))), lengths or {WINDOW: 1}), _windows(hashes(literals(F.col("text"))), steps, 1))
    spread = docs.filter("doc_id is not null").select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.w", "x.pos", "x.kind")
    items = win.select("w", "item_id", "ipos", "n_windows", F.lit(0).alias("kind")).union(
        lit.select("w", "item_id", "ipos", (F.col("n_words") - F.col("k") + 1).alias("n_windows"), F.lit(1).alias("kind")))
    hit = spread.join(_small(items), ["w", "kind"])
    return hit.groupBy("doc_id", "item_id", "kind", (F.col("pos") - F.col("ipos")).alias("shift")).agg(
        F.count_distinct("ipos").alias("hits"), F.min("ipos").alias("first"), F.max("ipos").alias("last"), F.max("n_windows").alias("n_windows"))


def verbatim(docs: DataFrame, benchmark: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, n_windows``: pairs of ``found`` with enough words of the item in a row, word for word.

    ``found`` are aligned literal hits ``(doc_id, item_id, shift, n_windows)``; along each alignment the texts are compared word by word.
    """
    wanted = _small(kept(found.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "shift", "n_windows")).alias("p")), "wanted"))
    texts = docs.select("doc_id", F.col("text").alias("doc_text")).filter("doc_text is not null").join(wanted, "doc_id")
    one = texts.groupBy("doc_id").agg(F.min(F.struct("doc_text", "p")).alias("s")).select(
        "doc_id", literals(F.col("s.doc_text")).alias("d"), F.explode("s.p").alias("p")).select("doc_id", "d", "p.*")
    items = benchmark.filter("item_id is not null").groupBy("item_id").agg(F.min("text").alias("t")).select("item_id", literals(F.col("t")).alias("b"))
    both = one.join(_small(kept(items, "items")), "item_id")
    place = F.sequence(F.lit(1), F.size("b"))
    same = F.transform(place, lambda i: F.coalesce(F.try_element_at("b", i) == F.try_element_at("d", F.when(i + F.col("shift") > 0, i + F.col("shift"))), F.lit(False)))
    grow = lambda s, x: F.struct(F.when(x, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["most"], F.when(x, s["now"] + 1).otherwise(0)).alias("most"))
    run = F.aggregate(same, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), grow, lambda s: s["most"])
    judged = both.select("doc_id", "item_id", "n_windows", F.size("b").alias("n"), run.alias("run")).filter(F.col("run") >= F.least(F.col("n"), F.lit(VERBATIM)))
    return judged.groupBy("doc_id", "item_id").agg(F.max(F.col("run") / F.col("n")).alias("coverage"), F.max("n_windows").alias("n_windows"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, n_windows, kind`` for each document that holds a benchmark item or its template.

    ``kind`` is ``exact`` if all fillers agree or a run of the item stands there word for word, else ``reparameterised``;
    ``coverage`` is the share of the item's windows, or the share of its words in the longest such run if that is more. A null
    text or id matches nothing; an id that repeats, on either side, counts once (the smallest text of an item). An empty
    table on either side gives no rows. Texts are searched whole; a copy broken by insertions is still found, as its
    parts are summed.
    """
    every = kept(matches(docs, benchmark), "found")
    literal = verbatim(docs, benchmark, every.filter("kind = 1").select("doc_id", "item_id", "shift", "n_windows"))
    found = every.filter("kind = 0").drop("kind")
    near = found.filter("hits >= least(2, n_windows)")
    total = F.sum("hits").over(Window.partitionBy("doc_id", "item_id"))
    enough = lambda t: (F.col(t) >= F.ceil(COVERAGE * F.col("n_windows"))) | (F.col(t) >= ENOUGH)
    passed = near.withColumn("total", F.least(total, F.col("n_windows"))).filter(enough("total"))
    # runs in document order that go on in the item are parts of one copy; a run that goes back begins another
    order = Window.partitionBy("doc_id", "item_id").orderBy(F.col("shift") + F.col("first"), "shift")
    back = F.coalesce((F.col("first") <= F.lag("last").over(order)).cast("int"), F.lit(0))
    passed = passed.withColumn("back", back).withColumn("copy", F.sum("back").over(order)).drop("back")
    own = F.sum("hits").over(Window.partitionBy("doc_id", "item_id", "copy"))
    passed = passed.withColumn("own", F.least(own, F.col("n_windows")))
    passed = kept(passed, "matches")
    texts = docs.select("doc_id", F.col("text").alias("doc_text")).filter("doc_text is not null")
    wanted = _small(kept(passed.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift", "copy", "first", "last")).alias("p")), "wanted"))
    doc_side = texts.join(wanted, "doc_id").groupBy("doc_id").agg(F.min(F.struct("doc_text", "p")).alias("s")).select(
        "doc_id", tokens(F.col("s.doc_text"), fillers=True).alias("d"), F.explode("s.p").alias("p")).select("doc_id", "d", "p.*")
    items = benchmark.filter("item_id is not null").groupBy("item_id").agg(F.min("text").alias("item_text"))
    items = kept(items.select("item_id", F.filter(tokens(F.col("item_text"), fillers=True), lambda x: x != "").alias("b")), "items")
    both = doc_side.join(_small(items), "item_id")
    # fillers that stand opposite each other in the aligned part
    span = F.sequence(F.col("first"), F.least(F.col("last") + WINDOW - 1, F.size("b"), F.size("d") - F.col("shift")))
    slots = F.filter(
        F.transform(span, lambda i: F.struct(F.try_element_at("b", i).alias("b"), F.try_element_at("d", i + F.col("shift")).alias("d"))),
        lambda s: F.substring(s["b"], 1, 1).isin(NUMBER, NAME, UNIT) & (F.substring(s["b"], 1, 1) == F.substring(s["d"], 1, 1)))
    # every copy that is enough by itself is judged; all runs together (copy -1) only where none is
    each = F.explode(F.array(F.col("copy"), F.lit(-1)))
    key = ["doc_id", "item_id", "copy"]
    aligned = both.select(*key, slots.alias("s")).withColumn("copy", each)
    filled = aligned.select(*key, F.explode("s").alias("s")).groupBy(*key, "s.b").agg(
        F.count_distinct("s.d").alias("values"), F.min(F.col("s.d")).alias("value"), F.count(F.lit(1)).alias("times"))
    kinds = filled.groupBy(*key).agg(
        F.avg(F.when(F.col("times") > 1, (F.col("values") == 1).cast("double"))).alias("consistent"),
        F.min(((F.col("values") == 1) & (F.col("value") == F.col("b"))).cast("int")).alias("same"))
    copies = passed.select("doc_id", "item_id", "total", "n_windows", "own", each.alias("copy")).groupBy(*key).agg(
        F.max("total").alias("total"), F.max("n_windows").alias("n_windows"), F.max("own").alias("own"))
    good = copies.filter((F.col("copy") < 0) != enough("own")).join(kinds, key, "left").filter(F.coalesce("consistent", F.lit(1.0)) >= CONSISTENT)
    judged = good.groupBy("doc_id", "item_id").agg(
        F.max("total").alias("total"), F.max("n_windows").alias("n_windows"), F.max(F.coalesce("same", F.lit(1))).alias("same"))
    told = judged.select("doc_id", "item_id", (F.col("total") / F.col("n_windows")).alias("coverage"), "n_windows", "same", F.lit(1).alias("template")).union(
        literal.select("doc_id", "item_id", "coverage", "n_windows", F.lit(1), F.lit(0)))
    return told.groupBy("doc_id", "item_id").agg(
        F.round(F.max("coverage"), 6).alias("coverage"), F.max_by("n_windows", "template").cast("long").alias("n_windows"),
        F.when(F.max("same") == 1, "exact").otherwise("reparameterised").alias("kind"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows with a null id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
