"""Cleaning, encoding, order statistics, sampling and sources on small and awkward inputs."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.ordered import exact_quantiles, key_cuts, running_sums
from sparkmine.lineage import scratch_path, small_table
from sparkmine.operators import cleaning, eda, encoding, reduction, sampling
from sparkmine.plans.preprocess import PreprocessConfig, Preprocessor
from sparkmine.sources import tables


def values(spark, n=5000, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(3, 2, n), 2)
    x[: n // 3] = 7.5  # a hot value
    return x, spark.createDataFrame([(int(i % 3), float(v) if i % 11 else None) for i, v in enumerate(x)], "g int, x double").repartition(7)


@pytest.mark.parametrize("by", [None, "g"])
def test_quantiles_by_brackets_equal_numpy(spark, by):
    x, df = values(spark)
    qs = [0.0, 0.1, 0.5, 0.77, 0.999, 1.0]
    got = exact_quantiles(df, ["x"], qs, by, small=0, accuracy=200)
    kept = np.arange(len(x)) % 11 != 0
    for g in [None] if by is None else [0, 1, 2]:
        mine = x[kept & ((np.arange(len(x)) % 3 == g) if by else True)]
        assert np.allclose(got[(g, "x")], np.quantile(mine, qs), rtol=0, atol=1e-9)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "g int, x double")
    assert exact_quantiles(df, ["x"], [0.5])[(None, "x")] == [None]


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_ranges(spark, descending):
    x, df = values(spark)
    counts = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    small = running_sums(counts, ["g"], "x", ["n"], descending=descending)
    ranged = running_sums(counts, ["g"], "x", ["n"], descending=descending, rows_per_window=50)
    assert sorted(map(tuple, small.select("g", F.coalesce("x", F.lit(-1.0)), "cum_n").collect())) == sorted(
        map(tuple, ranged.select("g", F.coalesce("x", F.lit(-1.0)), "cum_n").collect()))
    assert running_sums(counts.filter("x IS NOT NULL").groupBy("x").agg(F.sum("n").alias("n")), [], "x", ["n"], rows_per_window=50).agg(F.max("cum_n")).first()[0] == df.filter("x IS NOT NULL").count()


def test_ranges_stay_few_however_small_the_window(spark, monkeypatch):
    """One range costs a task and a file, so ten times the rows must not make ten times the ranges."""
    monkeypatch.setattr("sparkmine.functions.ordered.MAX_RANGES", 16)
    made = []
    real = DataFrame.repartitionByRange
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda self, n, *c: made.append(n) or real(self, n, *c))
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("n"))
    got = running_sums(df, ["g"], "id", ["n"], rows_per_window=10)
    assert got.filter(F.col("cum_n") != F.floor(F.col("id") / 2) + 1).isEmpty() and got.count() == 3000 and made == [16]


@pytest.mark.parametrize("small", [1, 100_000])
def test_key_cuts(spark, small):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**60, 3000)
    df = spark.createDataFrame([(int(i % 2), int(k)) for i, k in enumerate(keys)], "g int, k bigint")
    got = key_cuts(df, "k", {0: 10, 1: 1400}, by="g", bits=60, small=small)
    assert got == {g: int(np.sort(keys[np.arange(3000) % 2 == g])[n - 1]) for g, n in ((0, 10), (1, 1400))}


def test_sampling_counts(spark):
    df = spark.range(5000).withColumn("label", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, "b").otherwise("c"))
    assert sampling.sample_exact(df, 777, id_col="id").count() == 777
    assert sampling.sample_exact(df, 9999, id_col="id").count() == 5000
    assert sampling.sample_exact(df, 0, id_col="id").count() == 0
    split = sampling.stratified_split(df, id_col="id", label_col="label", test_share=0.25)
    for r in split.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        assert abs(r["t"] - 0.25 * r["n"]) <= 0.5
    moved = sampling.stratified_split(df.repartition(13), id_col="id", label_col="label", test_share=0.25)
    assert split.exceptAll(moved).isEmpty()
    folds = sampling.kfold(df, 4, id_col="id").groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2, 3} and all(1100 < r["count"] < 1400 for r in folds)
    drawn = sampling.bootstrap(spark.range(20000), 2, id_col="id").groupBy("tree").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("u")).collect()
    assert all(abs(r["n"] / 20000 - 1) < 0.03 and abs(r["u"] / 20000 - (1 - np.exp(-1))) < 0.02 for r in drawn)


def test_missing_rules_differ_at_the_boundary(spark):
    df = spark.createDataFrame([(i, None if i < 5 else 1.0, None if i < 6 else 1.0) for i in range(10)], "id int, half double, most double")
    assert cleaning.kept_columns(df, min_present=0.4) == ["id", "half", "most"]
    assert cleaning.kept_columns(df, max_missing=0.5) == ["id", "half"]
    assert cleaning.kept_columns(df.limit(0), max_missing=0.5) == ["id", "half", "most"]


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "id int, c double, e double")
    assert [r["c"] for r in encoding.standardise(df, ["c"]).collect()] == [0.0, 0.0]
    assert cleaning.medians(df, ["c", "e"]) == {"c": 5.0, "e": 0.0}
    assert [r["n"] for r in eda.histogram(df, ["c"], 4).orderBy("bin").collect()] == [0, 0, 2, 0]


def test_one_hot_drops_the_first_and_zeroes_the_unseen(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, v string")
    model, kept = encoding.fit_one_hot(df, ["v"])
    assert kept == {"v": ["b", "c"]}
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "z"), (5, None)], "id int, v string")
    got = {r["id"]: r["h"] for r in model.transform(new).select("id", vector_to_array("v_hot").alias("h")).collect()}
    assert got == {1: [0, 0], 2: [1, 0], 3: [0, 1], 4: [0, 0], 5: [0, 0]}


def test_label_codes_are_sorted(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "B", "a", None, "b"])], "id int, v string")
    got = {r["id"]: r["code"] for r in encoding.label_encode(df, "v", into="code").collect()}
    assert got == {0: 2, 1: 0, 2: 1, 3: None, 4: 2}


def test_preprocessor_on_unseen_rows(spark):
    rows = [(i, f"s{i % 3}", f"m{i % 12:02d}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, few string, many string, num double")
    prep = Preprocessor(PreprocessConfig.default("id")).fit(df)
    assert prep.features == ["few", "num"] + [f"many_m{i:02d}" for i in range(1, 12)]
    new = spark.createDataFrame([(100, "s1", "new", 29.5)], df.schema)
    x = prep.transform(new).select(vector_to_array("features").alias("x")).first()["x"]
    assert x[1] == pytest.approx(0.0) and x[2:] == [0.0] * 11


def test_pca_is_orthonormal_and_centred(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + 100
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, x array<double>")
    p = reduction.fit_pca(df, x_col="x", k=3)
    assert np.allclose(p.loadings.T @ p.loadings, np.eye(3))
    z = np.array([r["pc"] for r in p.transform(df, "x").collect()])
    assert np.allclose(z.mean(0), 0, atol=1e-9)
    cov = np.cov(x.T)
    assert np.allclose(z.var(0, ddof=1), np.sort(np.linalg.eigvalsh(cov))[::-1][:3])
    assert np.allclose(p.ratios, np.sort(np.linalg.eigvalsh(cov))[::-1][:3] / np.trace(cov))


def test_stacked_lookup_file(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text('kind_id,description\n1,Plain\n2,"With, comma"\n3,NULL\n,\nplace_id,description\n1, Leading space\n30,Last\n')
    got = {(r["code_type"], r["code"]): r["description"] for r in tables.read_stacked_lookup(spark, str(path)).collect()}
    assert got == {("kind_id", "1"): "Plain", ("kind_id", "2"): "With, comma", ("kind_id", "3"): None,
                   ("place_id", "1"): "Leading space", ("place_id", "30"): "Last"}


def test_results_as_parquet(spark):
    path = scratch_path(spark, "results")
    tables.write_results(small_table(spark, [(3, 0.5)], "k int, score double"), path, fmt="parquet")
    assert spark.read.parquet(path).first()["score"] == 0.5


def test_ranges_keep_null_groups_and_sort_strings(spark):
    rows = [(None if k % 4 == 0 else k % 4, f"v{(k * 37) % 500:03d}", 1) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, v string, n int").repartition(3)
    for by in ([], ["g"]):
        read = lambda d: sorted((r["g"] if r["g"] is not None else -1, r["v"], r["cum_n"]) for r in d.collect())
        assert read(running_sums(df, by, "v", ["n"], rows_per_window=20)) == read(running_sums(df, by, "v", ["n"]))
    assert exact_quantiles(df.select(F.col("n").cast("double").alias("x"), "g"), ["x"], [0.5], "g", small=0, accuracy=50, rows_per_window=5)[(None, "x")] == [1.0]


def test_null_classes_are_split(spark):
    df = spark.range(1500).withColumn("label", F.when(F.col("id") % 10 >= 3, F.col("id") % 2))
    split = sampling.stratified_split(df, id_col="id", label_col="label")
    assert split.count() == 1500 and split.filter("label is null and is_test").count() == 90


def test_scope_drops_scratch_tables(spark):
    import os

    from sparkmine.lineage import cut, scratch_scope

    with scratch_scope(spark):
        kept = cut(spark.range(5))
        path = kept.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists("/" + path)
    assert not os.path.exists("/" + path)


def test_folds_must_match(spark):
    from sparkmine.operators import tuning

    df = spark.range(30).withColumn("fold", F.col("id") % 3).withColumn("label", F.lit(1))
    with pytest.raises(ValueError, match="n_folds"):
        tuning.cross_validate(df, lambda tr, te, p, f: te.withColumn("prediction", F.lit(1)), [{}], fold_col="fold", label_col="label", n_folds=2)
