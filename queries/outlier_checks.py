"""Checks for outlier detection and feature selection."""

from pyspark.sql import functions as F

from queries.base import EMB_LONG, EMB_PAIRS, THREE, USERS, check, embeddings, three_class, user_features
from queries.preparation import _plain_users
from sparkmine.lineage import cut, small_table
from sparkmine.operators import classify, feature_select, outliers, reduction
from sparkmine.operators.sampling import stratified_split

# -- elliptic envelope ---------------------------------------------------------


@check("envelope_covariance", "i:i j:i mean:6 covariance:6", f"""WITH {EMB_LONG}, m AS (SELECT dim, avg(v) AS m FROM emb_long GROUP BY dim),
  c AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.v, b.v) AS c FROM emb_long a JOIN emb_long b USING (id) GROUP BY 1, 2)
  SELECT i, j, m AS mean, c + CASE WHEN i = j THEN 1e-6 ELSE 0 END AS covariance FROM c JOIN m ON i = dim""")
def _(spark, d):
    env = outliers.fit_envelope(embeddings(spark, d), x_col="x", contamination=0.05)
    rows = [(i, j, env.location[i], v) for i, row in enumerate(env.covariance) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "i int, j int, mean double, covariance double")


_ENV = USERS + """, c AS (SELECT avg(n_events) AS mx, avg(avg_value) AS my, covar_samp(n_events, n_events) + 1e-6 AS a, covar_samp(n_events, avg_value) AS b,
    covar_samp(avg_value, avg_value) + 1e-6 AS e FROM users),
  dist AS MATERIALIZED (SELECT id, sqrt(greatest((e * (n_events - mx) ** 2 - 2 * b * (n_events - mx) * (avg_value - my) + a * (avg_value - my) ** 2) / (a * e - b * b), 0)) AS distance FROM users, c),
  env AS MATERIALIZED (SELECT id, distance, t - distance AS score, CASE WHEN t - distance >= 0 THEN 1 ELSE -1 END AS prediction, t - distance < 0 AS is_outlier
    FROM dist, (SELECT quantile_cont(distance, 0.95) AS t FROM dist))"""


def _envelope(spark, d):
    x = _plain_users(spark, d)
    return outliers.fit_envelope(x, x_col="x", contamination=0.05).score(x, id_col="id", x_col="x").withColumn("is_outlier", F.col("prediction") == -1)


@check("envelope_scores", "id:i distance:6 score:6 prediction:i", f"WITH {_ENV} SELECT id, distance, score, prediction FROM env")
def _(spark, d):
    return _envelope(spark, d)


_THRESHOLDS = f"WITH {_ENV} " + " UNION ALL ".join(
    f"SELECT {c} AS contamination, quantile_cont(distance, {1 - c}) AS threshold FROM dist" for c in (0.01, 0.05, 0.1))


def _thresholds(spark, d, **sizes):
    scored = cut(_envelope(spark, d))
    return small_table(spark, [(c, outliers.upper_threshold(scored, "distance", c, **sizes)) for c in (0.01, 0.05, 0.1)], "contamination double, threshold double")


@check("contamination_threshold", "contamination:3 threshold:6", _THRESHOLDS)
def _(spark, d):
    return _thresholds(spark, d)


@check("contamination_threshold_ranged", "contamination:3 threshold:6", _THRESHOLDS)
def _(spark, d):
    return _thresholds(spark, d, small=0, accuracy=100, rows_per_window=10)


@check("outlier_summary", "method:s n_rows:i n_outliers:i share:6 min_score:6 max_score:6 avg_score:6", f"""WITH {_ENV}
  SELECT 'envelope' AS method, count(*) AS n_rows, count(*) FILTER (is_outlier) AS n_outliers, count(*) FILTER (is_outlier) / count(*) AS share,
    min(score) AS min_score, max(score) AS max_score, avg(score) AS avg_score FROM env""")
def _(spark, d):
    return outliers.outlier_summary(_envelope(spark, d), "envelope")


@check("most_extreme", "id:i score:6", f"WITH {_ENV} SELECT id, score FROM env ORDER BY score, id LIMIT 5")
def _(spark, d):
    return outliers.most_extreme(_envelope(spark, d))


# -- local outlier factor ------------------------------------------------------

_LOF = """nn AS MATERIALIZED (SELECT id, neighbor, d FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbor) <= 20),
  kd AS (SELECT id, max(d) AS kd FROM nn GROUP BY id),
  lrd AS (SELECT nn.id, 1.0 / (avg(greatest(kd, d)) + 1e-10) AS lrd FROM nn JOIN kd ON kd.id = neighbor GROUP BY nn.id),
  lof AS (SELECT nn.id, avg(b.lrd) / any_value(a.lrd) AS lof FROM nn JOIN lrd b ON b.id = neighbor JOIN lrd a ON a.id = nn.id GROUP BY nn.id)"""


@check("local_outlier_factor", "id:i lof:5", f"WITH {EMB_PAIRS}, {_LOF} SELECT id, lof FROM lof")
def _(spark, d):
    return outliers.local_outlier_factor(embeddings(spark, d), id_col="id", x_col="x", k=20)


@check("lof_outliers", "id:i score:5 is_outlier:b sampled:b", f"""WITH {EMB_PAIRS}, {_LOF}, t AS (SELECT quantile_cont(-lof, 0.05) AS t FROM lof)
  SELECT id, -lof AS score, -lof < t AS is_outlier, true AS sampled FROM lof, t""")
def _(spark, d):
    return outliers.lof_outliers(embeddings(spark, d), id_col="id", x_col="x", k=20, contamination=0.05)


@check("isolation_forest", "id:i anomaly:6 score:6 is_outlier:b")
def _(spark, d):
    return outliers.isolation_forest(embeddings(spark, d), id_col="id", x_col="x", contamination=0.05)


# -- overlap -------------------------------------------------------------------

_METHODS = ("avg_value", "n_error", "n_events")
_FLAGS = USERS + ", flags AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT '{m}' AS method, id FROM users WHERE {m} > (SELECT quantile_cont({m}, 0.9) FROM users)" for m in _METHODS) + ")"


def _flags(spark, d):
    u = user_features(spark, d)
    return outliers.flags({m: u.select("id", (F.col(m) > outliers.upper_threshold(u, m, 0.1)).alias("is_outlier")) for m in _METHODS})


@check("overlap_pairs", "method_a:s method_b:s n_both:i n_either:i jaccard:6", f"""WITH {_FLAGS},
  m AS (SELECT DISTINCT method FROM flags), p AS (SELECT a.method AS method_a, b.method AS method_b FROM m a JOIN m b ON a.method < b.method)
  SELECT method_a, method_b, n_both, n_either, CASE WHEN n_either > 0 THEN n_both / n_either ELSE 0 END AS jaccard FROM (SELECT method_a, method_b,
    (SELECT count(*) FROM (SELECT id FROM flags WHERE method = method_a INTERSECT SELECT id FROM flags WHERE method = method_b)) AS n_both,
    (SELECT count(*) FROM (SELECT id FROM flags WHERE method = method_a UNION SELECT id FROM flags WHERE method = method_b)) AS n_either FROM p)""")
def _(spark, d):
    return outliers.pairwise_overlap(_flags(spark, d), _METHODS)


# counts that go together, so that some users stand out by all of them
_TOGETHER = ("n_events", "n_view", "n_click")


@check("overlap_common", "id:i", "WITH " + USERS + ", flags AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT '{m}' AS method, id FROM users WHERE {m} > (SELECT quantile_cont({m}, 0.7) FROM users)" for m in _TOGETHER) + ") SELECT id FROM flags GROUP BY id HAVING count(*) = 3")
def _(spark, d):
    u = user_features(spark, d)
    flagged = outliers.flags({m: u.select("id", (F.col(m) > outliers.upper_threshold(u, m, 0.3)).alias("is_outlier")) for m in _TOGETHER})
    return outliers.common_outliers(flagged, len(_TOGETHER))


@check("overlap_unique", "id:i method:s", f"WITH {_FLAGS} SELECT id, min(method) AS method FROM flags GROUP BY id HAVING count(*) = 1")
def _(spark, d):
    return outliers.unique_outliers(_flags(spark, d))


@check("flagged_projection", "id:i pc1:4 pc2:4 score:5 is_outlier:b")
def _(spark, d):
    e = embeddings(spark, d)
    projected = reduction.fit_pca(e, x_col="x", k=2).coordinates(e, id_col="id", x_col="x")
    return outliers.flagged_projection(projected, outliers.lof_outliers(e, id_col="id", x_col="x", k=20, contamination=0.05), id_col="id")


# -- feature selection ---------------------------------------------------------

_NAMES = [f"x{i}" for i in range(64)]


def _vectors(spark, d):
    return classify.with_vector(embeddings(spark, d), "x").select("id", "x", "features", "label")


@check("select_l1", "feature:s score:4 selected:b")
def _(spark, d):
    v = _vectors(spark, d)
    return feature_select.select_l1(v, _NAMES, features_col="features", label_col="label", C=0.1).table(v)


@check("select_recursive", "feature:s score:1 selected:b")
def _(spark, d):
    v = _vectors(spark, d)
    return feature_select.select_recursive(v, _NAMES, features_col="features", label_col="label", n_features=20, step=15).table(v)


_BINS = THREE + ", " + ", ".join(
    f"e_{c} AS (SELECT list_distinct(quantile_cont({c}, [{', '.join(str(i / 10) for i in range(1, 10))}])) AS e FROM three)" for c in ("price", "cust")) + """,
  long AS MATERIALIZED (SELECT 'priority' AS feature, priority AS value, label FROM three WHERE priority IS NOT NULL
    UNION ALL SELECT 'price', CAST(len(list_filter(e, lambda q: q < price)) AS VARCHAR), label FROM three, e_price
    UNION ALL SELECT 'cust', CAST(len(list_filter(e, lambda q: q < cust)) AS VARCHAR), label FROM three, e_cust),
  joint AS (SELECT feature, value, label, count(*) AS n FROM long GROUP BY ALL),
  mi AS MATERIALIZED (SELECT feature, greatest(sum(n / total * ln(n * total / (nx * ny))), 0) AS score FROM (SELECT feature, n, sum(n) OVER (PARTITION BY feature, value) AS nx,
    sum(n) OVER (PARTITION BY feature, label) AS ny, sum(n) OVER (PARTITION BY feature) AS total FROM joint) GROUP BY feature)"""


def _mi(spark, d):
    return feature_select.mutual_information(three_class(spark, d), discrete=["priority"], numeric=["price", "cust"], label_col="label")


@check("mutual_information", "feature:s score:6", f"WITH {_BINS} SELECT feature, score FROM mi")
def _(spark, d):
    return _mi(spark, d)


@check("ranked_features", "feature:s score:6 selected:b", f"WITH {_BINS} SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) <= 2 AS selected FROM mi")
def _(spark, d):
    return feature_select.ranked_report(feature_select.select_top(_mi(spark, d), 2), 20)


@check("compare_feature_sets", "features:s n_features:i accuracy:4")
def _(spark, d):
    v = stratified_split(_vectors(spark, d), id_col="id", label_col="label")
    train, test = v.filter("NOT is_test"), v.filter("is_test")
    chosen = feature_select.select_l1(train, _NAMES, features_col="features", label_col="label", C=0.1)
    return feature_select.compare_feature_sets(train, test, chosen, features_col="features", label_col="label")
