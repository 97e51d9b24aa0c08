"""Checks for sources, cleaning, encoding, scaling and the full chain."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from queries.base import DIRTY, EMB_LONG, USERS, check, dirty_orders, embeddings, table, user_features
from sparkmine.lineage import scratch_path
from sparkmine.operators import outliers, tuning, cleaning, encoding, eda, moments, reduction
from sparkmine.plans.preprocess import PreprocessConfig, Preprocessor
from sparkmine.sources import tables as sources


@check("read_delimited", "id:i o_orderstatus:s priority:s price:4", f"""WITH {DIRTY}
  SELECT id, o_orderstatus, nullif(priority, '?') AS priority, price FROM dirty""")
def _(spark, d):
    path = scratch_path(spark, "orders-csv")
    dirty = dirty_orders(spark, d).select("id", "o_orderstatus", "priority", "price")
    sources.write_results(dirty, path)
    return sources.read_delimited(spark, path, dirty.schema, null_tokens=("?",))


@check("stacked_lookup", "source:s code_type:s code:s description:s", """
  SELECT CAST(c_custkey AS VARCHAR) AS source, 'custkey' AS code_type, CAST(c_custkey AS VARCHAR) AS code, c_name || ', customer' AS description FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment, CASE WHEN c_custkey % 5 > 0 THEN 'segment of ' || c_name END FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', 'total', '"quoted"' FROM customer""")
def _(spark, d):
    c = table(spark, d, "customer")
    text = F.concat(
        F.lit("custkey,description\n"), F.col("c_custkey"), F.lit(',"'), F.col("c_name"), F.lit(', customer"\n,\nsegment,description\n'),
        F.col("c_mktsegment"), F.lit(", "), F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit("segment of "), F.col("c_name"))).otherwise("NULL"),
        F.lit('\ntotal,"""quoted"""\n'))
    return sources.parse_stacked_lookup(c.select(F.col("c_custkey").cast("string").alias("source"), text.alias("text")))


@check("lookup_join", "c_custkey:i c_nationkey:i c_nationkey_description:s",
       "SELECT c_custkey, c_nationkey, n_name AS c_nationkey_description FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, d):
    lookup = table(spark, d, "nation").select(F.lit("nation").alias("code_type"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("description"))
    return sources.describe_codes(table(spark, d, "customer").select("c_custkey", "c_nationkey"), lookup, "c_nationkey", "nation")


@check("profile", "column:s type:s n_rows:i non_null:i", f"""WITH {DIRTY}
  SELECT 'id' AS column, 'bigint' AS type, count(*) AS n_rows, count(id) AS non_null FROM dirty
  UNION ALL SELECT 'o_orderstatus', 'string', count(*), count(o_orderstatus) FROM dirty
  UNION ALL SELECT 'priority', 'string', count(*), count(nullif(priority, '?')) FROM dirty
  UNION ALL SELECT 'price', 'double', count(*), count(price) FROM dirty
  UNION ALL SELECT 'sparse97', 'string', count(*), count(nullif(sparse97, '?')) FROM dirty
  UNION ALL SELECT 'sparse55', 'string', count(*), count(nullif(sparse55, '?')) FROM dirty
  UNION ALL SELECT 'sparse45', 'string', count(*), count(nullif(sparse45, '?')) FROM dirty""")
def _(spark, d):
    return cleaning.profile(cleaning.placeholder_to_null(dirty_orders(spark, d)))


@check("placeholder_to_null", "id:i o_orderstatus:s priority:s sparse97:s", f"""WITH {DIRTY}
  SELECT id, o_orderstatus, nullif(priority, '?') AS priority, nullif(sparse97, '?') AS sparse97 FROM dirty""")
def _(spark, d):
    return cleaning.placeholder_to_null(dirty_orders(spark, d))


_COLUMNS = ("id", "o_orderstatus", "priority", "price", "sparse97", "sparse55", "sparse45")


@check("missing_top", "column:s n:i", f"WITH {DIRTY} SELECT col AS column, n FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(*) FILTER ({c if c in ('id', 'price') else f'''nullif({c}, '?')'''} IS NULL) AS n FROM dirty" for c in _COLUMNS
) + ") ORDER BY n DESC, col LIMIT 15")
def _(spark, d):
    return cleaning.missing_counts(cleaning.placeholder_to_null(dirty_orders(spark, d)))


@check("placeholder_top", "column:s n:i", f"WITH {DIRTY} SELECT col AS column, n FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(*) FILTER ({'false' if c in ('id', 'price') else f'''{c} = '?' '''}) AS n FROM dirty" for c in _COLUMNS
) + ") ORDER BY n DESC, col LIMIT 15")
def _(spark, d):
    return cleaning.placeholder_counts(dirty_orders(spark, d))


@check("drop_sparse_by_present", "id:i o_orderstatus:s priority:s price:4 sparse55:s sparse45:s", f"""WITH {DIRTY}
  SELECT id, o_orderstatus, nullif(priority, '?') AS priority, price, nullif(sparse55, '?') AS sparse55, nullif(sparse45, '?') AS sparse45 FROM dirty""")
def _(spark, d):
    kept = cleaning.drop_sparse(cleaning.placeholder_to_null(dirty_orders(spark, d)), min_present=0.4)
    assert "sparse97" not in kept.columns
    return kept


@check("drop_sparse_by_missing", "id:i o_orderstatus:s priority:s price:4 sparse45:s", f"""WITH {DIRTY}
  SELECT id, o_orderstatus, nullif(priority, '?') AS priority, price, nullif(sparse45, '?') AS sparse45 FROM dirty""")
def _(spark, d):
    kept = cleaning.drop_sparse(cleaning.placeholder_to_null(dirty_orders(spark, d)), max_missing=0.5)
    assert "sparse55" not in kept.columns
    return kept


@check("drop_duplicate_rows", "event_id:i user_id:i event_type:s value:4", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return cleaning.drop_duplicate_rows(e.union(e.filter(F.col("event_id") % 20 == 0)))


@check("fill_unknown", "id:i priority:s sparse45:s", f"""WITH {DIRTY}
  SELECT id, replace(priority, '?', 'Unknown') AS priority, replace(sparse45, '?', 'Unknown') AS sparse45 FROM dirty""")
def _(spark, d):
    return cleaning.fill_strings(cleaning.placeholder_to_null(dirty_orders(spark, d)))


# the paths for columns and groups too large for one window, on the same tables
RANGED = {"small": 0, "accuracy": 100, "rows_per_window": 10}

_MEDIAN = f"""WITH {DIRTY}, m AS (SELECT quantile_cont(price, 0.5) AS m FROM dirty)
  SELECT id, coalesce(price, m) AS price FROM dirty, m"""


@check("median_impute", "id:i price:6", _MEDIAN)
def _(spark, d):
    return cleaning.impute_median(dirty_orders(spark, d), ["price"])


@check("median_impute_ranged", "id:i price:6", _MEDIAN)
def _(spark, d):
    return cleaning.impute_median(dirty_orders(spark, d), ["price"], **RANGED)


@check("drop_ids", "id:i price:4", f"WITH {DIRTY} SELECT id, price FROM dirty")
def _(spark, d):
    out = cleaning.drop_ids(dirty_orders(spark, d).withColumn("patient", F.col("id") * 2), ["id", "patient", "absent"], keep="id")
    assert "patient" not in out.columns
    return out


@check("map_target", "id:i three:i two:i", f"""SELECT o_orderkey AS id,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS three, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS two FROM orders""")
def _(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), cleaning.map_values("o_orderstatus", {"F": 0, "O": 1, "P": 2}).alias("three"),
        cleaning.map_values("o_orderstatus", {"F": 0, "O": 1}).alias("two"))


@check("select_numeric", "p_partkey:i p_size:i p_retailprice:4", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(spark, d):
    return cleaning.select_by_type(table(spark, d, "part"), "numeric")


@check("select_by_index", "p_partkey:i p_brand:s p_size:i", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, d):
    return cleaning.select_by_index(table(spark, d, "part"), [1, 3], keep=["p_partkey"])


def mixed_part(spark, d):
    """Part with cardinalities 6, 25 and exactly 9, 10 and 11."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), "p_type", "p_brand", *[
        F.concat(F.lit("s"), (F.col("p_size") % k).cast("string")).alias(f"size{k}") for k in (9, 10, 11)])


MIXED = "mixed AS (SELECT p_partkey AS id, p_type, p_brand, " + ", ".join(f"concat('s', p_size % {k}) AS size{k}" for k in (9, 10, 11)) + " FROM part)"
_MIXED = ("p_type", "p_brand", "size9", "size10", "size11")
_CARD = " UNION ALL ".join(f"SELECT '{c}' AS col, count(DISTINCT {c}) AS n_distinct FROM mixed" for c in _MIXED)


@check("cardinality", "column:s n_distinct:i", f"WITH {MIXED} SELECT col AS column, n_distinct FROM ({_CARD})")
def _(spark, d):
    return encoding.cardinalities(mixed_part(spark, d), _MIXED)


@check("route_below_cut", "column:s n_distinct:i encoding:s",
       f"WITH {MIXED} SELECT col AS column, n_distinct, CASE WHEN n_distinct < 10 THEN 'label' ELSE 'onehot' END AS encoding FROM ({_CARD})")
def _(spark, d):
    return encoding.routing(mixed_part(spark, d), _MIXED)


@check("route_up_to_cut", "column:s n_distinct:i encoding:s",
       f"WITH {MIXED} SELECT col AS column, n_distinct, CASE WHEN n_distinct <= 10 THEN 'label' ELSE 'onehot' END AS encoding FROM ({_CARD})")
def _(spark, d):
    return encoding.routing(mixed_part(spark, d), _MIXED, inclusive=True)


_CODES = "SELECT p_partkey AS id, {c}, dense_rank() OVER (ORDER BY {c}) - 1 AS code FROM part"


@check("label_encode_ranged", "id:i p_name:s code:i", _CODES.format(c="p_name"))
def _(spark, d):
    return encoding.label_encode(table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name"), "p_name", into="code", rows_per_window=10)


@check("label_encode", "id:i p_brand:s code:i", _CODES.format(c="p_brand"))
def _(spark, d):
    return encoding.label_encode(table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand"), "p_brand", into="code")


@check("one_hot", "id:i slot:i value:1 width:i", """WITH r AS (SELECT p_partkey AS id, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part),
  w AS (SELECT count(DISTINCT p_brand) - 1 AS width FROM part)
  SELECT id, code - 1 AS slot, 1.0 AS value, width FROM r, w WHERE code > 0""")
def _(spark, d):
    hot = encoding.one_hot(table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand"), ["p_brand"])
    dense = vector_to_array("p_brand_hot")
    return hot.select("id", F.size(dense).alias("width"), F.posexplode(dense).alias("slot", "value")).filter("value > 0")


@check("standardise", "id:i n_events:6 avg_value:6 sd_value:6", f"""WITH {USERS}
  SELECT id, """ + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in ("n_events", "avg_value", "sd_value")) + " FROM users")
def _(spark, d):
    return encoding.standardise(user_features(spark, d), ["n_events", "avg_value", "sd_value"])


@check("assemble", "id:i slot:i value:6", f"""WITH {USERS} SELECT id, 0 AS slot, n_events AS value FROM users
  UNION ALL SELECT id, 1, avg_value FROM users UNION ALL SELECT id, 2, n_click FROM users""")
def _(spark, d):
    a = encoding.assemble(user_features(spark, d), ["n_events", "avg_value", "n_click"])
    return a.select("id", F.posexplode("features").alias("slot", "value"))


def raw_parts(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.alias("id"), F.when(k % 3 == 0, "NO").when(k % 3 == 1, ">30").otherwise("<30").alias("target"),
        F.when(k % 10 == 0, "?").otherwise(F.col("p_brand")).alias("brand"), F.col("p_type").alias("type"),
        F.col("p_size").alias("size"), F.when(k % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.when(k % 100 < 97, "?").otherwise("x").alias("sparse"))


RAW = """raw AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS brand, p_type AS type, p_size AS size,
  CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price FROM part)"""


def _long_features(spark, prep, df):
    out = prep.transform(df)
    values = out.select("id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    names = spark.createDataFrame(list(enumerate(prep.features)), "slot int, feature string")
    return values.join(F.broadcast(names), "slot")


_SCALE = "({0} - avg({0}) OVER (PARTITION BY feature)) / stddev_pop({0}) OVER (PARTITION BY feature)"


@check("preprocess_default", "id:i feature:s value:6", f"""WITH {RAW},
  filled AS (SELECT id, coalesce(brand, 'Unknown') AS brand, dense_rank() OVER (ORDER BY type) - 1 AS type, size, coalesce(price, 0) AS price FROM raw),
  plain AS (SELECT id, 'type' AS feature, type AS v FROM filled UNION ALL SELECT id, 'size', size FROM filled UNION ALL SELECT id, 'price', price FROM filled),
  cats AS (SELECT DISTINCT brand AS cat FROM filled WHERE brand > (SELECT min(brand) FROM filled))
  SELECT id, feature, {_SCALE.format('v')} AS value FROM plain
  UNION ALL SELECT id, 'brand_' || cat, CASE WHEN brand = cat THEN 1.0 ELSE 0.0 END FROM filled, cats""")
def _(spark, d):
    raw = raw_parts(spark, d)
    prep = Preprocessor(PreprocessConfig.default("id", target="target")).fit(raw)
    return _long_features(spark, prep, raw)


@check("preprocess_outlier", "id:i feature:s value:6", f"""WITH {RAW}, m AS (SELECT quantile_cont(price, 0.5) AS m FROM raw),
  filled AS (SELECT id, brand, dense_rank() OVER (ORDER BY type) - 1 AS type, size, coalesce(price, m) AS price FROM raw, m),
  plain AS (SELECT id, 'type' AS feature, CAST(type AS DOUBLE) AS v FROM filled UNION ALL SELECT id, 'size', size FROM filled UNION ALL SELECT id, 'price', price FROM filled),
  cats AS (SELECT DISTINCT brand AS cat FROM filled WHERE brand > (SELECT min(brand) FROM filled)),
  every AS (SELECT * FROM plain UNION ALL SELECT id, 'brand_' || cat, CASE WHEN brand = cat THEN 1.0 ELSE 0.0 END FROM filled, cats)
  SELECT id, feature, {_SCALE.format('v')} AS value FROM every""")
def _(spark, d):
    raw = raw_parts(spark, d)
    prep = Preprocessor(PreprocessConfig.outlier("id", target="target")).fit(raw.union(raw.filter("id % 20 = 0")))
    return _long_features(spark, prep, raw)


# -- chart data ----------------------------------------------------------------

@check("class_distribution", "label:s n:i share:6", "SELECT o_orderstatus AS label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 1")
def _(spark, d):
    return eda.class_distribution(table(spark, d, "orders"), "o_orderstatus")


def _histogram_sql(bins, items):
    parts = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM {t}" for c, t in items)
    return f"""WITH v AS MATERIALIZED ({parts}), l AS (SELECT col, min(x) AS a, max(x) AS b, (max(x) - min(x)) / {bins} AS w FROM v GROUP BY col),
      g AS (SELECT col, a, w, unnest(range({bins})) AS bin FROM l),
      c AS (SELECT v.col, least(floor((x - a) / w), {bins - 1}) AS bin, count(*) AS n FROM v JOIN l USING (col) GROUP BY 1, 2)
      SELECT g.col AS column, g.bin, a + g.bin * w AS lo, a + (g.bin + 1) * w AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.col = c.col AND g.bin = c.bin"""


@check("histogram_30", "column:s bin:i lo:4 hi:4 n:i", _histogram_sql(30, [(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")]))
def _(spark, d):
    return eda.histogram(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], 30)


@check("histogram_50", "column:s bin:i lo:4 hi:4 n:i", _histogram_sql(50, [("value", "events")]))
def _(spark, d):
    return eda.histogram(table(spark, d, "events"), ["value"], 50)


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


_HOLED = EMB_LONG + """, h AS MATERIALIZED (SELECT id, dim, CASE WHEN (id + dim) % 7 > 0 THEN v END AS v FROM emb_long),
  p AS (SELECT x.dim AS a, y.dim AS b, count(*) AS n, covar_samp(x.v, y.v) AS covariance, corr(x.v, y.v) AS r FROM h x JOIN h y ON x.id = y.id AND x.dim <= y.dim
    WHERE x.v IS NOT NULL AND y.v IS NOT NULL GROUP BY 1, 2)"""


@check("pair_statistics", "a:i b:i n:i covariance:6 r:6", f"WITH {_HOLED} SELECT * FROM p")
def _(spark, d):
    holed = F.transform("x", lambda v, k: F.when((F.col("id") + k) % 7 > 0, v))
    return moments.pair_statistics(embeddings(spark, d).select(holed.alias("x")), "x", tile=24)


@check("correlation", "a:s b:s r:6", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for i, a in enumerate(_CORR) for b in _CORR[i:]))
def _(spark, d):
    return eda.correlation(table(spark, d, "lineitem"), _CORR)


@check("boxplot", "label:s column:s q1:4 median:4 q3:4 whisker_low:4 whisker_high:4 n_outliers:i n:i", """WITH b AS (SELECT event_type AS label,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
  j AS (SELECT b.*, value AS x, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events JOIN b ON event_type = label)
  SELECT label, 'value' AS column, q1, median, q3, min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
    count(*) FILTER (NOT inside) AS n_outliers, count(*) AS n FROM j GROUP BY label, q1, median, q3""")
def _(spark, d):
    return eda.boxplot(table(spark, d, "events"), ["value"], "event_type")


def _null_class(spark, d):
    return table(spark, d, "events").withColumn("label", F.when(F.col("event_type") != "view", F.col("event_type")))


@check("boxplot_ranged", "label:s column:s q1:4 median:4 q3:4 whisker_low:4 whisker_high:4 n_outliers:i n:i", """WITH e AS (SELECT nullif(event_type, 'view') AS label, value FROM events),
  b AS (SELECT label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM e GROUP BY 1),
  j AS (SELECT b.*, value AS x, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM e JOIN b ON e.label IS NOT DISTINCT FROM b.label)
  SELECT label, 'value' AS column, q1, median, q3, min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
    count(*) FILTER (NOT inside) AS n_outliers, count(*) AS n FROM j GROUP BY label, q1, median, q3""")
def _(spark, d):
    return eda.boxplot(_null_class(spark, d), ["value"], "label", **RANGED)


# -- principal components ------------------------------------------------------

_EIGEN = USERS + """, c AS (SELECT avg(n_events) AS mx, avg(avg_value) AS my, covar_samp(n_events, n_events) AS a, covar_samp(n_events, avg_value) AS b,
    covar_samp(avg_value, avg_value) AS e FROM users),
  l AS (SELECT *, (a + e) / 2 + sqrt(((a - e) / 2) ** 2 + b * b) AS l1, (a + e) / 2 - sqrt(((a - e) / 2) ** 2 + b * b) AS l2 FROM c)"""


def _plain_users(spark, d):
    return user_features(spark, d).select("id", F.array(F.col("n_events").cast("double"), "avg_value").alias("x"))


@check("explained_variance", "component:i ratio:6 cumulative:6", f"""WITH {_EIGEN}
  SELECT 1 AS component, l1 / (l1 + l2) AS ratio, l1 / (l1 + l2) AS cumulative FROM l UNION ALL SELECT 2, l2 / (l1 + l2), 1.0 FROM l""")
def _(spark, d):
    x = _plain_users(spark, d)
    return reduction.explained_variance(x, reduction.fit_pca(x, x_col="x", k=2))


_V1 = """v AS (SELECT *, b / sqrt(b * b + (l1 - a) ** 2) AS p, (l1 - a) / sqrt(b * b + (l1 - a) ** 2) AS q FROM l),
  s AS (SELECT *, CASE WHEN abs(p) >= abs(q) THEN sign(p) ELSE sign(q) END AS s1, CASE WHEN abs(q) >= abs(p) THEN sign(-q) ELSE sign(p) END AS s2 FROM v)"""


@check("pca_projection", "id:i pc1:4 pc2:4", f"""WITH {_EIGEN}, {_V1}
  SELECT id, s1 * (p * (n_events - mx) + q * (avg_value - my)) AS pc1, s2 * (-q * (n_events - mx) + p * (avg_value - my)) AS pc2 FROM users, s""")
def _(spark, d):
    x = _plain_users(spark, d)
    return reduction.fit_pca(x, x_col="x", k=2).coordinates(x, id_col="id", x_col="x")


@check("projection_by_class", "id:i label:i pc1:4 pc2:4 pc3:4")
def _(spark, d):
    from queries.base import embeddings

    e = embeddings(spark, d)
    projected = reduction.fit_pca(e, x_col="x", k=3).coordinates(e, id_col="id", x_col="x")
    return eda.projection_by_class(projected, e, id_col="id", label_col="label")


@check("pca_apply_to_new_rows", "id:i pc1:4 pc2:4")
def _(spark, d):
    from queries.base import embeddings
    from sparkmine.operators.sampling import stratified_split

    split = stratified_split(embeddings(spark, d), id_col="id", label_col="label")
    model = reduction.fit_pca(split.filter("NOT is_test"), x_col="x", k=2)
    return model.coordinates(split.filter("is_test"), id_col="id", x_col="x")


# the same operators on the two-column users, where the components have a closed form

_AXES = "s1 * (p * (n_events - mx) + q * (avg_value - my)) AS pc1, s2 * (-q * (n_events - mx) + p * (avg_value - my)) AS pc2"
_TRAINED = _EIGEN.replace("AS e FROM users)", "AS e FROM users WHERE id % 5 <> 0)")


def _user_plane_projected(spark, d):
    x = _plain_users(spark, d)
    return reduction.fit_pca(x, x_col="x", k=2).coordinates(x, id_col="id", x_col="x")


@check("pca_apply_to_new_users", "id:i pc1:4 pc2:4", f"WITH {_TRAINED}, {_V1} SELECT id, {_AXES} FROM users, s WHERE id % 5 = 0")
def _(spark, d):
    x = _plain_users(spark, d)
    return reduction.fit_pca(x.filter("id % 5 <> 0"), x_col="x", k=2).coordinates(x.filter("id % 5 = 0"), id_col="id", x_col="x")


@check("projection_table_users", "id:i pc1:4 pc2:4 label:i", f"WITH {_EIGEN}, {_V1} SELECT id, {_AXES}, id % 3 AS label FROM users, s")
def _(spark, d):
    labels = _plain_users(spark, d).select("id", (F.col("id") % 3).alias("kind"))
    return eda.projection_by_class(_user_plane_projected(spark, d), labels, id_col="id", label_col="kind")


@check("correct_projection_users", "id:i pc1:4 pc2:4 label:i prediction:i correct:b", f"""WITH {_EIGEN}, {_V1}
  SELECT id, {_AXES}, id % 3 AS label, id % 2 AS prediction, id % 3 = id % 2 AS correct FROM users, s""")
def _(spark, d):
    guessed = _plain_users(spark, d).select("id", (F.col("id") % 3).alias("label"), (F.col("id") % 2).alias("prediction"))
    return tuning.correct_projection(_user_plane_projected(spark, d), guessed, id_col="id")


@check("flagged_projection_users", "id:i pc1:4 pc2:4 score:5 is_outlier:b", f"""WITH {_EIGEN}, {_V1}
  SELECT id, {_AXES}, -sd_value AS score, sd_value > (SELECT quantile_cont(sd_value, 0.9) FROM users) AS is_outlier FROM users, s""")
def _(spark, d):
    u = user_features(spark, d)
    limit = outliers.upper_threshold(u, "sd_value", 0.1)
    flagged = u.select("id", (-F.col("sd_value")).alias("score"), (F.col("sd_value") > limit).alias("is_outlier"))
    return outliers.flagged_projection(_user_plane_projected(spark, d), flagged, id_col="id")
