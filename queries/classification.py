"""Checks for trees, forests, votes, classifiers, metrics and parameter search."""

from pyspark.sql import functions as F

from queries.base import EMB, EMB_PAIRS, THREE, check, embeddings, sql_key, sql_uniform, table, three_class
from queries.distances import _poisson_sql
from sparkmine.functions.keys import hash_key, uniform
from sparkmine.lineage import cut, scratch_path
from sparkmine.operators import classify, metrics, reduction, stacked, trees, tuning
from sparkmine.operators.sampling import fold_of, stratified_split
from sparkmine.sources import tables as sources

# -- trees ---------------------------------------------------------------------


@check("impurity", "priority:s n:i gini:6 entropy:6", f"""WITH {THREE}, c AS (SELECT priority, label, count(*) AS c FROM three GROUP BY 1, 2),
  p AS (SELECT priority, c, sum(c) OVER (PARTITION BY priority) AS n FROM c)
  SELECT priority, n, 1 - sum((c / n) ** 2) AS gini, -sum(c / n * log2(c / n + 1e-12)) AS entropy FROM p GROUP BY 1, 2""")
def _(spark, d):
    return trees.impurity(three_class(spark, d), label_col="label", by=["priority"])


def _split_sql(cols, criterion="gini"):
    values = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, id, label FROM three" for c in cols)
    gini = lambda side: "(1 - " + " - ".join(f"({side}{i} / {side}n) ** 2" for i in range(3)) + ")"
    entropy = lambda side: "(0 - " + " - ".join(f"({side}{i} / {side}n) * log2({side}{i} / {side}n + 1e-12)" for i in range(3)) + ")"
    imp = gini if criterion == "gini" else entropy
    return f"""long AS ({values}), v AS (SELECT feature, value, arg_min(label, id) AS first_label, arg_max(label, id) AS last_label,
      {', '.join(f'count(*) FILTER (label = {i}) AS c{i}' for i in range(3))} FROM long GROUP BY 1, 2),
    r AS (SELECT feature, value, last_label, lead(value) OVER w AS next_value, lead(first_label) OVER w AS next_label,
      {', '.join(f'CAST(sum(c{i}) OVER w AS DOUBLE) AS l{i}, CAST(sum(c{i}) OVER (PARTITION BY feature) - sum(c{i}) OVER w AS DOUBLE) AS r{i}' for i in range(3))}
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)),
    s AS (SELECT *, l0 + l1 + l2 AS ln, r0 + r1 + r2 AS rn FROM r WHERE last_label <> next_label),
    t AS (SELECT feature, (value + next_value) / 2 AS threshold, (ln * {imp('l')} + rn * {imp('r')}) / (ln + rn) AS impurity FROM s),
    best AS (SELECT feature, threshold, impurity FROM t QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(impurity, 12), threshold) = 1)"""


@check("best_numeric_split", "feature:s threshold:4 impurity:6", f"WITH {THREE}, {_split_sql(['price', 'cust', 'month'])} SELECT * FROM best")
def _(spark, d):
    return trees.numeric_splits(three_class(spark, d), ["price", "cust", "month"], id_col="id", label_col="label", classes=[0, 1, 2])


@check("best_numeric_split_entropy", "feature:s threshold:4 impurity:6", f"WITH {THREE}, {_split_sql(['price', 'cust', 'month'], 'entropy')} SELECT * FROM best")
def _(spark, d):
    return trees.numeric_splits(three_class(spark, d), ["price", "cust", "month"], id_col="id", label_col="label", classes=[0, 1, 2], criterion="entropy")


_CATEGORICAL = """cat AS (SELECT count(*) AS n_values, sum(n * (1 - (c0 / n) ** 2 - (c1 / n) ** 2 - (c2 / n) ** 2)) / sum(n) AS impurity FROM (
  SELECT coalesce(priority, '(null)') AS value, count(*) AS n, count(*) FILTER (label = 0) AS c0, count(*) FILTER (label = 1) AS c1, count(*) FILTER (label = 2) AS c2 FROM three GROUP BY 1))"""


@check("categorical_split", "feature:s n_values:i impurity:6", f"WITH {THREE}, {_CATEGORICAL} SELECT 'priority' AS feature, n_values, impurity FROM cat")
def _(spark, d):
    return trees.categorical_splits(three_class(spark, d), ["priority"], label_col="label", classes=[0, 1, 2])


@check("categorical_split_entropy", "feature:s n_values:i impurity:6", f"""WITH {THREE}, c AS (SELECT priority, label, count(*) AS c FROM three GROUP BY 1, 2),
  p AS (SELECT priority, c, sum(c) OVER (PARTITION BY priority) AS n FROM c), e AS (SELECT priority, n, -sum(c / n * log2(c / n + 1e-12)) AS h FROM p GROUP BY 1, 2)
  SELECT 'priority' AS feature, count(*) AS n_values, sum(n * h) / sum(n) AS impurity FROM e""")
def _(spark, d):
    return trees.categorical_splits(three_class(spark, d), ["priority"], label_col="label", classes=[0, 1, 2], criterion="entropy")


@check("tree_stump", "id:i prediction:i", f"""WITH {THREE}, {_split_sql(['price', 'cust', 'month'])},
  pick AS (SELECT feature, threshold FROM best ORDER BY round(impurity, 12), CASE feature WHEN 'price' THEN 0 WHEN 'cust' THEN 1 ELSE 2 END LIMIT 1),
  side AS (SELECT three.id, label, CASE feature WHEN 'price' THEN price WHEN 'cust' THEN cust ELSE month END >= threshold AS ge FROM three, pick),
  top AS (SELECT ge, label FROM side GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY ge ORDER BY count(*) DESC, CAST(label AS VARCHAR)) = 1)
  SELECT id, top.label AS prediction FROM side JOIN top USING (ge)""")
def _(spark, d):
    t = three_class(spark, d)
    stump = trees.grow_tree(t, id_col="id", numeric=["price", "cust", "month"], categorical=[], label_col="label", max_depth=1)
    return stump.predict(t)


def _grown_sql(levels, numeric, categorical, chosen=None):
    """Levels of trees over ``st0 (tree, node, w, id, label, columns...)``: nodes ``nd0..``, edges ``ed0..`` and the rows on every level."""
    order = sorted([*numeric, *categorical]) if chosen else [*numeric, *categorical]
    place = "CASE feature " + " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(order)) + " END"
    gini = lambda side: "(1 - " + " - ".join(f"({side}{i} / {side}n) ** 2" for i in range(3)) + ")"
    counts = ", ".join(f"coalesce(sum(w) FILTER (label = {i}), 0) AS c{i}" for i in range(3))
    key = "CASE " + " ".join(f"WHEN feature = '{f}' THEN CASE WHEN {f} < threshold THEN 'l' WHEN {f} >= threshold THEN 'ge' END" for f in numeric) + " ".join(
        f" WHEN feature = '{f}' THEN coalesce('=' || {f}, '?')" for f in categorical) + " END"
    offered = f"SEMI JOIN {chosen} USING (tree, feature)" if chosen else ""
    out = []
    for d in range(levels + 1):
        out.append(f"""mx{d} AS MATERIALIZED (SELECT tree, node, {counts} FROM st{d} GROUP BY 1, 2),
          nd{d} AS MATERIALIZED (SELECT tree, node, {d} AS depth, c0 + c1 + c2 AS size, greatest(c0, c1, c2) < c0 + c1 + c2 AS impure,
            CASE WHEN c0 = greatest(c0, c1, c2) THEN 0 WHEN c1 = greatest(c0, c1, c2) THEN 1 ELSE 2 END AS majority FROM mx{d})""")
        if d == levels:
            break
        melt = " UNION ALL ".join(f"SELECT tree, node, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, w, id, label FROM so{d} WHERE {f} IS NOT NULL" for f in numeric)
        cats = "".join(f" UNION ALL SELECT tree, node, '{f}' AS feature, coalesce('=' || {f}, '?') AS value, w, label FROM so{d}" for f in categorical)
        out.append(f"""so{d} AS MATERIALIZED (SELECT s.* FROM st{d} s SEMI JOIN (SELECT tree, node FROM nd{d} WHERE impure AND size >= 2) o USING (tree, node)),
          lo{d} AS (SELECT * FROM ({melt}) {offered}),
          va{d} AS (SELECT tree, node, feature, value, arg_min(label, id) AS fl, arg_max(label, id) AS ll, {counts} FROM lo{d} GROUP BY 1, 2, 3, 4),
          ru{d} AS (SELECT tree, node, feature, value, ll, lead(value) OVER v AS nv, lead(fl) OVER v AS nl,
            {', '.join(f'CAST(sum(c{i}) OVER v AS DOUBLE) AS l{i}, CAST(sum(c{i}) OVER (PARTITION BY tree, node, feature) - sum(c{i}) OVER v AS DOUBLE) AS r{i}' for i in range(3))}
            FROM va{d} WINDOW v AS (PARTITION BY tree, node, feature ORDER BY value)),
          cu{d} AS (SELECT *, l0 + l1 + l2 AS ln, r0 + r1 + r2 AS rn FROM ru{d} WHERE ll <> nl),
          ca{d} AS (SELECT tree, node, feature, value, CAST(c0 AS DOUBLE) AS l0, CAST(c1 AS DOUBLE) AS l1, CAST(c2 AS DOUBLE) AS l2, CAST(c0 + c1 + c2 AS DOUBLE) AS ln
            FROM (SELECT tree, node, feature, value, {counts} FROM (SELECT NULL AS tree, NULL AS node, NULL AS feature, NULL AS value, NULL AS w, NULL AS label WHERE FALSE{cats}) {offered} GROUP BY 1, 2, 3, 4) x),
          al{d} AS (SELECT tree, node, feature, (value + nv) / 2 AS threshold, (ln * {gini('l')} + rn * {gini('r')}) / (ln + rn) AS impurity FROM cu{d}
            UNION ALL SELECT tree, node, feature, NULL, sum(ln * {gini('l')}) / sum(ln) FROM ca{d} GROUP BY 1, 2, 3 HAVING count(*) > 1),
          be{d} AS MATERIALIZED (SELECT tree, node, feature, threshold FROM al{d} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY round(impurity, 12), {place}, threshold) = 1),
          ke{d} AS (SELECT * FROM (SELECT s.*, {key} AS key FROM so{d} s JOIN be{d} USING (tree, node)) WHERE key IS NOT NULL),
          ed{d} AS MATERIALIZED (SELECT k.tree, node, key, last + row_number() OVER (PARTITION BY k.tree ORDER BY node, CASE WHEN key IN ('l', '?') THEN 0 ELSE 1 END, key) AS child
            FROM (SELECT DISTINCT tree, node, key FROM ke{d}) k JOIN (SELECT tree, max(node) AS last FROM nd{d} GROUP BY 1) m ON m.tree = k.tree),
          st{d + 1} AS MATERIALIZED (SELECT k.* REPLACE (e.child AS node) EXCLUDE (key) FROM ke{d} k JOIN ed{d} e ON e.tree = k.tree AND e.node = k.node AND e.key = k.key)""".replace(
            "k.* REPLACE (e.child AS node) EXCLUDE (key)", "k.* EXCLUDE (key) REPLACE (e.child AS node)"))
    return ",\n".join(out)


def _nodes_sql(levels):
    return " UNION ALL ".join(
        f"SELECT tree, node, depth, size, majority, feature, threshold, coalesce(n, 0) AS n_children FROM nd{d} LEFT JOIN be{d} USING (tree, node) LEFT JOIN (SELECT tree, node, count(*) AS n FROM ed{d} GROUP BY 1, 2) USING (tree, node)"
        for d in range(levels)) + f" UNION ALL SELECT tree, node, depth, size, majority, NULL, NULL, 0 FROM nd{levels}"


_TREE_COLUMNS = "node:i depth:i size:i majority:s feature:s threshold:4 n_children:i"


@check("tree_two_levels", _TREE_COLUMNS, f"""WITH {THREE}, st0 AS MATERIALIZED (SELECT 0 AS tree, 0 AS node, 1 AS w, id, label, price, cust, priority FROM three),
  {_grown_sql(2, ['price', 'cust'], ['priority'])} {_nodes_sql(2)}""")
def _(spark, d):
    t = three_class(spark, d)
    return trees.tree_table(t, trees.grow_tree(t, id_col="id", numeric=["price", "cust"], categorical=["priority"], label_col="label", max_depth=2))


# two of three features and a bootstrap for each of three trees
_BAGGED = f"""t AS (SELECT *, unnest(range(3)) AS tree FROM three), u AS (SELECT *, {sql_uniform('id', "'42-' || tree")} AS u FROM t),
  st0 AS MATERIALIZED (SELECT tree, 0 AS node, w, id, label, price, cust, month FROM (SELECT *, {_poisson_sql('u')} AS w FROM u) WHERE w > 0),
  chosen AS (SELECT tree, feature FROM (SELECT feature, unnest(range(3)) AS tree FROM (SELECT unnest(['price', 'cust', 'month']) AS feature))
    QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {sql_key("feature || '-' || tree", 42)}, feature) <= 2)"""


def bagged_trees(spark, d):
    t = three_class(spark, d)
    return t, trees.exact_forest(t, id_col="id", features=["price", "cust", "month"], label_col="label", n_trees=3, subset=2, max_depth=2)


@check("exact_forest_nodes", "tree:i " + _TREE_COLUMNS, f"WITH {THREE}, {_BAGGED}, {_grown_sql(2, ['price', 'cust', 'month'], [], 'chosen')} {_nodes_sql(2)}")
def _(spark, d):
    return bagged_trees(spark, d)[1].nodes_table


@check("tree_exact", "node:i depth:i size:i majority:s feature:s threshold:4 n_children:i", f"""WITH {THREE},
  st0 AS MATERIALIZED (SELECT 0 AS tree, 0 AS node, 1 AS w, id, label, price, cust, priority FROM three), {_grown_sql(3, ['price', 'cust'], ['priority'])} {_nodes_sql(3)}""")
def _(spark, d):
    t = three_class(spark, d)
    return trees.tree_table(t, trees.grow_tree(t, id_col="id", numeric=["price", "cust"], categorical=["priority"], label_col="label", max_depth=3))


@check("majority_class", "priority:s majority:i n:i", f"""WITH {THREE}, c AS (SELECT priority, label, count(*) AS c FROM three GROUP BY 1, 2)
  SELECT priority, label AS majority, sum(c) OVER (PARTITION BY priority) AS n FROM c QUALIFY row_number() OVER (PARTITION BY priority ORDER BY c DESC, CAST(label AS VARCHAR)) = 1""")
def _(spark, d):
    return trees.majority_class(three_class(spark, d), label_col="label", by=["priority"])


_VOTES = f"""votes AS (SELECT o_orderkey AS id, tree, {sql_key('o_orderkey', "'vote-' || tree")} % 3 AS prediction FROM orders, (SELECT unnest(range(7)) AS tree))"""


@check("hard_vote", "id:i prediction:i n_votes:i p0:6 p1:6 p2:6", f"""WITH {_VOTES}, c AS (SELECT id, count(*) AS n, {', '.join(f'count(*) FILTER (prediction = {i}) AS v{i}' for i in range(3))} FROM votes GROUP BY id)
  SELECT id, CASE WHEN v0 >= v1 AND v0 >= v2 THEN 0 WHEN v1 >= v2 THEN 1 ELSE 2 END AS prediction, n AS n_votes, v0 / n AS p0, v1 / n AS p1, v2 / n AS p2 FROM c""")
def _(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(6))))
    seed = F.concat(F.lit("vote-"), F.col("tree").cast("string"))
    voted = trees.hard_vote(o.withColumn("prediction", F.pmod(hash_key(F.col("id"), seed), F.lit(3)).cast("int")), [0, 1, 2])
    return voted.select("*", *[F.col("probability")[i].alias(f"p{i}") for i in range(3)])


def split_embeddings(spark, d):
    e = stratified_split(classify.with_vector(embeddings(spark, d), "x"), id_col="id", label_col="label")
    return e.filter("NOT is_test"), e.filter("is_test")


_PREDICTION = "id:i label:i prediction:i"


@check("random_forest", _PREDICTION)
def _(spark, d):
    train, test = split_embeddings(spark, d)
    return trees.ml_forest(train, features_col="features", label_col="label", n_trees=20, max_depth=6).transform(test)


@check("decision_tree", _PREDICTION)
def _(spark, d):
    train, test = split_embeddings(spark, d)
    return trees.ml_tree(train, features_col="features", label_col="label").transform(test)


_REACHED = ", ".join(f"at{d + 1} AS (SELECT a.id, a.tree, coalesce(e.child, a.node) AS node, price, cust, month, e.child IS NULL OR a.done AS done FROM at{d} a "
                     f"LEFT JOIN be{d} b ON b.tree = a.tree AND b.node = a.node AND NOT a.done LEFT JOIN ed{d} e ON e.tree = a.tree AND e.node = a.node AND NOT a.done "
                     f"AND e.key = CASE WHEN (CASE feature WHEN 'price' THEN price WHEN 'cust' THEN cust ELSE month END) < threshold THEN 'l' ELSE 'ge' END)" for d in range(2))


@check("exact_forest", "id:i prediction:i n_votes:i", f"""WITH {THREE}, {_BAGGED}, {_grown_sql(2, ['price', 'cust', 'month'], [], 'chosen')}, nodes AS ({_nodes_sql(2)}),
  at0 AS (SELECT id, tree, 0 AS node, price, cust, month, FALSE AS done FROM three, (SELECT unnest(range(3)) AS tree)), {_REACHED},
  votes AS (SELECT id, majority FROM at2 JOIN nodes USING (tree, node)), counted AS (SELECT id, majority, count(*) AS c FROM votes GROUP BY 1, 2)
  SELECT id, majority AS prediction, 3 AS n_votes FROM counted QUALIFY row_number() OVER (PARTITION BY id ORDER BY c DESC, majority) = 1""")
def _(spark, d):
    t, forest = bagged_trees(spark, d)
    return trees.hard_vote(trees.tree_votes(t, forest, id_col="id"), [0, 1, 2])


@check("forest_importances", "feature:s importance:4")
def _(spark, d):
    train, _ = split_embeddings(spark, d)
    return trees.feature_importances(train, trees.ml_forest(train, features_col="features", label_col="label", max_depth=6), [f"x{i}" for i in range(64)])


# -- classifiers ---------------------------------------------------------------

_SPLIT = f"""split AS MATERIALIZED (SELECT id, x, label, row_number() OVER (PARTITION BY label ORDER BY {sql_key('id', 42, 15)}) <= floor(0.2 * count(*) OVER (PARTITION BY label) + 0.5) AS is_test FROM emb)"""
_KNN = f"""{EMB}, {_SPLIT}, cand AS (SELECT q.id, q.label, c.id AS neighbor, c.label AS vote, list_distance(q.x, c.x) AS d FROM split q JOIN split c ON q.is_test AND NOT c.is_test),
  nn AS MATERIALIZED (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbor) <= 5)"""


def _vote_sql(w):
    return f"WITH {_KNN}, v AS (SELECT id, label, vote, sum({w}) AS w FROM nn GROUP BY 1, 2, 3) SELECT id, label, vote AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY w DESC, vote) = 1"


def _knn(spark, d, weights):
    train, test = split_embeddings(spark, d)
    predicted = classify.knn_classify(train, test, id_col="id", x_col="x", label_col="label", k=5, weights=weights)
    return test.select("id", "label").join(predicted, "id")


@check("knn_classify_uniform", _PREDICTION, _vote_sql("1.0"))
def _(spark, d):
    return _knn(spark, d, "uniform")


@check("knn_classify_distance", _PREDICTION, _vote_sql("1.0 / (d + 1e-8)"))
def _(spark, d):
    return _knn(spark, d, "distance")


@check("linear_svm", _PREDICTION)
def _(spark, d):
    train, test = split_embeddings(spark, d)
    return classify.linear_svm(train).transform(test)


def _kernel_check(kind, gamma):
    @check(f"kernel_svm_{kind}", _PREDICTION)
    def _(spark, d):
        train, test = split_embeddings(spark, d)
        lifted, model = classify.kernel_svm(train.drop("features"), id_col="id", x_col="x", label_col="label", kind=kind, gamma=gamma, landmarks=64)
        return model.transform(lifted.transform(test.drop("features"), "x"))


for _kind, _gamma in (("rbf", "scale"), ("poly", "scale"), ("sigmoid", "auto")):
    _kernel_check(_kind, _gamma)


@check("logistic", _PREDICTION)
def _(spark, d):
    train, test = split_embeddings(spark, d)
    return classify.logistic(train).transform(test)


# -- metrics -------------------------------------------------------------------

_GUESS = THREE + f", guess AS MATERIALIZED (SELECT id, label, CASE WHEN {sql_uniform('id', repr('hit'))} < 0.6 THEN label ELSE {sql_key('id', repr('guess'))} % 3 END AS prediction FROM three)"


def guesses(spark, d):
    return three_class(spark, d).select("id", "label", F.when(uniform(F.col("id"), "hit") < 0.6, F.col("label")).otherwise(
        F.pmod(hash_key(F.col("id"), "guess"), F.lit(3)).cast("int")).alias("prediction"))


def _rates(src, tag=""):
    """Per-class rates of ``src`` as ``rate<tag>`` and their weighted summary as ``total<tag>``."""
    return f"""seen{tag} AS (SELECT label AS c FROM {src} UNION SELECT prediction FROM {src}),
  hits{tag} AS (SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted, count(*) FILTER (label = c AND prediction = c) AS hit
    FROM seen{tag}, {src} GROUP BY c),
  part{tag} AS (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r FROM hits{tag}),
  rate{tag} AS MATERIALIZED (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM part{tag}),
  total{tag} AS (SELECT sum(support) AS n_rows, sum(hit) / sum(support) AS accuracy, sum(p * support) / sum(support) AS "precision",
    sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1 FROM rate{tag})"""


@check("metric_summary", "n_rows:i accuracy:6 precision:6 recall:6 f1:6", f"WITH {_GUESS}, {_rates('guess')} SELECT * FROM total")
def _(spark, d):
    return metrics.summary(guesses(spark, d), label_col="label", prediction_col="prediction")


@check("class_report", "class:s precision:6 recall:6 f1:6 support:i", f"""WITH {_GUESS}, {_rates('guess')}
  SELECT CAST(c AS VARCHAR) AS class, p AS "precision", r AS recall, f AS f1, support FROM rate
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM rate
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM rate""")
def _(spark, d):
    return metrics.report(guesses(spark, d), label_col="label", prediction_col="prediction")


@check("confusion_matrix", "label:i prediction:i n:i", f"""WITH {_GUESS}, l AS (SELECT unnest(range(4)) AS v)
  SELECT a.v AS label, b.v AS prediction, count(guess.id) AS n FROM l a CROSS JOIN l b LEFT JOIN guess ON label = a.v AND prediction = b.v GROUP BY 1, 2""")
def _(spark, d):
    return metrics.confusion(guesses(spark, d), [0, 1, 2, 3], label_col="label", prediction_col="prediction")


def doc_scores(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(
        "doc_id", F.col("quality").alias("truth"), F.col("n_chars").cast("double").alias("score"))


_DOCS = "docs AS MATERIALIZED (SELECT doc_id, quality AS truth, CAST(n_chars AS DOUBLE) AS score FROM documents JOIN labels USING (doc_id))"
_ROC = """v AS (SELECT {by} score, count(*) FILTER (truth = 1) AS p, count(*) FILTER (truth <> 1) AS n FROM {src} GROUP BY ALL),
  c AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER ({part}) AS tp, sum(n) OVER ({part}) AS tn FROM v WINDOW w AS ({part} ORDER BY score DESC))"""


@check("roc_points", "threshold:6 tp:i fp:i tpr:6 fpr:6", f"""WITH {_DOCS}, {_ROC.format(by='', src='docs', part='')}
  SELECT score AS threshold, cp AS tp, cn AS fp, cp / tp AS tpr, cn / tn AS fpr FROM c""")
def _(spark, d):
    return metrics.roc_points(doc_scores(spark, d), truth_col="truth", score_col="score")


@check("roc_points_ranged", "source:s threshold:6 tp:i fp:i tpr:6 fpr:6", f"""WITH docs AS (SELECT nullif(source, 'src1') AS source, quality AS truth, CAST(n_chars AS DOUBLE) AS score
    FROM documents JOIN labels USING (doc_id)), {_ROC.format(by='source,', src='docs', part='PARTITION BY source')}
  SELECT source, score AS threshold, cp AS tp, cn AS fp, CASE WHEN c.tp > 0 THEN cp / c.tp ELSE 0 END AS tpr, CASE WHEN c.tn > 0 THEN cn / c.tn ELSE 0 END AS fpr FROM c""")
def _(spark, d):
    scored = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(
        F.when(F.col("source") != "src1", F.col("source")).alias("source"), F.col("quality").alias("truth"), F.col("n_chars").cast("double").alias("score"))
    return metrics.roc_points(scored, truth_col="truth", score_col="score", by=["source"], rows_per_window=10)


@check("auc", "n_pos:i n_neg:i auc:6", f"""WITH {_DOCS}, {_ROC.format(by='', src='docs', part='')}
  SELECT max(tp) AS n_pos, max(tn) AS n_neg, sum(n * (cp - p / 2)) / (max(tp) * max(tn)) AS auc FROM c""")
def _(spark, d):
    return metrics.auc(doc_scores(spark, d), truth_col="truth", score_col="score")


_PROBS = THREE + ", u AS (SELECT id, label, " + ", ".join(
    f"{sql_uniform('id', repr(f'p{i}'))} + CASE WHEN label = {i} THEN 0.3 ELSE 0 END AS u{i}" for i in range(3)) + """ FROM three),
  ovr AS MATERIALIZED (""" + " UNION ALL ".join(f"SELECT {i} AS cls, CASE WHEN label = {i} THEN 1 ELSE 0 END AS truth, u{i} / (u0 + u1 + u2) AS score FROM u" for i in range(3)) + ")"


@check("multiclass_auc", "average:s auc:6", f"""WITH {_PROBS}, {_ROC.format(by='cls,', src='ovr', part='PARTITION BY cls')},
  a AS (SELECT cls, max(tp) AS np, sum(n * (cp - p / 2)) / (max(tp) * max(tn)) AS auc FROM c GROUP BY cls),
  mv AS (SELECT score, count(*) FILTER (truth = 1) AS p, count(*) FILTER (truth <> 1) AS n FROM ovr GROUP BY 1),
  mc AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS cp FROM mv)
  SELECT 'class ' || cls AS average, auc FROM a UNION ALL SELECT 'weighted', sum(auc * np) / sum(np) FROM a
  UNION ALL SELECT 'micro', sum(n * (cp - p / 2)) / (sum(p) * sum(n)) FROM mc""")
def _(spark, d):
    return metrics.multiclass_auc(_probabilities(spark, d), [0, 1, 2], label_col="label", probability_col="probability")


def _probabilities(spark, d):
    u = [uniform(F.col("id"), f"p{i}") + F.when(F.col("label") == i, 0.3).otherwise(0) for i in range(3)]
    return three_class(spark, d).select("label", F.array(*[x / (u[0] + u[1] + u[2]) for x in u]).alias("probability"))


_POINTS = "score AS threshold, cp AS tp, cn AS fp, cp / c.tp AS tpr, cn / c.tn AS fpr FROM c"


@check("roc_points_by_class", "curve:s threshold:9 tp:i fp:i tpr:6 fpr:6", f"""WITH {_PROBS}, {_ROC.format(by='cls,', src='ovr', part='PARTITION BY cls')}
  SELECT 'class ' || cls AS curve, {_POINTS}""")
def _(spark, d):
    return metrics.multiclass_roc(_probabilities(spark, d), [0, 1, 2], label_col="label", probability_col="probability").filter("curve <> 'micro'")


@check("roc_points_micro", "threshold:9 tp:i fp:i tpr:6 fpr:6", f"WITH {_PROBS}, {_ROC.format(by='', src='ovr', part='')} SELECT {_POINTS}")
def _(spark, d):
    return metrics.multiclass_roc(_probabilities(spark, d), [0, 1, 2], label_col="label", probability_col="probability").filter("curve = 'micro'")


# -- search --------------------------------------------------------------------

_FOLDS = f"""{EMB_PAIRS}, fold AS MATERIALIZED (SELECT id, {sql_key('id', 42)} % 3 AS fold FROM emb),
  nn AS MATERIALIZED (SELECT p.id, a.fold, p.label, other_label AS vote, d, row_number() OVER (PARTITION BY p.id ORDER BY d, neighbor) AS rank
    FROM pairs p JOIN fold a ON a.id = p.id JOIN fold b ON b.id = neighbor WHERE a.fold <> b.fold QUALIFY rank <= 7),
  v AS (SELECT id, fold, label, k, weights, vote, sum(CASE weights WHEN 'uniform' THEN 1.0 ELSE 1.0 / (d + 1e-8) END) AS w
    FROM nn, (SELECT unnest([3, 5, 7]) AS k), (SELECT unnest(['uniform', 'distance']) AS weights) WHERE rank <= k GROUP BY ALL),
  p AS MATERIALIZED (SELECT id, fold, label, k, weights, vote AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY id, k, weights ORDER BY w DESC, vote) = 1),
  f AS (SELECT k, weights, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM p GROUP BY ALL),
  g AS MATERIALIZED (SELECT 2 AS p, weights, k, avg(accuracy) AS mean_accuracy, stddev_pop(accuracy) AS std_accuracy FROM f GROUP BY ALL)"""


def folded(spark, d):
    return embeddings(spark, d).withColumn("fold", fold_of("id", 3))


def grid(spark, d):
    return tuning.grid_search_knn(folded(spark, d), id_col="id", x_col="x", label_col="label", fold_col="fold", ks=(3, 5, 7))


@check("cross_validation_knn", "weights:s k:i fold:i accuracy:6", f"WITH {_FOLDS} SELECT weights, k, fold, accuracy FROM f")
def _(spark, d):
    votes = tuning.knn_fold_votes(folded(spark, d), id_col="id", x_col="x", label_col="label", fold_col="fold", ks=(3, 5, 7))
    return tuning.fold_accuracy(votes, ["weights", "k"])


@check("grid_search_knn", "p:i weights:s k:i mean_accuracy:6 std_accuracy:6", f"WITH {_FOLDS} SELECT * FROM g")
def _(spark, d):
    return grid(spark, d)


@check("search_report", "rank:i weights:s k:i mean_accuracy:6 is_best:b", f"""WITH {_FOLDS} SELECT row_number() OVER (ORDER BY mean_accuracy DESC, p, weights, k) AS rank, weights, k, mean_accuracy, rank = 1 AS is_best FROM g QUALIFY rank <= 5""")
def _(spark, d):
    return tuning.search_report(grid(spark, d), score="mean_accuracy", order=["p", "weights", "k"])


@check("results_round_trip", "p:i weights:s k:i mean_accuracy:6", f"WITH {_FOLDS} SELECT p, weights, k, mean_accuracy FROM g")
def _(spark, d):
    path = scratch_path(spark, "search-results")
    sources.write_results(grid(spark, d).select("p", "weights", "k", "mean_accuracy"), path)
    return sources.read_delimited(spark, path, "p int, weights string, k int, mean_accuracy double")


@check("accuracy_curves", "p:i weights:s k:i accuracy:6", f"WITH {_FOLDS} SELECT p, weights, k, mean_accuracy AS accuracy FROM g")
def _(spark, d):
    curves = tuning.accuracy_curves(grid(spark, d))
    return curves.select("p", "weights", F.explode(F.arrays_zip("ks", "accuracies")).alias("s")).select("p", "weights", F.col("s.ks").alias("k"), F.col("s.accuracies").alias("accuracy"))


_COMPARE = _GUESS + """, other AS MATERIALIZED (SELECT id, label, CASE WHEN """ + sql_uniform("id", repr("tuned")) + """ < 0.7 THEN label ELSE prediction END AS prediction FROM guess), """


def _compare_sql():
    melt = " UNION ALL ".join(f"""SELECT '{m}' AS metric, totala."{m}" AS baseline, totalb."{m}" AS tuned FROM totala, totalb""" for m in tuning.METRICS)
    return f"WITH {_COMPARE} {_rates('guess', 'a')}, {_rates('other', 'b')}, m AS ({melt}) SELECT *, tuned - baseline AS difference, 100 * (tuned - baseline) / baseline AS percent FROM m"


@check("compare_models", "metric:s baseline:6 tuned:6 difference:6 percent:4", _compare_sql())
def _(spark, d):
    g = guesses(spark, d)
    better = g.withColumn("prediction", F.when(uniform(F.col("id"), "tuned") < 0.7, F.col("label")).otherwise(F.col("prediction")))
    rate = lambda x: metrics.summary(x, label_col="label", prediction_col="prediction")
    return tuning.compare_models(rate(g), rate(better))


def _gap_sql():
    part = "guess{k} AS MATERIALIZED (SELECT id, label, prediction FROM guess WHERE (id % 5 = 0) = {test})"
    sides = ", ".join(part.format(k=k, test=t) for k, t in (("tr", "FALSE"), ("te", "TRUE")))
    melt = " UNION ALL ".join(f"""SELECT '{m}' AS metric, totala."{m}" AS train, totalb."{m}" AS test, totala."{m}" - totalb."{m}" AS gap FROM totala, totalb""" for m in tuning.METRICS)
    return f"WITH {_GUESS}, {sides}, {_rates('guesstr', 'a')}, {_rates('guesste', 'b')} {melt}"


@check("train_test_gap", "metric:s train:6 test:6 gap:6", _gap_sql())
def _(spark, d):
    rate = lambda x: metrics.summary(x, label_col="label", prediction_col="prediction")
    g = guesses(spark, d)
    return tuning.train_test_gap(rate(g.filter("id % 5 <> 0")), rate(g.filter("id % 5 = 0")))


@check("random_search_svm", "candidate:i params:s mean_score:4 std_score:4")
def _(spark, d):
    return stacked.search_linear(folded(spark, d), tuning.random_draws({"C": (0.01, 10.0)}, 2), id_col="id", x_col="x", label_col="label", fold_col="fold", n_folds=3, scoring="f1")


@check("random_search_svm_wide", "candidate:i params:s mean_score:4 std_score:4")
def _(spark, d):
    return stacked.search_linear(folded(spark, d), tuning.random_draws({"C": (0.01, 10.0)}, 10), id_col="id", x_col="x", label_col="label", fold_col="fold", n_folds=3)


@check("grid_search_logistic", "candidate:i params:s mean_score:4 std_score:4")
def _(spark, d):
    return stacked.search_linear(folded(spark, d), tuning.grid_of({"C": [0.01, 0.1, 1.0, 10.0]}), id_col="id", x_col="x", label_col="label", fold_col="fold", n_folds=3, loss="logistic")


def _fit_forest(train, test, params, fold):
    return trees.ml_forest(train, features_col="features", label_col="label", n_trees=params["n_trees"], max_depth=params["max_depth"], seed=42 + fold).transform(test)


@check("grid_search_forest", "candidate:i params:s mean_score:4 std_score:4")
def _(spark, d):
    rows = classify.with_vector(folded(spark, d), "x").select("id", "features", "label", "fold")
    return tuning.search(rows, _fit_forest, tuning.grid_of({"n_trees": [5, 10], "max_depth": [4]}), fold_col="fold", label_col="label", n_folds=3)


_REFIT = f"""{EMB.replace('emb AS', 'every AS')}, {_SPLIT.replace('FROM emb', 'FROM every')}, emb AS MATERIALIZED (SELECT id, x, label FROM split WHERE NOT is_test),
  {_FOLDS[len(EMB) + 2:]}, best AS (SELECT k, weights FROM g ORDER BY round(mean_accuracy, 12) DESC, p, weights DESC, k LIMIT 1),
  far AS (SELECT q.id, q.label, c.id AS neighbor, c.label AS vote, list_distance(q.x, c.x) AS d, row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.x, c.x), c.id) AS rank
    FROM split q JOIN split c ON q.is_test AND NOT c.is_test),
  fv AS (SELECT id, label, vote, sum(CASE weights WHEN 'uniform' THEN 1.0 ELSE 1.0 / (d + 1e-8) END) AS w FROM far, best WHERE rank <= k GROUP BY ALL),
  guess AS MATERIALIZED (SELECT id, label, vote AS prediction FROM fv QUALIFY row_number() OVER (PARTITION BY id ORDER BY w DESC, vote) = 1)"""


@check("refit_best_knn", "n_rows:i accuracy:6 precision:6 recall:6 f1:6", f"WITH {_REFIT}, {_rates('guess')} SELECT * FROM total")
def _(spark, d):
    train, test = split_embeddings(spark, d)
    results = cut(tuning.grid_search_knn(train.withColumn("fold", fold_of("id", 3)), id_col="id", x_col="x", label_col="label", fold_col="fold", ks=(3, 5, 7)))
    return tuning.refit_knn(train, test, results, id_col="id", x_col="x", label_col="label")


@check("correct_projection", "id:i pc1:4 pc2:4 label:i prediction:i correct:b")
def _(spark, d):
    train, test = split_embeddings(spark, d)
    projected = reduction.fit_pca(train, x_col="x", k=2).coordinates(test, id_col="id", x_col="x")
    return tuning.correct_projection(projected, _knn(spark, d, "uniform"), id_col="id")
