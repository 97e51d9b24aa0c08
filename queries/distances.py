"""Checks for sampling, neighbours, clustering and cluster quality."""

from pyspark.sql import functions as F

from queries.base import EMB_LONG, EMB_PAIRS, USER_PLANE, USERS, check, embeddings, sql_key, sql_uniform, table, user_features, user_plane
from sparkmine.functions.keys import hash_key
from sparkmine.lineage import cut
from sparkmine.operators import cluster_quality, dbscan, kmeans, linkage, neighbors, sampling

# -- sampling ------------------------------------------------------------------


@check("sample_exact", "event_id:i value:4", f"SELECT event_id, value FROM events ORDER BY {sql_key('event_id', 42, 15)}, event_id LIMIT 1000")
def _(spark, d):
    return sampling.sample_exact(table(spark, d, "events").select("event_id", "value"), 1000, id_col="event_id")


@check("stratified_split", "event_id:i event_type:s is_test:b", f"""WITH r AS (SELECT event_id, event_type,
    row_number() OVER (PARTITION BY event_type ORDER BY {sql_key('event_id', 42, 15)}) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT event_id, event_type, rn <= floor(0.2 * n + 0.5) AS is_test FROM r""")
def _(spark, d):
    return sampling.stratified_split(table(spark, d, "events").select("event_id", "event_type"), id_col="event_id", label_col="event_type")


@check("stratified_split_null_class", "event_id:i event_type:s is_test:b", f"""WITH e AS (SELECT event_id, nullif(event_type, 'view') AS event_type FROM events),
  r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {sql_key('event_id', 42, 15)}) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM e)
  SELECT event_id, event_type, rn <= floor(0.2 * n + 0.5) AS is_test FROM r""")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"))
    return sampling.stratified_split(e, id_col="event_id", label_col="event_type")


@check("kfold", "o_orderkey:i fold:i", f"SELECT o_orderkey, {sql_key('o_orderkey', 7)} % 5 AS fold FROM orders")
def _(spark, d):
    return sampling.kfold(table(spark, d, "orders").select("o_orderkey"), 5, id_col="o_orderkey", seed=7)


def _poisson_sql(u):
    import math

    below, mass, parts = 0.0, math.exp(-1.0), []
    for i in range(1, sampling.POISSON_TERMS + 1):
        below += mass
        parts.append(f"CASE WHEN {u} > CAST('{below!r}' AS DOUBLE) THEN 1 ELSE 0 END")
        mass /= i
    return " + ".join(parts)


_DRAWN = f"""t AS (SELECT event_id, value, unnest(range(3)) AS tree FROM events),
  u AS (SELECT *, {sql_uniform('event_id', "'42-' || tree")} AS u FROM t), w AS (SELECT event_id, tree, value, {_poisson_sql('u')} AS weight FROM u)"""


@check("bootstrap", "event_id:i tree:i weight:i", f"WITH {_DRAWN} SELECT event_id, tree, weight FROM w WHERE weight > 0")
def _(spark, d):
    return sampling.bootstrap(table(spark, d, "events").select("event_id"), 3, id_col="event_id")


_FEATURES = ("n_events", "avg_value", "sd_value", "n_click", "n_error", "n_purchase", "n_signup", "n_view")


@check("bagged_feature_means", "tree:i feature:s n_drawn:i mean:6", f"""WITH {USERS},
  f AS (SELECT unnest([{', '.join(repr(f) for f in _FEATURES)}]) AS feature), g AS (SELECT feature, unnest(range(4)) AS tree FROM f),
  k AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY {sql_key("feature || '-' || tree", 42)}, feature) AS rn FROM g),
  t AS (SELECT *, unnest(range(4)) AS tree FROM users), u AS (SELECT *, {sql_uniform('id', "'42-' || tree")} AS u FROM t), w AS (SELECT *, {_poisson_sql('u')} AS weight FROM u),
  m AS ({' UNION ALL '.join(f"SELECT tree, '{f}' AS feature, sum(weight) AS n_drawn, sum({f} * weight) / sum(weight) AS mean FROM w GROUP BY tree" for f in _FEATURES)})
  SELECT m.* FROM m JOIN k USING (tree, feature) WHERE rn <= 3""")
def _(spark, d):
    return sampling.bagged_means(user_features(spark, d), _FEATURES, id_col="id", n_trees=4, size=3)


# -- neighbours ----------------------------------------------------------------

@check("pairwise_distance_profile", "id:i n_others:i sum_distance:5 min_distance:6 max_distance:6 mean_distance:6", f"""WITH {EMB_PAIRS}
  SELECT id, count(*) AS n_others, sum(d) AS sum_distance, min(d) AS min_distance, max(d) AS max_distance, avg(d) AS mean_distance FROM pairs GROUP BY id""")
def _(spark, d):
    return neighbors.distance_profile(embeddings(spark, d), id_col="id", x_col="x")


@check("nearest_centroid", "id:i cluster:i distance:6", f"""WITH {EMB_LONG}, c AS (SELECT label AS cluster, dim, avg(v) AS v FROM emb_long GROUP BY 1, 2),
  d AS (SELECT id, cluster, sqrt(sum((e.v - c.v) ** 2)) AS distance FROM emb_long e JOIN c USING (dim) GROUP BY 1, 2)
  SELECT id, cluster, distance FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1""")
def _(spark, d):
    e = embeddings(spark, d)
    # one centre per label
    centers = [r["center"] for r in cluster_quality.centroid_table(e, x_col="x", cluster_col="label").orderBy("cluster").collect()]
    return neighbors.nearest_center(e, centers, x_col="x")


@check("knn_euclidean", "id:i neighbor:i distance:6 rank:i", f"""WITH {EMB_PAIRS}
  SELECT id, neighbor, d AS distance, row_number() OVER (PARTITION BY id ORDER BY d, neighbor) AS rank FROM pairs QUALIFY rank <= 5""")
def _(spark, d):
    return neighbors.k_nearest(embeddings(spark, d), id_col="id", x_col="x", k=5)


@check("knn_manhattan", "id:i neighbor:i distance:6 rank:i", f"""WITH {USER_PLANE},
  p AS (SELECT a.id, b.id AS neighbor, abs(a.x1 - b.x1) + abs(a.x2 - b.x2) AS d FROM plane a JOIN plane b ON a.id <> b.id)
  SELECT id, neighbor, d AS distance, row_number() OVER (PARTITION BY id ORDER BY d, neighbor) AS rank FROM p QUALIFY rank <= 4""")
def _(spark, d):
    return neighbors.k_nearest(user_plane(spark, d), id_col="id", x_col="x", k=4, p=1)


def customer_plane(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")).alias("x"))


CUSTOMERS = "cust AS MATERIALIZED (SELECT c_custkey AS id, c_acctbal / 100 AS x1, CAST(c_nationkey AS DOUBLE) AS x2 FROM customer)"


@check("radius_neighbors", "id:i n_neighbors:i first_neighbor:i last_neighbor:i sum_distance:5", f"""WITH {CUSTOMERS},
  p AS (SELECT a.id, b.id AS neighbor, sqrt((a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2) AS d FROM cust a JOIN cust b ON a.id <> b.id),
  n AS (SELECT id, count(*) AS n, min(neighbor) AS first_neighbor, max(neighbor) AS last_neighbor, sum(d) AS s FROM p WHERE d <= 2.5 GROUP BY id)
  SELECT cust.id, coalesce(n, 0) AS n_neighbors, first_neighbor, last_neighbor, coalesce(s, 0) AS sum_distance FROM cust LEFT JOIN n ON n.id = cust.id""")
def _(spark, d):
    return neighbors.radius_profile(customer_plane(spark, d), id_col="id", x_col="x", eps=2.5)


@check("k_distance_percentiles", "q:2 value:6", f"""WITH {EMB_PAIRS},
  k AS (SELECT id, d FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbor) = 4)
  SELECT q, quantile_cont(d, q) AS value FROM k, (SELECT 1) GROUP BY q""".replace(
    "SELECT q, quantile_cont(d, q) AS value FROM k, (SELECT 1) GROUP BY q",
    " UNION ALL ".join(f"SELECT {q} AS q, quantile_cont(d, {q}) AS value FROM k" for q in (0.25, 0.5, 0.75, 0.9))))
def _(spark, d):
    kd = neighbors.k_distance(embeddings(spark, d), id_col="id", x_col="x", min_pts=5)
    qs = (0.25, 0.5, 0.75, 0.9)
    return spark.createDataFrame(list(zip(qs, neighbors.k_distance_percentiles(cut(kd), qs))), "q double, value double")


# -- k-means -------------------------------------------------------------------

def _seed_sql(k):
    """D² seeding, one CTE per centre."""
    out = f"s0 AS MATERIALIZED (SELECT id FROM emb ORDER BY {sql_key('id', repr('42-0'))}, id LIMIT 1)"
    for r in range(1, k):
        seen = " UNION ALL ".join(f"SELECT id FROM s{i}" for i in range(r))
        out += f""", d{r} AS MATERIALIZED (SELECT e.id, min(list_distance(e.x, c.x)) AS d FROM emb e, ({seen}) s JOIN emb c ON c.id = s.id GROUP BY e.id),
          s{r} AS MATERIALIZED (SELECT id FROM d{r} WHERE d > 0 ORDER BY -ln({sql_uniform('id', repr(f'42-{r}'))}) / (d * d), id LIMIT 1)"""
    return out


@check("kmeans_seeding", "cluster:i dim:i v:6", f"WITH {EMB_LONG}, {_seed_sql(4)} " + " UNION ALL ".join(
    f"SELECT {i} AS cluster, dim, v FROM emb_long JOIN s{i} USING (id)" for i in range(4)))
def _(spark, d):
    centers = kmeans.seed_centers(embeddings(spark, d), id_col="id", x_col="x", k=4)
    return spark.createDataFrame(list(enumerate(centers)), "cluster int, x array<double>").select("cluster", F.posexplode("x").alias("dim", "v"))


def _lloyd_sql(k, rounds):
    out = f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {sql_key('id', repr('start'))}) - 1 AS cluster, id FROM emb ORDER BY 1 LIMIT {k}),
      m0 AS MATERIALIZED (SELECT cluster, dim, v FROM emb_long JOIN c0 USING (id))"""
    for r in range(1, rounds + 1):
        out += f""", a{r} AS MATERIALIZED (SELECT id, cluster FROM (SELECT e.id, m.cluster, sum((e.v - m.v) ** 2) AS d FROM emb_long e JOIN m{r - 1} m USING (dim) GROUP BY 1, 2)
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, cluster) = 1),
          m{r} AS MATERIALIZED (SELECT cluster, dim, avg(v) AS v FROM emb_long JOIN a{r} USING (id) GROUP BY 1, 2)"""
    return out


def lloyd_fit(spark, d):
    e = embeddings(spark, d)
    # four starting centres
    start = [r["x"] for r in e.orderBy(hash_key(F.col("id"), "start")).limit(4).collect()]
    return e, kmeans.lloyd(e, start, x_col="x", max_iter=3)


@check("kmeans_lloyd", "id:i cluster:i", f"WITH {EMB_LONG}, {_lloyd_sql(4, 3)} SELECT id, cluster FROM a3")
def _(spark, d):
    e, fit = lloyd_fit(spark, d)
    return fit.transform(e, "x")


@check("kmeans_centers", "cluster:i dim:i v:6", f"WITH {EMB_LONG}, {_lloyd_sql(4, 3)} SELECT cluster, dim, v FROM m3")
def _(spark, d):
    _, fit = lloyd_fit(spark, d)
    return spark.createDataFrame(list(enumerate(fit.centers)), "cluster int, x array<double>").select("cluster", F.posexplode("x").alias("dim", "v"))


@check("kmeans_sweep", "k:i silhouette:4 calinski_harabasz:4 davies_bouldin:4 is_best:b")
def _(spark, d):
    return cluster_quality.sweep_kmeans(embeddings(spark, d), id_col="id", x_col="x", ks=(2, 3, 4))


# -- quality -------------------------------------------------------------------

_SIL = """per AS (SELECT p.id, p.label AS cluster, other_label, avg(d) AS m FROM pairs p GROUP BY 1, 2, 3),
  ab AS (SELECT id, cluster, max(CASE WHEN other_label = cluster THEN m END) AS a, min(CASE WHEN other_label <> cluster THEN m END) AS b FROM per GROUP BY 1, 2)"""


@check("silhouette_rows", "id:i cluster:i a:6 b:6 silhouette:6", f"WITH {EMB_PAIRS}, {_SIL} SELECT id, cluster, a, b, (b - a) / greatest(a, b) AS silhouette FROM ab")
def _(spark, d):
    return cluster_quality.silhouette_rows(embeddings(spark, d), id_col="id", x_col="x", cluster_col="label")


@check("silhouette_sampled", "n_rows:i silhouette:6", f"""WITH {EMB_PAIRS}, {_SIL}, s AS (SELECT id FROM emb ORDER BY {sql_key('id', 42, 15)} LIMIT 200)
  SELECT count(*) AS n_rows, avg((b - a) / greatest(a, b)) AS silhouette FROM ab JOIN s USING (id)""")
def _(spark, d):
    e = embeddings(spark, d)
    return cluster_quality.silhouette(e, id_col="id", x_col="x", cluster_col="label", sample=sampling.sample_exact(e, 200, id_col="id"))


@check("calinski_harabasz", "n_rows:i n_clusters:i between:6 within:6 calinski_harabasz:6", f"""WITH {EMB_LONG}, g AS (SELECT dim, avg(v) AS g FROM emb_long GROUP BY dim),
  c AS (SELECT label, dim, avg(v) AS c, count(*) AS n FROM emb_long GROUP BY 1, 2),
  b AS (SELECT sum(n * (c - g) ** 2) AS between FROM c JOIN g USING (dim)), w AS (SELECT sum((v - c) ** 2) AS within FROM emb_long e JOIN c ON e.label = c.label AND e.dim = c.dim),
  t AS (SELECT count(*) AS n_rows, count(DISTINCT label) AS n_clusters FROM emb)
  SELECT n_rows, n_clusters, "between", "within", ("between" / (n_clusters - 1)) / ("within" / (n_rows - n_clusters)) AS calinski_harabasz FROM t, b, w""".replace(
    "AS between", 'AS "between"').replace("AS within", 'AS "within"'))
def _(spark, d):
    return cluster_quality.calinski_harabasz(embeddings(spark, d), x_col="x", cluster_col="label")


@check("davies_bouldin", "n_clusters:i davies_bouldin:6", f"""WITH {EMB_LONG}, c AS (SELECT label, dim, avg(v) AS c FROM emb_long GROUP BY 1, 2),
  r AS (SELECT e.label, e.id, sqrt(sum((v - c) ** 2)) AS d FROM emb_long e JOIN c ON e.label = c.label AND e.dim = c.dim GROUP BY 1, 2), s AS (SELECT label, avg(d) AS s FROM r GROUP BY 1),
  m AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.c - b.c) ** 2)) AS d FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2),
  x AS (SELECT i, max((si.s + sj.s) / d) AS r FROM m JOIN s si ON si.label = i JOIN s sj ON sj.label = j GROUP BY i)
  SELECT count(*) AS n_clusters, avg(r) AS davies_bouldin FROM x""")
def _(spark, d):
    return cluster_quality.davies_bouldin(embeddings(spark, d), x_col="x", cluster_col="label")


@check("contingency", "cluster:i label:i n:i cluster_size:i share:6", f"""WITH {EMB_LONG}, {_lloyd_sql(4, 3)}
  SELECT cluster, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY cluster) AS cluster_size, count(*) / sum(count(*)) OVER (PARTITION BY cluster) AS share
  FROM a3 JOIN emb USING (id) GROUP BY 1, 2""")
def _(spark, d):
    e, fit = lloyd_fit(spark, d)
    return cluster_quality.contingency(fit.transform(e, "x"), cluster_col="cluster", label_col="label")


@check("purity", "n_rows:i purity:6", f"""WITH {EMB_LONG}, {_lloyd_sql(4, 3)}, c AS (SELECT cluster, label, count(*) AS n FROM a3 JOIN emb USING (id) GROUP BY 1, 2)
  SELECT sum(n) AS n_rows, sum(top) / sum(n) AS purity FROM (SELECT cluster, max(n) AS top, sum(n) AS n FROM c GROUP BY cluster)""")
def _(spark, d):
    e, fit = lloyd_fit(spark, d)
    return cluster_quality.purity(fit.transform(e, "x"), cluster_col="cluster", label_col="label")


# -- density clustering --------------------------------------------------------

EPS, MIN_PTS = 0.35, 4
_DBSCAN = f"""near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM plane a JOIN plane b ON a.id <> b.id AND sqrt((a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2) <= {EPS}),
  core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_PTS}),
  ce AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
  walk(id, root) AS (SELECT id, id FROM core UNION SELECT ce.b, walk.root FROM walk JOIN ce ON ce.a = walk.id),
  comp AS (SELECT id, min(root) AS root FROM walk GROUP BY id), num AS (SELECT id, dense_rank() OVER (ORDER BY root) AS cluster FROM comp),
  edge AS (SELECT near.a AS id, min(num.cluster) AS cluster FROM near JOIN num ON near.b = num.id GROUP BY near.a),
  lab AS (SELECT plane.id, coalesce(num.cluster, edge.cluster, 0) AS cluster, num.cluster IS NOT NULL AS is_core
    FROM plane LEFT JOIN num ON num.id = plane.id LEFT JOIN edge ON edge.id = plane.id)"""


@check("dbscan", "id:i cluster:i is_core:b", f"WITH RECURSIVE {USER_PLANE}, {_DBSCAN} SELECT * FROM lab")
def _(spark, d):
    return dbscan.dbscan(user_plane(spark, d), id_col="id", x_col="x", eps=EPS, min_pts=MIN_PTS)


NEAR_CUSTOMERS = 0.99
_DENSE_CUSTOMERS = CUSTOMERS.replace("cust AS", "plane AS") + ", " + _DBSCAN.replace(f"<= {EPS}", f"<= {NEAR_CUSTOMERS}").replace(f">= {MIN_PTS}", ">= 2")


@check("dbscan_customers", "id:i cluster:i is_core:b", f"WITH RECURSIVE {_DENSE_CUSTOMERS} SELECT * FROM lab")
def _(spark, d):
    return dbscan.dbscan(customer_plane(spark, d), id_col="id", x_col="x", eps=NEAR_CUSTOMERS, min_pts=2)


@check("cluster_sizes", "cluster:i n:i is_noise:b", f"WITH RECURSIVE {USER_PLANE}, {_DBSCAN} SELECT cluster, count(*) AS n, cluster = 0 AS is_noise FROM lab GROUP BY cluster")
def _(spark, d):
    return cluster_quality.cluster_sizes(dbscan.dbscan(user_plane(spark, d), id_col="id", x_col="x", eps=EPS, min_pts=MIN_PTS), cluster_col="cluster")


@check("cluster_summary", "n_clusters:i n_noise:i n_rows:i", f"""WITH RECURSIVE {USER_PLANE}, {_DBSCAN}
  SELECT count(DISTINCT cluster) FILTER (cluster > 0) AS n_clusters, count(*) FILTER (cluster = 0) AS n_noise, count(*) AS n_rows FROM lab""")
def _(spark, d):
    return cluster_quality.cluster_summary(dbscan.dbscan(user_plane(spark, d), id_col="id", x_col="x", eps=EPS, min_pts=MIN_PTS), cluster_col="cluster")


_APART = "dist AS MATERIALIZED (SELECT a.id AS a, b.id AS b, sqrt((a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2) AS d FROM plane a JOIN plane b ON a.id <> b.id)"
# scores of labelled rows lab (k, id, cluster) of the plane
_SCORED = """per AS (SELECT l.k, l.id, l.cluster, o.cluster AS other, avg(d) AS m FROM lab l JOIN dist ON dist.a = l.id JOIN lab o ON o.k = l.k AND o.id = dist.b GROUP BY 1, 2, 3, 4),
  ab AS (SELECT k, id, max(CASE WHEN other = cluster THEN m END) AS a, min(CASE WHEN other <> cluster THEN m END) AS b FROM per GROUP BY 1, 2),
  sil AS (SELECT k, avg(CASE WHEN a IS NULL OR greatest(a, coalesce(b, a)) = 0 THEN 0 ELSE (coalesce(b, a) - a) / greatest(a, coalesce(b, a)) END) AS silhouette FROM ab GROUP BY k),
  cen AS (SELECT k, cluster, avg(x1) AS c1, avg(x2) AS c2, count(*) AS n FROM lab JOIN plane USING (id) GROUP BY 1, 2),
  mid AS (SELECT k, avg(x1) AS g1, avg(x2) AS g2, count(*) AS n FROM lab JOIN plane USING (id) GROUP BY 1),
  far AS (SELECT k, cluster, avg(sqrt((x1 - c1) ** 2 + (x2 - c2) ** 2)) AS s, sum((x1 - c1) ** 2 + (x2 - c2) ** 2) AS w FROM lab JOIN plane USING (id) JOIN cen USING (k, cluster) GROUP BY 1, 2),
  ch AS (SELECT k, (sum(cen.n * ((c1 - g1) ** 2 + (c2 - g2) ** 2)) / (count(*) - 1)) / (sum(w) / (max(mid.n) - count(*))) AS ch FROM cen JOIN far USING (k, cluster) JOIN mid USING (k) GROUP BY k),
  worst AS (SELECT a.k, a.cluster, max((fa.s + fb.s) / sqrt((a.c1 - b.c1) ** 2 + (a.c2 - b.c2) ** 2)) AS r FROM cen a JOIN cen b ON a.k = b.k AND a.cluster <> b.cluster
    JOIN far fa ON fa.k = a.k AND fa.cluster = a.cluster JOIN far fb ON fb.k = b.k AND fb.cluster = b.cluster GROUP BY 1, 2),
  db AS (SELECT k, avg(r) AS db FROM worst GROUP BY k),
  scored AS (SELECT k, silhouette, ch AS calinski_harabasz, db AS davies_bouldin FROM sil JOIN ch USING (k) JOIN db USING (k))"""


_RADII = " UNION ALL ".join(f"SELECT {i + 1} AS step, {f} * quantile_cont(d, {q}) AS eps FROM kd" for i, (q, f) in enumerate(((0.25, 1.0), (0.5, 1.0), (0.75, 1.0), (0.9, 1.0), (0.9, 1.5), (0.9, 2.0))))


@check("dbscan_sweep", "step:i eps:6 n_clusters:i n_noise:i silhouette:4 calinski_harabasz:4 davies_bouldin:4 is_best:b", f"""WITH RECURSIVE {USER_PLANE}, {_APART},
  kd AS (SELECT a AS id, d FROM dist QUALIFY row_number() OVER (PARTITION BY a ORDER BY d, b) = 4), radii AS MATERIALIZED ({_RADII}),
  near AS MATERIALIZED (SELECT step, a, b FROM radii JOIN dist ON d <= eps), core AS MATERIALIZED (SELECT step, a AS id FROM near GROUP BY 1, 2 HAVING count(*) >= 5),
  ce AS MATERIALIZED (SELECT n.* FROM near n SEMI JOIN core x ON x.step = n.step AND x.id = n.a SEMI JOIN core y ON y.step = n.step AND y.id = n.b),
  walk(step, id, root) AS (SELECT step, id, id FROM core UNION SELECT ce.step, ce.b, walk.root FROM walk JOIN ce ON ce.step = walk.step AND ce.a = walk.id),
  num AS (SELECT step, id, dense_rank() OVER (PARTITION BY step ORDER BY root) AS cluster FROM (SELECT step, id, min(root) AS root FROM walk GROUP BY 1, 2)),
  edge AS (SELECT near.step, near.a AS id, min(cluster) AS cluster FROM near JOIN num ON num.step = near.step AND num.id = near.b GROUP BY 1, 2),
  every AS MATERIALIZED (SELECT r.step, p.id, coalesce(num.cluster, edge.cluster, 0) AS cluster FROM plane p CROSS JOIN radii r
    LEFT JOIN num ON num.step = r.step AND num.id = p.id LEFT JOIN edge ON edge.step = r.step AND edge.id = p.id),
  sizes AS MATERIALIZED (SELECT step, cluster, count(*) AS n FROM every GROUP BY 1, 2),
  told AS (SELECT step, count(*) FILTER (cluster > 0) AS n_clusters, coalesce(sum(n) FILTER (cluster = 0), 0) AS n_noise, count(*) FILTER (cluster > 0 AND n >= 2) AS valid FROM sizes GROUP BY step),
  lab AS MATERIALIZED (SELECT step AS k, id, cluster FROM every SEMI JOIN (SELECT step, cluster FROM sizes WHERE cluster > 0 AND n >= 2) v USING (step, cluster)
    SEMI JOIN (SELECT step FROM told WHERE n_clusters > 1 AND valid > 1) t USING (step)), {_SCORED},
  res AS (SELECT step, eps, n_clusters, n_noise, coalesce(silhouette, -1) AS silhouette, coalesce(calinski_harabasz, -1) AS calinski_harabasz,
    coalesce(davies_bouldin, -1) AS davies_bouldin FROM radii JOIN told USING (step) LEFT JOIN scored ON k = step)
  SELECT *, step = first_value(step) OVER (ORDER BY CASE WHEN silhouette > -1 THEN 0 ELSE 1 END, CASE WHEN silhouette > -1 THEN -silhouette ELSE -n_clusters END, step) AS is_best FROM res""")
def _(spark, d):
    return dbscan.sweep_eps(user_plane(spark, d), id_col="id", x_col="x", min_pts=5)[0]


@check("dbscan_levels", "id:i level:i cluster:i", f"""WITH RECURSIVE {USER_PLANE}, {_APART}, radii AS (SELECT unnest([0, 1, 2]) AS step, unnest([0.2, 0.35, 0.6]) AS eps),
  near AS MATERIALIZED (SELECT step, a, b FROM radii JOIN dist ON d <= eps), core AS MATERIALIZED (SELECT step, a AS id FROM near GROUP BY 1, 2 HAVING count(*) >= 4),
  ce AS MATERIALIZED (SELECT n.* FROM near n SEMI JOIN core x ON x.step = n.step AND x.id = n.a SEMI JOIN core y ON y.step = n.step AND y.id = n.b),
  walk(step, id, root) AS (SELECT step, id, id FROM core UNION SELECT ce.step, ce.b, walk.root FROM walk JOIN ce ON ce.step = walk.step AND ce.a = walk.id),
  num AS (SELECT step, id, dense_rank() OVER (PARTITION BY step ORDER BY root) AS cluster FROM (SELECT step, id, min(root) AS root FROM walk GROUP BY 1, 2)),
  edge AS (SELECT near.step, near.a AS id, min(cluster) AS cluster FROM near JOIN num ON num.step = near.step AND num.id = near.b GROUP BY 1, 2)
  SELECT p.id, r.step AS level, coalesce(num.cluster, edge.cluster, 0) AS cluster FROM plane p CROSS JOIN radii r
    LEFT JOIN num ON num.step = r.step AND num.id = p.id LEFT JOIN edge ON edge.step = r.step AND edge.id = p.id""")
def _(spark, d):
    return dbscan.dbscan_levels(user_plane(spark, d), id_col="id", x_col="x", radii=(0.2, 0.35, 0.6), min_pts=4)


# -- linkage -------------------------------------------------------------------

@check("average_linkage", "id:i cluster:i")
def _(spark, d):
    return linkage.average_linkage(embeddings(spark, d), id_col="id", x_col="x", k=5)


# one pair merges a step; a recursion step sees the labels of the step before
_LINKED = f"""{_APART}, steps(step, id, cluster) AS (SELECT 0, id, id FROM plane UNION ALL
    SELECT s.step + 1, s.id, CASE WHEN s.cluster = m.b THEN m.a ELSE s.cluster END
    FROM steps s, (SELECT x.cluster AS a, y.cluster AS b FROM steps x JOIN dist ON dist.a = x.id JOIN steps y ON dist.b = y.id WHERE x.cluster < y.cluster
      GROUP BY 1, 2 ORDER BY avg(d), 1, 2 LIMIT 1) m),
  cuts AS (SELECT n - step AS k, id, dense_rank() OVER (PARTITION BY step ORDER BY cluster) - 1 AS cluster FROM steps, (SELECT count(*) AS n FROM plane) t)"""
def _plane_seeds(k):
    """D² seeding on the plane, one CTE per centre, and the start of every run."""
    out = f"s0 AS MATERIALIZED (SELECT id FROM plane ORDER BY {sql_key('id', repr('42-0'))}, id LIMIT 1)"
    for r in range(1, k):
        seen = " UNION ALL ".join(f"SELECT id FROM s{i}" for i in range(r))
        out += f""", d{r} AS MATERIALIZED (SELECT e.id, min(sqrt((e.x1 - c.x1) ** 2 + (e.x2 - c.x2) ** 2)) AS d FROM plane e, ({seen}) s JOIN plane c ON c.id = s.id GROUP BY e.id),
          s{r} AS MATERIALIZED (SELECT id FROM d{r} WHERE d > 0 ORDER BY -ln({sql_uniform('id', repr(f'42-{r}'))}) / (d * d), id LIMIT 1)"""
    start = " UNION ALL ".join(f"SELECT k, {r} AS cluster, x1, x2 FROM s{r} JOIN plane USING (id), ks WHERE k > {r}" for r in range(k))
    return f"{out}, ks AS (SELECT unnest([2, 3, 4]) AS k), start AS MATERIALIZED ({start})"


# sixty rounds are more than any of the runs needs; an empty cluster keeps its centre
_RUNS = f"""{_plane_seeds(4)}, runs(it, k, cluster, c1, c2) AS (SELECT 0, k, cluster, x1, x2 FROM start UNION ALL
    SELECT l.it + 1, l.k, l.cluster, coalesce(m1, l.c1), coalesce(m2, l.c2) FROM runs l LEFT JOIN (SELECT k, own, avg(x1) AS m1, avg(x2) AS m2 FROM
      (SELECT r.k, p.id, p.x1, p.x2, arg_min(r.cluster, (p.x1 - r.c1) ** 2 + (p.x2 - r.c2) ** 2) AS own FROM runs r, plane p GROUP BY ALL) GROUP BY 1, 2) m
      ON m.k = l.k AND m.own = l.cluster WHERE l.it < 60),
  lab AS MATERIALIZED (SELECT k, id, arg_min(cluster, (x1 - c1) ** 2 + (x2 - c2) ** 2) AS cluster FROM runs, plane WHERE it = 60 GROUP BY 1, 2)"""


@check("kmeans_sweep_users", "k:i silhouette:4 calinski_harabasz:4 davies_bouldin:4 is_best:b", f"""WITH RECURSIVE {USER_PLANE}, {_APART}, {_RUNS}, {_SCORED}
  SELECT *, k = first_value(k) OVER (ORDER BY silhouette DESC, k) AS is_best FROM scored""")
def _(spark, d):
    return cluster_quality.sweep_kmeans(user_plane(spark, d), id_col="id", x_col="x", ks=(2, 3, 4))


@check("average_linkage_users", "id:i cluster:i", f"WITH RECURSIVE {USER_PLANE}, {_LINKED} SELECT id, cluster FROM cuts WHERE k = 5")
def _(spark, d):
    return linkage.average_linkage(user_plane(spark, d), id_col="id", x_col="x", k=5)


@check("linkage_heights", "a:i b:i height:6", f"""WITH RECURSIVE {USER_PLANE}, {_LINKED},
  joined AS (SELECT o.step, o.cluster AS a, o2.cluster AS b FROM (SELECT DISTINCT step, cluster FROM steps) o JOIN (SELECT DISTINCT step, cluster FROM steps) o2
    ON o.step = o2.step AND o.cluster < o2.cluster JOIN (SELECT s.step, s.cluster AS was, t.cluster AS now FROM steps s JOIN steps t ON t.step = s.step + 1 AND t.id = s.id
      WHERE s.cluster <> t.cluster GROUP BY ALL) m ON m.step = o.step AND m.was = o2.cluster AND m.now = o.cluster)
  SELECT j.a, j.b, avg(d) AS height FROM joined j JOIN steps x ON x.step = j.step AND x.cluster = j.a JOIN steps y ON y.step = j.step AND y.cluster = j.b
    JOIN dist ON dist.a = x.id AND dist.b = y.id GROUP BY j.step, j.a, j.b""")
def _(spark, d):
    return linkage.dendrogram(user_plane(spark, d), id_col="id", x_col="x")


@check("linkage_sweep", "k:i silhouette:4 calinski_harabasz:4 davies_bouldin:4 is_best:b", f"""WITH RECURSIVE {USER_PLANE}, {_LINKED},
  lab AS (SELECT * FROM cuts WHERE k IN (2, 3, 4)), {_SCORED}
  SELECT *, k = first_value(k) OVER (ORDER BY silhouette DESC, k) AS is_best FROM scored""")
def _(spark, d):
    return linkage.sweep_linkage(user_plane(spark, d), id_col="id", x_col="x", ks=(2, 3, 4))
