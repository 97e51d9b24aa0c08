"""How a check is declared, and the inputs that several checks share.

A check names its result columns once (``name:kind``); the same casts and roundings
are then applied to the Spark result and wrapped around the SQL text.
Kinds: ``i`` bigint, ``s`` string, ``b`` boolean, a digit = double rounded to that many places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.vectors import as_vector
from sparkmine.operators.encoding import standardise
from sparkmine.sources.tables import read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def shape(df: DataFrame, columns: str) -> DataFrame:
    out = []
    for item in columns.split():
        name, kind = item.split(":")
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "s":
            c = c.cast("string")
        elif kind == "b":
            c = c.cast("boolean")
        else:
            c = F.round(c.cast("double"), int(kind)) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(sql: str, columns: str) -> str:
    out = []
    for item in columns.split():
        name, kind = item.split(":")
        name = f'"{name}"'
        c = {"i": f"CAST({name} AS BIGINT)", "s": f"CAST({name} AS VARCHAR)", "b": f"CAST({name} AS BOOLEAN)"}.get(
            kind, f"round(CAST({name} AS DOUBLE), {kind}) + 0.0")
        out.append(f"{c} AS {name}")
    sql = sql.replace(" AS column", ' AS "column"')
    return f"SELECT {', '.join(out)} FROM ({sql}) AS result"


def check(name: str, columns: str, sql: str | None = None):
    """Register a check; without ``sql`` only its rows are counted."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: shape(fn(spark, sf_dir), columns)
        if sql is not None:
            SQL[name] = shape_sql(sql, columns)
        return fn

    return register


# -- keys on the SQL side ------------------------------------------------------

def sql_key(expr: str, seed: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr(md5(concat({expr}, '-', {seed})), 1, {digits}) AS BIGINT)"


def sql_uniform(expr: str, seed: str) -> str:
    return f"(({sql_key(expr, seed)} + 0.5) / 4294967296.0)"


# -- shared inputs -------------------------------------------------------------

def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_parquet(spark, d, name)


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), F.col("label").cast("int").alias("label"))


EMB = "emb AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"
EMB_LONG = EMB + ", emb_long AS MATERIALIZED (SELECT id, label, unnest(range(len(x))) AS dim, unnest(x) AS v FROM emb)"
EMB_PAIRS = EMB + """, pairs AS MATERIALIZED (
  SELECT a.id, b.id AS neighbor, a.label, b.label AS other_label, list_distance(a.x, b.x) AS d
  FROM emb a JOIN emb b ON a.id <> b.id)"""

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def user_features(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("avg_value"), F.stddev_pop("value").alias("sd_value"),
        *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in EVENT_TYPES])


USERS = "users AS MATERIALIZED (SELECT user_id AS id, count(*) AS n_events, avg(value) AS avg_value, stddev_pop(value) AS sd_value, " + ", ".join(
    f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in EVENT_TYPES) + " FROM events GROUP BY user_id)"


def user_plane(spark: SparkSession, d: str) -> DataFrame:
    """Two scaled features per user: ``(id, x)``."""
    u = user_features(spark, d).select("id", "n_events", "avg_value")
    return standardise(u, ["n_events", "avg_value"]).select("id", as_vector("n_events", "avg_value").alias("x"))


USER_PLANE = USERS + """, plane AS MATERIALIZED (
  SELECT u.id, (n_events - mn) / sn AS x1, (avg_value - ma) / sa AS x2
  FROM users u, (SELECT avg(n_events) AS mn, stddev_pop(n_events) AS sn, avg(avg_value) AS ma, stddev_pop(avg_value) AS sa FROM users) s)"""


def dirty_orders(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    share = lambda p: F.when(k % 100 < p, "?").otherwise("x")
    return table(spark, d, "orders").select(
        k.alias("id"), "o_orderstatus", F.when(k % 10 < 3, "?").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"),
        share(97).alias("sparse97"), share(55).alias("sparse55"), share(45).alias("sparse45"))


DIRTY = """dirty AS (SELECT o_orderkey AS id, o_orderstatus,
  CASE WHEN o_orderkey % 10 < 3 THEN '?' ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 100 < 97 THEN '?' ELSE 'x' END AS sparse97,
  CASE WHEN o_orderkey % 100 < 55 THEN '?' ELSE 'x' END AS sparse55,
  CASE WHEN o_orderkey % 100 < 45 THEN '?' ELSE 'x' END AS sparse45 FROM orders)"""


def three_class(spark: SparkSession, d: str) -> DataFrame:
    """Orders with status F/O/P as 0/1/2."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr("CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END").alias("label"),
        F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("double").alias("cust"), F.month("o_orderdate").cast("double").alias("month"),
        F.when(F.col("o_orderkey") % 10 >= 3, F.col("o_orderpriority")).alias("priority"))


THREE = """three AS MATERIALIZED (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS label,
  o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS cust, CAST(month(o_orderdate) AS DOUBLE) AS month,
  CASE WHEN o_orderkey % 10 >= 3 THEN o_orderpriority END AS priority FROM orders)"""
