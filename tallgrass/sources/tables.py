"""Table loading and the standard views that the registered queries read.

Parquet timestamps without zone become session-zone timestamps, so that casts to seconds and watermarks work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, with TIMESTAMP_NTZ columns cast to TIMESTAMP in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else f.name for f in df.schema])


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from events: signed amount, whole seconds, day."""
    outflow = F.col("event_type").isin("purchase", "error")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        "ts",
        F.col("ts").cast("long").alias("sec"),
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("category"),
        F.when(outflow, -F.col("value")).otherwise(F.col("value")).alias("amount"),
        "value",
        "props",
    )


TXN = """txn AS (SELECT event_id, user_id AS entity_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(ts AS DATE) AS day,
event_type AS category, CASE WHEN event_type IN ('purchase', 'error') THEN -value ELSE value END AS amount, value, props FROM events)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account with balance, delinquency, age, order counts and a deterministic propensity."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("account_id")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spend"), F.to_date(F.max("o_orderdate")).alias("last_order")
    )
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("long").alias("nation"),
        F.abs("c_acctbal").alias("balance"),
        F.expr("c_custkey * 7 % 200").alias("days_past_due"),
        F.expr("18 + c_custkey % 60").alias("age"),
        F.expr("(c_custkey * 31 % 100) / 1e2").alias("propensity"),
        F.expr("c_custkey % 11 = 0").alias("dispute"),
        F.expr("c_custkey % 13 = 0").alias("do_not_contact"),
    )
    return base.join(orders, "account_id", "left").withColumns({"n_orders": F.coalesce("n_orders", F.lit(0)).cast("long"), "spend": F.coalesce("spend", F.lit(0.0))})


ACCOUNTS = """accounts AS (SELECT c_custkey AS account_id, c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation, abs(c_acctbal) AS balance,
c_custkey * 7 % 200 AS days_past_due, 18 + c_custkey % 60 AS age, (c_custkey * 31 % 100) / 1e2 AS propensity, c_custkey % 11 = 0 AS dispute,
c_custkey % 13 = 0 AS do_not_contact, coalesce(n_orders, 0) AS n_orders, coalesce(spend, 0) AS spend, last_order
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend, CAST(max(o_orderdate) AS DATE) AS last_order FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scored cases: outcome y, two regressors, a probability and its binary label, segments and days."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_orderstatus").alias("grp"),
        F.to_date("o_orderdate").alias("day"),
        F.expr("o_totalprice / 1e3").alias("y"),
        F.expr("o_totalprice / 1e3 * (0.8e0 + (o_orderkey * 37 % 40) / 1e2)").alias("champion"),
        F.expr("o_totalprice / 1e3 * (0.85e0 + (o_orderkey * 53 % 30) / 1e2)").alias("challenger"),
        F.expr("(o_orderkey * 97 % 1009) / 1009e0").alias("p"),
        F.expr("CAST((o_orderkey * 61 % 1013) / 1013e0 < (o_orderkey * 97 % 1009) / 1009e0 AS INT)").alias("label"),
    )


SCORES = """scores AS (SELECT o_orderkey AS id, o_custkey AS entity_id, o_orderpriority AS segment, o_orderstatus AS grp, CAST(o_orderdate AS DATE) AS day,
o_totalprice / 1e3 AS y, o_totalprice / 1e3 * (0.8e0 + (o_orderkey * 37 % 40) / 1e2) AS champion, o_totalprice / 1e3 * (0.85e0 + (o_orderkey * 53 % 30) / 1e2) AS challenger,
(o_orderkey * 97 % 1009) / 1009e0 AS p, CAST((o_orderkey * 61 % 1013) / 1013e0 < (o_orderkey * 97 % 1009) / 1009e0 AS INT) AS label FROM orders)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected weighted edges between customers and suppliers, one row each."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst")).agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("weight"))


EDGES = """edges AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, count(*) AS n, sum(l_extendedprice) AS weight
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def trails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected edges between parts on neighbouring lines of an order, one row each; src is the smaller part."""
    from pyspark.sql import Window

    after = F.lead("l_partkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    steps = table(spark, sf_dir, "lineitem").select("l_partkey", after.alias("after")).where("l_partkey <> after")
    return steps.select(F.least("l_partkey", "after").alias("src"), F.greatest("l_partkey", "after").alias("dst")).distinct()


TRAILS = """steps AS (SELECT l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS b FROM lineitem),
trails AS (SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst FROM steps WHERE a <> b)"""
