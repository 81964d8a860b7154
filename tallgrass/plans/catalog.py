"""Queries of sources, sinks and catalog."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tallgrass.operators.windows import latest, rounded
from tallgrass.sources import files, store
from tallgrass.sources.scratch import settle, shared_path
from tallgrass.sources.tables import ACCOUNTS, SCORES, TXN, accounts, scores, table, txn

from .registry import query
from .windows import r

BY_FLAG = f"SELECT l_returnflag, count(*) AS n, {r('sum(l_quantity)', 'quantity', 2)} FROM lineitem GROUP BY 1"


def by_flag(df):
    return rounded(df.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")), ["l_returnflag", "n"], ["quantity"], 2)


@query("A1_scan_csv", f"SELECT l_returnflag || 'é' AS l_returnflag, count(*) AS n, {r('sum(l_quantity)', 'quantity', 2)} FROM lineitem GROUP BY 1")
def a1(spark, sf_dir):
    """A file that isn't UTF-8: the encodings are tried in turn."""
    path = shared_path(spark, "csv")
    table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat("l_returnflag", F.lit("é")).alias("l_returnflag"), "l_quantity").write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return by_flag(files.scan_text_csv(spark, path))


DERBY = "jdbc:derby:memory:{}"


def through_database(spark, sf_dir, read):
    """What read(url) makes of the suppliers (a small table) in the database that ships with Spark: the result is written, and
    the database dropped. Any other database takes its URL and driver."""
    url = DERBY.format(f"tallgrass{uuid.uuid4().hex}")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    rows.coalesce(2).write.format("jdbc").option("url", f"{url};create=true").option("dbtable", "suppliers").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").save()
    try:
        return settle(read(url), "from-database")
    finally:
        try:
            spark._jvm.java.sql.DriverManager.getConnection(f"{url};drop=true")
        except Py4JJavaError as dropped:  # the database says by an exception that it is gone
            if "dropped" not in str(dropped):
                raise


def by_nation(df):
    return df.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal") + 1.3e-7, 2).alias("balance"))


NATIONS = f"SELECT s_nationkey, count(*) AS n, {r('sum(s_acctbal)', 'balance', 2)} FROM supplier"


@query("A4_scan_jdbc_query", f"{NATIONS} WHERE s_acctbal > 1000 GROUP BY 1")
def a4(spark, sf_dir):
    return through_database(spark, sf_dir, lambda url: by_nation(files.scan_jdbc(spark, url, query='SELECT "s_nationkey", "s_acctbal" FROM suppliers WHERE "s_acctbal" > 1000')))


@query("A5_scan_jdbc_table", f"{NATIONS} GROUP BY 1")
def a5(spark, sf_dir):
    return through_database(spark, sf_dir, lambda url: by_nation(files.scan_jdbc(spark, url, table="suppliers", columns=["s_nationkey", "s_acctbal"])))


@query("A6_scan_jdbc_chunked", f"{NATIONS} GROUP BY 1")
def a6(spark, sf_dir):
    low, high = table(spark, sf_dir, "supplier").agg(F.min("s_suppkey"), F.max("s_suppkey")).first()
    return through_database(spark, sf_dir, lambda url: by_nation(files.scan_jdbc(spark, url, table="suppliers", partition=("s_suppkey", low, high + 1, 4))))


@query("A2_scan_csv_chunked", BY_FLAG)
def a2(spark, sf_dir):
    path = shared_path(spark, "csv")
    source = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    source.write.option("header", True).option("maxRecordsPerFile", 20_000).csv(path)
    found = files.scan_csv(spark, path, source.schema, bad="__bad")
    return by_flag(found.where("__bad IS NULL"))


@query("A3_scan_json", BY_FLAG)
def a3(spark, sf_dir):
    path = shared_path(spark, "json")
    table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity").write.json(path)
    return by_flag(files.scan_json(spark, path))


@query("A7_table_info", "SELECT 'doc_id' AS name, count(*) - count(doc_id) AS nulls, count(*) AS rows FROM documents UNION ALL SELECT 'text', count(*) - count(text), count(*) FROM documents")
def a7(spark, sf_dir):
    return files.table_info(table(spark, sf_dir, "documents").select("doc_id", "text")).select("name", "nulls", "rows")


@query("A8_infer_types", f"SELECT count(*) AS n, {r('sum(l_quantity)', 'quantity', 2)}, min(CAST(l_shipdate AS DATE)) AS first_day FROM lineitem")
def a8(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in ("l_quantity", "l_shipdate", "l_returnflag")])
    found = files.typed(text, files.infer_types(text))
    return rounded(found.agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.to_date(F.min("l_shipdate")).alias("first_day")), ["n", "first_day"], ["quantity"], 2)


@query("A9_infer_schema", "SELECT 'l_returnflag' AS name, min(l_returnflag) AS low, max(l_returnflag) AS high, count(DISTINCT l_returnflag) AS distinct_values, count(DISTINCT l_returnflag) <= 10 AS enumerable FROM lineitem UNION ALL SELECT 'l_suppkey', CAST(min(l_suppkey) AS VARCHAR), CAST(max(l_suppkey) AS VARCHAR), count(DISTINCT l_suppkey), count(DISTINCT l_suppkey) <= 10 FROM lineitem")
def a9(spark, sf_dir):
    return files.infer_schema(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey")).drop("type")


@query("A10_write_decisions", f"WITH {SCORES} SELECT id, round(p + 1.3e-7, 4) + 0e0 AS prediction, DATE '2024-02-01' AS as_of, 'v1' AS model FROM scores")
def a10(spark, sf_dir):
    path = shared_path(spark, "decisions")
    store.write_decisions(scores(spark, sf_dir), path, "id", "p", "2024-02-01", model="v1")
    return rounded(store.read_decisions(spark, path), ["id", "as_of", "model"], ["prediction"])


@query("A11_read_decisions", f"WITH {SCORES} SELECT id, DATE '2024-02-02' AS as_of FROM scores WHERE p >= 0.5")
def a11(spark, sf_dir):
    path, df = shared_path(spark, "decisions"), scores(spark, sf_dir)
    for day in ("2024-02-01", "2024-02-02"):
        store.write_decisions(df, path, "id", "p", day, use_case="income")
    return store.read_decisions(spark, path, F.col("prediction") >= 0.5, "2024-02-02").select("id", "as_of")


@query("A12_map_schema", "SELECT o_orderkey AS case_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def a12(spark, sf_dir):
    names = {"o_orderkey": "case_id", "o_custkey": "customer_id", "o_totalprice": "amount"}
    return table(spark, sf_dir, "orders").select(*names).withColumnsRenamed(names)


A13 = """WITH c AS (SELECT 'amount' AS concept, 'o_totalprice' AS columns, 'mapped' AS status, count(o_totalprice) AS filled FROM orders UNION ALL SELECT 'customer', 'o_custkey', 'mapped', count(o_custkey) FROM orders
UNION ALL SELECT 'state', 'o_orderpriority,o_orderstatus', 'ambiguous', count(o_orderpriority) + count(o_orderstatus) FROM orders UNION ALL SELECT 'phone', '', 'missing', 0)
SELECT concept, columns, status, filled, (SELECT count(*) FROM orders) AS rows FROM c"""


@query("A13_match_concepts", A13)
def a13(spark, sf_dir):
    """Which columns of the orders carry a concept, and how many values they hold."""
    info = files.table_info(table(spark, sf_dir, "orders"))
    aliases = spark.createDataFrame([("o_totalprice", "amount"), ("total", "amount"), ("o_custkey", "customer"), ("mobile", "phone"), ("o_orderstatus", "state"), ("o_orderpriority", "state")], "alias string, concept string")
    found = store.match_concepts(info.select("name"), aliases)
    held = found.select("concept", F.explode("columns").alias("name")).join(info, "name").groupBy("concept").agg(F.sum(F.col("rows") - F.col("nulls")).alias("filled"))
    rows = found.join(held, "concept", "left").crossJoin(info.agg(F.max("rows").alias("rows")))
    return rows.select("concept", F.array_join("columns", ",").alias("columns"), "status", F.coalesce("filled", F.lit(0)).alias("filled"), "rows")


@query("A14_audit_log", f"WITH {ACCOUNTS} SELECT account_id AS id, n_orders AS prediction, 'm' || (account_id % 2) AS model, '{{\"age\":' || age || ',\"dispute\":' || CASE WHEN dispute THEN 'true' ELSE 'false' END || '}}' AS features FROM accounts")
def a14(spark, sf_dir):
    model = F.concat(F.lit("m"), F.col("account_id") % 2)
    return store.audit_rows(accounts(spark, sf_dir), "account_id", "n_orders", ["age", "dispute"], model, F.col("last_order")).drop("logged_at")


@query("A15_audit_query", f"WITH {ACCOUNTS} SELECT account_id AS id, n_orders AS prediction FROM accounts WHERE account_id % 2 = 1 AND last_order >= DATE '1999-01-01'")
def a15(spark, sf_dir):
    audit = store.audit_rows(accounts(spark, sf_dir), "account_id", "n_orders", ["age"], F.concat(F.lit("m"), F.col("account_id") % 2), F.col("last_order"))
    return audit.where("model = 'm1' AND logged_at >= DATE'1999-01-01'").select("id", "prediction")


@query("A16_audit_retention", f"WITH {ACCOUNTS} SELECT account_id AS id FROM accounts WHERE last_order >= DATE '1999-06-01' - 90")
def a16(spark, sf_dir):
    audit = store.audit_rows(accounts(spark, sf_dir), "account_id", "n_orders", ["age"], F.lit("m"), F.col("last_order"))
    return store.retained(audit, "logged_at", "1999-06-01", 90).select("id")


CACHE = "c AS (SELECT entity_id, max(sec) AS newest, sum(value) AS total FROM txn GROUP BY 1), k AS (SELECT entity_id, sum(value) AS total, max(sec) AS cached_at FROM txn WHERE day < DATE '2024-01-29' AND entity_id % 7 <> 0 GROUP BY 1)"


def cached(spark, sf_dir):
    rows = txn(spark, sf_dir)
    whole = rows.groupBy("entity_id").agg(F.max("sec").alias("newest"), F.sum("value").alias("total"))
    old = rows.where("day < DATE'2024-01-29' AND entity_id % 7 <> 0").groupBy("entity_id").agg(F.sum("value").alias("total"), F.max("sec").alias("cached_at"))
    return whole, old


@query("A17_upsert_cache", f"WITH {TXN}, {CACHE} SELECT c.entity_id, {r('CASE WHEN k.cached_at IS NULL OR c.newest > k.cached_at THEN c.total ELSE k.total END', 'total', 2)}, CASE WHEN k.cached_at IS NULL OR c.newest > k.cached_at THEN 1706745600 ELSE k.cached_at END AS cached_at FROM c LEFT JOIN k USING (entity_id)")
def a17(spark, sf_dir):
    whole, old = cached(spark, sf_dir)
    fresh = store.to_refresh(whole, old, "entity_id", "newest", F.lit(1706745600), 10**9).select("entity_id", "total", F.lit(1706745600).cast("long").alias("cached_at"))
    return rounded(store.upsert(old, fresh, "entity_id"), ["entity_id", "cached_at"], ["total"], 2)


@query("A18_invalidate_cache", f"WITH {TXN}, {CACHE} SELECT entity_id, cached_at FROM k WHERE entity_id % 5 <> 0")
def a18(spark, sf_dir):
    old = cached(spark, sf_dir)[1]
    return store.invalidate(old, "entity_id", old.where("entity_id % 5 = 0").select("entity_id")).select("entity_id", "cached_at")


@query("A19_cache_stats", f"WITH {TXN}, {CACHE} SELECT count(*) AS total, count(*) FILTER (1706572800 - cached_at <= 172800) AS fresh, count(*) FILTER (1706572800 - cached_at > 172800) AS stale, {r('avg(CAST(1706572800 - cached_at <= 172800 AS INT))', 'freshness')} FROM k")
def a19(spark, sf_dir):
    return rounded(store.cache_stats(cached(spark, sf_dir)[1], F.lit(1706572800), 172800), ["total", "fresh", "stale"], ["freshness"])


@query("A20_materialized_view", f"SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n, {r('sum(o_totalprice)', 'total', 1)} FROM orders GROUP BY 1, 2")
def a20(spark, sf_dir):
    path = shared_path(spark, "monthly")
    view = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    view.write.partitionBy("year").parquet(path)
    return rounded(spark.read.schema(view.schema).parquet(path), ["year", "month", "n"], ["total"], 1)


@query("A21_warm_latest", f"WITH {TXN}, {ACCOUNTS} SELECT entity_id, event_id, value FROM txn WHERE entity_id IN (SELECT account_id FROM accounts) QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) = 1")
def a21(spark, sf_dir):
    wanted = accounts(spark, sf_dir).select(F.col("account_id").alias("entity_id"))
    return latest(txn(spark, sf_dir).join(wanted, "entity_id", "left_semi"), "entity_id", ["ts", "event_id"], ["event_id", "value"])
