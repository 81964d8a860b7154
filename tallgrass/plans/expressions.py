"""Queries of scalar expressions and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import scalar as s
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import ACCOUNTS, TXN, accounts, table, txn

from .registry import query
from .windows import r

DIGITS = "lpad(CAST(o_orderkey * 7919 % 1000000 AS VARCHAR), 6, '0')"
B = [f"CAST(substr({DIGITS}, {6 - i}, 1) AS INT)" for i in range(6)]


@query("F1_dlnq_history", f"WITH b AS (SELECT o_orderkey, [{', '.join(B)}] AS b FROM orders) SELECT o_orderkey, list_max(b) AS worst, CAST(coalesce(nullif(list_position(b, 0), 0) - 1, 6) AS BIGINT) AS streak, CAST({' + '.join(f'CAST(b[{i}] > b[{i + 1}] AS INT)' for i in range(1, 6))} AS BIGINT) AS worsening, CAST({' + '.join(f'CAST(b[{i}] < b[{i + 1}] AS INT)' for i in range(1, 6))} AS BIGINT) AS improving, CAST(list_position(b, list_max(b)) - 1 AS BIGINT) AS months_since_worst FROM b")
def f1(spark, sf_dir):
    digits = F.lpad((F.col("o_orderkey") * 7919 % 1000000).cast("string"), 6, "0")
    df = table(spark, sf_dir, "orders").select("o_orderkey", s.history(digits).alias("b"))
    return df.select("o_orderkey", *[c.alias(n) for n, c in s.history_features(F.col("b")).items()])


@query("F6_fatigue", f"WITH {ACCOUNTS} SELECT account_id, {r('least(1e0, (n_orders * 0.05e0 + age * 0.01e0) * power(0.5e0, days_past_due / 14e0))', 'fatigue')} FROM accounts")
def f6(spark, sf_dir):
    f = s.fatigue([(F.col("n_orders"), 0.05), (F.col("age"), 0.01)], F.col("days_past_due"))
    return rounded(accounts(spark, sf_dir).select("account_id", f.alias("fatigue")), ["account_id"], ["fatigue"])


@query("F8_legal_sale_npv", f"WITH {ACCOUNTS}, n AS (SELECT account_id, balance * propensity * 0.8e0 AS tdr, balance * 0.5e0 - 800 AS legal, balance * 0.12e0 AS sale FROM accounts) SELECT account_id, CASE WHEN greatest(tdr, legal, sale) <= 0 THEN 'HOLD' WHEN tdr >= legal AND tdr >= sale THEN 'TDR' WHEN legal >= sale THEN 'LEGAL' ELSE 'DEBT_SALE' END AS path, {r('greatest(tdr, legal, sale)', 'value', 2)} FROM n")
def f8(spark, sf_dir):
    b = F.col("balance")
    n = accounts(spark, sf_dir).select("account_id", (b * F.col("propensity") * 0.8).alias("tdr"), (b * 0.5 - 800).alias("legal"), (b * 0.12).alias("sale")).withColumn("value", F.greatest("tdr", "legal", "sale"))
    path = F.when(F.col("value") <= 0, "HOLD").when(F.col("tdr") == F.col("value"), "TDR").when(F.col("legal") == F.col("value"), "LEGAL").otherwise("DEBT_SALE")
    return rounded(n.withColumn("path", path), ["account_id", "path"], ["value"], 2)


@query("F9_take_up", f"WITH {ACCOUNTS} SELECT account_id, {r('greatest(0.02e0, least(0.92e0, 0.3e0 + 0.5e0 * propensity - 0.001e0 * days_past_due + CASE WHEN dispute THEN -0.2e0 ELSE 0 END))', 'take_up')} FROM accounts")
def f9(spark, sf_dir):
    x = 0.3 + 0.5 * F.col("propensity") - 0.001 * F.col("days_past_due") + F.when(F.col("dispute"), -0.2).otherwise(0.0)
    return rounded(accounts(spark, sf_dir).select("account_id", F.greatest(F.lit(0.02), F.least(F.lit(0.92), x)).alias("take_up")), ["account_id"], ["take_up"])


@query("F11_erv", f"WITH {ACCOUNTS} SELECT account_id, {r('propensity * 0.6e0 * balance * 0.9e0', 'erv', 2)} FROM accounts")
def f11(spark, sf_dir):
    return rounded(accounts(spark, sf_dir).select("account_id", (F.col("propensity") * 0.6 * F.col("balance") * 0.9).alias("erv")), ["account_id"], ["erv"], 2)


@query("F12_logit", f"WITH {ACCOUNTS}, l AS (SELECT account_id, greatest(1e-6, least(1 - 1e-6, propensity)) AS c FROM accounts) SELECT account_id, {r('ln(c / (1 - c))', 'logit')}, {r('c', 'back')} FROM l")
def f12(spark, sf_dir):
    x = s.logit(F.col("propensity"))
    return rounded(accounts(spark, sf_dir).select("account_id", x.alias("logit"), s.inverse_logit(x).alias("back")), ["account_id"], ["logit", "back"])


@query("F13_keyword_flags", "SELECT doc_id, regexp_matches(lower(text), 'password|secret') AS flagged FROM documents")
def f13(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", s.keyword(F.col("text"), ["password", "secret"]).alias("flagged"))


@query("F14_monthly_equivalent", f"SELECT l_orderkey, l_linenumber, l_partkey, {r('l_extendedprice * CASE WHEN l_quantity BETWEEN 28 AND 32 THEN 1 WHEN l_quantity BETWEEN 13 AND 15 THEN 2.17e0 WHEN l_quantity BETWEEN 6 AND 8 THEN 4.33e0 WHEN l_quantity > 0 THEN 30 / l_quantity ELSE 1 END', 'monthly', 1)} FROM lineitem")
def f14(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", s.monthly_equivalent(F.col("l_extendedprice"), F.col("l_quantity")).alias("monthly"))
    return rounded(df, ["l_orderkey", "l_linenumber", "l_partkey"], ["monthly"], 1)


@query("F15_json_pack", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || ',\"t\":\"' || event_type || '\"}' AS packed FROM events")
def f15(spark, sf_dir):
    k = F.from_json("props", "k long")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.to_json(F.struct(k.alias("k"), F.col("event_type").alias("t"))).alias("packed"))


@query("F16_map_explode", "SELECT l_orderkey, l_linenumber, l_partkey, unnest(['tax', 'discount']) AS name, round(unnest([l_tax, l_discount]) + 1.3e-7, 4) + 0e0 AS value FROM lineitem")
def f16(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("tallgrass_lines")
    return rounded(spark.sql("SELECT l_orderkey, l_linenumber, l_partkey, name, value FROM tallgrass_lines LATERAL VIEW explode(map('tax', l_tax, 'discount', l_discount)) m AS name, value"), ["l_orderkey", "l_linenumber", "l_partkey", "name"], ["value"])


@query("F17_reason_codes", f"WITH {ACCOUNTS}, c AS (SELECT account_id, unnest(['dpd', 'orders', 'age']) AS n, unnest([abs(0.01e0 * (days_past_due - 100)), abs(0.05e0 * (n_orders - 10)), abs(0.02e0 * (age - 45))]) AS v FROM accounts) SELECT account_id, string_agg(n, ',' ORDER BY v DESC, n) AS reasons FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY v DESC, n) <= 2) GROUP BY 1")
def f17(spark, sf_dir):
    parts = {"dpd": 0.01 * (F.col("days_past_due") - 100), "orders": 0.05 * (F.col("n_orders") - 10), "age": 0.02 * (F.col("age") - 45)}
    return accounts(spark, sf_dir).select("account_id", F.array_join(s.reason_codes(parts, 2), ",").alias("reasons"))


@query("F18_time_features", "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(dayofweek(ts) + 1 AS BIGINT) AS dow, dayofweek(ts) IN (0, 6) AS weekend, hour(ts) BETWEEN 9 AND 17 AS business FROM events")
def f18(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.hour("ts").cast("long").alias("hour"), F.dayofweek("ts").cast("long").alias("dow"), F.dayofweek("ts").isin(1, 7).alias("weekend"), F.hour("ts").between(9, 17).alias("business"))


@query("F19_small_features", f"WITH {ACCOUNTS} SELECT account_id, CAST(datediff('day', last_order, DATE '2010-01-01') // 365 AS BIGINT) AS years, {r('spend / nullif(n_orders, 0)', 'ticket', 2)} FROM accounts")
def f19(spark, sf_dir):
    out = accounts(spark, sf_dir).select("account_id", F.floor(F.datediff(F.lit("2010-01-01").cast("date"), F.col("last_order")) / 365).alias("years"), (F.col("spend") / F.nullif("n_orders", F.lit(0))).alias("ticket"))
    return rounded(out, ["account_id", "years"], ["ticket"], 2)


CURVE = f"{ACCOUNTS}, g AS (SELECT account_id, d, least(0.95e0, propensity + 0.8e0 * d) AS p, balance FROM accounts, (VALUES (0e0), (0.2e0), (0.4e0)) t(d))"


def curve(spark, sf_dir):
    a = accounts(spark, sf_dir).withColumn("d", F.explode(F.array(*[F.lit(x) for x in (0.0, 0.2, 0.4)])))
    return a.withColumn("p", F.least(F.lit(0.95), F.col("propensity") + 0.8 * F.col("d")))


@query("F21_erv_curve", f"WITH {CURVE}, e AS (SELECT *, p * balance * (1 - d) AS net FROM g) SELECT account_id, d, {r('net', 'net', 2)}, {r('net - lag(net) OVER w', 'gain', 2)}, row_number() OVER (PARTITION BY account_id ORDER BY net DESC, d) = 1 AS best FROM e WINDOW w AS (PARTITION BY account_id ORDER BY d)")
def f21(spark, sf_dir):
    from pyspark.sql import Window

    e = curve(spark, sf_dir).withColumn("net", F.col("p") * F.col("balance") * (1 - F.col("d")))
    w = Window.partitionBy("account_id")
    out = e.select("account_id", "d", "net", (F.col("net") - F.lag("net").over(w.orderBy("d"))).alias("gain"), (F.row_number().over(w.orderBy(F.desc("net"), "d")) == 1).alias("best"))
    return rounded(out, ["account_id", "d", "best"], ["net", "gain"], 2)


@query("S1_union_all", f"WITH {TXN} SELECT 'rows' AS metric, category, CAST(count(*) AS DOUBLE) AS value FROM txn GROUP BY 2 UNION ALL SELECT 'nulls', category, CAST(count(*) - count(value) AS DOUBLE) FROM txn GROUP BY 2")
def s1(spark, sf_dir):
    t = txn(spark, sf_dir)
    a = t.groupBy("category").agg(F.count("*").cast("double").alias("value")).select(F.lit("rows").alias("metric"), "category", "value")
    return a.unionByName(t.groupBy("category").agg(F.count_if(F.col("value").isNull()).cast("double").alias("value")).select(F.lit("nulls").alias("metric"), "category", "value"))


@query("S2_union_schema", f"WITH {TXN} SELECT category, count(*) AS n, NULL AS top FROM txn GROUP BY 1 UNION ALL SELECT category, NULL, max(value) FROM txn GROUP BY 1")
def s2(spark, sf_dir):
    t = txn(spark, sf_dir)
    return t.groupBy("category").agg(F.count("*").alias("n")).unionByName(t.groupBy("category").agg(F.max("value").alias("top")), allowMissingColumns=True)


@query("S3_id_sets", "SELECT id FROM (SELECT user_id AS id FROM events UNION SELECT o_custkey FROM orders) INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey < 10")
def s3(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("id")).union(table(spark, sf_dir, "orders").select("o_custkey")).distinct()
    return ids.intersect(table(spark, sf_dir, "customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("id")))


@query("S4_category_union", "SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b FROM (SELECT l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY 1) a FULL JOIN (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1) b ON a.k = b.k")
def s4(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("a"))
    return a.join(table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("b")), "k", "full").fillna(0)


@query("S5_stack_train_test", "SELECT o_orderkey, o_orderkey % 5 = 0 AS is_test FROM orders")
def s5(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return o.where("o_orderkey % 5 <> 0").withColumn("is_test", F.lit(False)).unionByName(o.where("o_orderkey % 5 = 0").withColumn("is_test", F.lit(True)))
