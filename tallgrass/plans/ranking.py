"""Queries of ranking and allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import ranking as t
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import ACCOUNTS, EDGES, SCORES, accounts, edges, scores, table

from .registry import query
from .windows import r

VALUES = {"call": "propensity * balance - 25", "sms": "propensity * 0.7e0 * balance - 1", "letter": "propensity * 0.5e0 * balance - 5"}
ACTIONS = "v AS (" + " UNION ALL ".join(f"SELECT account_id, '{n}' AS action, {e} AS value FROM accounts" for n, e in VALUES.items()) + "), k AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY value DESC, action) AS k FROM v)"


@query("T1_rank_actions", f"WITH {ACCOUNTS}, {ACTIONS} SELECT account_id, max(action) FILTER (k = 1) AS action, {r('max(value) FILTER (k = 1)', 'value', 2)}, string_agg(action, ',' ORDER BY k) AS top FROM k GROUP BY 1")
def t1(spark, sf_dir):
    return rounded(t.rank_actions(accounts(spark, sf_dir), "account_id", {n: F.expr(e) for n, e in VALUES.items()}), ["account_id", "action", "top"], ["value"], 2)


CUT = f"WITH {ACCOUNTS}, a AS (SELECT account_id, balance, CASE WHEN days_past_due > 90 THEN 'call' ELSE 'sms' END AS action FROM accounts), k AS (SELECT *, row_number() OVER (PARTITION BY action ORDER BY balance DESC, account_id) AS k FROM a)"


@query("T2_capacity_cut", f"{CUT} SELECT account_id, CASE WHEN action = 'call' AND k > 100 THEN 'sms' ELSE action END AS final FROM k")
def t2(spark, sf_dir):
    a = accounts(spark, sf_dir).withColumn("action", F.when(F.col("days_past_due") > 90, "call").otherwise("sms"))
    return t.capacity_cut(a, "action", "balance", "account_id", {"call": 100}, "sms").select("account_id", "final")


SHARES = {"call": 0.15, "sms": 0.3, "letter": 0.25}
WISHES = {"call": "propensity * balance - 25", "sms": "CASE WHEN NOT do_not_contact THEN propensity * 0.7e0 * balance - 1 END", "letter": "propensity * 0.5e0 * balance - 5 + 40 * (account_id % 7)", "agency": "CASE WHEN days_past_due > 100 THEN balance * 0.1e0 END"}
ROUNDS = 14
T3 = f"""WITH {ACCOUNTS}, v AS ({" UNION ALL ".join(f"SELECT account_id, '{n}' AS action, {e} AS value FROM accounts" for n, e in WISHES.items())}),
w AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY value DESC, action) - 1 AS at FROM v WHERE value IS NOT NULL),
room AS (SELECT action, CAST(floor(share * n + 1e-9) AS BIGINT) AS room FROM (VALUES {", ".join(f"('{n}', {x}e0)" for n, x in SHARES.items())}) s(action, share), (SELECT count(*) AS n FROM accounts)),
s0 AS (SELECT account_id, 0 AS at FROM accounts), """ + ",\n".join(f"""s{k} AS (SELECT s.account_id, s.at + CASE WHEN row_number() OVER (PARTITION BY w.action ORDER BY w.value DESC, s.account_id) > room THEN 1 ELSE 0 END AS at
FROM s{k - 1} s LEFT JOIN w ON w.account_id = s.account_id AND w.at = s.at LEFT JOIN room ON room.action = w.action)""" for k in range(1, ROUNDS + 1)) + f"""
SELECT s.account_id, coalesce(action, 'NONE') AS final, {r('value', 'value', 2)}, CAST(s.at AS BIGINT) AS moves FROM s{ROUNDS} s LEFT JOIN w ON w.account_id = s.account_id AND w.at = s.at"""


@query("T3_share_capacity", T3)
def t3(spark, sf_dir):
    """Actions with shares of the accounts; the SQL unrolls as many rounds as these tables need at most."""
    found = t.share_capacity(accounts(spark, sf_dir), "account_id", {n: F.expr(e) for n, e in WISHES.items()}, SHARES)
    return rounded(found, ["account_id", "final", "moves"], ["value"], 2)


@query("T6_contact_sequence", f"WITH {ACCOUNTS} SELECT account_id, step, last_order + CAST(step * 7 AS INT) AS day, {r('propensity * power(0.8e0, step)', 'propensity')} FROM accounts, (SELECT unnest([0, 1, 2]) AS step)")
def t6(spark, sf_dir):
    s = accounts(spark, sf_dir).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(2))))
    out = s.select("account_id", "step", F.date_add("last_order", F.col("step") * 7).alias("day"), (F.col("propensity") * F.pow(F.lit(0.8), "step")).alias("propensity"))
    return rounded(out, ["account_id", "step", "day"], ["propensity"])


@query("T7_channel_dedup", "SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1 THEN o_orderpriority ELSE 'NO_ACTION' END AS final FROM orders")
def t7(spark, sf_dir):
    return t.channel_dedup(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_totalprice", "o_orderkey").select("o_orderkey", "final")


@query("T8_queue_assign", f"WITH {ACCOUNTS}, c AS (SELECT account_id, row_number() OVER (ORDER BY balance DESC, account_id) AS k FROM accounts QUALIFY row_number() OVER (ORDER BY balance DESC, account_id) <= 5), o AS (SELECT * FROM (VALUES (1, 'ann'), (2, 'bo'), (3, 'ann'), (4, 'bo'), (5, 'ann')) v(k, officer)) SELECT account_id, officer FROM c JOIN o USING (k)")
def t8(spark, sf_dir):
    cases = accounts(spark, sf_dir).select("account_id", (-F.col("balance")).alias("p"))
    return t.round_robin(cases, ["p", "account_id"], {"ann": 3, "bo": 2}).select("account_id", "officer")


@query("T9_queue_report", f"WITH {ACCOUNTS} SELECT account_id, {r('balance', 'balance', 2)} FROM accounts ORDER BY accounts.balance DESC, account_id LIMIT 10")
def t9(spark, sf_dir):
    return rounded(accounts(spark, sf_dir).orderBy(F.desc("balance"), "account_id").limit(10), ["account_id"], ["balance"], 2)


@query("T10_budget_allocation", f"WITH {ACCOUNTS}, g AS (SELECT segment, avg(balance * propensity) AS gain, 10 + 5 * min(nation) AS cost, count(*) AS cap FROM accounts GROUP BY 1), s AS (SELECT *, coalesce(sum(cost * cap) OVER (ORDER BY gain / cost DESC, segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM g) SELECT segment, CAST(greatest(0, least(cap, floor((8000e0 - spent) / cost))) AS BIGINT) AS units FROM s")
def t10(spark, sf_dir):
    g = accounts(spark, sf_dir).groupBy("segment").agg(F.avg(F.col("balance") * F.col("propensity")).alias("gain"), (10 + 5 * F.min("nation")).alias("cost"), F.count("*").alias("cap"))
    return t.budget_allocation(g, "segment", "gain", "cost", "cap", 8000.0).select("segment", "units")


@query("T11_top_risk", f"WITH {EDGES} SELECT src, {r('sum(weight)', 'risk', 2)} FROM edges GROUP BY 1 ORDER BY sum(weight) DESC, src LIMIT 20")
def t11(spark, sf_dir):
    g = edges(spark, sf_dir).groupBy("src").agg(F.sum("weight").alias("risk"))
    return rounded(g.orderBy(F.desc("risk"), "src").limit(20), ["src"], ["risk"], 2)


@query("T13_customer_summary_sort", f"WITH {ACCOUNTS} SELECT account_id, segment, n_orders FROM accounts")
def t13(spark, sf_dir):
    return accounts(spark, sf_dir).select("account_id", "segment", "n_orders").orderBy("account_id")


@query("T14_rank_in_group", f"WITH {SCORES} SELECT entity_id, id, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY p DESC, id) AS INT) AS rank FROM scores QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY p DESC, id) <= 3")
def t14(spark, sf_dir):
    return t.top_in_group(scores(spark, sf_dir), ["entity_id"], [F.desc("p"), F.col("id")], 3).select("entity_id", "id", "rank")
