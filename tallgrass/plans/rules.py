"""Queries of business rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions.scalar import bucket_100
from tallgrass.operators import rules as p
from tallgrass.operators.quantiles import with_quantiles
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import ACCOUNTS, SCORES, TXN, accounts, scores, table, txn

from .registry import query
from .windows import r

SEGMENTS = {"strategic": "balance > 8000 AND days_past_due < 30", "hardship": "days_past_due BETWEEN 90 AND 180", "lost": "days_past_due > 180", "small": "balance < 500"}
CASE = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in SEGMENTS.items()) + " ELSE 'unclassified' END"


@query("P1_rule_segments", f"WITH {ACCOUNTS} SELECT account_id, {CASE} AS persona FROM accounts")
def p1(spark, sf_dir):
    return accounts(spark, sf_dir).select("account_id", p.first_match(SEGMENTS, "unclassified").alias("persona"))


@query("P3_business_filters", f"WITH {ACCOUNTS} SELECT count(*) AS total, count(*) FILTER (NOT n_orders >= 5) AS dropped_history, count(*) FILTER (n_orders >= 5 AND NOT age >= 21) AS dropped_age, count(*) FILTER (n_orders >= 5 AND age >= 21 AND dispute) AS dropped_dispute, count(*) FILTER (n_orders >= 5 AND age >= 21 AND NOT dispute) AS kept FROM accounts")
def p3(spark, sf_dir):
    return p.dropped_counts(accounts(spark, sf_dir), {"history": "n_orders >= 5", "age": "age >= 21", "dispute": "NOT dispute"})


@query("P4_decision_rules", f"WITH {SCORES} SELECT id, CASE WHEN p >= 0.6 THEN 'approve' WHEN p < 0.4 THEN 'decline' ELSE 'review' END AS decision, CASE WHEN abs(p - 0.5) / 0.5 >= 0.2 THEN 'high' WHEN abs(p - 0.5) / 0.5 >= 0.1 THEN 'medium' ELSE 'low' END AS confidence FROM scores")
def p4(spark, sf_dir):
    decision = p.first_match({"approve": "p >= 0.6", "decline": "p < 0.4"}, "review")
    return scores(spark, sf_dir).select("id", decision.alias("decision"), p.confidence(F.col("p"), 0.5).alias("confidence"))


MD5 = "(((CAST('0x' || substr(md5('{s}' || {k}), 1, 16) AS UBIGINT) % 100) * 16 + CAST('0x' || substr(md5('{s}' || {k}), 17, 16) AS UBIGINT) % 100) % 100)"


@query("P5_route_model", f"WITH {ACCOUNTS} SELECT account_id, CASE WHEN balance > 9500 THEN 'manual' WHEN n_orders < 3 THEN 'sparse' WHEN age < 25 THEN 'new' WHEN {MD5.format(s='r', k='account_id')} < 10 THEN 'challenger' ELSE 'champion' END AS model FROM accounts")
def p5(spark, sf_dir):
    rules = {"manual": "balance > 9500", "sparse": "n_orders < 3", "new": "age < 25", "challenger": bucket_100(F.col("account_id"), "r") < 10}
    return accounts(spark, sf_dir).select("account_id", p.first_match(rules, "champion").alias("model"))


@query("P6_traffic_split", f"WITH {ACCOUNTS} SELECT account_id, CAST({MD5.format(s='seed', k='account_id')} AS INT) AS bucket, {MD5.format(s='seed', k='account_id')} < 20 AS challenger FROM accounts")
def p6(spark, sf_dir):
    b = bucket_100(F.col("account_id"), "seed")
    return accounts(spark, sf_dir).select("account_id", b.alias("bucket"), (b < 20).alias("challenger"))


@query("P7_ab_variant", f"WITH {ACCOUNTS}, b AS (SELECT account_id, {MD5.format(s='ab', k='account_id')} AS b FROM accounts) SELECT account_id, CASE WHEN b < 50 THEN 'control' WHEN b < 80 THEN 'a' ELSE 'b' END AS variant FROM b")
def p7(spark, sf_dir):
    return accounts(spark, sf_dir).select("account_id", p.variant(bucket_100(F.col("account_id"), "ab"), {"control": 50, "a": 30, "b": 20}).alias("variant"))


RULES = {"price_range": "l_extendedprice BETWEEN 1000 AND 90000", "flag_allowed": "l_returnflag IN ('A', 'N')", "discount": "l_discount <= 0.08", "key_present": "l_orderkey IS NOT NULL"}


@query("P8_validate_schema", " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({c}, false)) AS violations, round(avg(CAST(NOT coalesce({c}, false) AS INT)) + 1.3e-7, 4) AS rate FROM lineitem" for n, c in RULES.items()))
def p8(spark, sf_dir):
    return rounded(p.violations(table(spark, sf_dir, "lineitem"), RULES), ["rule", "violations"], ["rate"])


@query("P9_validate_input_quality", f"WITH {TXN} SELECT count(*) AS n, datediff('day', min(day), max(day)) AS days_covered, {r('avg(CAST(value IS NULL AS INT))', 'null_rate')}, count(*) >= 1000 AND datediff('day', min(day), max(day)) >= 20 AS usable FROM txn")
def p9(spark, sf_dir):
    g = txn(spark, sf_dir).agg(F.count("*").alias("n"), F.datediff(F.max("day"), F.min("day")).cast("long").alias("days_covered"), F.avg(F.col("value").isNull().cast("double")).alias("null_rate"))
    return rounded(g.withColumn("usable", (F.col("n") >= 1000) & (F.col("days_covered") >= 20)), ["n", "days_covered", "usable"], ["null_rate"])


BLOCKS = {"dispute": "dispute", "do_not_contact": "do_not_contact AND action = 'call'", "too_small": "balance < least_balance", "too_late": "days_past_due > 180 AND action = 'sms'"}
ACTIONS = [("call", 500.0), ("sms", 0.0), ("legal", 3000.0)]


@query("P10_constraint_engine", f"WITH {ACCOUNTS}, a AS (SELECT * FROM (VALUES ('call', 500e0), ('sms', 0e0), ('legal', 3000e0)) v(action, least_balance)) SELECT account_id, action, concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in BLOCKS.items()) + ") AS blocked FROM accounts, a")
def p10(spark, sf_dir):
    actions = F.explode(F.array(*[F.struct(F.lit(n).alias("action"), F.lit(b).alias("least_balance")) for n, b in ACTIONS]))
    grid = accounts(spark, sf_dir).select("*", actions.alias("x")).select("*", "x.*")
    return grid.select("account_id", "action", F.array_join(p.reasons(BLOCKS), "|").alias("blocked"))


@query("P11_suppression", f"WITH {ACCOUNTS} SELECT account_id, CASE WHEN NOT (do_not_contact OR dispute) THEN 'call' WHEN NOT (days_past_due > 150) THEN 'sms' WHEN NOT dispute THEN 'letter' ELSE 'NO_CONTACT' END AS action FROM accounts")
def p11(spark, sf_dir):
    candidates = [(F.lit("call"), F.col("do_not_contact") | F.col("dispute")), (F.lit("sms"), F.col("days_past_due") > 150), (F.lit("letter"), F.col("dispute"))]
    return accounts(spark, sf_dir).select("account_id", p.first_allowed(candidates, "NO_CONTACT").alias("action"))


@query("P12_nba_compliance", f"WITH {TXN}, c AS (SELECT entity_id, count(*) FILTER (sec > 1706572800 - 604800) AS contacts, avg(CAST(category = 'error' AS INT)) AS disputes FROM txn GROUP BY 1) SELECT entity_id, contacts, CASE WHEN contacts >= 20 THEN 'cap' WHEN disputes > 0.3 THEN 'disputes' ELSE 'ok' END AS reason FROM c")
def p12(spark, sf_dir):
    c = txn(spark, sf_dir).groupBy("entity_id").agg(F.count_if(F.col("sec") > 1706572800 - 604800).alias("contacts"), F.avg((F.col("category") == "error").cast("double")).alias("disputes"))
    return c.select("entity_id", "contacts", p.first_match({"cap": "contacts >= 20", "disputes": "disputes > 0.3"}, "ok").alias("reason"))


@query("P13_nba_channel", f"WITH {ACCOUNTS}, {TXN}, b AS (SELECT entity_id, category, avg(value) AS v FROM txn GROUP BY 1, 2), h AS (SELECT entity_id, category FROM b QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY v DESC, category) = 1) SELECT account_id, CASE WHEN do_not_contact THEN 'letter' WHEN days_past_due > 120 THEN 'call' ELSE coalesce(category, 'sms') END AS channel FROM accounts LEFT JOIN h ON entity_id = account_id")
def p13(spark, sf_dir):
    from tallgrass.operators.aggregates import best_by

    best = best_by(txn(spark, sf_dir), "entity_id", "category", F.avg("value")).select(F.col("entity_id").alias("account_id"), "preferred")
    rule = F.when(F.col("do_not_contact"), "letter").when(F.col("days_past_due") > 120, "call").otherwise(F.coalesce("preferred", F.lit("sms")))
    return accounts(spark, sf_dir).join(best, "account_id", "left").select("account_id", rule.alias("channel"))


@query("P14_nba_timing", "SELECT o_orderkey, CAST(o_orderdate + ((4 - dayofweek(o_orderdate) + 7) % 7) * INTERVAL 1 DAY AS DATE) AS next_day, CAST(greatest(8, least(20, o_orderkey % 24)) AS BIGINT) AS hour FROM orders")
def p14(spark, sf_dir):
    ahead = F.pmod(F.lit(5) - F.dayofweek("o_orderdate"), F.lit(7))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), ahead).alias("next_day"), F.greatest(F.lit(8), F.least(F.lit(20), F.col("o_orderkey") % 24)).cast("long").alias("hour"))


@query("P16_score_bands", f"WITH {ACCOUNTS} SELECT account_id, CASE WHEN propensity >= 0.7 THEN 'HOT' WHEN propensity >= 0.4 THEN 'WARM' WHEN propensity >= 0.15 THEN 'COLD' ELSE 'FROZEN' END AS band, {r('propensity * 10', 'points', 1)} FROM accounts")
def p16(spark, sf_dir):
    band = p.first_match({"HOT": "propensity >= 0.7", "WARM": "propensity >= 0.4", "COLD": "propensity >= 0.15"}, "FROZEN")
    return rounded(accounts(spark, sf_dir).select("account_id", band.alias("band"), (F.col("propensity") * 10).alias("points")), ["account_id", "band"], ["points"], 1)


@query("P17_action_from_discount", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount <= 0.02 THEN 'sms' WHEN l_discount <= 0.06 THEN 'call' ELSE 'visit' END AS channel FROM lineitem")
def p17(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", p.first_match({"sms": "l_discount <= 0.02", "call": "l_discount <= 0.06"}, "visit").alias("channel"))


ESCALATE = {"STALE": "days_past_due > 150", "HIGH_VALUE": "balance > 7000", "DISPUTED": "dispute"}


@query("P18_escalations", f"WITH {ACCOUNTS} SELECT account_id, concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in ESCALATE.items()) + ") AS reasons, last_order + 1 AS due FROM accounts WHERE days_past_due > 150 OR balance > 7000 OR dispute")
def p18(spark, sf_dir):
    found = accounts(spark, sf_dir).withColumn("r", p.reasons(ESCALATE)).where(F.size("r") > 0)
    return found.select("account_id", F.array_join("r", "|").alias("reasons"), F.date_add("last_order", 1).alias("due"))


@query("P19_legal_eligibility", f"WITH {ACCOUNTS} SELECT account_id, days_past_due >= 90 AND balance >= 1000 AS eligible, CASE WHEN balance >= 7000 THEN 'A' WHEN balance >= 3000 THEN 'B' ELSE 'C' END AS band, {r('0.6e0 * least(1e0, balance / 10000) + 0.4e0 * days_past_due / 200', 'priority')} FROM accounts")
def p19(spark, sf_dir):
    a = accounts(spark, sf_dir)
    out = a.select("account_id", ((F.col("days_past_due") >= 90) & (F.col("balance") >= 1000)).alias("eligible"), p.first_match({"A": "balance >= 7000", "B": "balance >= 3000"}, "C").alias("band"), (0.6 * F.least(F.lit(1.0), F.col("balance") / 10000) + 0.4 * F.col("days_past_due") / 200).alias("priority"))
    return rounded(out, ["account_id", "eligible", "band"], ["priority"])


@query("P20_alert_rules", f"WITH {TXN}, m AS (SELECT day, count(*) AS n, quantile_cont(value, 0.95) AS p95, avg(CAST(category = 'error' AS INT)) AS errors FROM txn GROUP BY 1) SELECT day, 'p95' AS metric, {r('p95', 'value')} FROM m WHERE p95 > 150 UNION ALL SELECT day, 'errors', {r('errors', 'value')} FROM m WHERE errors > 0.22 UNION ALL SELECT day, 'n', {r('CAST(n AS DOUBLE)', 'value')} FROM m WHERE n < 310")
def p20(spark, sf_dir):
    t = txn(spark, sf_dir)
    m = t.groupBy("day").agg(F.count("*").alias("n"), F.avg((F.col("category") == "error").cast("double")).alias("errors"))
    m = with_quantiles(m, t, ["day"], "value", [0.95]).withColumn("p95", F.col("q")[0]).drop("q")
    return rounded(p.alerts(m, ["day"], {"p95": (">", 150), "errors": (">", 0.22), "n": ("<", 310)}), ["day", "metric"], ["value"])


@query("P22_freshness", f"WITH {TXN} SELECT category, CAST(1706745600 - max(sec) AS BIGINT) AS age_seconds, 1706745600 - max(sec) <= 172800 AS fresh FROM txn GROUP BY 1")
def p22(spark, sf_dir):
    age = F.lit(1706745600) - F.max("sec")
    return txn(spark, sf_dir).groupBy("category").agg(age.cast("long").alias("age_seconds"), (age <= 172800).alias("fresh"))


@query("P24_data_contract", "SELECT doc_id, CAST((text IS NOT NULL) AS INT) * 50 + CAST((quality IS NOT NULL) AS INT) * 30 + CAST((lang IS NOT NULL) AS INT) * 20 AS completeness, concat_ws(',', CASE WHEN text IS NULL THEN 'text' END, CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN lang IS NULL THEN 'lang' END) AS missing FROM documents LEFT JOIN labels USING (doc_id)")
def p24(spark, sf_dir):
    weights = {"text": 50, "quality": 30, "lang": 20}
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    score = sum((F.when(F.col(c).isNotNull(), w).otherwise(0) for c, w in weights.items()), F.lit(0))
    return joined.select("doc_id", score.alias("completeness"), F.array_join(p.reasons({c: F.col(c).isNull() for c in weights}), ",").alias("missing"))
