"""Queries of grouped features, cohorts, profiles, income signals and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import aggregates as a
from tallgrass.operators.quantiles import with_quantiles
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import ACCOUNTS, SCORES, TXN, accounts, scores, table, txn

from .registry import query
from .windows import ORDER, ROWS, r

NOW = 1706572800
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("G2_segment_stats", f"WITH {ACCOUNTS} SELECT segment, count(*) AS n, {r('avg(balance)', 'mean')}, {r('median(balance)', 'median')}, {r('stddev_samp(balance)', 'std')}, {r('count(*) / sum(count(*)) OVER ()', 'share')} FROM accounts GROUP BY 1")
def g2(spark, sf_dir):
    return rounded(a.segment_stats(accounts(spark, sf_dir), "segment", "balance"), ["segment", "n"], ["mean", "median", "std", "share"])


GAPS = f"gaps AS (SELECT *, (sec - lag(sec) OVER {ROWS}) / 86400e0 AS g FROM txn WHERE category = 'purchase')"


AGE = f"(({NOW} - sec) / 86400e0)"


@query("G8_preferred_channel", f"WITH {TXN}, c AS (SELECT entity_id, category, count(*) AS n FROM txn GROUP BY 1, 2) SELECT entity_id, category AS preferred, n AS weight FROM c QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, category) = 1")
def g8(spark, sf_dir):
    return a.best_by(txn(spark, sf_dir), "entity_id", "category", F.count("*"))


@query("G9_offer_history", "SELECT l_suppkey AS account_id, count(*) AS offers, round(avg(CAST(l_returnflag = 'A' AS INT)) + 1.3e-7, 4) AS acceptance, round(avg(l_discount) + 1.3e-7, 4) AS avg_discount FROM lineitem GROUP BY 1")
def g9(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("account_id")).agg(F.count("*").alias("offers"), a.share_of(F.col("l_returnflag") == "A").alias("acceptance"), F.avg("l_discount").alias("avg_discount"))
    return rounded(g, ["account_id", "offers"], ["acceptance", "avg_discount"])


@query("G10_capacity_score", f"WITH {ACCOUNTS}, d AS (SELECT account_id, CASE WHEN spend > 0 THEN balance * 12 / spend END AS dti FROM accounts) SELECT account_id, {r('dti', 'dti')}, CASE WHEN dti IS NULL THEN 0 WHEN dti < 0.02 THEN 100 WHEN dti < 0.05 THEN 70 WHEN dti < 0.1 THEN 40 ELSE 10 END AS capacity FROM d")
def g10(spark, sf_dir):
    d = accounts(spark, sf_dir).withColumn("dti", F.when(F.col("spend") > 0, F.col("balance") * 12 / F.col("spend")))
    score = F.when(F.col("dti").isNull(), 0).when(F.col("dti") < 0.02, 100).when(F.col("dti") < 0.05, 70).when(F.col("dti") < 0.1, 40).otherwise(10)
    return rounded(d.withColumn("capacity", score), ["account_id", "capacity"], ["dti"])


@query("G11_decision_summary", f"WITH {ACCOUNTS} SELECT segment, count(*) AS n, {r('sum(balance)', 'balances', 2)}, {r('sum(balance * propensity)', 'recovery', 2)}, {r('sum(balance * propensity) / (2.5e0 * count(*))', 'roi', 2)} FROM accounts GROUP BY 1")
def g11(spark, sf_dir):
    g = accounts(spark, sf_dir).groupBy("segment").agg(F.count("*").alias("n"), F.sum("balance").alias("balances"), F.sum(F.col("balance") * F.col("propensity")).alias("recovery"))
    return rounded(g.withColumn("roi", F.col("recovery") / (2.5 * F.col("n"))), ["segment", "n"], ["balances", "recovery", "roi"], 2)


@query("G12_batch_summary", f"WITH {SCORES} SELECT segment AS model, p >= 0.5 AS approved, count(*) AS n, count(DISTINCT entity_id) AS entities FROM scores WHERE day >= DATE '1998-01-01' GROUP BY 1, 2")
def g12(spark, sf_dir):
    return scores(spark, sf_dir).where("day >= '1998-01-01'").groupBy(F.col("segment").alias("model"), (F.col("p") >= 0.5).alias("approved")).agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("entities"))


G13 = """WITH f AS (SELECT o_custkey AS id, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS cohort FROM orders GROUP BY 1),
g AS (SELECT cohort, CAST(datediff('month', cohort, o_orderdate) AS BIGINT) AS period, count(DISTINCT id) AS active FROM orders JOIN f ON id = o_custkey GROUP BY 1, 2)
SELECT cohort, period, active, round(active / max(CASE WHEN period = 0 THEN active END) OVER (PARTITION BY cohort) + 1.3e-7, 4) AS retention FROM g"""


@query("G13_cohort_retention", G13)
def g13(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    return rounded(a.cohorts(orders, "id", "day"), ["cohort", "period", "active"], ["retention"])


@query("G14_cohort_ltv", f"WITH p AS (SELECT o_custkey, CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS cohort, sum(CAST(o_totalprice AS DECIMAL(28,6))) AS v FROM orders GROUP BY 1) SELECT cohort, count(*) AS n, {r('CAST(sum(v) AS DOUBLE) / count(*)', 'mean', 2)}, {r('median(CAST(v AS DOUBLE))', 'median', 2)}, {r('CAST(sum(v) AS DOUBLE)', 'total', 2)} FROM p GROUP BY 1")
def g14(spark, sf_dir):
    return rounded(a.cohort_value(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice"), ["cohort", "n"], ["mean", "median", "total"], 2)


@query("G15_rfm", f"SELECT o_custkey, datediff('day', CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS recency, count(*) AS frequency, {r('sum(o_totalprice)', 'monetary', 2)} FROM orders GROUP BY 1")
def g15(spark, sf_dir):
    return rounded(a.rfm(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice"), ["o_custkey", "recency", "frequency"], ["monetary"], 2)


@query("G16_segment_profile", f"WITH {SCORES} SELECT segment, count(*) AS n, {r('avg(y)', 'mean')}, {r('median(y)', 'median')}, {r('min(y)', 'low')}, {r('max(y)', 'high')}, {r('count(*) / sum(count(*)) OVER ()', 'share')} FROM scores GROUP BY 1")
def g16(spark, sf_dir):
    return rounded(a.segment_stats(scores(spark, sf_dir), "segment", "y"), ["segment", "n"], ["mean", "median", "low", "high", "share"])


@query("G17_persona_stats", f"WITH {ACCOUNTS} SELECT CASE WHEN days_past_due > 90 THEN 'late' WHEN balance > 5000 THEN 'large' ELSE 'other' END AS persona, count(*) AS n, {r('avg(balance)', 'avg_balance')}, {r('avg(days_past_due)', 'avg_dpd')}, {r('count(*) / sum(count(*)) OVER ()', 'share')} FROM accounts GROUP BY 1")
def g17(spark, sf_dir):
    from pyspark.sql import Window

    persona = F.expr("CASE WHEN days_past_due > 90 THEN 'late' WHEN balance > 5000 THEN 'large' ELSE 'other' END")
    g = accounts(spark, sf_dir).groupBy(persona.alias("persona")).agg(F.count("*").alias("n"), F.avg("balance").alias("avg_balance"), F.avg("days_past_due").alias("avg_dpd"))
    return rounded(g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())), ["persona", "n"], ["avg_balance", "avg_dpd", "share"])


@query("G18_erv_portfolio", f"WITH {ACCOUNTS}, e AS (SELECT segment, balance, propensity * balance * 0.9e0 AS erv FROM accounts) SELECT segment, {r('sum(erv)', 'erv', 2)}, {r('avg(CAST(erv > 1000 AS INT))', 'contact_share')}, {r('sum(erv) / sum(balance)', 'recovery_rate')} FROM e GROUP BY 1")
def g18(spark, sf_dir):
    e = accounts(spark, sf_dir).withColumn("erv", F.col("propensity") * F.col("balance") * 0.9)
    g = e.groupBy("segment").agg(F.sum("erv").alias("erv"), a.share_of(F.col("erv") > 1000).alias("contact_share"), (F.sum("erv") / F.sum("balance")).alias("recovery_rate"))
    return rounded(g, ["segment"], ["erv"], 2).join(rounded(g, ["segment"], ["contact_share", "recovery_rate"]), "segment")


@query("G19_erv_sensitivity", f"WITH {ACCOUNTS} SELECT account_id, {r('least(1e0, propensity * 1.1e0) * balance * 1.1e0', 'best', 2)}, {r('propensity * 0.9e0 * balance * 0.9e0', 'worst', 2)} FROM accounts")
def g19(spark, sf_dir):
    p, b = F.col("propensity"), F.col("balance")
    return rounded(accounts(spark, sf_dir).select("account_id", (F.least(F.lit(1.0), p * 1.1) * b * 1.1).alias("best"), (p * 0.9 * b * 0.9).alias("worst")), ["account_id"], ["best", "worst"], 2)


@query("G20_portfolio_npv", f"WITH {ACCOUNTS} SELECT count(*) FILTER (days_past_due <= 90) AS n_tdr, count(*) FILTER (days_past_due > 90) AS n_legal, {r('sum(CASE WHEN days_past_due <= 90 THEN balance * propensity ELSE balance * 0.2e0 END)', 'npv', 2)} FROM accounts")
def g20(spark, sf_dir):
    tdr = F.col("days_past_due") <= 90
    g = accounts(spark, sf_dir).agg(F.count_if(tdr).alias("n_tdr"), F.count_if(~tdr).alias("n_legal"), F.sum(F.when(tdr, F.col("balance") * F.col("propensity")).otherwise(F.col("balance") * 0.2)).alias("npv"))
    return rounded(g, ["n_tdr", "n_legal"], ["npv"], 2)


@query("G23_arm_stats", f"WITH {TXN}, g AS (SELECT category AS arm, count(*) AS pulls, avg(CAST(value > 30 AS INT)) AS m FROM txn GROUP BY 1) SELECT arm, pulls, {r('m', 'mean_reward')}, {r('m + sqrt(2 * ln((SELECT count(*) FROM txn)) / pulls)', 'ucb')}, {r('(1 + m * pulls) / (2 + pulls)', 'posterior_mean')} FROM g")
def g23(spark, sf_dir):
    from pyspark.sql import Window

    g = txn(spark, sf_dir).groupBy(F.col("category").alias("arm")).agg(F.count("*").alias("pulls"), a.share_of(F.col("value") > 30).alias("mean_reward"))
    total = F.sum("pulls").over(Window.partitionBy())
    g = g.withColumn("ucb", F.col("mean_reward") + F.sqrt(2 * F.log(total) / F.col("pulls"))).withColumn("posterior_mean", (1 + F.col("mean_reward") * F.col("pulls")) / (2 + F.col("pulls")))
    return rounded(g, ["arm", "pulls"], ["mean_reward", "ucb", "posterior_mean"])


@query("G25_merchant_profile", f"SELECT l_suppkey, count(*) AS n, {r('avg(l_extendedprice)', 'mean')}, {r('stddev_samp(l_extendedprice)', 'std')}, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def g25(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("mean"), F.stddev("l_extendedprice").alias("std"), F.count_distinct("l_partkey").alias("parts"))
    return rounded(g, ["l_suppkey", "n", "parts"], ["mean", "std"])


G26 = f"""WITH {TXN}, c AS (SELECT entity_id, CAST(category <> lag(category) OVER {ROWS} AS INT) AS c FROM txn), cr AS (SELECT entity_id, avg(c) AS change_rate FROM c GROUP BY 1),
s AS (SELECT entity_id, category, count(*) / sum(count(*)) OVER (PARTITION BY entity_id) AS p FROM txn GROUP BY 1, 2), h AS (SELECT entity_id, sum(-p * log2(p)) AS h, count(*) AS k, max(p) AS d FROM s GROUP BY 1)
SELECT entity_id, {r('change_rate', 'change_rate')}, {r('CASE WHEN k > 1 THEN h / log2(k) ELSE 0 END', 'entropy_ratio')}, {r('d', 'dominance')} FROM h JOIN cr USING (entity_id)"""


@query("G26_source_consistency", G26)
def g26(spark, sf_dir):
    return rounded(a.source_consistency(txn(spark, sf_dir), "entity_id", "category", ORDER), ["entity_id"], ["change_rate", "entropy_ratio", "dominance"])


G27 = f"""WITH {TXN}, {GAPS.replace("WHERE category = 'purchase'", "WHERE amount > 0").replace(ROWS, ROWS.replace("entity_id", "entity_id, category"))}, s AS (SELECT entity_id, category, median(g) AS gap, avg(value) AS v, count(*) AS n FROM gaps GROUP BY 1, 2)
SELECT entity_id, category, n, {r("v * CASE WHEN gap BETWEEN 28 AND 32 THEN 1 WHEN gap BETWEEN 13 AND 15 THEN 2.17e0 WHEN gap BETWEEN 6 AND 8 THEN 4.33e0 WHEN gap > 0 THEN 30 / gap ELSE 1 END", 'monthly_equivalent', 1)} FROM s"""


@query("G27_income_estimate", G27)
def g27(spark, sf_dir):
    from pyspark.sql import Window

    from tallgrass.functions.scalar import monthly_equivalent

    w = Window.partitionBy("entity_id", "category").orderBy(*ORDER)
    gaps = txn(spark, sf_dir).where("amount > 0").withColumn("g", (F.col("sec") - F.lag("sec").over(w)) / 86400.0)
    s = gaps.groupBy("entity_id", "category").agg(F.percentile("g", 0.5).alias("gap"), F.avg("value").alias("v"), F.count("*").alias("n"))
    return rounded(s.withColumn("monthly_equivalent", monthly_equivalent(F.col("v"), F.col("gap"))), ["entity_id", "category", "n"], ["monthly_equivalent"], 1)


G29 = f"""WITH {TXN}, d AS (SELECT entity_id, date_trunc('week', day) AS week, sum(value) AS v, datediff('day', DATE '2024-01-01', date_trunc('week', day)) / 7 AS i FROM txn GROUP BY 1, 2, 4),
g AS (SELECT entity_id, regr_slope(v, i) AS slope, regr_r2(v, i) AS r2, count(*) AS n FROM d GROUP BY 1)
SELECT entity_id, n, {r('slope', 'slope')}, {r('r2', 'r2')}, CASE WHEN n < 3 THEN 'unknown' WHEN r2 < 0.3 THEN 'stable' WHEN slope > 0 THEN 'up' ELSE 'down' END AS trend FROM g"""


@query("G29_income_history", G29)
def g29(spark, sf_dir):
    weeks = txn(spark, sf_dir).groupBy("entity_id", F.to_date(F.date_trunc("week", "day")).alias("week")).agg(F.sum("value").alias("v"))
    found = a.trend(weeks.withColumn("i", F.datediff("week", F.lit("2024-01-01")) / 7.0), "entity_id", "i", "v")
    return rounded(found, ["entity_id", "n", "trend"], ["slope", "r2"])


@query("G30_seasonality_cv", f"WITH m AS (SELECT o_custkey, month(o_orderdate) AS m, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2) SELECT o_custkey, {r('least(1e0, stddev_samp(v) / avg(v))', 'seasonality')} FROM m GROUP BY 1")
def g30(spark, sf_dir):
    m = table(spark, sf_dir, "orders").groupBy("o_custkey", F.month("o_orderdate").alias("m")).agg(F.avg("o_totalprice").alias("v"))
    s = F.stddev("v") / F.avg("v")
    return rounded(m.groupBy("o_custkey").agg(F.least(F.lit(1.0), s).alias("seasonality")), ["o_custkey"], ["seasonality"])


@query("G37_roll_rates", f"WITH s AS (SELECT CASE WHEN o_totalprice > 300000 THEN '90+' WHEN o_totalprice > 150000 THEN '30-89' ELSE 'current' END AS f, o_custkey, o_orderdate, o_orderkey FROM orders), t AS (SELECT f, lead(f) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS t FROM s) SELECT f AS from_state, t AS to_state, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY f)', 'probability')} FROM t WHERE t IS NOT NULL GROUP BY 1, 2")
def g37(spark, sf_dir):
    state = F.when(F.col("o_totalprice") > 300000, "90+").when(F.col("o_totalprice") > 150000, "30-89").otherwise("current")
    orders = table(spark, sf_dir, "orders").withColumn("state", state)
    return rounded(a.transitions(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "state"), ["from_state", "to_state", "n"], ["probability"])


G38 = f"""WITH {ACCOUNTS}, s AS (SELECT * FROM (VALUES ('base', 1e0, 1e0), ('severe', 1.8e0, 1.4e0)) v(scenario, a, b)), l AS (SELECT scenario, segment, balance, least(1e0, propensity * a) * least(1e0, 0.45e0 * b) * balance AS loss FROM accounts, s)
SELECT scenario, segment, count(*) AS n, {r('sum(loss)', 'expected_loss', 2)}, {r('sum(loss) / sum(balance)', 'loss_rate', 4)}, {r('quantile_cont(loss, 0.95)', 'var_95', 2)} FROM l GROUP BY 1, 2"""


@query("G40_cleaning", f"WITH {TXN}, m AS (SELECT entity_id, median(value) AS m, count(*) AS n FROM txn GROUP BY 1), t AS (SELECT quantile_cont(value, 0.99) AS top FROM txn) SELECT event_id, {r('least(coalesce(value, m), top)', 'value')} FROM txn JOIN m USING (entity_id), t WHERE n >= 60")
def g40(spark, sf_dir):
    return rounded(a.cleaned(txn(spark, sf_dir), "entity_id", "value", 60, 0.99), ["event_id"], ["value"])


LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in LINES)


@query("G43_distribution_report", f"WITH l AS ({LONG}), g AS (SELECT feature, count(value) AS n, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS std, avg(power(value, 3)) AS m3, avg(power(value, 2)) AS m2, kurtosis_pop(value) AS k, var_pop(value) AS v FROM l GROUP BY 1) SELECT feature, n, {r('mean', 'mean')}, {r('median', 'median')}, {r('std', 'std')}, {r('(m3 - 3 * mean * m2 + 2 * power(mean, 3)) / power(v, 1.5)', 'skew', 3)}, {r('k', 'kurtosis', 3)}, n / 6 * (power((m3 - 3 * mean * m2 + 2 * power(mean, 3)) / power(v, 1.5), 2) + k * k / 4) < 5.991 AS normal FROM g")
def g43(spark, sf_dir):
    d = a.distribution_report(table(spark, sf_dir, "lineitem"), LINES)
    return rounded(rounded(d, ["feature", "n", "normal", "skew", "kurtosis"], ["mean", "median", "std"]), ["feature", "n", "normal", "mean", "median", "std"], ["skew", "kurtosis"], 3).withColumns({c: F.round(c, 4) for c in ("mean", "median", "std")})


@query("G45_quality_score", "WITH s AS (SELECT count(text) / count(*) AS completeness, avg(CAST(n_chars > 0 AS INT)) AS validity, count(DISTINCT text) / count(*) AS uniqueness FROM documents) SELECT round(completeness + 1.3e-7, 4) AS completeness, round(validity + 1.3e-7, 4) AS validity, round(uniqueness + 1.3e-7, 4) AS uniqueness, round(0.4e0 * completeness + 0.3e0 * validity + 0.3e0 * uniqueness + 1.3e-7, 4) AS quality FROM s")
def g45(spark, sf_dir):
    s = table(spark, sf_dir, "documents").agg((F.count("text") / F.count("*")).alias("completeness"), a.share_of(F.col("n_chars") > 0).alias("validity"), (F.count_distinct("text") / F.count("*")).alias("uniqueness"))
    return rounded(s.withColumn("quality", 0.4 * F.col("completeness") + 0.3 * F.col("validity") + 0.3 * F.col("uniqueness")), [], ["completeness", "validity", "uniqueness", "quality"])


@query("G47_correlation_matrix", " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, {r(f'corr({x}, {y})', 'r')} FROM lineitem" for i, x in enumerate(LINES) for y in LINES[i + 1 :]))
def g47(spark, sf_dir):
    return rounded(a.correlations(table(spark, sf_dir, "lineitem"), LINES), ["a", "b"], ["r"])


@query("G49_imbalance", "WITH c AS (SELECT l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT arg_max(k, (n, k)) AS most, arg_min(k, (n, k)) AS least, round(max(n) / min(n) + 1.3e-7, 4) AS ratio FROM c")
def g49(spark, sf_dir):
    return rounded(a.imbalance(table(spark, sf_dir, "lineitem"), "l_returnflag"), ["most", "least"], ["ratio"])


@query("G50_feature_quality", f"WITH l AS ({LONG}) SELECT feature, {r('avg(CAST(value IS NULL AS INT))', 'missing')}, count(DISTINCT value) AS distinct_values, {r('var_samp(value)', 'variance', 2)} FROM l GROUP BY 1")
def g50(spark, sf_dir):
    d = a.feature_quality(table(spark, sf_dir, "lineitem"), LINES)
    return d.select("feature", F.round(F.col("missing") + 1.3e-7, 4).alias("missing"), "distinct_values", F.round(F.col("variance") + 1.3e-7, 2).alias("variance"))


@query("G52_latency_volume", f"SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n, {r('quantile_cont(value, 0.5)', 'p50')}, {r('quantile_cont(value, 0.95)', 'p95')}, {r('quantile_cont(value, 0.99)', 'p99')}, {r('avg(CAST(event_type = $$error$$ AS INT))', 'error_rate')} FROM events GROUP BY 1".replace("$$", "'"))
def g52(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("hour", F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH"))
    g = rows.groupBy("hour").agg(F.count("*").alias("n"), a.share_of(F.col("event_type") == "error").alias("error_rate"))
    g = with_quantiles(g, rows, ["hour"], "value", [0.5, 0.95, 0.99]).select("*", *[F.col("q")[i].alias(f"p{q}") for i, q in enumerate((50, 95, 99))])
    return rounded(g, ["hour", "n"], ["p50", "p95", "p99", "error_rate"])


@query("G55_posterior_income", f"WITH {TXN} SELECT entity_id, {r('(50 / 400e0 + sum(value) / 2500e0) / (1 / 400e0 + count(value) / 2500e0)', 'posterior_mean')}, {r('1 / (1 / 400e0 + count(value) / 2500e0)', 'posterior_var')} FROM txn GROUP BY 1")
def g55(spark, sf_dir):
    return rounded(a.posterior_normal(txn(spark, sf_dir), "entity_id", "value", 50.0, 400.0, 2500.0), ["entity_id"], ["posterior_mean", "posterior_var"])


G28 = f"""WITH {TXN}, g AS (SELECT entity_id, count(*) AS n, stddev_samp(value) / avg(value) AS cv, (max(sec) - min(sec)) / 86400e0 AS span, avg(CAST(value > 50 AS INT)) AS big FROM txn WHERE amount > 0 GROUP BY 1)
SELECT entity_id, {r('0.3e0 * least(1e0, n / 30e0) + 0.25e0 / (1 + coalesce(cv, 0)) + 0.2e0 * least(1e0, span / 30) + 0.15e0 * big + CASE WHEN n >= 10 THEN 0.1e0 ELSE 0 END', 'confidence')} FROM g"""


@query("G32_income_risk", f"WITH {TXN}, g AS (SELECT entity_id, stddev_samp(value) / avg(value) AS cv, avg(CAST(category = 'error' AS INT)) AS errors FROM txn GROUP BY 1), s AS (SELECT *, 0.6e0 * least(1e0, cv / 2) + 0.4e0 * errors AS risk FROM g) SELECT entity_id, {r('risk', 'risk')}, CASE WHEN risk > 0.4 THEN 'high' WHEN risk > 0.3 THEN 'medium' ELSE 'low' END AS category, concat_ws('|', CASE WHEN cv > 1 THEN 'volatile' END, CASE WHEN errors > 0.25 THEN 'errors' END) AS flags FROM s")
def g32(spark, sf_dir):
    from tallgrass.operators.rules import first_match, reasons

    g = txn(spark, sf_dir).groupBy("entity_id").agg((F.stddev("value") / F.avg("value")).alias("cv"), a.share_of(F.col("category") == "error").alias("errors"))
    g = g.withColumn("risk", 0.6 * F.least(F.lit(1.0), F.col("cv") / 2) + 0.4 * F.col("errors"))
    g = g.withColumn("category", first_match({"high": "risk > 0.4", "medium": "risk > 0.3"}, "low")).withColumn("flags", F.array_join(reasons({"volatile": "cv > 1", "errors": "errors > 0.25"}), "|"))
    return rounded(g, ["entity_id", "category", "flags"], ["risk"])


@query("G54_feature_registry", "SELECT 'l_quantity' AS name, 'size' AS family, 0e0 AS null_rate FROM lineitem GROUP BY 1 UNION ALL SELECT 'l_tax', 'price', 0e0 FROM lineitem GROUP BY 1")
def g54(spark, sf_dir):
    rows = a.registry_rows(table(spark, sf_dir, "lineitem").select("l_quantity", "l_tax", "l_linestatus"), {"l_quantity": "size", "l_tax": "price"})
    return rows.where("family <> 'other'").select("name", "family", "null_rate")
