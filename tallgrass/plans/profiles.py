"""Queries of deposit, contact and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import profiles as o
from tallgrass.operators.quantiles import quantiles
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import ACCOUNTS, EDGES, SCORES, TXN, accounts, edges, scores, table, txn

from .registry import query
from .windows import ORDER, ROWS, r

NOW, TODAY = 1706572800, "1998-12-31"
AGE = f"(({NOW} - sec) / 86400e0)"
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in LINES)


def ramp(x: str, low: int, high: int) -> str:
    return f"greatest(0e0, least(1e0, ({x} - {low}) / {high - low}e0))"


G1 = f"""WITH {TXN}, g AS (SELECT entity_id, datediff('day', min(day), max(day)) AS days_history, count(*) AS n_rows, count(*) FILTER (amount > 0) AS n_deposits, count(*) FILTER (amount < 0) AS n_expenses FROM txn GROUP BY 1),
s AS (SELECT *, 0.4e0 * {ramp('days_history', 20, 29)} + 0.3e0 * {ramp('n_deposits', 20, 60)} + 0.3e0 * {ramp('n_rows', 40, 100)} AS score, days_history >= 20 AND n_rows >= 40 AND n_deposits >= 20 AS allowed FROM g)
SELECT entity_id, days_history, n_rows, n_deposits, n_expenses, {r('score', 'score')}, CASE WHEN score >= 0.7e0 THEN 'sufficient' WHEN score >= 0.5e0 THEN 'marginal' ELSE 'insufficient' END AS flag, CASE WHEN score >= 0.7e0 THEN 'challenger' ELSE 'champion' END AS model, allowed FROM s"""


@query("G1_sufficiency", G1)
def g1(spark, sf_dir):
    found = o.data_sufficiency(txn(spark, sf_dir), "entity_id", "day", "amount", (20, 29), (40, 100), (20, 60))
    return rounded(found, ["entity_id", "days_history", "n_rows", "n_deposits", "n_expenses", "flag", "model", "allowed"], ["score"])


@query("G2_fallback_income", f"WITH {TXN} SELECT entity_id, count(*) AS n, {r('avg(amount)', 'mean_amount')}, {r('coalesce(sum(amount) FILTER (amount > 0), 0)', 'deposits')}, {r('coalesce(sum(-amount) FILTER (amount < 0), 0)', 'expenses')}, {r('avg(amount) FILTER (amount > 0)', 'mean_deposit')}, {r('avg(amount) FILTER (amount > 0) * 2 * 26', 'income', 3)} FROM txn GROUP BY 1")
def g2(spark, sf_dir):
    found = o.fallback_income(txn(spark, sf_dir), "entity_id", "amount")
    return rounded(found, ["entity_id", "n"], ["mean_amount", "deposits", "expenses", "mean_deposit"]).join(rounded(found, ["entity_id"], ["income"], 3), "entity_id")


G3 = f"""WITH {TXN}, gaps AS (SELECT *, (sec - lag(sec) OVER {ROWS}) / 86400e0 AS g FROM txn WHERE category = 'purchase'), p AS (SELECT entity_id, count(*) AS n, median(g) AS m, stddev_samp(g) AS s, stddev_samp(g) / avg(g) AS cv FROM gaps GROUP BY 1 HAVING count(*) >= 3),
k AS (SELECT *, CASE WHEN floor(m) BETWEEN 6 AND 8 THEN 'weekly' WHEN floor(m) BETWEEN 13 AND 15 THEN 'biweekly' WHEN floor(m) BETWEEN 16 AND 17 THEN 'semimonthly' WHEN floor(m) BETWEEN 28 AND 32 THEN 'monthly' ELSE 'irregular' END AS rhythm FROM p),
c AS (SELECT *, CASE WHEN cv IS NULL OR cv > 1 THEN 0e0 ELSE 0.3e0 * least(1e0, n / 10e0) + 0.4e0 * (1 - cv) + 0.3e0 * CASE WHEN rhythm IN ('biweekly', 'monthly') THEN 1e0 WHEN rhythm IN ('weekly', 'semimonthly') THEN 0.9e0 ELSE 0.3e0 END END AS confidence FROM k)
SELECT entity_id, n, {r('m', 'median_gap')}, {r('s', 'gap_std')}, {r('cv', 'gap_cv')}, rhythm, {r('confidence', 'confidence')}, rhythm <> 'irregular' AND confidence >= 0.6e0 AS paycheck FROM c"""


@query("G3_deposit_periodicity", G3)
def g3(spark, sf_dir):
    found = o.deposit_periodicity(txn(spark, sf_dir).where("category = 'purchase'"), "entity_id", ORDER)
    return rounded(found, ["entity_id", "n", "rhythm", "paycheck"], ["median_gap", "gap_std", "gap_cv", "confidence"])


G4 = f"""WITH {TXN}, g AS (SELECT entity_id, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS low, max(value) AS high, median(value) AS median, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.1) AS a, quantile_cont(value, 0.9) AS b FROM txn GROUP BY 1),
s AS (SELECT entity_id, median(abs(value - median)) AS mad, avg(value) FILTER (value BETWEEN a AND b) AS trimmed FROM txn JOIN g USING (entity_id) GROUP BY 1), c AS (SELECT *, std / mean AS cv FROM g JOIN s USING (entity_id))
SELECT entity_id, n, {r('mean', 'mean')}, {r('std', 'std')}, {r('low', 'low')}, {r('high', 'high')}, {r('median', 'median')}, {r('p25', 'p25')}, {r('p75', 'p75')}, {r('mad', 'mad')}, {r('trimmed', 'trimmed_mean')}, {r('cv', 'cv')},
{r(f"CASE WHEN n < 3 THEN 0 ELSE 0.5e0 * (CASE WHEN cv IS NULL OR cv < 0 THEN 0 ELSE 1 - greatest(0e0, least(1e0, (cv - 0.2e0) / 0.8e0)) END) + 0.3e0 * least(1e0, n / 10e0) + 0.2e0 * (CASE WHEN median IS NULL OR median = 0 THEN 0.5e0 ELSE greatest(0e0, 1 - abs(mean / median - 1)) END) END", 'score')} FROM c"""


@query("G4_deposit_stability", G4)
def g4(spark, sf_dir):
    found = o.deposit_spread(txn(spark, sf_dir), "entity_id", "value")
    return rounded(found, ["entity_id", "n"], ["mean", "std", "low", "high", "median", "p25", "p75", "mad", "trimmed_mean", "cv", "score"])


G6 = f"""WITH g AS (SELECT o_custkey AS account_id, count(*) AS made, count(*) FILTER (o_orderstatus = 'F') AS kept, count(*) FILTER (o_orderstatus = 'P') AS broken, count(*) FILTER (o_orderpriority = '5-LOW') AS low, avg(o_totalprice) AS mean_amount, coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0) AS k, sum(o_totalprice) AS t, max((CAST(o_orderdate AS DATE), o_totalprice)) AS l, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders GROUP BY 1),
s AS (SELECT *, l[1] AS last_day, l[2] AS last_amount, datediff('day', l[1], DATE '{TODAY}') AS since FROM g)
SELECT account_id, made, kept, broken, open, 0 * made AS partial, {r('kept / made', 'kept_rate')}, {r('broken / made', 'broken_rate')}, {r('mean_amount', 'mean_amount', 2)}, {r('k / t', 'kept_ratio')}, last_day, {r('last_amount', 'last_amount', 2)}, since AS days_since_last, CASE WHEN since <= 30 THEN 1e0 WHEN since <= 90 THEN 0.5e0 ELSE 0e0 END AS recency FROM s"""


@query("G6_ptp_features", G6)
def g6(spark, sf_dir):
    found = o.promises(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "account_id"), "account_id", "o_orderstatus", "o_orderdate", "o_totalprice", {"kept": "F", "broken": "P", "partial": "H", "open": "O"}, TODAY)
    keys = ["account_id", "made", "kept", "broken", "open", "partial", "last_day", "days_since_last", "recency"]
    return rounded(rounded(found, [*keys, "mean_amount", "last_amount"], ["kept_rate", "broken_rate", "kept_ratio"]), [*keys, "kept_rate", "broken_rate", "kept_ratio"], ["mean_amount", "last_amount"], 2).select(*keys, "mean_amount", "last_amount", "kept_rate", "broken_rate", "kept_ratio")


G7 = f"WITH {TXN} SELECT entity_id, " + ", ".join(f"count(*) FILTER ({AGE} <= {d}) AS contacts_{d}d" for d in (7, 30, 90)) + f", {r(f'min({AGE})', 'days_since_last')}, " + r("avg(CAST(category IN ('click', 'purchase') AS INT))", "response_rate") + ", count(*) FILTER (category = 'click') AS promises, " + r("CASE WHEN count(*) FILTER (category = 'purchase') > 0 THEN count(*) FILTER (category = 'click') / count(*) FILTER (category = 'purchase') END", "promise_rate") + " FROM txn GROUP BY 1"


@query("G7_contact_counts", G7)
def g7(spark, sf_dir):
    found = o.contacts(txn(spark, sf_dir), "entity_id", "category", "sec", NOW, ["click", "purchase"], "click", "purchase")
    return rounded(found, ["entity_id", "contacts_7d", "contacts_30d", "contacts_90d", "promises"], ["days_since_last", "response_rate", "promise_rate"])


@query("G21_payment_patterns", f"WITH {TXN} SELECT category, {r('avg(CAST(value > 20 AS INT))', 'payment_rate')}, {r('avg(value) FILTER (value > 20)', 'mean')}, {r('stddev_samp(value) FILTER (value > 20)', 'std')}, {r('min(value) FILTER (value > 20)', 'low')}, {r('max(value) FILTER (value > 20)', 'high')}, " + ", ".join(r(f"quantile_cont(value, {q}) FILTER (value > 20)", n) for q, n in ((0.5, "median"), (0.25, "p25"), (0.75, "p75"), (0.9, "p90"))) + " FROM txn GROUP BY 1")
def g21(spark, sf_dir):
    found = o.payer_spread(txn(spark, sf_dir), "category", "value", 20.0)
    return rounded(found, ["category"], found.columns[1:])


@query("G22_channel_stats", f"WITH {TXN}, c AS (SELECT * FROM (VALUES ('view', 0.1e0), ('click', 0.5e0), ('purchase', 2e0)) v(category, cost)) SELECT category, count(*) AS n, {r('avg(CAST(value > 30 AS INT))', 'response_rate')}, {r('sum(cost)', 'total_cost')} FROM txn JOIN c USING (category) GROUP BY 1")
def g22(spark, sf_dir):
    costs = spark.createDataFrame([("view", 0.1), ("click", 0.5), ("purchase", 2.0)], "category string, cost double")
    g = txn(spark, sf_dir).join(F.broadcast(costs), "category").groupBy("category").agg(F.count("*").alias("n"), F.avg((F.col("value") > 30).cast("double")).alias("response_rate"), F.sum("cost").alias("total_cost"))
    return rounded(g, ["category", "n"], ["response_rate", "total_cost"])


G24 = f"SELECT o_custkey AS entity_id, count(*) AS n, {r('avg(l_extendedprice)', 'mean', 2)}, {r('stddev_samp(l_extendedprice)', 'std', 2)}, {r('min(l_extendedprice)', 'low', 2)}, {r('max(l_extendedprice)', 'high', 2)}, {r('sum(l_extendedprice)', 'total', 2)}, count(DISTINCT l_returnflag) AS kinds, count(DISTINCT l_suppkey) AS merchants, count(DISTINCT CAST(l_shipdate AS DATE)) AS days_active, {r('count(*) / count(DISTINCT CAST(l_shipdate AS DATE))', 'frequency', 2)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"


@query("G24_entity_profile", G24)
def g24(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = F.col("l_extendedprice")
    days = F.count_distinct(F.to_date("l_shipdate"))
    g = rows.groupBy(F.col("o_custkey").alias("entity_id")).agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev(x).alias("std"), F.min(x).alias("low"), F.max(x).alias("high"), F.sum(x).alias("total"), F.count_distinct("l_returnflag").alias("kinds"), F.count_distinct("l_suppkey").alias("merchants"), days.alias("days_active"), (F.count("*") / days).alias("frequency"))
    return rounded(g, ["entity_id", "n", "kinds", "merchants", "days_active"], ["mean", "std", "low", "high", "total", "frequency"], 2)


G28 = f"""WITH {TXN}, d AS (SELECT *, sec - lag(sec) OVER {ROWS} AS g FROM txn WHERE amount > 0), g AS (SELECT entity_id, count(*) AS n, stddev_samp(value) / avg(value) AS cv, count(g) AS gaps, stddev_samp(g) / avg(g) AS gcv, avg(CAST(category = 'click' AS INT)) AS k, avg(CAST(value >= 50 AS INT)) AS big FROM d GROUP BY 1)
SELECT entity_id, n, {r('0.25e0 * least(1e0, n / 12e0) + 0.25e0 * greatest(0e0, 1 - coalesce(cv, 1)) + 0.2e0 * CASE WHEN gaps = 0 THEN 0.5e0 ELSE greatest(0e0, 1 - coalesce(gcv, 1)) END + 0.15e0 * k + 0.15e0 * big', 'confidence')} FROM g"""


@query("G28_deposit_confidence", G28)
def g28(spark, sf_dir):
    found = o.deposit_confidence(txn(spark, sf_dir).where("amount > 0"), "entity_id", "value", ORDER, F.col("category") == "click", 50.0)
    return rounded(found, ["entity_id", "n"], ["confidence"])


@query("G33_employers", f"WITH {EDGES} SELECT dst, count(*) AS payees, {r('avg(weight)', 'mean_paid', 2)}, {r('median(weight)', 'median_paid', 2)}, {r('stddev_samp(weight)', 'std_paid', 2)}, {r('avg(n)', 'pay_frequency')}, {r('0.5e0 * least(1e0, count(*) / 200e0) + 0.5e0 * greatest(0e0, 1 - stddev_samp(weight) / avg(weight))', 'confidence')} FROM edges GROUP BY 1 HAVING count(*) >= 50")
def g33(spark, sf_dir):
    spread = F.greatest(F.lit(0.0), 1 - F.stddev("weight") / F.avg("weight"))
    g = edges(spark, sf_dir).groupBy("dst").agg(F.count("*").alias("payees"), F.avg("weight").alias("mean_paid"), F.percentile("weight", 0.5).alias("median_paid"), F.stddev("weight").alias("std_paid"), F.avg("n").alias("pay_frequency"), (0.5 * F.least(F.lit(1.0), F.count("*") / 200) + 0.5 * spread).alias("confidence")).where("payees >= 50")
    return rounded(g, ["dst", "payees"], ["mean_paid", "median_paid", "std_paid"], 2).join(rounded(g, ["dst"], ["pay_frequency", "confidence"]), "dst")


G38 = f"""WITH {ACCOUNTS}, s AS (SELECT * FROM (VALUES ('base', 1e0, 1e0), ('adverse', 1.4e0, 1.2e0), ('severe', 1.8e0, 1.4e0)) v(scenario, a, b)), l AS (SELECT scenario, segment, balance, least(1e0, propensity * a) * least(1e0, 0.45e0 * b) * balance AS loss FROM accounts, s),
q AS (SELECT scenario, segment, quantile_cont(loss, 0.95) AS v FROM l GROUP BY 1, 2) SELECT scenario, segment, count(*) AS n, {r('sum(loss)', 'expected_loss', 2)}, {r('sum(loss) / sum(balance)', 'loss_rate')}, {r('max(v)', 'var_95', 2)}, {r('avg(loss) FILTER (loss >= v)', 'cvar_95', 2)} FROM l JOIN q USING (scenario, segment) GROUP BY 1, 2"""


@query("G38_stress_el", G38)
def g38(spark, sf_dir):
    scenarios = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in (("base", 1.0, 1.0), ("adverse", 1.4, 1.2), ("severe", 1.8, 1.4))])
    rows = accounts(spark, sf_dir).select("segment", "balance", "propensity", F.explode(scenarios).alias("s")).select("segment", "balance", "s.scenario", (F.least(F.lit(1.0), F.col("propensity") * F.col("s.a")) * F.least(F.lit(1.0), 0.45 * F.col("s.b")) * F.col("balance")).alias("loss"))
    tail = quantiles(rows, ["scenario", "segment"], "loss", [0.95]).select("scenario", "segment", F.col("q")[0].alias("var_95"))
    g = rows.join(F.broadcast(tail), ["scenario", "segment"]).groupBy("scenario", "segment").agg(F.count("*").alias("n"), F.sum("loss").alias("expected_loss"), (F.sum("loss") / F.sum("balance")).alias("loss_rate"), F.max("var_95").alias("var_95"), F.avg(F.when(F.col("loss") >= F.col("var_95"), F.col("loss"))).alias("cvar_95"))
    return rounded(g, ["scenario", "segment", "n"], ["expected_loss", "var_95", "cvar_95"], 2).join(rounded(g, ["scenario", "segment"], ["loss_rate"]), ["scenario", "segment"])


GRID = "[1e0, 1.25e0, 1.5e0, 1.75e0, 2e0]"


@query("G39_sensitivity_grid", f"WITH {ACCOUNTS}, g AS (SELECT unnest({GRID}) AS m), e AS (SELECT m, sum(least(1e0, propensity * m) * 0.45e0 * balance) AS el FROM accounts, g GROUP BY 1), b AS (SELECT max(el) FILTER (m = 1) AS base FROM e) SELECT m AS multiplier, {r('el', 'expected_loss', 2)}, m = (SELECT min(m) FROM e, b WHERE el >= 1.3e0 * base) AS reaches_target FROM e")
def g39(spark, sf_dir):
    """Expected loss over a grid, and which multiplier is the smallest that reaches 1.3 times the base loss."""
    grid = accounts(spark, sf_dir).withColumn("multiplier", F.explode(F.array(*[F.lit(m) for m in (1.0, 1.25, 1.5, 1.75, 2.0)])))
    el = grid.groupBy("multiplier").agg(F.sum(F.least(F.lit(1.0), F.col("propensity") * F.col("multiplier")) * 0.45 * F.col("balance")).alias("expected_loss"))
    base = el.agg(F.max(F.when(F.col("multiplier") == 1, F.col("expected_loss"))).alias("base"))
    first = el.crossJoin(base).where("expected_loss >= 1.3 * base").agg(F.min("multiplier").alias("first"))
    return rounded(el.crossJoin(first).withColumn("reaches_target", F.col("multiplier") == F.col("first")), ["multiplier", "reaches_target"], ["expected_loss"], 2)


G41 = """WITH d AS (SELECT text, toxic, quality, lang FROM documents LEFT JOIN labels USING (doc_id)), n AS (SELECT count(*) AS n, count(*) FILTER (text IS NULL OR toxic IS NULL OR quality IS NULL OR lang IS NULL) AS w, count(text) AS t, count(toxic) AS x, count(quality) AS q, count(lang) AS l, corr(CAST(toxic IS NULL AS INT), CAST(quality IS NULL AS INT)) AS c FROM d)
SELECT f AS feature, n - k AS nulls, round((n - k) / n + 1.3e-7, 4) AS rate, w AS rows_with_nulls, CASE WHEN c > 0.7 AND f = 'toxic' THEN 'quality' WHEN c > 0.7 AND f = 'quality' THEN 'toxic' ELSE '' END AS tied_to FROM (SELECT *, unnest(['text', 'toxic', 'quality', 'lang']) AS f, unnest([t, x, q, l]) AS k FROM n)"""


@query("G41_missing_report", G41)
def g41(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(o.null_patterns(joined, ["text", "toxic", "quality", "lang"]), ["feature", "nulls", "rows_with_nulls", "tied_to"], ["rate"])


G42 = f"""WITH l AS ({LONG}), q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m, stddev_samp(value) AS s FROM l GROUP BY 1), c AS (SELECT feature, count(value) AS n, count(*) FILTER (value < a - 1.5e0 * (b - a) OR value > b + 1.5e0 * (b - a)) AS i, count(*) FILTER (abs(value - m) > 3 * s) AS z FROM l JOIN q USING (feature) GROUP BY 1)
SELECT feature, n, i AS iqr_outliers, z AS z_outliers, {r('i / n', 'iqr_rate')}, {r('z / n', 'z_rate')}, CASE WHEN i / n > 0.1e0 THEN 'high' WHEN i / n > 0.05e0 THEN 'medium' ELSE 'low' END AS severity FROM c"""


@query("G42_outlier_report", G42)
def g42(spark, sf_dir):
    return rounded(o.outliers(table(spark, sf_dir, "lineitem"), LINES), ["feature", "n", "iqr_outliers", "z_outliers", "severity"], ["iqr_rate", "z_rate"])


SLIM = "d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_quantity AS again, l_quantity * 2 + 1 AS target, l_discount, 'x' AS fixed FROM lineitem)"


@query("G44_consistency_report", f"WITH {SLIM} SELECT 'repeated rows' AS finding, '*' AS columns, (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS n UNION ALL SELECT 'repeated keys', 'l_orderkey', (SELECT count(*) - count(DISTINCT l_orderkey) FROM d) UNION ALL SELECT 'constant', 'fixed', 1 UNION ALL SELECT 'identical', 'l_quantity,again', 1 FROM d HAVING bool_and(l_quantity = again) UNION ALL SELECT 'like the target', 'l_quantity', 1 FROM d HAVING abs(corr(l_quantity, target)) > 0.95 UNION ALL SELECT 'like the target', 'l_discount', 1 FROM d HAVING abs(corr(l_discount, target)) > 0.95")
def g44(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_quantity").alias("again"), (F.col("l_quantity") * 2 + 1).alias("target"), "l_discount", F.lit("x").alias("fixed"))
    return o.consistency(rows, ["l_orderkey"], "target", ["l_quantity", "l_discount"])


TOP = "(SELECT feature, string_agg(value || ':' || c, ',' ORDER BY c DESC, value) AS top FROM (SELECT feature, value, count(*) AS c, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS pos FROM w WHERE value IS NOT NULL GROUP BY 1, 2) WHERE pos <= 3 GROUP BY 1)"
G46 = f"""WITH l AS ({LONG}), w AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem), m AS (SELECT feature, count(value) AS n, count(*) - count(value) AS missing, count(DISTINCT value) AS uniques, avg(value) AS m1, avg(value * value) AS m2, avg(value * value * value) AS m3, var_pop(value) AS v, stddev_samp(value) AS std, min(value) AS low, quantile_cont(value, 0.25) AS p25, median(value) AS median, quantile_cont(value, 0.75) AS p75, max(value) AS high FROM l GROUP BY 1)
SELECT feature, n, missing, uniques, {r('m1', 'mean', 3)}, {r('std', 'std', 3)}, {r('low', 'low', 3)}, {r('p25', 'p25', 3)}, {r('median', 'median', 3)}, {r('p75', 'p75', 3)}, {r('high', 'high', 3)}, {r('(m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1) / power(v, 1.5)', 'skew', 3)}, CAST(NULL AS VARCHAR) AS top FROM m
UNION ALL SELECT feature, count(value), count(*) - count(value), count(DISTINCT value), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, max(top) FROM w JOIN {TOP} USING (feature) GROUP BY 1"""


@query("G46_univariate_profile", G46)
def g46(spark, sf_dir):
    found = o.univariate(table(spark, sf_dir, "lineitem"), LINES, ["l_returnflag", "l_linestatus"])
    return rounded(found, ["feature", "n", "missing", "uniques", "top"], ["mean", "std", "low", "p25", "median", "p75", "high", "skew"], 3)


G48 = f"""WITH {SCORES}, f AS (SELECT *, label = 1 AS flag FROM scores), g AS (SELECT segment, count(*) AS n, avg(y) AS m, var_samp(y) AS v FROM f GROUP BY 1), t AS (SELECT avg(y) AS m, count(*) AS n FROM f),
c AS (SELECT segment, grp, count(*) AS n FROM f GROUP BY 1, 2), c2 AS (SELECT n, sum(n) OVER (PARTITION BY segment) AS a, sum(n) OVER (PARTITION BY grp) AS b, sum(n) OVER () AS t FROM c),
e AS (SELECT min(y) AS lo, max(y) AS hi FROM f), b AS (SELECT least(4, floor((y - lo) / (hi - lo) * 5)) AS x, segment AS s, count(*) AS n FROM f, e GROUP BY 1, 2), b2 AS (SELECT n, sum(n) OVER (PARTITION BY x) AS a, sum(n) OVER (PARTITION BY s) AS b, sum(n) OVER () AS t FROM b)
SELECT 'pearson' AS test, {r('corr(y, champion)', 'statistic')} FROM f UNION ALL SELECT 'welch', {r('(avg(y) FILTER (flag) - avg(y) FILTER (NOT flag)) / sqrt(var_samp(y) FILTER (flag) / count(*) FILTER (flag) + var_samp(y) FILTER (NOT flag) / count(*) FILTER (NOT flag))', 'statistic')} FROM f
UNION ALL SELECT 'anova', {r('(sum(g.n * power(g.m - t.m, 2)) / (count(*) - 1)) / (sum((g.n - 1) * g.v) / (max(t.n) - count(*)))', 'statistic')} FROM g, t UNION ALL SELECT 'chi2', {r('max(t) * (sum(n * n / (a * b)) - 1)', 'statistic', 3)} FROM c2 UNION ALL SELECT 'mutual information', {r('sum(n / t * ln(n * t / (a * b)))', 'statistic')} FROM b2"""


@query("G48_bivariate_tests", G48)
def g48(spark, sf_dir):
    found = o.tests(scores(spark, sf_dir).withColumn("flag", F.col("label") == 1), "y", "champion", "flag", "segment", "grp")
    whole = F.when(F.col("test") == "chi2", F.round(F.col("statistic") + 1.3e-7, 3)).otherwise(F.round(F.col("statistic") + 1.3e-7, 4))
    return found.select("test", whole.alias("statistic"))


PAIRS = [(x, y) for i, x in enumerate(LINES) for y in LINES[i + 1 :]]
SKEW = " + ".join(f"(avg(power({c}, 3)) - 3 * avg({c}) * avg(power({c}, 2)) + 2 * power(avg({c}), 3)) / power(var_pop({c}), 1.5)" for c in LINES)
G51 = f"SELECT count(*) AS rows, 4 AS columns, {r(f'({SKEW}) / 4', 'mean_skew', 3)}, {r('(' + ' + '.join(f'kurtosis_pop({c})' for c in LINES) + ') / 4', 'mean_kurtosis', 3)}, {r('(' + ' + '.join(f'avg(CAST({c} = 0 AS INT))' for c in LINES) + ') / 4', 'sparsity', 3)}, {r('(' + ' + '.join(f'abs(corr({x}, {y}))' for x, y in PAIRS) + ') / 6', 'mean_correlation')}, {r('greatest(' + ', '.join(f'abs(corr({x}, {y}))' for x, y in PAIRS) + ')', 'max_correlation')}, (SELECT {r('max(c) / min(c)', 'i')} FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag)) AS imbalance FROM lineitem"


@query("G51_meta_features", G51)
def g51(spark, sf_dir):
    found = o.meta_features(table(spark, sf_dir, "lineitem"), LINES, "l_returnflag")
    return rounded(rounded(found, ["rows", "columns", "mean_correlation", "max_correlation", "imbalance"], ["mean_skew", "mean_kurtosis", "sparsity"], 3), ["rows", "columns", "mean_skew", "mean_kurtosis", "sparsity"], ["mean_correlation", "max_correlation", "imbalance"])


@query("G51b_task_similarity")
def g51b(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    old = F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")
    return o.task_similarity(o.meta_features(rows.where(old), LINES, "l_returnflag"), o.meta_features(rows.where(~old), LINES, "l_returnflag"))


@query("G56_decayed_average", f"WITH {TXN}, w AS (SELECT entity_id, value, exp(-ln(2) * {AGE} / 10) AS e, greatest(0e0, 1 - {AGE} / 60) AS l, CASE WHEN {AGE} <= 7 THEN 1e0 WHEN {AGE} <= 30 THEN 0.5e0 ELSE 0.25e0 END AS s FROM txn) SELECT entity_id, {r('sum(value * e) / sum(e)', 'exponential')}, {r('sum(value * l) / sum(l)', 'linear')}, {r('sum(value * s) / sum(s)', 'step')} FROM w GROUP BY 1")
def g56(spark, sf_dir):
    age = (F.lit(NOW) - F.col("sec")) / 86400.0
    weights = {"exponential": F.exp(-F.log(F.lit(2.0)) * age / 10), "linear": F.greatest(F.lit(0.0), 1 - age / 60), "step": F.when(age <= 7, 1.0).when(age <= 30, 0.5).otherwise(0.25)}
    g = txn(spark, sf_dir).groupBy("entity_id").agg(*[(F.sum(w * F.col("value")) / F.sum(w)).alias(n) for n, w in weights.items()])
    return rounded(g, ["entity_id"], list(weights))
