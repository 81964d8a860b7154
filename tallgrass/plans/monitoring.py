"""Queries of drift, calibration, comparison and rollout verdicts that join several statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallgrass.operators import statistics as v
from tallgrass.operators.quantiles import quantiles, with_quantiles
from tallgrass.operators.windows import global_rank, rounded
from tallgrass.sources.tables import SCORES, scores, table

from .registry import query
from .statistics import CHI, LINES, NEW, OLD, PSI, halves
from .windows import r


def both(df, keys, fine, coarse, digits=4, other=3):
    """Columns rounded to two precisions; keys tell the rows apart."""
    value = lambda c, d: F.round(F.col(c) + 1.3e-7, d).alias(c)
    return df.select(*keys, *[value(c, digits) for c in fine], *[value(c, other) for c in coarse])


def union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("V6_chi2_drift", f"WITH {CHI}, y AS (SELECT CASE WHEN {OLD} THEN 0 ELSE 1 END AS side, avg(CAST(l_returnflag = 'R' AS INT)) AS m, count(*) AS n FROM lineitem GROUP BY 1), z AS (SELECT max(m) FILTER (side = 0) AS m0, max(m) FILTER (side = 1) AS m1, max(n) FILTER (side = 0) AS n0, max(n) FILTER (side = 1) AS n1 FROM y) SELECT {r('(SELECT sum(power(n - e, 2) / e) FROM e)', 'chi2', 3)}, {r('(SELECT sqrt(sum(power(n - e, 2) / e) / max(t)) FROM e)', 'cramers_v', 6)}, {r('(m1 - m0) / sqrt((m0 * n0 + m1 * n1) / (n0 + n1) * (1 - (m0 * n0 + m1 * n1) / (n0 + n1)) * (1 / n0 + 1 / n1))', 'target_z')}, abs((m1 - m0) / sqrt((m0 * n0 + m1 * n1) / (n0 + n1) * (1 - (m0 * n0 + m1 * n1) / (n0 + n1)) * (1 / n0 + 1 / n1))) > 1.96 AS concept_drift FROM z")
def v6(spark, sf_dir):
    """Of two categories, and whether the target's rate moved between the halves."""
    lines = table(spark, sf_dir, "lineitem")
    found = v.chi_square(lines, "l_returnflag", "l_linestatus")
    new = ~(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp"))
    z = v.two_proportions(lines, new, F.col("l_returnflag") == "R").select(F.col("z").alias("target_z"))
    return both(found.crossJoin(z).withColumn("concept_drift", F.abs("target_z") > 1.96), ["concept_drift", F.round(F.col("cramers_v") + 1.3e-7, 6).alias("cramers_v")], ["target_z"], ["chi2"])


V7 = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(avg({c}) FILTER ({NEW}) / avg({c}) FILTER ({OLD}) - 1) AS m, abs(stddev_samp({c}) FILTER ({NEW}) / stddev_samp({c}) FILTER ({OLD}) - 1) AS s, min({c}) FILTER ({NEW}) - min({c}) FILTER ({OLD}) AS lo, max({c}) FILTER ({NEW}) - max({c}) FILTER ({OLD}) AS hi, avg(CAST({c} IS NULL AS INT)) FILTER ({NEW}) - avg(CAST({c} IS NULL AS INT)) FILTER ({OLD}) AS gone FROM lineitem"
    for c in LINES
)


@query("V7_distribution_monitor", f"WITH d AS ({V7}) SELECT feature, {r('m', 'mean_shift', 5)}, {r('s', 'std_shift', 5)}, {r('lo', 'min_shift', 2)}, {r('hi', 'max_shift', 2)}, {r('gone', 'missing_shift', 5)}, {r('(SELECT 0.7e0 * avg(m) + 0.3e0 * max(m) FROM d)', 'composite', 5)} FROM d")
def v7(spark, sf_dir):
    from tallgrass.operators.aggregates import long_form

    x = F.col("value")
    aggs = lambda i: [F.avg(x).alias(f"m{i}"), F.stddev(x).alias(f"s{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.avg(x.isNull().cast("double")).alias(f"g{i}")]
    old, new = (long_form(df, LINES).groupBy("feature").agg(*aggs(i)) for i, df in enumerate(halves(spark, sf_dir)))
    d = old.join(new, "feature").select("feature", F.abs(F.col("m1") / F.col("m0") - 1).alias("mean_shift"), F.abs(F.col("s1") / F.col("s0") - 1).alias("std_shift"), (F.col("a1") - F.col("a0")).alias("min_shift"), (F.col("b1") - F.col("b0")).alias("max_shift"), (F.col("g1") - F.col("g0")).alias("missing_shift"))
    whole = d.agg((0.7 * F.avg("mean_shift") + 0.3 * F.max("mean_shift")).alias("composite"))
    return both(d.crossJoin(whole), ["feature"], ["mean_shift", "std_shift", "missing_shift", "composite"], ["min_shift", "max_shift"], 5, 2)


CAL = """g AS (SELECT {k} AS segment, least(9, floor(p * 10)) AS b, count(*) AS n, sum(p) AS sp, sum(label) AS sy, sum(power(p - label, 2)) AS br, sum(-label * ln(greatest(1e-15, least(1 - 1e-15, p))) - (1 - label) * ln(1 - greatest(1e-15, least(1 - 1e-15, p)))) AS l FROM scores GROUP BY 1, 2),
c AS (SELECT segment, sum(n) AS n, sum(br) / sum(n) AS brier, sum(l) / sum(n) AS log_loss, sum(abs(sp - sy)) / sum(n) AS ece, max(abs(sp - sy) / n) AS mce, sum(power(sy - sp, 2) / (n * (sp / n) * (1 - sp / n))) AS hl FROM g GROUP BY 1)"""
CAL_ROW = f"segment, CAST(n AS BIGINT) AS n, {r('brier', 'brier', 5)}, {r('log_loss', 'log_loss', 5)}, {r('ece', 'ece', 5)}, {r('mce', 'mce', 5)}, {r('hl', 'hosmer_lemeshow', 3)}, CAST(brier < 0.25 AS INT) + CAST(ece < 0.05 AS INT) + CAST(hl < 15.507 AS INT) >= 2 AS calibrated"


@query("V10_calibration_tests", f"SELECT * FROM (WITH {SCORES}, {CAL.format(k='CAST(NULL AS VARCHAR)')} SELECT {CAL_ROW} FROM c) UNION ALL SELECT * FROM (WITH {SCORES}, {CAL.format(k='segment')} SELECT {CAL_ROW} FROM c WHERE n >= 50)")
def v10(spark, sf_dir):
    """The whole and each segment of 50 rows; calibrated where two of three hold: Brier, ECE, Hosmer-Lemeshow at 5 %."""
    s = scores(spark, sf_dir)
    found = v.calibration_by(s.withColumn("segment", F.lit(None).cast("string")), "segment", "label", "p").unionByName(v.calibration_by(s, "segment", "label", "p").where("n >= 50"))
    good = (F.col("brier") < 0.25).cast("int") + (F.col("ece") < 0.05).cast("int") + (F.col("hosmer_lemeshow") < 15.507).cast("int") >= 2
    return both(found.withColumn("calibrated", good), ["segment", "n", "calibrated"], ["brier", "log_loss", "ece", "mce"], ["hosmer_lemeshow"], 5, 3)


RANKS = "k AS (SELECT id, segment, y, champion, challenger, row_number() OVER (ORDER BY champion, id) AS a, row_number() OVER (ORDER BY challenger, id) AS b, ntile(10) OVER (ORDER BY champion, id) AS decile FROM scores)"


def ranked(s):
    """Each row's places by the champion's and the challenger's score."""
    a = global_rank(s.select("id", "segment", "y", "champion", "challenger"), ["champion", "id"]).withColumnRenamed("rank", "a")
    b = global_rank(s.select("id", "challenger"), ["challenger", "id"]).select("id", F.col("rank").alias("b"))
    return a.join(b, "id")


def err(p: str) -> str:
    return f"avg(abs(y - {p}))"


V11 = f"""WITH {SCORES}, {RANKS}, d AS (SELECT decile, {err('champion')} AS a, {err('challenger')} AS b FROM k GROUP BY 1),
m AS (SELECT {err('champion')} AS ma, {err('challenger')} AS mb, sqrt(avg(power(y - champion, 2))) AS ra, sqrt(avg(power(y - challenger, 2))) AS rb, 1 - avg(power(y - champion, 2)) / var_pop(y) AS qa, 1 - avg(power(y - challenger, 2)) / var_pop(y) AS qb, corr(champion, challenger) AS c, corr(a, b) AS rc FROM k), w AS (SELECT count(*) FILTER (b > 1.1e0 * a) AS worse FROM d)
SELECT {r('ma', 'mae_champion')}, {r('mb', 'mae_challenger')}, {r('ra', 'rmse_champion')}, {r('rb', 'rmse_challenger')}, {r('qa', 'r2_champion', 6)}, {r('qb', 'r2_challenger', 6)}, {r('1 - mb / ma', 'improvement', 6)}, {r('c', 'correlation', 6)}, {r('rc', 'rank_correlation', 6)}, worse AS worse_deciles,
concat_ws('|', CASE WHEN 1 - mb / ma < 0.02e0 THEN 'improvement' END, CASE WHEN qb < qa THEN 'r2' END, CASE WHEN rc < 0.8e0 THEN 'order' END, CASE WHEN worse > 2 THEN 'deciles' END) AS blockers, 1 - mb / ma >= 0.02e0 AND qb >= qa AND rc >= 0.8e0 AND worse <= 2 AS promote FROM m, w"""


@query("V11_champion_challenger", V11)
def v11(spark, sf_dir):
    k = ranked(scores(spark, sf_dir))
    y, a, b = F.col("y"), F.col("champion"), F.col("challenger")
    m = k.agg(F.avg(F.abs(y - a)).alias("mae_champion"), F.avg(F.abs(y - b)).alias("mae_challenger"), F.sqrt(F.avg((y - a) ** 2)).alias("rmse_champion"), F.sqrt(F.avg((y - b) ** 2)).alias("rmse_challenger"), (1 - F.avg((y - a) ** 2) / F.var_pop(y)).alias("r2_champion"), (1 - F.avg((y - b) ** 2) / F.var_pop(y)).alias("r2_challenger"), F.corr(a, b).alias("correlation"), F.corr("a", "b").alias("rank_correlation"), F.count("*").alias("rows"))
    size = k.agg(F.count("*").alias("rows"))
    big, tenth = F.col("rows") % 10, F.floor(F.col("rows") / 10)
    place = F.when(F.col("a") <= big * (tenth + 1), F.ceil(F.col("a") / (tenth + 1))).otherwise(big + F.ceil((F.col("a") - big * (tenth + 1)) / F.greatest(tenth, F.lit(1))))
    d = k.crossJoin(F.broadcast(size)).groupBy(place.alias("decile")).agg(F.avg(F.abs(y - a)).alias("ea"), F.avg(F.abs(y - b)).alias("eb"))
    whole = m.crossJoin(d.agg(F.count_if(F.col("eb") > 1.1 * F.col("ea")).alias("worse_deciles"))).withColumn("improvement", 1 - F.col("mae_challenger") / F.col("mae_champion"))
    faults = {"improvement": F.col("improvement") < 0.02, "r2": F.col("r2_challenger") < F.col("r2_champion"), "order": F.col("rank_correlation") < 0.8, "deciles": F.col("worse_deciles") > 2}
    blockers = F.concat_ws("|", *[F.when(c, name) for name, c in faults.items()])
    return both(whole.withColumn("blockers", blockers).withColumn("promote", F.col("blockers") == ""), ["worse_deciles", "blockers", "promote"], ["mae_champion", "mae_challenger", "rmse_champion", "rmse_challenger"], ["r2_champion", "r2_challenger", "improvement", "correlation", "rank_correlation"], 4, 6)


V12 = f"""WITH {SCORES}, {RANKS}, s AS (SELECT segment, corr(champion, challenger) AS c FROM k GROUP BY 1), m AS (SELECT corr(champion, challenger) AS c, corr(a, b) AS rc, abs(avg(challenger) / avg(champion) - 1) AS shift, abs(quantile_cont(challenger, 0.9) / quantile_cont(champion, 0.9) - 1) AS p90 FROM k), l AS (SELECT min(c) AS low FROM s)
SELECT {r('c', 'correlation', 6)}, {r('rc', 'rank_correlation', 6)}, {r('low', 'least_segment_correlation', 6)}, {r('shift', 'mean_shift', 6)}, {r('p90', 'p90_shift', 6)}, {r('0.4e0 * c + 0.3e0 * rc + 0.3e0 * (1 - least(1e0, shift))', 'score', 6)}, 0.4e0 * c + 0.3e0 * rc + 0.3e0 * (1 - least(1e0, shift)) >= 0.9e0 AS stable FROM m, l"""


@query("V12_model_stability", V12)
def v12(spark, sf_dir):
    k = ranked(scores(spark, sf_dir))
    m = k.agg(F.corr("champion", "challenger").alias("correlation"), F.corr("a", "b").alias("rank_correlation"), F.abs(F.avg("challenger") / F.avg("champion") - 1).alias("mean_shift"), F.lit(1).alias("one"))
    top = quantiles(k, [], "challenger", [0.9]).select(F.col("q")[0].alias("b")).crossJoin(quantiles(k, [], "champion", [0.9]).select(F.col("q")[0].alias("a")))
    m = m.crossJoin(top.select(F.abs(F.col("b") / F.col("a") - 1).alias("p90_shift")))
    low = k.groupBy("segment").agg(F.corr("champion", "challenger").alias("c")).agg(F.min("c").alias("least_segment_correlation"))
    whole = m.crossJoin(low).withColumn("score", 0.4 * F.col("correlation") + 0.3 * F.col("rank_correlation") + 0.3 * (1 - F.least(F.lit(1.0), F.col("mean_shift"))))
    return both(whole.withColumn("stable", F.col("score") >= 0.9), ["stable"], [], ["correlation", "rank_correlation", "least_segment_correlation", "mean_shift", "p90_shift", "score"], other=6)


@query("V15_interval_validation", f"WITH {SCORES} SELECT {r('avg(abs(y - champion))', 'mae')}, {r('sqrt(avg(power(y - champion, 2)))', 'rmse')}, {r('avg(abs(y - champion) / y)', 'mape', 5)}, {r('avg(CAST(y BETWEEN champion * 0.85e0 AND champion * 1.15e0 AS INT))', 'coverage_80')}, {r('avg(CAST(y BETWEEN champion * 0.8e0 AND champion * 1.2e0 AS INT))', 'coverage_90')}, {r('median(champion * 0.3e0)', 'width_80')}, {r('median(champion * 0.4e0)', 'width_90')} FROM scores WHERE y > 0")
def v15(spark, sf_dir):
    y, p = F.col("y"), F.col("champion")
    inside = lambda w: F.avg(y.between(p * (1 - w), p * (1 + w)).cast("double"))
    rows = scores(spark, sf_dir).where("y > 0")
    g = rows.agg(F.avg(F.abs(y - p)).alias("mae"), F.sqrt(F.avg((y - p) ** 2)).alias("rmse"), F.avg(F.abs(y - p) / y).alias("mape"), inside(0.15).alias("coverage_80"), inside(0.2).alias("coverage_90"))
    middle = F.col("q")[0]
    g = g.crossJoin(quantiles(rows, [], p, [0.5]).select((middle * 0.3).alias("width_80"), (middle * 0.4).alias("width_90")))
    return both(g, [], ["mae", "rmse", "coverage_80", "coverage_90", "width_80", "width_90"], ["mape"], 4, 5)


FAIR = f"WITH {SCORES}, g AS (SELECT segment, count(*) AS n, avg(CAST(p >= 0.5 AS INT)) AS a, avg(CAST(p >= 0.5 AS INT)) FILTER (label = 1) AS t, avg(CAST(p >= 0.5 AS INT)) FILTER (label = 0) AS f FROM scores GROUP BY 1), z AS (SELECT * FROM g WHERE segment = '5-LOW')"


@query("V17_fairness_metrics", f"{FAIR} SELECT g.segment, {r('g.a - z.a', 'parity_gap')}, {r('g.t - z.t', 'opportunity_gap')}, {r('g.f - z.f', 'fpr_gap')}, {r('greatest(abs(g.t - z.t), abs(g.f - z.f))', 'odds_gap')}, abs(g.a - z.a) <= 0.1 AND greatest(abs(g.t - z.t), abs(g.f - z.f)) <= 0.1 AS fair FROM g, z")
def v17(spark, sf_dir):
    f = v.fairness(scores(spark, sf_dir), "segment", "5-LOW", F.col("p") >= 0.5, F.col("label") == 1)
    f = f.withColumn("odds_gap", F.greatest(F.abs("opportunity_gap"), F.abs("fpr_gap")))
    return rounded(f.withColumn("fair", (F.abs("parity_gap") <= 0.1) & (F.col("odds_gap") <= 0.1)), ["segment", "fair"], ["parity_gap", "opportunity_gap", "fpr_gap", "odds_gap"])


V25 = f"""WITH {SCORES}, g AS (SELECT count(*) FILTER (id % 2 = 1) AS n1, count(*) FILTER (id % 2 = 0) AS n0, avg(label) FILTER (id % 2 = 1) AS p1, avg(label) FILTER (id % 2 = 0) AS p0, avg(p) FILTER (id % 2 = 1) AS m1, avg(p) FILTER (id % 2 = 0) AS m0, var_samp(p) FILTER (id % 2 = 1) AS v1, var_samp(p) FILTER (id % 2 = 0) AS v0, avg(CAST((p >= 0.5) = (label = 1) AS INT)) FILTER (id % 2 = 1) AS a1, avg(CAST((p >= 0.5) = (label = 1) AS INT)) FILTER (id % 2 = 0) AS a0, avg(id * 19 % 200) FILTER (id % 2 = 1) AS l1, avg(id * 19 % 200) FILTER (id % 2 = 0) AS l0, quantile_cont(id * 19 % 200, 0.95) FILTER (id % 2 = 1) AS q1, quantile_cont(id * 19 % 200, 0.95) FILTER (id % 2 = 0) AS q0 FROM scores), q AS (SELECT *, (p1 * n1 + p0 * n0) / (n1 + n0) AS p FROM g)
SELECT {r('p1', 'rate_treated')}, {r('p0', 'rate_control')}, {r('(p1 - p0) / sqrt(p * (1 - p) * (1 / n1 + 1 / n0))', 'z')}, {r('p1 - p0 - 1.96e0 * sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)', 'low')}, {r('p1 - p0 + 1.96e0 * sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)', 'high')}, {r('(m1 - m0) / sqrt(v1 / n1 + v0 / n0)', 'welch_t')}, {r('a1', 'accuracy_treated')}, {r('a0', 'accuracy_control')}, {r('l1', 'latency_treated')}, {r('l0', 'latency_control')}, {r('q1', 'latency_p95_treated')}, {r('q0', 'latency_p95_control')} FROM q"""


@query("V25_ab_test", V25)
def v25(spark, sf_dir):
    s = scores(spark, sf_dir)
    arm = lambda k, x: F.when(F.col("id") % 2 == k, x)
    hit = ((F.col("p") >= 0.5) == (F.col("label") == 1)).cast("double")
    m = s.agg(((F.avg(arm(1, F.col("p"))) - F.avg(arm(0, F.col("p")))) / F.sqrt(F.var_samp(arm(1, F.col("p"))) / F.count(arm(1, F.col("p"))) + F.var_samp(arm(0, F.col("p"))) / F.count(arm(0, F.col("p"))))).alias("welch_t"), F.avg(arm(1, hit)).alias("accuracy_treated"), F.avg(arm(0, hit)).alias("accuracy_control"), F.count(arm(1, hit)).alias("n1"), F.count(arm(0, hit)).alias("n0"))
    t = v.two_proportions(s, F.col("id") % 2 == 1, F.col("label") == 1).select("rate_treated", "rate_control", "z").crossJoin(m)
    p1, p0 = F.col("rate_treated"), F.col("rate_control")
    spread = 1.96 * F.sqrt(p1 * (1 - p1) / F.col("n1") + p0 * (1 - p0) / F.col("n0"))
    latency = s.select((F.col("id") % 2).alias("arm"), (F.col("id") * 19 % 200).alias("ms"))
    tails = with_quantiles(latency.groupBy("arm").agg(F.avg("ms").alias("mean")), latency, ["arm"], "ms", [0.95])
    each = lambda k, c: F.max(F.when(F.col("arm") == k, c))
    slow = tails.agg(*[each(k, c).alias(f"latency_{m}{name}") for k, name in ((1, "treated"), (0, "control")) for m, c in (("", F.col("mean")), ("p95_", F.col("q")[0]))])
    whole = t.withColumns({"low": p1 - p0 - spread, "high": p1 - p0 + spread}).crossJoin(slow)
    return rounded(whole, [], ["rate_treated", "rate_control", "z", "low", "high", "welch_t", "accuracy_treated", "accuracy_control", "latency_treated", "latency_control", "latency_p95_treated", "latency_p95_control"])


@query("V26b_parallel_trends", f"WITH {SCORES} SELECT year(day) AS year, grp = 'F' AS treated, count(*) AS n, {r('avg(y)', 'mean')} FROM scores WHERE day < DATE '1998-01-01' GROUP BY 1, 2")
def v26b(spark, sf_dir):
    g = scores(spark, sf_dir).where("day < '1998-01-01'").groupBy(F.year("day").cast("long").alias("year"), (F.col("grp") == "F").alias("treated")).agg(F.count("*").alias("n"), F.avg("y").alias("mean"))
    return rounded(g, ["year", "treated", "n"], ["mean"])


V29 = f"""WITH {SCORES}, s(pct, pos) AS (VALUES (5, 1), (10, 2), (25, 3)), m AS (SELECT {err('champion')} AS a, {err('challenger')} AS b, corr(champion, challenger) AS c, count(*) AS n FROM scores), g AS (SELECT (SELECT pct FROM s ORDER BY pos DESC LIMIT 1) AS pct, b > 1.1e0 * a AS worse, c < 0.8e0 AS loose, n < 100 AS few FROM m)
SELECT pct AS before, CASE WHEN worse THEN 'rollback' WHEN loose OR few THEN 'hold' ELSE 'advance' END AS step, CASE WHEN worse THEN 0 WHEN loose OR few THEN pct ELSE 50 END AS percentage, concat_ws('|', CASE WHEN worse THEN 'error' END, CASE WHEN loose THEN 'stability' END, CASE WHEN few THEN 'rows' END) AS failed_gates, 50 < 50 AS needs_approval FROM g"""


@query("V29_rollout_step", V29)
def v29(spark, sf_dir):
    """From the newest row of the state table; steps are 5, 10, 25, 50, 100 %, and those above 50 % need an approval."""
    y, state = F.col("y"), spark.createDataFrame([(5, 1), (10, 2), (25, 3)], "pct int, at int")
    now = state.agg(F.max_by("pct", "at").alias("before"))
    m = scores(spark, sf_dir).agg(F.avg(F.abs(y - F.col("champion"))).alias("a"), F.avg(F.abs(y - F.col("challenger"))).alias("b"), F.corr("champion", "challenger").alias("c"), F.count("*").alias("n")).crossJoin(now)
    worse, loose, few = F.col("b") > 1.1 * F.col("a"), F.col("c") < 0.8, F.col("n") < 100
    following = F.element_at(F.filter(F.array(*map(F.lit, (5, 10, 25, 50, 100))), lambda p: p > F.col("before")), 1)
    gates = F.concat_ws("|", F.when(worse, "error"), F.when(loose, "stability"), F.when(few, "rows"))
    return m.select("before", F.when(worse, "rollback").when(loose | few, "hold").otherwise("advance").alias("step"), F.when(worse, 0).when(loose | few, F.col("before")).otherwise(following).alias("percentage"), gates.alias("failed_gates"), (F.when(worse | loose | few, F.lit(0)).otherwise(following) > 50).alias("needs_approval"))


V30 = f"""WITH {PSI}, da AS (SELECT count(*) FILTER (psi >= 0.25) AS drifted, max(psi) AS worst FROM psi), db AS (SELECT abs(avg(l_extendedprice) FILTER ({NEW}) / avg(l_extendedprice) FILTER ({OLD}) - 1) AS shift, avg(CAST(l_quantity IS NULL AS INT)) FILTER ({NEW}) AS gone FROM lineitem),
{SCORES}, de AS (SELECT avg(abs(y - champion)) FILTER (day >= DATE '1998-01-01') / avg(abs(y - champion)) FILTER (day < DATE '1998-01-01') - 1 AS worse FROM scores)
SELECT drifted, {r('worst', 'worst_psi')}, {r('shift', 'prediction_shift', 5)}, {r('gone', 'null_rate', 5)}, {r('worse', 'error_growth', 5)}, concat_ws('|', CASE WHEN drifted > 0 THEN 'psi' END, CASE WHEN shift > 0.1e0 THEN 'prediction' END, CASE WHEN gone > 0.1e0 THEN 'nulls' END, CASE WHEN worse > 0.15e0 THEN 'error' END) AS alarms, CASE WHEN drifted > 0 OR shift > 0.1e0 OR gone > 0.1e0 OR worse > 0.15e0 THEN 'alert' ELSE 'ok' END AS status FROM da, db, de"""


@query("V30_daily_monitor", V30)
def v30(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    a = v.psi(old, new, LINES).agg(F.count_if(F.col("psi") >= 0.25).alias("drifted"), F.max("psi").alias("worst_psi"))
    b = old.agg(F.avg("l_extendedprice").alias("p0")).crossJoin(new.agg(F.avg("l_extendedprice").alias("p1"), F.avg(F.col("l_quantity").isNull().cast("double")).alias("null_rate")))
    e, recent = F.abs(F.col("y") - F.col("champion")), F.col("day") >= F.lit("1998-01-01").cast("date")
    c = scores(spark, sf_dir).agg((F.avg(F.when(recent, e)) / F.avg(F.when(~recent, e)) - 1).alias("error_growth"))
    whole = a.crossJoin(b).crossJoin(c).withColumn("prediction_shift", F.abs(F.col("p1") / F.col("p0") - 1))
    limits = {"psi": F.col("drifted") > 0, "prediction": F.col("prediction_shift") > 0.1, "nulls": F.col("null_rate") > 0.1, "error": F.col("error_growth") > 0.15}
    whole = whole.withColumn("alarms", F.concat_ws("|", *[F.when(x, n) for n, x in limits.items()]))
    return both(whole.withColumn("status", F.when(F.col("alarms") == "", "ok").otherwise("alert")), ["drifted", "alarms", "status"], ["worst_psi"], ["prediction_shift", "null_rate", "error_growth"], 4, 5)


TRENDS = {"predictions": "count(*)", "mean prediction": "avg(p)", "alerts": "count(*) FILTER (p >= 0.9)", "error": "avg(abs(y - champion))", "quality": "avg(CAST(y > 0 AS INT))"}


@query("V31_dashboards", f"WITH {SCORES} " + " UNION ALL ".join(f"SELECT day, '{n}' AS trend, {r(f'CAST({e} AS DOUBLE)', 'value')} FROM scores GROUP BY 1" for n, e in TRENDS.items()))
def v31(spark, sf_dir):
    """Five daily trends in one long frame, from one aggregation."""
    g = scores(spark, sf_dir).groupBy("day").agg(F.count("*").cast("double").alias("predictions"), F.avg("p").alias("mean prediction"), F.count_if(F.col("p") >= 0.9).cast("double").alias("alerts"), F.avg(F.abs(F.col("y") - F.col("champion"))).alias("error"), F.avg((F.col("y") > 0).cast("double")).alias("quality"))
    pairs = F.array(*[F.struct(F.lit(n).alias("trend"), F.col(n).alias("value")) for n in TRENDS])
    return rounded(g.select("day", F.explode(pairs).alias("t")).select("day", "t.*"), ["day", "trend"], ["value"])


BACK = "count(*) AS n, {a}, {b}, {c}, {d}".format(a=r("sum(CASE WHEN p >= 0.5 THEN y ELSE 0 END)", "recovered", 1), b=r("2.5e0 * count(*) FILTER (p >= 0.5)", "cost", 1), c=r("sum(CASE WHEN p >= 0.5 THEN y ELSE 0 END) / (2.5e0 * count(*) FILTER (p >= 0.5)) - 1", "roi", 3), d=r("avg(CAST((p >= 0.5) = (label = 1) AS INT))", "hit_rate", 3))


@query("V36_policy_backtest", f"WITH {SCORES} SELECT segment, {BACK} FROM scores GROUP BY 1 UNION ALL SELECT 'all', {BACK} FROM scores")
def v36(spark, sf_dir):
    chosen, s = F.col("p") >= 0.5, scores(spark, sf_dir)
    g = union([x.groupBy("segment").agg(F.count("*").alias("n"), F.sum(F.when(chosen, F.col("y")).otherwise(0.0)).alias("recovered"), (2.5 * F.count_if(chosen)).alias("cost"), F.avg((chosen == (F.col("label") == 1)).cast("double")).alias("hit_rate")) for x in (s, s.withColumn("segment", F.lit("all")))])
    return both(g.withColumn("roi", F.col("recovered") / F.col("cost") - 1), ["segment", "n"], ["recovered", "cost"], ["roi", "hit_rate"], 1, 3)
