"""Queries of stability, leaks, triggers, votes, treatments and channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions.scalar import bucket_100
from tallgrass.operators import joins as j
from tallgrass.operators import stability as t
from tallgrass.operators import statistics as v
from tallgrass.operators.rules import first_match
from tallgrass.operators.windows import rounded, rounded_by
from tallgrass.sources.scratch import settle
from tallgrass.sources.tables import ACCOUNTS, EDGES, SCORES, TXN, accounts, edges, scores, table, txn

from .joins import J12
from .registry import query
from .rules import CASE, SEGMENTS
from .statistics import LINES, OLD, halves
from .windows import r

CUTS = "list_distinct(quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) FILTER (side = 0))"
LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, CASE WHEN {OLD} THEN 0 ELSE 1 END AS side, l_returnflag AS segment, CAST(year(l_shipdate) AS VARCHAR) AS period FROM lineitem" for c in LINES)
V2 = f"""WITH l AS ({LONG}), e AS (SELECT feature, {CUTS} AS edges FROM l GROUP BY 1), b AS (SELECT l.*, len(list_filter(edges, lambda x: x < value)) AS bin FROM l JOIN e USING (feature)),
parts AS (SELECT 'all' AS part, '' AS key, feature, bin, side FROM b UNION ALL SELECT 'segment', segment, feature, bin, side FROM b UNION ALL SELECT 'period', period, feature, bin, side FROM b WHERE side = 1
  UNION ALL SELECT 'period', p.period, feature, bin, side FROM b, (SELECT DISTINCT period FROM b WHERE side = 1) p WHERE side = 0),
c AS (SELECT part, key, feature, bin, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM parts GROUP BY 1, 2, 3, 4),
s AS (SELECT part, key, feature, CASE WHEN sum(a) OVER w > 0 THEN greatest(1e-4, a / sum(a) OVER w) ELSE 1e-4 END AS p, CASE WHEN sum(b) OVER w > 0 THEN greatest(1e-4, b / sum(b) OVER w) ELSE 1e-4 END AS q FROM c WINDOW w AS (PARTITION BY part, key, feature)),
psi AS (SELECT part, key, feature, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1, 2, 3) SELECT part, key, feature, {r('psi', 'psi')}, CASE WHEN psi < 0.1 THEN 'green' WHEN psi < 0.25 THEN 'amber' ELSE 'red' END AS light FROM psi"""


@query("V2_psi_smoothed", V2)
def v2(spark, sf_dir):
    old, new = (x.withColumns({"segment": F.col("l_returnflag"), "period": F.year("l_shipdate").cast("string")}) for x in halves(spark, sf_dir))
    return rounded(t.psi_parts(old, new, LINES, "segment", "period"), ["part", "key", "feature", "light"], ["psi"])


def half_width_sql(residual: str) -> str:
    return f"e AS (SELECT {residual} AS e, row_number() OVER (ORDER BY {residual}) - 1 AS i FROM scores WHERE id % 2 = 0), q AS (SELECT least(1e0, ceil((n + 1) * 0.9e0) / n) * (n - 1) AS k FROM n), w AS (SELECT max(e) FILTER (i = floor(k)) + (k - floor(k)) * (max(e) FILTER (i = ceil(k)) - max(e) FILTER (i = floor(k))) AS w FROM e, q GROUP BY k)"


def conformal_sql(kind: str, residual: str, half: str) -> str:
    return f"SELECT * FROM (WITH n AS (SELECT count(*) AS n FROM scores WHERE id % 2 = 0), {half_width_sql(residual)} SELECT '{kind}' AS kind, {r('w', 'half_width')}, {r(f'avg(CAST(y BETWEEN greatest(0, champion - {half}) AND champion + {half} AS INT))', 'coverage')}, {r(f'avg(champion + {half} - greatest(0, champion - {half}))', 'mean_width', 3)} FROM scores, w WHERE id % 2 = 1 GROUP BY w)"


@query("V14_conformal", f"WITH {SCORES} {conformal_sql('absolute', 'abs(y - champion)', 'w')} UNION ALL {conformal_sql('relative', 'abs(y - champion) / champion', 'w * champion')}")
def v14(spark, sf_dir):
    s = scores(spark, sf_dir)
    parts = [v.conformal(s.where("id % 2 = 0"), s.where("id % 2 = 1"), "y", "champion", relative=k).withColumn("kind", F.lit(n)) for n, k in (("absolute", False), ("relative", True))]
    return rounded_by(parts[0].unionByName(parts[1]), ["kind"], {"half_width": 4, "coverage": 4, "mean_width": 3})


NUMBERS, KINDS = ["champion", "challenger", "p"], ["segment", "grp", "echo"]
CASES = f"{SCORES}, cases AS (SELECT id, y, champion, CASE WHEN day < DATE '1997-01-01' OR id % 3 <> 0 THEN challenger END AS challenger, p, segment, grp, CASE WHEN y > 150 THEN 'high' ELSE 'low' END AS band, CASE WHEN id % 50 = 0 THEN 'odd' WHEN y > 150 THEN 'a' ELSE 'b' END AS echo, day >= DATE '1997-01-01' AS test FROM scores)"


def cramer_sql(c: str) -> str:
    return f"""SELECT 'association' AS kind, '{c}' AS feature, v AS value, v > 0.85 AS leak FROM (SELECT sqrt((sum(n * n / (rn * cn)) - 1) / (least(count(DISTINCT {c}), count(DISTINCT band)) - 1)) AS v
FROM (SELECT {c}, band, CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER (PARTITION BY {c}) AS DOUBLE) AS rn, CAST(sum(count(*)) OVER (PARTITION BY band) AS DOUBLE) AS cn FROM cases GROUP BY 1, 2))"""


V18 = f"WITH {CASES}, x AS (" + " UNION ALL ".join([
    *(f"SELECT 'correlation' AS kind, '{c}' AS feature, corr({c}, y) AS value, abs(corr({c}, y)) > 0.9 AS leak FROM cases" for c in NUMBERS),
    *(f"SELECT 'missing', '{c}', avg(CAST({c} IS NULL AS INT)) FILTER (test) - avg(CAST({c} IS NULL AS INT)) FILTER (NOT test), abs(avg(CAST({c} IS NULL AS INT)) FILTER (test) - avg(CAST({c} IS NULL AS INT)) FILTER (NOT test)) > 0.1 FROM cases" for c in NUMBERS + KINDS),
    *map(cramer_sql, KINDS),
]) + f") SELECT kind, feature, {r('value', 'value')}, leak FROM x"


@query("V18_target_leakage", V18)
def v18(spark, sf_dir):
    late = F.col("day") >= F.lit("1997-01-01").cast("date")
    high = F.col("y") > 150
    df = scores(spark, sf_dir).withColumns({"challenger": F.when(~late | (F.col("id") % 3 != 0), F.col("challenger")), "band": F.when(high, "high").otherwise("low"), "echo": F.when(F.col("id") % 50 == 0, "odd").when(high, "a").otherwise("b")})
    return rounded(t.target_leaks(df, "y", "band", NUMBERS, KINDS, late), ["kind", "feature", "leak"], ["value"])


G31 = f"""WITH {TXN}, d AS (SELECT entity_id, day, sum(value) AS v, arg_max(category, (value, event_id)) AS s FROM txn GROUP BY 1, 2),
i AS (SELECT *, CAST(row_number() OVER w - 1 AS DOUBLE) AS i, day - lag(day) OVER w AS g, CASE WHEN lag(s) OVER w IS NULL OR s <> lag(s) OVER w THEN 1 ELSE 0 END AS c FROM d WINDOW w AS (PARTITION BY entity_id ORDER BY day)),
g AS (SELECT entity_id, count(*) AS n, avg(v) AS m, stddev_pop(v) AS sd, stddev_samp(v) AS ss, (max(v) - min(v)) / median(v) AS rg, regr_slope(v, i) AS slope, regr_intercept(v, i) AS ic, coalesce(regr_r2(v, i), 0) AS r2, stddev_samp(g) AS gs, avg(g) AS gm, sum(c) AS ch FROM i GROUP BY 1 HAVING count(*) >= 6),
x AS (SELECT *, CASE WHEN r2 < 1 THEN sign(slope) * sqrt(r2 * (n - 2) / (1 - r2)) END AS t, 0.6e0 * CASE WHEN gm > 0 THEN least(1e0, gs / gm) ELSE 1 END + 0.4e0 * CASE WHEN m > 0 THEN least(1e0, ss / m) ELSE 1 END AS ir, 1 - least(1e0, ch / n) AS em FROM g),
y AS (SELECT *, greatest(0e0, least(1e0, 0.35e0 * (1 - least(1e0, sd / m / 0.5e0)) + 0.25e0 * r2 + 0.25e0 * (1 - ir) + 0.15e0 * em)) AS ov, coalesce(abs(t) > 2, false) AND abs(slope) >= 0.01e0 * m AS clear FROM x)
SELECT entity_id, n, CASE WHEN clear AND slope > 0 THEN 'increasing' WHEN clear THEN 'decreasing' ELSE 'stable' END AS direction, ov >= 0.6 AS stable, {r('sd / m', 'cv')}, {r('sd', 'std', 3)}, {r('rg', 'range_share')}, {r('slope', 'slope', 3)}, {r('r2', 'r2')}, {r('t', 't', 3)}, {r('ir', 'irregularity')}, {r('em', 'employment')}, {r('ov', 'overall')},
{", ".join(r(f'greatest(0, ic + slope * (n - 1 + {k}))', f'forecast_{k}', 2) for k in (3, 6, 12))} FROM y"""


@query("G31_income_stability", G31)
def g31(spark, sf_dir):
    """Daily sums of an entity, with the kind of its largest event as source."""
    daily = txn(spark, sf_dir).groupBy("entity_id", "day").agg(F.sum("value").alias("v"), F.max_by("category", F.struct("value", "event_id")).alias("s"))
    found = t.stability_scores(daily, "entity_id", ["day"], "day", "v", "s")
    return rounded_by(found, ["entity_id", "n", "direction", "stable"], {"cv": 4, "std": 3, "range_share": 4, "slope": 3, "r2": 4, "t": 3, "irregularity": 4, "employment": 4, "overall": 4, "forecast_3": 2, "forecast_6": 2, "forecast_12": 2})


STATES = ["signup", "purchase", "error", "view", "click", "closed"]
G36 = f"""WITH {TXN}, s AS (SELECT entity_id, entity_id % 3 AS segment, ts, event_id, CASE WHEN row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) = 1 THEN 'closed' ELSE category END AS st FROM txn),
p AS (SELECT segment, st AS f, lead(st) OVER (PARTITION BY entity_id ORDER BY ts, event_id) AS t FROM s), c AS (SELECT segment, f, t, count(*) AS n FROM p WHERE t IS NOT NULL GROUP BY 1, 2, 3),
k AS (SELECT segment, f, t FROM (SELECT DISTINCT segment FROM s), (SELECT unnest({STATES}) AS f), (SELECT unnest({STATES}) AS t)), j AS (SELECT k.*, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY segment, f) AS left_ FROM k LEFT JOIN c USING (segment, f, t))
SELECT segment, f AS from_state, t AS to_state, n, {r('CASE WHEN left_ = 0 THEN CAST(f = t AS INT) ELSE (n + 0.5e0) / (left_ + 3) END', 'probability')} FROM j"""


@query("G36_transition_matrix", G36)
def g36(spark, sf_dir):
    """Kinds of events by a third of the entities; the last event of an entity closes it."""
    from pyspark.sql import Window

    last = F.row_number().over(Window.partitionBy("entity_id").orderBy(F.desc("ts"), F.desc("event_id"))) == 1
    rows = txn(spark, sf_dir).withColumns({"segment": F.col("entity_id") % 3, "state": F.when(last, "closed").otherwise(F.col("category"))})
    return rounded(t.transition_matrices(rows, "entity_id", ["ts", "event_id"], "state", STATES, 0.5, "segment"), ["segment", "from_state", "to_state", "n"], ["probability"])


G35 = f"""WITH {EDGES}, sec AS (SELECT 's' || s_suppkey AS id, n_regionkey AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 'c' || c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
l AS (SELECT DISTINCT src, dst FROM edges), d AS (SELECT src, count(*) AS n FROM l GROUP BY 1), p AS (SELECT a.src, b.src AS peer, count(*) AS common FROM l a JOIN l b ON a.dst = b.dst AND a.src <> b.src GROUP BY 1, 2),
s AS (SELECT p.src, peer, common / (d.n + e.n - common) AS similarity FROM p JOIN d ON p.src = d.src JOIN d e ON p.peer = e.src), k AS (SELECT * FROM s WHERE similarity >= 0.4e0 QUALIFY row_number() OVER (PARTITION BY src ORDER BY similarity DESC, peer) <= 5),
v AS (SELECT src, sector, 0.5e0 AS v FROM l JOIN sec ON sec.id = l.dst UNION ALL SELECT src, sector, 0.3e0 * similarity FROM k JOIN sec ON sec.id = k.peer), g AS (SELECT src, sector, sum(v) AS v FROM v GROUP BY 1, 2)
SELECT src, sector, {r('v / sum(v) OVER (PARTITION BY src)', 'share')} FROM g"""


@query("G35_sector_vote", G35)
def g35(spark, sf_dir):
    """A node's sector is its nation's region."""
    region = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("sector"))
    named = lambda name, key, nation, mark: table(spark, sf_dir, name).join(region, F.col(nation) == F.col("n_nationkey")).select(F.concat(F.lit(mark), key).alias("id"), "sector")
    sectors = named("supplier", "s_suppkey", "s_nationkey", "s").unionByName(named("customer", "c_custkey", "c_nationkey", "c"))
    whole = settle(edges(spark, sf_dir).select("src", "dst"), "sector-edges")
    return rounded(t.sector_votes(whole, j.peers(whole, 0.4, 5).select("src", "peer", "similarity"), sectors), ["src", "sector"], ["share"])


LEVEL = "CASE WHEN abs(p - 0.5) >= 0.3 THEN 'high' WHEN abs(p - 0.5) >= 0.15 THEN 'medium' ELSE 'low' END"
KPI = f"count(*) AS n, {r('sqrt(avg(power(y - champion, 2)))', 'rmse')}, {r('avg(abs(y - champion))', 'mae')}, {r('1 - sum(power(y - champion, 2)) / (var_pop(y) * count(*))', 'r2')}, {r('sum(y) FILTER (champion >= (SELECT quantile_cont(champion, 0.8) FROM scores))', 'top_value', 1)}"


@query("G53_report_kpis", f"WITH {SCORES} SELECT 'all' AS part, {KPI} FROM scores UNION ALL SELECT {LEVEL}, {KPI} FROM scores GROUP BY 1")
def g53(spark, sf_dir):
    s = scores(spark, sf_dir).withColumn("level", F.expr(LEVEL))
    return rounded_by(t.report_kpis(s, "y", "champion", "level"), ["part", "n"], {"rmse": 4, "mae": 4, "r2": 4, "top_value": 1})


@query("G53b_daily_volume", f"WITH {SCORES} SELECT day, count(*) AS n, {r('sum(y)', 'value', 2)}, {r('avg(p)', 'mean_p')} FROM scores GROUP BY 1")
def g53b(spark, sf_dir):
    g = scores(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n"), F.sum("y").alias("value"), F.avg("p").alias("mean_p"))
    return rounded_by(g, ["day", "n"], {"value": 2, "mean_p": 4})


@query("J12b_paired_effect", f"WITH m AS ({J12.replace('WITH ', 'WITH ', 1)}), g AS (SELECT count(*) AS pairs, avg(difference) AS e, stddev_samp(difference) / sqrt(count(*)) AS se FROM m) SELECT pairs, {r('e', 'effect', 3)}, {r('se', 'se', 3)}, {r('e / se', 't', 3)}, {r('e - 1.96 * se', 'low', 3)}, {r('e + 1.96 * se', 'high', 3)}, e - 1.96 * se > 0 OR e + 1.96 * se < 0 AS significant FROM g")
def j12b(spark, sf_dir):
    found = j.match_nearest(scores(spark, sf_dir), F.col("segment") == "1-URGENT", "p", "y", "id", 0.05)
    return rounded(t.paired_effect(found, "difference"), ["pairs", "significant"], ["effect", "se", "t", "low", "high"], 3)


PLANS = {"strategic": "retain", "hardship": "restructure", "lost": "sell", "small": "remind", "strategic_1": "reward", "lost_0": "write off", "unclassified_2": "survey"}
CLUSTER = "CASE WHEN age < 35 THEN 0 WHEN age < 55 THEN 1 ELSE 2 END"
LOOKUP = "MAP {" + ", ".join(f"'{k}': '{x}'" for k, x in PLANS.items()) + "}"


@query("P2_segment_strategy", f"WITH {ACCOUNTS}, s AS (SELECT account_id, {CASE} AS rule, {CLUSTER} AS cluster FROM accounts) SELECT account_id, rule || '_' || cluster AS persona, coalesce({LOOKUP}[rule || '_' || cluster], {LOOKUP}[rule], 'standard') AS strategy FROM s")
def p2(spark, sf_dir):
    """Rules and clusters make personas; the clusters are bands of age here, so that SQL can state them (M4 finds them)."""
    df = accounts(spark, sf_dir).select("account_id", first_match(SEGMENTS, "unclassified").alias("rule"), F.expr(CLUSTER).alias("cluster"))
    return t.segment_strategy(df, "rule", "cluster", PLANS, "standard").select("account_id", "persona", "strategy")


AUC = "(sum(k) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0))"
SPLIT = f"{SCORES}, sides AS (SELECT *, CASE WHEN day < DATE '1997-01-01' THEN 0 ELSE 1 END AS side FROM scores)"
P21 = f"""WITH {SPLIT}, rk AS (SELECT label, side, avg(i) OVER (PARTITION BY side, p) AS k FROM (SELECT label, side, p, row_number() OVER (PARTITION BY side ORDER BY p) AS i FROM sides)),
auc AS (SELECT (SELECT {AUC} FROM rk WHERE side = 0) AS a, (SELECT {AUC} FROM rk WHERE side = 1) AS b),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, side FROM sides" for c in ("y", "p", "champion"))}), e AS (SELECT feature, {CUTS} AS edges FROM l GROUP BY 1),
bn AS (SELECT l.feature, len(list_filter(edges, lambda x: x < value)) AS bin, side FROM l JOIN e USING (feature)), c AS (SELECT feature, bin, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM bn GROUP BY 1, 2),
s AS (SELECT feature, greatest(1e-4, a / sum(a) OVER (PARTITION BY feature)) AS p, greatest(1e-4, b / sum(b) OVER (PARTITION BY feature)) AS q FROM c), psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1),
d AS (SELECT max(psi) AS d, CAST(count(*) FILTER (psi >= 0.25) AS DOUBLE) AS k FROM psi),
x AS (SELECT 'low auc' AS trigger, b AS value, 0.7e0 AS bound, b < 0.7 AS fired FROM auc UNION ALL SELECT 'auc drop', a - b, 0.02e0, a - b > 0.02 FROM auc UNION ALL SELECT 'drifted features', k, 1e0, k >= 1 FROM d UNION ALL SELECT 'largest drift', d, 0.25e0, d >= 0.25 FROM d)
SELECT trigger, {r('value', 'value')}, bound, fired FROM x"""


@query("P21_retrain_triggers", P21)
def p21(spark, sf_dir):
    s = scores(spark, sf_dir)
    old = F.col("day") < F.lit("1997-01-01").cast("date")
    drift = v.psi(s.where(old), s.where(~old), ["y", "p", "champion"])
    return rounded(t.retrain_triggers(s.where(old), s.where(~old), "label", "p", drift), ["trigger", "bound", "fired"], ["value"])


OFFERS = {"call": ("propensity", 25.0), "sms": ("p_sms", 1.0), "letter": ("p_letter", 5.0), "legal": ("p_legal", 200.0)}
CHANCES = {"p_sms": "propensity * 0.7e0", "p_letter": "propensity * 0.5e0", "p_legal": "0.3e0 + propensity * 0.6e0"}
BUCKET = "((CAST(('0x' || substr(md5('t4' || account_id), 1, 16)) AS UBIGINT) % 100) * 16 + CAST(('0x' || substr(md5('t4' || account_id), 17, 16)) AS UBIGINT) % 100) % 100"
T4 = f"""WITH {ACCOUNTS}, x AS (SELECT account_id, balance, age, days_past_due, propensity, {", ".join(f"{e} AS {n}" for n, e in CHANCES.items())}, {BUCKET} < 10 AS exploring FROM accounts),
v AS ({" UNION ALL ".join(f"SELECT account_id, exploring, '{n}' AS action, {c} * balance - {cost}e0 AS value FROM x" + (" WHERE NOT (age < 21 OR days_past_due < 90)" if n == "legal" else "") for n, (c, cost) in OFFERS.items())}),
k AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY value DESC, action) AS k FROM v) SELECT account_id, action, {r('value', 'value', 2)}, exploring AS explored FROM k WHERE k = CASE WHEN exploring THEN 2 ELSE 1 END"""


@query("T4_treatment_value", T4)
def t4(spark, sf_dir):
    """Legal steps are closed to the young and to the not long overdue; a tenth of the accounts explores."""
    df = accounts(spark, sf_dir).withColumns({n: F.expr(e) for n, e in CHANCES.items()})
    blocked = {"legal": (F.col("age") < 21) | (F.col("days_past_due") < 90)}
    found = t.treatment_values(df, "account_id", OFFERS, "balance", blocked, bucket_100(F.col("account_id"), "t4") < 10)
    return rounded(found, ["account_id", "action", "explored"], ["value"], 2)


ROOM = {"view": 500, "click": 10**9}
T5 = f"""WITH {TXN}, u AS (SELECT category, CASE WHEN category = 'view' AND count(*) > 500 THEN 0.5e0 ELSE 1 END AS load FROM txn GROUP BY 1), x AS (SELECT entity_id, category, hour(ts) AS h, dayofweek(ts) + 1 AS d, value * CASE WHEN hour(ts) BETWEEN 8 AND 19 THEN 1 ELSE 0.7e0 END * load AS v FROM txn JOIN u USING (category)),
c AS (SELECT entity_id, category, sum(v) AS v FROM x GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY round(sum(v), 9) DESC, category) = 1),
h AS (SELECT entity_id, category, h FROM x GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY entity_id, category ORDER BY round(sum(v), 9) DESC, h) = 1), d AS (SELECT entity_id, category, d FROM x GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY entity_id, category ORDER BY round(sum(v), 9) DESC, d) = 1)
SELECT entity_id, category AS channel, h AS best_hour, d AS best_day, {r('v', 'value', 2)} FROM c JOIN h USING (entity_id, category) JOIN d USING (entity_id, category)"""


@query("T5_channel_recommend", T5)
def t5(spark, sf_dir):
    found = t.channel_values(txn(spark, sf_dir).withColumnRenamed("category", "channel"), "entity_id", "channel", "ts", "value", ROOM)
    return rounded(found, ["entity_id", "channel", "best_hour", "best_day"], ["value"], 2)
