"""Queries of drift, calibration, fairness, ranking and comparison statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import statistics as v
from tallgrass.operators.aggregates import trend
from tallgrass.operators.quantiles import with_quantiles
from tallgrass.operators.windows import rounded
from tallgrass.sources.tables import SCORES, scores, table

from .registry import query
from .windows import r

LINES = ["l_quantity", "l_extendedprice", "l_discount"]
OLD, NEW = "l_shipdate < TIMESTAMP '1998-01-01'", "l_shipdate >= TIMESTAMP '1998-01-01'"


def halves(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    return df.where(cut), df.where(~cut)


LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, CASE WHEN {OLD} THEN 0 ELSE 1 END AS side FROM lineitem" for c in LINES)
PSI = f"""l AS ({LONG}), e AS (SELECT feature, list_distinct(quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) FILTER (side = 0)) AS edges FROM l GROUP BY 1),
b AS (SELECT l.feature, len(list_filter(edges, lambda x: x < value)) AS bin, side FROM l JOIN e USING (feature)), c AS (SELECT feature, bin, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM b GROUP BY 1, 2),
s AS (SELECT feature, greatest(1e-4, a / sum(a) OVER (PARTITION BY feature)) AS p, greatest(1e-4, b / sum(b) OVER (PARTITION BY feature)) AS q FROM c), psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1)"""


@query("V1_psi", f"WITH {PSI} SELECT feature, {r('psi', 'psi')}, psi >= 0.25 AS drift FROM psi")
def v1(spark, sf_dir):
    return rounded(v.psi(*halves(spark, sf_dir), LINES), ["feature", "drift"], ["psi"])


@query("V3_csi_categorical", f"WITH c AS (SELECT l_returnflag AS k, count(*) FILTER ({OLD}) AS a, count(*) FILTER ({NEW}) AS b FROM lineitem GROUP BY 1), s AS (SELECT greatest(1e-4, a / sum(a) OVER ()) AS p, greatest(1e-4, b / sum(b) OVER ()) AS q FROM c) SELECT {r('sum((q - p) * ln(q / p))', 'csi', 6)} FROM s")
def v3(spark, sf_dir):
    return rounded(v.csi(*halves(spark, sf_dir), "l_returnflag"), [], ["csi"], 6)


STATS = {"mean": "avg(l_extendedprice)", "std": "stddev_samp(l_extendedprice)", "p10": "quantile_cont(l_extendedprice, 0.1)", "p50": "quantile_cont(l_extendedprice, 0.5)", "p90": "quantile_cont(l_extendedprice, 0.9)"}


@query("V4_prediction_drift", " UNION ALL ".join(f"SELECT '{n}' AS statistic, {r(f'{s} FILTER ({NEW}) / {s} FILTER ({OLD}) - 1', 'change', 5)}, abs({s} FILTER ({NEW}) / {s} FILTER ({OLD}) - 1) > 0.1 AS drift FROM lineitem" for n, s in STATS.items()))
def v4(spark, sf_dir):
    return rounded(v.shift(*halves(spark, sf_dir), "l_extendedprice"), ["statistic", "drift"], ["change"], 5)


@query("V5_ks_two_sample", f"WITH s AS (SELECT l_extendedprice AS x, count(*) FILTER ({OLD}) AS a, count(*) FILTER ({NEW}) AS b FROM lineitem GROUP BY 1), u AS (SELECT sum(a) OVER (ORDER BY x) / sum(a) OVER () AS fa, sum(b) OVER (ORDER BY x) / sum(b) OVER () AS fb FROM s) SELECT {r('max(abs(fa - fb))', 'ks', 6)} FROM u")
def v5(spark, sf_dir):
    return rounded(v.ks_two_sample(*halves(spark, sf_dir), "l_extendedprice"), [], ["ks"], 6)


CHI = "c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY 1, 2), e AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e, sum(n) OVER () AS t FROM c)"


def metrics_sql(p: str, by: str = "") -> str:
    return f"{by + ', ' if by else ''}count(*) AS n, {r(f'avg(abs(y - {p}))', 'mae')}, {r(f'sqrt(avg(power(y - {p}, 2)))', 'rmse')}, {r(f'1 - sum(power(y - {p}, 2)) / (var_pop(y) * count(*))', 'r2', 6)}"


def metrics(df, keys):
    return rounded(df, [*keys, "n"], ["mae", "rmse"]).join(rounded(df, [*keys, "n"], ["r2"], 6), [*keys, "n"])


@query("V8_segment_metrics", f"WITH {SCORES} SELECT {metrics_sql('champion', 'segment')} FROM scores GROUP BY 1")
def v8(spark, sf_dir):
    return metrics(v.regression_metrics(scores(spark, sf_dir), "y", "champion", ["segment"]), ["segment"])


@query("V9_decile_calibration", f"WITH {SCORES}, d AS (SELECT *, ntile(10) OVER (ORDER BY champion, id) AS decile FROM scores) SELECT decile, count(*) AS n, {r('avg(champion)', 'mean_p')}, {r('avg(y)', 'mean_y')}, {r('abs(avg(champion) - avg(y))', 'error')} FROM d GROUP BY 1")
def v9(spark, sf_dir):
    return rounded(v.decile_calibration(scores(spark, sf_dir), "y", "champion", ["champion", "id"]), ["decile", "n"], ["mean_p", "mean_y", "error"])


FAIR = f"WITH {SCORES}, g AS (SELECT segment, count(*) AS n, avg(CAST(p >= 0.5 AS INT)) AS a, avg(CAST(p >= 0.5 AS INT)) FILTER (label = 1) AS t, avg(CAST(p >= 0.5 AS INT)) FILTER (label = 0) AS f FROM scores GROUP BY 1), z AS (SELECT * FROM g WHERE segment = '5-LOW')"


@query("V16_fair_lending", f"{FAIR} SELECT g.segment, g.n, {r('g.a', 'approval')}, {r('g.a / z.a', 'impact_ratio')}, g.a / z.a >= 0.8 AS passes FROM g, z")
def v16(spark, sf_dir):
    f = v.fairness(scores(spark, sf_dir), "segment", "5-LOW", F.col("p") >= 0.5, F.col("label") == 1)
    return rounded(f, ["segment", "n", "passes"], ["approval", "impact_ratio"])


@query("V20_ood_score", "WITH m AS (SELECT avg(l_quantity) AS a, stddev_samp(l_quantity) AS b, avg(l_extendedprice) AS c, stddev_samp(l_extendedprice) AS d FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), s AS (SELECT l_orderkey, sqrt((power((l_quantity - a) / b, 2) + power((l_extendedprice - c) / d, 2)) / 2) AS score FROM lineitem, m WHERE l_shipdate >= TIMESTAMP '1998-01-01') SELECT count(*) AS n, round(max(score) + 1.3e-7, 4) AS top, round(quantile_cont(score, 0.95) + 1.3e-7, 4) AS cut FROM s")
def v20(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    s = v.ood_scores(old, new, ["l_quantity", "l_extendedprice"], "l_orderkey")
    g = s.agg(F.count("*").alias("n"), F.max("score").alias("top"))
    return rounded(with_quantiles(g, s, [], "score", [0.95]).withColumn("cut", F.col("q")[0]), ["n"], ["top", "cut"])


V21 = f"""WITH {SCORES}, b AS (SELECT p, sum(label) AS pos, count(*) - sum(label) AS neg FROM scores GROUP BY 1), u AS (SELECT *, sum(neg) OVER (ORDER BY p) AS nu, sum(pos) OVER (ORDER BY p) AS pu, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM b),
m AS (SELECT count(*) FILTER (label = 1 AND p >= 0.5) AS tp, count(*) FILTER (label = 0 AND p >= 0.5) AS fp, count(*) FILTER (label = 1) AS pp, count(*) FILTER (label = 0) AS nn FROM scores)
SELECT {r('sum(pos * (nu - neg / 2)) / max(u.tp) / max(u.tn)', 'auc', 5)}, {r('max(abs(pu / u.tp - nu / u.tn))', 'ks', 5)}, {r('max((m.tp + nn - fp) / (pp + nn))', 'accuracy', 5)}, {r('max(m.tp / (m.tp + fp))', 'precision', 5)}, {r('max(m.tp / pp)', 'recall', 5)} FROM u, m"""


@query("V21_classification_metrics", V21)
def v21(spark, sf_dir):
    return rounded(v.classification(scores(spark, sf_dir), "label", "p"), [], ["auc", "ks", "accuracy", "precision", "recall"], 5)


V22 = f"""WITH {SCORES}, k AS (SELECT entity_id, label, row_number() OVER (PARTITION BY entity_id ORDER BY p DESC, id) AS r, row_number() OVER (PARTITION BY entity_id ORDER BY label DESC, p DESC, id) AS i, sum(label) OVER (PARTITION BY entity_id ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS h FROM scores)
SELECT entity_id, {r('CASE WHEN sum(label) > 0 THEN sum(label / log2(r + 1)) FILTER (r <= 10) / sum(label / log2(i + 1)) FILTER (i <= 10) ELSE 0 END', 'ndcg')}, {r('coalesce(sum(h / r) FILTER (label = 1) / sum(label), 0)', 'average_precision')}, {r('coalesce(1 / min(r) FILTER (label = 1), 0)', 'reciprocal_rank')} FROM k GROUP BY 1"""


@query("V22_ranking_metrics", V22)
def v22(spark, sf_dir):
    m = v.ranking_metrics(scores(spark, sf_dir), "entity_id", [F.desc("p"), F.col("id")], "label")
    return rounded(m, ["entity_id"], ["ndcg", "average_precision", "reciprocal_rank"])


@query("V23_position_bias", f"SELECT l_linenumber AS position, {r('greatest(0.01e0, avg(CAST(l_returnflag = $$A$$ AS INT)))', 'ctr')}, {r('1 / greatest(0.01e0, avg(CAST(l_returnflag = $$A$$ AS INT)))', 'weight')} FROM lineitem GROUP BY 1".replace("$$", "'"))
def v23(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("position")).agg(F.greatest(F.lit(0.01), F.avg((F.col("l_returnflag") == "A").cast("double"))).alias("ctr"))
    return rounded(g.withColumn("weight", 1 / F.col("ctr")), ["position"], ["ctr", "weight"])


@query("V24_uplift_qini", f"WITH {SCORES}, b AS (SELECT 11 - ntile(10) OVER (ORDER BY p, id) AS bin, CAST(id % 2 AS INT) AS t, label AS y FROM scores), g AS (SELECT bin, sum(t) AS nt, sum(1 - t) AS nc, sum(t * y) AS yt, sum((1 - t) * y) AS yc FROM b GROUP BY 1) SELECT bin, {r('yt / nt - yc / nc', 'effect')}, {r('sum(yt) OVER w - sum(yc) OVER w * sum(nt) OVER w / sum(nc) OVER w', 'qini', 3)} FROM g WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING)")
def v24(spark, sf_dir):
    rows = scores(spark, sf_dir).withColumn("t", (F.col("id") % 2).cast("int"))
    u = v.uplift_bins(rows, ["p", "id"], "t", "label")
    return rounded(u, ["bin"], ["effect"]).join(rounded(u, ["bin"], ["qini"], 3), "bin")


V26 = f"""WITH {SCORES}, c AS (SELECT grp = 'F' AS t, day >= DATE '1998-01-01' AS a, avg(y) AS m, var_samp(y) AS v, count(*) AS n FROM scores GROUP BY 1, 2)
SELECT {r('sum(CASE WHEN t = a THEN m ELSE -m END)', 'effect')}, {r('sqrt(sum(v / n))', 'standard_error')} FROM c"""


@query("V26_did", V26)
def v26(spark, sf_dir):
    d = v.difference_in_differences(scores(spark, sf_dir), F.col("grp") == "F", F.col("day") >= F.lit("1998-01-01").cast("date"), "y")
    return rounded(d, [], ["effect", "standard_error"])


@query("V27_shadow_compare", f"WITH {SCORES} SELECT {r('avg(abs(champion - challenger))', 'mae')}, {r('avg(champion)', 'mean_production')}, {r('avg(challenger)', 'mean_shadow')}, {r('corr(champion, challenger)', 'correlation', 5)} FROM scores WHERE day BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
def v27(spark, sf_dir):
    g = scores(spark, sf_dir).where("day BETWEEN '1997-01-01' AND '1998-12-31'").agg(F.avg(F.abs(F.col("champion") - F.col("challenger"))).alias("mae"), F.avg("champion").alias("mean_production"), F.avg("challenger").alias("mean_shadow"), F.corr("champion", "challenger").alias("correlation"))
    return rounded(g, [], ["mae", "mean_production", "mean_shadow"]).crossJoin(rounded(g, [], ["correlation"], 5))


MD5 = "(((CAST('0x' || substr(md5('s' || id), 1, 16) AS UBIGINT) % 100) * 16 + CAST('0x' || substr(md5('s' || id), 17, 16) AS UBIGINT) % 100) % 100)"


@query("V28_split_check", f"WITH {SCORES} SELECT count(*) AS n, {r(f'avg(CAST({MD5} < 20 AS INT))', 'share')}, abs(avg(CAST({MD5} < 20 AS INT)) - 0.2) <= 0.02 AS within FROM scores")
def v28(spark, sf_dir):
    from tallgrass.functions.scalar import bucket_100

    g = scores(spark, sf_dir).agg(F.count("*").alias("n"), F.avg((bucket_100(F.col("id"), "s") < 20).cast("double")).alias("share"))
    return rounded(g.withColumn("within", F.abs(F.col("share") - 0.2) <= 0.02), ["n", "within"], ["share"])


V33 = """WITH c AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM embeddings), m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM c GROUP BY 1, 2)
SELECT a.label AS a, b.label AS b, round(sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)) + 1.3e-7, 4) AS cosine FROM m a JOIN m b ON a.i = b.i AND a.label < b.label GROUP BY 1, 2"""


@query("V33_embedding_quality", V33)
def v33(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    a, b = cells.alias("a"), cells.alias("b")
    pairs = a.join(b, (F.col("a.i") == F.col("b.i")) & (F.col("a.label") < F.col("b.label"))).groupBy(F.col("a.label").alias("a"), F.col("b.label").alias("b"))
    dot = lambda p, q: F.sum(F.col(f"{p}.x") * F.col(f"{q}.x"))
    return rounded(pairs.agg((dot("a", "b") / F.sqrt(dot("a", "a") * dot("b", "b"))).alias("cosine")), ["a", "b"], ["cosine"])


@query("V34_score_ensemble", f"WITH {SCORES}, e AS (SELECT min(y) AS a, max(y) AS b, min(p) AS c, max(p) AS d FROM scores), s AS (SELECT id, (y - a) / (b - a) AS s1, (p - c) / (d - c) AS s2 FROM scores, e), w AS (SELECT id, (s1 + s2) / 2 AS m, greatest(s1, s2) AS x, (0.7e0 * s1 + 0.3e0 * s2) / 1e0 AS w FROM s) SELECT id, {r('m', 'mean_score', 5)}, {r('x', 'max_score', 5)}, {r('w', 'weighted_score', 5)}, w > (SELECT quantile_cont(w, 0.95) FROM w) AS anomaly FROM w")
def v34(spark, sf_dir):
    return rounded(v.ensemble(scores(spark, sf_dir), "id", ["y", "p"], [0.7, 0.3], 0.05), ["id", "anomaly"], ["mean_score", "max_score", "weighted_score"], 5)


@query("V35_performance_trend", f"WITH {SCORES}, g AS (SELECT segment, year(day) AS i, avg(abs(y - champion)) AS mae FROM scores GROUP BY 1, 2), t AS (SELECT segment, count(*) AS n, regr_slope(mae, i) AS slope, regr_r2(mae, i) AS r2 FROM g GROUP BY 1) SELECT segment, n, {r('slope', 'slope')}, {r('r2', 'r2')} FROM t")
def v35(spark, sf_dir):
    g = scores(spark, sf_dir).groupBy("segment", F.year("day").alias("i")).agg(F.avg(F.abs(F.col("y") - F.col("champion"))).alias("mae"))
    return rounded(trend(g, "segment", "i", "mae"), ["segment", "n"], ["slope", "r2"])


@query("T12_best_threshold", f"WITH {SCORES}, b AS (SELECT p, sum(label) AS pos, count(*) AS n FROM scores GROUP BY 1), u AS (SELECT p, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS k, sum(pos) OVER () AS t FROM b), f AS (SELECT p, tp / t AS rc, CASE WHEN tp > 0 THEN 2 * (tp / t) * (tp / k) / (tp / t + tp / k) ELSE 0 END AS f1 FROM u) SELECT {r('max(p) FILTER (rc >= 0.8)', 'threshold_recall')}, {r('max(f1)', 'best_f1')} FROM f")
def t12(spark, sf_dir):
    return rounded(v.threshold_for(scores(spark, sf_dir), "label", "p", 0.8), [], ["threshold_recall", "best_f1"])
