"""Queries of model diversity, calibration maps, adversarial validation, embeddings and networks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallgrass.operators import ensembles as e
from tallgrass.operators import networks as n
from tallgrass.operators.windows import rounded, rounded_by
from tallgrass.sources.tables import EDGES, SCORES, edges, scores, table

from .registry import query
from .windows import r

MODELS = {"m1": "p", "m2": "(id * 53 % 997) / 997e0", "m3": "0.6e0 * p + 0.4e0 * ((id * 53 % 997) / 997e0)", "m4": "1 - p", "m5": "p * p"}
VOTES = f"{SCORES}, votes AS (SELECT id, label, " + ", ".join(f"{x} AS {m}" for m, x in MODELS.items()) + " FROM scores)"
NAMES = list(MODELS)
PAIRS = [(a, b) for i, a in enumerate(NAMES) for b in NAMES[i + 1 :]]


def votes(spark, sf_dir):
    return scores(spark, sf_dir).select("id", "label", *[F.expr(x).alias(m) for m, x in MODELS.items()])


def pair_sql(a: str, b: str) -> str:
    count = lambda i, j: f"CAST(count(*) FILTER (({a} > 0.5) = {i} AND ({b} > 0.5) = {j}) AS DOUBLE)"
    both, cross = f"{count(True, True)} * {count(False, False)}", f"{count(True, False)} * {count(False, True)}"
    return f"SELECT '{a}' AS a, '{b}' AS b, avg(CAST(({a} > 0.5) <> ({b} > 0.5) AS INT)) AS d, CASE WHEN {both} + {cross} > 0 THEN ({both} - {cross}) / ({both} + {cross}) END AS q, corr({a}, {b}) AS c FROM votes"


PAIR = "pairs AS (" + " UNION ALL ".join(pair_sql(a, b) for a, b in PAIRS) + ")"


@query("F22_diversity", f"WITH {VOTES}, {PAIR} SELECT a, b, {r('d', 'disagreement')}, {r('q', 'q_statistic')}, {r('c', 'correlation')} FROM pairs")
def f22(spark, sf_dir):
    return rounded(e.diversity(votes(spark, sf_dir), NAMES), ["a", "b"], ["disagreement", "q_statistic", "correlation"])


def auc_sql(m: str) -> str:
    """Mean rank of the positive ones, ties sharing their ranks."""
    return f"SELECT '{m}' AS model, (sum(k) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM (SELECT label, avg(i) OVER (PARTITION BY {m}) AS k FROM (SELECT label, {m}, row_number() OVER (ORDER BY {m}) AS i FROM votes))"


def next_sql(k: int) -> str:
    """The k-th choice: over the models not yet taken, with the mean correlation of all pairs among taken and candidate."""
    taken = ", ".join(f"(SELECT model FROM c{i})" for i in range(1, k))
    return f"""c{k} AS (SELECT {k} AS place, m.model, any_value(m.auc) AS auc, 0.7e0 * any_value(m.auc) + 0.3e0 * (1 - avg(p.c)) AS score
FROM auc m, pairs p WHERE m.model NOT IN ({taken}) AND (p.a IN ({taken}) OR p.a = m.model) AND (p.b IN ({taken}) OR p.b = m.model) GROUP BY m.model ORDER BY round(score, 9) DESC, m.model LIMIT 1)"""


F22B = f"""WITH {VOTES}, {PAIR}, auc AS ({" UNION ALL ".join(map(auc_sql, NAMES))}), c1 AS (SELECT 1 AS place, model, auc, auc AS score FROM auc ORDER BY round(auc, 9) DESC, model LIMIT 1), {next_sql(2)}, {next_sql(3)},
c AS (FROM c1 UNION ALL FROM c2 UNION ALL FROM c3) SELECT CAST(place AS BIGINT) AS place, model, {r('auc', 'auc')}, {r('score', 'score')} FROM c"""


@query("F22b_diverse_subset", F22B)
def f22b(spark, sf_dir):
    return rounded(e.diverse_subset(votes(spark, sf_dir), NAMES, "label", 3), ["place", "model"], ["auc", "score"])


@query("V13_isotonic_calibration")
def v13(spark, sf_dir):
    """Maps fitted on the even cases, applied to the odd ones."""
    rows = scores(spark, sf_dir).withColumn("p", F.col("p") ** 2)
    found = e.calibrated(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"), "p", "label")
    return found.select("id", "p", "label", "isotonic", "sigmoid")


LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("V19_adversarial")
def v19(spark, sf_dir):
    """Lines before against lines after a day (temporal), one order in five against the others (sampling), and lines picked by
    their quantity against the others (biased)."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LINES, "l_shipdate")
    old = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    some = F.pmod(F.xxhash64("l_orderkey"), F.lit(5)) == 0
    biased = (F.col("l_quantity") > 25) & (F.col("l_linenumber") > 1)
    variants = {"temporal": old, "sampling": some, "biased": biased}
    id, found = ["l_orderkey", "l_linenumber", "l_partkey"], None
    for name, side in variants.items():
        part = e.adversarial(rows.where(side), rows.where(~side), LINES, id).select(F.lit(name).alias("variant"), "*")
        found = part if found is None else found.unionByName(part)
    return found


V33B = """WITH p AS (SELECT vec_id AS a, lead(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS b, true AS linked FROM embeddings
UNION ALL SELECT x.vec_id, y.vec_id, false FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1 AND x.label <> y.label),
d AS (SELECT p.a, p.b, linked, unnest(x.embedding) AS u, unnest(y.embedding) AS v FROM p JOIN embeddings x ON x.vec_id = p.a JOIN embeddings y ON y.vec_id = p.b),
c AS (SELECT linked, sum(CAST(u AS DOUBLE) * v) / sqrt(sum(CAST(u AS DOUBLE) * u)) / sqrt(sum(CAST(v AS DOUBLE) * v)) AS c FROM d GROUP BY a, b, linked)
SELECT count(*) FILTER (linked) AS n_linked, count(*) FILTER (NOT linked) AS n_unlinked, """ + ", ".join([
    r("avg(c) FILTER (linked)", "linked"), r("avg(c) FILTER (NOT linked)", "unlinked"), r("avg(c) FILTER (linked) - avg(c) FILTER (NOT linked)", "separation"),
    r("avg(CAST(c > (SELECT avg(c) FROM c WHERE NOT linked) AS INT)) FILTER (linked)", "above"),
]) + " FROM c"


@query("V33b_pair_separation", V33B)
def v33b(spark, sf_dir):
    """Linked: a vector and the next one of its label; unlinked: neighbours by number with different labels."""
    rows = table(spark, sf_dir, "embeddings")
    same = rows.select(F.col("vec_id").alias("a"), F.lead("vec_id").over(Window.partitionBy("label").orderBy("vec_id")).alias("b"), F.lit(True).alias("linked")).where("b IS NOT NULL")
    x, y = rows.select(F.col("vec_id").alias("a"), F.col("label").alias("la")), rows.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("label").alias("lb"))
    other = x.join(y, "a").where("la <> lb").select("a", "b", F.lit(False).alias("linked"))
    found = e.pair_separation(rows, same.unionByName(other), "vec_id", "embedding")
    return rounded(found, ["n_linked", "n_unlinked"], ["linked", "unlinked", "separation", "above"])


PEERS = """l AS (SELECT DISTINCT src, dst FROM edges), d AS (SELECT src, count(*) AS n FROM l GROUP BY 1),
pp AS (SELECT a.src, b.src AS peer, count(*) AS common FROM l a JOIN l b ON a.dst = b.dst AND a.src <> b.src GROUP BY 1, 2),
ss AS (SELECT pp.src, peer, common / (d.n + f.n - common) AS similarity FROM pp JOIN d ON pp.src = d.src JOIN d f ON pp.peer = f.src),
peers AS (SELECT src, peer FROM ss WHERE similarity >= 0.4e0 QUALIFY row_number() OVER (PARTITION BY src ORDER BY similarity DESC, peer) <= 5)"""
G34 = f"""WITH {EDGES}, {PEERS}, paid AS (SELECT dst, avg(weight) AS m FROM edges GROUP BY 1 HAVING count(*) >= 50),
income AS (SELECT src, sum(weight) AS own, avg(m) AS employer, count(m) AS employers, count(*) AS links FROM edges LEFT JOIN paid USING (dst) GROUP BY 1),
lv AS (SELECT p.src, count(*) AS peers, median(i.own) AS med, (quantile_cont(i.own, 0.75) - quantile_cont(i.own, 0.25)) / 1.35e0 AS spread FROM peers p JOIN income i ON i.src = p.peer GROUP BY 1),
near AS (SELECT a.src, count(*) AS near, avg(i.own) AS m, stddev_pop(i.own) AS s FROM edges a JOIN edges b ON a.dst = b.dst AND a.src <> b.src JOIN income i ON i.src = b.src GROUP BY 1),
x AS (SELECT i.src, employers, coalesce(peers, 0) AS peers, coalesce(near, 0) AS near, abs(own / links / employer - 1) AS gap, coalesce(CASE WHEN spread > 0 THEN (own - med) / spread END, 0) AS pd,
  CASE WHEN coalesce(near, 0) < 3 THEN 0.5e0 WHEN s > 0 THEN least(1e0, abs(own - m) / s / 3) ELSE 0 END AS an FROM income i LEFT JOIN lv USING (src) LEFT JOIN near USING (src)),
y AS (SELECT *, list_avg(list_filter([1 - least(1e0, gap), CASE WHEN peers > 0 THEN 1 - least(1e0, abs(pd) / 3) END, 1 - an], lambda v: v IS NOT NULL)) AS score FROM x)
SELECT src, employers, peers, near, {r('gap', 'employer_gap')}, {r('pd', 'peer_deviation', 3)}, {r('an', 'anomaly', 3)}, {r('score', 'consistency', 3)}, {r('least(1e0, least(1e0, peers / 5e0) * 0.6e0 + CASE WHEN employers > 0 THEN 1e0 ELSE 0.5e0 END * 0.4e0)', 'confidence')},
score >= 0.6 AND abs(pd) <= 3 AND an <= 0.7 AS consistent, concat_ws('|', CASE WHEN abs(pd) > 3 THEN 'peer deviation' END, CASE WHEN gap > 0.3e0 THEN 'employer mismatch' END, CASE WHEN an > 0.7e0 THEN 'network anomaly' END) AS flags FROM y"""


@query("G34_network_validation", G34)
def g34(spark, sf_dir):
    """Incomes against employers, against the five most similar others, and against all who share a payer."""
    found = n.validated_incomes(edges(spark, sf_dir))
    keys = ["src", "employers", "peers", "near", "consistent", "flags"]
    return rounded_by(found, keys, {"employer_gap": 4, "peer_deviation": 3, "anomaly": 3, "consistency": 3, "confidence": 4})


G34B = f"""WITH pay AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, l_extendedprice AS amount, o_orderdate >= TIMESTAMP '1996-01-01' AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (SELECT src, dst, count(*) AS n, avg(amount) AS mean, stddev_pop(amount) AS sd FROM pay GROUP BY 1, 2), {PEERS},
boss AS (SELECT dst FROM edges GROUP BY 1 HAVING count(*) >= 50),
own AS (SELECT src, coalesce(max(CASE WHEN boss.dst IS NOT NULL AND n >= 3 THEN greatest(0e0, 1 - sd / mean) END), 0) AS es, count(*) AS degree FROM edges LEFT JOIN boss USING (dst) GROUP BY 1),
ps AS (SELECT p.src, avg(es) AS ps FROM peers p JOIN own ON own.src = p.peer AND es > 0 GROUP BY 1),
ch AS (SELECT src, sum(amount) FILTER (late) / sum(amount) FILTER (NOT late) - 1 AS change FROM pay GROUP BY 1),
x AS (SELECT own.src, es, coalesce(ps, 0.5e0) AS ps, 1 - least(1e0, abs(degree - (SELECT avg(degree) FROM own)) / greatest(1e0, (SELECT avg(degree) FROM own))) AS ns, change FROM own LEFT JOIN ps USING (src) JOIN ch USING (src))
SELECT src, {r('es', 'employer_stability')}, {r('ps', 'peer_stability')}, {r('ns', 'network_stability')}, {r('0.5e0 * es + 0.3e0 * ps + 0.2e0 * ns', 'overall')}, {r('change', 'change')} FROM x"""


@query("G34b_network_stability", G34B)
def g34b(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")
    paid = lines.select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.col("l_extendedprice").alias("amount"), late.alias("late"))
    return rounded(n.network_stability(paid), ["src"], ["employer_stability", "peer_stability", "network_stability", "overall", "change"])
