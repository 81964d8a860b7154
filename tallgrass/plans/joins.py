"""Queries of the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import joins as j
from tallgrass.operators.windows import rounded
from tallgrass.sources import store
from tallgrass.sources.scratch import settle, shared_path
from tallgrass.sources.tables import ACCOUNTS, EDGES, SCORES, TXN, accounts, edges, scores, txn

from .registry import query
from .windows import r

BUY, PAY = "(SELECT * FROM txn WHERE category = 'view')", "(SELECT * FROM txn WHERE category = 'purchase')"


@query("J1_asof_join", f"WITH {TXN} SELECT l.event_id, f.event_id AS feature_id, f.value AS feature FROM {BUY} l ASOF LEFT JOIN {PAY} f ON l.entity_id = f.entity_id AND l.ts >= f.ts")
def j1(spark, sf_dir):
    rows = txn(spark, sf_dir)
    right = rows.where("category = 'purchase'").select("entity_id", F.col("ts").alias("feature_ts"), F.col("event_id").alias("feature_id"), F.col("value").alias("feature"))
    return j.asof(rows.where("category = 'view'"), right, "entity_id", "ts", "feature_ts", ["feature_id", "feature"]).select("event_id", "feature_id", "feature")


@query("J2_asof_join_lookback", f"WITH {TXN} SELECT l.event_id, CASE WHEN l.sec - f.sec <= 172800 THEN f.event_id END AS feature_id FROM {BUY} l ASOF LEFT JOIN {PAY} f ON l.entity_id = f.entity_id AND l.ts >= f.ts")
def j2(spark, sf_dir):
    rows = txn(spark, sf_dir)
    right = rows.where("category = 'purchase'").select("entity_id", F.col("ts").alias("feature_ts"), F.col("event_id").alias("feature_id"))
    return j.asof(rows.where("category = 'view'"), right, "entity_id", "ts", "feature_ts", ["feature_id"], lookback_days=2).select("event_id", "feature_id")


@query("J3_leakage_check", f"WITH {TXN}, l AS (SELECT entity_id, max(ts) AS label_ts FROM txn WHERE category = 'purchase' GROUP BY 1) SELECT t.entity_id, count(*) AS leaks FROM txn t JOIN l USING (entity_id) WHERE t.ts > label_ts GROUP BY 1")
def j3(spark, sf_dir):
    rows = txn(spark, sf_dir)
    labels = rows.where("category = 'purchase'").groupBy("entity_id").agg(F.max("ts").alias("label_ts"))
    return j.leaks(rows, labels, "entity_id", "ts", "label_ts").groupBy("entity_id").agg(F.count("*").alias("leaks"))


@query("J5_split_sufficient", f"WITH {TXN}, n AS (SELECT entity_id, count(*) AS n FROM txn GROUP BY 1) SELECT event_id, n >= 65 AS sufficient FROM txn JOIN n USING (entity_id)")
def j5(spark, sf_dir):
    rows = txn(spark, sf_dir)
    enough = rows.groupBy("entity_id").agg(F.count("*").alias("n")).where("n >= 65")
    both = rows.join(enough, "entity_id", "left_semi").select("event_id", F.lit(True).alias("sufficient"))
    return both.unionByName(rows.join(enough, "entity_id", "left_anti").select("event_id", F.lit(False).alias("sufficient")))


@query("J6_time_lag_join", f"WITH {TXN}, p AS (SELECT entity_id, day + 7 AS day, avg(value) AS past FROM txn GROUP BY 1, 2) SELECT event_id, {r('past', 'value_7d_ago')} FROM txn LEFT JOIN p USING (entity_id, day)")
def j6(spark, sf_dir):
    return rounded(j.time_lag(txn(spark, sf_dir), "entity_id", "day", "value", 7), ["event_id"], ["value_7d_ago"])


@query("J7_demographics_join", f"WITH {ACCOUNTS} SELECT o_orderkey, age, age >= 60 AS senior, segment, NOT do_not_contact AS phone_ok FROM orders LEFT JOIN accounts ON account_id = o_custkey")
def j7(spark, sf_dir):
    from tallgrass.sources.tables import table

    people = accounts(spark, sf_dir).dropDuplicates(["account_id"])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("account_id"))
    return orders.join(people, "account_id", "left").select("o_orderkey", "age", (F.col("age") >= 60).alias("senior"), "segment", (~F.col("do_not_contact")).alias("phone_ok"))


@query("J8_label_join", f"WITH {ACCOUNTS}, l AS (SELECT o_custkey, sum(o_totalprice) AS paid FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1) SELECT account_id, {r('coalesce(paid, 0)', 'paid', 2)}, CAST(coalesce(paid, 0) > 0 AS INT) AS label FROM accounts LEFT JOIN l ON o_custkey = account_id")
def j8(spark, sf_dir):
    from tallgrass.sources.tables import table

    paid = table(spark, sf_dir, "orders").where("o_orderdate >= '1998-01-01' AND o_orderdate < '1998-07-01'").groupBy(F.col("o_custkey").alias("account_id")).agg(F.sum("o_totalprice").alias("paid"))
    found = accounts(spark, sf_dir).select("account_id").join(paid, "account_id", "left").withColumn("paid", F.coalesce("paid", F.lit(0.0)))
    return rounded(found.withColumn("label", (F.col("paid") > 0).cast("int")), ["account_id"], ["paid", "label"], 2)


GRID = [0.0, 0.1, 0.2, 0.3, 0.4]
ERV = "least(0.95e0, propensity + 0.8e0 * d) * balance * (1 - d)"


@query("J9_cross_grid", f"WITH {ACCOUNTS}, g AS (SELECT account_id, d, {ERV} AS v FROM accounts, (VALUES (0e0), (0.1e0), (0.2e0), (0.3e0), (0.4e0)) t(d)) SELECT account_id, d AS discount, {r('v', 'value', 2)}, CASE WHEN v > 3000 THEN 'CONTACT' WHEN v > 500 THEN 'DEFER' ELSE 'SELL' END AS decision FROM g QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY v DESC, d) = 1")
def j9(spark, sf_dir):
    d, balance = F.col("discount"), F.col("balance")
    value = F.least(F.lit(0.95), F.col("propensity") + 0.8 * d) * balance * (1 - d)
    best = j.best_on_grid(accounts(spark, sf_dir), "account_id", GRID, "discount", value)
    decision = F.when(F.col("value") > 3000, "CONTACT").when(F.col("value") > 500, "DEFER").otherwise("SELL")
    return rounded(best.withColumn("decision", decision), ["account_id", "discount", "decision"], ["value"], 2)


J11 = f"""WITH {EDGES}, l AS (SELECT DISTINCT src, dst FROM edges), d AS (SELECT src, count(*) AS n FROM l GROUP BY 1),
p AS (SELECT a.src, b.src AS peer, count(*) AS common FROM l a JOIN l b ON a.dst = b.dst AND a.src <> b.src GROUP BY 1, 2),
s AS (SELECT p.src, peer, common / (d.n + e.n - common) AS similarity FROM p JOIN d ON p.src = d.src JOIN d e ON p.peer = e.src),
k AS (SELECT src, peer, similarity FROM s WHERE similarity >= 0.4e0 QUALIFY row_number() OVER (PARTITION BY src ORDER BY similarity DESC, peer) <= 5),
v AS (SELECT src AS id, sum(weight) AS value FROM edges GROUP BY 1)
SELECT k.src, count(*) AS peers, {r('max(similarity)', 'best')}, {r('median(a.value)', 'median', 2)}, {r('quantile_cont(a.value, 0.25)', 'p25', 2)}, {r('quantile_cont(a.value, 0.75)', 'p75', 2)}, {r('avg(CAST(b.value >= a.value AS INT))', 'percentile')}
FROM k JOIN v a ON a.id = k.peer JOIN v b ON b.id = k.src GROUP BY 1"""


@query("J11_entity_network_peers", J11)
def j11(spark, sf_dir):
    whole = settle(edges(spark, sf_dir).select("src", "dst", "weight"), "peer-edges")
    found = settle(j.peers(whole, 0.4, 5), "peers")
    levels = j.peer_levels(found, whole.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("value")))
    best = found.groupBy("src").agg(F.max("similarity").alias("best"))
    return rounded(rounded(levels.join(best, "src"), ["src", "peers", "median", "p25", "p75"], ["best", "percentile"]), ["src", "peers", "best", "percentile"], ["median", "p25", "p75"], 2)


J12 = f"""WITH {SCORES}, t AS (SELECT * FROM scores WHERE segment = '1-URGENT'), c AS (SELECT p, min(id) AS id, min_by(y, id) AS y FROM scores WHERE segment <> '1-URGENT' GROUP BY 1),
a AS (SELECT t.id, t.p, t.y, c.p AS lp, c.id AS lid, c.y AS ly FROM t ASOF LEFT JOIN c ON t.p >= c.p), b AS (SELECT t.id, c.p AS hp, c.id AS hid, c.y AS hy FROM t ASOF LEFT JOIN c ON t.p <= c.p)
SELECT id, CASE WHEN hp IS NULL OR p - lp <= hp - p THEN lid ELSE hid END AS match_id, {r('y - CASE WHEN hp IS NULL OR p - lp <= hp - p THEN ly ELSE hy END', 'difference')} FROM a JOIN b USING (id)"""


@query("J12_match_nearest", J12)
def j12(spark, sf_dir):
    found = j.match_nearest(scores(spark, sf_dir), F.col("segment") == "1-URGENT", "p", "y", "id", 0.05)
    return rounded(found, ["id", "match_id"], ["difference"])


J13 = """WITH s AS (SELECT o_custkey AS id, year(o_orderdate) AS y, CASE WHEN sum(o_totalprice) > 500000 THEN 'high' WHEN sum(o_totalprice) > 250000 THEN 'mid' ELSE 'low' END AS state FROM orders GROUP BY 1, 2)
SELECT a.state AS from_state, b.state AS to_state, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY a.state) + 1.3e-7, 4) AS share FROM s a JOIN s b ON a.id = b.id WHERE a.y = 1996 AND b.y = 1997 GROUP BY 1, 2"""


@query("J13_migration_join", J13)
def j13(spark, sf_dir):
    from tallgrass.sources.tables import table

    yearly = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    states = yearly.withColumn("state", F.when(F.col("v") > 500000, "high").when(F.col("v") > 250000, "mid").otherwise("low"))
    return rounded(j.migration(states, "id", "y", "state", 1996, 1997), ["from_state", "to_state", "n"], ["share"])


J14 = f"""WITH RECURSIVE {EDGES}, e AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
h AS (SELECT 'c1' AS id, 0 AS hops UNION SELECT dst, hops + 1 FROM h JOIN e ON h.id = e.src WHERE hops < 2) SELECT id, min(hops) AS hops FROM h GROUP BY 1"""


@query("J14_khop_subgraph", J14)
def j14(spark, sf_dir):
    seeds = spark.range(1).select(F.lit("c1").alias("id"))
    return j.khop(edges(spark, sf_dir), seeds, 2)


J15 = f"""WITH {TXN}, ids AS (SELECT DISTINCT entity_id FROM txn), ends AS (SELECT min(ts) AS a, max(ts) AS b FROM txn),
p AS (
  SELECT entity_id, 'v1' AS version, a AS made_at, entity_id % 7 / 1e1 + CASE WHEN entity_id % 3 = 0 THEN 1 ELSE 0 END AS prediction FROM ids, ends
  UNION ALL SELECT entity_id, 'v2', a + (b - a) / 2, entity_id % 5 / 1e1 FROM ids, ends WHERE entity_id % 4 <> 0)
SELECT l.event_id, p.version, {r('p.prediction', 'prediction')} FROM txn l ASOF LEFT JOIN p ON l.entity_id = p.entity_id AND l.ts >= p.made_at"""


@query("J15_attach_predictions", J15)
def j15(spark, sf_dir):
    """A model's second version half way; its batch is written twice, and a late batch corrects the first version."""
    path, rows = shared_path(spark, "predictions"), txn(spark, sf_dir)
    ends = rows.agg(F.min("ts").alias("a"), (F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("m"))
    ids = rows.select("entity_id").distinct().crossJoin(F.broadcast(ends))
    first = ids.select("entity_id", F.lit("v1").alias("version"), F.col("a").alias("made_at"), F.expr("entity_id % 7 / 1e1").alias("p"))
    second = ids.where("entity_id % 4 <> 0").select("entity_id", F.lit("v2").alias("version"), F.col("m").alias("made_at"), F.expr("entity_id % 5 / 1e1").alias("p"))
    late = first.where("entity_id % 3 = 0").withColumn("p", F.col("p") + 1)
    for batch, df in ((2, late), (0, first), (1, second.withColumn("p", F.lit(9.0))), (1, second)):
        store.put_predictions(df, path, batch, "entity_id", "version", "made_at", "p")
    return rounded(store.attach_predictions(rows, path, "entity_id", "ts"), ["event_id", "version"], ["prediction"])


@query("J16_stickiness", f"WITH {ACCOUNTS}, a AS (SELECT account_id, CAST(('0x' || substr(md5('a' || account_id), 1, 8)) AS BIGINT) % 2 AS v FROM accounts), b AS (SELECT account_id, CAST(('0x' || substr(md5('b' || account_id), 1, 8)) AS BIGINT) % 2 AS v FROM accounts) SELECT count(*) AS n, {r('avg(CAST(a.v = b.v AS INT))', 'stickiness')} FROM a JOIN b USING (account_id)")
def j16(spark, sf_dir):
    rows = accounts(spark, sf_dir)
    assign = lambda seed: rows.select("account_id", (F.conv(F.substring(F.md5(F.concat(F.lit(seed), "account_id")), 1, 8), 16, 10).cast("long") % 2).alias("v"))
    return rounded(j.stickiness(assign("a"), assign("b"), "account_id", "v"), ["n"], ["stickiness"])


@query("J17_event_asof", f"WITH {TXN} SELECT event_id, {r('(sec - max(CASE WHEN category = $$error$$ THEN sec END) OVER (PARTITION BY entity_id ORDER BY sec RANGE UNBOUNDED PRECEDING)) / 86400e0', 'days_since_error')} FROM txn".replace("$$", "'"))
def j17(spark, sf_dir):
    from tallgrass.operators.windows import event_features

    found = event_features(txn(spark, sf_dir), "entity_id", "category", "error")
    return rounded(found.withColumnRenamed("days_since", "days_since_error"), ["event_id"], ["days_since_error"])
