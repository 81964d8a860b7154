"""Queries of models: Spark ML fits over whole tables. SQL states what can be stated without a fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import scalar as s
from tallgrass.operators import learn as m
from tallgrass.operators import rules as p
from tallgrass.operators.quantiles import with_quantiles
from tallgrass.operators.windows import rounded
from tallgrass.sources import store
from tallgrass.sources.scratch import settle
from tallgrass.sources.tables import ACCOUNTS, accounts, table

from .registry import query
from .windows import r

CASE = ["n_lines", "quantity", "price", "discount", "tax"]
ACCOUNT = ["balance", "days_past_due", "age", "n_orders", "spend"]


def cases(spark, sf_dir):
    """Orders as collection cases: what is due, how much came back and when, with the features of their lines.

    returned marks cases of which something came back, share how much of the price, gap the days to the first line. The cases
    are written once, as every fit, score and metric reads them again."""
    back = F.col("l_returnflag") == "R"
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"),
        F.max(back.cast("int")).alias("returned"), (F.sum(F.when(back, F.col("l_extendedprice")).otherwise(0.0)) / F.sum("l_extendedprice")).alias("share"), F.to_date(F.min("l_shipdate")).alias("first_day"),
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity_id"), F.col("o_orderpriority").alias("segment"), F.col("o_orderstatus").alias("action"), F.to_date("o_orderdate").alias("day"))
    rows = lines.join(orders, "l_orderkey").withColumnRenamed("l_orderkey", "id").withColumn("amount", F.col("price") * F.col("share"))
    return settle(rows.withColumn("gap", F.abs(F.datediff("first_day", "day"))).withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(10)).cast("int")), "cases")


def parts(df):
    """Rows to fit on, to judge on, and both."""
    return df.where("fold < 8"), df.where("fold >= 8"), df


@query("M1_tag_pca", f"WITH t AS (SELECT l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM lineitem), z AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, avg(c) AS mc, stddev_samp(c) AS sc FROM t) SELECT l_orderkey, l_linenumber, {r('((l_quantity - ma) / sa) ** 2 + ((l_extendedprice - mb) / sb) ** 2 + ((l_discount - mc) / sc) ** 2', 'length2', 3)} FROM lineitem, z")
def m1(spark, sf_dir):
    """The components are free in sign; that they keep each row's length is what SQL can state."""
    found = m.pca_scores(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], 3)
    return rounded(found.withColumn("length2", F.col("pc1") ** 2 + F.col("pc2") ** 2 + F.col("pc3") ** 2), ["l_orderkey", "l_linenumber"], ["length2"], 3)


@query("M2_train_model")
def m2(spark, sf_dir):
    """Held-out figures of every kind: AUC of returned, R2 of the price by the other features."""
    train, held, _ = parts(cases(spark, sf_dir))
    rows = []
    for kind in m.CLASSIFIERS:
        rows.append(("classifier", kind, float(m.auc(m.fit(train, CASE, "returned", kind, classify=True).score(held, "p"), "returned", "p"))))
    for kind in m.REGRESSORS:
        scored = m.fit(train, ["n_lines", "quantity", "discount"], "price", kind).score(held, "p")
        rows.append(("regressor", kind, float(1 - scored.agg(F.avg((F.col("price") - F.col("p")) ** 2) / F.var_pop("price")).first()[0])))
    return spark.createDataFrame(rows, "task string, kind string, score double")


@query("M3_batch_score", f"WITH {ACCOUNTS} SELECT account_id, CASE WHEN balance > 9500 THEN 'manual' WHEN n_orders < 3 THEN 'sparse' ELSE 'champion' END AS route, true AS valid, '2024-01-01' AS stamp FROM accounts")
def m3(spark, sf_dir):
    """Scored, routed, explained, stamped and packed for the audit log; SQL states all but the score itself."""
    rows = accounts(spark, sf_dir).withColumn("late", (F.col("days_past_due") > 90).cast("int"))
    scored = m.fit(rows, ["balance", "age", "n_orders", "spend"], "late", "logistic", classify=True).score(rows, "prediction")
    routed = scored.withColumn("route", p.first_match({"manual": "balance > 9500", "sparse": "n_orders < 3"}, "champion")).withColumn("reasons", s.reason_codes({"balance": F.col("balance") / 1e4, "orders": F.col("n_orders") / 1e2}, 1))
    audit = store.audit_rows(routed, "account_id", "prediction", ["balance", "age", "reasons"], F.col("route"), F.lit("2024-01-01"))
    valid = F.col("prediction").between(0, 1) & F.get_json_object("features", "$.balance").isNotNull() & (F.size(F.from_json(F.get_json_object("features", "$.reasons"), "array<string>")) == 1)
    return audit.select(F.col("id").alias("account_id"), F.col("model").alias("route"), valid.alias("valid"), F.col("logged_at").alias("stamp"))


@query("M4_persona_clusters")
def m4(spark, sf_dir):
    found = m.grouped_clusters(accounts(spark, sf_dir), ACCOUNT, 3, by="segment")
    return found.select("account_id", "segment", "cluster", "distance")


@query("M5_entity_clusters")
def m5(spark, sf_dir):
    rows = accounts(spark, sf_dir)
    best = m.cluster_counts(rows, ACCOUNT).where("best and method = 'kmeans'").first()["k"]
    return m.grouped_clusters(rows, ACCOUNT, best).select("account_id", "cluster", "distance")


@query("M5b_cluster_counts")
def m5b(spark, sf_dir):
    return m.cluster_counts(accounts(spark, sf_dir), ACCOUNT)


@query("M6_text_topics")
def m6(spark, sf_dir):
    return m.text_topics(table(spark, sf_dir, "documents"), "text", keep=["doc_id"]).select("doc_id", "topic")


@query("M7_two_stage_recovery")
def m7(spark, sf_dir):
    train, _, rows = parts(cases(spark, sf_dir))
    found = m.two_stage(train, rows, CASE, "returned", "share", by="segment", least=500)
    return found.select("id", "segment", "p", "fraction", "expected", (F.col("expected") * F.col("price")).alias("amount"))


@query("M7b_two_stage_quality")
def m7b(spark, sf_dir):
    """Held-out figures of M7's models, of all cases and by segment."""
    train, held, _ = parts(cases(spark, sf_dir))
    return m.two_stage_quality(m.two_stage(train, held, CASE, "returned", "share", by="segment", least=500), "returned", "share", by="segment")


@query("M8_elasticity_model")
def m8(spark, sf_dir):
    train, _, rows = parts(cases(spark, sf_dir))
    found = m.dose_response(train.withColumn("dealt", F.col("fold") < 2), rows, ["n_lines", "quantity", "price"], "discount", "returned", [0.0, 0.02, 0.05, 0.08, 0.1], random="dealt")
    return found.groupBy("segment", "discount").agg(F.count("*").alias("n"), F.avg("p").alias("p"))


@query("M9_recovery_scorecard")
def m9(spark, sf_dir):
    train, _, rows = parts(cases(spark, sf_dir))
    found = m.scorecard(train, rows, CASE, "returned", "amount", {"high": 0.7, "medium": 0.4, "low": 0.0})
    return found.select("id", "p", "recovered", "score", "band")


@query("M10_propensity")
def m10(spark, sf_dir):
    within = lambda days: (F.col("gap") <= days).cast("int")
    train, _, rows = parts(cases(spark, sf_dir).withColumns({"in90": within(90), "in365": within(365), "in900": within(900)}))
    found = m.horizons(train, rows, CASE, {"90": "in90", "365": "in365", "900": "in900"}, by="segment")
    return found.select("id", "segment", *[f"{n}_{h}" for h in (90, 365, 900) for n in ("p", "likely")])


@query("M11_payment_estimator")
def m11(spark, sf_dir):
    train, held, rows = parts(cases(spark, sf_dir))
    found = m.intervals(train, held, rows, ["n_lines", "quantity", "discount"], "price")
    return found.select("id", "price", "estimate", "low_80", "high_80", "low_90", "high_90")


@query("M12_uplift_learners")
def m12(spark, sf_dir):
    train, _, rows = parts(cases(spark, sf_dir).withColumn("treated", (F.col("discount") > 0.05).cast("int")))
    return m.uplift(train, rows, ["n_lines", "quantity", "price"], "treated", "share").select("id", "treated", "uplift_t", "uplift_s", "uplift_x", "uplift")


@query("M13_action_scoring")
def m13(spark, sf_dir):
    train, _, rows = parts(cases(spark, sf_dir))
    found = m.action_scores(train, rows.select("id", "action", *CASE), CASE, "action", "returned", "amount", "O")
    return found.select("id", "action", "p", "payment", "expected", "uplift")


@query("M14_supervised_fraud")
def m14(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumn("fraud", ((F.col("price") > 150_000) & (F.col("n_lines") < 6)).cast("int"))
    train, held, rows = parts(rows)
    return m.calibrated_classifier(train, held, rows, ["n_lines", "quantity", "price"], "fraud").select("id", "fraud", "raw", "p", "flagged")


@query("M15_ensembles")
def m15(spark, sf_dir):
    found = m.ensembles(cases(spark, sf_dir), ["n_lines", "quantity", "discount"], "price", "segment", F.col("fold"), {"n_lines = 0": 0.0, "quantity < 2": 1500.0})
    return found.select("id", "price", "oof_boosted", "oof_linear", "weighted", "stacked", "segmented", "ruled")


@query("M16_model_comparison")
def m16(spark, sf_dir):
    return m.compare(cases(spark, sf_dir), ["n_lines", "quantity", "discount"], "price", ("boosted", "forest", "linear"), F.col("fold"))


@query("M16b_grid_search")
def m16b(spark, sf_dir):
    return m.grid_search(cases(spark, sf_dir), CASE, "returned")


@query("M17_feature_importance")
def m17(spark, sf_dir):
    train, held, _ = parts(cases(spark, sf_dir))
    return m.importance(train, held, CASE, "returned", "id")


RESIDUAL = "WITH b AS (SELECT o_orderkey AS id, CAST(floor(o_totalprice / 5e4) AS BIGINT) AS band, o_totalprice * (0.8e0 + (o_orderkey * 37 % 40) / 1e2) - o_totalprice AS e FROM orders)"


@query("M18_multi_quantile", f"{RESIDUAL} SELECT band, count(*) AS n, " + ", ".join(r(f"quantile_cont(e, {q})", f"q{q * 100:.0f}", 3) for q in (0.1, 0.25, 0.5, 0.75, 0.9)) + " FROM b GROUP BY 1")
def m18(spark, sf_dir):
    """Quantiles of what a score misses, by band of the score: added to the score they are its conditional quantiles."""
    orders = table(spark, sf_dir, "orders")
    missed = F.expr("o_totalprice * (0.8e0 + (o_orderkey * 37 % 40) / 1e2) - o_totalprice")
    rows = orders.select(F.floor(F.col("o_totalprice") / 5e4).alias("band"), missed.alias("e"))
    levels = (0.1, 0.25, 0.5, 0.75, 0.9)
    found = with_quantiles(rows.groupBy("band").agg(F.count("*").alias("n")), rows, ["band"], "e", list(levels))
    return rounded(found.select("band", "n", *[F.col("q")[i].alias(f"q{q * 100:.0f}") for i, q in enumerate(levels)]), ["band", "n"], [f"q{q * 100:.0f}" for q in levels], 3)


@query("U1_scalar_functions", "SELECT event_id, CASE WHEN value < 0 THEN 'out' WHEN value = 0 THEN 'none' ELSE 'in' END AS direction, CAST(('0x' || substr(md5('u1:' || user_id), 1, 8)) AS BIGINT) % 100 AS bucket FROM events")
def u1(spark, sf_dir):
    """Small scalar rules as columns, with no Python."""
    direction = F.when(F.col("value") < 0, "out").when(F.col("value") == 0, "none").otherwise("in")
    bucket = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("u1:"), F.col("user_id").cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(100))
    return table(spark, sf_dir, "events").select("event_id", direction.alias("direction"), bucket.alias("bucket"))


@query("U2_grouped_columns", f"SELECT user_id, count(*) AS n, {r('sum(value) / greatest(1, count(DISTINCT CAST(ts AS DATE)))', 'per_day')} FROM events GROUP BY 1")
def u2(spark, sf_dir):
    """What a grouped pandas function would do, as one aggregation."""
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), (F.sum("value") / F.greatest(F.lit(1), F.count_distinct(F.to_date("ts")))).alias("per_day"))
    return rounded(g, ["user_id", "n"], ["per_day"])


@query("U3_feature_plugins", f"SELECT account_id, {r('balance / (1 + n_orders)', 'balance_per_order')}, days_past_due > 90 AS late FROM (WITH {ACCOUNTS} SELECT * FROM accounts)")
def u3(spark, sf_dir):
    """Feature plug-ins are functions of a frame, chained by transform."""
    plugins = [lambda df: df.withColumn("balance_per_order", F.col("balance") / (1 + F.col("n_orders"))), lambda df: df.withColumn("late", F.col("days_past_due") > 90)]
    rows = accounts(spark, sf_dir)
    for plugin in plugins:
        rows = rows.transform(plugin)
    return rounded(rows, ["account_id", "late"], ["balance_per_order"])


@query("U4_custom_validators", "SELECT 'positive' AS \"check\", count(*) FILTER (NOT l_quantity > 0) AS failed, count(*) AS rows FROM lineitem UNION ALL SELECT 'below_mean', count(*) FILTER (NOT l_extendedprice <= 1e5), count(*) FROM lineitem UNION ALL SELECT 'known_flag', count(*) FILTER (NOT l_returnflag IN ('A', 'N')), count(*) FROM lineitem")
def u4(spark, sf_dir):
    checks = {"positive": lambda df: df["l_quantity"] > 0, "below_mean": lambda df: df["l_extendedprice"] <= 1e5, "known_flag": lambda df: df["l_returnflag"].isin("A", "N")}
    return m.validated(table(spark, sf_dir, "lineitem"), checks)


@query("U5_model_hook", f"SELECT l_orderkey, l_linenumber, {r('l_quantity * 2 + l_discount', 'prediction')} FROM lineitem")
def u5(spark, sf_dir):
    hook = m.outside_model(lambda x: x["l_quantity"] * 2 + x["l_discount"], ["l_quantity", "l_discount"])
    return rounded(hook(table(spark, sf_dir, "lineitem"), "prediction"), ["l_orderkey", "l_linenumber"], ["prediction"])


@query("V32_domain_shift")
def v32(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    old = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    return m.domain_shift(rows.where(old), rows.where(~old), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
