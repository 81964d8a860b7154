"""Models: held-out figures, orders that have to hold, edge frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import learn
from tallgrass.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    """y falls with a and rises with b; label is likelier with a; the effect of t is b."""
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=600), rng.normal(size=600)
    t, noise = rng.integers(0, 2, 600), rng.normal(size=600) / 4
    data = [(k, float(a[k]), float(b[k]), int(t[k]), float(b[k] - 2 * a[k] + noise[k]), int(a[k] + noise[k] > 0), float(a[k] + t[k] * b[k]), "us"[k % 2]) for k in range(600)]
    return spark.createDataFrame(data, "id long, a double, b double, t int, y double, label int, z double, seg string").withColumn("fold", F.col("id") % 10).cache()


def halves(rows):
    return rows.where("fold < 7"), rows.where("fold >= 7")


@pytest.mark.parametrize("kind", ["boosted", "forest", "logistic"])
def test_classifiers(rows, kind):
    train, held = halves(rows)
    assert learn.auc(learn.fit(train, ["a", "b"], "label", kind, classify=True).score(held, "p"), "label", "p") > 0.95


def test_comparison_prefers_the_true_form(rows):
    found = {r.kind: r for r in learn.compare(rows, ["a", "b"], "y", ("boosted", "linear"), F.col("fold")).collect()}
    assert found["linear"].best and found["linear"].r2 > 0.95 and found["boosted"].t > 2


def test_two_stage_and_scorecard(rows):
    train, held = halves(rows.withColumn("share", F.when(F.col("label") == 1, 0.8).otherwise(0.0)).withColumn("amount", F.col("share") * 100))
    found = learn.two_stage(train, held, ["a", "b"], "label", "share", by="seg", least=100)
    assert found.count() == held.count() and found.where("abs(fraction - 0.8) > 0.05 or p not between 0 and 1").count() == 0
    cards = learn.scorecard(train, held, ["a", "b"], "label", "amount", {"high": 0.6, "low": 0.0})
    assert cards.where("band = 'high' and p < 0.6 or band = 'low' and p >= 0.6 or band is null").count() == 0


def test_horizons_rise(rows):
    train, held = halves(rows.withColumns({"soon": (F.col("a") > 1).cast("int"), "later": (F.col("a") > 0).cast("int")}))
    found = learn.horizons(train, held, ["a", "b"], {"soon": "soon", "later": "later"})
    assert found.where("p_later < p_soon").count() == 0 and found.where("likely_later and a < -0.5").count() == 0


def test_intervals_cover(rows):
    train, held = halves(rows)
    found = learn.intervals(train, held, rows, ["a", "b"], "y")
    assert 0.8 < found.where("fold >= 7").agg(F.avg(F.col("y").between(F.col("low_90"), F.col("high_90")).cast("double"))).first()[0] < 0.97
    assert found.where("low_90 > low_80 or high_80 > high_90").count() == 0


def test_uplift_follows_the_effect(rows):
    train, held = halves(rows)
    found = learn.uplift(train, held, ["a", "b"], "t", "z")
    assert found.agg(F.corr("uplift", "b")).first()[0] > 0.8


def test_actions_and_doses(rows):
    train = rows.withColumn("action", F.when(F.col("t") == 1, "call").otherwise("none")).withColumn("paid", ((F.col("t") == 1) | (F.col("a") > 1)).cast("int")).withColumn("amount", F.lit(10.0))
    found = learn.action_scores(train, train.select("id", "a", "b", "action"), ["a", "b"], "action", "paid", "amount", "none")
    assert found.count() == 1200 and found.where("action = 'none' and uplift != 0").count() == 0
    assert found.where("action = 'call' and a < 0 and uplift < 0.5").count() == 0
    dosed = learn.dose_response(train.withColumn("d", F.col("t").cast("double")), train, ["a", "b"], "d", "paid", [0.0, 1.0])
    p = {r.d: r.p for r in dosed.groupBy("d").agg(F.avg("p").alias("p")).collect()}
    assert p[1.0] > p[0.0] + 0.3


def test_calibrated_classifier_and_importance(rows):
    train, held = halves(rows)
    found = learn.calibrated_classifier(train, held, rows, ["a", "b"], "label")
    assert found.where("flagged != (label = 1)").count() < 60
    ranked = learn.importance(train, held, ["a", "b"], "label", "id").orderBy(F.desc("drop")).collect()
    assert [r.feature for r in ranked] == ["a", "b"] and ranked[0].tree > ranked[1].tree


def test_clusters(spark):
    rows = spark.createDataFrame([(k, float(10 * (k % 3)), float(k % 3 == 1)) for k in range(90)], "id long, a double, b double")
    counts = {r.k: r for r in learn.cluster_counts(rows, ["a", "b"], (2, 3, 4)).where("method = 'kmeans'").collect()}
    assert counts[3].best and not counts[2].best
    assert {r.n for r in learn.grouped_clusters(rows, ["a", "b"], 3).groupBy("cluster").agg(F.countDistinct("a").alias("n")).collect()} == {1}


def test_topics(spark):
    words = [["cat", "dog", "pet"], ["stock", "bond", "fund"]]
    rows = spark.createDataFrame([(k, " ".join(words[k % 2] * 3)) for k in range(40)] + [(40, None)], "id long, text string")
    found = learn.text_topics(rows, "text", k=3, dims=3)
    assert found.count() == 41 and found.where("id < 40").groupBy(F.col("id") % 2).agg(F.countDistinct("topic").alias("n")).where("n != 1").count() == 0


def test_topics_take_texts_apart_once(spark):
    """Fits and scores read the written term counts, so no text is split again in the result's plan."""
    rows = spark.createDataFrame([(k, "cat dog" if k % 2 else "stock bond") for k in range(20)], "id long, text string")
    found = learn.text_topics(rows, "text", k=2, dims=2, keep=["id"])
    assert found.columns == ["id", "topic"] and found.count() == 20 and learn.text_topics(rows, "text", k=2, dims=2).columns == ["id", "text", "topic"]
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_constant_and_empty_labels(spark):
    rows = spark.createDataFrame([(1, 1.0, 1), (2, None, 1), (3, 2.0, None)], "id long, a double, label int")
    assert {r.p for r in learn.fit(rows, ["a"], "label", classify=True).score(rows, "p").collect()} == {1.0}
    assert {r.p for r in learn.fit(rows.limit(0), ["a"], "label").score(rows, "p").collect()} == {0.0}


def test_domain_shift(spark, rows):
    same = learn.domain_shift(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"), ["a", "b"]).first()
    moved = learn.domain_shift(rows, rows.withColumns({"a": F.col("a") * 3 + 2, "b": F.col("b") + F.col("a")}), ["a", "b"]).first()
    assert moved.kl > 5 * same.kl and moved.aligned_gap < 1e-6 < moved.gap


def test_queries_hold_their_orders(spark):
    q = registry.queries()
    assert q["M10_propensity"](spark, SF).where("p_90 > p_365 or p_365 > p_900").count() == 0
    assert q["M2_train_model"](spark, SF).where("score is null").count() == 0


def test_level_two_is_out_of_fold(spark):
    """A row's own fold has no part in its score: a fold with a wild outcome is scored by the other folds' line."""
    data = [(k, "uv"[k % 2], k % 3, float(k % 7), 2.0 * (k % 7) + 1 + (5 if k % 2 else 0) + (1000.0 if k % 3 == 2 else 0.0)) for k in range(210)]
    rows = spark.createDataFrame(data, "id long, seg string, f int, x double, y double")
    found = learn.fold_linear(rows, ["x"], "y", "f", "own", ["seg"]).collect()
    for r in found:
        mean = 2 * r.x + 1 + (5 if r.seg == "v" else 0)
        assert abs(r.own - (mean if r.f == 2 else mean + 500)) < 1e-3
    assert {r.whole for r in learn.fold_linear(rows.limit(0), ["x"], "y", "f", "whole").collect()} == set()
    lone = learn.fold_linear(rows.where("f = 1"), ["x"], "y", "f", "own", ["seg"])
    assert lone.count() == 70 and {r.own for r in lone.collect()} == {0.0}


def test_quality_by_group(spark):
    rng = np.random.default_rng(4)
    data = [(g, float(p), int(rng.random() < p), float(s)) for g in "ab" for p, s in zip(rng.integers(0, 9, 80) / 8, rng.random(80), strict=True)]
    scored = spark.createDataFrame(data, "g string, p double, y int, share double").withColumn("fraction", F.lit(0.5)).withColumn("expected", F.col("p") * 0.5)
    found = {r.part: r for r in learn.two_stage_quality(scored, "y", "share", "g").collect()}
    for part in ("a", "b", "all"):
        own = [r for r in data if part in (r[0], "all")]
        ones, zeros = [r[1] for r in own if r[2]], [r[1] for r in own if not r[2]]
        assert np.isclose(found[part].auc, np.mean([[(a > b) + (a == b) / 2 for b in zeros] for a in ones]))
        assert np.isclose(found[part].brier, np.mean([(r[1] - r[2]) ** 2 for r in own])) and found[part].n == len(own)
        assert np.isclose(found[part].expected_mae, np.mean([abs(r[1] / 2 - r[3]) for r in own]))


def test_clusters_by_group(spark):
    """Each group finds its own centres: the groups' points lie apart in scale."""
    rows = spark.createDataFrame([(k, "uv"[k % 2], float(k % 4 // 2 * (10 if k % 2 else 1000))) for k in range(80)], "id long, seg string, a double")
    found = learn.grouped_clusters(rows, ["a"], 2, by="seg")
    assert {r.n for r in found.groupBy("seg", "cluster").agg(F.countDistinct("a").alias("n")).collect()} == {1}
    assert found.groupBy("seg").agg(F.countDistinct("cluster").alias("n")).where("n != 2").count() == 0 and found.where("distance > 1e-6").count() == 0


def test_horizons_by_group(rows):
    """In one segment the label follows a, in the other -a: only models of their own see that."""
    labelled = rows.withColumn("hit", ((F.col("a") * F.when(F.col("seg") == "u", 1).otherwise(-1)) > 0).cast("int"))
    train, held = halves(labelled)
    own, common = (learn.auc(learn.horizons(train, held, ["a", "b"], {"x": "hit"}, by, 100), "hit", "p_x") for by in ("seg", None))
    assert own > 0.95 and common < 0.7


def test_queries_beat_the_mean(spark):
    q = registry.queries()
    row = q["M15_ensembles"](spark, SF).agg(F.var_pop("price").alias("v"), *[F.avg((F.col(c) - F.col("price")) ** 2).alias(c) for c in ("weighted", "stacked", "segmented")]).first()
    assert all(row[c] < 0.5 * row["v"] for c in ("weighted", "stacked", "segmented"))
    found = {r.part: r for r in q["M7b_two_stage_quality"](spark, SF).collect()}
    assert found["all"].auc > 0.6 and found["all"].brier < 0.25 and sum(r.n for k, r in found.items() if k != "all") == found["all"].n


def test_grouped_clusters_read_rows_that_were_written_once(spark):
    """The result of every group comes from one written table, so no task reads the shuffles behind the rows again."""
    left = spark.range(60).select(F.col("id"), (F.col("id") % 2).alias("g"), (F.col("id") % 3 * 10.0).alias("x"))
    rows = left.join(spark.range(60).select("id", (F.col("id") / 100).alias("y")).hint("merge"), "id")
    found = learn.grouped_clusters(rows, ["x"], 3, by="g")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert found.count() == 60 and found.groupBy("g", "x").agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0
