"""Calibration maps on rows they haven't seen, samples that can and can't be told apart, choices of models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import ensembles as e
from tallgrass.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    """The outcome's chance is the root of the score, so the score is far too low."""
    rng = np.random.default_rng(2)
    p = rng.random(4000)
    return spark.createDataFrame([(k, float(x * x), int(rng.random() < x)) for k, x in enumerate(p)], "id long, p double, y int").cache()


def gap(rows, column):
    """Mean distance of mean score and mean outcome over tenths of the score."""
    g = rows.groupBy(F.floor(F.least(F.lit(0.999), F.col(column)) * 10).alias("b")).agg(F.count("*").alias("n"), F.avg(column).alias("p"), F.avg("y").alias("y")).toPandas()
    return float((g.n * (g.p - g.y).abs()).sum() / g.n.sum())


def test_maps_mend_rows_they_have_not_seen(scored):
    found = e.calibrated(scored.where("id % 2 = 0"), scored.where("id % 2 = 1"), "p", "y").cache()
    assert found.count() == 2000 and gap(found, "p") > 0.12
    assert gap(found, "isotonic") < 0.05 and gap(found, "sigmoid") < 0.06
    rows = found.orderBy("p").select("isotonic", "sigmoid").toPandas()
    assert (np.diff(rows.isotonic) >= -1e-12).all() and (np.diff(rows.sigmoid) >= -1e-12).all()


def test_query_calibrates_the_other_half(spark):
    found = registry.queries()["V13_isotonic_calibration"](spark, SF)
    assert found.where("id % 2 = 0").count() == 0
    rows = found.withColumn("y", F.col("label")).cache()
    assert max(gap(rows, "isotonic"), gap(rows, "sigmoid")) < gap(rows, "p")


def test_adversarial_variants(spark):
    found = {(r.variant, r.feature): r for r in registry.queries()["V19_adversarial"](spark, SF).collect()}
    assert len(found) == 12
    assert {r.verdict for (v, _), r in found.items() if v == "sampling"} == {"alike"} and abs(found["sampling", "l_tax"].auc - 0.5) < 0.08
    biased = {f: r for (v, f), r in found.items() if v == "biased"}
    assert biased["l_quantity"].verdict == "different" and max(biased.values(), key=lambda r: r.drop).feature == "l_quantity"
    assert abs(sum(r.importance for r in biased.values()) - 1) < 1e-6


def test_adversarial_without_rows(spark):
    rows = spark.createDataFrame([(1, 1.0)], "id int, a double")
    assert [r.verdict for r in e.adversarial(rows, rows.limit(0), ["a"], ["id"]).collect()] == ["unknown"]


def test_choice_prefers_unlike_models(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 500)
    good = y + rng.normal(size=500)
    data = [(int(y[k]), float(good[k]), float(good[k] + 0.01), float(y[k] + rng.normal() * 1.3)) for k in range(500)]
    rows = spark.createDataFrame(data, "y int, a double, twin double, other double")
    assert [r.model for r in e.diverse_subset(rows, ["a", "twin", "other"], "y", 2, 0.5).orderBy("place").collect()] == ["a", "other"]
    assert [r.model for r in e.diverse_subset(rows, ["a", "twin", "other"], "y", 3, 0.0).orderBy("place").collect()] == ["a", "twin", "other"]


def test_separation(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "id int, v array<double>")
    pairs = spark.createDataFrame([(1, 2, True), (1, 3, False), (2, 3, False), (1, 4, False)], "a int, b int, linked boolean")
    r = e.pair_separation(vectors, pairs, "id", "v").first()
    assert (r.n_linked, r.n_unlinked, r.above) == (1, 3, 1.0) and r.separation > 0.9
