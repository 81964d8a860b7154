"""Matrices with states that nothing leaves, triggers, blocked treatments, scores at their ends."""

import numpy as np
from pyspark.sql import functions as F

from tallgrass.operators import stability as t
from tallgrass.operators import statistics as v


def test_absorbing_rows(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "b"), (1, 4, "end"), (2, 1, "a")], "id int, k int, s string")
    found = {(r.from_state, r.to_state): r.probability for r in t.transition_matrices(rows, "id", ["k"], "s", ["a", "b", "end"]).collect()}
    assert found == {("a", "a"): 0, ("a", "b"): 1, ("a", "end"): 0, ("b", "a"): 0, ("b", "b"): 0.5, ("b", "end"): 0.5, ("end", "a"): 0, ("end", "b"): 0, ("end", "end"): 1}
    smooth = t.transition_matrices(rows, "id", ["k"], "s", ["a", "b", "end"], 1.0).groupBy("from_state").agg(F.sum("probability").alias("p")).collect()
    assert all(np.isclose(r.p, 1) for r in smooth)


def test_steady_and_wild_incomes(spark):
    day = "date_add(date'2024-01-01', k)"
    rows = spark.range(24).selectExpr("id % 2 AS who", "CAST(id / 2 AS INT) AS k").selectExpr("who", f"{day} AS day", "CASE WHEN who = 0 THEN 100.0 + k ELSE 100.0 * (k % 3) END AS v", "CASE WHEN who = 0 THEN 'x' ELSE CAST(k AS STRING) END AS s")
    found = {r.who: r for r in t.stability_scores(rows, "who", ["day"], "day", "v", "s").collect()}
    assert found[0].stable and np.isclose(found[0].r2, 1) and found[0].irregularity < 0.02
    assert np.isclose(found[0].forecast_3, 100 + 11 + 3) and found[0].employment == 1 - 1 / 12
    assert not found[1].stable and found[1].employment == 0 and found[1].overall < found[0].overall
    assert t.stability_scores(rows.where("day < '2024-01-06'"), "who", ["day"], "day", "v", "s").count() == 0


def test_blocked_and_exploring(spark):
    rows = spark.createDataFrame([(1, 0.5, 0.9, 100.0, True, False), (2, 0.5, 0.9, 100.0, False, False), (3, 0.5, 0.9, 100.0, False, True)], "id int, p double, q double, owed double, young boolean, explore boolean")
    found = {r.id: (r.action, r.explored) for r in t.treatment_values(rows, "id", {"call": ("p", 1.0), "legal": ("q", 5.0)}, "owed", {"legal": F.col("young")}, F.col("explore")).collect()}
    assert found == {1: ("call", False), 2: ("legal", False), 3: ("call", True)}


def test_relative_residuals_cover(spark):
    rng = np.random.default_rng(1)
    p = rng.uniform(10, 1000, 4000)
    rows = spark.createDataFrame([(k, float(x), float(x * (1 + 0.2 * e))) for k, (x, e) in enumerate(zip(p, rng.normal(size=4000), strict=True))], "id long, p double, y double")
    a, b = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    relative, absolute = v.conformal(a, b, "y", "p", 0.1, True).first(), v.conformal(a, b, "y", "p", 0.1).first()
    assert 0.87 < relative.coverage < 0.93 and 0.87 < absolute.coverage < 0.93 and relative.mean_width < absolute.mean_width
    assert np.isclose(relative.half_width, np.quantile(np.abs(rng.normal(size=100_000)) * 0.2, 0.9), rtol=0.1)


def test_psi_of_equal_parts_is_nothing(spark):
    rows = spark.range(400).selectExpr("CAST(id % 40 AS DOUBLE) AS x", "CASE WHEN id < 200 THEN 'u' ELSE 'v' END AS seg", "CAST(id % 2 AS STRING) AS per")
    assert t.psi_parts(rows, rows, ["x"], "seg", "per").where("part != 'period' AND abs(psi) > 1e-9").count() == 0
    moved = rows.withColumn("x", F.when(F.col("seg") == "v", F.col("x") + 100).otherwise(F.col("x")))
    found = {(r.part, r.key): r.light for r in t.psi_parts(rows, moved, ["x"], "seg", "per").collect()}
    assert (found["segment", "u"], found["segment", "v"]) == ("green", "red")
