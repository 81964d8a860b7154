"""Worked cases and edge frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallgrass.functions import scalar
from tallgrass.operators import aggregates, graph, joins, statistics, windows


def day(*a):
    return dt.datetime(2024, *a)


LEFT, RIGHT = "id long, at timestamp", "id long, seen timestamp, v int"


def asof(spark, left, right, **how):
    found = joins.asof(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "id", "at", "seen", ["v"], **how)
    return {(r.id, r.at.day): r.v for r in found.collect()}


def test_asof_takes_the_latest_row_not_after(spark):
    right = [(1, day(1, 1), 10), (1, day(1, 4), 20), (1, day(1, 10), 30), (2, day(1, 20), 5)]
    assert asof(spark, [(1, day(1, 5)), (1, day(1, 10)), (2, day(1, 7))], right) == {(1, 5): 20, (1, 10): 30, (2, 7): None}


def test_asof_strict_and_lookback(spark):
    right = [(1, day(1, 1), 10), (1, day(1, 15), 20)]
    assert asof(spark, [(1, day(1, 15))], right, strict=True) == {(1, 15): 10}
    assert asof(spark, [(1, day(1, 30)), (1, day(1, 14))], right, lookback_days=20) == {(1, 30): 20, (1, 14): 10}
    assert asof(spark, [(1, day(1, 30))], right, lookback_days=10) == {(1, 30): None}


def test_leaks(spark):
    f = spark.createDataFrame([(1, day(1, 1)), (2, day(1, 9))], "id long, seen timestamp")
    labels = spark.createDataFrame([(1, day(1, 5)), (2, day(1, 5))], "id long, due timestamp")
    assert [r.id for r in joins.leaks(f, labels, "id", "seen", "due").collect()] == [2]


def test_biweekly(spark):
    rows = [(1, 14 * 86400 * k, k) for k in range(5)]
    found = aggregates.periodicity(spark.createDataFrame(rows, "e long, sec long, event_id long"), "e", ["sec"]).first()
    assert (found.median_gap, found.gap_cv, found.rhythm) == (14.0, 0.0, "biweekly")


def test_delinquency_history(spark):
    df = spark.createDataFrame([("000000001123",), ("000000123456X",)], "h string").select(scalar.history(F.col("h")).alias("b"))
    first, second = df.select("b", *[c.alias(n) for n, c in scalar.history_features(F.col("b")).items()]).collect()
    assert (first.worst, first.streak, first.worsening, first.improving, first.months_since_worst) == (3, 4, 3, 0, 0)
    assert second.b[:3] == [0, 6, 5]


def test_stability_order(spark):
    rows = [(1, v) for v in (5000.0, 5100.0, 4950.0, 5050.0, 5000.0)] + [(2, v) for v in (2000.0, 5000.0, 1500.0, 8000.0, 3000.0)]
    found = {r.e: r.stability for r in aggregates.deposit_stability(spark.createDataFrame(rows, "e long, v double"), "e", "v").collect()}
    assert found[1] > found[2]


def test_components_core_and_triangles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("y", "y")], "src string, dst string")
    assert {r.id: r.component for r in graph.components(e).collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    assert sorted(r.id for r in graph.core(e, 2).collect()) == ["a", "b", "c"]
    assert {r.id: r.triangles for r in graph.clustering(e).collect()} == {"a": 1, "b": 1, "c": 1, "d": 0, "x": 0, "y": 0}


def test_pagerank_sums_to_one(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    assert graph.pagerank(e, 5).agg(F.sum("rank")).first()[0] == pytest.approx(1)


def test_global_rank_matches_sort(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1009).alias("v"))
    ranked = windows.global_rank(df, ["v"], partitions=7).orderBy("v").collect()
    assert [r.rank for r in ranked] == list(range(1, 1001))


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "label int, p double")
    assert statistics.classification(df, "label", "p").first().auc == pytest.approx((0.5 + 1 + 0 + 1) / 4)


def test_nearest_match(spark):
    df = spark.createDataFrame([(1, 0.50, 10.0, True), (2, 0.47, 1.0, False), (3, 0.51, 2.0, False), (4, 0.99, 5.0, True)], "id long, s double, y double, t boolean")
    found = {r.id: (r.match_id, r.difference) for r in joins.match_nearest(df, F.col("t"), "s", "y", "id", 0.1).collect()}
    assert found == {1: (3, 8.0), 4: (3, 3.0)}


EMPTY = "event_id long, entity_id long, ts timestamp, sec long, day date, category string, amount double, value double"


@pytest.mark.parametrize("run", [
    lambda d: windows.rolling(d, "entity_id", "amount"),
    lambda d: windows.event_features(d, "entity_id", "category", "x"),
    lambda d: windows.amount_clusters(d, "entity_id", "amount"),
    lambda d: windows.volatility(d, "entity_id", "amount", 7),
    lambda d: aggregates.sufficiency(d, "entity_id", "day", F.col("amount") > 0),
    lambda d: aggregates.cohorts(d, "entity_id", "day"),
    lambda d: aggregates.source_consistency(d, "entity_id", "category", ["ts"]),
    lambda d: aggregates.missing_report(d, ["amount"]),
])
@pytest.mark.parametrize("rows", [[], [(1, 1, day(1, 1), 0, dt.date(2024, 1, 1), "x", None, 1.0)]])
def test_edge_frames(spark, run, rows):
    run(spark.createDataFrame(rows, EMPTY)).collect()
