"""Queries against their SQL on rows that the given tables don't hold: zeros, equal values, values at a threshold."""

import numpy as np
import pandas as pd
import pytest
from compare import rows, views

from tallgrass.operators import aggregates, joins, quantiles
from tallgrass.plans import learn, registry


def agree(spark, folder, name, events):
    """events: (user, hour, kind, value)."""
    user, hour, kind, value = zip(*events, strict=True)
    ts = (pd.Timestamp("2024-01-01") + pd.to_timedelta(hour, unit="h")).astype("datetime64[us]")
    frame = pd.DataFrame({"event_id": range(len(user)), "ts": ts, "user_id": user, "event_type": kind, "value": np.array(value, dtype=float), "props": "{}"})
    frame.to_parquet(folder / "events.parquet")
    found = registry.queries()[name](spark, str(folder)).toPandas()
    expected = views(str(folder)).sql(registry.oracle_sql()[name]).df()
    assert rows(found) == rows(expected)
    return found.set_index("event_id").sort_index()


def test_elasticity_from_zero(spark, tmp_path):
    found = agree(spark, tmp_path, "W14_elasticity", [(1, k, "view", v) for k, v in enumerate([5, 0, 7, 9, 8, 0, 0, 3])])
    assert found.log_elasticity.isna().tolist() == [True, False, True, False, False, False, True, True]


def test_stability_of_equal_values(spark, tmp_path):
    found = agree(spark, tmp_path, "W15_stability", [(1, k, "view", v) for k, v in enumerate([5, 5, 5, 9, 8])] + [(2, k, "view", 3) for k in range(4)] + [(3, 0, "view", 1)])
    assert found.trend_r2.isna().tolist() == [True, True, True, False, False, True, True, True, True, True]


def test_shocks_at_the_threshold(spark, tmp_path):
    """The middle of x - 2d, x, x - d is one deviation from the mean."""
    rng = np.random.default_rng(5)
    events = []
    for user in range(400):
        x, d = rng.integers(5000, 30000) / 100, rng.integers(1, 2000) / 100
        events += [(user, k, "view", round(v, 2)) for k, v in enumerate([x - 2 * d, x, x - d])]
    found = agree(spark, tmp_path, "W26_income_shocks", events)
    assert (found.shock.iloc[1::3] == "none").all()


def test_concentration_of_nothing(spark, tmp_path):
    found = agree(spark, tmp_path, "W28_category_concentration", [(1, 0, "view", 0), (1, 1, "click", 0), (1, 2, "view", 4), (1, 3, "click", 4)])
    assert found.entropy.isna().tolist() == [True, True, False, False] and found.entropy[3] == pytest.approx(np.log(2), abs=1e-4)


def test_cohort_sums_are_exact(spark):
    df = spark.range(3).coalesce(1).selectExpr("1 AS who", "DATE'2024-03-01' AS day", "0.1D AS v")
    found = aggregates.cohort_value(df, "who", "day", "v").first()
    assert (found.n, found.total, found["mean"], found["median"]) == (1, 0.3, 0.3, 0.3)


def test_peers_rule_out_before_the_shuffle(spark, monkeypatch):
    """Sets that share a few of many neighbours: nearly all pairs meet, hardly one is left to be compared on whole sets."""
    rng = np.random.default_rng(9)
    sets = [set(rng.choice(400, 40, replace=False).tolist()) for _ in range(300)]
    sets += [set(list(s)[:36]) | {500 + k for k in range(4)} for s in sets[:20]]
    kept = {}
    settle = joins.settle
    monkeypatch.setattr(joins, "settle", lambda df, name: kept.setdefault(name, settle(df, name)))
    found = {(r.src, r.peer) for r in joins.peers(spark.createDataFrame([(f"n{i}", f"d{x}") for i, s in enumerate(sets) for x in s], "src string, dst string"), 0.4, 5).collect()}
    assert found == {p for i in range(20) for p in ((f"n{i}", f"n{300 + i}"), (f"n{300 + i}", f"n{i}"))}
    assert kept["peer-pairs"].where("src <> peer").count() < 400


def test_groups_dont_meet_in_one_task(spark):
    """Quantiles of a few large groups: the sketch goes to the rows, not the rows to one task a group."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS x")
        found = quantiles.quantiles(df, ["g"], "x", [0.5])
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        assert {r.g: r.q for r in found.collect()} == {0: [499.5], 1: [499.0], 2: [500.0]}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cases_are_written_once(spark):
    """What the fits read again and again has no shuffle behind it."""
    assert "Exchange" not in learn.cases(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
