"""Curves, offer trees, candidate grids, shares of capacity and prediction tables against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.functions import curves as c
from tallgrass.operators import offers as o
from tallgrass.operators import ranking, windows
from tallgrass.plans import registry
from tallgrass.sources import store
from tallgrass.sources.scratch import shared_path


def pooled(values, weights):
    blocks = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, w, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + n]
    return [s / w for s, w, n in blocks for _ in range(n)]


def test_isotonic_against_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=n).round(1).tolist(), rng.integers(1, 4, n).astype(float).tolist()) for k, n in enumerate([0, 1, 2, *rng.integers(3, 15, 60)])]
    df = spark.createDataFrame(rows, "id int, v array<double>, w array<double>").withColumn("fit", c.isotonic(F.col("v"), F.col("w")))
    for r in df.collect():
        assert np.allclose(r.fit, pooled(r.v, r.w)) and all(np.diff(r.fit) >= -1e-12)


def test_curve_between_and_beyond_its_points(spark):
    x = [0.0, 3.0, 6.0, 9.0, 60.0, 99.0]
    df = spark.createDataFrame([(v,) for v in x], "x double").select(c.interpolated(c.points(o.REDEFAULT["SM"]), F.col("x")).alias("y"))
    assert np.allclose([r.y for r in df.collect()], [0, 0.075, 0.15, 0.2, 0.52, 0.52])


def test_constant_worth_is_the_expression(spark):
    for stage in o.REDEFAULT:
        got = spark.range(1).select(*[c.survival_factor(c.points(o.REDEFAULT[stage]), F.lit(t), 0.12).alias(f"t{t}") for t in (1, 12, 60)]).first()
        assert np.allclose(list(got), [o.worth(o.REDEFAULT[stage], t, 0.12) for t in (1, 12, 60)])


def test_looked_up_worth_is_the_expression(spark):
    """Also without a month, for stages without a curve of their own and beyond the table."""
    rows = spark.createDataFrame([(s, t) for s in ("SM", "NPL", "CHARGEOFF", "?", None) for t in (None, 0, 1, 7, 66, 120, 121)], "stage string, tenor int")
    found = rows.select(o.worth_of(F.col("stage"), F.col("tenor")).alias("a"), c.survival_factor(o.curve_of(F.col("stage")), F.col("tenor"), 0.12).alias("b")).collect()
    assert all((r.a is None and r.b is None) or np.isclose(r.a, r.b, rtol=1e-12) for r in found) and sum(r.a is None for r in found) == 5


@pytest.mark.parametrize("name", ["J10_offer_grid", "F7_loan_npv"])
def test_offers_use_all_cores(spark, name):
    """The accounts are one small file, which a scan takes in one task."""
    found = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_best_candidate_is_the_best_of_all(spark):
    rows = [(k, stage, float(b), float(cap), w) for k, (stage, b, cap, w) in enumerate([("SM", 1000, 50, 0.2), ("NPL", 90000, 0, 0.9), ("CHARGEOFF", 20000, 900, 0.5), ("NPL", 100, 10, 0.5)])]
    found = o.offer_grid(spark.createDataFrame(rows, "id int, stage string, owed double, capacity double, will double"), "stage", "owed", "capacity", "will").orderBy("id").collect()
    for r, (_, stage, owed, capacity, will) in zip(found, rows, strict=True):
        values = []
        for kind, h, rate, t in o.grid(stage):
            m = rate / 12
            pay = owed * (1 - h) * m / (1 - (1 + m) ** -t) if m else owed * (1 - h) / t
            light = max(0.10 - min(pay / capacity, 3) * 0.08, -0.15) if capacity else -0.10
            chance = min(0.92, max(0.02, o.TAKE_UP[kind] + h * 0.25 + o.STAGE_EFFECT[stage] + light + (will - 0.5) * 0.2))
            values.append(chance * max(0.0, pay * o.worth(o.REDEFAULT[stage], t, 0.12) - owed * h - 500))
        assert np.isclose(r.best.expected, max(values)) and r.candidates == len(values)
        assert (r.best.type, r.best.haircut, r.best.rate, r.best.tenor) == o.grid(stage)[int(np.argmax(np.round(values, 9)))]
        assert r.within_policy == (r.best.haircut <= o.AUTO_APPROVED[stage]) and (r.reason is None) == r.within_policy


def test_tree_takes_the_first_rule_and_survives_nulls(spark):
    tree = [o.Leaf("ltp > 0.5", "settlement", (20, 40)), o.Leaf("ltp > 0.1", "payment_plan", (0, 10), (6, 12))]
    rows = spark.createDataFrame([(1, 0.6, 1.0, 100.0), (2, 0.2, 0.5, 100.0), (3, None, None, None), (4, 0.0, 0.0, 50.0)], "id int, ltp double, atp double, balance double")
    found = {r.id: r.offer for r in o.offer_tree(rows, tree).collect()}
    assert [found[k].rule for k in (1, 2, 3, 4)] == [1, 2, 0, 0]
    assert np.isclose(found[1].discount, 24) and np.isclose(found[1].amount, 76) and np.isclose(found[1].roi, (76 * 0.3 - 25) / 25)
    assert found[2].months == 9 and np.isclose(found[2].monthly, 92 / 9) and found[3].kind == "payment_reminder" and found[3].recovery is None


@pytest.mark.parametrize("seed", range(3))
def test_share_capacity_against_a_plain_loop(spark, seed):
    rng = np.random.default_rng(seed)
    n, names = 120, ["a", "b", "c"]
    value = {k: {m: (None if rng.random() < 0.15 else float(rng.integers(0, 12))) for m in names} for k in range(n)}
    shares = {"a": 0.1, "b": 0.25, "c": 0.3} if seed else {"a": 0.2}
    room = {m: int(n * s + 1e-9) for m, s in shares.items()}
    wish = {k: sorted((m for m in names if v[m] is not None), key=lambda m, v=v: (-v[m], m)) for k, v in value.items()}
    held, free = {m: [] for m in names}, [k for k in range(n) if wish[k]]
    at = dict.fromkeys(range(n), 0)
    while free:
        k = free.pop()
        m = wish[k][at[k]]
        held[m] = sorted([*held[m], k], key=lambda x, m=m: (-value[x][m], x))
        if m in room and len(held[m]) > room[m]:
            out = held[m].pop()
            at[out] += 1
            if at[out] < len(wish[out]):
                free.append(out)
    expected = {k: m for m, ks in held.items() for k in ks}
    df = spark.createDataFrame([(k, *[value[k][m] for m in names]) for k in range(n)], "id int, a double, b double, c double")
    found = ranking.share_capacity(df, "id", {m: F.col(m) for m in names}, shares)
    assert {r.id: r.final for r in found.collect()} == {k: expected.get(k, "NONE") for k in range(n)}


def test_prediction_batches_replace_and_correct(spark):
    path, ts = shared_path(spark, "p"), "timestamp'2024-01-0{} 00:00:00'"
    row = lambda v, day, p: spark.sql(f"SELECT 1 AS id, '{v}' AS version, {ts.format(day)} AS made_at, {p}e0 AS p")
    put = lambda df, batch: store.put_predictions(df, path, batch, "id", "version", "made_at", "p")
    put(row("v1", 1, 0.1), 0)
    put(row("v2", 3, 0.2), 1)
    put(row("v2", 3, 0.3), 1)
    put(row("v1", 1, 0.4), 5)
    put(row("v1", 1, 0.9), 2)
    asked = spark.sql(f"SELECT 1 AS id, {ts.format(2)} AS ts UNION ALL SELECT 1, {ts.format(4)} UNION ALL SELECT 2, {ts.format(4)}")
    found = {(r.id, r.ts.day): (r.version, r.prediction) for r in store.attach_predictions(asked, path, "id", "ts").collect()}
    assert found == {(1, 2): ("v1", 0.4), (1, 4): ("v2", 0.3), (2, 4): (None, None)}
    assert {r.prediction for r in store.attach_predictions(asked, path, "id", "ts", "v1").collect()} == {0.4, None}


def test_sequences_are_padded_cut_and_coded(spark):
    rows = spark.createDataFrame([(1, 10, 1.0, "x"), (1, 40, 3.0, "y"), (1, 45, 5.0, "z"), (2, 7, 2.0, None)], "id int, t int, v double, k string")
    codes = windows.sequence_codes(rows.unionByName(rows.where("k = 'y'")), "k", 2)
    moments = spark.createDataFrame([(1.0, 2.0)], "mean double, sd double")
    run = lambda n, before: {r.id: (r.used, r["values"], r.gaps, r.codes) for r in windows.event_sequences(rows, codes, moments, "id", "t", ["t"], "v", "k", n, before).collect()}
    assert run(2, True) == {1: (2, [1.0, 2.0], [0, 5], [1, 0]), 2: (1, [0.0, 0.5], [0, 0], [0, 0])}
    assert run(4, False) == {1: (3, [0.0, 1.0, 2.0, 0.0], [0, 30, 5, 0], [2, 1, 0, 0]), 2: (1, [0.5, 0.0, 0.0, 0.0], [0, 0, 0, 0], [0, 0, 0, 0])}
