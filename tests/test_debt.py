"""Collections columns on rows with unknown parts, by hand."""

import datetime

from pyspark.sql import functions as F

from tallgrass.functions import debt as d
from tallgrass.operators import contacts as k


def one(spark, columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_unknown_stays_unknown(spark):
    none = F.lit(None).cast("double")
    assert one(spark, {"a": d.clip(none, 0, 1), "b": d.flag(none > 1), "c": d.tier(none, [1, 2]), "d": d.clip(F.lit(5.0), 0, 1)}).asDict() == {"a": None, "b": 0, "c": 0, "d": 1.0}


def test_arrears_by_hand(spark):
    p = F.array(*[F.lit(x).cast("double") for x in (0.0, 50.0, None, 20.0, 10.0, 5.0, 0.0, 0.0, 0.0)])
    r = one(spark, d.arrears(p, F.lit(1)))
    assert (r.latest, r.largest, r.nonzero, r.trend_3, r.trend_6, r.acceleration, r.recovered, r.inconsistent) == (0, 50, 4, -20, -5, -15, 1, 0)
    for empty in (F.array().cast("array<double>"), F.array(F.lit(None).cast("double"))):
        r = one(spark, d.arrears(empty, F.lit(3)))
        assert {v for n, v in r.asDict().items() if n != "inconsistent"} == {0} and r.inconsistent == 1


def test_billing_cycle_at_month_ends(spark):
    day = lambda x: F.lit(x).cast("date")
    r = one(spark, d.billing_cycle(F.lit(31), day("2024-03-20"), F.lit(20)))
    assert r.last_due == datetime.date(2024, 3, 20) and (r.days_past, r.phase, r.days_to_next, r.due_day) == (0, 0, 31, 20)
    r = one(spark, d.billing_cycle(F.lit(30), day("2023-03-19"), F.lit(20)))  # the bill of 28 February falls due on 20 March
    assert r.last_due == datetime.date(2023, 2, 19) and (r.days_past, r.phase, r.days_to_next) == (28, 2, 1)
    assert set(one(spark, d.billing_cycle(F.lit(40), day("2023-03-19"), F.lit(20))).asDict().values()) == {None}


def test_income_tiers(spark):
    x = lambda v: F.lit(v).cast("double")
    rows = [(100.0, 70.0, 40.0, 15.0), (0.0, 70.0, 40.0, 15.0), (None, None, 40.0, 15.0), (None, None, None, 15.0), (None, None, None, None)]
    got = [one(spark, d.affordability(x(a), x(b), x(c), x(e), x(120.0), F.lit(95), x(6000.0))) for a, b, c, e in rows]
    assert [r.tier for r in got] == [1, 2, 3, 4, 5] and [round(r.income, 6) for r in got] == [100, 200, 100, 100, 25000]
    assert got[3].obligations == 10 and [r.over_indebted for r in got] == [False, False, False, False, False]


def test_strategy_without_history(spark):
    accounts = spark.createDataFrame([(1, "new_high_value", 100.0), (2, "x", 100.0), (3, None, 50.0)], "id int, persona string, balance double")
    history = spark.createDataFrame([("x", "sms", "plan", 10, "9", 5.0, 100.0), ("x", "call", "plan", 20, "9", 50.0, 100.0)], "persona string, channel string, offer string, discount int, hour string, got double, owed double")
    found = {r.id: r for r in k.persona_strategy(accounts, history.withColumnRenamed("owed", "balance"), "persona", ["channel", "offer", "discount", "hour"], "got", "balance", {"call": 5.0}).collect()}
    assert (found[1].channel, found[1].discount, found[1].roi, found[1].known) == ("call", 50, 200.0, False)
    assert (found[2].channel, found[2].recovery, found[2].roi) == ("call", 50.0, 900.0)
    assert (found[3].channel, found[3].discount) == ("sms", 20)
