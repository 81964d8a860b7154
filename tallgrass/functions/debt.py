"""Columns of collections: arrears histories, billing cycles, scorecard inputs, affordability, willingness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Grace days by product, and median income by (30-day bucket of days past due, balance tier).
GRACE = {"CC": 20, "CRCARD": 20, "CREDIT_CARD": 20, "SPC": 15, "SPCARD": 15, "SECURED": 15, "PERSONAL": 15}
MEDIAN_INCOME = [
    [15000, 25000, 40000, 70000],
    [12000, 20000, 35000, 60000],
    [10000, 18000, 30000, 55000],
    [8000, 15000, 25000, 45000],
    [7000, 12000, 20000, 35000],
    [6000, 10000, 18000, 30000],
]


def clip(x: Column, low: float, high: float) -> Column:
    """x within low and high; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("long")


def tier(x: Column, edges: list[float]) -> Column:
    """How many of the edges x is above."""
    return sum((flag(x > e) for e in edges), F.lit(0).cast("long"))


def arrears(periods: Column, worst_bucket: Column) -> dict[str, Column]:
    """Features of amounts in arrears, newest period first; unknown periods are null. Without any known period all are 0.

    Trends compare the newest with the third (sixth) period, or the one after where that is unknown; acceleration is the change
    over the newest three less that over the three before. inconsistent: the delinquency history was at bucket 3 or worse and
    there are no arrears."""
    known = F.filter(periods, lambda x: x.isNotNull())
    n, zero = F.size(known), F.lit(0.0)
    at = lambda i: F.coalesce(F.try_element_at(periods, F.lit(i)), zero)
    mean = F.aggregate(known, zero, lambda a, x: a + x) / F.nullif(n, F.lit(0))
    spread = F.sqrt(F.aggregate(F.transform(known, lambda x: (x - mean) * (x - mean)), zero, lambda a, x: a + x) / F.nullif(n, F.lit(0)))
    positive = F.size(F.filter(known, lambda x: x > 0))
    since = lambda i: F.coalesce(F.when(F.try_element_at(periods, F.lit(1)).isNotNull() & (n >= i), at(1) - F.coalesce(F.try_element_at(periods, F.lit(i)), F.try_element_at(periods, F.lit(i + 1)))), zero)
    top = F.coalesce(F.array_max(known), zero)
    return {
        "latest": at(1),
        "largest": top,
        "mean": F.coalesce(mean, zero),
        "volatility": F.when(n > 1, spread).otherwise(zero),
        "nonzero": positive.cast("long"),
        "nonzero_share": F.coalesce(positive / F.nullif(n, F.lit(0)), zero),
        "trend_3": since(3),
        "trend_6": since(6),
        "acceleration": F.when(n >= 6, (at(1) - at(3)) - (at(4) - at(6))).otherwise(zero),
        "recovered": flag((n > 0) & (at(1) == 0) & (F.size(F.filter(F.slice(known, 2, 99), lambda x: x > 0)) > 0)),
        "peak_to_now": F.when(top > 0, at(1) / top).otherwise(zero),
        "inconsistent": flag((worst_bucket >= 3) & (at(1) == 0) & (top == 0)),
    }


def billing_cycle(bill_day: Column, snapshot: Column, grace: Column) -> dict[str, Column]:
    """Due dates around a snapshot day: the bill day of a month, clamped to its end, plus grace days.

    last_due is the newest due date up to the snapshot, next_due the first one after it, of the bills of the three months before
    to the two after (a bill of last month may fall due in this one). phase: 0 on the due day, 1 up to a week, 2 up to 30 days, 3 beyond. All null where bill
    day or snapshot are unknown or the bill day is none."""
    day = F.when(bill_day.between(1, 31), bill_day.cast("int"))

    def due(month: Column) -> Column:
        first = F.add_months(F.trunc(snapshot, "month"), month)
        return F.when(day.isNotNull(), F.date_add(F.least(F.date_add(first, day - 1), F.last_day(first)), grace))

    dates = lambda a, b: F.transform(F.sequence(F.lit(a), F.lit(b)), due)
    last = F.coalesce(F.array_max(F.filter(dates(-3, 0), lambda d: d <= snapshot)), F.when(day.isNotNull(), F.date_sub(snapshot, 30)))
    after = F.coalesce(F.array_min(F.filter(dates(-3, 2), lambda d: d > snapshot)), F.when(day.isNotNull(), F.date_add(snapshot, 30)))
    past = F.datediff(snapshot, last)
    return {
        "due_day": F.dayofmonth(due(F.lit(0))).cast("long"),
        "last_due": last,
        "days_past": past.cast("long"),
        "days_to_next": F.datediff(after, snapshot).cast("long"),
        "phase": F.when(past == 0, 0).when(past <= 7, 1).when(past <= 30, 2).when(past > 30, 3).cast("long"),
    }


def grace_of(product: Column, grace: dict[str, int] = GRACE, other: int = 20) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in grace.items() for x in kv])[F.upper(product)], F.lit(other))


def willingness(payments_12m: Column, kept_rate: Column, call_rate: Column, message_rate: Column, days_since_payment: Column) -> Column:
    """How readily a debtor engages: payments (30), promises kept (25), answered calls (20) and messages (15), and a recent
    payment (10), as a share of 100. Unknown parts count as 0, an unknown payment day as long ago."""
    known = lambda x: F.coalesce(x, F.lit(0.0))
    recent = F.greatest(F.lit(0.0), 1 - F.coalesce(days_since_payment, F.lit(999)) / 365)
    return (known(payments_12m) / 12 * 30 + known(kept_rate) * 25 + known(call_rate) * 20 + known(message_rate) * 15 + recent * 10) / 100


def affordability(predicted: Column, secured_payment: Column, instalments: Column, last_payment: Column, paid_12m: Column, days_past_due: Column, balance: Column) -> dict[str, Column]:
    """Income by the first of five tiers that is known and positive: a model's, secured loan payments / 0.35, instalments /
    0.40, the last payment / 0.15, the median of the debtor's bucket and balance tier. From it obligations (instalments, else
    a twelfth of what was paid), living costs (35 %), what is left, capacity (60 % of that), and debt service ratio."""
    positive = lambda x: F.when(x > 0, x)
    bucket, level = F.least(F.lit(5), F.floor(F.coalesce(days_past_due, F.lit(0)) / 30)), sum((flag(balance >= e) for e in (1000, 5000, 10000)), F.lit(0).cast("long"))
    median = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in MEDIAN_INCOME])
    tiers = [positive(predicted), positive(secured_payment) / 0.35, positive(instalments) / 0.40, positive(last_payment) / 0.15, F.element_at(F.element_at(median, (bucket + 1).cast("int")), (level + 1).cast("int"))]
    income = F.coalesce(*tiers)
    which = F.coalesce(*[F.when(t.isNotNull(), k) for k, t in enumerate(tiers, 1)]).cast("long")
    owed = F.coalesce(instalments, F.coalesce(paid_12m, F.lit(0.0)) / 12)
    left, ratio = F.greatest(F.lit(0.0), income - owed - income * 0.35), owed / F.greatest(F.lit(1.0), income)
    confidence = F.when(which == 1, "high").when(which <= 3, "medium").otherwise("low")
    return {"income": income, "tier": which, "confidence": confidence, "obligations": owed, "living": income * 0.35, "disposable": left, "capacity": left * 0.60, "dsr": ratio, "over_indebted": ratio > 0.40}


def scorecard_inputs(c: dict[str, Column], as_of: Column) -> dict[str, Column]:
    """Inputs of a recovery scorecard from dpd, balance, last_payment, paid_count, paid_total, last_paid, contacts, response,
    kept, last_contact, offered, accepted, active; days are counted back from as_of. Unknown amounts and counts are 0."""
    x = {k: F.coalesce(v, F.lit(0.0)) for k, v in c.items() if k not in ("last_paid", "last_contact")}
    dpd, balance = F.greatest(F.lit(0.0), x["dpd"]), F.greatest(F.lit(0.0), x["balance"])
    share = lambda a, b, most: F.coalesce(clip(a / F.nullif(b, F.lit(0.0)), 0, most), F.lit(0.0))
    since = lambda day, most: F.coalesce(clip(F.datediff(as_of, day).cast("double"), 0, most), F.lit(float(most)))
    paid, contact = since(c["last_paid"], 730), since(c["last_contact"], 365)
    accepted = share(x["accepted"], x["offered"], 1)
    return {
        "dpd_norm": F.least(F.lit(1.0), dpd / 720), "log_dpd": F.log1p(dpd), "is_sm": flag(dpd.between(31, 90)), "is_npl": flag(dpd.between(91, 180)), "is_chargeoff": flag(dpd > 180),
        "dpd_bucket": tier(dpd, [0, 30, 60, 90, 180]), "log_balance": F.log1p(balance), "balance_tier": tier(balance, [999, 4999, 9999, 49999]),
        "log_last_payment": F.log1p(F.greatest(F.lit(0.0), x["last_payment"])), "last_pay_to_balance": share(x["last_payment"], x["balance"], 2), "has_paid": flag(x["paid_count"] > 0),
        "payment_freq": clip(x["paid_count"], 0, 24) / 24, "recovery_rate": share(x["paid_total"], x["balance"], 2), "days_since_payment": paid, "days_since_pay_norm": paid / 730,
        "paid_90d": flag(paid <= 90), "paid_180d": flag(paid <= 180), "contacts_norm": clip(x["contacts"], 0, 30) / 30, "high_contact": flag(x["contacts"] > 10),
        "responsive": flag(x["response"] > 0.2), "reliable": flag(x["kept"] > 0.6), "days_since_contact": contact, "fresh_contact": flag(contact <= 7),
        "accept_rate": accepted, "high_accept": flag(accepted > 0.5), "active_settlement": flag(x["active"] > 0),
    }


PERSONAS = ("high_value_cooperative", "high_value_unresponsive", "medium_value_willing", "medium_value_struggling", "low_value_chronic", "promise_keeper", "standard")


def next_action_inputs(c: dict[str, Column]) -> dict[str, Column]:
    """Inputs of a next-best-action model from dpd, balance, limit, due_30d, minimum_due, paid_7d, paid_14d, paid_30d,
    days_since_payment, last_payment, fatigue, accept_rate, kept_rate, plan_rate, line_rate, sms_rate, days_since_contact,
    contacts_7d and persona. Unknown amounts and counts are 0, unknown utilisation one half."""
    x = {k: F.coalesce(v, F.lit(0.0)) for k, v in c.items() if k != "persona"}
    dpd, balance = F.greatest(F.lit(0.0), x["dpd"]), F.greatest(F.lit(0.0), x["balance"])
    share = lambda a, b, most, none=0.0: F.coalesce(clip(a / F.nullif(b, F.lit(0.0)), 0, most), F.lit(none))
    return {
        "dpd_norm": F.least(F.lit(1.0), dpd / 360), "bucket": F.least(F.lit(5), F.floor(dpd / 30)).cast("long"), "is_current": flag(dpd == 0), "is_early": flag(dpd.between(1, 60)), "is_late": flag(dpd > 90), "log_dpd": F.log1p(dpd),
        "minimum_coverage": share(x["due_30d"], x["minimum_due"], 3), "paid_7d": flag(x["paid_7d"] > 0), "paid_14d": flag(x["paid_14d"] > 0), "paid_30d": flag(x["paid_30d"] > 0),
        "days_since_pay_norm": clip(x["days_since_payment"], 0, 180) / 180, "last_pay_to_balance": share(x["last_payment"], x["balance"], 2),
        "fatigue": x["fatigue"], "high_fatigue": flag(x["fatigue"] >= 0.70), "medium_fatigue": flag(x["fatigue"].between(0.40, 0.70)), "fresh": flag(x["fatigue"] < 0.20),
        "high_accept": flag(x["accept_rate"] > 0.5), "reliable_promise": flag(x["kept_rate"] > 0.7), "completes_plans": flag(x["plan_rate"] > 0.6),
        "log_balance": F.log1p(balance), "balance_tier": tier(balance, [999, 4999, 9999, 49999]), "utilisation": share(x["balance"], x["limit"], 1, 0.5),
        "line_better": flag(x["line_rate"] > x["sms_rate"]), "days_since_contact_norm": clip(x["days_since_contact"], 0, 90) / 90, "contacts_norm": clip(x["contacts_7d"], 0, 10) / 10,
        **{f"persona_{p}": flag(c["persona"] == p) for p in PERSONAS},
    }
