"""Offers: decision trees given as rows, candidate grids and the value of loans under survival curves.

All of it is expressions on the row: the grid of a stage is a literal array, so an account is never multiplied."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.curves import Curve, instalment, interpolated, points, survival_factor

#: Cumulative share of new defaults by month, and policy by stage.
REDEFAULT = {
    "SM": {6: 0.15, 12: 0.25, 24: 0.35, 36: 0.42, 48: 0.48, 60: 0.52},
    "NPL": {6: 0.25, 12: 0.40, 24: 0.55, 36: 0.63, 48: 0.70, 60: 0.75},
    "CHARGEOFF": {6: 0.35, 12: 0.55, 24: 0.70, 36: 0.78, 48: 0.83, 60: 0.87},
}
RATE = {"SM": 0.15, "NPL": 0.10, "CHARGEOFF": 0.0}
MAX_HAIRCUT = {"SM": 0.20, "NPL": 0.40, "CHARGEOFF": 0.65}
AUTO_APPROVED = {"SM": 0.10, "NPL": 0.20, "CHARGEOFF": 0.40}
STAGE_EFFECT = {"SM": 0.05, "NPL": 0.0, "CHARGEOFF": -0.08}
TENORS = (12, 24, 36, 48, 60)
SETTLEMENTS = (0.10, 0.20, 0.30, 0.40, 0.50, 0.60)
TAKE_UP = {"FULL_SETTLEMENT": 0.22, "PARTIAL_SETTLEMENT": 0.32, "RESCHEDULE_SAME_RATE": 0.40, "RESCHEDULE_RATE_REDUCE": 0.52, "FEE_WAIVER": 0.45, "FULL_RESTRUCTURE": 0.58}
ACCEPTANCE = {"settlement": 0.30, "payment_plan": 0.40}
COST = {"settlement": 25.0, "payment_plan": 30.0, "legal_action": 200.0, "debt_sale": 5.0, "payment_reminder": 2.0}


@dataclass(frozen=True)
class Leaf:
    """A rule of an offer tree: where it holds, and what kind of offer with which ranges follows."""

    when: str
    kind: str
    discount: tuple[float, float] = (0.0, 0.0)
    months: tuple[int, int] = (0, 0)


@dataclass(frozen=True)
class Scores:
    """Columns with willingness and ability to pay, and a model's acceptance by kind of offer, where there is one."""

    willing: str = "ltp"
    able: str = "atp"
    balance: str = "balance"
    acceptance: dict[str, str] = field(default_factory=dict)


def offer_tree(df: DataFrame, tree: list[Leaf], by: Scores = Scores()) -> DataFrame:
    """df with offer: kind, discount in percent, amount, months, monthly, acceptance, recovery, cost, roi and the rule's number.

    The first rule that holds counts (0: none, a reminder). A settlement's discount falls from the top of its range as both
    scores rise; a plan's length falls as ability rises and its discount as willingness rises. Recovery is the amount, or the
    balance where the kind has none, times acceptance."""
    willing, able, balance = F.col(by.willing), F.col(by.able), F.col(by.balance)
    none = F.lit(None)

    def leaf(number: int, rule: Leaf) -> Column:
        low, high = rule.discount
        months = none.cast("int")
        amount = monthly = none.cast("double")
        discount = F.lit(0.0)
        if rule.kind == "settlement":
            discount = high - (willing + able) / 2 * (high - low)
            amount = balance * (1 - discount / 100)
        elif rule.kind == "payment_plan":
            months = F.floor(rule.months[0] + (1 - able) * (rule.months[1] - rule.months[0])).cast("int")
            discount = (1 - willing) * high
            monthly = balance * (1 - discount / 100) / months
        elif rule.kind == "debt_sale":
            discount, amount = F.lit(90.0), balance * 0.10
        else:
            amount = balance
        accepted = F.col(by.acceptance[rule.kind]) if rule.kind in by.acceptance else F.lit(ACCEPTANCE.get(rule.kind, 0.20))
        cost, recovery = COST.get(rule.kind, 10.0), F.coalesce(amount, balance) * accepted
        return F.struct(
            F.lit(number).alias("rule"), F.lit(rule.kind).alias("kind"), discount.alias("discount"), amount.alias("amount"), months.alias("months"), monthly.alias("monthly"),
            accepted.alias("acceptance"), recovery.alias("recovery"), F.lit(cost).alias("cost"), ((recovery - cost) / cost).alias("roi"),
        )

    offer = leaf(0, Leaf("true", "payment_reminder"))
    for number in range(len(tree), 0, -1):
        offer = F.when(F.expr(tree[number - 1].when), leaf(number, tree[number - 1])).otherwise(offer)
    return df.withColumn("offer", offer)


def grid(stage: str) -> list[tuple[str, float, float, int]]:
    """(type, haircut, yearly rate, months) of a stage's candidates that policy admits."""
    rate, most = RATE[stage], MAX_HAIRCUT[stage]
    return [
        *(("FULL_SETTLEMENT", h, 0.0, 1) for h in SETTLEMENTS if h <= most * 1.5 + 1e-9),
        *(("RESCHEDULE_RATE_REDUCE", 0.0, rate * (1 - cut), t) for cut in (0.25, 0.50, 0.75, 1.00) for t in TENORS),
        *(("RESCHEDULE_SAME_RATE", 0.0, rate, t) for t in TENORS),
        *(("FULL_RESTRUCTURE", h, rate * 0.50, t) for h in (0.10, 0.20) if h <= most for t in (36, 48, 60)),
    ]


def loan(outstanding: Column, haircut: Column, rate: Column, tenor: Column, redefault: Column, waived: Column, annual: float = 0.12, processing: float = 500.0, factor: Column | None = None) -> Column:
    """instalment, pv, concession, npv and redefault_12m of a loan after a haircut; redefault is the stage's curve as data,
    factor what an instalment of 1 is worth, where that is known (worth_of)."""
    monthly = instalment(outstanding * (1 - haircut), rate, tenor)
    factor = survival_factor(redefault, tenor, annual) if factor is None else factor
    pv, concession = monthly * factor, outstanding * haircut + waived + processing
    return F.struct(monthly.alias("instalment"), pv.alias("pv"), concession.alias("concession"), (pv - concession).alias("npv"), interpolated(redefault, F.lit(12.0)).alias("redefault_12m"))


def curve_of(stage: Column, curves: dict[str, Curve] = REDEFAULT, other: str = "NPL") -> Column:
    """The curve of the row's stage."""
    out = points(curves[other])
    for name, curve in curves.items():
        out = F.when(stage == name, points(curve)).otherwise(out)
    return out


def take_up(base: Column, monthly: Column, capacity: Column, stage: Column, willing: Column) -> Column:
    """Chance that an offer is accepted: a base by type and haircut, more for willingness and light instalments."""
    effect = F.coalesce(F.create_map(*[F.lit(x) for kv in STAGE_EFFECT.items() for x in kv])[stage], F.lit(0.0))
    light = F.when(capacity > 0, F.greatest(F.lit(-0.15), 0.10 - F.least(F.lit(3.0), monthly / capacity) * 0.08)).otherwise(-0.10)
    return F.greatest(F.lit(0.02), F.least(F.lit(0.92), base + effect + light + (willing - 0.5) * 0.20))


def worths(curve: Curve, tenor: int, annual: float) -> list[float]:
    """survival_factor of known numbers for 1 to tenor months, when the plan is made."""
    knots = sorted(({0: 0.0} | curve).items())

    def redefault(t: int) -> float:
        for (a, low), (b, high) in zip(knots, knots[1:], strict=False):
            if t <= b:
                return low + (high - low) * (t - a) / (b - a)
        return knots[-1][1]

    return list(accumulate(max(0.0, 1 - redefault(t)) * (1 + annual) ** (-t / 12) for t in range(1, tenor + 1)))


def worth(curve: Curve, tenor: int, annual: float) -> float:
    """The last of worths: one for each stage and tenor."""
    return worths(curve, tenor, annual)[-1]


def worth_of(stage: Column, tenor: Column, curves: dict[str, Curve] = REDEFAULT, other: str = "NPL", annual: float = 0.12, most: int = 120) -> Column:
    """survival_factor of the row's stage, looked up for 1 to most months and added up month by month beyond."""
    known = lambda name: F.array(*[F.lit(x) for x in worths(curves[name], most, annual)])
    table = known(other)
    for name in curves:
        table = F.when(stage == name, known(name)).otherwise(table)
    months = tenor.cast("int")
    return F.when(months.between(1, most), F.get(table, months - 1)).otherwise(survival_factor(curve_of(stage, curves, other), tenor, annual))


def offer_grid(df: DataFrame, stage: str, outstanding: str, capacity: str, willing: str, annual: float = 0.12, processing: float = 500.0) -> DataFrame:
    """df with best: of the stage's candidates the one with the most expected cash, the first of equal ones, with
    within_policy and reason; and candidates, their number.

    What policy rules out isn't in the array. The survival-weighted worth of an instalment depends on stage and tenor alone,
    so it is a constant of the candidate, and a candidate costs some multiplications. Spark evaluates a lambda's expression
    wherever it stands, so instalment and chance are computed in steps of their own, once a candidate."""
    kind, owed = F.col(stage), F.col(outstanding)
    cells = None
    for name in REDEFAULT:
        own = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("type"), F.lit(h).alias("haircut"), F.lit(r).alias("rate"), F.lit(t).alias("tenor"), F.lit(worth(REDEFAULT[name], t, annual)).alias("worth"), F.lit(TAKE_UP[k] + h * 0.25).alias("base")) for i, (k, h, r, t) in enumerate(grid(name))])
        cells = own if cells is None else F.when(kind == name, own).otherwise(cells)

    def priced(c: Column) -> Column:
        return F.struct(c.alias("c"), instalment(owed * (1 - c["haircut"]), c["rate"], c["tenor"]).alias("monthly"))

    def judged(x: Column) -> Column:
        c, monthly = x["c"], x["monthly"]
        npv = monthly * c["worth"] - owed * c["haircut"] - processing
        return F.struct(c.alias("c"), monthly.alias("monthly"), npv.alias("npv"), take_up(c["base"], monthly, F.col(capacity), kind, F.col(willing)).alias("chance"))

    def value(x: Column) -> Column:
        c, monthly = x["c"], x["monthly"]
        cash = x["chance"] * F.greatest(x["npv"], F.lit(0.0))
        return F.struct(cash.alias("expected"), (-c["i"]).alias("i"), c["type"].alias("type"), c["haircut"].alias("haircut"), c["rate"].alias("rate"), c["tenor"].alias("tenor"), monthly.alias("instalment"), x["chance"].alias("take_up"), x["npv"].alias("npv"), (monthly <= F.col(capacity)).alias("affordable"), (monthly * c["tenor"] + owed * c["haircut"]).alias("recovered"))

    limit = F.create_map(*[F.lit(x) for kv in AUTO_APPROVED.items() for x in kv])[kind]
    whole = df.withColumn("__cells", cells).withColumn("best", F.array_max(F.transform(F.transform(F.transform("__cells", priced), judged), value))).withColumn("candidates", F.size("__cells")).drop("__cells")
    over = F.col("best.haircut") > limit
    percent = lambda x: F.round(x * 100).cast("int").cast("string")
    reason = F.when(over, F.concat(F.lit("haircut "), percent(F.col("best.haircut")), F.lit(" % is above "), percent(limit), F.lit(" % for "), kind))
    return whole.withColumn("within_policy", ~over).withColumn("reason", reason)
