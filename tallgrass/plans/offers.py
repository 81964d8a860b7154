"""Queries of offers, loan values, elasticity curves and model diversity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import curves as c
from tallgrass.operators import offers as o
from tallgrass.operators.windows import rounded, rounded_by
from tallgrass.sources.tables import ACCOUNTS, accounts

from .registry import query
from .windows import r

# What the accounts lack is derived from their ids, the same way in both engines.
DEBTOR = f"""{ACCOUNTS}, debtor AS (SELECT *, propensity AS ltp, (account_id * 17 % 100) / 1e2 AS atp, balance * 0.03e0 + 50 * propensity AS capacity,
CASE WHEN days_past_due < 90 THEN 'SM' WHEN days_past_due < 150 THEN 'NPL' ELSE 'CHARGEOFF' END AS stage,
CASE WHEN balance > 7000 AND propensity < 0.4e0 THEN 'high_value_unresponsive' ELSE 'other' END AS persona FROM accounts)"""


def debtors(spark, sf_dir):
    return accounts(spark, sf_dir).withColumns({
        "ltp": F.col("propensity"),
        "atp": F.expr("(account_id * 17 % 100) / 1e2"),
        "capacity": F.col("balance") * 0.03 + 50 * F.col("propensity"),
        "stage": F.when(F.col("days_past_due") < 90, "SM").when(F.col("days_past_due") < 150, "NPL").otherwise("CHARGEOFF"),
        "persona": F.when((F.col("balance") > 7000) & (F.col("propensity") < 0.4), "high_value_unresponsive").otherwise("other"),
    })


def dealt(df):
    """df over all cores: the accounts' file is so small that a scan takes it in one or two tasks, however much a row costs."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "account_id")


TREE = [
    o.Leaf("ltp < 0.2 AND atp < 0.3 AND balance < 2000", "debt_sale"),
    o.Leaf("ltp < 0.3 AND days_past_due > 160", "legal_action"),
    o.Leaf("ltp > 0.5 AND atp > 0.6", "payment_plan", (0, 10), (6, 12)),
    o.Leaf("ltp > 0.4 AND atp < 0.5", "settlement", (30, 60)),
    o.Leaf("persona = 'high_value_unresponsive' AND days_past_due > 100", "settlement", (40, 70)),
]
RULE = "CASE " + " ".join(f"WHEN {leaf.when} THEN {i}" for i, leaf in enumerate(TREE, 1)) + " ELSE 0 END"
P15 = f"""WITH {DEBTOR}, t AS (SELECT *, {RULE} AS rule FROM debtor),
k AS (SELECT *, ['payment_reminder', 'debt_sale', 'legal_action', 'payment_plan', 'settlement', 'settlement'][rule + 1] AS kind,
  CASE rule WHEN 1 THEN 90e0 WHEN 3 THEN (1 - ltp) * 10 WHEN 4 THEN 60 - (ltp + atp) / 2 * 30 WHEN 5 THEN 70 - (ltp + atp) / 2 * 30 ELSE 0 END AS discount,
  CASE WHEN rule = 3 THEN CAST(floor(6 + (1 - atp) * 6) AS INT) END AS months FROM t),
a AS (SELECT *, CASE WHEN rule = 1 THEN balance * 0.1e0 WHEN rule = 3 THEN NULL ELSE balance * (1 - discount / 100) END AS amount, balance * (1 - discount / 100) / months AS monthly,
  CASE kind WHEN 'settlement' THEN 0.3e0 WHEN 'payment_plan' THEN 0.4e0 ELSE 0.2e0 END AS acceptance,
  CASE kind WHEN 'settlement' THEN 25e0 WHEN 'payment_plan' THEN 30 WHEN 'legal_action' THEN 200 WHEN 'debt_sale' THEN 5 ELSE 2 END AS cost FROM k)
SELECT account_id, CAST(rule AS BIGINT) AS rule, kind, CAST(months AS BIGINT) AS months, cost, {r('discount', 'discount', 3)}, {r('amount', 'amount', 2)}, {r('monthly', 'monthly', 2)}, {r('acceptance', 'acceptance')},
{r('coalesce(amount, balance) * acceptance', 'recovery', 2)}, {r('(coalesce(amount, balance) * acceptance - cost) / cost', 'roi', 3)} FROM a"""


@query("P15_offer_tree", P15)
def p15(spark, sf_dir):
    found = o.offer_tree(debtors(spark, sf_dir), TREE).select("account_id", "offer.*").withColumns({n: F.col(n).cast("long") for n in ("rule", "months")})
    digits = {"discount": 3, "amount": 2, "monthly": 2, "acceptance": 4, "recovery": 2, "roi": 3}
    return rounded_by(found, ["account_id", "rule", "kind", "months", "cost"], digits)


CHECKPOINTS = "redefault AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {x}, {y}e0)" for s, curve in o.REDEFAULT.items() for x, y in sorted(({0: 0.0} | curve).items())) + ") v(stage, x, y))"
#: Share of new defaults by stage and month, between the checkpoints on a line.
MONTHS = f"""{CHECKPOINTS}, lines AS (SELECT stage, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM redefault WINDOW w AS (PARTITION BY stage ORDER BY x)),
months AS (SELECT stage, t, CASE WHEN x2 IS NULL THEN y ELSE y + (y2 - y) * (t - x) / (x2 - x) END AS q FROM lines, range(1, 73) m(t) WHERE t >= x AND (x2 IS NULL OR t < x2))"""
F7 = f"""WITH {DEBTOR}, {MONTHS}, terms AS (SELECT *, (account_id % 4) / 1e1 AS haircut, (account_id % 3) * 0.05e0 AS rate, 6 + account_id % 5 * 15 AS tenor, 10e0 * (account_id % 5) AS waived FROM debtor),
i AS (SELECT *, CASE WHEN rate > 0 THEN balance * (1 - haircut) * rate / 12 / (1 - power(1 + rate / 12, -tenor)) ELSE balance * (1 - haircut) / tenor END AS instalment FROM terms),
v AS (SELECT account_id, sum(instalment * greatest(0e0, 1 - q) * power(power(1.12e0, 1e0 / 12), -t)) AS pv FROM i JOIN months USING (stage) WHERE t <= tenor GROUP BY 1)
SELECT account_id, stage, CAST(tenor AS BIGINT) AS tenor, instalment <= capacity AS affordable, {r('instalment', 'instalment', 2)}, {r('pv', 'pv', 2)}, {r('balance * haircut + waived + 500', 'concession', 2)},
{r('pv - balance * haircut - waived - 500', 'npv', 2)}, {r('propensity * greatest(0e0, pv - balance * haircut - waived - 500)', 'expected', 2)}, {r('q', 'redefault_12m', 2)}
FROM i JOIN v USING (account_id) JOIN (SELECT stage, q FROM months WHERE t = 12) USING (stage)"""


@query("F7_loan_npv", F7)
def f7(spark, sf_dir):
    """Loans after a haircut, whose borrowers default anew along the stage's curve."""
    terms = dealt(debtors(spark, sf_dir)).withColumns({"haircut": F.expr("(account_id % 4) / 1e1"), "rate": F.expr("(account_id % 3) * 0.05e0"), "tenor": F.expr("6 + account_id % 5 * 15"), "waived": F.expr("10e0 * (account_id % 5)")})
    value = o.loan(F.col("balance"), F.col("haircut"), F.col("rate"), F.col("tenor"), o.curve_of(F.col("stage")), F.col("waived"), factor=o.worth_of(F.col("stage"), F.col("tenor")))
    found = terms.withColumn("v", value).select("account_id", "stage", F.col("tenor").cast("long").alias("tenor"), (F.col("v.instalment") <= F.col("capacity")).alias("affordable"), "v.*", (F.col("propensity") * F.greatest(F.lit(0.0), F.col("v.npv"))).alias("expected"))
    return rounded(found, ["account_id", "stage", "tenor", "affordable"], ["instalment", "pv", "concession", "npv", "expected", "redefault_12m"], 2)


POLICY = "policy AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {o.RATE[s]}e0, {o.MAX_HAIRCUT[s]}e0, {o.AUTO_APPROVED[s]}e0, {o.STAGE_EFFECT[s]}e0)" for s in o.REDEFAULT) + ") v(stage, base_rate, most, automatic, effect))"
J10 = f"""WITH {DEBTOR}, {MONTHS}, {POLICY}, tenors AS (SELECT unnest([12, 24, 36, 48, 60]) AS tenor),
cells AS (
  SELECT stage, 'FULL_SETTLEMENT' AS type, h AS haircut, 0e0 AS rate, 1 AS tenor, 0.22e0 AS base, 1000 + h * 100 AS i FROM policy, (SELECT unnest([0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0]) AS h) WHERE h <= most * 1.5e0 + 1e-9
  UNION ALL SELECT stage, 'RESCHEDULE_RATE_REDUCE', 0, base_rate * (1 - cut), tenor, 0.52e0, 2000 + cut * 400 + tenor FROM policy, tenors, (SELECT unnest([0.25e0, 0.5e0, 0.75e0, 1e0]) AS cut)
  UNION ALL SELECT stage, 'RESCHEDULE_SAME_RATE', 0, base_rate, tenor, 0.4e0, 3000 + tenor FROM policy, tenors
  UNION ALL SELECT stage, 'FULL_RESTRUCTURE', h, base_rate * 0.5e0, tenor, 0.58e0, 4000 + h * 1000 + tenor FROM policy, tenors, (SELECT unnest([0.1e0, 0.2e0]) AS h) WHERE tenor >= 36 AND h <= most),
worth AS (SELECT stage, tenor, sum((1 - q) * power(power(1.12e0, 1e0 / 12), -t)) AS worth FROM months, (SELECT DISTINCT tenor FROM cells) WHERE t <= tenor GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN rate > 0 THEN balance * (1 - haircut) * rate / 12 / (1 - power(1 + rate / 12, -tenor)) ELSE balance * (1 - haircut) / tenor END AS instalment
  FROM debtor JOIN cells USING (stage) JOIN worth USING (stage, tenor) JOIN policy USING (stage)),
v AS (SELECT *, instalment * worth - balance * haircut - 500 AS npv,
  greatest(0.02e0, least(0.92e0, base + haircut * 0.25e0 + effect + CASE WHEN capacity > 0 THEN greatest(-0.15e0, 0.1e0 - least(3e0, instalment / capacity) * 0.08e0) ELSE -0.1e0 END + (propensity - 0.5e0) * 0.2e0)) AS take_up FROM m),
best AS (SELECT *, take_up * greatest(npv, 0) AS expected, count(*) OVER (PARTITION BY account_id) AS candidates FROM v QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY round(take_up * greatest(npv, 0), 6) DESC, i) = 1)
SELECT account_id, stage, type, CAST(tenor AS BIGINT) AS tenor, CAST(candidates AS BIGINT) AS candidates, instalment <= capacity AS affordable, haircut <= automatic AS within_policy,
CASE WHEN haircut > automatic THEN 'haircut ' || CAST(round(haircut * 100) AS INT) || ' % is above ' || CAST(round(automatic * 100) AS INT) || ' % for ' || stage END AS reason,
{r('haircut', 'haircut')}, {r('rate', 'rate')}, {r('take_up', 'take_up')}, {r('instalment', 'instalment', 2)}, {r('npv', 'npv', 2)}, {r('expected', 'expected', 2)}, {r('instalment * tenor + balance * haircut', 'recovered', 2)} FROM best"""


@query("J10_offer_grid", J10)
def j10(spark, sf_dir):
    """Best candidate by type, haircut, rate and tenor of each account."""
    found = o.offer_grid(dealt(debtors(spark, sf_dir)), "stage", "balance", "capacity", "propensity")
    found = found.select("account_id", "stage", F.col("candidates").cast("long").alias("candidates"), "within_policy", "reason", "best.*").withColumn("tenor", F.col("tenor").cast("long"))
    digits = {"haircut": 4, "rate": 4, "take_up": 4, "instalment": 2, "npv": 2, "expected": 2, "recovered": 2}
    return rounded_by(found, ["account_id", "stage", "type", "tenor", "candidates", "affordable", "within_policy", "reason"], digits)


# A chance that dips at places, with weights, so that there is something to pool.
STEPS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5]
CURVE = f"""{ACCOUNTS}, raw AS (SELECT account_id, segment, d, CAST(round(d * 10) AS INT) AS i, greatest(0.01e0, least(0.95e0, propensity + 0.6e0 * d - 0.02e0 * ((account_id + CAST(round(d * 10) AS INT) * 7) % 9))) AS raw,
1e0 + (account_id + CAST(round(d * 10) AS INT)) % 3 AS w FROM accounts, (SELECT unnest({STEPS}) * 1e0 AS d)),
sums AS (SELECT *, sum(raw * w) OVER u AS sw, sum(w) OVER u AS ww FROM raw WINDOW u AS (PARTITION BY account_id ORDER BY i)),
means AS (SELECT a.account_id, a.i AS a, b.i AS b, (b.sw - a.sw + a.raw * a.w) / (b.ww - a.ww + a.w) AS m FROM sums a JOIN sums b ON a.account_id = b.account_id AND a.i <= b.i),
-- The monotone fit at i is the largest over starts up to i of the smallest mean over ends from i on.
lows AS (SELECT s.account_id, s.i, m.a, min(m.m) AS low FROM sums s JOIN means m ON m.account_id = s.account_id AND m.a <= s.i AND m.b >= s.i GROUP BY 1, 2, 3),
fit AS (SELECT account_id, i, max(low) AS p FROM lows GROUP BY 1, 2),
curve AS (SELECT account_id, segment, d, p, p - first_value(p) OVER u AS lift, lag(p) OVER u AS before, lag(d) OVER u AS d0 FROM fit JOIN raw USING (account_id, i) WINDOW u AS (PARTITION BY account_id ORDER BY i))"""
F20 = f"""WITH {CURVE} SELECT account_id, d, {r('p', 'p')}, {r('lift', 'lift')}, {r('CASE WHEN before IS NULL THEN 0 WHEN before > 0 THEN (p - before) / before / ((d - d0) / greatest(d0, 1e-6)) END', 'elasticity')},
{r('CASE WHEN before IS NULL THEN 0 ELSE (p - before) / ((p + before) / 2) / ((d - d0) / ((d + d0) / 2)) END', 'arc')} FROM curve"""


def curve(spark, sf_dir):
    """(account_id, segment, d, p, lift, elasticity, arc): the fit is made in the row's array, then exploded."""
    d = F.array(*[F.lit(x) for x in STEPS])
    i = lambda x: F.round(x * 10).cast("int")
    raw = F.transform(d, lambda x: F.greatest(F.lit(0.01), F.least(F.lit(0.95), F.col("propensity") + 0.6 * x - 0.02 * ((F.col("account_id") + i(x) * 7) % 9))))
    fit = c.isotonic(raw, F.transform(d, lambda x: 1.0 + (F.col("account_id") + i(x)) % 3))
    rows = accounts(spark, sf_dir).select("account_id", "segment", fit.alias("fit"))
    step = F.transform("fit", lambda p, k: F.struct(F.element_at(d, k + 1).alias("d"), p.alias("p"), (p - F.element_at("fit", 1)).alias("lift"), F.when(k > 0, F.element_at("fit", F.greatest(k, F.lit(1)))).alias("before"), F.when(k > 0, F.element_at(d, F.greatest(k, F.lit(1)))).alias("d0")))
    one = rows.select("account_id", "segment", F.explode(step).alias("s")).select("account_id", "segment", "s.*")
    gain, wide = F.col("p") - F.col("before"), F.col("d") - F.col("d0")
    elasticity = F.when(F.col("before").isNull(), 0.0).when(F.col("before") > 0, gain / F.col("before") / (wide / F.greatest(F.col("d0"), F.lit(1e-6))))
    arc = F.when(F.col("before").isNull(), 0.0).otherwise(gain / ((F.col("p") + F.col("before")) / 2) / (wide / ((F.col("d") + F.col("d0")) / 2)))
    return one.select("account_id", "segment", "d", "p", "lift", elasticity.alias("elasticity"), arc.alias("arc"))


@query("F20_elasticity_curve", F20)
def f20(spark, sf_dir):
    return rounded(curve(spark, sf_dir), ["account_id", "d"], ["p", "lift", "elasticity", "arc"])


F20B = f"WITH {CURVE} SELECT segment, d, count(*) AS n, {r('avg(p)', 'p')}, {r('avg(lift)', 'lift')} FROM curve GROUP BY 1, 2 HAVING count(*) >= 30"


@query("F20b_segment_elasticity", F20B)
def f20b(spark, sf_dir):
    """Mean curves of the segments with 30 accounts or more."""
    g = curve(spark, sf_dir).groupBy("segment", "d").agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.avg("lift").alias("lift")).where("n >= 30")
    return rounded(g, ["segment", "d", "n"], ["p", "lift"])
