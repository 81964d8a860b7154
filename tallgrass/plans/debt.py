"""Queries of collections columns: contacts, arrears, billing cycles, scorecards, affordability, strategies, base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import debt as d
from tallgrass.operators import contacts as k
from tallgrass.operators.windows import rounded, rounded_by
from tallgrass.sources.tables import ACCOUNTS, TXN, accounts, table, txn

from .registry import query
from .windows import r

AS_OF = "2001-01-01"


def sql(columns: dict[str, str], digits: int = 4) -> str:
    return ", ".join(r(e, n, digits) for n, e in columns.items())


# Contacts: an event's kind is its channel; result and agent follow from its number.
RESULT = "['connected', 'no_answer', 'refused', 'promise', 'responded'][CAST(event_id % 5 + 1 AS INT)]"
SNAP = "DATE '2024-01-25'"
CONTACT = f"""{TXN}, contact AS (SELECT entity_id, event_id, ts, day, CASE category WHEN 'purchase' THEN 'voice' WHEN 'view' THEN 'sms' WHEN 'click' THEN 'email' WHEN 'signup' THEN 'line' ELSE 'field' END AS channel,
{RESULT} AS result, 'agent' || event_id % 17 AS agent FROM txn WHERE day <= {SNAP})"""
WITHIN = lambda n: f"day >= {SNAP} - {n}"
G5 = f"""WITH {CONTACT}, l AS (SELECT entity_id, arg_max(day, (ts, event_id)) AS day, arg_max(result, (ts, event_id)) AS result, arg_max(agent, (ts, event_id)) AS agent FROM contact GROUP BY 1),
g AS (SELECT entity_id, count(*) FILTER (channel = 'voice') AS calls_made, count(*) FILTER (channel = 'sms') AS sms_sent, count(*) FILTER (channel = 'email') AS email_sent, count(*) FILTER (channel = 'line') AS line_sent,
count(*) FILTER (channel = 'voice' AND result IN ('connected', 'promise')) AS calls_connected, count(*) FILTER (channel = 'voice' AND result = 'no_answer') AS calls_no_answer, count(*) FILTER (channel = 'voice' AND result = 'refused') AS calls_refused,
count(*) FILTER (channel = 'sms' AND result = 'responded') AS sms_responded, count(*) FILTER ({WITHIN(30)}) AS contacts_30d, count(*) FILTER ({WITHIN(90)}) AS contacts_90d, count(*) FILTER (channel = 'voice' AND day = {SNAP}) AS calls_today,
count(*) FILTER (channel = 'voice' AND {WITHIN(7)}) AS calls_week, count(DISTINCT channel) AS channels_used, CAST(coalesce(bool_or(channel = 'field'), false) AS BIGINT) AS escalated,
CAST(coalesce(bool_or(channel = 'voice' AND result IN ('connected', 'promise') AND {WITHIN(30)}), false) AS BIGINT) AS right_party FROM contact GROUP BY 1)
SELECT g.*, {r('coalesce(calls_connected / nullif(calls_made, 0), 0)', 'call_response_rate')}, {r('coalesce(sms_responded / nullif(sms_sent, 0), 0)', 'sms_response_rate')}, {r('contacts_30d / 30e0', 'intensity_30d')},
CAST({SNAP} - l.day AS BIGINT) AS days_since_last, CAST(l.day - DATE '1970-01-01' AS BIGINT) AS last_day, CASE l.result WHEN 'promise' THEN 2 WHEN 'connected' THEN 1 WHEN 'refused' THEN 3 ELSE 0 END::BIGINT AS last_outcome,
CAST(('0x' || substr(md5(l.agent), 1, 8)) AS BIGINT) % 10000 AS agent_hash FROM g JOIN l USING (entity_id)"""


@query("G5_action_features", G5)
def g5(spark, sf_dir):
    channel = F.create_map(*[F.lit(x) for kv in {"purchase": "voice", "view": "sms", "click": "email", "signup": "line", "error": "field"}.items() for x in kv])
    result = F.array(*[F.lit(x) for x in ("connected", "no_answer", "refused", "promise", "responded")])
    rows = txn(spark, sf_dir).select("entity_id", "event_id", "ts", "day", channel[F.col("category")].alias("channel"), F.element_at(result, (F.col("event_id") % 5 + 1).cast("int")).alias("result"), F.concat(F.lit("agent"), F.col("event_id") % 17).alias("agent"))
    found = k.action_features(rows, "entity_id", "2024-01-25", ["ts", "event_id"])
    return rounded(found, [c for c in found.columns if not c.endswith("rate") and c != "intensity_30d"], ["call_response_rate", "sms_response_rate", "intensity_30d"])


PERIOD = [f"CASE WHEN o_orderkey * {7 * i + 3} % 101 % 10 = 0 THEN NULL WHEN o_orderkey * {7 * i + 3} % 101 % 3 = 0 THEN 0e0 ELSE CAST(o_orderkey * {7 * i + 3} % 101 AS DOUBLE) END" for i in range(9)]
KNOWN = "list_filter(p, lambda x: x IS NOT NULL)"
F2 = f"""WITH a AS (SELECT o_orderkey, o_orderkey % 6 AS bucket, CASE WHEN o_orderkey % 53 = 0 THEN [CAST(NULL AS DOUBLE)] ELSE [{", ".join(PERIOD)}] END AS p FROM orders), n AS (SELECT *, {KNOWN} AS k, len({KNOWN}) AS n FROM a),
x AS (SELECT *, coalesce(p[1], 0) AS p1, coalesce(p[3], 0) AS p3, coalesce(p[4], 0) AS p4, coalesce(p[6], 0) AS p6, coalesce(list_max(k), 0) AS top FROM n)
SELECT o_orderkey, CAST(len(list_filter(k, lambda v: v > 0)) AS BIGINT) AS nonzero, CAST(n > 0 AND p1 = 0 AND len(list_filter(k[2:], lambda v: v > 0)) > 0 AS BIGINT) AS recovered, CAST(bucket >= 3 AND p1 = 0 AND top = 0 AS BIGINT) AS inconsistent,
{sql({'latest': 'p1', 'largest': 'top', 'mean': 'coalesce(list_avg(k), 0)', 'volatility': 'CASE WHEN n > 1 THEN list_stddev_pop(k) ELSE 0 END', 'nonzero_share': 'coalesce(len(list_filter(k, lambda v: v > 0)) / nullif(n, 0), 0)',
'trend_3': 'coalesce(CASE WHEN p[1] IS NOT NULL AND n >= 3 THEN p[1] - coalesce(p[3], p[4]) END, 0)', 'trend_6': 'coalesce(CASE WHEN p[1] IS NOT NULL AND n >= 6 THEN p[1] - coalesce(p[6], p[7]) END, 0)',
'acceleration': 'CASE WHEN n >= 6 THEN p1 - p3 - p4 + p6 ELSE 0 END', 'peak_to_now': 'CASE WHEN top > 0 THEN p1 / top ELSE 0 END'})} FROM x"""


@query("F2_arrears", F2)
def f2(spark, sf_dir):
    periods = F.when(F.col("o_orderkey") % 53 == 0, F.array(F.lit(None).cast("double"))).otherwise(F.array(*[F.expr(e) for e in PERIOD]))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", periods.alias("p"))
    out = rows.select("o_orderkey", *[c.alias(n) for n, c in d.arrears(F.col("p"), F.col("o_orderkey") % 6).items()])
    keys = ["o_orderkey", "nonzero", "recovered", "inconsistent"]
    return rounded(out, keys, [c for c in out.columns if c not in keys])


def cycle_sql(grace: str, name: str) -> str:
    first = "CAST(date_trunc('month', day) + to_months(CAST(m AS INT)) AS DATE)"
    due = f"least({first} + CAST(bill - 1 AS INT), last_day({first})) + CAST({grace} AS INT)"
    dates = lambda a, b, test: f"list_filter(list_transform(range({a}, {b} + 1), lambda m: {due}), lambda x: x {test} day)"
    last, after = f"coalesce(list_max({dates(-3, 0, '<=')}), day - 30)", f"coalesce(list_min({dates(-3, 2, '>')}), day + 30)"
    this = due.replace("CAST(m AS INT)", "0")
    return f"""CAST(day({this}) AS BIGINT) AS {name}_due_day, {last} AS {name}_last_due, CAST(day - {last} AS BIGINT) AS {name}_days_past, CAST({after} - day AS BIGINT) AS {name}_days_to_next,
CASE WHEN day - {last} = 0 THEN 0 WHEN day - {last} <= 7 THEN 1 WHEN day - {last} <= 30 THEN 2 ELSE 3 END::BIGINT AS {name}_phase"""


F3 = f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderkey % 31 + 1 AS bill, o_orderkey * 7 % 200 AS dpd, CASE o_orderkey % 3 WHEN 0 THEN 20 WHEN 1 THEN 15 ELSE 20 END AS own FROM orders),
c AS (SELECT o_orderkey, bill, dpd, {cycle_sql('20', 'cc')}, {cycle_sql('15', 'spc')}, {cycle_sql('own', 'product')} FROM o)
SELECT * EXCLUDE (bill, dpd), {r('bill / 31e0', 'bill_day_norm')}, CAST(dpd // 30 AS BIGINT) AS cycles_missed, CAST(dpd % 30 AS BIGINT) AS cycle_residual, CAST(least(cc_days_to_next, spc_days_to_next) <= 7 AS BIGINT) AS due_soon FROM c"""


@query("F3_billing_cycle", F3)
def f3(spark, sf_dir):
    product = F.array(F.lit("cc"), F.lit("spc"), F.lit("other"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 31 + 1).alias("bill"), (F.col("o_orderkey") * 7 % 200).alias("dpd"), F.element_at(product, (F.col("o_orderkey") % 3 + 1).cast("int")).alias("product"))
    grace = {"cc": F.lit(20), "spc": F.lit(15), "product": d.grace_of(F.col("product"))}
    cycles = [c.alias(f"{n}_{f}") for n, g in grace.items() for f, c in d.billing_cycle(F.col("bill"), F.col("day"), g).items()]
    out = rows.select("o_orderkey", "bill", *cycles, F.floor(F.col("dpd") / 30).alias("cycles_missed"), (F.col("dpd") % 30).alias("cycle_residual"))
    out = out.withColumn("due_soon", d.flag(F.least("cc_days_to_next", "spc_days_to_next") <= 7)).withColumn("bill_day_norm", F.col("bill") / 31)
    return rounded(out, [c for c in out.columns if c not in ("bill", "bill_day_norm")], ["bill_day_norm"])


# What a debtor's row lacks is derived from its id.
INPUT = {
    "dpd": "days_past_due", "balance": "balance", "last_payment": "spend / nullif(n_orders, 0) / 100", "paid_count": "n_orders", "paid_total": "spend / 84", "contacts": "account_id % 40", "response": "propensity",
    "kept": "(account_id * 17 % 100) / 1e2", "offered": "account_id % 5", "accepted": "account_id % 3", "active": "account_id % 2",
}
TIERS = "(CASE WHEN balance > 999 THEN 1 ELSE 0 END + CASE WHEN balance > 4999 THEN 1 ELSE 0 END + CASE WHEN balance > 9999 THEN 1 ELSE 0 END + CASE WHEN balance > 49999 THEN 1 ELSE 0 END)"
F4 = f"""WITH {ACCOUNTS}, i AS (SELECT account_id, balance, {", ".join(f"CAST({e} AS DOUBLE) AS {n}_" for n, e in INPUT.items())}, greatest(0, least(730, coalesce(DATE '{AS_OF}' - last_order, 730))) AS paid, account_id % 500 AS since FROM accounts)
SELECT account_id, CAST(dpd_ BETWEEN 31 AND 90 AS BIGINT) AS is_sm, CAST(dpd_ BETWEEN 91 AND 180 AS BIGINT) AS is_npl, CAST(dpd_ > 180 AS BIGINT) AS is_chargeoff, CAST((dpd_ > 0)::INT + (dpd_ > 30)::INT + (dpd_ > 60)::INT + (dpd_ > 90)::INT + (dpd_ > 180)::INT AS BIGINT) AS dpd_bucket,
CAST({TIERS} AS BIGINT) AS balance_tier, CAST(paid_count_ > 0 AS BIGINT) AS has_paid, CAST(paid <= 90 AS BIGINT) AS paid_90d, CAST(paid <= 180 AS BIGINT) AS paid_180d, CAST(contacts_ > 10 AS BIGINT) AS high_contact, CAST(response_ > 0.2 AS BIGINT) AS responsive, CAST(kept_ > 0.6 AS BIGINT) AS reliable,
CAST(since <= 7 AS BIGINT) AS fresh_contact, CAST(least(1, coalesce(accepted_ / nullif(offered_, 0), 0)) > 0.5 AS BIGINT) AS high_accept, CAST(active_ > 0 AS BIGINT) AS active_settlement,
{sql({'dpd_norm': 'least(1e0, dpd_ / 720)', 'log_dpd': 'ln(1 + dpd_)', 'log_balance': 'ln(1 + balance)', 'log_last_payment': 'ln(1 + coalesce(last_payment_, 0))', 'last_pay_to_balance': 'least(2, coalesce(last_payment_ / nullif(balance, 0), 0))', 'payment_freq': 'least(24, paid_count_) / 24',
'recovery_rate': 'least(2, coalesce(paid_total_ / nullif(balance, 0), 0))', 'days_since_payment': 'CAST(paid AS DOUBLE)', 'days_since_pay_norm': 'paid / 730e0', 'contacts_norm': 'least(30, contacts_) / 30', 'days_since_contact': 'least(365e0, since)', 'accept_rate': 'least(1, coalesce(accepted_ / nullif(offered_, 0), 0))'})} FROM i"""


def inputs(df, columns):
    return {n: F.expr(e).cast("double") for n, e in columns.items()}


@query("F4_scorecard_features", F4)
def f4(spark, sf_dir):
    dates = {"last_paid": F.col("last_order"), "last_contact": F.date_sub(F.lit(AS_OF).cast("date"), (F.col("account_id") % 500).cast("int"))}
    df = accounts(spark, sf_dir)
    out = df.select("account_id", *[c.alias(n) for n, c in d.scorecard_inputs(inputs(df, INPUT) | dates, F.lit(AS_OF).cast("date")).items()])
    whole = [c for c, t in out.dtypes if t == "bigint"]
    return rounded(out, whole, [c for c in out.columns if c not in whole])


ACTION = {
    "dpd": "days_past_due", "balance": "balance", "limit": "CASE WHEN account_id % 9 <> 0 THEN 12000 END", "due_30d": "n_orders * 30", "minimum_due": "balance / 20", "paid_7d": "account_id % 2", "paid_14d": "account_id % 3", "paid_30d": "account_id % 4",
    "days_since_payment": "account_id * 3 % 250", "last_payment": "spend / nullif(n_orders, 0) / 100", "fatigue": "(account_id * 29 % 100) / 1e2", "accept_rate": "propensity", "kept_rate": "(account_id * 17 % 100) / 1e2", "plan_rate": "(account_id * 13 % 100) / 1e2",
    "line_rate": "(account_id * 41 % 100) / 1e2", "sms_rate": "(account_id * 43 % 100) / 1e2", "days_since_contact": "account_id % 120", "contacts_7d": "account_id % 14",
}
PERSONA = "[" + ", ".join(f"'{p}'" for p in d.PERSONAS) + "][CAST(account_id % 7 + 1 AS INT)]"
F5 = f"""WITH {ACCOUNTS}, i AS (SELECT account_id, balance, {PERSONA} AS persona, {", ".join(f"CAST({e} AS DOUBLE) AS {n}_" for n, e in ACTION.items())} FROM accounts)
SELECT account_id, CAST(least(5, floor(dpd_ / 30)) AS BIGINT) AS bucket, CAST(dpd_ = 0 AS BIGINT) AS is_current, CAST(dpd_ BETWEEN 1 AND 60 AS BIGINT) AS is_early, CAST(dpd_ > 90 AS BIGINT) AS is_late, CAST(paid_7d_ > 0 AS BIGINT) AS paid_7d, CAST(paid_14d_ > 0 AS BIGINT) AS paid_14d, CAST(paid_30d_ > 0 AS BIGINT) AS paid_30d,
CAST(fatigue_ >= 0.7 AS BIGINT) AS high_fatigue, CAST(fatigue_ BETWEEN 0.4 AND 0.7 AS BIGINT) AS medium_fatigue, CAST(fatigue_ < 0.2 AS BIGINT) AS fresh, CAST(accept_rate_ > 0.5 AS BIGINT) AS high_accept, CAST(kept_rate_ > 0.7 AS BIGINT) AS reliable_promise, CAST(plan_rate_ > 0.6 AS BIGINT) AS completes_plans,
CAST({TIERS} AS BIGINT) AS balance_tier, CAST(line_rate_ > sms_rate_ AS BIGINT) AS line_better, {", ".join(f"CAST(persona = '{p}' AS BIGINT) AS persona_{p}" for p in d.PERSONAS)},
{sql({'dpd_norm': 'least(1e0, dpd_ / 360)', 'log_dpd': 'ln(1 + dpd_)', 'minimum_coverage': 'least(3, coalesce(due_30d_ / nullif(minimum_due_, 0), 0))', 'days_since_pay_norm': 'least(180, days_since_payment_) / 180', 'last_pay_to_balance': 'least(2, coalesce(last_payment_ / nullif(balance, 0), 0))',
'fatigue': 'fatigue_', 'log_balance': 'ln(1 + balance)', 'utilisation': 'least(1, coalesce(balance / limit_, 0.5e0))', 'days_since_contact_norm': 'least(90, days_since_contact_) / 90', 'contacts_norm': 'least(10, contacts_7d_) / 10'})} FROM i"""


@query("F5_nba_features", F5)
def f5(spark, sf_dir):
    df = accounts(spark, sf_dir)
    persona = F.element_at(F.array(*[F.lit(p) for p in d.PERSONAS]), (F.col("account_id") % 7 + 1).cast("int"))
    out = df.select("account_id", *[c.alias(n) for n, c in d.next_action_inputs(inputs(df, ACTION) | {"persona": persona}).items()])
    whole = [c for c, t in out.dtypes if t == "bigint"]
    return rounded(out, whole, [c for c in out.columns if c not in whole])


F10 = f"WITH {ACCOUNTS} SELECT account_id, {r('(n_orders / 12e0 * 30 + (account_id * 17 % 100) / 1e2 * 25 + propensity * 20 + (account_id * 43 % 100) / 1e2 * 15 + greatest(0e0, 1 - coalesce(DATE $$2001-01-01$$ - last_order, 999) / 365e0) * 10) / 100', 'willingness')} FROM accounts".replace("$$", "'")


@query("F10_willingness", F10)
def f10(spark, sf_dir):
    since = F.datediff(F.lit(AS_OF).cast("date"), F.col("last_order"))
    x = d.willingness(F.col("n_orders"), F.expr("(account_id * 17 % 100) / 1e2"), F.col("propensity"), F.expr("(account_id * 43 % 100) / 1e2"), since)
    return rounded(accounts(spark, sf_dir).select("account_id", x.alias("willingness")), ["account_id"], ["willingness"])


MEANS = {"predicted": "CASE WHEN account_id % 5 = 0 THEN spend / 84 END", "secured": "CASE WHEN account_id % 5 = 1 THEN balance * 0.02e0 END", "instalments": "CASE WHEN account_id % 5 = 2 THEN balance * 0.03e0 END", "last": "CASE WHEN account_id % 5 = 3 THEN balance * 0.01e0 END", "paid": "spend / 84"}
MEDIANS = "[" + ", ".join("[" + ", ".join(f"{x}e0" for x in row) + "]" for row in d.MEDIAN_INCOME) + "]"
P23 = f"""WITH {ACCOUNTS}, i AS (SELECT account_id, days_past_due, balance, {", ".join(f"{e} AS {n}" for n, e in MEANS.items())} FROM accounts),
t AS (SELECT *, CASE WHEN predicted > 0 THEN 1 WHEN secured > 0 THEN 2 WHEN instalments > 0 THEN 3 WHEN "last" > 0 THEN 4 ELSE 5 END AS tier, {MEDIANS}[CAST(least(5, days_past_due // 30) + 1 AS INT)][CASE WHEN balance < 1000 THEN 1 WHEN balance < 5000 THEN 2 WHEN balance < 10000 THEN 3 ELSE 4 END] AS median FROM i),
x AS (SELECT *, CASE tier WHEN 1 THEN predicted WHEN 2 THEN secured / 0.35e0 WHEN 3 THEN instalments / 0.4e0 WHEN 4 THEN "last" / 0.15e0 ELSE median END AS income, coalesce(instalments, coalesce(paid, 0) / 12) AS owed FROM t)
SELECT account_id, CAST(tier AS BIGINT) AS tier, CASE WHEN tier = 1 THEN 'high' WHEN tier <= 3 THEN 'medium' ELSE 'low' END AS confidence, owed / greatest(1e0, income) > 0.4e0 AS over_indebted,
{sql({'income': 'income', 'obligations': 'owed', 'living': 'income * 0.35e0', 'disposable': 'greatest(0e0, income - owed - income * 0.35e0)', 'capacity': 'greatest(0e0, income - owed - income * 0.35e0) * 0.6e0'}, 2)}, {r('owed / greatest(1e0, income)', 'dsr')} FROM x"""


@query("P23_affordability", P23)
def p23(spark, sf_dir):
    x = {n: F.expr(e) for n, e in MEANS.items()}
    found = d.affordability(x["predicted"], x["secured"], x["instalments"], x["last"], x["paid"], F.col("days_past_due"), F.col("balance"))
    out = accounts(spark, sf_dir).select("account_id", *[c.alias(n) for n, c in found.items()])
    return rounded_by(out, ["account_id", "tier", "confidence", "over_indebted"], {"income": 2, "obligations": 2, "living": 2, "disposable": 2, "capacity": 2, "dsr": 4})


# History: what was tried on accounts of a persona and how much of the balance came back.
HISTORY = f"""{ACCOUNTS}, tried AS (SELECT *, CASE WHEN balance > 8000 THEN 'high_value' WHEN balance > 4000 THEN 'standard' WHEN balance > 2000 THEN 'low_value' ELSE 'new_' || CASE WHEN balance > 1000 THEN 'high_value' ELSE 'low_value' END END AS persona,
['call', 'sms', 'email'][CAST(account_id % 3 + 1 AS INT)] AS channel, ['settlement', 'payment_plan'][CAST(account_id % 2 + 1 AS INT)] AS offer, 10 * (account_id % 4) AS discount, ['09:00', '13:00', '18:00'][CAST(account_id % 3 + 1 AS INT)] AS hour FROM accounts)"""
P25 = f"""WITH {HISTORY}, g AS (SELECT persona, channel, offer, discount, hour, sum(balance * propensity) / sum(balance) AS rate FROM tried WHERE persona NOT LIKE 'new%' GROUP BY 1, 2, 3, 4, 5),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY persona ORDER BY round(rate, 9) DESC, channel DESC, offer DESC, discount DESC, hour DESC) = 1),
x AS (SELECT t.account_id, t.persona, b.persona IS NOT NULL AS known, t.balance, coalesce(b.channel, CASE WHEN t.persona LIKE '%high_value%' THEN 'call' WHEN t.persona LIKE '%low_value%' THEN 'email' ELSE 'sms' END) AS channel,
coalesce(b.offer, CASE WHEN t.persona LIKE '%high_value%' THEN 'settlement' WHEN t.persona LIKE '%low_value%' THEN 'payment_reminder' ELSE 'payment_plan' END) AS offer, coalesce(b.discount, CASE WHEN t.persona LIKE '%high_value%' THEN 50 WHEN t.persona LIKE '%low_value%' THEN 0 ELSE 20 END) AS discount,
coalesce(b.hour, '10:00') AS hour, coalesce(b.rate, 0.15e0) AS rate FROM tried t LEFT JOIN b USING (persona)), c AS (SELECT *, CASE channel WHEN 'call' THEN 5e0 WHEN 'sms' THEN 0.1e0 WHEN 'email' THEN 0.05e0 ELSE 1 END AS cost FROM x)
SELECT account_id, persona, known, channel, offer, CAST(discount AS BIGINT) AS discount, hour, cost, {r('balance * rate', 'recovery', 2)}, {r('CASE WHEN known THEN (balance * rate - cost) / cost * 100 ELSE 200 END', 'roi', 1)} FROM c"""


@query("P25_persona_strategy", P25)
def p25(spark, sf_dir):
    b = F.col("balance")
    pick = lambda names, n: F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("account_id") % n + 1).cast("int"))
    persona = F.when(b > 8000, "high_value").when(b > 4000, "standard").when(b > 2000, "low_value").when(b > 1000, "new_high_value").otherwise("new_low_value")
    tried = accounts(spark, sf_dir).withColumns({"persona": persona, "channel": pick(["call", "sms", "email"], 3), "offer": pick(["settlement", "payment_plan"], 2), "discount": 10 * (F.col("account_id") % 4), "hour": pick(["09:00", "13:00", "18:00"], 3)})
    past = tried.where(~F.col("persona").startswith("new")).withColumn("recovered", b * F.col("propensity"))
    found = k.persona_strategy(tried.select("account_id", "persona", "balance"), past, "persona", ["channel", "offer", "discount", "hour"], "recovered", "balance", {"call": 5.0, "sms": 0.1, "email": 0.05})
    return rounded_by(found.withColumn("discount", F.col("discount").cast("long")), ["account_id", "persona", "known", "channel", "offer", "discount", "hour", "cost"], {"recovery": 2, "roi": 1})


A22 = f"""WITH {ACCOUNTS}, c AS (SELECT account_id, segment, nation, balance, days_past_due, CASE WHEN account_id % 9 <> 0 THEN 8000e0 END AS credit_limit, last_order, CASE WHEN account_id % 4 = 0 THEN balance / 24 END AS instalment, CASE WHEN account_id % 4 = 0 THEN 24 END AS instalments FROM accounts),
k AS (SELECT c_custkey AS account_id, min(c_name) AS customer FROM customer WHERE c_custkey % 6 <> 0 GROUP BY 1)
SELECT account_id, segment, nation, days_past_due, customer, CAST(coalesce(DATE '{AS_OF}' - last_order, 999) AS BIGINT) AS days_since_payment, {r('balance', 'balance', 2)}, {r('least(2, greatest(0, coalesce(balance / credit_limit, 0)))', 'utilisation')}, {r('coalesce(instalment, 0) * coalesce(instalments, 0)', 'new_loan', 2)} FROM c LEFT JOIN k USING (account_id)"""


@query("A22_base_table", A22)
def a22(spark, sf_dir):
    """Cards with what follows from them, and the customer where one is known."""
    fourth = F.col("account_id") % 4 == 0
    cards = accounts(spark, sf_dir).withColumns({"credit_limit": F.when(F.col("account_id") % 9 != 0, 8000.0), "instalment": F.when(fourth, F.col("balance") / 24), "instalments": F.when(fourth, 24), "last_payment_date": F.col("last_order")})
    names = table(spark, sf_dir, "customer").where("c_custkey % 6 <> 0").select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("customer"))
    found = k.base_table(cards, names, "account_id", ["segment", "nation", "days_past_due", "balance"], AS_OF)
    return rounded_by(found, ["account_id", "segment", "nation", "days_past_due", "customer", "days_since_payment"], {"balance": 2, "utilisation": 4, "new_loan": 2})


J4 = f"""WITH {ACCOUNTS}, {TXN},
f1 AS (SELECT entity_id AS account_id, count(*) AS n_events, sum(value) AS total FROM txn GROUP BY 1), f2 AS (SELECT entity_id AS account_id, count(*) AS n_errors FROM txn WHERE category = 'error' GROUP BY 1),
f3 AS (SELECT entity_id AS account_id, count(*) AS n_late, sum(value) AS late_total FROM txn WHERE hour(ts) >= 20 GROUP BY 1), f4 AS (SELECT o_custkey AS account_id, avg(o_totalprice) AS mean_order FROM orders GROUP BY 1),
f5 AS (SELECT o_custkey AS account_id, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1), f6 AS (SELECT o_custkey AS account_id, count(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT account_id, coalesce(n_events, 0) AS n_events, coalesce(n_errors, 0) AS n_errors, coalesce(n_late, 0) AS n_late, coalesce(n_open, 0) AS n_open, {sql({'total': 'coalesce(total, 0)', 'late_total': 'coalesce(late_total, 0)', 'mean_order': 'coalesce(mean_order, 0)', 'quantity': 'coalesce(quantity, 0)'}, 2)}
FROM accounts LEFT JOIN f1 USING (account_id) LEFT JOIN f2 USING (account_id) LEFT JOIN f3 USING (account_id) LEFT JOIN f4 USING (account_id) LEFT JOIN f5 USING (account_id) LEFT JOIN f6 USING (account_id)"""


@query("J4_feature_left_joins", J4)
def j4(spark, sf_dir):
    """Six feature frames; those of one source come from one aggregation of it."""
    rows, orders, lines = txn(spark, sf_dir), table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    late = F.hour("ts") >= 20
    events = rows.groupBy(F.col("entity_id").alias("account_id")).agg(F.count("*").alias("n_events"), F.sum("value").alias("total"), F.count_if(F.col("category") == "error").alias("n_errors"), F.count_if(late).alias("n_late"), F.sum(F.when(late, F.col("value"))).alias("late_total"))
    owed = orders.groupBy(F.col("o_custkey").alias("account_id")).agg(F.avg("o_totalprice").alias("mean_order"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
    bought = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("account_id")).agg(F.sum("l_quantity").alias("quantity"))
    found = k.feature_frame(accounts(spark, sf_dir).select("account_id"), "account_id", [events, owed, bought])
    return rounded(found, ["account_id", "n_events", "n_errors", "n_late", "n_open"], ["total", "late_total", "mean_order", "quantity"], 2)
