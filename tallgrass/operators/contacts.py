"""Features and strategies of collection accounts that need grouping or joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.debt import clip, flag

#: Codes of a contact's outcome.
OUTCOMES = {"no_answer": 0, "connected": 1, "promise": 2, "refused": 3}
REACHED = ("connected", "promise")


def action_features(df: DataFrame, entity: str, snapshot: str, order: list[str]) -> DataFrame:
    """Contact features per entity from rows (channel: voice, sms, email, line, field; result; day; agent) up to a snapshot day,
    from one aggregation: counts by channel and result, response rates, contacts of the last 7, 30 and 90 days, channels used,
    escalation, right-party contact, and the last contact's day, outcome code and hashed agent."""
    snap = F.lit(snapshot).cast("date")
    rows = df.where(F.col("day") <= snap)
    voice, sms = F.col("channel") == "voice", F.col("channel") == "sms"
    reached = F.col("result").isin(*REACHED)
    last = lambda n: F.col("day") >= F.date_sub(snap, n)
    newest = F.max_by(F.struct("day", "result", "agent"), F.struct(*order))
    g = rows.groupBy(entity).agg(
        F.count_if(voice).alias("calls_made"), F.count_if(sms).alias("sms_sent"), F.count_if(F.col("channel") == "email").alias("email_sent"), F.count_if(F.col("channel") == "line").alias("line_sent"),
        F.count_if(voice & reached).alias("calls_connected"), F.count_if(voice & (F.col("result") == "no_answer")).alias("calls_no_answer"), F.count_if(voice & (F.col("result") == "refused")).alias("calls_refused"), F.count_if(sms & (F.col("result") == "responded")).alias("sms_responded"),
        F.count_if(last(30)).alias("contacts_30d"), F.count_if(last(90)).alias("contacts_90d"), F.count_if(voice & (F.col("day") == snap)).alias("calls_today"), F.count_if(voice & last(7)).alias("calls_week"),
        sum((F.max(flag(F.col("channel") == c)) for c in ("voice", "sms", "email", "line", "field")), F.lit(0)).alias("channels_used"),
        F.max(flag(F.col("channel") == "field")).alias("escalated"), F.max(flag(voice & reached & last(30))).alias("right_party"), newest.alias("__last"),
    )
    rate = lambda a, b: F.coalesce(F.col(a) / F.nullif(b, F.lit(0)), F.lit(0.0))
    code = F.coalesce(F.create_map(*[F.lit(x) for kv in OUTCOMES.items() for x in kv])[F.col("__last.result")], F.lit(0)).cast("long")
    hashed = F.conv(F.substring(F.md5("__last.agent"), 1, 8), 16, 10).cast("long") % 10000
    more = {
        "call_response_rate": rate("calls_connected", "calls_made"), "sms_response_rate": rate("sms_responded", "sms_sent"), "intensity_30d": F.col("contacts_30d") / 30,
        "days_since_last": F.datediff(snap, "__last.day").cast("long"), "last_day": F.unix_date("__last.day").cast("long"), "last_outcome": code, "agent_hash": hashed,
    }
    return g.withColumns(more).drop("__last")


#: What a persona without history gets: by value in its name (channel, offer, discount), the hour, the recovery rate and ROI.
DEFAULTS = {"high_value": ("call", "settlement", 50), "low_value": ("email", "payment_reminder", 0)}
OTHER, HOUR, RATE, ROI = ("sms", "payment_plan", 20), "10:00", 0.15, 200.0


def persona_strategy(accounts: DataFrame, history: DataFrame, persona: str, dimensions: list[str], recovered: str, owed: str, costs: dict[str, float]) -> DataFrame:
    """accounts with the strategy (channel, offer, discount, hour: dimensions in this order) that recovered most of what its
    persona owed, whether there was one (known), expected recovery, cost by channel and ROI in percent. Of equal rates (to nine
    digits) the greater values of the dimensions count. A persona without history gets the default of its value tier."""
    tried = history.groupBy(persona, *dimensions).agg((F.sum(recovered) / F.sum(owed)).alias("rate"))
    best = tried.groupBy(persona).agg(F.max_by(F.struct(*dimensions, "rate"), F.struct(F.round("rate", 9), *dimensions)).alias("b"))
    rows = accounts.join(best, persona, "left")
    default = lambda i: reduce(lambda out, kv: F.when(F.col(persona).contains(kv[0]), F.lit(kv[1][i])).otherwise(out), reversed(DEFAULTS.items()), F.lit(OTHER[i]))
    channel, offer, discount, hour = dimensions
    cost = F.create_map(*[F.lit(x) for kv in costs.items() for x in kv])
    out = rows.select(
        *accounts.columns, F.col("b").isNotNull().alias("known"), F.coalesce(f"b.{channel}", default(0)).alias("channel"), F.coalesce(f"b.{offer}", default(1)).alias("offer"), F.coalesce(f"b.{discount}", default(2)).alias("discount"),
        F.coalesce(f"b.{hour}", F.lit(HOUR)).alias("hour"), (F.col(owed) * F.coalesce("b.rate", F.lit(RATE))).alias("recovery"),
    )
    out = out.withColumn("cost", F.coalesce(cost[F.col("channel")], F.lit(1.0)))
    return out.withColumn("roi", F.when(F.col("known"), (F.col("recovery") - F.col("cost")) / F.col("cost") * 100).otherwise(ROI))


def base_table(cards: DataFrame, customers: DataFrame, key: str, keep: list[str], as_of: str) -> DataFrame:
    """One row a card: kept columns, utilisation of its limit (0 to 2; 0 without a limit), days since the last payment (999 where
    none is known), what an agreed plan comes to, and the customer of the same key (the first by name), where there is one."""
    snap = F.lit(as_of).cast("date")
    names = customers.groupBy(key).agg(F.min("customer").alias("customer"))
    utilisation = F.coalesce(clip(F.col("balance") / F.nullif("credit_limit", F.lit(0.0)), 0, 2), F.lit(0.0))
    plan = F.coalesce("instalment", F.lit(0.0)) * F.coalesce("instalments", F.lit(0))
    rows = cards.select(key, *keep, utilisation.alias("utilisation"), F.coalesce(F.datediff(snap, "last_payment_date"), F.lit(999)).cast("long").alias("days_since_payment"), plan.alias("new_loan"))
    return rows.join(names, key, "left")


def feature_frame(accounts: DataFrame, key: str, frames: list[DataFrame]) -> DataFrame:
    """accounts with the columns of all frames (one row a key each), 0 where a frame has no row."""
    return reduce(lambda left, right: left.join(right, key, "left"), frames, accounts).fillna(0)
