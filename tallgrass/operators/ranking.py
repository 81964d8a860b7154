"""Ranking, capacity limits and allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_in_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def rank_actions(df: DataFrame, id: str, values: dict[str, Column], k: int = 3) -> DataFrame:
    """The best action per row, its value and the k best names; equal values by name. No shuffle: actions are columns."""
    ranked = F.array_sort(F.array(*[F.struct((-v).alias("v"), F.lit(n).alias("n")) for n, v in values.items()]))
    return df.select(id, ranked.alias("r")).select(id, F.col("r")[0]["n"].alias("action"), (-F.col("r")[0]["v"]).alias("value"), F.array_join(F.transform(F.slice("r", 1, k), lambda x: x["n"]), ",").alias("top"))


def capacity_cut(df: DataFrame, action: str, value: str, id: str, limits: dict[str, int], fallback: str) -> DataFrame:
    """The most valuable rows of each limited action keep it, the others get the fallback.

    A cut value per action comes from a partial top-k of (value, id), so no task sorts a whole action."""
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    salted = df.withColumn("__s", F.pmod(F.xxhash64(id), F.lit(64)))
    w = Window.partitionBy(action, "__s").orderBy(F.desc(value), id)
    some = salted.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= limit[F.col(action)])
    best = some.withColumn("__r", F.row_number().over(Window.partitionBy(action).orderBy(F.desc(value), id))).where(F.col("__r") <= limit[F.col(action)])
    kept = df.join(best.select(id, F.lit(True).alias("__kept")), id, "left")
    unlimited = limit[F.col(action)].isNull()
    return kept.withColumn("final", F.when(unlimited | F.col("__kept"), F.col(action)).otherwise(fallback)).drop("__kept")


def share_capacity(df: DataFrame, id: str, values: dict[str, Column], shares: dict[str, float], none: str = "NONE") -> DataFrame:
    """(id, final, value, moves): each row's best action that has room. An action holds floor(share * rows) rows at most (those
    without a share any number), the most valuable ones, equal values by id; what is beyond moves on to its next best action,
    until nothing moves. Actions without a value (null) are not open to a row; a row that no action has room for gets none.

    Each round ranks the rows of the overfull actions by ranges (global_rank), so no task sorts an action, and is written, so
    that a lost executor repeats one round. No row ends below an action that holds a less valuable row than it would be."""
    from tallgrass.sources.scratch import settle

    from .windows import global_rank

    wish = F.filter(F.array(*[F.struct((-v).cast("double").alias("v"), F.lit(n).alias("n")) for n, v in values.items()]), lambda x: x["v"].isNotNull())
    state = settle(df.select(id, F.array_sort(wish).alias("__wish"), F.lit(0).alias("__at")), "wishes")
    total = state.count()
    room = {n: int(total * share + 1e-9) for n, share in shares.items()}
    limit = F.create_map(*[F.lit(x) for kv in room.items() for x in kv]) if room else None
    while room:
        asked = state.withColumn("__a", F.when(F.col("__at") < F.size("__wish"), F.col("__wish")[F.col("__at")]))
        held = {r["n"]: r["c"] for r in asked.groupBy(F.col("__a.n").alias("n")).agg(F.count("*").alias("c")).collect()}
        over = sorted(n for n, c in held.items() if n in room and c > room[n])
        if not over:
            break
        rows = asked.where(F.col("__a.n").isin(over)).select(id, F.col("__a.n").alias("__n"), F.col("__a.v").alias("__v"))
        before = {n: sum(held[m] for m in over[:k]) for k, n in enumerate(over)}
        start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
        out = global_rank(rows, ["__n", "__v", id]).where(F.col("rank") - start[F.col("__n")] > limit[F.col("__n")]).select(id, F.lit(1).alias("__out"))
        state = settle(state.join(out, id, "left").select(id, "__wish", (F.col("__at") + F.coalesce("__out", F.lit(0))).alias("__at")), "wishes")
    last = F.when(F.col("__at") < F.size("__wish"), F.col("__wish")[F.col("__at")])
    return state.select(id, F.coalesce(last["n"], F.lit(none)).alias("final"), (-last["v"]).alias("value"), F.col("__at").cast("long").alias("moves"))


def round_robin(cases: DataFrame, priority: list[str], officers: dict[str, int]) -> DataFrame:
    """Cases in priority order dealt over officers in turns until their capacity is used; the rest stay queued.

    Only the cases that there is room for are ordered (a bounded top-k)."""
    slots = sorted((turn, name) for name, n in officers.items() for turn in range(n))
    spark = cases.sparkSession
    free = spark.createDataFrame([(i + 1, name) for i, (_, name) in enumerate(slots)], "slot int, officer string")
    first = cases.orderBy(*priority).limit(len(slots)).withColumn("slot", F.row_number().over(Window.orderBy(*priority)))
    return first.join(F.broadcast(free), "slot").drop("slot")


def budget_allocation(df: DataFrame, key: str, gain: str, cost: str, capacity: str, budget: float) -> DataFrame:
    """Units per option, best gain per cost first, while the budget lasts. One row per option."""
    w = Window.orderBy(F.desc(F.col(gain) / F.col(cost)), key).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(F.col(cost) * F.col(capacity)).over(w), F.lit(0.0))
    units = F.greatest(F.lit(0.0), F.least(F.col(capacity).cast("double"), F.floor((budget - spent) / F.col(cost))))
    return df.select(key, units.cast("long").alias("units"), (units * F.col(gain)).alias("expected"))


def channel_dedup(df: DataFrame, customer: str, channel: str, value: str, id: str) -> DataFrame:
    """One product wins each channel of a customer; the others get NO_ACTION."""
    w = Window.partitionBy(customer, channel).orderBy(F.desc(value), id)
    return df.withColumn("final", F.when(F.row_number().over(w) == 1, F.col(channel)).otherwise("NO_ACTION"))
