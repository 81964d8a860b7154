"""Rule-based segmentation, routing, validation, eligibility and suppression as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(rules: Mapping[str, str | Column], default: str) -> Column:
    """The name of the first rule that holds; a rule is a SQL predicate or a Column."""
    hit = [F.when(F.expr(c) if isinstance(c, str) else c, F.lit(name)) for name, c in rules.items()]
    return F.coalesce(*hit, F.lit(default))


def reasons(rules: Mapping[str, str | Column]) -> Column:
    """Names of all rules that hold, in order."""
    hit = [F.when(F.expr(c) if isinstance(c, str) else c, F.lit(name)) for name, c in rules.items()]
    return F.filter(F.array(*hit), lambda x: x.isNotNull())


def dropped_counts(df: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """How many rows each filter drops that the ones before kept, and how many stay, in one pass."""
    alive, columns = F.lit(True), [F.count("*").alias("total")]
    for name, keep in filters.items():
        columns.append(F.count_if(alive & ~F.coalesce(F.expr(keep), F.lit(False))).alias(f"dropped_{name}"))
        alive = alive & F.coalesce(F.expr(keep), F.lit(False))
    return df.agg(*columns, F.count_if(alive).alias("kept"))


def confidence(p: Column, threshold: float) -> Column:
    margin = F.abs(p - threshold) / threshold
    return F.when(margin >= 0.2, "high").when(margin >= 0.1, "medium").otherwise("low")


def variant(bucket: Column, shares: Mapping[str, int]) -> Column:
    """Which variant's cumulative share of 100 the bucket falls into."""
    total, chain = 0, None
    for name, share in shares.items():
        total += share
        chain = F.when(bucket < total, name) if chain is None else chain.when(bucket < total, name)
    return chain


def violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, violations, rate): rows that break each rule; a null is a violation."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(name) for name, c in rules.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules])
    return one.select("__n", F.explode(rows).alias("r")).select("r.*", F.when(F.col("__n") > 0, F.col("r.violations") / F.col("__n")).alias("rate"))


def first_allowed(candidates: list[tuple[Column, Column]], none: str) -> Column:
    """The first candidate action whose block condition doesn't hold."""
    return F.coalesce(*[F.when(~F.coalesce(blocked, F.lit(False)), action) for action, blocked in candidates], F.lit(none))


def alerts(metrics: DataFrame, key: list[str], limits: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row per metric beyond its limit; a limit is ('>' or '<', value)."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(v)).alias("limit"), (F.col(m) > v if op == ">" else F.col(m) < v).alias("hit")) for m, (op, v) in limits.items()])
    return metrics.select(*key, F.explode(rows).alias("r")).where("r.hit").select(*key, "r.metric", "r.value", "r.limit")
