"""Room under limits, repayment, instalments, utilisation and delinquency over rolling windows.

All windows of a call partition by the entity and order by seconds, so one shuffle serves them. A ratio with a zero or null
denominator is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import back


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def _change(df: DataFrame, entity: str, order: list[str], columns: dict[str, Column]) -> DataFrame:
    """df with each column, its change since the row before (<name>_d) and the change of that (<name>_dd)."""
    w = Window.partitionBy(entity).orderBy(*order)
    rows = df.withColumns(columns)
    rows = rows.withColumns({f"{n}_d": F.col(n) - F.lag(n).over(w) for n in columns})
    return rows.withColumns({f"{n}_dd": F.col(f"{n}_d") - F.lag(f"{n}_d").over(w) for n in columns})


def open_to_buy(df: DataFrame, entity: str, order: list[str], balance: str, limit: str, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Room under the limit, its share, utilisation; and per window the room's velocity (mean change), variation and momentum
    (mean change of the change), and utilisation's mean and maximum."""
    room, limits = F.col(limit) - F.col(balance), F.col(limit)
    rows = _change(df, entity, order, {"otb": room}).withColumns({"available": ratio(room, limits), "utilisation": ratio(F.col(balance), limits)})
    out = {}
    for n in days:
        b = back(entity, n)
        out |= {f"velocity_{n}d": F.avg("otb_d").over(b), f"momentum_{n}d": F.avg("otb_dd").over(b), f"cv_{n}d": ratio(F.stddev("otb").over(b), F.abs(F.avg("otb").over(b))), f"utilisation_mean_{n}d": F.avg("utilisation").over(b), f"utilisation_max_{n}d": F.max("utilisation").over(b)}
    return rows.withColumns(out).drop("otb_d", "otb_dd")


def repayment_buffer(df: DataFrame, entity: str, due: str, day: str, paid: str, balance: str, income: str, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Days to the due date, payment over balance, payment and debt over income; and per window mean and least days to due, and
    mean and least payment ratio."""
    rows = df.withColumns({"days_to_due": F.datediff(due, day).cast("long"), "payment_ratio": ratio(F.col(paid), F.col(balance)), "payment_to_income": ratio(F.col(paid), F.col(income)), "debt_to_income": ratio(F.col(balance), F.col(income))})
    out = {}
    for n in days:
        b = back(entity, n)
        out |= {f"due_mean_{n}d": F.avg("days_to_due").over(b), f"due_min_{n}d": F.min("days_to_due").over(b), f"ratio_mean_{n}d": F.avg("payment_ratio").over(b), f"ratio_min_{n}d": F.min("payment_ratio").over(b)}
    return rows.withColumns(out)


def instalment_features(df: DataFrame, entity: str, order: list[str], instalment: str, income: str, balance: str, limit: str, day: str, days: tuple[int, ...] = (7, 30), high: float = 0.8) -> DataFrame:
    """burden (instalment over income) and utilisation; per window the instalments' mean, variation and rises, the burden's mean
    and maximum, regularity (1 / (1 + deviation of the days between payments)), and utilisation's mean, maximum, minimum,
    deviation, range, times above high and velocity."""
    w = Window.partitionBy(entity).orderBy(*order)
    rows = df.withColumns({"burden": ratio(F.col(instalment), F.col(income)), "__up": (F.col(instalment) > F.lag(instalment).over(w)).cast("long"), "__gap": F.datediff(day, F.lag(day).over(w))})
    rows = _change(rows, entity, order, {"utilisation": ratio(F.col(balance), F.col(limit))})
    out = {}
    for n in days:
        b = back(entity, n)
        mean, use = F.avg(instalment).over(b), F.col("utilisation")
        out |= {
            f"instalment_mean_{n}d": mean, f"instalment_cv_{n}d": ratio(F.stddev(instalment).over(b), F.abs(mean)), f"increases_{n}d": F.sum("__up").over(b), f"burden_mean_{n}d": F.avg("burden").over(b), f"burden_max_{n}d": F.max("burden").over(b),
            f"regularity_{n}d": 1 / (1 + F.stddev("__gap").over(b)), f"use_mean_{n}d": F.avg(use).over(b), f"use_max_{n}d": F.max(use).over(b), f"use_min_{n}d": F.min(use).over(b), f"use_std_{n}d": F.stddev(use).over(b),
            f"use_range_{n}d": F.max(use).over(b) - F.min(use).over(b), f"high_use_{n}d": F.sum((use > high).cast("long")).over(b), f"use_velocity_{n}d": F.avg("utilisation_d").over(b),
        }
    return rows.withColumns(out).drop("__up", "__gap", "utilisation_d", "utilisation_dd")


def delinquency_rolls(df: DataFrame, entity: str, order: list[str], day: str, bucket: str, delay: str, windows: dict[str, int] = {"3m": 90, "6m": 180, "12m": 365}) -> DataFrame:
    """Direction of the last move and whether it cured itself; per window the worst bucket and delay, moves, rolls forward and
    back, and cures; and rows and days since the bucket last changed (gaps and islands)."""
    w = Window.partitionBy(entity).orderBy(*order)
    before = F.lag(bucket).over(w)
    rows = df.withColumn("roll", F.when(F.col(bucket) > before, "forward").when(F.col(bucket) < before, "back").when(before.isNotNull(), "stay"))
    rows = rows.withColumn("self_cure", F.coalesce((F.col("roll") == "back") & (F.col(bucket) == 0), F.lit(False)))
    rows = rows.withColumn("__island", F.sum(F.coalesce((F.col("roll") != "stay").cast("int"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    count = lambda condition, b: F.sum(F.coalesce(condition, F.lit(False)).cast("long")).over(b)
    out = {}
    for name, n in windows.items():
        b = back(entity, n)
        out |= {f"worst_{name}": F.max(bucket).over(b), f"worst_delay_{name}": F.max(delay).over(b), f"forward_{name}": count(F.col("roll") == "forward", b), f"back_{name}": count(F.col("roll") == "back", b), f"moves_{name}": count(F.col("roll") != "stay", b), f"cures_{name}": count(F.col("self_cure"), b)}
    inside = Window.partitionBy(entity, "__island").orderBy(*order)
    since = {"time_in_bucket": F.row_number().over(inside).cast("long"), "days_in_bucket": F.datediff(day, F.first(day).over(inside)).cast("long")}
    return rows.withColumns(out).withColumns(since).drop("__island")
