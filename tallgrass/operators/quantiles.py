"""Exact quantiles of whole columns without gathering a column's values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.sources.scratch import settle

from .windows import running_sums

#: Groups (a key and some dozens of numbers each) that are sent to all tasks at most.
MOST_BROADCAST = 10_000


def _same(a: DataFrame, b: DataFrame, by: list[str]) -> list[Column]:
    return [a[c].eqNullSafe(b[f"__{c}"]) for c in by]


def _joined(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner", few: bool = False) -> DataFrame:
    """a with b, whose columns of by are named __<column>; one row of b where by is empty. Where b has few rows it goes to a's
    rows, so that a group's rows don't meet in one task."""
    if not by:
        return a.crossJoin(F.broadcast(b))
    b = F.broadcast(b) if few else b
    return a.join(b, _same(a, b, by), how).drop(*[f"__{c}" for c in by])


def _between(low: Column, high: Column, at: Column) -> Column:
    return low + (at - F.floor(at)) * (high - low)


def quantiles(df: DataFrame, by: list[str], value: str | Column, ps: list[float], accuracy: int = 10_000, name: str = "q") -> DataFrame:
    """(by..., q): the linearly interpolated quantiles of value at ps, as an array in the order of ps. Nulls don't count; a
    group without a value has no row (without by: a row with null).

    Two steps: a mergeable sketch brackets each wanted rank within 2 / accuracy of the rows; counts of the rows below tell
    which rank inside the bracket is meant, and only the bracket's distinct values are put in order. A task orders about
    4 / accuracy of a group's rows, so accuracy grows with the table. A rank that the bracket misses is an error."""
    rows = df.select(*by, (F.col(value) if isinstance(value, str) else value).cast("double").alias("__x")).where("__x IS NOT NULL")
    margins = [min(1.0, max(0.0, p + side * 2 / accuracy)) for p in ps for side in (-1, 1)]
    sketch = rows.groupBy(*by).agg(F.count("*").alias("__n"), F.percentile_approx("__x", margins, accuracy).alias("__cuts")).withColumnsRenamed({c: f"__{c}" for c in by})
    if by:
        sketch = settle(sketch, "sketch")
    placed = _joined(rows, sketch, by, few=bool(by) and sketch.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST)
    low, high, x = (lambda i: F.col("__cuts")[2 * i]), (lambda i: F.col("__cuts")[2 * i + 1]), F.col("__x")
    outside = placed.groupBy(*by).agg(
        F.first("__n").alias("__n"),
        F.array(*[F.struct(F.lit(i).alias("i"), F.count_if(x < low(i)).alias("below"), F.count_if(x <= high(i)).alias("upto"), F.max(F.when(x < low(i), x)).alias("under"), F.min(F.when(x > high(i), x)).alias("over")) for i in range(len(ps))]).alias("__o"),
    )
    inside = placed.select(*by, "__x", F.explode(F.filter(F.array(*[F.when((x >= low(i)) & (x <= high(i)), F.lit(i)) for i in range(len(ps))]), lambda i: i.isNotNull())).alias("__i"))
    steps = inside.groupBy(*by, "__i", "__x").agg(F.count("*").alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(*by, "__i").orderBy("__x"))
    wanted = outside.select(*by, "__n", F.explode("__o").alias("__o")).select(*by, "__n", "__o.*").withColumn("__at", F.array(*[F.lit(float(p)) for p in ps])[F.col("i")] * (F.col("__n") - 1))
    asked = wanted.withColumnsRenamed({c: f"__{c}" for c in by})
    ranked = steps.withColumn("__upto", upto)
    on = [*_same(ranked, asked, by), ranked["__i"] == asked["i"]]
    both = ranked.join(asked, on).drop(*[f"__{c}" for c in by])
    first, last = F.col("below") + F.col("__upto") - F.col("__c"), F.col("below") + F.col("__upto") - 1
    at = lambda r: F.max(F.when((first <= r) & (r <= last), F.col("__x")))
    k, k1 = F.floor("__at"), F.least(F.floor("__at") + 1, F.col("__n") - 1)
    edge = lambda found, r: F.coalesce(found, F.when(r == F.col("upto"), F.col("over")), F.when(r == F.col("below") - 1, F.col("under")), F.raise_error("a quantile's bracket misses its rank").cast("double"))
    g = both.groupBy(*by, "__i").agg(at(k).alias("__a"), at(k1).alias("__b"), *[F.first(c).alias(c) for c in ("__n", "__at", "below", "upto", "under", "over")])
    value_at = g.select(*by, "__i", _between(edge(F.col("__a"), k), edge(F.col("__b"), k1), F.col("__at")).alias("__v"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__v"))), lambda s: s["__v"])
    return value_at.groupBy(*by).agg(listed.alias(name)) if by else value_at.agg(F.when(F.count("*") > 0, listed).alias(name))


def quantiles_of_counts(counts: DataFrame, by: list[str], value: str, count: str, ps: list[float], name: str = "q") -> DataFrame:
    """quantiles of values that each stand for count rows: running sums over all values, by ranges of them."""
    rows = counts.where(F.col(value).isNotNull() & (F.col(count) > 0)).groupBy(*by, value).agg(F.sum(count).alias("__c"))
    summed = running_sums(rows, [*by, value], ["__c"])
    whole = summed.groupBy(*by).agg(F.sum("__c").alias("__n"), F.min(F.col("__c_upto") - F.col("__c")).alias("__start")).withColumnsRenamed({c: f"__{c}" for c in by})
    placed = _joined(summed, whole, by)
    last = F.col("__c_upto") - F.col("__start") - 1
    first = last - F.col("__c") + 1
    hit = lambda r: F.max(F.when((first <= r) & (r <= last), F.col(value)))
    at = [F.lit(float(p)) * (F.col("__n") - 1) for p in ps]
    found = [_between(hit(F.floor(a)), hit(F.least(F.floor(a) + 1, F.col("__n") - 1)), F.first(a)) for a in at]
    return placed.groupBy(*by).agg(F.array(*found).alias(name)) if by else placed.agg(F.when(F.count("*") > 0, F.array(*found)).alias(name))


def with_quantiles(df: DataFrame, source: DataFrame, by: list[str], value: str | Column, ps: list[float], name: str = "q", **how) -> DataFrame:
    """df (one row a group) with the quantiles of source's groups."""
    return _joined(df, quantiles(source, by, value, ps, name=name, **how).withColumnsRenamed({c: f"__{c}" for c in by}), by, "left")
