"""Grouped features, cohorts, profiles, income signals, portfolios and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles, with_quantiles


def share_of(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def sufficiency(df: DataFrame, entity: str, day: str, is_deposit: Column, least_days: int = 20, least_rows: int = 60, least_deposits: int = 25) -> DataFrame:
    """Per entity days of history, rows and deposits, and whether all three are enough."""
    g = df.groupBy(entity).agg((F.datediff(F.max(day), F.min(day))).cast("long").alias("days_history"), F.count("*").alias("n_rows"), F.count_if(is_deposit).alias("n_deposits"))
    ok = (F.col("days_history") >= least_days) & (F.col("n_rows") >= least_rows) & (F.col("n_deposits") >= least_deposits)
    return g.withColumn("sufficient", ok)


def segment_stats(df: DataFrame, segment: str, value: str) -> DataFrame:
    """Size, share, mean, median, spread and extremes of a value per segment."""
    g = df.groupBy(segment).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"))
    g = with_quantiles(g, df, [segment], value, [0.5]).withColumn("median", F.col("q")[0]).drop("q")
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def periodicity(df: DataFrame, entity: str, order: list[str], least: int = 3) -> DataFrame:
    """Per entity the median gap in days between deposits, its coefficient of variation and the name of the rhythm."""
    w = Window.partitionBy(entity).orderBy(*order)
    gaps = df.withColumn("__g", (F.col("sec") - F.lag("sec").over(w)) / 86400.0)
    g = gaps.groupBy(entity).agg(F.percentile("__g", 0.5).alias("median_gap"), (F.stddev("__g") / F.avg("__g")).alias("gap_cv"), F.count("__g").alias("n_gaps")).where(F.col("n_gaps") >= least - 1)
    m = F.col("median_gap")
    name = F.when(m.between(6, 8), "weekly").when(m.between(13, 15), "biweekly").when(m.between(16, 17), "semimonthly").when(m.between(28, 32), "monthly").otherwise("irregular")
    return g.withColumn("rhythm", name)


def deposit_stability(df: DataFrame, entity: str, amount: str) -> DataFrame:
    """Mean, spread, coefficient of variation and a 0..1 stability score of amounts per entity."""
    g = df.groupBy(entity).agg(F.avg(amount).alias("mean"), F.stddev(amount).alias("std"), F.count("*").alias("n"))
    return g.withColumn("cv", F.when(F.col("mean") != 0, F.col("std") / F.abs("mean"))).withColumn("stability", F.when(F.col("cv").isNotNull(), 1 / (1 + F.col("cv"))))


def best_by(df: DataFrame, entity: str, choice: str, weight: Column) -> DataFrame:
    """The choice with the largest total weight per entity; the alphabetically first of equals."""
    totals = df.groupBy(entity, choice).agg(weight.alias("__w"))
    w = Window.partitionBy(entity).orderBy(F.desc("__w"), choice)
    return totals.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(entity, F.col(choice).alias("preferred"), F.col("__w").alias("weight"))


def cohorts(df: DataFrame, entity: str, day: str, unit: str = "month") -> DataFrame:
    """Active entities per first-activity cohort and number of periods since, with their share of period 0."""
    first = df.groupBy(entity).agg(F.date_trunc(unit, F.min(day)).cast("date").alias("cohort"))
    months = F.months_between(F.date_trunc(unit, day), F.col("cohort")).cast("long")
    active = df.join(first, entity).select(entity, "cohort", months.alias("period")).groupBy("cohort", "period").agg(F.count_distinct(entity).alias("active"))
    start = active.where("period = 0").select("cohort", F.col("active").alias("size"))
    return active.join(F.broadcast(start), "cohort").withColumn("retention", F.col("active") / F.col("size"))


def cohort_value(df: DataFrame, entity: str, day: str, value: str, unit: str = "year") -> DataFrame:
    """Entities by the unit of their first day: how many, and mean, total and median of their sums. Sums are of decimals, so
    that they don't depend on the order of the rows."""
    per = df.groupBy(entity).agg(F.date_trunc(unit, F.min(day)).cast("date").alias("cohort"), F.sum(F.col(value).cast("decimal(28,6)")).alias("v"))
    g = per.groupBy("cohort").agg(F.count("*").alias("n"), F.sum("v").cast("double").alias("total")).withColumn("mean", F.col("total") / F.col("n"))
    return with_quantiles(g, per, ["cohort"], "v", [0.5]).withColumn("median", F.col("q")[0]).drop("q")


def rfm(df: DataFrame, entity: str, day: str, value: str) -> DataFrame:
    """Recency in days before the latest day of all, frequency, monetary total."""
    last = df.agg(F.max(day).alias("__max"))
    g = df.groupBy(entity).agg(F.max(day).alias("__last"), F.count("*").alias("frequency"), F.sum(value).alias("monetary"))
    return g.crossJoin(F.broadcast(last)).select(entity, F.datediff("__max", "__last").cast("long").alias("recency"), "frequency", "monetary")


def source_consistency(df: DataFrame, entity: str, source: str, order: list[str]) -> DataFrame:
    """Per entity how often the source changes, entropy over its maximum, and the share of the main source."""
    w = Window.partitionBy(entity).orderBy(*order)
    change = df.withColumn("__c", (F.col(source) != F.lag(source).over(w)).cast("double")).groupBy(entity).agg(F.avg("__c").alias("change_rate"))
    share = df.groupBy(entity, source).agg(F.count("*").alias("__n")).withColumn("__p", F.col("__n") / F.sum("__n").over(Window.partitionBy(entity)))
    spread = share.groupBy(entity).agg(F.sum(-F.col("__p") * F.log2("__p")).alias("__h"), F.count("*").alias("__k"), F.max("__p").alias("dominance"))
    return spread.join(change, entity).select(entity, "change_rate", F.when(F.col("__k") > 1, F.col("__h") / F.log2(F.col("__k"))).otherwise(0.0).alias("entropy_ratio"), "dominance")


def income_deposits(df: DataFrame, entity: str, text: str, keywords: list[str], since: str) -> DataFrame:
    """Deposits since a day with keyword flag, gap to the one before and a kind."""
    w = Window.partitionBy(entity).orderBy("ts", "event_id")
    rows = df.where((F.col("amount") > 0) & (F.col("day") >= F.lit(since).cast("date"))).withColumn("gap_days", (F.col("sec") - F.lag("sec").over(w)) / 86400.0)
    rows = rows.withColumn("keyword", F.lower(text).rlike("|".join(keywords)))
    kind = F.when(F.col("keyword"), "activity").when(F.col("gap_days").between(6, 8), "weekly").when(F.col("gap_days") < 1, "frequent").otherwise("other")
    return rows.withColumn("kind", kind)


def trend(df: DataFrame, entity: str, x: str, y: str) -> DataFrame:
    """Per entity slope, R2 and a label of y over x."""
    g = df.groupBy(entity).agg(F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r2"), F.count("*").alias("n"))
    return g.withColumn("trend", F.when(F.col("n") < 3, "unknown").when(F.col("r2") < 0.3, "stable").when(F.col("slope") > 0, "up").otherwise("down"))


def transitions(df: DataFrame, entity: str, order: list[str], state: str, smoothing: float = 0.0, states: list[str] = ()) -> DataFrame:
    """Counts of consecutive states and their row-wise probabilities, optionally smoothed over a given set of states."""
    w = Window.partitionBy(entity).orderBy(*order)
    steps = df.select(F.col(state).alias("from_state"), F.lead(state).over(w).alias("to_state")).where(F.col("to_state").isNotNull())
    counts = steps.groupBy("from_state", "to_state").agg(F.count("*").alias("n"))
    share = (F.col("n") + smoothing) / (F.sum("n").over(Window.partitionBy("from_state")) + smoothing * len(states))
    return counts.withColumn("probability", share)


def cleaned(df: DataFrame, entity: str, value: str, least: int, cut: float) -> DataFrame:
    """Nulls filled by the entity's median, values cut at a global percentile, entities with too few rows left out."""
    med = df.groupBy(entity).agg(F.percentile(value, 0.5).alias("__m"), F.count("*").alias("__n"))
    top = quantiles(df, [], value, [cut]).select(F.col("q")[0].alias("__top"))
    rows = df.join(med, entity).where(F.col("__n") >= least).crossJoin(F.broadcast(top))
    return rows.withColumn(value, F.least(F.coalesce(value, "__m"), "__top")).drop("__m", "__n", "__top")


def long_form(df: DataFrame, columns: list[str], extra: list[str] = ()) -> DataFrame:
    """(extra, feature, value): one row per column and row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*extra, F.explode(pairs).alias("__p")).select(*extra, "__p.*")


def missing_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and rate per column, from one aggregation."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("nulls")) for c in columns])
    return one.select("__n", F.explode(pairs).alias("p")).select("p.*", F.when(F.col("__n") > 0, F.col("p.nulls") / F.col("__n")).alias("rate"))


def distribution_report(df: DataFrame, columns: list[str], critical: float = 5.991) -> DataFrame:
    """Moments per column and a normality flag: the Jarque-Bera statistic against the 5 % point of chi-square with two
    degrees of freedom."""
    rows = long_form(df, columns)
    g = rows.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev("value").alias("std"), F.min("value").alias("low"), F.max("value").alias("high"), F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurtosis"))
    g = with_quantiles(g, rows, ["feature"], "value", [0.5]).withColumn("median", F.col("q")[0]).drop("q")
    jb = F.col("n") / 6 * (F.col("skew") ** 2 + F.col("kurtosis") ** 2 / 4)
    return g.withColumn("jarque_bera", jb).withColumn("normal", F.col("jarque_bera") < critical)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) of all column pairs, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}~{b}").alias("r")) for a, b in pairs])).alias("p")).select("p.*")


def feature_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing rate, distinct values and variance per column, with a verdict."""
    g = long_form(df, columns).groupBy("feature").agg(F.avg(F.col("value").isNull().cast("double")).alias("missing"), F.count_distinct("value").alias("distinct_values"), F.var_samp("value").alias("variance"))
    return g.withColumn("usable", (F.col("missing") < 0.5) & (F.col("distinct_values") > 1) & (F.col("variance") > 0))


def imbalance(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.max_by(column, F.struct("n", column)).alias("most"), F.min_by(column, F.struct("n", column)).alias("least"), (F.max("n") / F.min("n")).alias("ratio"))


def posterior_normal(df: DataFrame, entity: str, value: str, prior_mean: float, prior_var: float, noise_var: float) -> DataFrame:
    """Normal-normal posterior of an entity's level: closed form from count and sum."""
    g = df.groupBy(entity).agg(F.count(value).alias("n"), F.sum(value).alias("s"))
    precision = 1 / prior_var + F.col("n") / noise_var
    return g.select(entity, ((prior_mean / prior_var + F.col("s") / noise_var) / precision).alias("posterior_mean"), (1 / precision).alias("posterior_var"))


def registry_rows(df: DataFrame, group: dict[str, str]) -> DataFrame:
    """Feature metadata: name, type, group and null rate of each column."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.lit(group.get(c, "other")).alias("family"), F.col(c).alias("null_rate")) for c, t in df.dtypes])
    return one.select(F.explode(rows).alias("r")).select("r.*")
