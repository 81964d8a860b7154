"""Rolling, lagged and event-based features of entity time series.

Time windows are closed intervals [t - n days, t] over whole seconds; rows at the same second belong to each other's
window. One shuffle by entity serves every feature of a call. Row-based functions order by (ts, tiebreak)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "avg": F.avg, "count": F.count, "std": F.stddev, "min": F.min, "max": F.max}


def back(entity: str, days: float, sec: str = "sec") -> WindowSpec:
    """The closed window of the last days."""
    return Window.partitionBy(entity).orderBy(sec).rangeBetween(-int(days * 86400), 0)


def rolling(df: DataFrame, entity: str, value: str, days: tuple[int, ...] = (7, 30, 90), aggs: tuple[str, ...] = ("sum", "avg", "count", "std", "min", "max"), group: str = "") -> DataFrame:
    """{value}_{agg}_{n}d for each aggregate and window, suffixed by the window group where one is named."""
    tail = f"_{group}" if group else ""
    return df.select("*", *[AGGREGATES[a](value).over(back(entity, n)).alias(f"{value}_{a}_{n}d{tail}") for n in days for a in aggs])


def tag_counts(df: DataFrame, entity: str, tag: str, values: list[str], days: int) -> DataFrame:
    """For each tag value the number of rows with it in the window."""
    return df.select("*", *[F.sum(F.when(F.col(tag) == v, 1).otherwise(0)).over(back(entity, days)).alias(f"{v}_count_{days}d") for v in values])


def category_sums(df: DataFrame, entity: str, category: str, value: str, values: list[str], days: int) -> DataFrame:
    return df.select("*", *[F.sum(F.when(F.col(category) == v, F.col(value)).otherwise(0.0)).over(back(entity, days)).alias(f"{v}_sum_{days}d") for v in values])


def liquidity(df: DataFrame, entity: str, amount: str, balance: str, days: int) -> DataFrame:
    """Income, expense, their ratio (null without expense), mean and spread of balance, net flow."""
    w = back(entity, days)
    income, expense = F.sum(F.when(F.col(amount) > 0, F.col(amount)).otherwise(0.0)).over(w), F.sum(F.when(F.col(amount) < 0, -F.col(amount)).otherwise(0.0)).over(w)
    return df.select("*", income.alias("income"), expense.alias("expense"), F.when(expense != 0, income / expense).alias("income_expense_ratio"), F.avg(balance).over(w).alias("avg_balance"), F.stddev(balance).over(w).alias("balance_volatility"), F.sum(amount).over(w).alias("net_flow"))


def lags(df: DataFrame, entity: str, order: list[str], value: str, steps: tuple[int, ...] = (1, 7)) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(*order)
    return df.select("*", *[f(value, k).over(w).alias(f"{value}_{n}_{k}") for k in steps for n, f in (("lag", F.lag), ("lead", F.lead))])


def growing_windows(df: DataFrame, entity: str, value: str, days: tuple[int, ...]) -> DataFrame:
    """Means over growing windows, and each mean less the next longer one."""
    mean = {n: F.avg(value).over(back(entity, n)) for n in days}
    return df.select("*", *[m.alias(f"{value}_mean_{n}d") for n, m in mean.items()], *[(mean[a] - mean[b]).alias(f"{value}_diff_{a}d_{b}d") for a, b in zip(days, days[1:], strict=False)])


def event_features(df: DataFrame, entity: str, event: str, kind: str) -> DataFrame:
    """Days since the last event of a kind (this row's included), its 30 and 60 day counts and its mean gap over 90 days."""
    upto = Window.partitionBy(entity).orderBy("sec").rangeBetween(Window.unboundedPreceding, 0)
    hit = F.col(event) == kind
    rows = df.withColumn("__last", F.max(F.when(hit, F.col("sec"))).over(upto))
    before = Window.partitionBy(entity).orderBy("sec").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__gap", F.when(hit, (F.col("sec") - F.max(F.when(hit, F.col("sec"))).over(before)) / 86400.0))
    count = lambda n: F.sum(hit.cast("long")).over(back(entity, n))
    return rows.select(*df.columns, ((F.col("sec") - F.col("__last")) / 86400.0).alias("days_since"), count(30).alias("count_30d"), count(60).alias("count_60d"), F.avg("__gap").over(back(entity, 90)).alias("mean_gap_90d"))


def velocity(df: DataFrame, entity: str, order: list[str], value: str, days: int) -> DataFrame:
    """Change per day since the row before, and its rolling mean, spread and range; null at equal times."""
    w = Window.partitionBy(entity).orderBy(*order)
    gap = (F.col("sec") - F.lag("sec").over(w)) / 86400.0
    rows = df.withColumn("velocity", F.when(gap > 0, (F.col(value) - F.lag(value).over(w)) / gap))
    b = back(entity, days)
    return rows.select("*", F.avg("velocity").over(b).alias("velocity_mean"), F.stddev("velocity").over(b).alias("velocity_std"), (F.max("velocity").over(b) - F.min("velocity").over(b)).alias("velocity_range"))


def momentum(df: DataFrame, entity: str, order: list[str], value: str, days: int) -> DataFrame:
    """Second difference, its rolling mean, how often it is positive or negative, and the share of positive ones."""
    w, b = Window.partitionBy(entity).orderBy(*order), back(entity, days)
    rows = df.withColumn("momentum", F.col(value) - 2 * F.lag(value).over(w) + F.lag(value, 2).over(w))
    up, down = F.sum((F.col("momentum") > 0).cast("long")).over(b), F.sum((F.col("momentum") < 0).cast("long")).over(b)
    return rows.select("*", F.avg("momentum").over(b).alias("momentum_mean"), up.alias("momentum_up"), down.alias("momentum_down"), F.when(up + down > 0, up / (up + down)).alias("momentum_ratio"))


def volatility(df: DataFrame, entity: str, value: str, days: int) -> DataFrame:
    b = back(entity, days)
    mean, std, low, high = (f(value).over(b) for f in (F.avg, F.stddev, F.min, F.max))
    iqr = F.percentile(value, 0.75).over(b) - F.percentile(value, 0.25).over(b)
    return df.select("*", std.alias("vol_std"), F.when(mean != 0, std / F.abs(mean)).alias("vol_cv"), (high - low).alias("vol_range"), iqr.alias("vol_iqr"), F.when(mean != 0, (high - low) / F.abs(mean)).alias("vol_relative_range"))


def elasticity(df: DataFrame, entity: str, order: list[str], value: str, reference: str, days: int) -> DataFrame:
    """Relative change of value per absolute relative change of reference; null where either base is 0 or nothing moved."""
    w, b = Window.partitionBy(entity).orderBy(*order), back(entity, days)
    change = lambda c: F.when(F.lag(c).over(w) != 0, F.col(c) / F.lag(c).over(w) - 1)
    rows = df.withColumn("__d", change(value)).withColumn("__r", F.abs(change(reference)))
    rows = rows.withColumn("elasticity", F.when(F.col("__r") > 0, F.col("__d") / F.col("__r"))).drop("__d", "__r")
    return rows.select("*", F.avg("elasticity").over(b).alias("elasticity_mean"), F.stddev("elasticity").over(b).alias("elasticity_std"), F.sum((F.abs("elasticity") > 2).cast("long")).over(b).alias("elastic_count"))


def stability(df: DataFrame, entity: str, order: list[str], value: str, days: int) -> DataFrame:
    """Rolling fit to a line over row numbers (R2), 1 - CV, lag-1 autocorrelation; nulls where undefined, as in a window of
    equal values."""
    w, b = Window.partitionBy(entity).orderBy(*order), back(entity, days)
    rows = df.withColumn("__i", F.row_number().over(w).cast("double")).withColumn("__p", F.lag(value).over(w))
    mean, std = F.avg(value).over(b), F.stddev(value).over(b)
    paired = lambda c, d: F.when(F.col(d).isNotNull(), F.col(c))
    spread = lambda c, d: F.nullif(F.stddev_pop(paired(c, d)).over(b), F.lit(0.0))
    corr = lambda c, d: F.covar_pop(c, d).over(b) / spread(c, d) / spread(d, c)  # noqa: E731  (F.corr divides by zero where one side is constant)
    fit, again = corr("__i", value), corr("__p", value)
    return rows.select(*df.columns, (fit * fit).alias("trend_r2"), F.when(mean != 0, 1 - std / F.abs(mean)).alias("consistency"), again.alias("autocorrelation"))


def latest(df: DataFrame, entity: str, order: list[str], columns: list[str]) -> DataFrame:
    """The newest row per entity, by partial aggregation instead of a sort."""
    return df.groupBy(entity).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__r")).select(entity, "__r.*")


def trimmed_mean(df: DataFrame, entity: str, value: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    rank = F.percent_rank().over(Window.partitionBy(entity).orderBy(value))
    return df.withColumn("__r", rank).where(F.col("__r").between(low, high)).groupBy(entity).agg(F.avg(value).alias("trimmed_mean"), F.count("*").alias("n"))


def global_rank(df: DataFrame, order: list[str], partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """1-based rank of each row in the total order, without a single-task sort. There are as many ranges as
    spark.sql.shuffle.partitions, which is set for the size of the data, unless another number is given. keep names the
    columns that come back (all).

    Rows are dealt by ranges of the order, once; each range is sorted and numbered where it lies and shifted by the counts of the
    ranges before it, a frame of one row per range. The ranges are written first, since both steps must see the same ones."""
    from tallgrass.sources.scratch import settle

    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the lower 33 bits of the id number a partition's rows in their order
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    dealt = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    ranged = settle(dealt.select(*(keep or df.columns), F.spark_partition_id().alias("__range"), own.alias("__own")), "ranges")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    return ranged.join(F.broadcast(before), "__range").withColumn("rank", F.col("__own") + F.col("__before")).drop("__range", "__own", "__before")


def running_sums(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """df with <column>_upto: sums over the total order, this row included. As in global_rank rows are dealt by ranges, each
    range is summed on its own, and a frame of one row per range brings what the ranges before it hold."""
    from tallgrass.sources.scratch import settle

    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(df.repartitionByRange(partitions, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__range", *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}") for c in columns])
    own = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(before), "__range").select(*df.columns, *[(F.sum(c).over(own) + F.col(f"__{c}")).alias(f"{c}_upto") for c in columns])


def ntile(df: DataFrame, order: list[str], bins: int, name: str = "bin") -> DataFrame:
    """Exact equal-count bins 1..bins of the total order (the first n mod bins bins hold one row more)."""
    n = df.count()
    small, more = n // bins, n % bins
    r = F.col("rank") - 1
    cut = more * (small + 1)
    place = F.when(r < cut, F.floor(r / (small + 1))).otherwise(more + F.floor((r - cut) / max(1, small)))
    return global_rank(df, order).withColumn(name, (place + 1).cast("long"))


def short_windows(df: DataFrame, entity: str, value: str, hours: tuple[int, ...] = (1, 6, 12, 24, 168)) -> DataFrame:
    """Count, sum, mean and max over the last hours, and the ratio of the shortest count to the longest."""
    spec = {h: Window.partitionBy(entity).orderBy("sec").rangeBetween(-3600 * h, 0) for h in hours}
    count = {h: F.count("*").over(w) for h, w in spec.items()}
    stats = {"sum": F.sum, "avg": F.avg, "max": F.max}
    return df.select("*", *[c.alias(f"count_{h}h") for h, c in count.items()], *[f(value).over(w).alias(f"{n}_{h}h") for n, f in stats.items() for h, w in spec.items()], (count[hours[0]] / count[hours[-1]]).alias("acceleration"))


def percent_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """The share of the other rows that are below, 0 for the smallest value and 0 for a lone row; null stays null. Counts per
    distinct value are summed up in order by ranges and joined back."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__c"))
    below = running_sums(counts, [value], ["__c"]).select(F.col(value).alias("__v"), (F.col("__c_upto") - F.col("__c")).alias("__below"))
    total = counts.agg(F.sum("__c").alias("__total"))
    found = df.join(below, df[value] == F.col("__v"), "left").crossJoin(F.broadcast(total))
    return found.withColumn(name, F.when(F.col("__total") > 1, F.col("__below") / (F.col("__total") - 1)).when(F.col("__below").isNotNull(), 0.0)).drop("__v", "__below", "__total")


def group_zscore(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """Standard score within groups from joined group statistics, so a large group isn't gathered in one task."""
    stats = df.groupBy(*by).agg(F.avg(value).alias("__m"), F.stddev(value).alias("__s")) if by else df.agg(F.avg(value).alias("__m"), F.stddev(value).alias("__s"))
    joined = df.join(stats, by) if by else df.crossJoin(F.broadcast(stats))
    return joined.withColumn(name, F.when(F.col("__s") > 0, (F.col(value) - F.col("__m")) / F.col("__s"))).drop("__m", "__s")


def amount_clusters(df: DataFrame, entity: str, value: str, eps: float = 0.3) -> DataFrame:
    """One-dimensional density clusters of standardised values: a gap above eps starts a new one, singletons are -1,
    entities with fewer than three rows are one cluster 0."""
    w = Window.partitionBy(entity)
    z = F.when(F.stddev_pop(value).over(w) > 0, (F.col(value) - F.avg(value).over(w)) / F.stddev_pop(value).over(w)).otherwise(0.0)
    rows = df.withColumn("__z", z).withColumn("__n", F.count("*").over(w))
    order = Window.partitionBy(entity).orderBy("__z", value)
    rows = rows.withColumn("__new", (F.col("__z") - F.lag("__z").over(order) > eps).cast("long"))
    run = F.sum(F.coalesce("__new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__run", run).withColumn("__size", F.count("*").over(Window.partitionBy(entity, "__run")))
    cluster = F.when(F.col("__n") < 3, 0).when(F.col("__size") < 2, -1).otherwise(F.col("__run"))
    return rows.select(*df.columns, cluster.cast("long").alias("cluster"))


def shocks(df: DataFrame, entity: str, order: list[str], value: str, threshold: float = 1.0) -> DataFrame:
    """Deviation from the centred three-row mean in its standard deviations, and whether it passes the threshold; to nine
    digits, as a value may lie exactly at a threshold."""
    w = Window.partitionBy(entity).orderBy(*order).rowsBetween(-1, 1)
    mean, std = F.avg(value).over(w), F.stddev(value).over(w)
    z = F.when(std > 0, (F.col(value) - mean) / std)
    near = F.round("shock_z", 9)
    return df.withColumn("shock_z", z).withColumn("shock", F.when(near > threshold, "up").when(near < -threshold, "down").otherwise("none"))


def diversity(df: DataFrame, entity: str, kind: str, order: list[str], days: int) -> DataFrame:
    """Distinct kinds and rows in the window, the share of repeats, and whether the row brings a new kind."""
    b = back(entity, days)
    distinct, n = F.size(F.collect_set(kind).over(b)).cast("long"), F.count("*").over(b)
    first = F.row_number().over(Window.partitionBy(entity, kind).orderBy(*order)) == 1
    return df.select("*", distinct.alias("distinct_kinds"), n.alias("n_rows"), (1 - distinct / n).alias("repeat_ratio"), first.alias("new_kind"))


def concentration(df: DataFrame, entity: str, kind: str, value: str, kinds: list[str], days: int) -> DataFrame:
    """Rolling Herfindahl index, entropy and top share of absolute value over a known small set of kinds; nulls where the
    window holds nothing but zeros."""
    b = back(entity, days)
    rows = df.select("*", F.sum(F.abs(value)).over(b).alias("__t"), *[F.sum(F.when(F.col(kind) == k, F.abs(value)).otherwise(0.0)).over(b).alias(f"__k{i}") for i, k in enumerate(kinds)])
    share = [F.when(F.col("__t") > 0, F.col(f"__k{i}") / F.col("__t")) for i in range(len(kinds))]
    entropy = sum((F.when(s > 0, -s * F.log(s)).when(s == 0, 0.0) for s in share), F.lit(0.0))
    return rows.select(*df.columns, sum((s * s for s in share), F.lit(0.0)).alias("hhi"), entropy.alias("entropy"), F.greatest(*share).alias("top_share"))


def outcome_leads(daily: DataFrame, entity: str, day: str, paid: str, bucket: str, ahead: int = 7) -> DataFrame:
    """daily (one row a day of each entity, without gaps) with what comes after each day: whether and how much is paid on the
    next one, the bucket so many days later, its change, and whether it is worse. Null where the days end before."""
    w = Window.partitionBy(entity).orderBy(day)
    after = F.lead(bucket, ahead).over(w)
    rows = daily.select("*", F.lead(paid).over(w).alias("next_amount"), after.alias(f"bucket_{ahead}d"))
    return rows.withColumns({"next_paid": F.col("next_amount") > 0, "bucket_change": F.col(f"bucket_{ahead}d") - F.col(bucket), "worse": F.coalesce(F.col(f"bucket_{ahead}d") > F.col(bucket), F.lit(False))})


def outcome_leaks(rows: DataFrame, day: str, outcome: str, as_of: str) -> DataFrame:
    """How many rows there are, how many have an outcome, and how many of these are dated on or after as_of, when nothing can
    have come after them yet."""
    known = F.col(outcome).isNotNull()
    return rows.agg(F.count("*").alias("n"), F.count_if(known).alias("known"), F.count_if(known & (F.col(day) >= F.lit(as_of).cast("date"))).alias("leaks"))


def regime_change(df: DataFrame, entity: str, order: list[str], value: str, rows: int = 5) -> DataFrame:
    """Flags rows whose trailing mean jumps by more than the spread before, or whose spread jumps by half of it."""
    w = Window.partitionBy(entity).orderBy(*order)
    found = df.withColumn("__m", F.avg(value).over(w.rowsBetween(-rows + 1, 0))).withColumn("__s", F.stddev(value).over(w.rowsBetween(-rows + 1, 0)))
    mean, std = F.lag("__m").over(w), F.lag("__s").over(w)
    return found.withColumn("regime_change", F.coalesce((F.abs(F.col("__m") - mean) > std) | (F.abs(F.col("__s") - std) > 0.5 * std), F.lit(False))).drop("__m", "__s")


def temporal_folds(df: DataFrame, day: str, cuts: list[tuple[str, str]]) -> DataFrame:
    """Expanding training data and a fixed test window for each (train end, test end): one row per row, fold and role."""
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b")) for i, (a, b) in enumerate(cuts)])
    rows = df.select("*", F.explode(folds).alias("__f")).where(F.col(day) < F.col("__f.b"))
    return rows.select(*df.columns, F.col("__f.fold").alias("fold"), F.when(F.col(day) < F.col("__f.a"), "train").otherwise("test").alias("role"))


def sequences(df: DataFrame, entity: str, order: list[str], columns: list[str], length: int) -> DataFrame:
    """The last rows of each entity as arrays, oldest first."""
    newest = Window.partitionBy(entity).orderBy(*[F.desc(c) for c in order])
    rows = df.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= length)
    packed = rows.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct((-F.col("__r")).alias("__r"), *columns))).alias("__a"))
    return packed.select(entity, *[F.col(f"__a.{c}").alias(c) for c in columns])


def sequence_codes(df: DataFrame, category: str, most: int) -> DataFrame:
    """(category, code): the most frequent values from 1 on, equal counts by name. At most so many rows; any other value is 0."""
    top = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), category).limit(most)
    return top.select(category, F.row_number().over(Window.orderBy(F.desc("__n"), category)).alias("code"))


def event_sequences(df: DataFrame, codes: DataFrame, moments: DataFrame, entity: str, time: str, order: list[str], value: str, category: str, length: int, before: bool = True) -> DataFrame:
    """entity, used (number of true events), and arrays of exactly length elements, oldest first: values by moments (one row
    mean, sd), seconds since the event before, and codes of the category (0 for one that codes lacks). Filled with 0.

    codes and moments are fitted once, on whatever rows are for learning, and serve all others."""
    from tallgrass.functions.curves import padded

    one = sequences(df, entity, order, [time, value, category], length)
    known = codes.agg(F.map_from_entries(F.collect_list(F.struct(category, "code"))).alias("__codes"))
    rows = one.crossJoin(F.broadcast(known)).crossJoin(F.broadcast(moments.select(F.col("mean").alias("__m"), F.col("sd").alias("__s"))))
    scale = F.transform(value, lambda x: F.when(F.col("__s") > 0, (x - F.col("__m")) / F.col("__s")).otherwise(0.0))
    seconds = F.transform(time, lambda t: t.cast("long"))
    gaps = F.transform(seconds, lambda t, i: F.when(i > 0, t - F.element_at(seconds, F.greatest(i, F.lit(1)))).otherwise(F.lit(0).cast("long")))
    named = F.transform(category, lambda k: F.coalesce(F.try_element_at("__codes", k), F.lit(0)))
    fill = {"values": (scale, F.lit(0.0)), "gaps": (gaps, F.lit(0).cast("long")), "codes": (named, F.lit(0))}
    return rows.select(entity, F.size(category).alias("used"), *[padded(c, length, z, before).alias(n) for n, (c, z) in fill.items()])


def decomposition(daily: DataFrame, series: str, day: str, value: str, period: int = 7) -> DataFrame:
    """Additive trend, seasonal and residual parts of a gap-free daily series."""
    w = Window.partitionBy(series).orderBy(day)
    rows = daily.withColumn("__trend", F.avg(value).over(w.rowsBetween(-(period // 2), period // 2))).withColumn("__phase", F.pmod(F.datediff(day, F.lit("2000-01-01")), F.lit(period)))
    rows = rows.withColumn("__d", F.col(value) - F.col("__trend"))
    seasonal = F.avg("__d").over(Window.partitionBy(series, "__phase")) - F.avg("__d").over(Window.partitionBy(series))
    return rows.select(series, day, value, F.col("__trend").alias("trend"), seasonal.alias("seasonal"), (F.col("__d") - seasonal).alias("residual"))


def filled_days(df: DataFrame, series: str, day: str, value: str) -> DataFrame:
    """One row per series and day between its first and last, missing days as 0."""
    ends = df.groupBy(series).agg(F.min(day).alias("a"), F.max(day).alias("b")).select(series, F.explode(F.sequence("a", "b")).alias(day))
    sums = df.groupBy(series, day).agg(F.sum(value).alias(value))
    return ends.join(sums, [series, day], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def rounded(df: DataFrame, keys: list[str], columns: list[str], digits: int = 4) -> DataFrame:
    """keys and columns, doubles rounded for comparison; the shift keeps exact halves off the rounding edge."""
    kinds = dict(df.dtypes)
    value = lambda c: F.round(F.col(c) + 1.3e-7, digits).alias(c) if kinds[c] in ("double", "float") else F.col(c)
    return df.select(*keys, *[value(c) for c in columns])


def rounded_by(df: DataFrame, keys: list[str], digits: dict[str, int]) -> DataFrame:
    """keys and columns, each double rounded for comparison to its own number of digits."""
    return df.select(*keys, *[F.round(F.col(c) + 1.3e-7, n).alias(c) for c, n in digits.items()])
