"""Per-entity deposit and contact profiles, and column profiles of data-quality reports, each from partial aggregates.

A ratio with a zero or null denominator is null; an entity without a qualifying row isn't returned unless stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import long_form, share_of
from .quantiles import quantiles, quantiles_of_counts, with_quantiles


def ramp(value: Column, low: float, high: float) -> Column:
    """0 up to low, 1 from high, linear between."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low)))


def corr(a: Column | str, b: Column | str) -> Column:
    """Pearson's r, null where a side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def data_sufficiency(df: DataFrame, entity: str, day: str, amount: str, days: tuple[int, int], rows: tuple[int, int], deposits: tuple[int, int], enough: float = 0.5) -> DataFrame:
    """Per entity days of history, counts, a score of 0.4 days, 0.3 deposits, 0.3 rows (each from its least to its ideal
    number), a flag, the recommended model and whether all least numbers are there."""
    g = df.groupBy(entity).agg(F.datediff(F.max(day), F.min(day)).cast("long").alias("days_history"), F.count("*").alias("n_rows"), F.count_if(F.col(amount) > 0).alias("n_deposits"), F.count_if(F.col(amount) < 0).alias("n_expenses"))
    g = g.withColumn("score", 0.4 * ramp(F.col("days_history"), *days) + 0.3 * ramp(F.col("n_deposits"), *deposits) + 0.3 * ramp(F.col("n_rows"), *rows))
    flag = F.when(F.col("score") >= 0.7, "sufficient").when(F.col("score") >= enough, "marginal").otherwise("insufficient")
    allowed = (F.col("days_history") >= days[0]) & (F.col("n_rows") >= rows[0]) & (F.col("n_deposits") >= deposits[0])
    return g.withColumn("flag", flag).withColumn("model", F.when(F.col("flag") == "sufficient", "challenger").otherwise("champion")).withColumn("allowed", allowed)


def fallback_income(df: DataFrame, entity: str, amount: str) -> DataFrame:
    """Per entity totals, averages and the crude income of two average deposits for each of 26 fortnights."""
    x = F.col(amount)
    g = df.groupBy(entity).agg(F.count("*").alias("n"), F.avg(x).alias("mean_amount"), F.sum(F.when(x > 0, x).otherwise(0.0)).alias("deposits"), F.sum(F.when(x < 0, -x).otherwise(0.0)).alias("expenses"), F.avg(F.when(x > 0, x)).alias("mean_deposit"))
    return g.withColumn("income", F.col("mean_deposit") * 2 * 26)


def deposit_periodicity(df: DataFrame, entity: str, order: list[str], least: int = 3) -> DataFrame:
    """Per entity of at least least deposits: gaps in days (median, spread, variation), rhythm, confidence, paycheck flag."""
    w = Window.partitionBy(entity).orderBy(*order)
    gaps = df.withColumn("__g", (F.col("sec") - F.lag("sec").over(w)) / 86400.0)
    g = gaps.groupBy(entity).agg(F.count("*").alias("n"), F.percentile("__g", 0.5).alias("median_gap"), F.stddev("__g").alias("gap_std"), (F.stddev("__g") / F.avg("__g")).alias("gap_cv")).where(F.col("n") >= least)
    m = F.floor("median_gap")
    rhythm = F.when(m.between(6, 8), "weekly").when(m.between(13, 15), "biweekly").when(m.between(16, 17), "semimonthly").when(m.between(28, 32), "monthly").otherwise("irregular")
    fit = F.when(F.col("rhythm").isin("biweekly", "monthly"), 1.0).when(F.col("rhythm").isin("weekly", "semimonthly"), 0.9).otherwise(0.3)
    score = 0.3 * F.least(F.lit(1.0), F.col("n") / 10) + 0.4 * (1 - F.col("gap_cv")) + 0.3 * fit
    g = g.withColumn("rhythm", rhythm).withColumn("confidence", F.when(F.col("gap_cv").isNull() | (F.col("gap_cv") > 1), 0.0).otherwise(score))
    return g.withColumn("paycheck", (F.col("rhythm") != "irregular") & (F.col("confidence") >= 0.6))


def deposit_spread(df: DataFrame, entity: str, amount: str) -> DataFrame:
    """Per entity mean, spread, extremes, quartiles, variation, median absolute deviation, mean of the middle 80 %, and a
    score of 0.5 low variation, 0.3 number and 0.2 symmetry."""
    g = df.groupBy(entity).agg(F.count(amount).alias("n"), F.avg(amount).alias("mean"), F.stddev(amount).alias("std"), F.min(amount).alias("low"), F.max(amount).alias("high"), F.percentile(amount, [0.5, 0.25, 0.75, 0.1, 0.9]).alias("__q"))
    q = {name: F.col("__q")[i].alias(name) for i, name in enumerate(("median", "p25", "p75", "__a", "__b"))}
    g = g.select(entity, "n", "mean", "std", "low", "high", *q.values())
    inner = df.join(g.select(entity, "median", "__a", "__b"), entity)
    x = F.col(amount)
    second = inner.groupBy(entity).agg(F.percentile(F.abs(x - F.col("median")), 0.5).alias("mad"), F.avg(F.when(x.between(F.col("__a"), F.col("__b")), x)).alias("trimmed_mean"))
    g = g.drop("__a", "__b").join(second, entity).withColumn("cv", F.when(F.col("mean") != 0, F.col("std") / F.col("mean")))
    steady = F.when(F.col("cv").isNull() | (F.col("cv") < 0), 0.0).otherwise(1 - ramp(F.col("cv"), 0.2, 1.0))
    symmetry = F.when(F.col("median").isNull() | (F.col("median") == 0), 0.5).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(F.col("mean") / F.col("median") - 1)))
    score = 0.5 * steady + 0.3 * F.least(F.lit(1.0), F.col("n") / 10) + 0.2 * symmetry
    return g.withColumn("score", F.when(F.col("n") < 3, 0.0).otherwise(score))


def deposit_confidence(df: DataFrame, entity: str, amount: str, order: list[str], keyword: Column, large: float) -> DataFrame:
    """0..1 per entity: 0.25 number (12 are enough), 0.25 steady amounts, 0.20 steady gaps (0.5 without a gap), 0.15 share
    with a keyword, 0.15 share of large deposits."""
    w = Window.partitionBy(entity).orderBy(*order)
    rows = df.withColumn("__g", F.col("sec") - F.lag("sec").over(w)).withColumn("__k", F.coalesce(keyword, F.lit(False)))
    g = rows.groupBy(entity).agg(F.count("*").alias("n"), (F.stddev(amount) / F.avg(amount)).alias("cv"), F.count("__g").alias("gaps"), (F.stddev("__g") / F.avg("__g")).alias("gap_cv"), share_of(F.col("__k")).alias("keyword"), share_of(F.col(amount) >= large).alias("large"))
    steady = F.greatest(F.lit(0.0), 1 - F.coalesce("cv", F.lit(1.0)))
    timing = F.when(F.col("gaps") == 0, 0.5).otherwise(F.greatest(F.lit(0.0), 1 - F.coalesce("gap_cv", F.lit(1.0))))
    return g.withColumn("confidence", 0.25 * F.least(F.lit(1.0), F.col("n") / 12) + 0.25 * steady + 0.2 * timing + 0.15 * F.col("keyword") + 0.15 * F.col("large"))


def promises(df: DataFrame, entity: str, status: str, day: str, amount: str, kinds: dict[str, str], now: str) -> DataFrame:
    """Per entity 13 features of promises to pay; kinds names the status of kept, broken, partial and open ones."""
    hit = {k: F.col(status) == v for k, v in kinds.items()}
    g = df.groupBy(entity).agg(F.count("*").alias("made"), *[F.count_if(c).alias(k) for k, c in hit.items()], F.avg(amount).alias("mean_amount"), F.sum(F.when(hit["kept"], F.col(amount)).otherwise(0.0)).alias("__k"), F.sum(amount).alias("__t"), F.max(F.struct(F.to_date(day).alias("d"), F.col(amount).alias("a"))).alias("__l"))
    since = F.datediff(F.lit(now).cast("date"), "__l.d").cast("long")
    g = g.withColumns({"kept_rate": F.col("kept") / F.col("made"), "broken_rate": F.col("broken") / F.col("made"), "kept_ratio": F.when(F.col("__t") > 0, F.col("__k") / F.col("__t")).otherwise(0.0), "last_day": F.col("__l.d"), "last_amount": F.col("__l.a"), "days_since_last": since})
    return g.withColumn("recency", F.when(since <= 30, 1.0).when(since <= 90, 0.5).otherwise(0.0)).drop("__k", "__t", "__l")


def contacts(df: DataFrame, entity: str, kind: str, sec: str, now: int, answered: list[str], promised: str, paid: str) -> DataFrame:
    """Per entity contacts in 7, 30 and 90 days, days since the last one, response rate, promises and the rate of promises
    to payments."""
    age = (F.lit(now) - F.col(sec)) / 86400.0
    n = lambda k: F.count_if(F.col(kind) == k)
    g = df.groupBy(entity).agg(*[F.count_if(age <= d).alias(f"contacts_{d}d") for d in (7, 30, 90)], F.min(age).alias("days_since_last"), share_of(F.col(kind).isin(answered)).alias("response_rate"), n(promised).alias("promises"), n(paid).alias("__p"))
    return g.withColumn("promise_rate", F.when(F.col("__p") > 0, F.col("promises") / F.col("__p"))).drop("__p")


def payer_spread(df: DataFrame, by: str, value: str, least: float) -> DataFrame:
    """Per group the share of payers (above least), and of payers' values mean, median, spread, extremes, p25, p75, p90."""
    paid = F.when(F.col(value) > least, F.col(value))
    g = df.groupBy(by).agg(share_of(F.col(value) > least).alias("payment_rate"), F.avg(paid).alias("mean"), F.stddev(paid).alias("std"), F.min(paid).alias("low"), F.max(paid).alias("high"))
    g = with_quantiles(g, df, [by], paid, [0.5, 0.25, 0.75, 0.9])
    return g.select(by, "payment_rate", "mean", "std", "low", "high", *[F.col("q")[i].alias(n) for i, n in enumerate(("median", "p25", "p75", "p90"))])


def null_patterns(df: DataFrame, columns: list[str], least: float = 0.7) -> DataFrame:
    """(feature, nulls, rate, rows_with_nulls, tied_to): null counts per column, how many rows have any null, and the other
    columns whose null marks correlate by more than least. One aggregation."""
    gone = {c: F.col(c).isNull().cast("double") for c in columns}
    pairs = [(a, b) for a in columns for b in columns if a < b]
    one = df.agg(F.count("*").alias("__n"), F.count_if(F.greatest(*gone.values()) > 0 if len(columns) > 1 else gone[columns[0]] > 0).alias("__r"), *[F.sum(x).cast("long").alias(c) for c, x in gone.items()], *[corr(gone[a], gone[b]).alias(f"{a}~{b}") for a, b in pairs])
    tied = lambda c: F.array_sort(F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(F.col(f"{a}~{b}") > least, F.lit(b if a == c else a)) for a, b in pairs if c in (a, b)])))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("nulls"), tied(c).alias("tied_to")) for c in columns])
    return one.select("__n", F.col("__r").alias("rows_with_nulls"), F.explode(rows).alias("p")).select("p.feature", "p.nulls", F.when(F.col("__n") > 0, F.col("p.nulls") / F.col("__n")).alias("rate"), "rows_with_nulls", F.array_join("p.tied_to", ",").alias("tied_to"))


def outliers(df: DataFrame, columns: list[str], k: float = 1.5, z: float = 3.0) -> DataFrame:
    """Per column how many values lie outside the quartile fences and beyond z standard deviations, as counts and shares, and
    a severity by the share outside the fences."""
    one = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}~m"), F.stddev(c).alias(f"{c}~s"))])
    fences = {r["feature"]: r["q"] for r in quantiles(long_form(df, columns), ["feature"], "value", [0.25, 0.75]).collect()}  # a row a column
    level = lambda c: (fences[c][0] - k * (fences[c][1] - fences[c][0]), fences[c][1] + k * (fences[c][1] - fences[c][0])) if c in fences else (None, None)
    both = df.crossJoin(F.broadcast(one))
    found = both.agg(*[e for c in columns for e in (F.count(c).alias(f"{c}~n"), F.count_if((F.col(c) < level(c)[0]) | (F.col(c) > level(c)[1])).alias(f"{c}~i"), F.count_if(F.abs(F.col(c) - F.col(f"{c}~m")) > z * F.col(f"{c}~s")).alias(f"{c}~z"))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}~n").alias("n"), F.col(f"{c}~i").alias("iqr_outliers"), F.col(f"{c}~z").alias("z_outliers")) for c in columns])
    g = found.select(F.explode(rows).alias("r")).select("r.*").withColumns({"iqr_rate": F.when(F.col("n") > 0, F.col("iqr_outliers") / F.col("n")), "z_rate": F.when(F.col("n") > 0, F.col("z_outliers") / F.col("n"))})
    return g.withColumn("severity", F.when(F.col("iqr_rate") > 0.1, "high").when(F.col("iqr_rate") > 0.05, "medium").otherwise("low"))


def consistency(df: DataFrame, key: list[str], target: str, numeric: list[str], least: float = 0.95) -> DataFrame:
    """(finding, columns, n): repeated rows and keys, constant columns, identical column pairs, numeric columns that correlate
    with the target by more than least."""
    names = df.columns
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    whole = df.groupBy(*names).agg(F.count("*").alias("__c")).agg(F.sum(F.col("__c") - 1).alias("rows"))
    keys = df.groupBy(*key).agg(F.count("*").alias("__c")).agg(F.sum(F.col("__c") - 1).alias("keys"))
    one = df.agg(*[(F.min(c).eqNullSafe(F.max(c)) & ~(F.count(c).between(1, F.count("*") - 1))).alias(f"={c}") for c in names], *[F.bool_and(F.col(a).cast("string").eqNullSafe(F.col(b).cast("string"))).alias(f"{a}~{b}") for a, b in pairs], *[corr(c, target).alias(f"r{c}") for c in numeric if c != target])
    row = lambda finding, columns, n: F.struct(F.lit(finding).alias("finding"), F.lit(columns).alias("columns"), n.cast("long").alias("n"))
    rows = [row("repeated rows", "*", F.coalesce("rows", F.lit(0))), row("repeated keys", ",".join(key), F.coalesce("keys", F.lit(0)))]
    rows += [F.when(F.col(f"={c}"), row("constant", c, F.lit(1))) for c in names] + [F.when(F.col(f"{a}~{b}"), row("identical", f"{a},{b}", F.lit(1))) for a, b in pairs]
    rows += [F.when(F.abs(F.col(f"r{c}")) > least, row("like the target", c, F.lit(1))) for c in numeric if c != target]
    return whole.crossJoin(keys).crossJoin(one).select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")


def univariate(df: DataFrame, numeric: list[str], categorical: list[str], k: int = 3) -> DataFrame:
    """(feature, n, missing, uniques, mean, std, low, p25, median, p75, high, skew, top): one row per column; top are the k
    most frequent values of a categorical one with their counts."""
    counts = long_form(df, numeric).groupBy("feature", "value").agg(F.count("*").alias("c"))
    there = F.when(F.col("value").isNotNull(), F.col("c")).otherwise(0)
    v, c = F.col("value"), F.col("c")
    g = counts.groupBy("feature").agg(F.sum(there).alias("n"), F.sum(c - there).alias("missing"), F.count("value").alias("uniques"), F.sum(c * v).alias("s1"), F.sum(c * v * v).alias("s2"), F.sum(c * v * v * v).alias("s3"), F.min("value").alias("low"), F.max("value").alias("high"))
    g = g.join(quantiles_of_counts(counts, ["feature"], "value", "c", [0.25, 0.5, 0.75]), "feature", "left")
    n = F.col("n")
    mean, var = F.col("s1") / n, F.col("s2") / n - (F.col("s1") / n) ** 2
    numbers = g.select("feature", "n", "missing", "uniques", mean.alias("mean"), F.sqrt(var * n / (n - 1)).alias("std"), "low", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p75"), "high", ((F.col("s3") / n - 3 * mean * F.col("s2") / n + 2 * mean**3) / var**1.5).alias("skew"), F.lit(None).cast("string").alias("top"))
    text = df.select(F.explode(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(x).cast("string").alias("value")) for x in categorical])).alias("p")).select("p.*").groupBy("feature", "value").agg(F.count("*").alias("c"))
    ranked = text.withColumn("at", F.row_number().over(Window.partitionBy("feature").orderBy(F.col("value").isNull(), F.desc("c"), "value")))
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("at") <= k) & F.col("value").isNotNull(), F.struct("at", "value", "c")))), lambda x: F.concat_ws(":", x["value"], x["c"].cast("string"))), ",")
    none = F.lit(None).cast("double")
    words = ranked.groupBy("feature").agg(F.sum(F.when(F.col("value").isNotNull(), F.col("c")).otherwise(0)).alias("n"), F.sum(F.when(F.col("value").isNull(), F.col("c")).otherwise(0)).alias("missing"), F.count("value").alias("uniques"), top.alias("top"))
    return numbers.unionByName(words.select("feature", "n", "missing", "uniques", *[none.alias(x) for x in ("mean", "std", "low", "p25", "median", "p75", "high", "skew")], "top"))


def tests(df: DataFrame, number: str, other: str, flag: str, group: str, kind: str, bins: int = 5) -> DataFrame:
    """(test, statistic) by type of pair: pearson of two numbers, Welch's t of a number by a flag, ANOVA's F by a group,
    chi-square of two categories, and the mutual information of equal-width bins of the number with the group."""
    from .statistics import anova, chi_square

    r = df.agg(corr(number, other).alias("statistic")).select(F.lit("pearson").alias("test"), "statistic")
    one = lambda k, f: f(F.when(F.col(flag) == k, F.col(number)))
    t = df.agg(((one(True, F.avg) - one(False, F.avg)) / F.sqrt(one(True, F.var_samp) / one(True, F.count) + one(False, F.var_samp) / one(False, F.count))).alias("statistic")).select(F.lit("welch").alias("test"), "statistic")
    f = anova(df, group, number).select(F.lit("anova").alias("test"), F.col("f_statistic").alias("statistic"))
    c = chi_square(df, group, kind).select(F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"))
    ends = df.agg(F.min(number).alias("__a"), F.max(number).alias("__b"))
    bin_of = F.least(F.lit(bins - 1), F.floor((F.col(number) - F.col("__a")) / (F.col("__b") - F.col("__a")) * bins))
    cells = df.crossJoin(F.broadcast(ends)).groupBy(bin_of.alias("x"), F.col(group).alias("y")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    p = cells.select("n", total.alias("t"), F.sum("n").over(Window.partitionBy("x")).alias("a"), F.sum("n").over(Window.partitionBy("y")).alias("b"))
    m = p.agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("a") * F.col("b")))).alias("statistic")).select(F.lit("mutual information").alias("test"), "statistic")
    return r.unionByName(t).unionByName(f).unionByName(c).unionByName(m)


def meta_features(df: DataFrame, columns: list[str], group: str) -> DataFrame:
    """One row on the shape of a table: rows, columns, mean skewness and kurtosis, share of zeros, mean and largest absolute
    correlation, imbalance of a group (largest to smallest)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    n = F.lit(float(len(columns)))
    mean = lambda f: sum((f(c) for c in columns), F.lit(0.0)) / n
    one = df.agg(F.count("*").alias("rows"), F.lit(len(columns)).cast("long").alias("columns"), mean(F.skewness).alias("mean_skew"), mean(F.kurtosis).alias("mean_kurtosis"), mean(lambda c: share_of(F.col(c) == 0)).alias("sparsity"), *[F.abs(corr(a, b)).alias(f"{a}~{b}") for a, b in pairs])
    rs = [F.col(f"{a}~{b}") for a, b in pairs]
    sizes = df.groupBy(group).agg(F.count("*").alias("c")).agg((F.max("c") / F.min("c")).alias("imbalance"))
    return one.crossJoin(sizes).select("rows", "columns", "mean_skew", "mean_kurtosis", "sparsity", (sum(rs, F.lit(0.0)) / len(rs)).alias("mean_correlation"), (F.greatest(*rs) if len(rs) > 1 else rs[0]).alias("max_correlation"), "imbalance")


def task_similarity(a: DataFrame, b: DataFrame) -> DataFrame:
    """(similarity): cosine of two rows of meta features, each on the scale of its larger value."""
    names = [c for c in a.columns]
    pair = a.select(F.array(*[F.col(c).cast("double") for c in names]).alias("x")).crossJoin(b.select(F.array(*[F.col(c).cast("double") for c in names]).alias("y")))
    scaled = pair.select(F.zip_with("x", "y", lambda p, q: F.struct((p / F.greatest(F.abs(p), F.abs(q), F.lit(1e-12))).alias("p"), (q / F.greatest(F.abs(p), F.abs(q), F.lit(1e-12))).alias("q"))).alias("z"))
    dot = lambda f: F.aggregate("z", F.lit(0.0), lambda s, v: s + f(v))
    return scaled.select((dot(lambda v: v["p"] * v["q"]) / F.sqrt(dot(lambda v: v["p"] * v["p"]) * dot(lambda v: v["q"] * v["q"]))).alias("similarity"))
