"""Drift, calibration, fairness, ranking, uplift and comparison statistics, each from few aggregations.

Statistics that need an order of all rows use operators.windows.global_rank, which sorts by ranges; cumulative sums run
over one row per distinct score or bin, never over the rows themselves in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import long_form
from .quantiles import quantiles
from .windows import ntile, running_sums


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """F statistic of group means, from grouped moments."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    one = g.agg(F.sum("n").alias("N"), F.count("*").alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("M"), F.sum((F.col("n") - 1) * F.col("v")).alias("within"), F.sum(F.col("n") * F.col("m") ** 2).alias("q"))
    between = F.col("q") - F.col("N") * F.col("M") ** 2
    return one.select(((between / (F.col("k") - 1)) / (F.col("within") / (F.col("N") - F.col("k")))).alias("f_statistic"))


def psi(base: DataFrame, now: DataFrame, columns: list[str], bins: int = 10, floor: float = 1e-4, alert: float = 0.25) -> DataFrame:
    """Population stability index per column on quantile bins of base. Edges are one row per column."""
    both = long_form(base, columns).withColumn("side", F.lit(0)).unionByName(long_form(now, columns).withColumn("side", F.lit(1))).where("value IS NOT NULL")
    edges = quantiles(both.where("side = 0"), ["feature"], "value", [i / bins for i in range(1, bins)]).select("feature", F.array_distinct("q").alias("edges"))
    rows = both.join(F.broadcast(edges), "feature").withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    counts = rows.groupBy("feature", "bin").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    w = Window.partitionBy("feature")
    p, q = (F.greatest(F.lit(floor), F.col(c) / F.sum(c).over(w)) for c in "ab")
    terms = counts.select("feature", ((q - p) * F.log(q / p)).alias("t"))
    return terms.groupBy("feature").agg(F.sum("t").alias("psi")).withColumn("drift", F.col("psi") >= alert)


def csi(base: DataFrame, now: DataFrame, column: str, floor: float = 1e-4) -> DataFrame:
    """Stability index of category shares; a category on one side only has the floor on the other."""
    both = base.select(column, F.lit(0).alias("side")).unionByName(now.select(column, F.lit(1).alias("side")))
    counts = both.groupBy(column).agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    w = Window.partitionBy()
    p, q = (F.greatest(F.lit(floor), F.col(c) / F.sum(c).over(w)) for c in "ab")
    return counts.select(((q - p) * F.log(q / p)).alias("t")).agg(F.sum("t").alias("csi"))


def shift(base: DataFrame, now: DataFrame, value: str, tolerance: float = 0.1) -> DataFrame:
    """Relative change of mean, spread and percentiles."""
    stats = lambda df, s: df.agg(F.avg(value).alias(f"mean_{s}"), F.stddev(value).alias(f"std_{s}")).crossJoin(quantiles(df, [], value, [0.1, 0.5, 0.9]).select(*[F.col("q")[i].alias(f"p{p}_{s}") for i, p in enumerate((10, 50, 90))]))
    one = stats(base, "a").crossJoin(stats(now, "b"))
    names = ["mean", "std", "p10", "p50", "p90"]
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(f"{n}_a").alias("base"), F.col(f"{n}_b").alias("now")) for n in names])).alias("r")).select("r.*")
    rows = rows.withColumn("change", F.when(F.col("base") != 0, (F.col("now") - F.col("base")) / F.abs("base")))
    return rows.withColumn("drift", F.abs("change") > tolerance)


def ks_two_sample(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Largest distance of the two distribution functions, with its asymptotic p-value."""
    both = a.select(value, F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(b.select(value, F.lit(0).alias("x"), F.lit(1).alias("y"))).where(F.col(value).isNotNull())
    steps = both.groupBy(value).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    ranked = running_sums(steps, [value], ["x", "y"])
    totals = steps.agg(F.sum("x").alias("n"), F.sum("y").alias("m"))
    gap = F.abs(F.col("x_upto") / F.col("n") - F.col("y_upto") / F.col("m"))
    d = ranked.crossJoin(F.broadcast(totals)).agg(F.max(gap).alias("ks"), F.first("n").alias("n"), F.first("m").alias("m"))
    en = F.sqrt(F.col("n") * F.col("m") / (F.col("n") + F.col("m")))
    lam = (en + 0.12 + 0.11 / en) * F.col("ks")
    tail = sum(((-1) ** (k - 1) * 2 * F.exp(-2 * k * k * lam * lam) for k in range(1, 20)), F.lit(0.0))
    return d.withColumn("p_value", F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square, degrees of freedom and Cramer's V of two categorical columns, from the observed cells alone: cells without
    a row add nothing to N * (sum of n^2 / (row * column) - 1)."""
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    rows = counts.groupBy(a).agg(F.sum("n").alias("r"))
    cols = counts.groupBy(b).agg(F.sum("n").alias("c"))
    cells = counts.join(rows, counts[a].eqNullSafe(rows[a])).drop(rows[a]).join(cols, counts[b].eqNullSafe(cols[b])).drop(cols[b])
    g = cells.agg(F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("c"))).alias("s"), F.sum("n").alias("total"), F.count_distinct(F.struct(a)).alias("i"), F.count_distinct(F.struct(b)).alias("j"))
    chi2 = F.col("total") * (F.col("s") - 1)
    return g.select(chi2.alias("chi2"), ((F.col("i") - 1) * (F.col("j") - 1)).alias("degrees"), F.when(F.least("i", "j") > 1, F.sqrt(chi2 / (F.col("total") * (F.least("i", "j") - 1)))).alias("cramers_v"))


def regression_metrics(df: DataFrame, y: str, p: str, by: list[str] = (), least: int = 10) -> DataFrame:
    """n, MAE, RMSE, R2 and means, overall or by group; groups under least rows are left out."""
    e = F.col(y) - F.col(p)
    g = df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("__e"), (F.var_pop(y) * F.count("*")).alias("__t"), F.avg(y).alias("mean_y"), F.avg(p).alias("mean_p"))
    return g.where(F.col("n") >= least).withColumn("r2", F.when(F.col("__t") > 0, 1 - F.col("__e") / F.col("__t"))).drop("__e", "__t")


def decile_calibration(df: DataFrame, y: str, p: str, order: list[str], bins: int = 10) -> DataFrame:
    """Mean prediction against mean outcome in equal-count bins of the prediction."""
    g = ntile(df, order, bins, "decile").groupBy("decile").agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(y).alias("mean_y"))
    return g.withColumn("error", F.abs(F.col("mean_p") - F.col("mean_y")))


def calibration(df: DataFrame, label: str, p: str, bins: int = 10) -> DataFrame:
    """Brier score, log loss, expected and maximum calibration error, Hosmer-Lemeshow, from one pass by probability bin."""
    c = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(p)))
    rows = df.withColumn("__b", F.least(F.lit(bins - 1), F.floor(F.col(p) * bins)))
    g = rows.groupBy("__b").agg(F.count("*").alias("n"), F.sum(p).alias("sp"), F.sum(label).alias("sy"), F.sum((F.col(p) - F.col(label)) ** 2).alias("b"), F.sum(-F.col(label) * F.log(c) - (1 - F.col(label)) * F.log(1 - c)).alias("l"))
    gap, mean = F.abs(F.col("sp") - F.col("sy")) / F.col("n"), F.col("sp") / F.col("n")
    return g.agg((F.sum("b") / F.sum("n")).alias("brier"), (F.sum("l") / F.sum("n")).alias("log_loss"), (F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"), F.max(gap).alias("mce"), F.sum((F.col("sy") - F.col("sp")) ** 2 / (F.col("n") * mean * (1 - mean))).alias("hosmer_lemeshow"))


def calibration_by(df: DataFrame, by: str, label: str, p: str, bins: int = 10) -> DataFrame:
    """calibration's figures for each value of by, with its number of rows."""
    c = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(p)))
    rows = df.withColumn("__b", F.least(F.lit(bins - 1), F.floor(F.col(p) * bins)))
    g = rows.groupBy(by, "__b").agg(F.count("*").alias("n"), F.sum(p).alias("sp"), F.sum(label).alias("sy"), F.sum((F.col(p) - F.col(label)) ** 2).alias("b"), F.sum(-F.col(label) * F.log(c) - (1 - F.col(label)) * F.log(1 - c)).alias("l"))
    gap, mean = F.abs(F.col("sp") - F.col("sy")) / F.col("n"), F.col("sp") / F.col("n")
    return g.groupBy(by).agg(F.sum("n").alias("n"), (F.sum("b") / F.sum("n")).alias("brier"), (F.sum("l") / F.sum("n")).alias("log_loss"), (F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"), F.max(gap).alias("mce"), F.sum((F.col("sy") - F.col("sp")) ** 2 / (F.col("n") * mean * (1 - mean))).alias("hosmer_lemeshow"))


def fairness(df: DataFrame, group: str, reference: str, approved: Column, label: Column) -> DataFrame:
    """Approval, true and false positive rates per group, with the ratio and gaps to the reference group."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.avg(approved.cast("double")).alias("approval"), F.avg(F.when(label, approved.cast("double"))).alias("tpr"), F.avg(F.when(~label, approved.cast("double"))).alias("fpr"))
    ref = g.where(F.col(group) == reference).select(F.col("approval").alias("__a"), F.col("tpr").alias("__t"), F.col("fpr").alias("__f"))
    rows = g.crossJoin(F.broadcast(ref)).withColumn("impact_ratio", F.col("approval") / F.col("__a"))
    return rows.select(*g.columns, "impact_ratio", (F.col("impact_ratio") >= 0.8).alias("passes"), (F.col("approval") - F.col("__a")).alias("parity_gap"), (F.col("tpr") - F.col("__t")).alias("opportunity_gap"), (F.col("fpr") - F.col("__f")).alias("fpr_gap"))


def classification(df: DataFrame, label: str, p: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1, AUC (ties count half), Gini and KS from counts per distinct score."""
    by = df.groupBy(p).agg(F.sum(label).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    ranked = running_sums(by, [p], ["pos", "neg"])
    totals = by.agg(F.sum("pos").alias("pos_all"), F.sum("neg").alias("neg_all"))
    hit = F.col(p) >= threshold
    pairs = F.col("pos") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2)
    g = ranked.crossJoin(F.broadcast(totals)).agg(
        (F.sum(pairs) / F.first("pos_all") / F.first("neg_all")).alias("auc"),
        F.max(F.abs(F.col("pos_upto") / F.col("pos_all") - F.col("neg_upto") / F.col("neg_all"))).alias("ks"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"), F.first("pos_all").alias("pos_all"), F.first("neg_all").alias("neg_all"),
    )
    precision, recall = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))), F.col("tp") / F.col("pos_all")
    return g.select("auc", (2 * F.col("auc") - 1).alias("gini"), "ks", ((F.col("tp") + F.col("neg_all") - F.col("fp")) / (F.col("pos_all") + F.col("neg_all"))).alias("accuracy"), precision.alias("precision"), recall.alias("recall"), (2 * precision * recall / (precision + recall)).alias("f1"))


def auc_by(df: DataFrame, group: str, label: str, p: str) -> DataFrame:
    """(group, auc) with ties counted half; null where a group has one class only. Groups follow one another in one order of
    all distinct (group, score), so neither a group nor a score is gathered in a task."""
    by = df.where(F.col(p).isNotNull() & F.col(label).isNotNull()).groupBy(group, p).agg(F.sum(label).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    below = F.col("neg_upto") - F.col("neg")
    g = running_sums(by, [group, p], ["neg"]).groupBy(group).agg(F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("pairs"), F.min(below).alias("start"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return g.select(group, F.when((F.col("pos") > 0) & (F.col("neg") > 0), (F.col("pairs") - F.col("start") * F.col("pos")) / F.col("pos") / F.col("neg")).alias("auc"))


def ranking_metrics(df: DataFrame, group: str, order: list[Column], relevant: str, k: int = 10) -> DataFrame:
    """NDCG, average precision, reciprocal rank and precision at k per group."""
    w, best = Window.partitionBy(group).orderBy(*order), Window.partitionBy(group).orderBy(F.desc(relevant), *order)
    rows = df.withColumn("__r", F.row_number().over(w)).withColumn("__i", F.row_number().over(best)).withColumn("__hits", F.sum(relevant).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rel = F.col(relevant)
    gain = lambda r: F.sum(F.when(F.col(r) <= k, rel / F.log2(F.col(r) + 1)))
    g = rows.groupBy(group).agg(gain("__r").alias("dcg"), gain("__i").alias("ideal"), F.sum(F.when(rel > 0, F.col("__hits") / F.col("__r"))).alias("ap"), F.sum(relevant).alias("n"), F.min(F.when(rel > 0, F.col("__r"))).alias("first"), F.sum(F.when(F.col("__r") <= k, rel)).alias("topk"))
    return g.select(group, F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0).alias("ndcg"), F.when(F.col("n") > 0, F.col("ap") / F.col("n")).otherwise(0.0).alias("average_precision"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"), (F.col("topk") / k).alias("precision_at_k"))


def uplift_bins(df: DataFrame, order: list[str], treated: str, y: str, bins: int = 10) -> DataFrame:
    """Treated and control response per equal-count bin of descending uplift (bins count from the end of the order), and
    the cumulative gain."""
    g = ntile(df, order, bins, "__b").groupBy((bins + 1 - F.col("__b")).alias("bin")).agg(F.sum(treated).alias("n_t"), F.sum(1 - F.col(treated)).alias("n_c"), F.sum(F.col(treated) * F.col(y)).alias("y_t"), F.sum((1 - F.col(treated)) * F.col(y)).alias("y_c"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = {k: F.sum(k).over(w) for k in ("n_t", "n_c", "y_t", "y_c")}
    return g.select("bin", (F.col("y_t") / F.col("n_t") - F.col("y_c") / F.col("n_c")).alias("effect"), (c["y_t"] - c["y_c"] * c["n_t"] / c["n_c"]).alias("qini"))


def two_proportions(df: DataFrame, treated: Column, success: Column) -> DataFrame:
    """Rates of both arms, pooled z and a 95 % interval of the difference."""
    g = df.agg(F.count_if(treated).alias("n1"), F.count_if(~treated).alias("n0"), F.count_if(treated & success).alias("x1"), F.count_if(~treated & success).alias("x0"))
    p1, p0 = F.col("x1") / F.col("n1"), F.col("x0") / F.col("n0")
    pool = (F.col("x1") + F.col("x0")) / (F.col("n1") + F.col("n0"))
    half = 1.96 * F.sqrt(p1 * (1 - p1) / F.col("n1") + p0 * (1 - p0) / F.col("n0"))
    z = (p1 - p0) / F.sqrt(pool * (1 - pool) * (1 / F.col("n1") + 1 / F.col("n0")))
    return g.select(p1.alias("rate_treated"), p0.alias("rate_control"), z.alias("z"), (p1 - p0 - half).alias("low"), (p1 - p0 + half).alias("high"), (F.abs(z) > 1.96).alias("significant"))


def difference_in_differences(df: DataFrame, treated: Column, after: Column, y: str) -> DataFrame:
    """Effect, standard error and t from the four cells."""
    cell = {(t, a): F.when((treated if t else ~treated) & (after if a else ~after), F.col(y)) for t in (0, 1) for a in (0, 1)}
    g = df.agg(*[f(c).alias(f"{n}{t}{a}") for (t, a), c in cell.items() for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    effect = F.col("m11") - F.col("m10") - F.col("m01") + F.col("m00")
    se = F.sqrt(sum((F.col(f"v{k}") / F.col(f"n{k}") for k in ("00", "01", "10", "11")), F.lit(0.0)))
    return g.select(effect.alias("effect"), se.alias("standard_error"), (effect / se).alias("t"))


def conformal(calibration_set: DataFrame, test: DataFrame, y: str, p: str, alpha: float = 0.1, relative: bool = False) -> DataFrame:
    """Half width from the ceil((n+1)(1-alpha))/n quantile of residuals, absolute or relative to the prediction, with coverage
    and mean width on test. Intervals don't go below 0."""
    n = calibration_set.count()
    q = min(1.0, -(-(n + 1) * (1 - alpha) // 1) / max(1, n))
    residual = F.abs(F.col(y) - F.col(p))
    width = quantiles(calibration_set, [], residual / F.nullif(F.abs(F.col(p)), F.lit(0.0)) if relative else residual, [q]).select(F.col("q")[0].alias("half_width"))
    half = F.col("half_width") * F.abs(F.col(p)) if relative else F.col("half_width")
    low, high = F.greatest(F.lit(0.0), F.col(p) - half), F.col(p) + half
    return test.crossJoin(F.broadcast(width)).agg(F.first("half_width").alias("half_width"), F.avg(F.col(y).between(low, high).cast("double")).alias("coverage"), F.avg(high - low).alias("mean_width"))


def ood_scores(train: DataFrame, df: DataFrame, columns: list[str], id: str, share: float = 0.05) -> DataFrame:
    """Root mean square of standard scores under train's moments, flagged above its (1 - share) percentile."""
    moments = train.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev(c).alias(f"s_{c}") for c in columns])
    terms = sum((F.when(F.col(f"s_{c}") > 0, ((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")) ** 2).otherwise(0.0) for c in columns), F.lit(0.0))
    rows = df.crossJoin(F.broadcast(moments)).select(id, F.sqrt(terms / len(columns)).alias("score"))
    cut = quantiles(rows, [], "score", [1 - share]).select(F.col("q")[0].alias("cut"))
    return rows.crossJoin(F.broadcast(cut)).select(id, "score", (F.col("score") > F.col("cut")).alias("outside"))


def ensemble(df: DataFrame, id: str, detectors: list[str], weights: list[float], share: float) -> DataFrame:
    """Min-max scaled detectors, their mean, largest and weighted mean, and a cut of the weighted one."""
    ends = df.agg(*[F.min(c).alias(f"lo_{c}") for c in detectors], *[F.max(c).alias(f"hi_{c}") for c in detectors])
    scaled = [F.when(F.col(f"hi_{c}") > F.col(f"lo_{c}"), (F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}"))).otherwise(0.0) for c in detectors]
    weighted = sum((w * s for w, s in zip(weights, scaled, strict=True)), F.lit(0.0)) / sum(weights)
    rows = df.crossJoin(F.broadcast(ends)).select(id, (sum(scaled, F.lit(0.0)) / len(scaled)).alias("mean_score"), F.greatest(*scaled).alias("max_score"), weighted.alias("weighted_score"))
    cut = quantiles(rows, [], "weighted_score", [1 - share]).select(F.col("q")[0].alias("cut"))
    return rows.crossJoin(F.broadcast(cut)).withColumn("anomaly", F.col("weighted_score") > F.col("cut")).drop("cut")


def threshold_for(df: DataFrame, label: str, p: str, recall: float) -> DataFrame:
    """The highest threshold whose recall reaches the target, and the threshold with the best F1."""
    by = df.groupBy(p).agg(F.sum(label).cast("long").alias("pos"), F.count("*").alias("all")).withColumn("neg_p", -F.col(p))
    ranked = running_sums(by, ["neg_p"], ["pos", "all"]).crossJoin(F.broadcast(by.agg(F.sum("pos").alias("pos_all"))))
    r, prec = F.col("pos_upto") / F.col("pos_all"), F.col("pos_upto") / F.col("all_upto")
    rows = ranked.select(p, r.alias("recall"), F.when(F.col("pos_upto") > 0, 2 * r * prec / (r + prec)).otherwise(0.0).alias("f1"))
    return rows.agg(F.max(F.when(F.col("recall") >= recall, F.col(p))).alias("threshold_recall"), F.max_by(p, F.struct("f1", p)).alias("threshold_f1"), F.max("f1").alias("best_f1"))
