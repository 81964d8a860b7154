"""Models as Spark ML pipelines: fits and scores run over whole tables; only coefficients reach the driver.

Null features count as 0 in every fit and score; a label that is null leaves the row out of the fit, never out of the
scores. Fits of a table with one class or no row give the mean label as a constant."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import IDF, PCA, HashingTF, NGram, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions.scalar import inverse_logit, logit
from tallgrass.sources.scratch import settle

from .windows import global_rank

SEED = 7
REGRESSORS = {"boosted": GBTRegressor, "forest": RandomForestRegressor, "linear": LinearRegression}
CLASSIFIERS = {"boosted": GBTClassifier, "forest": RandomForestClassifier, "logistic": LogisticRegression}
SIZES = {"boosted": {"maxIter": 8, "maxDepth": 3, "seed": SEED}, "forest": {"numTrees": 12, "maxDepth": 5, "seed": SEED}, "linear": {"regParam": 1e-3}, "logistic": {"regParam": 1e-3}}


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with its columns as one vector."""
    filled = {f"__f{k}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for k, c in enumerate(columns)}
    return VectorAssembler(inputCols=list(filled), outputCol="__features").transform(df.withColumns(filled)).drop(*filled)


class Model:
    """A fitted estimator with its columns: scores a frame by one column of predictions or probabilities."""

    def __init__(self, columns: list[str], fitted, constant: float | None = None):
        self.columns, self.fitted, self.constant = columns, fitted, constant

    def score(self, df: DataFrame, name: str) -> DataFrame:
        if self.fitted is None:
            return df.withColumn(name, F.lit(self.constant))
        found = self.fitted.transform(assembled(df, self.columns))
        value = vector_to_array("probability")[1] if "probability" in found.columns else F.col("prediction")
        return found.withColumn("__value", value).drop("__features", "rawPrediction", "probability", "prediction").withColumnRenamed("__value", name)


def fit(df: DataFrame, columns: list[str], label: str, kind: str = "boosted", classify: bool = False, weight: str | None = None, **settings) -> Model:
    """A regressor or classifier of a kind: boosted, forest, linear or logistic."""
    rows = df.where(F.col(label).isNotNull()).withColumn("__label", F.col(label).cast("double"))
    low, high, mean = rows.agg(F.min("__label"), F.max("__label"), F.avg("__label")).first()
    if low is None or low == high:
        return Model(columns, None, float(mean or 0.0))
    maker = (CLASSIFIERS if classify else REGRESSORS)[kind]
    options = SIZES[kind] | settings | {"featuresCol": "__features", "labelCol": "__label"} | ({"weightCol": weight} if weight else {})
    return Model(columns, maker(**options).fit(assembled(rows, columns)))


def pca_scores(df: DataFrame, columns: list[str], k: int = 3) -> DataFrame:
    """df with pc1..pck of the standardised columns."""
    steps = [StandardScaler(inputCol="__features", outputCol="__z", withMean=True), PCA(k=k, inputCol="__z", outputCol="__pc")]
    found = Pipeline(stages=steps).fit(rows := assembled(df, columns)).transform(rows)
    parts = vector_to_array("__pc")
    return found.select("*", *[parts[i].alias(f"pc{i + 1}") for i in range(k)]).drop("__features", "__z", "__pc")


def grouped_clusters(df: DataFrame, columns: list[str], k: int, by: str | None = None) -> DataFrame:
    """df with cluster and distance to its centre; with by, each of its values (a few) has clusters of its own.

    The rows are written once, dealt over all cores, as every scaler, fit and score reads them again."""
    parts, df = [], settle(df.repartition(df.sparkSession.sparkContext.defaultParallelism), "clustered")
    for value in [r[0] for r in df.select(by).distinct().orderBy(by).collect()] if by else [None]:
        rows = assembled(df.where(F.col(by).eqNullSafe(value)) if by else df, columns)
        scaler = StandardScaler(inputCol="__features", outputCol="__z", withMean=True).fit(rows)
        model = KMeans(k=k, seed=SEED, featuresCol="__z", predictionCol="cluster", maxIter=10).fit(z := scaler.transform(rows))
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
        found = model.transform(z)
        gap = F.zip_with(vector_to_array("__z"), F.element_at(centres, F.col("cluster") + 1), lambda a, b: (a - b) * (a - b))
        parts.append(found.withColumn("distance", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))).drop("__features", "__z"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def cluster_counts(df: DataFrame, columns: list[str], ks: tuple[int, ...] = (2, 3, 4, 5)) -> DataFrame:
    """(k, method, silhouette, cost, best): how well each number of clusters fits, and a Gaussian mixture of the best."""
    rows = assembled(df, columns)
    z = settle(StandardScaler(inputCol="__features", outputCol="z", withMean=True).fit(rows).transform(rows).select("z"), "clusters")
    judge, found = ClusteringEvaluator(featuresCol="z"), []
    for k in ks:
        model = KMeans(k=k, seed=SEED, featuresCol="z", maxIter=10).fit(z)
        found.append((k, "kmeans", float(judge.evaluate(model.transform(z))), float(model.summary.trainingCost)))
    best = max(found, key=lambda r: r[2])[0]
    mixture = GaussianMixture(k=best, seed=SEED, featuresCol="z", maxIter=10).fit(z)
    found.append((best, "mixture", None, -float(mixture.summary.logLikelihood)))
    return df.sparkSession.createDataFrame([(*r, r[0] == best) for r in found], "k int, method string, silhouette double, cost double, best boolean")


def text_topics(df: DataFrame, text: str, k: int = 5, buckets: int = 1024, dims: int = 8, keep: list[str] | None = None) -> DataFrame:
    """df with topic: TF-IDF of words and word pairs, reduced by PCA, clustered by KMeans. Null text counts as empty. keep names
    the columns that come back (all).

    The rows' term counts are written once, as IDF, PCA, KMeans and the scores each read them again."""
    rows = df.withColumn("__w", F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+"), lambda w: w != ""))
    rows = NGram(n=2, inputCol="__w", outputCol="__p").transform(rows).withColumn("__t", F.concat("__w", "__p"))
    counted = settle(HashingTF(inputCol="__t", outputCol="__tf", numFeatures=buckets).transform(rows).select(*(keep or df.columns), "__tf"), "terms")
    steps = [IDF(inputCol="__tf", outputCol="__idf"), PCA(k=dims, inputCol="__idf", outputCol="__pc"), KMeans(k=k, seed=SEED, featuresCol="__pc", predictionCol="topic", maxIter=10)]
    return Pipeline(stages=steps).fit(counted).transform(counted).drop("__tf", "__idf", "__pc")


def auc(df: DataFrame, label: str, p: str) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol=p, labelCol="__y").evaluate(df.withColumn("__y", F.col(label).cast("double")))


def two_stage(train: DataFrame, df: DataFrame, columns: list[str], label: str, share: str, by: str | None = None, least: int = 200) -> DataFrame:
    """df with p (of label), fraction (of what is due, given label) and expected = p * fraction.

    The fraction is fitted on the logit. With by, each of its values that has at least least labelled rows has models of
    its own, the others the common ones."""

    def pair(rows: DataFrame) -> tuple[Model, Model]:
        given = rows.where(F.col(label) == 1).withColumn("__logit", logit(F.col(share), 1e-3))
        return fit(rows, columns, label, classify=True), fit(given, columns, "__logit")

    def scored(rows: DataFrame, models: tuple[Model, Model]) -> DataFrame:
        found = models[1].score(models[0].score(rows, "p"), "__logit")
        return found.withColumn("fraction", inverse_logit(F.col("__logit"))).drop("__logit")

    run = lambda rows, all_: scored(all_, pair(rows))
    found = per_group(train, df, by, run, least) if by else run(train, df)
    return found.withColumn("expected", F.col("p") * F.col("fraction"))


def two_stage_quality(scored: DataFrame, label: str, share: str, by: str | None = None) -> DataFrame:
    """Figures of two_stage's scores on rows that it hasn't learnt from, of all rows and by value of by: n, auc (ties count
    half), brier, mean p and mean label, and the errors of fraction (where label is 1) and of expected against share."""
    from .statistics import auc_by

    rows = scored.where(F.col(label).isNotNull())
    both = rows.withColumn("__g", F.lit("all"))
    if by:
        both = settle(rows, "judged").transform(lambda x: x.withColumn("__g", F.lit("all")).unionByName(x.where(F.col(by).isNotNull()).withColumn("__g", F.col(by).cast("string"))))
    e = F.col("expected") - F.col(share)
    g = both.groupBy("__g").agg(
        F.count("*").alias("n"), F.avg((F.col("p") - F.col(label)) ** 2).alias("brier"), F.avg("p").alias("mean_p"), F.avg(label).alias("mean_label"),
        F.avg(F.when(F.col(label) == 1, F.abs(F.col("fraction") - F.col(share)))).alias("fraction_mae"), F.avg(F.abs(e)).alias("expected_mae"), F.avg(e).alias("bias"),
    )
    return g.join(auc_by(both, "__g", label, "p"), "__g", "left").withColumnRenamed("__g", "part")


def balanced(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """df with weights by which both classes count alike."""
    n = df.agg(F.count(label).alias("n"), F.sum(label).alias("ones")).first()
    ones = max(1, int(n["ones"] or 0))
    zeros = max(1, int(n["n"]) - ones)
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(n["n"] / 2 / ones)).otherwise(F.lit(n["n"] / 2 / zeros)))


def dose_response(train: DataFrame, df: DataFrame, columns: list[str], dose: str, label: str, grid: list[float], random: str | None = None, boost: float = 3.0) -> DataFrame:
    """df crossed with a grid of doses, with p(label | dose). Classes count alike; rows of random (dealt doses) count boost
    times."""
    weighted = balanced(train, label, "__w")
    if random:
        weighted = weighted.withColumn("__w", F.col("__w") * F.when(F.col(random), boost).otherwise(1.0))
    model = fit(weighted, [*columns, dose], label, classify=True, weight="__w")
    return model.score(df.drop(dose).withColumn(dose, F.explode(F.array(*[F.lit(float(x)) for x in grid]))), "p")


def scorecard(train: DataFrame, df: DataFrame, columns: list[str], label: str, amount: str, bands: Mapping[str, float]) -> DataFrame:
    """df with p, amount expected given recovery (from a log fit), score = p * amount and its band, the first whose least
    probability p reaches."""
    given = train.where(F.col(label) == 1).withColumn("__log", F.log1p(F.greatest(F.lit(0.0), F.col(amount))))
    found = fit(given, columns, "__log").score(fit(train, columns, label, classify=True).score(df, "p"), "__log")
    band = F.lit(None).cast("string")
    for name, least in sorted(bands.items(), key=lambda b: b[1]):
        band = F.when(F.col("p") >= least, name).otherwise(band)
    return found.withColumn("recovered", F.expm1("__log")).withColumn("score", F.col("p") * F.col("recovered")).withColumn("band", band).drop("__log")


def best_f1(df: DataFrame, label: str, p: str, steps: int = 50) -> float:
    """The threshold of the highest F1, from counts by fiftieths of the probability."""
    bins = df.groupBy(F.least(F.lit(steps - 1), F.floor(F.col(p) * steps)).alias("b")).agg(F.sum(label).alias("t"), F.count("*").alias("n")).collect()
    hits = {r["b"]: (r["t"] or 0, r["n"]) for r in bins}
    total = sum(t for t, _ in hits.values())
    f1 = {b: 2 * sum(hits.get(x, (0, 0))[0] for x in range(b, steps)) / max(1, total + sum(hits.get(x, (0, 0))[1] for x in range(b, steps))) for b in range(steps)}
    return max(f1, key=lambda b: (f1[b], -b)) / steps


def per_group(train: DataFrame, df: DataFrame, by: str, run: Callable[[DataFrame, DataFrame], DataFrame], least: int, most: int = 32) -> DataFrame:
    """run(train, df) for each value of by with at least least rows to learn from, the most frequent first and most of them at
    most, each with models of its own; one run on all of train for all other rows. Each value is a branch of the plan."""
    counts = train.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("__n")).where(F.col("__n") >= least)
    own = [r[0] for r in counts.orderBy(F.desc("__n"), by).limit(most).collect()]
    whole = run(train, df.where(~F.coalesce(F.col(by).isin(*own), F.lit(False))) if own else df)
    for value in own:
        whole = whole.unionByName(run(train.where(F.col(by) == value), df.where(F.col(by) == value)))
    return whole


def horizons(train: DataFrame, df: DataFrame, columns: list[str], labels: Mapping[str, str], by: str | None = None, least: int = 500) -> DataFrame:
    """df with p_<horizon> and likely_<horizon> for each labelled horizon; thresholds by F1 on train, and probabilities of
    longer horizons no less than of shorter ones. With by, its larger values have models and thresholds of their own."""
    if by:
        return per_group(train, df, by, lambda a, b: horizons(a, b, columns, labels), least)
    before = None
    for name, label in labels.items():
        model = fit(train, columns, label, "logistic", classify=True)
        threshold = best_f1(model.score(train, "__p"), label, "__p")
        df = model.score(df, f"p_{name}")
        if before:
            df = df.withColumn(f"p_{name}", F.greatest(f"p_{name}", before))
        df = df.withColumn(f"likely_{name}", F.col(f"p_{name}") >= threshold)
        before = f"p_{name}"
    return df


def intervals(train: DataFrame, held: DataFrame, df: DataFrame, columns: list[str], y: str, levels: tuple[float, ...] = (0.8, 0.9)) -> DataFrame:
    """df with an estimate of y and, by quantiles of the residuals of held, low_<level> and high_<level>."""
    model = fit(train, columns, y)
    residual = model.score(held, "__p").select((F.col(y) - F.col("__p")).alias("e"))
    tails = [t for level in levels for t in ((1 - level) / 2, (1 + level) / 2)]
    edges = residual.approxQuantile("e", tails, 1e-3) or [0.0] * len(tails)
    found = model.score(df, "estimate")
    for k, level in enumerate(levels):
        name = f"{100 * level:.0f}"
        found = found.withColumns({f"low_{name}": F.col("estimate") + edges[2 * k], f"high_{name}": F.col("estimate") + edges[2 * k + 1]})
    return found


def uplift(train: DataFrame, df: DataFrame, columns: list[str], treated: str, y: str) -> DataFrame:
    """df with the uplift of treatment by three learners and their mean: t (a model for each arm), s (one model with the
    arm as a column) and x (effects imputed from the other arm's model, weighted by the propensity)."""
    arm = train.withColumn("__t", F.col(treated).cast("double"))
    one, none = arm.where("__t = 1"), arm.where("__t = 0")
    m1, m0 = fit(one, columns, y), fit(none, columns, y)
    both = fit(arm, [*columns, "__t"], y)
    d1 = fit(m0.score(one, "__m").withColumn("__d", F.col(y) - F.col("__m")), columns, "__d")
    d0 = fit(m1.score(none, "__m").withColumn("__d", F.col("__m") - F.col(y)), columns, "__d")
    propensity = fit(arm, columns, "__t", "logistic", classify=True)
    for model, name in ((m1, "__m1"), (m0, "__m0"), (d1, "__d1"), (d0, "__d0"), (propensity, "__e")):
        df = model.score(df, name)
    df = both.score(both.score(df.withColumn("__t", F.lit(1.0)), "__s1").withColumn("__t", F.lit(0.0)), "__s0")
    df = df.withColumns({"uplift_t": F.col("__m1") - F.col("__m0"), "uplift_s": F.col("__s1") - F.col("__s0"), "uplift_x": F.col("__e") * F.col("__d0") + (1 - F.col("__e")) * F.col("__d1")})
    return df.withColumn("uplift", (F.col("uplift_t") + F.col("uplift_s") + F.col("uplift_x")) / 3).drop("__m1", "__m0", "__d1", "__d0", "__e", "__t", "__s1", "__s0")


def action_scores(train: DataFrame, df: DataFrame, columns: list[str], action: str, label: str, amount: str, none: str) -> DataFrame:
    """df crossed with the actions seen in train: p, amount given payment, expected value and the uplift in p against the
    action none."""
    index = StringIndexer(inputCol=action, outputCol="__action", handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    indexed = index.transform(train)
    # one column for each action, so that a tree can single one out
    flags = {f"__is{k}": F.col("__action") == k for k in range(len(index.labels))}
    wide = indexed.withColumns(flags)
    p = fit(wide, [*columns, *flags], label, classify=True)
    a = fit(wide.where(F.col(label) == 1), [*columns, *flags], amount)
    offered = df.drop(action).withColumn(action, F.explode(F.array(*[F.lit(x) for x in index.labels])))
    scored = a.score(p.score(index.transform(offered).withColumns(flags), "p"), "payment").drop("__action", *flags)
    key = Window.partitionBy(*[c for c in df.columns if c != action])
    base = F.max(F.when(F.col(action) == none, F.col("p"))).over(key)
    return scored.withColumn("expected", F.col("p") * F.col("payment")).withColumn("uplift", F.col("p") - base)


def calibrated_classifier(train: DataFrame, held: DataFrame, df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """df with raw (a classifier with both classes alike), p (isotonic on held) and flagged (p at the best F1 of held)."""
    model = fit(balanced(train, label, "__w"), columns, label, classify=True, weight="__w")
    steps = [VectorAssembler(inputCols=["raw"], outputCol="__raw"), IsotonicRegression(featuresCol="__raw", labelCol="__y", predictionCol="p")]
    judged = model.score(held, "raw").withColumn("__y", F.col(label).cast("double"))
    curve: PipelineModel = Pipeline(stages=steps).fit(judged)
    threshold = best_f1(curve.transform(judged), label, "p")
    return curve.transform(model.score(df, "raw")).drop("__raw").withColumn("flagged", F.col("p") >= threshold)


def out_of_fold(df: DataFrame, columns: list[str], label: str, kinds: tuple[str, ...], fold: Column, folds: int = 3, classify: bool = False) -> DataFrame:
    """df with oof_<kind>: each row's score by models that haven't seen its fold."""
    rows = settle(df.withColumn("__fold", fold % folds), "folds")
    parts = []
    for k in range(folds):
        part = rows.where(F.col("__fold") == k)
        for kind in kinds:
            part = fit(rows.where(F.col("__fold") != k), columns, label, kind, classify).score(part, f"oof_{kind}")
        parts.append(part)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return settle(whole.drop("__fold"), "oof")


def _solved(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        k = int(round((part["m"].map(len).max() if len(part) else 0) ** 0.5))
        part["coef"] = [(np.linalg.lstsq(np.reshape(m, (k, k)) + 1e-9 * np.trace(np.reshape(m, (k, k))) * np.eye(k), np.array(v, float), rcond=None)[0]).tolist() for m, v in zip(part["m"], part["v"], strict=True)]
        yield part.drop(columns=["m", "v"])


def fold_linear(df: DataFrame, columns: list[str], y: str, fold: str, name: str, by: list[str] = ()) -> DataFrame:
    """df with name: a linear model of y on columns for each value of by, fitted on the other folds than the row's.

    Of each (by, fold) only the sums of products leave the scan; the other folds' are their total less the own ones. So any
    number of groups takes one aggregation, and a task solves small systems. Groups with one fold take the mean of y over all
    other folds."""
    x = [F.lit(1.0), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns)]
    n, keys = len(x), [*by, fold]
    rows = df.where(F.col(y).isNotNull())
    cells = {f"__m{i}_{j}": F.sum(x[i] * x[j]) for i in range(n) for j in range(n)} | {f"__v{i}": F.sum(x[i] * F.col(y)) for i in range(n)}
    own = rows.groupBy(*keys).agg(*[e.alias(k) for k, e in cells.items()])
    every = df.select(*keys).distinct()
    same = lambda a, b, on: [a[c].eqNullSafe(b[c]) for c in on]
    whole = rows.groupBy(*by).agg(*[e.alias(f"{k}t") for k, e in cells.items()])
    sums = every.join(whole, same(every, whole, by), "left").select(*[every[c] for c in keys], *[F.col(f"{k}t") for k in cells]) if by else every.crossJoin(F.broadcast(whole))
    less = sums.join(own, same(sums, own, keys), "left").select(*[sums[c] for c in keys], *[(F.coalesce(F.col(f"{k}t"), F.lit(0.0)) - F.coalesce(F.col(k), F.lit(0.0))).alias(k) for k in cells])
    packed = less.select(*keys, F.array(*[F.col(f"__m{i}_{j}") for i in range(n) for j in range(n)]).alias("m"), F.array(*[F.col(f"__v{i}") for i in range(n)]).alias("v"))
    head = ", ".join([f"`{c}` {dict(df.dtypes)[c]}" for c in keys] + ["coef array<double>"])
    known = packed.mapInPandas(_solved, head)
    renamed = known.withColumnsRenamed({c: f"__{c}" for c in keys})
    found = df.join(renamed, [df[c].eqNullSafe(renamed[f"__{c}"]) for c in keys], "left").drop(*[f"__{c}" for c in keys])
    return found.withColumn(name, sum((F.col("coef")[i] * x[i] for i in range(n)), F.lit(0.0))).drop("coef")


def ensembles(df: DataFrame, columns: list[str], y: str, by: str, fold: Column, rules: Mapping[str, float], weights: tuple[float, float] = (0.6, 0.4), folds: int = 3) -> DataFrame:
    """df with four ways to join models, all judged out of fold: weighted (mean of boosted and linear), stacked (a linear
    model on both, fitted on the other folds), segmented (one for each value of by) and ruled (the first rule's value, else
    stacked)."""
    found = out_of_fold(df.withColumn("__level", fold % folds), columns, y, ("boosted", "linear"), fold, folds)
    found = fold_linear(found, ["oof_boosted", "oof_linear"], y, "__level", "stacked")
    found = settle(fold_linear(found, ["oof_boosted", "oof_linear"], y, "__level", "segmented", [by]).drop("__level"), "ensembles")
    ruled = F.col("stacked")
    for rule, value in reversed(rules.items()):
        ruled = F.when(F.expr(rule), F.lit(value)).otherwise(ruled)
    return found.withColumns({"weighted": weights[0] * F.col("oof_boosted") + weights[1] * F.col("oof_linear"), "ruled": ruled})


def compare(df: DataFrame, columns: list[str], y: str, kinds: tuple[str, ...], fold: Column) -> DataFrame:
    """(kind, mae, rmse, r2, t, best): cross-validated metrics of each kind, and the paired t of its absolute errors against
    the best one's."""
    found = out_of_fold(df, columns, y, kinds, fold)
    errors = [F.abs(F.col(y) - F.col(f"oof_{k}")) for k in kinds]
    row = found.agg(F.count("*").alias("n"), (F.var_pop(y)).alias("v"), *[e for k, a in zip(kinds, errors, strict=True) for e in (F.avg(a).alias(f"mae_{k}"), F.avg(a * a).alias(f"mse_{k}"))], *[e for i, a in enumerate(errors) for j, b in enumerate(errors) for e in (F.avg(a - b).alias(f"d{i}_{j}"), F.stddev_samp(a - b).alias(f"s{i}_{j}"))]).first()
    best = min(range(len(kinds)), key=lambda i: row[f"mae_{kinds[i]}"])
    t = lambda i: row[f"d{i}_{best}"] / (row[f"s{i}_{best}"] / row["n"] ** 0.5) if row[f"s{i}_{best}"] else 0.0
    rows = [(k, row[f"mae_{k}"], row[f"mse_{k}"] ** 0.5, 1 - row[f"mse_{k}"] / row["v"], t(i), i == best) for i, k in enumerate(kinds)]
    return df.sparkSession.createDataFrame(rows, "kind string, mae double, rmse double, r2 double, t double, best boolean")


def grid_search(df: DataFrame, columns: list[str], label: str, penalties: tuple[float, ...] = (0.001, 0.01, 0.1), folds: int = 3) -> DataFrame:
    """(penalty, auc): cross-validated AUC of logistic regression by penalty."""
    model = LogisticRegression(featuresCol="__features", labelCol="__label")
    grid = ParamGridBuilder().addGrid(model.regParam, list(penalties)).build()
    judge = BinaryClassificationEvaluator(labelCol="__label")
    rows = assembled(df.withColumn("__label", F.col(label).cast("double")), columns)
    found = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=SEED).fit(rows)
    return df.sparkSession.createDataFrame([(p, float(a)) for p, a in zip(penalties, found.avgMetrics, strict=True)], "penalty double, auc double")


def importance(train: DataFrame, test: DataFrame, columns: list[str], label: str, id: str) -> DataFrame:
    """(feature, tree, drop): a forest's importance of each column, and how much AUC falls when the column's values go to
    other rows: rows numbered by one hash get the value of the row with the same number by another."""
    model = fit(train, columns, label, "forest", classify=True)
    rows = settle(test.select(id, label, *columns), "importance")
    here = settle(global_rank(rows.withColumn("__h", F.xxhash64(id)), ["__h", id]), "ranked")
    there = settle(global_rank(rows.select(id, *columns).withColumn("__h", F.xxhash64(id, F.lit(1))), ["__h", id]), "ranked")
    whole, found = auc(model.score(rows, "__p"), label, "__p"), []
    weights = model.fitted.featureImportances.toArray() if model.fitted else [0.0] * len(columns)
    for column, weight in zip(columns, weights, strict=True):
        mixed = here.drop(column).join(there.select("rank", column), "rank")
        found.append((column, float(weight), float(whole - auc(model.score(mixed, "__p"), label, "__p"))))
    return train.sparkSession.createDataFrame(found, "feature string, tree double, drop double")


def validated(df: DataFrame, checks: Mapping[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """(check, failed, rows): how many rows fail each custom check, a callable from the frame to a boolean column; a null
    verdict fails."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(~F.coalesce(check(df), F.lit(False))).alias(name) for name, check in checks.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("failed")) for name in checks])
    return one.select(F.explode(rows).alias("r"), F.col("__n").alias("rows")).select("r.*", "rows")


def outside_model(predict: Callable, columns: list[str]) -> Callable[[DataFrame, str], DataFrame]:
    """A hook for models that Spark ML has no form of: predict maps a pandas frame of the columns to values, in Arrow
    batches."""

    @F.pandas_udf("double")
    def run(features: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(features.fillna(0.0)))

    return lambda df, name: df.withColumn(name, run(F.struct(*[F.col(c).cast("double").alias(c) for c in columns])))


def domain_shift(source: DataFrame, target: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """One row on how far target is from source: kl (of histograms along the first principal component of both),
    mean_correlation (of the columns' means) and aligned_gap (largest covariance gap after source is whitened and given
    target's covariance) beside gap (before). Covariances are columns x columns."""
    both = pca_scores(source.select(*columns, F.lit(0).alias("__side")).unionByName(target.select(*columns, F.lit(1).alias("__side"))), columns, 1)
    low, high = both.agg(F.min("pc1"), F.max("pc1")).first()
    place = F.least(F.lit(bins - 1), F.floor((F.col("pc1") - low) / max(high - low, 1e-12) * bins))
    counts = both.groupBy(place.alias("bin")).agg(*[F.count_if(F.col("__side") == k).alias(f"n{k}") for k in (0, 1)]).collect()
    p, q = (np.array([r[f"n{k}"] for r in counts], float) + 1e-6 for k in (0, 1))
    p, q = p / p.sum(), q / q.sum()
    moments = both.groupBy("__side").agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.covar_samp(a, b).alias(f"c{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns)]).orderBy("__side").collect()
    means = [np.array([r[f"m{i}"] for i in range(len(columns))], float) for r in moments]
    cov = [np.array([[r[f"c{i}_{j}"] for j in range(len(columns))] for i in range(len(columns))], float) for r in moments]

    def power(c: np.ndarray, e: float) -> np.ndarray:
        values, vectors = np.linalg.eigh(c)
        return vectors @ np.diag(np.maximum(values, 1e-12) ** e) @ vectors.T

    mover = power(cov[0], -0.5) @ power(cov[1], 0.5)
    aligned = mover.T @ cov[0] @ mover
    row = (float((p * np.log(p / q)).sum()), float(np.corrcoef(*means)[0, 1]) if len(columns) > 1 else 1.0, float(np.abs(cov[0] - cov[1]).max()), float(np.abs(aligned - cov[1]).max()))
    return source.sparkSession.createDataFrame([row], "kl double, mean_correlation double, gap double, aligned_gap double")
