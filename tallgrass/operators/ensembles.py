"""Diversity of models, calibration maps and tests of whether two samples can be told apart."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.functions.scalar import logit
from tallgrass.sources.scratch import settle

from .learn import fit
from .statistics import auc_by
from .windows import global_rank


def diversity(df: DataFrame, models: list[str], cut: float = 0.5) -> DataFrame:
    """(a, b, disagreement, q_statistic, correlation) of each pair of score columns, all from one aggregation."""
    hit = {m: F.col(m) > cut for m in models}
    cells, rows = [], []
    for a, b in combinations(models, 2):
        n = {(i, j): F.count_if((hit[a] if i else ~hit[a]) & (hit[b] if j else ~hit[b])).alias(f"{a}~{b}~{i}{j}") for i in (0, 1) for j in (0, 1)}
        cells += [*n.values(), F.corr(a, b).alias(f"{a}~{b}~r")]
        n11, n00, n10, n01 = (F.col(f"`{a}~{b}~{k}`").cast("double") for k in ("11", "00", "10", "01"))
        q = F.when(n11 * n00 + n10 * n01 > 0, (n11 * n00 - n10 * n01) / (n11 * n00 + n10 * n01))
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), ((n10 + n01) / (n11 + n00 + n10 + n01)).alias("disagreement"), q.alias("q_statistic"), F.col(f"`{a}~{b}~r`").alias("correlation")))
    return df.agg(*cells).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def long_scores(df: DataFrame, models: list[str], label: str) -> DataFrame:
    """(model, label, p): a row for each model and row."""
    return df.select(F.col(label).alias("label"), F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("p")) for m in models])).alias("x")).select("x.*", "label")


def diverse_subset(df: DataFrame, models: list[str], label: str, most: int, weight: float = 0.3) -> DataFrame:
    """(place, model, auc, score): models taken one by one, first the one with the highest AUC, then the one with the most of
    (1 - weight) * AUC + weight * (1 - mean correlation of all pairs that would then be chosen); of equals the first named.

    The choice runs over one row per pair of models, a number that the caller fixes."""
    auc = {r["model"]: r["auc"] for r in auc_by(long_scores(df, models, label), "model", "label", "p").collect()}
    r = {frozenset((x["a"], x["b"])): x["correlation"] or 0.0 for x in diversity(df, models).collect()}
    best = max(models, key=lambda m: (auc[m], -models.index(m)))
    chosen = [(1, best, auc[best], auc[best])]
    while len(chosen) < min(most, len(models)):
        taken = [c[1] for c in chosen]
        rest = [m for m in models if m not in taken]
        value = {m: (1 - weight) * auc[m] + weight * (1 - sum(r[frozenset(p)] for p in combinations([*taken, m], 2)) / (len(taken) * (len(taken) + 1) / 2)) for m in rest}
        best = max(rest, key=lambda m: (value[m], -models.index(m)))
        chosen.append((len(chosen) + 1, best, auc[best], value[best]))
    return df.sparkSession.createDataFrame(chosen, "place long, model string, auc double, score double")


def calibrated(known: DataFrame, df: DataFrame, p: str, label: str) -> DataFrame:
    """df with isotonic and sigmoid: the score mapped to the outcome's frequency by maps fitted on known, the one monotone and
    free, the other a logistic curve of the score's logit."""
    rows = known.where(F.col(p).isNotNull() & F.col(label).isNotNull()).select(F.col(p).cast("double").alias("__p"), F.col(label).cast("double").alias("__y"))
    own = df.withColumns({"__p": F.col(p).cast("double"), "__x": logit(F.col(p).cast("double"))})
    vector = VectorAssembler(inputCols=["__p"], outputCol="__features")
    steps = IsotonicRegression(featuresCol="__features", labelCol="__y", predictionCol="isotonic").fit(vector.transform(rows))
    curve = VectorAssembler(inputCols=["__x"], outputCol="__features")
    model = LogisticRegression(featuresCol="__features", labelCol="__y").fit(curve.transform(rows.withColumn("__x", logit(F.col("__p")))))
    slope, middle = float(model.coefficients[0]), float(model.intercept)
    return steps.transform(vector.transform(own)).withColumn("sigmoid", 1 / (1 + F.exp(-(slope * F.col("__x") + middle)))).drop("__p", "__x", "__features")


def adversarial(first: DataFrame, second: DataFrame, columns: list[str], id: list[str], limit: float = 0.6, strong: float = 0.75) -> DataFrame:
    """(feature, importance, drop, auc, verdict): can a forest that learns from half of both samples tell the other half apart?

    importance is the forest's, drop the loss of AUC when a column's values go to other rows; auc has ties counted half, and
    the halves are dealt by a hash of id. verdict: alike below limit, shifted, different from strong on."""
    both = settle(first.select(*id, *columns, F.lit(0).alias("__side")).unionByName(second.select(*id, *columns, F.lit(1).alias("__side"))), "sides")
    half = F.pmod(F.xxhash64(*id, "__side"), F.lit(2)) == 0
    train, held = both.where(half), both.where(~half)
    model = fit(train, columns, "__side", "forest", classify=True)
    here = global_rank(held.withColumn("__h", F.xxhash64(*id, "__side")), ["__h", *id], keep=["__side", *columns])
    there = global_rank(held.select(*id, *columns, F.xxhash64(*id, "__side", F.lit(1)).alias("__h")), ["__h", *id], keep=columns)
    # one join brings each row the other row's values of all columns; a row is judged as it is and once for each column
    other = there.select("rank", *[F.col(c).alias(f"__{k}") for k, c in enumerate(columns)])
    case = lambda f, at: F.struct(F.lit(f).alias("__f"), *[F.col(f"__{k}" if k == at else c).alias(c) for k, c in enumerate(columns)])
    cases = F.array(case("*", None), *[case(c, k) for k, c in enumerate(columns)])
    tests = model.score(here.join(other, "rank").select("__side", F.explode(cases).alias("__t")).select("__side", "__t.*"), "p")
    found = {r["__f"]: r["auc"] for r in auc_by(tests.select("__f", "__side", "p"), "__f", "__side", "p").collect()}  # a row a column
    auc = found.get("*")
    weights = model.fitted.featureImportances.toArray() if model.fitted else [0.0] * len(columns)
    verdict = "unknown" if auc is None else "different" if auc >= strong else "shifted" if auc >= limit else "alike"
    rows = [(c, float(w), None if auc is None else float(auc - found[c]), auc, verdict) for c, w in zip(columns, weights, strict=True)]
    return both.sparkSession.createDataFrame(rows, "feature string, importance double, drop double, auc double, verdict string")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def pair_separation(vectors: DataFrame, pairs: DataFrame, id: str, vector: str) -> DataFrame:
    """One row on pairs (a, b, linked): how many of either kind, mean cosine of linked and of unlinked ones, their difference,
    and the share of linked pairs above the unlinked ones' mean."""
    x = vectors.select(F.col(id).alias("a"), F.col(vector).alias("__va"))
    y = vectors.select(F.col(id).alias("b"), F.col(vector).alias("__vb"))
    found = settle(pairs.join(x, "a").join(y, "b").select("linked", cosine(F.col("__va"), F.col("__vb")).alias("c")), "cosines")
    g = found.agg(F.count_if("linked").alias("n_linked"), F.count_if(~F.col("linked")).alias("n_unlinked"), F.avg(F.when(F.col("linked"), F.col("c"))).alias("linked"), F.avg(F.when(~F.col("linked"), F.col("c"))).alias("unlinked"))
    above = found.where("linked").crossJoin(F.broadcast(g.select(F.col("unlinked").alias("__u")))).agg(F.avg((F.col("c") > F.col("__u")).cast("double")).alias("above"))
    return g.withColumn("separation", F.col("linked") - F.col("unlinked")).crossJoin(above)
