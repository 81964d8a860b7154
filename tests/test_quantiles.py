"""Exact quantiles against numpy, with ties, groups and brackets narrower than the groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import quantiles as q

PS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]


def frame(spark, seed, many):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in zip(["a", "b", None, "one", "two"], [many, many // 3, 50, 1, 2], strict=True):
        x = rng.normal(size=n).round(1 if seed else 6)
        rows += [(g, float(v)) for v in x] + [(g, None)]
    rows.append(("none", None))
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(3)


@pytest.mark.parametrize("seed,accuracy", [(0, 10_000), (0, 20), (1, 10_000), (1, 20), (1, 100)])
def test_against_numpy(spark, seed, accuracy):
    rows, df = frame(spark, seed, 3000)
    values = {g: [x for k, x in rows if k == g and x is not None] for g in {k for k, _ in rows}}
    for found in (q.quantiles(df, ["g"], "x", PS, accuracy), q.quantiles_of_counts(df.groupBy("g", "x").agg(F.count("*").alias("c")), ["g"], "x", "c", PS)):
        got = {r.g: r.q for r in found.collect()}
        assert got.keys() == {g for g, v in values.items() if v}
        for g, v in got.items():
            assert np.allclose(v, np.quantile(values[g], PS))
    every = [x for v in values.values() for x in v]
    assert np.allclose(q.quantiles(df, [], "x", PS, accuracy).first().q, np.quantile(every, PS))


def test_empty(spark):
    _, df = frame(spark, 0, 10)
    assert q.quantiles(df.limit(0), [], "x", PS).first().q is None and q.quantiles(df.limit(0), ["g"], "x", PS).collect() == []
    assert q.quantiles_of_counts(df.limit(0).withColumn("c", F.lit(1)), [], "x", "c", PS).first().q is None


def test_only_brackets_are_ordered(spark):
    """A large column and a coarse sketch."""
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("x"))
    expected = np.quantile(df.toPandas().x, [0.5, 0.99])
    found = q.quantiles(df, [], "x", [0.5, 0.99], accuracy=2000)
    assert np.allclose(found.first().q, expected)
