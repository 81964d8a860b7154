"""Incomes held against the network they come from: employers, peers, neighbourhoods, and stability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.sources.scratch import settle

from .joins import peer_levels, peers


def neighbourhood(edges: DataFrame, values: DataFrame) -> DataFrame:
    """(src, near, near_mean, near_sd): of all who share a neighbour with src, counted once for each shared neighbour and
    without src itself, how many there are and the mean and population deviation of their values (src, value).

    Sums of each neighbour's own sides, less src's own share: two aggregations along the edges, and no pairs."""
    known = edges.select("src", "dst").join(values, "src")
    sides = known.groupBy("dst").agg(F.count("value").alias("c"), F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q"))
    own = F.coalesce("value", F.lit(0.0))
    held = F.col("value").isNotNull().cast("long")
    g = known.join(sides, "dst").groupBy("src").agg(F.sum(F.col("c") - held).alias("near"), F.sum(F.coalesce("s", F.lit(0.0)) - own).alias("s"), F.sum(F.coalesce("q", F.lit(0.0)) - own**2).alias("q"))
    mean = F.col("s") / F.nullif("near", F.lit(0))
    return g.select("src", "near", mean.alias("near_mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.nullif("near", F.lit(0)) - mean**2)).alias("near_sd"))


def validated_incomes(edges: DataFrame, least_payees: int = 50, similar: float = 0.4, k: int = 5, limit: float = 3.0) -> DataFrame:
    """One row a src: is its income what its employers, its peers and its neighbourhood suggest?

    employer_gap: what src is paid by link against what its employers pay on average; peer_deviation: distance from the peers'
    median in deviations (quartile range / 1.35); anomaly: distance from the neighbourhood's mean in limit deviations, at most 1
    (0.5 where fewer than three are near). consistency is the mean of what there is of 1 - gap, 1 - deviation / 3 and
    1 - anomaly."""
    edges = settle(edges.select("src", "dst", "weight"), "income-edges")
    paid = edges.groupBy("dst").agg(F.avg("weight").alias("m"), F.count("*").alias("c")).where(F.col("c") >= least_payees).drop("c")
    income = edges.join(paid, "dst", "left").groupBy("src").agg(F.sum("weight").alias("own"), F.avg("m").alias("employer"), F.count("m").alias("employers"), F.count("*").alias("links"))
    values = income.select("src", F.col("own").alias("value"))
    levels = peer_levels(peers(edges, similar, k), values.withColumnRenamed("src", "id")).select("src", "peers", "median", ((F.col("p75") - F.col("p25")) / 1.35).alias("spread"))
    rows = income.join(levels, "src", "left").join(neighbourhood(edges, values), "src", "left")
    gap = F.abs(F.col("own") / F.col("links") / F.col("employer") - 1)
    deviation = F.coalesce(F.when(F.col("spread") > 0, (F.col("own") - F.col("median")) / F.col("spread")), F.lit(0.0))
    anomaly = F.when(F.coalesce("near", F.lit(0)) < 3, 0.5).when(F.col("near_sd") > 0, F.least(F.lit(1.0), F.abs(F.col("own") - F.col("near_mean")) / F.col("near_sd") / limit)).otherwise(0.0)
    rows = rows.select("src", "employers", F.coalesce("peers", F.lit(0)).alias("peers"), F.coalesce("near", F.lit(0)).alias("near"), gap.alias("employer_gap"), deviation.alias("peer_deviation"), anomaly.alias("anomaly"))
    factors = F.array_compact(F.array(1 - F.least(F.lit(1.0), "employer_gap"), F.when(F.col("peers") > 0, 1 - F.least(F.lit(1.0), F.abs("peer_deviation") / 3)), 1 - F.col("anomaly")))
    score = F.aggregate(factors, F.lit(0.0), lambda a, x: a + x) / F.size(factors)
    flags = F.concat_ws("|", F.when(F.abs("peer_deviation") > limit, "peer deviation"), F.when(F.col("employer_gap") > 0.3, "employer mismatch"), F.when(F.col("anomaly") > 0.7, "network anomaly"))
    sure = F.least(F.lit(1.0), F.least(F.lit(1.0), F.col("peers") / k) * 0.6 + F.when(F.col("employers") > 0, 1.0).otherwise(0.5) * 0.4)
    return rows.withColumns({"consistency": score, "flags": flags, "confidence": sure}).withColumn("consistent", (F.col("consistency") >= 0.6) & (F.abs("peer_deviation") <= limit) & (F.col("anomaly") <= 0.7))


def network_stability(payments: DataFrame, least_payees: int = 50, similar: float = 0.4, k: int = 5) -> DataFrame:
    """One row a src from its payments (src, dst, amount, late): employer_stability (the steadiest employer with three payments
    or more: 1 - coefficient of variation, at least 0), peer_stability (mean of its peers' that isn't 0, else 0.5),
    network_stability (1 - relative distance of its degree from the mean degree), overall, and change, its income of the late
    payments over that of the others less 1."""
    sums = [F.sum(F.when(side, F.col("amount"))).alias(name) for name, side in (("after", F.col("late")), ("before", ~F.col("late")))]
    edges = settle(payments.groupBy("src", "dst").agg(F.count("*").alias("n"), F.avg("amount").alias("mean"), F.stddev_pop("amount").alias("sd"), *sums), "payment-edges")
    employers = edges.groupBy("dst").agg(F.count("*").alias("c")).where(F.col("c") >= least_payees).select("dst", F.lit(True).alias("employer"))
    steady = F.when(F.col("employer") & (F.col("n") >= 3), F.greatest(F.lit(0.0), 1 - F.when(F.col("mean") > 0, F.col("sd") / F.col("mean")).otherwise(1.0)))
    own = edges.join(employers, "dst", "left").groupBy("src").agg(F.coalesce(F.max(steady), F.lit(0.0)).alias("employer_stability"), F.count("*").alias("degree"))
    mean = own.agg(F.avg("degree").alias("mean_degree"))
    named = peers(edges, similar, k).join(own.where("employer_stability > 0").select(F.col("src").alias("peer"), F.col("employer_stability").alias("v")), "peer")
    by_peers = named.groupBy("src").agg(F.avg("v").alias("peer_stability"))
    change = edges.groupBy("src").agg((F.sum("after") / F.nullif(F.sum("before"), F.lit(0.0)) - 1).alias("change"))
    rows = own.join(by_peers, "src", "left").join(change, "src").crossJoin(F.broadcast(mean)).withColumn("peer_stability", F.coalesce("peer_stability", F.lit(0.5)))
    rows = rows.withColumn("network_stability", 1 - F.least(F.lit(1.0), F.abs(F.col("degree") - F.col("mean_degree")) / F.greatest(F.lit(1.0), F.col("mean_degree"))))
    return rows.withColumn("overall", 0.5 * F.col("employer_stability") + 0.3 * F.col("peer_stability") + 0.2 * F.col("network_stability")).drop("degree", "mean_degree")
