"""Decision tables, audit logs and feature caches as partitioned Parquet.

A cache is never changed in place: an update writes a whole new version and the caller moves to it, so readers of the old
one aren't disturbed and a failed write leaves nothing behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_decisions(df: DataFrame, path: str, id: str, prediction: str, as_of: str, **stamps: str) -> None:
    """Append id and prediction with constant stamps, partitioned by the day of the decision."""
    rows = df.select(F.col(id).alias("id"), F.col(prediction).alias("prediction"), F.lit(as_of).cast("date").alias("as_of"), *[F.lit(v).alias(k) for k, v in stamps.items()])
    rows.write.mode("append").partitionBy("as_of").parquet(path)


def read_decisions(spark: SparkSession, path: str, where: Column | None = None, as_of: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.where(F.col("as_of") == F.lit(as_of).cast("date")) if as_of else df
    return df.where(where) if where is not None else df


def put_predictions(df: DataFrame, path: str, batch: int, id: str, version: str, made_at: str, prediction: str) -> None:
    """One batch of predictions (id, version, made_at, prediction). A batch that is written again replaces itself; a later batch
    may bring a version of an id once more, and then holds."""
    rows = df.select(F.col(id).alias("id"), F.col(version).cast("string").alias("version"), F.col(made_at).alias("made_at"), F.col(prediction).cast("double").alias("prediction"))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={int(batch)}")


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """(id, version, made_at, prediction): of each id and version the row of the latest batch, whatever the order in which the
    batches came; of several rows in one batch the one made last."""
    rows = spark.read.parquet(path)
    return rows.groupBy("id", "version").agg(F.max_by(F.struct("made_at", "prediction"), F.struct("batch", "made_at", "prediction")).alias("r")).select("id", "version", "r.*")


def attach_predictions(df: DataFrame, path: str, id: str, ts: str, version: str | None = None) -> DataFrame:
    """df with version, made_at and prediction of the latest prediction for its id that was made at ts or before (of one
    version only, if one is given); nulls where there is none."""
    from tallgrass.operators.joins import asof

    known = predictions(df.sparkSession, path).withColumnRenamed("id", "__id")
    known = known.where(F.col("version") == version) if version else known
    found = asof(df, known.select(F.col("__id").alias(id), "made_at", F.col("made_at").alias("__made"), "prediction", "version"), id, ts, "made_at", ["__made", "prediction", "version"])
    return found.withColumnRenamed("__made", "made_at")


def audit_rows(df: DataFrame, id: str, prediction: str, features: list[str], model: Column, ts: Column) -> DataFrame:
    """One audit row per prediction, features packed as JSON."""
    return df.select(F.col(id).alias("id"), F.col(prediction).alias("prediction"), model.alias("model"), ts.alias("logged_at"), F.to_json(F.struct(*features)).alias("features"))


def retained(audit: DataFrame, ts: str, now: str, days: int) -> DataFrame:
    return audit.where(F.col(ts) >= F.date_sub(F.lit(now).cast("date"), days))


def to_refresh(entities: DataFrame, cache: DataFrame, key: str, newest: str, now: Column, ttl_seconds: int) -> DataFrame:
    """Entities that the cache lacks, holds too long, or holds from before their newest data."""
    c = cache.select(key, F.col("cached_at").alias("__at"))
    stale = F.col("__at").isNull() | (now - F.col("__at") > ttl_seconds) | (F.col(newest) > F.col("__at"))
    return entities.join(c, key, "left").where(stale).drop("__at")


def upsert(cache: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The cache with updated rows in place of old ones."""
    return cache.join(updates, key, "left_anti").unionByName(updates, allowMissingColumns=True)


def invalidate(cache: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    return cache.join(ids, key, "left_anti")


def cache_stats(cache: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    fresh = now - F.col("cached_at") <= ttl_seconds
    return cache.agg(F.count("*").alias("total"), F.count_if(fresh).alias("fresh"), F.count_if(~fresh).alias("stale"), F.avg(fresh.cast("double")).alias("freshness"))


def match_concepts(columns: DataFrame, aliases: DataFrame) -> DataFrame:
    """(concept, columns, status): which columns carry each business concept; aliases are (alias, concept)."""
    met = aliases.join(columns.select(F.lower("name").alias("alias"), "name"), "alias", "left")
    g = met.groupBy("concept").agg(F.array_sort(F.collect_set("name")).alias("columns"))
    n = F.size("columns")
    return g.withColumn("status", F.when(n == 0, "missing").when(n == 1, "mapped").otherwise("ambiguous"))
