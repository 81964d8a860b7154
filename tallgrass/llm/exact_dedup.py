"""Exact dedup: a keyed stream state of digests, kept on disk and never expired, and a full-byte check of hits.

The stream's state holds for each digest the stable identifier of the row that stays (smallest doc_id), its content
locator (file and row) and the number of rows seen. Texts are never part of the state. A hit is a row whose digest the
state knows from another row; the whole bytes of hits are compared before a row goes.

Defined results: null text counts as empty; null doc_id sorts last and may be kept when all ids of a group are null;
of rows with the same doc_id and text the first by locator stays; an empty table gives an empty result; extra columns
pass through untouched, those named as a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import has_rows, scratch, settle

#: A run of white space that one space doesn't already stand for.
LOOSE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Each run of [\\x20\\x09-\\x0D] becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), LOOSE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame) -> DataFrame:
    """docs with __file and __row, by which a row's content can be found again; rows that don't come straight from
    files are written to the shared folder first."""
    add = lambda df: df.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    try:
        return add(docs)
    except AnalysisException:
        return add(settle(docs, "exact-docs"))


def dedup_state(spark: SparkSession, rows: str, schema, max_files_per_batch: int | None = None) -> DataFrame:
    """Run the stateful stream over a table of (digest, first) and return the state: digest, first, group_size.

    State is keyed by digest, held in RocksDB, checkpointed to the shared folder and never expires. Each micro-batch
    writes the keys it changed under its own number, so a repeated batch overwrites itself; the last write of a key
    holds."""
    changed, old = scratch(spark, "exact-state"), {}
    for key, value in STATE_CONF.items():
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        reader = spark.readStream.schema(schema)
        if max_files_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
        state = reader.parquet(rows).groupBy("digest").agg(F.min("first").alias("first"), F.count("*").alias("group_size"))
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", scratch(spark, "exact-stream"))
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{changed}/batch={n}"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    numbered = spark.read.schema(T.StructType([*state.schema, T.StructField("batch", T.LongType())])).parquet(changed)
    if not max_files_per_batch:  # one batch wrote every key once
        return numbered.drop("batch")
    return numbered.groupBy("digest").agg(F.max_by(F.struct("first", "group_size"), "batch").alias("s")).select("digest", "s.*")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, max_files_per_batch: int | None = None) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256.

    A hot digest meets the state in a skew-splittable join; before the full-byte check, equal texts collapse in the
    map-side aggregate. Should one digest stand for two texts, its rows are grouped by the bytes themselves."""
    spark, columns = docs.sparkSession, docs.columns
    source = located(docs)
    rows = scratch(spark, "exact-digests")
    digests = source.select(digest(normalised(F.col("text"))).alias("digest"), _name().alias("first"))
    digests.write.parquet(rows)
    digests = spark.read.schema(digests.schema).parquet(rows)
    state = dedup_state(spark, rows, digests.schema, max_files_per_batch)

    decided = digests.join(state.withColumnRenamed("first", "stays"), "digest").select(
        F.col("first.file").alias("__file"), F.col("first.row").alias("__row"), F.col("digest").alias("__digest"), F.col("stays").alias("__stays"), F.col("group_size").alias("__size")
    )
    decided = settle(decided, "exact-decided")
    met = source.select("doc_id", "text", "__file", "__row").join(decided.where("__size > 1").select("__file", "__row", "__digest"), ["__file", "__row"])
    hits = met.groupBy("__digest", normalised(F.col("text")).alias("__bytes")).agg(F.min(_name()).alias("__first"), F.count("*").alias("__n"))
    hits = settle(hits.select("__digest", F.sha2("__bytes", 256).alias("__sha"), "__first", "__n"), "exact-hits")
    clashes = hits.groupBy("__digest").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("__digest")
    found = source.join(decided, ["__file", "__row"])
    found = found.withColumn("__sha", F.col("__digest") if digest is sha256 else F.sha2(normalised(F.col("text")), 256))
    if has_rows(clashes):
        found = found.join(hits.join(clashes, "__digest", "left_semi"), ["__digest", "__sha"], "left")
        found = found.withColumns({"__stays": F.coalesce("__first", "__stays"), "__size": F.coalesce("__n", "__size")})
    own = {
        "keep_id": F.col("__stays.id"),
        "group_size": F.col("__size"),
        "kept": (F.col("__stays.file") == F.col("__file")) & (F.col("__stays.row") == F.col("__row")),
        "text_sha256": F.col("__sha"),
    }
    return found.select(*[c for c in columns if c not in own], *[c.alias(n) for n, c in own.items()])


def _name() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
