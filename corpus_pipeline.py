"""The corpus pipeline: each stage works on all that the one before kept; its result is written and read again.

Defined results of every stage: an empty table gives an empty result; rows with null doc_id are never rejected and stay
with all their rows, but for equal texts, of which the exact stage keeps one; null and empty texts count as one another;
rows of one doc_id stand or fall together in all stages but the exact one; extra columns, also those with names that the
operators use, come back as they were, and the last stage returns ids and digests alone.

All stages run in one set of executors, whose memory the JVM and the Python workers of the stages before share, so every
stage sends texts to Python some hundred at a time."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm.byte_bpe import VOCABULARY, digests, encode
from tallgrass.llm.common import broadcast_if_small, settle, small_batches
from tallgrass.llm.decontaminate import without_contaminated
from tallgrass.llm.exact_dedup import exact_dedup
from tallgrass.llm.near_dedup import near_components
from tallgrass.llm.quality import quality_scores


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without these ids; rows with null doc_id stay."""
    return docs.join(broadcast_if_small(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    with small_batches(spark):
        scores = settle(quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "quality-scores")
    return _without(docs, scores.where("predicted = 0"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal documents the one with the smallest doc_id stays."""
    own = {c: f"__own_{c}" for c in docs.columns if c in ("keep_id", "group_size", "kept", "text_sha256")}
    found = exact_dedup(docs.withColumnsRenamed(own)).where("kept")
    return found.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest doc_id stays."""
    with small_batches(spark):
        groups = settle(near_components(docs), "near-groups")
    return _without(docs, groups.where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    with small_batches(spark):  # the search is written inside, so what is left is a join
        return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, with digests of the ids and of what they decode to."""
    encoded = encode(docs, public_tokenizers.path(VOCABULARY), decoded=True, remembered=50_000)
    return settle(digests(encoded, "token_ids"), "tokens", wide=True)  # some hundred texts at a time go to Python


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("tokens", tokens)]
#: The classifier has no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
