"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import has_rows, settle


def _star(edges: DataFrame, keep) -> DataFrame:
    """Each node sends the neighbours that keep() admits to the smallest of its neighbourhood."""
    near = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(near, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of ids -> (id, component), component being the smallest id reachable.

    Nodes without an edge aren't returned; nulls and loops are ignored. Rows stay linear in the edges: a node never
    pairs its neighbours with each other, and hubs split in the skew-aware join. Each round is written to the shared
    folder; it ends when a round changes nothing."""
    a, b = F.col("a"), F.col("b")
    edges = settle(edges.where((a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = None
    while has_rows(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).where("u != v")
        # each edge is already (larger, smaller): the smaller neighbours of u are its v's
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = settle(small.where("u != v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (id, component) after more edges (a, b): only the components that these touch are walked again."""
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        names = labels.select(F.col("id").alias(end), F.col("component").alias("c"))
        ends = ends.join(names, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    merged = settle(connected_components(ends), "merged")
    after = labels.join(merged.select(F.col("id").alias("component"), F.col("component").alias("c")), "component", "left").select("id", F.coalesce("c", "component").alias("component"))
    return settle(after.unionByName(merged.join(labels, "id", "left_anti")), "labels")
