"""MinHash near-dedup: universal hash minima, banding, signature check, confirmation on whole sets, components.

Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; a document's set is its distinct n-word shingles, or its whole
sequence where it has fewer words. Documents link when 100 * intersection >= percent * union.

How work stays linear: documents with the same set collapse to one representative before anything is paired. In each
bucket of a band every member meets one pivot, the member whose minima most others share, so the buckets of a family of
copies have the same few pivots. Components join what was confirmed. Only where a pivot's other members are in several
components is there more to compare, and no pair of them is made for that: their sets are re-expressed as differences
from the pivot's set. The symmetric difference of two sets is that of their differences, so with D(x) for x against the
pivot, x and y link only if their differences have

    need = (|D(x)| + |D(y)| - allowed(x, y)) / 2

elements in common, which is above half of the smaller one unless both link with the pivot. Ordered by rarity, two that
link so share an element of a short prefix, and what the family has in common is no element at all. Pairs are made from
equal prefix elements where sizes, places and signatures allow a link; each is confirmed on whole sets. Nothing is cut off
or sampled: every pair that shares a bucket is linked to the pivot on both sides, ruled out, or confirmed.

Defined results: null or empty text has no shingles and links with nothing; a null doc_id links with nothing and has a
null component_id; rows of one doc_id are one node; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SOLID, broadcast_if_small, has_rows, mix, settle, slices, texts_of, word_rows
from .components import connected_components, joined

BANDS, ROWS = 32, 4
FACTS = ["n_shingles", "bits0", "bits1"]
SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<bigint>, bits0 long, bits1 long"
#: Standard deviations by which a link's share of equal signature bits may fall short of what is expected. A link at the
#: threshold falls shorter with a chance of 7e-8 (0.85) or 2.5e-8 (0.80).
SLACK = 6.5


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles."""
    hashes, counts = word_rows([t.lower() for t in texts], SOLID)
    return [shingle_set(words, n) for words in np.split(hashes, np.cumsum(counts)[:-1])]


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    if not len(words):
        return words
    size, count = min(n, len(words)), max(1, len(words) - n + 1)
    h = np.full(count, size, np.uint64)
    for k in range(size):
        h = mix(h ^ words[k : k + count]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)
    return np.unique(h)


def coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of k multiply-shift hashes, from a fixed seed."""
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, k, np.uint64)


def minima(items: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    """The smallest value of each hash over the items, as 32-bit numbers."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), block):
        np.minimum(low, (a[:, None] * items[at : at + block] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(">u4")


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, bits0, bits1) per row; but for the size all are null for an empty set.

    bands are hashes of ROWS minima each, bits the lowest bit of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coefficients(BANDS * ROWS)
        for batch in slices(batches):
            sizes, keys, minimal = [], [], []
            for items in shingle_sets(texts_of(batch), n):
                sizes.append(len(items))
                keys.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                minimal.append(minima(items, a, b))
            low, empty = np.stack(minimal), np.array(sizes) == 0
            band = low.reshape(-1, BANDS, ROWS).astype(np.uint64)
            hashed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), band.shape[:2])
            for k in range(ROWS):
                hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + band[:, :, k])
            bits = np.packbits((low & 1).astype(np.uint8), axis=1).view(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(hashed.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists, *(pa.array(np.ascontiguousarray(bits[:, k]), mask=empty) for k in (0, 1))], SKETCH.replace(" long", "").replace(" binary", "").replace(" array<bigint>", "").split(", "))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, items) for the wanted ids: sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            items = shingle_sets(texts_of(batch), n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in items], pa.binary()), pa.array([x.tobytes() for x in items], pa.binary())], ["id", "set_key", "items"])

    wanted = docs.select(F.col("doc_id").cast("long"), "text").join(broadcast_if_small(ids.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "id long, set_key binary, items binary")


def least_overlap(n: Column, m: Column, percent: int) -> Column:
    """How many shingles sets of n and m shingles have in common at least where they link."""
    return F.ceil(percent * (n + m) / (100 + percent)).cast("long")


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether members a and b can link, by length and by equal signature bits."""
    share, hashes = (1 + percent / 100) / 2, BANDS * ROWS
    most = int(hashes * (1 - share) + SLACK * (hashes * share * (1 - share)) ** 0.5)
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    differ = F.bit_count(F.col(f"{a}.bits0").bitwiseXOR(F.col(f"{b}.bits0"))) + F.bit_count(F.col(f"{a}.bits1").bitwiseXOR(F.col(f"{b}.bits1")))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (differ <= most)


def _linked(percent: int):
    """Keep pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ix"), batch.column("iy"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def own_sets(ids: DataFrame, reps: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(id, items) of representatives. A doc_id may stand on several rows with different sets: the one meant is taken."""
    wanted = reps.select("id", "set_key").join(broadcast_if_small(ids), "id", "left_semi")
    return settle(sets_of(docs, ids, n).join(broadcast_if_small(wanted), ["id", "set_key"], "left_semi").dropDuplicates(["id"]).select("id", "items"), "near-sets")


def ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id): what stands on either side of pairs."""
    return pairs.select(F.col(a).alias("id")).distinct().unionByName(pairs.select(F.col(b).alias("id")).distinct()).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that link on whole sets, as edges (a, b)."""
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("items").alias("ix")), "x").join(sets.select(F.col("id").alias("y"), F.col("items").alias("iy")), "y")
    linked = both.select("x", "y", "ix", "iy").mapInArrow(_linked(percent), "x long, y long")
    return settle(linked.select(F.col("x").alias("a"), F.col("y").alias("b")), "near-edges", wide=True)


def with_pivots(reps: DataFrame) -> DataFrame:
    """Distinct (id, pivot): the documents that share a bucket, with the bucket's pivot. A pivot isn't its own member.

    The pivot is the member that meets most others in all its buckets; of equal ones the smallest id."""
    bands = reps.select("id", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = settle(bands.join(shared, "key"), "near-members")
    known = members.groupBy("id").agg(F.sum("c").alias("meets"))
    ranked = members.select("id", "key").join(known, "id").withColumn("rank", F.struct(-F.col("meets"), "id"))
    pivots = ranked.groupBy("key").agg(F.min("rank").alias("pivot")).select("key", F.col("pivot.id").alias("pivot"))
    return settle(members.join(pivots, "key").where("id != pivot").select("id", "pivot").distinct(), "near-met")


def _pairs(met: DataFrame, fact: DataFrame, percent: int) -> DataFrame:
    """Of pairs (x, y) those that sizes and signatures allow."""
    x, y = fact.withColumnRenamed("id", "x").alias("a"), fact.withColumnRenamed("id", "y").alias("b")
    return met.join(x, "x").join(y, "y").where(may_link("a", "b", percent)).select("x", "y")


def unsettled(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, pivot, component) of the members of pivots whose members are in several components."""
    named = met.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = named.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("pivot")
    return settle(named.join(several, "pivot", "left_semi"), "near-open")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, shingle) of each set."""
    for batch in slices(batches, "items", 8_000_000):
        items = [np.frombuffer(x, np.int64) for x in texts_of(batch, "items")]
        if items:
            ids = np.repeat(batch.column("id").to_numpy(), [len(x) for x in items])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(items))], ["id", "shingle"])


def lone_shingles(sets: DataFrame) -> DataFrame:
    """(id, lone): how many shingles of each set no other of the sets has."""
    held = sets.select("id", "items").mapInArrow(_unpacked, "id long, shingle long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    return held.where("n = 1").groupBy("id").agg(F.count("*").alias("lone"))


def ranked_sets(sets: DataFrame) -> DataFrame:
    """(id, ranked): each set as pairs of how many of the sets hold a shingle and the shingle, in this order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for elements in batch.column("elements"):
                table = np.array([elements.values.field("n").to_numpy(), elements.values.field("shingle").to_numpy()])
                found.append(table[:, np.lexsort(table[::-1])].T.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "ranked"])

    held = sets.select("id", "items").mapInArrow(_unpacked, "id long, shingle long")
    counts = held.groupBy("shingle").agg(F.count("*").alias("n"))
    elements = held.join(counts, "shingle").groupBy("id").agg(F.collect_list(F.struct("n", "shingle")).alias("elements"))
    return elements.mapInArrow(run, "id long, ranked binary")


def _difference(percent: int):
    """Of rows (id, pivot, rx, rp) the elements of the difference's prefix that another difference may have:
    (pivot, element, id, rest, size), rest being how many elements there are from this one on."""

    def allowed(n: int, m: int) -> int:
        """How many elements the symmetric difference of sets that link has at most."""
        return n + m - 2 * -(-percent * (n + m) // (100 + percent))

    def prefix(own: int, pivot: int, size: int) -> int:
        """How many elements at the front decide. A partner's difference is smaller by what is allowed at most. Where this
        set is linked with the pivot, the partner isn't, so its difference has a least size."""
        need = size - (own + own * 100 // percent) * (100 - percent) // (100 + percent)
        if size <= allowed(own, pivot):
            need = max(need, -int(-((size - 1) * (100 + percent) + (100 - percent) * (pivot - own)) // (2 * (100 + percent))))
        return size - max(1, need) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for i, p, x, y in zip(batch.column("id").to_pylist(), batch.column("pivot").to_pylist(), batch.column("rx"), batch.column("rp"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.int64).reshape(-1, 2) for v in (x, y))
                # in the family's differences what the pivot lacks is rare where few sets hold it, and what the pivot holds
                # where most do
                added, missing = ~np.isin(x[:, 1], y[:, 1], assume_unique=True), ~np.isin(y[:, 1], x[:, 1], assume_unique=True)
                both = np.concatenate([x[added], y[missing][np.lexsort((y[missing, 1], -y[missing, 0]))]])
                size = len(both)
                at = np.arange(prefix(len(x), len(y), size))
                at = at[(both[at, 0] > 1) | (at >= added.sum())]
                out.append((np.full(len(at), p), both[at, 1], np.full(len(at), i), size - at, np.full(len(at), size)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["pivot", "element", "id", "rest", "size"])

    return run


def differing(open_: DataFrame, labels: DataFrame, fact: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of different components, with a pivot in common, that may link though not both link with it.

    Before that, documents go that hold too many shingles which no other document in question has: they link with none."""
    for _ in range(2):
        lone = lone_shingles(sets).join(fact, "id").where(100 * (F.col("n_shingles") - F.col("lone")) < percent * F.col("n_shingles")).select("id")
        open_ = unsettled(open_.join(lone, "id", "left_anti").select("id", "pivot"), labels)
        ids = ends(open_, "id", "pivot")
        sets = settle(sets.join(broadcast_if_small(ids), "id", "left_semi"), "near-sets")
    ranked = settle(ranked_sets(sets), "near-ranked", wide=True)
    x, p = ranked.select("id", F.col("ranked").alias("rx")), ranked.select(F.col("id").alias("pivot"), F.col("ranked").alias("rp"))
    sized = open_.select("id", "pivot").join(x, "id").join(p, "pivot").select("id", "pivot", "rx", "rp")
    elements = sized.mapInArrow(_difference(percent), "pivot long, element long, id long, rest long, size long")
    facts = open_.select("id", "component").distinct().join(fact, "id")
    rows = settle(elements.join(facts, "id"), "near-elements", wide=True)
    n, m = F.col("a.n_shingles"), F.col("b.n_shingles")
    need = F.ceil((F.col("a.size") + F.col("b.size") - (n + m - 2 * least_overlap(n, m, percent))) / 2)
    meet = rows.alias("a").join(rows.alias("b"), ["pivot", "element"])
    meet = meet.where((F.col("a.id") > F.col("b.id")) & (F.col("a.component") != F.col("b.component")) & (F.least("a.rest", "b.rest") >= need) & may_link("a", "b", percent))
    return meet.select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct()


def near_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs."""
    docs = docs.select("doc_id", "text")
    rows = settle(sketches(docs, n), "near-sketch")
    sets = rows.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "bits0", "bits1")]
    reps = settle(sets.groupBy("set_key").agg(F.min("doc_id").alias("id"), *first), "near-reps")
    # rows of one doc_id are one node even where their sets differ
    same_id = sets.select("doc_id", "set_key").join(reps.select("set_key", "id"), "set_key").where("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    fact = reps.select("id", *FACTS)

    met = with_pivots(reps)
    pairs = settle(_pairs(met.select(F.col("id").alias("x"), F.col("pivot").alias("y")), fact, percent), "near-pairs")
    edges = confirmed(pairs, own_sets(ends(pairs, "x", "y"), reps, docs, n), percent)
    labels = settle(connected_components(edges), "near-labels")

    open_ = unsettled(met, labels)
    if has_rows(open_):
        sets = own_sets(ends(open_, "id", "pivot"), reps, docs, n)
        more = settle(differing(open_, labels, fact, sets, percent), "near-pairs")
        if has_rows(more):
            labels = joined(labels, confirmed(more, sets, percent))
    if has_rows(same_id):
        labels = joined(labels, same_id)
    placed = reps.join(labels, "id", "left").select("set_key", F.coalesce("component", "id").alias("component_id"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    result = rows.select("doc_id", "n_shingles", "set_key").join(placed, "set_key", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    return result.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=85)
