"""Line dedup: exact set-similarity join of lines, of which the later ones go.

A line is the set of its words (white-space separated, A-Z lower-cased). A line goes if an earlier one, by doc_id and
place in the text, has a Jaccard similarity of 0.8 or more to it, whether that one stays or not. Lines with the same set
are one class, whose first place counts. Tokens are ordered by rarity: by their bucket in a fixed-size table of counts
over the whole corpus, then by hash; any total order keeps the join exact. Classes meet through the tokens of their
prefixes; length, position and the parities of 128 buckets of tokens (tokens that both classes have cancel out, so a
long common passage doesn't fill them) rule pairs out inside the join; what is left is verified on the whole sets.

So that a family of many variants of a line doesn't pair all with all, a first round compares each class with two pivots
of each of its keys: the first class and the plainest one, whose rarest token is the most frequent (edits bring rare
tokens in), of those that have the same two least token hashes or the same two commonest tokens. Let d be the size of a class's symmetric difference from a pivot and n its own size. Two classes that
differ from each other in D tokens match where 9 D <= n + m, and D is at most the sum of their differences from a common
pivot, so they match where (9 d - n) of the one and of the other add up to 0 at most. The first class for each value of
9 d - n, and a running minimum over the values, then tell in rows linear in the family which of its classes have an
earlier match. Pivots that many classes met are then compared with all classes that share a token of their prefixes, so
that no class which matches such a pivot is overlooked for want of a common key. A class found to be a later copy is
done: it meets only classes for which it may be the earlier one.

Defined results: null text counts as empty; blank lines never go; rows with null doc_id neither lose lines nor remove
any; rows with the same doc_id and text are one document, other rows of a doc_id come in the order of their texts'
hashes; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SOLID, block_sums, broadcast_if_small, has_rows, mix, run_hashes, settle, slices, small_batches, texts_of

#: Similarity as a fraction; and the table of token counts.
NUM, DEN = 4, 5
TABLE, BLOCKS = 1 << 20, 64
#: A pivot that so many classes met is compared with all that share a token of its prefix; this decides costs, not results.
CROWD = 32
LINES = "k1 long, k2 long, doc_id long, text_hash long, line int, n int, plain long, bits0 long, bits1 long, meets array<bigint>, prefix array<bigint>"


def lines_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the batch's lines with words: row, place in the text, number of distinct words; and the words' hashes, in order
    within a line."""
    texts = [t.lower() for t in texts_of(batch)]
    text = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, words = run_hashes(text, SOLID)
    line = np.searchsorted(np.flatnonzero(text == 10), starts).astype(np.uint64)
    key = line << np.uint64(40) | words >> np.uint64(24)
    order = np.argsort(key)
    key, line, words = key[order], line[order], words[order]
    if ((key[1:] == key[:-1]) & (words[1:] != words[:-1])).any():  # words that differ in their low bits alone
        order = np.lexsort((words, line))
        line, words = line[order], words[order]
    fresh = np.concatenate([[True], (line[1:] != line[:-1]) | (words[1:] != words[:-1])])[: len(line)]
    line, words = line[fresh].astype(np.int64), words[fresh]
    begin = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])[: len(line)])
    first = np.cumsum([0, *(t.count(b"\n") + 1 for t in texts)])
    row = np.searchsorted(first, line[begin], side="right") - 1
    return row, (line[begin] - first[row]).astype(np.int32), np.diff(np.concatenate([begin, [len(line)]])), words


def token_counts(docs: DataFrame) -> np.ndarray:
    """How often the tokens of each bucket occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(TABLE, np.int64), []
        for batch in slices(batches):
            _, words = run_hashes(np.frombuffer(b"\n".join(t.lower() for t in texts_of(batch)), np.uint8), SOLID)
            held.append((words % np.uint64(TABLE)).astype(np.int32))
            if sum(map(len, held)) >= TABLE:  # the table is gone through once for many slices
                total, held = total + np.bincount(np.concatenate(held), minlength=TABLE), []
        if held:
            total += np.bincount(np.concatenate(held), minlength=TABLE)
        if total.any():
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "sums": pa.array([x.astype(np.uint32).tobytes() for x in total.reshape(BLOCKS, -1)], pa.binary())})

    with small_batches(docs.sparkSession):
        sums = block_sums(docs.select("text").mapInArrow(count, "block int, sums binary"), BLOCKS, np.uint32)
    return np.minimum(sums.reshape(-1), 2**40 - 1).astype(np.uint64) if sums.size else np.zeros(TABLE, np.uint64)


def set_keys(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set, whatever the order of its words."""
    k1 = np.add.reduceat(mix(words + np.uint64(1)), starts)
    return mix(k1).view(np.int64), np.bitwise_xor.reduceat(mix(words ^ np.uint64(0x9E3779B97F4A7C15)), starts).view(np.int64)


def line_classes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """One row for each set of words: keys, first place, size, count of the rarest token, parities, keys of the first round, prefix by rarity."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, place, n, words = lines_of(batch)
            if not len(n):
                continue
            starts, line = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
            k1, k2 = set_keys(words, starts)
            bit = np.uint64(1) << (words % np.uint64(64))
            half = (words >> np.uint64(6)) % np.uint64(2)
            bits = [np.bitwise_xor.reduceat(np.where(half == k, bit, np.uint64(0)), starts).view(np.int64) for k in (0, 1)]
            # words are in the order of their hashes: a stable sort by rarity leaves equally rare ones so
            order = np.argsort(line.astype(np.uint64) << np.uint64(40) | shared.value[words % np.uint64(TABLE)], kind="stable")
            commonest = [words[order[starts + np.maximum(n - k, 0)]] for k in (1, 2)]
            least = [np.minimum.reduceat(mix(words ^ np.uint64(k)), starts) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
            meets = np.stack([mix(mix(x + np.uint64(k)) ^ mix(y)) for k, (x, y) in enumerate((least, commonest))], axis=1).view(np.int64)
            plain = shared.value[words[order[starts]] % np.uint64(TABLE)].astype(np.int64)
            length = n - (NUM * n + DEN - 1) // DEN + 1
            prefix = words[order[np.arange(len(words)) - np.repeat(starts, n) < np.repeat(length, n)]].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(prefix))
            own = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "text_hash")]
            met = pa.FixedSizeListArray.from_arrays(pa.array(meets.ravel()), 2).cast(pa.list_(pa.int64()))
            columns = [pa.array(k1), pa.array(k2), *own, pa.array(place), pa.array(n.astype(np.int32)), pa.array(plain), *map(pa.array, bits), met, lists]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in LINES.split(", ")])

    found = docs.select("doc_id", "text_hash", "text").mapInArrow(run, LINES)
    rest = [F.first(c).alias(c) for c in ("n", "plain", "bits0", "bits1", "meets", "prefix")]
    return found.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("first"), *rest)


def may_match(a: str, b: str) -> tuple[Column, Column]:
    """Whether sizes and parities of two classes allow a match, and the least overlap a match has."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.floor((NUM * (n + m) + NUM + DEN - 1) / (NUM + DEN))
    differ = F.bit_count(F.col(f"{a}.bits0").bitwiseXOR(F.col(f"{b}.bits0"))) + F.bit_count(F.col(f"{a}.bits1").bitwiseXOR(F.col(f"{b}.bits1")))
    return (DEN * F.least(n, m) >= NUM * F.greatest(n, m)) & (differ <= n + m - 2 * need), need


def _meets(a: str, b: str) -> Column:
    """Whether two prefix tokens that are equal allow a match of their classes, of which a is the smaller or, of equal ones, has
    the smaller key: sizes, places, parities, and not both done."""
    size = lambda c: F.shiftright(F.col(f"{c}.nad"), 32)
    rest = lambda c: size(c) - F.shiftright(F.col(f"{c}.nad").bitwiseAND(F.lit(0xFFFFFFFF)), 1)
    n, m = size(a), size(b)
    need = F.floor((NUM * (n + m) + NUM + DEN - 1) / (NUM + DEN))
    differ = F.bit_count(F.col(f"{a}.bits0").bitwiseXOR(F.col(f"{b}.bits0"))) + F.bit_count(F.col(f"{a}.bits1").bitwiseXOR(F.col(f"{b}.bits1")))
    is_open = F.col(f"{a}.nad").bitwiseAND(F.col(f"{b}.nad")).bitwiseAND(F.lit(1)) == 0
    ordered = (n < m) | ((n == m) & (F.col(f"{a}.k1") < F.col(f"{b}.k1")))
    return ordered & is_open & (DEN * F.least(n, m) >= NUM * F.greatest(n, m)) & (F.least(rest(a), rest(b)) >= need) & (differ <= n + m - 2 * need)


def _short(tokens: DataFrame) -> DataFrame:
    """The tokens through which a class meets those of its size or more.

    An overlap with a class of m >= n tokens is at least NUM (n + m) / (NUM + DEN), so at least 2 NUM n / (NUM + DEN): all but
    so many tokens and one more hold one that both classes have among their rarest. rand() is below 1, so nothing depends on it;
    it keeps the filter behind the shuffle, which then needs to be written once only."""
    n, at = F.shiftright("nad", 32), F.shiftright(F.col("nad").bitwiseAND(F.lit(0xFFFFFFFF)), 1)
    return tokens.where(at + F.floor(F.rand(0)) <= n - F.floor((2 * NUM * n + NUM + DEN - 1) / (NUM + DEN)))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k1, k2, items) of the wanted classes, read again from the documents of their first places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, place, n, words = lines_of(batch)
            if not len(n):
                continue
            lines = [set(x) for x in batch.column("lines").to_pylist()]
            starts = np.cumsum(n) - n
            k1, k2 = set_keys(words, starts)
            keep = [i for i, (r, p) in enumerate(zip(row.tolist(), place.tolist(), strict=True)) if p in lines[r]]
            items = [np.sort(words[starts[i] : starts[i] + n[i]]).tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays([pa.array(k1[keep]), pa.array(k2[keep]), pa.array(items, pa.binary())], ["k1", "k2", "items"])

    places = wanted.groupBy("first.doc_id", "first.text_hash").agg(F.collect_set("first.line").alias("lines"))
    rows = docs.select("doc_id", "text_hash", "text").join(broadcast_if_small(settle(places, "line-places")), ["doc_id", "text_hash"])
    return rows.mapInArrow(run, "k1 long, k2 long, items binary").dropDuplicates(["k1", "k2"])


OVERLAPS = "x long, k2x long, fx struct<doc_id: bigint, text_hash: bigint, line: int>, y long, k2y long, fy struct<doc_id: bigint, text_hash: bigint, line: int>"


def _overlaps(matching: bool):
    """Add sizes n and m and the overlap to pairs of whole sets; with matching, only for pairs that match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, both = (np.zeros(batch.num_rows, np.int32) for _ in range(3))
            for i, (x, y) in enumerate(zip(batch.column("ix"), batch.column("iy"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n[i], m[i], both[i] = len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))
            names = [c for c in batch.schema.names if c not in ("ix", "iy")]
            found = pa.RecordBatch.from_arrays([*batch.select(names).columns, *map(pa.array, (n, m, both))], [*names, "n", "m", "overlap"])
            yield found.filter(pa.array(DEN * both.astype(np.int64) >= NUM * (n + m - both).astype(np.int64))) if matching else found

    return run


def _compared(pairs: DataFrame, classes: DataFrame, docs: DataFrame, matching: bool = False) -> DataFrame:
    """Pairs (x, y) of k1 with second keys, first places, sizes and overlap of the whole sets."""
    wanted = classes.select("k1", "k2", "first").join(pairs.select(F.explode(F.array("x", "y")).alias("k1")).distinct(), "k1", "left_semi")
    sets = settle(_sets(docs, wanted).join(wanted, ["k1", "k2"]), "line-sets", wide=True)
    x, y = (sets.select(F.col("k1").alias(c), F.col("k2").alias(f"k2{c}"), F.col("first").alias(f"f{c}"), F.col("items").alias(f"i{c}")) for c in ("x", "y"))
    both = pairs.join(x, "x").join(y, "y").where("fx != fy").select("x", "k2x", "fx", "y", "k2y", "fy", "ix", "iy")
    return settle(both.mapInArrow(_overlaps(matching), OVERLAPS + ", n int, m int, overlap int"), "line-overlaps")


def _later(compared: DataFrame) -> DataFrame:
    """The keys (k1, k2) of the later class of each pair that matches."""
    matching = compared.where(DEN * F.col("overlap").cast("long") >= NUM * (F.col("n").cast("long") + F.col("m") - F.col("overlap")))
    late = F.when(F.col("fx") > F.col("fy"), F.struct(F.col("x").alias("k1"), F.col("k2x").alias("k2"))).otherwise(F.struct(F.col("y").alias("k1"), F.col("k2y").alias("k2")))
    return matching.select(late.alias("k")).select("k.*").distinct()


def _later_by_pivot(compared: DataFrame) -> DataFrame:
    """The keys (k1, k2) of the classes x that match an earlier class of the same pivot y because both are near to it."""
    apart = (NUM + DEN) * (F.col("n").cast("long") + F.col("m") - 2 * F.col("overlap")) - F.col("n")
    members = compared.select(F.col("y").alias("pivot"), F.col("x").alias("k1"), F.col("k2x").alias("k2"), F.col("fx").alias("first"), apart.alias("apart"))
    itself = compared.select(F.col("y").alias("pivot"), F.col("y").alias("k1"), F.col("k2y").alias("k2"), F.col("fy").alias("first"), (-F.col("m").cast("long")).alias("apart"))
    members = members.unionByName(itself.distinct())
    # a pivot has a row for each value of apart here, not for each member
    least = settle(members.groupBy("pivot", "apart").agg(F.min("first").alias("first")), "line-apart")
    asked = least.select("pivot", "apart", (-F.col("apart")).alias("at"), F.lit(1).alias("asks"), F.lit(None).cast(least.schema["first"].dataType).alias("first"))
    held = least.select("pivot", "apart", F.col("apart").alias("at"), F.lit(0).alias("asks"), "first")
    so_far = Window.partitionBy("pivot").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earliest = held.unionByName(asked).withColumn("earliest", F.min("first").over(so_far)).where("asks = 1").select("pivot", "apart", "earliest")
    return members.join(earliest, ["pivot", "apart"]).where("earliest < first").select("k1", "k2").distinct()


def _crowd_pairs(compared: DataFrame, open_: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (x, y) of open classes with crowded pivots that share a token of the prefixes and weren't compared."""
    facts = ["k1", "n", "bits0", "bits1"]
    crowded = compared.groupBy("y").count().where(F.col("count") >= CROWD).select(F.col("y").alias("k1"))
    pivots = settle(classes.join(broadcast_if_small(crowded), "k1", "left_semi").select(*facts, F.explode("prefix").alias("token")), "line-crowds")
    allowed, _ = may_match("a", "p")
    tokens = open_.select(*facts, F.explode("prefix").alias("token"))
    met = tokens.alias("a").join(broadcast_if_small(pivots).alias("p"), "token").where((F.col("a.k1") != F.col("p.k1")) & allowed)
    return settle(met.select(F.col("a.k1").alias("x"), F.col("p.k1").alias("y")).distinct().join(compared.select("x", "y"), ["x", "y"], "left_anti"), "line-pairs")


def _text_hash(docs: DataFrame) -> Column:
    """What tells rows of one doc_id apart; only where an id stands on several rows is a row more than its id."""
    repeated = has_rows(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"))
    return F.xxhash64("text") if repeated else F.lit(0).cast("long")


def kept_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kept) for rows (doc_id, text_hash, text): the places of the lines with words that stay; rows
    without any are left out."""
    docs = docs.where("doc_id is not null")
    classes = settle(line_classes(docs, token_counts(docs)), "line-classes", wide=True)
    facts = ["k1", "n", "bits0", "bits1"]

    keyed = classes.select(F.explode("meets").alias("key"), "k1")
    shared = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    keyed = settle(keyed.join(shared, "key", "left_semi").join(classes.select("first", "plain", *facts), "k1"), "line-keys")
    plainest = F.struct(-F.col("plain"), "n", "first", F.struct("first", *facts).alias("p"))
    pivots = keyed.groupBy("key").agg(F.min(F.struct("first", *facts)).alias("p"), F.min(plainest).alias("q"))
    pivots = pivots.select("key", F.explode(F.array_distinct(F.array("p", "q.p"))).alias("p"))
    allowed, _ = may_match("m", "p")
    met = keyed.alias("m").join(pivots, "key").where((F.col("m.first") != F.col("p.first")) & allowed)
    pairs = settle(met.select(F.col("m.k1").alias("x"), F.col("p.k1").alias("y")).distinct(), "line-pairs")
    later = None
    if has_rows(pairs):
        compared = _compared(pairs, classes, docs)
        later = settle(_later(compared).unionByName(_later_by_pivot(compared)).distinct(), "line-later")
        crowd = _crowd_pairs(compared, classes.join(broadcast_if_small(later), ["k1", "k2"], "left_anti"), classes)
        if has_rows(crowd):
            crowd = _compared(crowd, classes, docs)
            near = compared.join(crowd.select("y").distinct(), "y", "left_semi").unionByName(crowd)
            later = settle(later.unionByName(_later(crowd)).unionByName(_later_by_pivot(near)).distinct(), "line-later")

    done, marked = F.lit(False), classes
    if later is not None:
        done, marked = F.coalesce("done", F.lit(False)), classes.join(broadcast_if_small(later.withColumn("done", F.lit(True))), ["k1", "k2"], "left")
    # size, place and done in one number, as these rows are the bulk of what is shuffled
    packed = (F.shiftleft(F.col("n").cast("long"), 32) + 2 * F.col("at").cast("long") + F.when(done, 1).otherwise(0)).alias("nad")
    tokens = marked.select("k1", "n", "bits0", "bits1", *(["done"] if later is not None else []), F.posexplode("prefix").alias("at", "token")).select("k1", packed, "bits0", "bits1", "token")
    # both sides of the join read the one shuffle, as neither gets filters of its own before it
    tokens = tokens.where(" and ".join(f"{c} is not null" for c in tokens.columns)).repartition("token")
    meet = _short(tokens).alias("a").join(tokens.alias("b"), "token").where(_meets("a", "b"))
    a, b = F.col("a.k1"), F.col("b.k1")
    more = settle(meet.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct(), "line-pairs")
    if has_rows(more):
        if later is not None:
            order = marked.select("k1", "first", done.alias("done"))
            x, y = (order.select(F.col("k1").alias(c), F.col("first").alias(f"f{c}"), F.col("done").alias(f"d{c}")) for c in ("x", "y"))
            is_open = ~F.when(F.col("fx") > F.col("fy"), F.col("dx")).otherwise(F.col("dy"))
            more = settle(more.join(x, "x").join(y, "y").where(is_open).select("x", "y").distinct(), "line-pairs")
        late = settle(_later(_compared(more, classes, docs, matching=True)), "line-later")
        later = late if later is None else later.unionByName(late)
    stay = classes.join(broadcast_if_small(later.distinct()), ["k1", "k2"], "left_anti") if later is not None else classes
    return stay.groupBy("first.doc_id", "first.text_hash").agg(F.array_sort(F.collect_set("first.line")).alias("kept"))


def line_numbers(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_blank, kept and n_removed for each row of docs."""
    rows = docs.select(F.col("doc_id").cast("long"), _text_hash(docs).alias("text_hash"), "text")
    text = F.coalesce("text", F.lit(""))
    blank = F.size(F.filter(F.split(text, "\n", -1), lambda x: F.ltrim(x, F.lit(" \t\n\x0b\f\r")) == ""))
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int")
    counted = rows.select("doc_id", "text_hash", n_lines.alias("n_lines"), blank.alias("n_blank"))
    found = counted.join(settle(kept_lines(rows), "line-kept"), ["doc_id", "text_hash"], "left").drop("text_hash")
    removed = F.col("n_lines") - F.col("n_blank") - F.coalesce(F.size("kept"), F.lit(0))
    return found.withColumn("n_removed", F.when(F.col("doc_id").isNull(), 0).otherwise(removed))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the later copies of lines cut from text."""
    text_hash = _text_hash(docs)
    kept = kept_lines(docs.select(F.col("doc_id").cast("long"), text_hash.alias("text_hash"), "text"))
    kept = settle(kept, "line-kept").select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("kept").alias("__kept"))
    rows = docs.join(kept, (F.col("doc_id").cast("long") == F.col("__doc")) & (text_hash == F.col("__hash")), "left")
    lines = F.filter(F.split("text", "\n", -1), lambda x, i: F.regexp_like(x, F.lit(r"^[\x20\x09-\x0D]*$")) | F.array_contains(F.coalesce("__kept", F.array().cast("array<int>")), i))
    return rows.withColumn("text", F.when(F.col("doc_id").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))).select(docs.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_numbers(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"), F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept_lines"))
