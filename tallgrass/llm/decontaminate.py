"""Benchmark decontamination: rare words and word pairs bring passages and test items together, Smith-Waterman scores them.

Words are runs of letters and digits, lower-cased, so case, punctuation and junk between words don't hide a copy. A
passage counts where its local alignment with the item (match 2, mismatch -1, gap -1) reaches threshold times the score
of a full copy.

Seeds lose no passage. Where M words match in r runs, at least r - 1 edits stand between the runs and M - r pairs of
neighbours match too. A score 2M - edits of T or more so means M + (M - r) >= T - 1: of an item's m words and m - 1 pairs
at least T - 1 match. Seeds are all but T - 1 - c of these, so a passage hits at least c of them, whichever they are; the
commonest are left out, by document counts of one pass over the corpus. Candidates are counted on all words and pairs
before they are aligned.

The benchmark is taken in blocks of bounded size, each of which is broadcast and meets all documents, so neither a large
benchmark nor a passage that a third of all documents holds gathers rows anywhere.

Defined results: of overlapping passages the best stands; null or empty texts hold no passage; items without words are
ignored; rows with null doc_id are searched and reported with it; equal rows are reported each; items with the same
item_id are reported each; an empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLAIN, broadcast_if_small, mix, plain_rows, settle, slices, texts_of, word_rows

MATCH, MISMATCH, GAP = 2, -1, -1
RESULT = "doc_id long, item_id long, score double, first_word int, last_word int, matches int"
#: Bytes of benchmark text that one broadcast block may hold.
BLOCK_BYTES = 8_000_000


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words in order, and the number of words of each text."""
    return word_rows([t.decode().lower().encode() for t in texts], PLAIN)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of each word with the next."""
    return mix(mix(words[:-1]) + words[1:])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman with linear gaps: best score, first and last passage word, matched words."""
    n = len(passage)
    h, steps = np.zeros((len(item) + 1, n + 1), np.int32), -GAP * np.arange(n + 1, dtype=np.int32)
    for i, word in enumerate(item):
        row = np.maximum(h[i] + GAP, 0)
        row[1:] = np.maximum(row[1:], h[i, :-1] + np.where(passage == word, MATCH, MISMATCH))
        h[i + 1] = np.maximum.accumulate(row + steps) - steps
    best = int(h.max())
    i, j = map(int, np.unravel_index(int(h.argmax()), h.shape))
    last, matches = j - 1, 0
    while h[i, j] > 0:
        hit = item[i - 1] == passage[j - 1]
        if h[i, j] == h[i - 1, j - 1] + (MATCH if hit else MISMATCH):
            i, j, matches = i - 1, j - 1, matches + int(hit)
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, j, last, matches


def best_ends(item: np.ndarray, passage: np.ndarray) -> tuple[int, np.ndarray]:
    """Smith-Waterman's best score and the passage words behind which it is reached, row by row."""
    row, steps = np.zeros(len(passage) + 1, np.int32), -GAP * np.arange(len(passage) + 1, dtype=np.int32)
    best, ends = 0, np.array([], np.int64)
    for word in item:
        below = np.maximum(row + GAP, 0)
        below[1:] = np.maximum(below[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(below + steps) - steps
        if (most := int(row.max())) > best:
            best, ends = most, np.flatnonzero(row == most)
    return best, ends


class Items:
    """A block of test items with the words and pairs (grams) that seed a search."""

    def __init__(self, rows: list[tuple[int | None, bytes]], threshold: float):
        words = plain_rows([t for _, t in rows]) if rows else []
        self.items = [(k, w) for (k, _), w in zip(rows, words, strict=True) if len(w)]
        self.least = [threshold * MATCH * len(w) for _, w in self.items]
        #: words, then pairs, of each item; how many of them a passage matches at least
        self.features = [np.concatenate([w, pair_hashes(w)]) for _, w in self.items]
        self.needed = [max(1, int(np.ceil(t - 1 - 1e-9))) for t in self.least]
        self.hits = [max(1, need // 3) for need in self.needed]
        self.grams = np.unique(np.concatenate(self.features)) if self.items else np.array([], np.uint64)

    def present(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts in the texts' words of the block's grams, and which."""
        if not len(words) or not len(self.grams):
            return np.array([], np.int64), np.array([], np.int64)
        inner = np.ones(len(words), bool)
        inner[np.cumsum(counts)[counts > 0] - 1] = False
        pairs = np.flatnonzero(inner)
        grams, starts = np.concatenate([words, pair_hashes(words)[pairs]]), np.concatenate([np.arange(len(words)), pairs])
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        found = np.flatnonzero(self.grams[at] == grams)
        return starts[found], at[found]

    def seed(self, documents: np.ndarray) -> None:
        """Keep as grams the rarest ones of each item, so many that a passage has to hit some."""
        chosen, owner, place = [], [], []
        for k, features in enumerate(self.features):
            seen = documents[np.searchsorted(self.grams, features)]
            rare = np.argsort(seen, kind="stable")[: len(features) - self.needed[k] + self.hits[k]]
            chosen.append(features[rare])
            owner.append(np.full(len(rare), k))
            place.append(rare)
        chosen = np.concatenate(chosen)
        order = np.argsort(chosen, kind="stable")
        self.grams, first = np.unique(chosen[order], return_index=True)
        #: of gram g the owners and places from first[g] to first[g + 1]
        self.first, self.owner, self.place = np.append(first, len(order)), np.concatenate(owner)[order], np.concatenate(place)[order]

    def passages(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int | None, float, int, int, int]]:
        """(row, item_id, score, first_word, last_word, matches) in texts of so many words each."""
        starts, grams = self.present(words, counts)
        if not len(starts):
            return
        ends = np.cumsum(counts)
        copies = self.first[grams + 1] - self.first[grams]
        entry = np.repeat(self.first[grams] - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
        item, place, start = self.owner[entry], self.place[entry], np.repeat(starts, copies)
        pair = np.searchsorted(ends, start, "right") * len(self.items) + item
        # different places hit by each text and item
        width = max(len(f) for f in self.features)
        known, places = np.unique(np.unique(pair * width + place) // width, return_counts=True)
        enough = known[places >= np.array(self.hits)[known % len(self.items)]]
        among = np.flatnonzero(np.isin(pair, enough))
        size = np.array([len(w) for _, w in self.items])
        diagonal = start - place % size[item]
        among = among[np.lexsort((diagonal[among], pair[among]))]
        for at in np.split(among, np.flatnonzero(np.diff(pair[among])) + 1) if len(among) else []:
            row, k = divmod(int(pair[at[0]]), len(self.items))
            m, slack = len(self.items[k][1]), int(MATCH * len(self.items[k][1]) - self.least[k])
            begin = int(ends[row] - counts[row])
            # a passage lies within slack of each of its hits, so hits of one passage are in one region
            for near in np.split(at, np.flatnonzero(np.diff(diagonal[at]) > m + 2 * slack) + 1):
                if len(np.unique(place[near])) >= self.hits[k]:
                    lo, hi = max(begin, int(diagonal[near[0]]) - slack), min(int(ends[row]), int(diagonal[near[-1]]) + m + slack)
                    for score, first, last, matches in self.best(k, words[lo:hi]):
                        yield row, self.items[k][0], score, lo + first - begin, lo + last - begin, matches

    def best(self, k: int, region: np.ndarray) -> Iterator[tuple[float, int, int, int]]:
        """Passages of an item in a region, the best first; the next ones from what lies between."""
        item, m = self.items[k][1], len(self.items[k][1])
        longest, todo = m + int(MATCH * m - self.least[k]), [(0, len(region))]
        while todo:
            lo, hi = todo.pop()
            part = region[lo:hi]
            if np.isin(self.features[k], np.concatenate([part, pair_hashes(part)])).sum() < self.needed[k]:
                continue
            most, ends = best_ends(item, part)
            if most < self.least[k] or not most:
                continue
            done = 0
            for end in ends.tolist():
                at = max(0, end - longest)
                score, first, last, matches = align(item, part[at:end])
                if at + first >= done:
                    yield score / (MATCH * m), lo + at + first, lo + at + last, matches
                    todo.append((lo + done, lo + at + first))
                    done = at + last + 1
            todo.append((lo + done, hi))


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row for each passage found: doc_id, item_id, score, first_word, last_word, matches."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    # nothing found yet; a local list would go through Python, in workers of its own that stay beside the others
    result = docs.where(F.lit(False)).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, RESULT.split(", "))])
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = Items([(r["item_id"], r["text"].encode()) for r in rows], threshold)
        if not block.items:
            continue
        shared = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            documents = np.zeros(len(block.grams), np.int64)
            for batch in slices(batches):
                words, counts = words_of(texts_of(batch))
                starts, grams = block.present(words, counts)
                held = np.unique(np.searchsorted(np.cumsum(counts), starts, "right") * len(documents) + grams) % len(documents)
                documents += np.bincount(held, minlength=len(documents))
            held = np.flatnonzero(documents)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(held), "documents": pa.array(documents[held])})

        seen = docs.select("text").mapInArrow(count, "gram long, documents long").groupBy("gram").agg(F.sum("documents").alias("documents")).collect()
        documents = np.zeros(len(block.grams), np.int64)
        documents[[r["gram"] for r in seen]] = [r["documents"] for r in seen]
        block.seed(documents)
        seeded = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=seeded) -> Iterator[pa.RecordBatch]:
            block = shared.value
            names = [field.split()[0] for field in RESULT.split(", ")]
            schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()), strict=True)))
            for batch in slices(batches):
                ids = batch.column("doc_id").to_pylist()
                found = [(ids[row], *p) for row, *p in block.passages(*words_of(texts_of(batch)))]
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in found], schema)

        result = result.unionByName(docs.mapInArrow(search, RESULT))
    return result


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without those that hold a test item; rows with null doc_id stay."""
    found = contaminated_passages(docs, benchmark, **how).select("doc_id").distinct()
    return docs.join(broadcast_if_small(settle(found, "contaminated")), "doc_id", "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return contaminated_passages(read("documents"), read("benchmark"))
