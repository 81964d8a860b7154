"""Language-model scores of texts by a weighted backoff automaton over smoothed n-grams.

The model is a trigram model with hierarchical Dirichlet smoothing: P(w) = (c + 1) / (N + V + 1), and P(w | context) =
(c(context w) + m P(w | shorter context)) / (c(context) + m), a distribution over the known words and one unknown word at
every context. As an automaton, each n-gram of the training texts is an arc from its context's state, weighted by log10 P; a
state's failure arc leads to the state of the shorter context and weighs log10(m / (c(context) + m)). A text is read once from
left to right, all texts of a slice in step; each carries its state and adds up weights.

Counts are of all training texts. Texts are cut into slices of some MB. A slice asks for each of its distinct n-grams once,
with how often it trains on it; the n-grams are 64-bit hashes, dealt over buckets by their value and sent as sorted blobs. A
bucket adds up and answers in the order of the question, so an answer holds numbers without keys. With the answers a slice
builds the part of the automaton that its texts can reach. So no task holds the model, and a frequent n-gram is one number a
slice. docs must give the same rows in the same order whenever it is read, as a table does; a check value of each blob raises
an error where it doesn't.

Defined results: null and empty texts are one end token; a null doc_id is never learnt from; repeated rows are learnt and
scored each; where no text trains, N = V = 0 and every score is 0; an empty table gives an empty result; extra columns are
ignored. Words are told apart by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SOLID, mix, settle, word_rows

#: Bytes of text in a slice, and for which there is one bucket.
SLICE, BUCKET = 6_000_000, 4_000_000
#: Prior weights of the shorter context's distribution, by n-gram order.
PRIOR = {2: 1000.0, 3: 30.0}
BEGIN, END, STEP = (np.uint64(x) for x in (0xB5026F5AA96619E9, 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15))
LOWER = bytes(b + 32 * (0x41 <= b <= 0x5A) for b in range(256))
ONE, THREE, SEVEN = np.uint64(1), np.uint64(3), np.uint64(7)


def learnt(doc_id: str = "doc_id") -> Column:
    """Whether a row trains: crc32 of the id as text modulo 7 is not 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 != 2, F.lit(False))


def pack(*arrays: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    planes, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(planes[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


class Tokens:
    """Tokens of some texts, one after the other, and the n-grams that end with each of them."""

    def __init__(self, texts: list[bytes]):
        parts, counts, low, size = [], [], 0, 0
        for high, text in enumerate(texts, 1):
            size += len(text)
            if size > 1_000_000 or high == len(texts):
                hashes, n = word_rows([t.translate(LOWER) for t in texts[low:high]], SOLID)
                parts.append(np.insert(hashes, np.cumsum(n), END))
                counts.append(n + 1)
                low, size = high, 0
        self.counts = np.concatenate(counts)
        self.first = np.cumsum(self.counts) - self.counts
        one = np.concatenate(parts)
        before = np.roll(one, 1)
        before[self.first] = BEGIN
        two = mix(before * STEP + one)
        later = np.ones(len(one), bool)
        later[self.first] = False
        three = mix(two[:-1] * STEP + one[1:])[later[1:]]
        self.later = np.flatnonzero(later)
        #: N-grams with their order in bits 1 and 2, and bit 0 left free.
        self.grams = np.concatenate([(x & ~SEVEN) | np.uint64(2 * k) for k, x in ((1, one), (2, two), (3, three))])


def cut(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted n-grams, and their number."""
    bounds = np.array([(b << 63) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(grams, bounds), len(grams))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bool], list[bytes]]]:
    """Slices with their number, ids, whether they train, and texts."""
    base, number = TaskContext.get().partitionId() << 32, 0
    ids, trains, texts, size = [], [], [], 0
    for batch in batches:
        for doc_id, train, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            if texts and size + len(text) > SLICE:
                yield base + number, ids, trains, texts
                ids, trains, texts, size, number = [], [], [], 0, number + 1
            ids.append(doc_id)
            trains.append(train)
            texts.append(text)
            size += len(text)
    if texts:
        yield base + number, ids, trains, texts


def questions(rows: DataFrame, buckets: int) -> DataFrame:
    """Blobs of the distinct n-grams of each slice by bucket, with how often the slice trains on each; tokens and texts are
    those that train, on one blob of a slice."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, trains, texts in _texts(batches):
            tokens = Tokens(texts)
            train = np.repeat(trains, tokens.counts)
            grams = np.sort(tokens.grams | np.concatenate([train, train, train[tokens.later]]).astype(np.uint64))
            starts = np.flatnonzero(np.concatenate([[True], grams[1:] >> ONE != grams[:-1] >> ONE]))
            times = np.add.reduceat(grams & ONE, starts).astype(np.uint32)
            grams = grams[starts] >> ONE
            edges = cut(grams, buckets)
            full = np.flatnonzero(np.diff(edges))
            out: dict[str, list] = {k: [] for k in ("slice", "bucket", "n", "mark", "grams", "tokens", "texts")}
            for b in full:
                own = slice(edges[b], edges[b + 1])
                blob = pack(np.diff(grams[own], prepend=np.uint64(0)), times[own])
                mark = int(np.bitwise_xor.reduce(grams[own]).view(np.int64))
                totals = (int(train.sum()), sum(trains)) if b == full[0] else (0, 0)
                for column, value in zip(out.values(), (number, int(b), len(times[own]), mark, blob, *totals), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.binary() if k == "grams" else pa.int64()) for k in out]))

    return rows.mapInArrow(work, "slice long, bucket long, n long, mark long, grams binary, tokens long, texts long")


def answers(asked: DataFrame) -> DataFrame:
    """How often all slices together train on the n-grams of each blob, in the blob's order; words is the number of different
    tokens of the bucket that train, on one blob of it."""

    def add_up(blobs: pa.Table) -> pa.Table:
        sizes = blobs.column("n").to_pylist()
        both = [unpack(blob, n, np.uint64, np.uint32) for blob, n in zip(blobs.column("grams").to_pylist(), sizes, strict=True)]
        grams, own = np.unique(np.concatenate([np.cumsum(g, dtype=np.uint64) for g, _ in both]), return_inverse=True)
        times = np.bincount(own, np.concatenate([t for _, t in both]), len(grams)).astype(np.uint64)
        words = int(((grams & THREE == ONE) & (times > 0)).sum())
        replies = [pack(times[x]) for x in np.split(own, np.cumsum(sizes)[:-1])]
        return pa.table({k: blobs.column(k) for k in ("slice", "bucket", "n", "mark", "tokens", "texts")} | {"times": pa.array(replies, pa.binary()), "words": pa.array([words] + [0] * (len(sizes) - 1), pa.int64())})

    return asked.groupBy("bucket").applyInArrow(add_up, "slice long, bucket long, n long, mark long, tokens long, texts long, times binary, words long")


class Automaton:
    """The part of the model that the texts of a slice can reach. States are numbers of n-grams of order 1 and 2; behind them
    come the root and the state in which a text begins."""

    def __init__(self, tokens: Tokens, grams: np.ndarray, place: np.ndarray, own: np.ndarray, times: np.ndarray, n_tokens: int, n_texts: int, n_words: int):
        """place: of each n-gram some place in tokens.grams; own: the n-gram of each such place; times: of each n-gram."""
        n, kind, m = len(tokens.later) + len(tokens.first), (grams & THREE).astype(np.int8), len(grams)
        self.one, self.two = own[:n], own[n : 2 * n]
        self.three = np.zeros(n, np.int32)
        self.three[tokens.later] = own[2 * n :]
        self.root, self.begin, self.times = m, m + 1, times
        #: Depth, count and shorter context of each state.
        self.depth = np.append(np.where((times > 0) & (kind < 3), kind, 0), [0, 1]).astype(np.int8)
        held = np.append(times, [0, n_texts]).astype(np.float64)
        self.fail, self.target = np.full(m + 2, m, np.int32), np.full(m + 2, m, np.int32)
        self.weight, self.back = np.zeros(m + 2), np.zeros(m + 2)
        # The token that ends each n-gram.
        at = np.where(kind == 1, place, np.where(kind == 2, place - n, 0)).astype(np.int32)
        at[kind == 3] = tokens.later[place[kind == 3] - 2 * n]
        start = np.zeros(n, bool)
        start[tokens.first] = True
        prior = np.where(start, self.begin, np.roll(self.one, 1))  # the state of the token before
        deeper = np.roll(self.two, 1)
        p = np.zeros(m)
        p[kind == 1] = (times[kind == 1] + 1) / (n_tokens + n_words + 1)
        for order, context, shorter in ((2, prior, self.one), (3, deeper, self.two)):
            own = np.flatnonzero(kind == order)
            p[own] = (times[own] + PRIOR[order] * p[shorter[at[own]]]) / (held[context[at[own]]] + PRIOR[order])
        self.weight[:m] = np.log10(p)
        for order, shorter in ((1, None), (2, self.one)):
            own = np.flatnonzero((kind == order) & (times > 0))
            self.back[own] = np.log10(PRIOR[order + 1] / (held[own] + PRIOR[order + 1]))
            self.target[own] = own
            if shorter is not None:
                self.fail[own] = shorter[at[own]]
        self.back[self.begin] = np.log10(PRIOR[2] / (n_texts + PRIOR[2]))
        own = np.flatnonzero((kind == 3) & (times > 0))
        self.target[own] = self.two[at[own]]

    def read(self, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        by_size = np.argsort(-counts, kind="stable")
        first, open_ = first[by_size], np.searchsorted(np.sort(counts), np.arange(counts.max()), "right")
        state, total = np.full(len(first), self.begin), np.zeros(len(first))
        for step, done in enumerate(open_.tolist()):
            m = len(first) - done
            at, s = first[:m] + step, state[:m]
            depth, sum_ = self.depth[s], np.zeros(m)
            then = np.full(m, -1)
            for order, gram in ((3, self.three), (2, self.two)):
                arc = gram[at]
                here = (depth == order - 1) & (then < 0)
                hit = here & (self.times[arc] > 0)
                then = np.where(hit, arc, then)
                fall = here & ~hit
                sum_ += np.where(fall, self.back[s], 0)
                s = np.where(fall, self.fail[s], s)
                depth = np.where(fall, depth - 1, depth)
            arc = np.where(then < 0, self.one[at], then)
            total[:m] += sum_ + self.weight[arc]
            state[:m] = self.target[arc]
        out = np.empty(len(total))
        out[by_size] = total
        return out


def _packed(rows: DataFrame) -> DataFrame:
    """The slices' texts, compressed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, trains, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(texts))], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([trains], pa.list_(pa.bool_())), pa.array([list(map(len, texts))], pa.list_(pa.int64()))],
                names=["slice", "times", "ids", "trains", "sizes"],
            )

    return rows.mapInArrow(work, "slice long, times binary, ids array<long>, trains array<boolean>, sizes array<long>")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row; the model learns from the rows
    that learnt() names."""
    rows = docs.select(F.col("doc_id").cast("long"), learnt().alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    if size is None:
        return spark.createDataFrame([], SCORES)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    replies = settle(answers(questions(rows, buckets)), "ngram-times")
    n_tokens, n_texts, n_words = replies.agg(F.sum("tokens"), F.sum("texts"), F.sum("words")).first()

    def score(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("bucket").to_pylist()  # a slice holds some MB
        text, replies = parts[0], parts[1:]  # the texts have bucket -1
        whole, texts, at = zstandard.ZstdDecompressor().decompress(text["times"]), [], 0
        for n in text["sizes"]:
            texts.append(whole[at : at + n])
            at += n
        tokens = Tokens(texts)
        grams, place, own = np.unique(tokens.grams >> ONE, return_index=True, return_inverse=True)
        place, own, tokens.grams = place.astype(np.int32), own.astype(np.int32), None
        edges = cut(grams, buckets)
        for r in replies:
            asked = grams[edges[r["bucket"]] : edges[r["bucket"] + 1]]
            if len(asked) != r["n"] or int(np.bitwise_xor.reduce(asked).view(np.int64)) != r["mark"]:
                raise ValueError("docs gave other rows, or another order of rows, when it was read again; write it to a table first")
        if sum(r["n"] for r in replies) != len(grams):
            raise ValueError("docs gave other rows when it was read again; write it to a table first")
        times = np.concatenate([unpack(r["times"], r["n"], np.uint64)[0] for r in replies]).astype(np.int64)
        automaton = Automaton(tokens, grams, place, own, times, n_tokens, n_texts, n_words)
        once = times[automaton.one]
        return pa.table({
            "doc_id": pa.array(text["ids"], pa.int64()),
            "held_out": pa.array([not x for x in text["trains"]]),
            "n_tokens": pa.array(tokens.counts.astype(np.int64)),
            "n_known": pa.array(np.add.reduceat((once > 0).astype(np.int64), tokens.first)),
            "train_tokens": pa.array(np.full(len(texts), n_tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10((once + 1) / (n_tokens + n_words + 1)), tokens.first)),
            "score": pa.array(automaton.read(tokens.first, tokens.counts)),
        })

    texts = _packed(rows).select("slice", F.lit(-1).cast("long").alias("bucket"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("mark"), "times", "ids", "trains", "sizes")
    nothing = [F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("ids", "trains", "sizes")]
    return texts.union(replies.select("slice", "bucket", "n", "mark", "times", *nothing)).groupBy("slice").applyInArrow(score, SCORES)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole texts."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
