"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network in numpy whose
probabilities a temperature calibrates.

Words fall into a fixed number of buckets. Every bucket owns a sparse ternary index vector; a word's context vector is
the sum of the index vectors of its neighbours over the whole corpus, gathered in one pass whose result has a fixed size
(BUCKETS x DIMS). A document is the mean of its words' vectors. The network learns from at most max_labels labelled
rows outside the held-out fold, the lowest by a hash of doc_id.

Defined results: null text counts as empty, pools to zeros and gets the network's score for zeros; rows with null doc_id
are scored, never learnt from; null labels are ignored, of clashing labels the larger holds; without both classes of
labels every score is the share of label 1 (0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHash, block_sums, held_out, mix, settle, slices, texts_of, training_labels

BUCKETS, DIMS, NONZEROS, WINDOW, BLOCKS = 1 << 15, 64, 4, 2, 64
#: Letter runs, digit runs and runs of other marks are words of their own.
WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\s\x80-\xff]+")


def index_dims() -> np.ndarray:
    """The NONZEROS dimensions of each bucket's index vector: +1 in the first half of them, -1 in the others."""
    seeds = np.arange(BUCKETS * NONZEROS, dtype=np.uint64).reshape(BUCKETS, NONZEROS)
    return (mix(seeds + np.uint64(1)) % np.uint64(DIMS)).astype(np.int64)


def _words(batch: pa.RecordBatch, hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of the batch, and the number of words of each row."""
    found = [WORD.findall(text) for text in texts_of(batch)]
    words = [w for row in found for w in row]
    return (hashes.array(words) % np.uint64(BUCKETS)).astype(np.int64), np.array([len(row) for row in found], np.int64)


def context_sums(docs: DataFrame) -> np.ndarray:
    """The corpus's context vectors (BUCKETS x DIMS): each task adds up its rows, then each block of buckets is summed
    as a stream. Only the fixed-size result reaches the driver."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, dims, total, any_row = WordHash(), index_dims(), np.zeros(BUCKETS * DIMS, np.float32), False
        for batch in slices(batches):
            words, counts = _words(batch, hashes)
            row, any_row = np.repeat(np.arange(len(counts)), counts), True
            for step in range(1, WINDOW + 1):
                same = row[:-step] == row[step:]
                a, b = words[:-step][same], words[step:][same]
                for centre, near in ((a, b), (b, a)):
                    at = centre * DIMS
                    for k in range(NONZEROS):
                        add = np.bincount(at + dims[near, k], minlength=BUCKETS * DIMS)
                        (np.add if k < NONZEROS // 2 else np.subtract)(total, add, out=total)
        if any_row:
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "sums": pa.array([x.tobytes() for x in total.reshape(BLOCKS, -1)], pa.binary())})

    sums = block_sums(docs.select("text").mapInArrow(gather, "block int, sums binary"), BLOCKS, np.float32)
    return sums.reshape(-1, DIMS) if sums.size else np.zeros((BUCKETS, DIMS))


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context and index vectors of unit length, added."""
    own = np.zeros((BUCKETS, DIMS), np.float32)
    dims = index_dims()
    for k in range(NONZEROS):
        own[np.arange(BUCKETS), dims[:, k]] += 1 if k < NONZEROS // 2 else -1
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return (unit(sums) + unit(own)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, features): the mean of the vectors of the row's words, as float32 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in slices(batches, max_bytes=500_000):
            words, counts = _words(batch, hashes)
            means, some = np.zeros((len(counts), DIMS), np.float32), counts > 0
            if some.any():
                starts = (np.cumsum(counts) - counts)[some]
                means[some] = np.add.reduceat(shared.value[words], starts, axis=0) / counts[some, None]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "features": pa.array([x.tobytes() for x in means], pa.binary())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, features binary")


class Network:
    """tanh hidden layer, logistic output, features standardised, temperature fitted on rows not trained on."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.constant = None if len(set(y.tolist())) == 2 else float(y.mean()) if len(y) else 0.5
        if self.constant is not None:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(x))
        held, train = order[: len(x) // 5], order[len(x) // 5 :]
        w = [rng.normal(0, DIMS**-0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(train), max(1, len(train) // 128)):
                h = np.tanh(x[rows] @ w[0] + w[1])
                error = (1 / (1 + np.exp(-(h @ w[2] + w[3]))) - y[rows]) / len(rows)
                back = np.outer(error, w[2]) * (1 - h * h)
                t += 1
                for i, g in enumerate((x[rows].T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ error + 1e-4 * w[2], error.sum(keepdims=True))):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    w[i] -= 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.weights, self.temperature = w, 1.0
        if len(set(y[held].tolist())) == 2:
            logit, sign = self._logit(x[held]), 2 * y[held] - 1
            self.temperature = min(np.geomspace(0.25, 8, 61), key=lambda temperature: np.logaddexp(0, -sign * logit / temperature).mean())

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.weights[0] + self.weights[1]) @ self.weights[2] + self.weights[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -40, 40)))


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float32).reshape(-1, DIMS).astype(np.float64)


def quality_scores(docs: DataFrame, labels: DataFrame, column: str = "quality", max_labels: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    docs = docs.select("doc_id", "text")
    features = settle(pooled(docs, word_vectors(context_sums(docs))), "quality-features")
    known = features.join(training_labels(labels, column), "doc_id").dropDuplicates(["doc_id"])
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).toPandas()
    network = Network(matrix(rows["features"]), rows["label"].to_numpy(np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value(matrix(batch.column("features").to_pylist()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return quality_scores(read("documents"), read("labels"))
