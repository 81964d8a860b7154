"""Toxicity: every maximal-scoring segment over token log-odds, made comparable by extreme-value statistics.

A token's weight is its log-odds of standing in toxic rather than clean documents, with an informative Dirichlet prior
from the whole corpus; only weights that stand far enough out of their standard error count, all other tokens cost a
small drift. A linear-time scan finds all maximal-scoring segments. With background frequencies the weights give the
parameters of the extreme-value distribution of chance segments, and so each segment's expected number of equals; a
document adds up the normalised scores of its significant passages, which a logistic curve turns into a probability.

Defined results: null text counts as empty, has no passage and the lowest score; rows with null doc_id are scored, never
learnt from; null labels are ignored, of clashing labels the larger holds; without labels of both classes the score is
the share of label 1 (0.5 without any); repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, held_out, plain_rows, settle, slices, texts_of, training_labels

PASSAGES = "array<struct<first_word:int,last_word:int,score:double>>"
_PASSAGES = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())]))


def word_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, n, toxic, clean): in how many documents, and in how many of each label, a word's hash occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=4_000_000):
            rows = [np.unique(words) for words in plain_rows(texts_of(batch))]
            label = np.repeat(np.array([-1 if x is None else x for x in batch.column("label").to_pylist()]), [len(r) for r in rows])
            words, at, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
            sums = [np.bincount(at, weights=label == k, minlength=len(words)).astype(np.int64) for k in (1, 0)]
            yield pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": n, "toxic": sums[0], "clean": sums[1]})

    marked = docs.join(broadcast_if_small(labels), "doc_id", "left").select("text", "label")
    counts = marked.mapInArrow(run, "word long, n long, toxic long, clean long")
    return counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")])


def lexicon(counts: DataFrame, documents: int, toxic: int, clean: int, prior: float, least_z: float) -> DataFrame:
    """(word, weight, share): all words whose z-scored log-odds are at least least_z; share is how much of a clean
    document's words a word makes up."""
    words = (counts.agg(F.sum("n")).first()[0] or 1) / documents
    a = prior * F.col("n") / documents
    t, c = F.col("toxic") + a, F.col("clean") + a
    rest = lambda n, x: F.greatest(F.lit(1e-6), F.lit(n + prior) - x)
    odds = F.log(t / rest(toxic, t)) - F.log(c / rest(clean, c))
    z = odds / F.sqrt(1 / t + 1 / c)
    marked = counts.where("toxic > 0").select("word", odds.alias("weight"), z.alias("z"), (c / (clean + prior) / words).alias("share"))
    return marked.where(F.col("z") >= least_z).select("word", "weight", "share")


def segments(at: list[int], weights: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence in which the positions at have weights and every
    other position costs drift.

    Linear: each segment knows the nearest one to its left that begins at a smaller sum, so a search steps over all between
    them; and where no segment begins at a smaller sum, all are final and leave the stack."""
    found: list[tuple[float, float, int, int, int]] = []
    stack: list[tuple[float, float, int, int, int]] = []  # sum before and after, first and last position, left neighbour
    total, done = 0.0, -1
    for p, w in zip(at, weights, strict=True):
        total -= drift * (p - done - 1)
        low, high, first, k = total, total + w, p, len(stack) - 1
        total, done = high, p
        while True:
            while k >= 0 and stack[k][0] >= low:
                k = stack[k][4]
            if k < 0:
                found += stack
                stack.clear()
                break
            if stack[k][1] >= high:
                break
            low, _, first, _, left = stack[k]
            del stack[k:]
            k = left
        stack.append((low, high, first, p, k))
    return [(first, last, high - low) for low, high, first, last, _ in found + stack]


class Scale:
    """Extreme-value parameters of chance segments: decay of the score, and rate per word."""

    def __init__(self, weights: np.ndarray, shares: np.ndarray, drift: float):
        self.decay, self.rate = 1.0, 1e-6
        if len(weights):
            excess = lambda x: np.exp(-x * drift) * max(0.0, 1 - shares.sum()) + (shares * np.exp(np.minimum(x * weights, 700))).sum() - 1
            low, high = 1e-6, 1.0
            while excess(high) < 0 and high < 64:
                high *= 2
            for _ in range(60):
                mid = (low + high) / 2
                low, high = (mid, high) if excess(mid) < 0 else (low, mid)
            self.decay = low
            self.rate = float(shares.sum() * np.exp(min(self.decay * weights.min(), 50)))

    def bits(self, score: float, words: int) -> float:
        """Minus the log of the number of chance segments of at least this score in so many words."""
        return self.decay * score - float(np.log(max(self.rate * words, 1e-9)))


def passages(docs: DataFrame, words: np.ndarray, weights: np.ndarray, scale: Scale, drift: float, most_expected: float) -> DataFrame:
    """(doc_id, n_words, strength, passages) by the weights of words (sorted hashes): the significant passages and the sum of their normalised scores."""
    shared = docs.sparkSession.sparkContext.broadcast((words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, weight), least = shared.value, -np.log(most_expected)
        for batch in slices(batches):
            sizes, strengths, found = [], [], []
            for tokens in plain_rows(texts_of(batch)):
                at, hit = np.array([], np.int64), np.array([])
                if len(known) and len(tokens):
                    place = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    at = np.flatnonzero(known[place] == tokens)
                    hit = weight[place[at]]
                spans = segments(at.tolist(), hit.tolist(), drift)
                bits = [scale.bits(s, len(tokens)) for _, _, s in spans]
                keep = [(*span, b) for span, b in zip(spans, bits, strict=True) if b >= least]
                sizes.append(len(tokens))
                strengths.append(sum(b for *_, b in keep))
                found.append([{"first_word": a, "last_word": b, "score": s} for a, b, s, _ in keep])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(sizes, pa.int64()), "strength": pa.array(strengths, pa.float64()), "passages": pa.array(found, _PASSAGES)})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_words long, strength double, passages {PASSAGES}")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope by Newton steps, slightly held back so that separable data stay finite."""
    design, w = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * len(x) * np.diag([1e-3, 1.0])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), design.T @ (y - p) - ridge * len(x) * np.array([1e-3, 1.0]) * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def toxicity_scores(docs: DataFrame, labels: DataFrame, column: str = "toxic", prior: float = 100.0, least_z: float = 4.0, most_words: int = 8_000_000, drift: float = 0.1, most_expected: float = 0.05, max_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, passages for each row of docs.

    Every word of least_z is in the lexicon, 16 bytes each to all executors; as only words of toxic-labelled documents can
    be, labels bound it, and beyond most_words it raises an error and drops none. max_labels bounds the labelled rows that
    the final curve is fitted on, the lowest by a hash of doc_id (8 bytes of score each). Counts cover all documents."""
    spark = docs.sparkSession
    docs, known = docs.select(F.col("doc_id").cast("long"), "text"), settle(training_labels(labels, column), "toxic-labels")
    sizes = {r["label"]: r["n"] for r in docs.select("doc_id").join(broadcast_if_small(known), "doc_id", "left").groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean, documents = sizes.get(1, 0), sizes.get(0, 0), max(1, sum(sizes.values()))
    words, weights, shares = np.array([], np.uint64), np.array([]), np.array([])
    if toxic and clean:
        chosen = settle(lexicon(settle(word_counts(docs, known), "toxic-counts"), documents, toxic, clean, prior, least_z), "toxic-words")
        if (many := chosen.count()) > most_words:
            raise ValueError(f"{many} words reach a z-score of {least_z}, more than {most_words}: raise least_z")
        table = chosen.orderBy("word").toArrow()
        words, weights, shares = table["word"].to_numpy().view(np.uint64), table["weight"].to_numpy(), table["share"].to_numpy()
        order = np.argsort(words)
        words, weights, shares = words[order], weights[order], shares[order]
    found = settle(passages(docs, words, weights, Scale(weights, shares, drift), drift, most_expected), "toxic-passages")
    if toxic and clean:
        sample = found.select("doc_id", "strength").join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "strength").limit(max_labels).toPandas()
        a, b = logistic(np.log1p(sample["strength"].to_numpy(float)), sample["label"].to_numpy(float))
        score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log1p("strength"))))
    else:
        score = F.lit(toxic / (toxic + clean) if toxic + clean else 0.5)
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"), "passages")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return toxicity_scores(read("documents"), read("labels")).drop("passages")
