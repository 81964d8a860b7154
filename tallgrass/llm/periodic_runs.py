"""Periodic runs of words, found with a run-length grammar built by recompression.

The words of a slice of texts form one string, with a symbol of its own after each text, so that nothing matches across
texts. Rounds of block compression (a maximal power of one symbol becomes one symbol) and pair compression (the alphabet is
split in two by chance; a left symbol before a right one becomes one symbol) shorten it until each text is one symbol. Which
symbols merge depends on the symbols alone, so equal stretches get equal parses but at their edges: a longest common
extension climbs the levels while the parents agree and comes down where they differ, a few steps a level. There is no
suffix array.

A run of period q and n words holds at least max(24 - q, 2 q) places whose word recurs q words later. So of each period only
every max(24 - q, 2 q)-th place is looked at (a harmonic grid, n log n places in all); where the word recurs, the grammar
gives the exact extensions to both sides.

Defined results: null and empty texts have no words, no runs and the digests of empty strings; a null doc_id leaves its words
as they are; rows of one doc_id are worked on one by one; an empty table gives an empty result; extra columns are ignored.
Words are told apart by 64-bit hashes, within a slice of texts."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SOLID, mix, slices, texts_of, word_rows

#: A run has at least so many words, and at least so many periods.
LEAST, TIMES = 24, 3
#: Places of the grid that are looked at in one go.
GRID = 2_000_000


class Level:
    """One string of the grammar: its symbols, the words that each of them stands for, and, once the next level is there,
    the symbol of that level that holds each of them."""

    def __init__(self, symbols: np.ndarray, widths: np.ndarray):
        self.symbols, self.widths = symbols, widths
        self.parent = self.first = self.last = self.ends = self.starts = None

    def join(self, begins: np.ndarray, symbols: np.ndarray) -> Level:
        """The next level, whose symbols begin at these places."""
        n, k = len(self.symbols), len(begins)
        self.first = begins
        self.last = np.append(begins[1:], n) - 1
        self.parent = np.repeat(np.arange(k), self.last - begins + 1)
        self.starts, self.ends = np.zeros(n, bool), np.zeros(n, bool)
        self.starts[begins] = True
        self.ends[self.last] = True
        return Level(symbols, np.add.reduceat(self.widths, begins) if n else self.widths)


def _named(a: np.ndarray, b: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """A new symbol for each different pair of numbers below 2**31."""
    kinds, names = np.unique((a.astype(np.int64) << 32) | b.astype(np.int64), return_inverse=True)
    return names + fresh, fresh + len(kinds)


class Grammar:
    """Levels over words (numbers from 0 on); texts end with a mark each, -1, -2 and so on, that never joins with others."""

    def __init__(self, words: np.ndarray):
        fresh, texts = int(words.max(initial=-1)) + 1, int((words < 0).sum())
        self.levels = [Level(words.astype(np.int64), np.ones(len(words), np.int64))]
        self.powers: list[bool] = []
        self.rounds = 0
        while len(self.levels[-1].symbols) > 2 * texts:
            self.rounds += 1
            for powers in (True, False):
                level = self.levels[-1]
                begins, symbols, fresh = (self._blocks if powers else self._pairs)(level.symbols, fresh)
                if len(begins) < len(level.symbols):
                    self.levels.append(level.join(begins, symbols))
                    self.powers.append(powers)

    @staticmethod
    def _blocks(s: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
        begins = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes, symbols = np.diff(np.append(begins, len(s))), s[begins]
        long = np.flatnonzero(sizes > 1)
        if len(long):
            symbols[long], fresh = _named(symbols[long], sizes[long], fresh)
        return begins, symbols, fresh

    def _pairs(self, s: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
        side = (mix(s.astype(np.uint64) + np.uint64(self.rounds << 40)) & np.uint64(1)).astype(bool)
        inner = s >= 0
        heads = np.flatnonzero((side & inner)[:-1] & (~side & inner)[1:])
        keep = np.ones(len(s), bool)
        keep[heads + 1] = False
        symbols = s.copy()
        if len(heads):
            symbols[heads], fresh = _named(s[heads], s[heads + 1], fresh)
        return np.flatnonzero(keep), symbols[keep], fresh

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Numbers of equal words from i and j on; with back, from i and j backwards. All i lie before their j."""
        found, step = np.zeros(len(i), np.int64), -1 if back else 1
        stand = np.stack([i, j]).astype(np.int64)
        level_of = np.zeros(len(i), np.int64)
        going, top = np.arange(len(i)), len(self.levels) - 1

        def eat(at: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Pass equal symbols, of a power as many as both have. Which of q go on, with both at the edge of a parent."""
            level = self.levels[at]
            a, b = stand[0, q], stand[1, q]
            # A place before the first word or behind the last has no symbol.
            inside = (a >= 0) & (b >= 0) & (a < len(level.symbols)) & (b < len(level.symbols))
            q, a, b = q[inside], a[inside], b[inside]
            same = level.symbols[a] == level.symbols[b]
            q, a, b = q[same], a[same], b[same]
            if at < top and self.powers[at]:
                edge = level.first if back else level.last
                left, right = (np.abs(edge[level.parent[x]] - x) + 1 for x in (a, b))
                n = np.minimum(left, right)
                on = left == right
            else:
                n, on = np.ones(len(q), np.int64), np.ones(len(q), bool)
            found[q] += n * level.widths[a]
            stand[:, q] += step * n
            return q, q[on]

        def rises(at: int, q: np.ndarray) -> np.ndarray:
            """Whether both places begin (end) equal symbols of the next level."""
            level, above = self.levels[at], self.levels[at + 1].symbols
            a, b = stand[0, q], stand[1, q]
            inside = (a >= 0) & (b >= 0) & (a < len(level.symbols)) & (b < len(level.symbols))
            a, b = np.where(inside, a, 0), np.where(inside, b, 0)
            edge = level.ends if back else level.starts
            return inside & edge[a] & edge[b] & (above[level.parent[a]] == above[level.parent[b]])

        for at in range(top):
            up = []
            # The first symbol may lie within a parent and the second have another parent; after that both parses agree.
            for _ in range(2):
                rise = rises(at, going)
                up.append(going[rise])
                _, going = eat(at, going[~rise])
            going = np.concatenate([*up, going[rises(at, going)]])
            level_of[going] = at + 1
            stand[:, going] = self.levels[at].parent[stand[:, going]]
            if not len(going):
                break
        while len(going):  # at the top each text has at most a few symbols
            going = eat(top, going)[1]
        for at in range(int(level_of.max(initial=0)), 0, -1):
            q = np.flatnonzero(level_of == at)
            below, above = self.levels[at - 1], len(self.levels[at].symbols)
            child, none = (below.last, -1) if back else (below.first, len(below.symbols))
            for side in (0, 1):
                x = stand[side, q]
                inside = (x >= 0) & (x < above)
                stand[side, q] = np.where(inside, child[np.where(inside, x, 0)], none)
            level_of[q] = at - 1
            eat(at - 1, q)
        return found


def grid(n: int, low: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods from low on that any run of n words with such a period has among them, some GRID at a time."""
    top = n // TIMES
    while low <= top and n >= LEAST:
        q = np.arange(low, min(top, low + GRID) + 1)
        stride = np.maximum(LEAST - q, (TIMES - 1) * q)
        counts = (n - q - 1) // stride + 1
        fit = max(1, int(np.searchsorted(np.cumsum(counts), GRID)))
        q, stride, counts = q[:fit], stride[:fit], counts[:fit]
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield nth * np.repeat(stride, counts), np.repeat(q, counts)
        low += fit


def find_runs(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, start, length and smallest period of all runs of the texts, given the words of all texts as numbers and
    the number of words of each text. In order of text, start and period."""
    begins = np.cumsum(counts) - counts
    places, periods, owner = [], [], []
    for text in np.flatnonzero(counts >= LEAST):
        own = words[begins[text] : begins[text] + counts[text]]
        for i, q in grid(int(counts[text])):
            hit = own[i] == own[i + q]
            places.append(i[hit] + begins[text] + text)  # each text before has a mark behind it
            periods.append(q[hit])
            owner.append(np.full(int(hit.sum()), text))
    if not sum(map(len, places)):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    i, q, text = map(np.concatenate, (places, periods, owner))
    grammar = Grammar(np.insert(words.astype(np.int64), begins + counts, -1 - np.arange(len(counts))))
    after = grammar.extend(i, i + q)
    before = grammar.extend(i - 1, i + q - 1, back=True)
    length = before + after + q
    hold = length >= np.maximum(LEAST, TIMES * q)
    rows = np.stack([text, i - before - begins[text] - text, length, q])[:, hold]
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    # Of one stretch the smallest period holds; a multiple of it has the same stretch.
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(0)
    rows = rows[:, new]
    return tuple(rows[:, np.lexsort((rows[3], rows[1], rows[0]))])


def damage(doc_id: int | None, n: int) -> np.ndarray:
    """Which original word each of n words becomes: in a tenth of the documents the words from some place on recur."""
    of = np.arange(n)
    if doc_id is None or not n:
        return of
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0:
        g = h // 10
        a = g % n
        of[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return of


def _found(batches: Iterator[pa.RecordBatch], damaged: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, max_bytes=1_000_000):
        texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
        hashes, counts = word_rows(texts, SOLID)
        numbers = np.unique(hashes, return_inverse=True)[1]
        split = [t.split() for t in texts]
        if damaged:
            begins = (np.cumsum(counts) - counts).tolist()
            for k, (doc_id, n) in enumerate(zip(ids, counts.tolist(), strict=True)):
                if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
                    of = damage(doc_id, n)
                    numbers[begins[k] : begins[k] + n] = numbers[begins[k] + of]
                    split[k] = list(map(split[k].__getitem__, of.tolist()))
        text, start, length, period = find_runs(numbers, counts)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            repeats = np.zeros(int(counts[k]) + 1, np.int64)
            own = slice(bounds[k], bounds[k + 1])
            np.add.at(repeats, start[own] + period[own], 1)
            np.add.at(repeats, start[own] + length[own], -1)
            split[k] = list(map(split[k].__getitem__, np.flatnonzero(np.cumsum(repeats)[:-1] == 0).tolist()))
        runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
            "collapsed": pa.array([b" ".join(words) for words in split], pa.binary()),
        })


def periodic_runs(docs: DataFrame, damaged: bool = False) -> DataFrame:
    """doc_id, runs (start, length, period by start, then period) and collapsed, the text's words without those that a run
    repeats, joined by one space. With damaged, words first recur as damage() says."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: _found(batches, damaged), "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def most_periodic(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length over period; ties go to the smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = dict.fromkeys(("n_runs", "start", "length", "period", "exponent_milli"), pa.int64()) | dict.fromkeys(("runs_sha256", "collapsed_sha256"), pa.string())
    for batch in batches:
        columns: dict[str, list] = {k: [] for k in kinds}
        for runs, collapsed in zip(batch.column("runs").to_pylist(), batch.column("collapsed").to_pylist(), strict=True):
            rows = [(r["start"], r["length"], r["period"]) for r in runs]
            start, length, period = most_periodic(rows) or (None, None, None)
            listed = "".join(f"{a},{b},{c}\n" for a, b, c in rows)
            values = (len(rows), start, length, period, length and 1000 * length // period, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
            for column, value in zip(columns.values(), values, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {k: pa.array(v, kinds[k]) for k, v in columns.items()})


def run_digests(docs: DataFrame, damaged: bool = False) -> DataFrame:
    """Counts, the most periodic run and digests of what periodic_runs finds, made where it is found."""
    head = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: _summed_up(_found(batches, damaged)), head)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text, a tenth of the texts with recurring words."""
    return run_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), damaged=True)
