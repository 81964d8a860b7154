"""What the text operators share: a scratch folder all executors see, words, hashes, safe column names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word cache is emptied beyond this many entries, so that a worker's memory stays bounded.
CACHE_WORDS = 300_000
#: Bytes of words: anything but white space; or letters and digits of lower-cased text.
SOLID = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
PLAIN = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240229).integers(1, 2**64, 256, np.uint64)
_powers: list[np.ndarray] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir. Where that is unset a session in one process (tests) gets a
    folder of its own; on a cluster a machine-local folder would lose rows, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tallgrass-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends rows to Python 500 at a time, so that neither side holds thousands of texts at once."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(batch)
    spark.conf.set(batch, str(min(int(usual), 500)) if int(usual) > 0 else "500")
    try:
        yield
    finally:
        spark.conf.set(batch, usual)


def settle(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors. With wide, rows that hold whole
    sets go to Python some hundred at a time."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    with small_batches(spark) if wide else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Hint a broadcast only when a count shows at most max_rows narrow rows; otherwise Spark shuffles."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text divides by 5. A null id is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """One row (doc_id, label) for each labelled id outside the held-out fold; the larger of clashing labels holds."""
    return (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64, at least n of each, kept for later calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 18)
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 2**64)))]
    return _powers[0], _powers[1]


def run_hashes(text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the maximal runs of bytes that inside admits.

    A run's hash is a polynomial in its bytes, read off prefix sums, so no run becomes a Python object."""
    power, inverse = _powers_to(len(text) + 1)
    edge = np.diff(np.concatenate([[False], inside[text], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[text] * power[: len(text)])])
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts])


def word_rows(texts: list[bytes], inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the number of words of each text. No text may have line feeds
    inside words."""
    starts, hashes = run_hashes(np.frombuffer(b"\n".join(texts), np.uint8), inside)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def plain_rows(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of each text's lower-cased runs of letters and digits."""
    hashes, counts = word_rows([t.decode().lower().encode() for t in texts], PLAIN)
    return np.split(hashes, np.cumsum(counts)[:-1])


def block_sums(parts: DataFrame, blocks: int, dtype: type) -> np.ndarray:
    """Sum rows (block, sums) by block as a stream, so that a task holds its blocks only, and return the whole table.

    The table's size is fixed by the caller and doesn't depend on the data."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
                x = np.frombuffer(sums.as_buffer(), dtype)
                total[block] = total[block] + x if block in total else x.astype(np.float64)
        if total:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(total), pa.int32()), "sums": pa.array([x.tobytes() for x in total.values()], pa.binary())})

    rows = parts.repartition(blocks, "block").mapInArrow(add_up, "block int, sums binary").collect()
    found = {r["block"]: np.frombuffer(r["sums"]) for r in rows}
    width = len(next(iter(found.values()))) if found else 0
    return np.stack([found.get(b, np.zeros(width)) for b in range(blocks)])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = 250_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about max_bytes of text, or one row. Arrays of 8 bytes for each byte of such a
    slice stay in a core's cache, and a worker keeps little memory after them."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(lengths) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The batch's texts as UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]
