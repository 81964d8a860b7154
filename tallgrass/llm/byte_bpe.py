"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is a linked list of byte runs. A bucket per merge rank holds the list positions whose pair has that rank;
three levels of 64-way bitmaps say which buckets hold anything, so find-first-set gives the next rank in three steps.
Positions of one rank leave their bucket from left to right. An entry whose pair has changed since is stale and skipped.
The cost is n log n in the length of a pre-token, however long it is.

Defined results: null text counts as empty and has no tokens; every row is returned, repeated ones too; doc_id may be
null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, texts_of

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Encoded pre-tokens in one generation of a worker's memory, unless a caller wants fewer.
REMEMBERED = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder(dict):
    """pre-token (str) -> its ids as int32 bytes. Two generations of remembered pre-tokens each are kept: when the younger
    is full the older goes, so what recurs stays."""

    def __init__(self, ranks: dict[bytes, int], remembered: int = REMEMBERED):
        super().__init__()
        self.ranks, self.older, self.remembered = ranks, {}, remembered
        count = max(ranks.values(), default=0) + 1
        #: Bitmaps of the rank queue: which buckets hold positions, which words of low and of mid aren't zero.
        self.low = [0] * (count // 64 + 1)
        self.mid = [0] * (len(self.low) // 64 + 1)
        self.buckets: dict[int, list[int]] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.remembered:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token. The queue is empty before and after; its steps stand inline, as this is the one hot
        loop of the operator."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        low, mid, buckets, top, n = self.low, self.mid, self.buckets, 0, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
        pair.append(None)
        fresh = [(r, i) for i, r in enumerate(pair) if r is not None]
        while True:
            for rank, i in fresh:
                bucket = buckets.get(rank)
                if bucket is None:
                    buckets[rank] = [i]
                    w = rank >> 6
                    low[w] |= 1 << (rank & 63)
                    mid[w >> 6] |= 1 << (w & 63)
                    top |= 1 << (w >> 6)
                else:
                    heappush(bucket, i)
            if not top:
                break
            j = (top & -top).bit_length() - 1
            m = mid[j]
            w = (j << 6) + (m & -m).bit_length() - 1
            bits = low[w]
            rank = (w << 6) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                bits &= bits - 1
                low[w] = bits
                if not bits:
                    m &= m - 1
                    mid[j] = m
                    if not m:
                        top &= top - 1
            fresh = []
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = None
            if end < n:
                before[end] = i
                r = pair[i] = rank_of(piece[i : after[end]])
                if r is not None:
                    fresh.append((r, i))
            else:
                pair[i] = None
            left = before[i]
            if left >= 0:
                r = pair[left] = rank_of(piece[left:end])
                if r is not None:
                    fresh.append((r, left))
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, ranks: dict[bytes, int], remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder for a vocabulary; what it remembers serves its later tasks too."""
    if (path, remembered) not in _encoders:
        _encoders.clear()
        _encoders[path, remembered] = Encoder(ranks, remembered)
    return _encoders[path, remembered]


def _lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, decoded: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id and token_ids of each row's whole text; with decoded, also the bytes that the ids stand for. remembered decides
    memory and time, not results."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, split = encoder_of(path, ranks.value, remembered), regex.compile(pattern).findall
        token = {rank: piece for piece, rank in ranks.value.items()}.__getitem__
        for batch in slices(batches, max_bytes=1_000_000):
            parts = [b"".join(map(encoder.__getitem__, split(text.decode()))) for text in texts_of(batch)]
            columns = {"doc_id": batch.column("doc_id"), "token_ids": _lists(parts)}
            if decoded:
                columns["decoded"] = pa.array([b"".join(map(token, np.frombuffer(p, np.int32).tolist())) for p in parts], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, token_ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes (decoded) that token_ids stand for; null ids count as none."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in ranks.value.items()}.__getitem__
        for batch in batches:
            texts = [b"".join(map(token, ids or ())) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": pa.array(texts, pa.binary())})

    return encoded.select(F.col("doc_id").cast("long"), "token_ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id with counts and digests of ids and decoded bytes, and more columns of encoded."""
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(encode(docs, public_tokenizers.path(VOCABULARY), decoded=True))
