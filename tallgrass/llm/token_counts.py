"""Token counts: a unigram language model's best segmentation, computed once for each prefix that pre-tokens share.

A pre-token is a run of [^\\x20\\x09-\\x0D] with the word-start mark before it. A slice's distinct pre-tokens form a trie that
is walked in order, so that only the path to the present node is held; a node has the best score of its prefix (of equal
scores the one with fewer tokens) and how many tokens that takes, computed once from its ancestors. The pieces that end
at a node are found by going up the path along a trie of reversed pieces. Terminal counts are kept, for a worker's later
tasks too, so a document's count is a sum of look-ups. Pieces have the rank of the vocabulary file, which has no probabilities; a
piece's log-probability follows Zipf's law on that rank. A character that no piece covers is one token per UTF-8 byte.

Defined results: null text counts as empty and has 0 tokens; every row is returned, doc_id may be null or repeated; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

VOCABULARY = "piece_bpe_32k.model"
START = "▁"
#: Pre-tokens that a worker remembers beyond which it starts anew.
REMEMBERED = 300_000


def load_pieces(path: str) -> dict[str, float]:
    """Ordinary pieces and their log-probabilities."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (rank + 3) for rank in range(len(pieces))))
    return {piece: -math.log(rank + 3) - total for rank, piece in enumerate(pieces)}


class TrieCounts(dict):
    """word -> (token count, log-probability) of its pre-token."""

    def __init__(self, pieces: dict[str, float]):
        super().__init__()
        self.byte = min(pieces.values(), default=0.0) - 10
        #: From the last character to the first; the empty key holds the log-probability of the piece.
        self.reversed: dict = {}
        for piece, p in pieces.items():
            node = self.reversed
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[""] = p

    def learn(self, words: list[str]) -> None:
        """Count the distinct words that aren't known yet."""
        fresh = sorted(w for w in words if w not in self)
        if len(self) + len(fresh) > REMEMBERED:
            self.clear()
            fresh = sorted(words)
        scores, tokens, before, byte, root = [0.0], [0], "", self.byte, self.reversed
        for word in fresh:
            text, shared = START + word, 0
            for a, b in zip(before, text, strict=False):
                if a != b:
                    break
                shared += 1
            del scores[shared + 1 :], tokens[shared + 1 :]
            for depth in range(shared, len(text)):
                char = text[depth]
                width = 1 if char < "\x80" else len(char.encode())
                best, fewest = scores[depth] + width * byte, tokens[depth] + width
                node, at = root.get(char), depth
                while node is not None:
                    p = node.get("")
                    if p is not None:
                        score = scores[at] + p
                        if score > best or score == best and tokens[at] < fewest - 1:
                            best, fewest = score, tokens[at] + 1
                    if not at:
                        break
                    at -= 1
                    node = node.get(text[at])
                scores.append(best)
                tokens.append(fewest)
            self[word] = tokens[-1], scores[-1]
            before = text


_tries: dict[str, TrieCounts] = {}


def trie_of(path: str, pieces: dict[str, float]) -> TrieCounts:
    """The worker's trie for a vocabulary."""
    if path not in _tries:
        _tries.clear()
        _tries[path] = TrieCounts(pieces)
    return _tries[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens and log_probability of each row's whole text."""
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(path, pieces.value)
        for batch in slices(batches, max_bytes=4_000_000):
            split = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
            words = split.flatten().dictionary_encode()
            # white space at either end leaves empty words, which aren't pre-tokens
            distinct = words.dictionary.to_pylist()
            trie.learn([w for w in distinct if w])
            found = np.array([(1, *trie[w]) if w else (0, 0, 0.0) for w in distinct]).reshape(-1, 3)
            counts = pc.list_value_length(split).to_numpy()
            totals, some = np.zeros((batch.num_rows, 3)), counts > 0
            if some.any():
                totals[some] = np.add.reduceat(found[words.indices.to_numpy()], (np.cumsum(counts) - counts)[some], axis=0)
            whole = [pa.array(totals[:, k].astype(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *whole, pa.array(totals[:, 2])], ["doc_id", "n_pretokens", "n_tokens", "log_probability"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, log_probability double")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))
