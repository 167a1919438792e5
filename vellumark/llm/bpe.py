"""Byte-pair encoding of whole texts under a public rank file (problem 8).

A text is cut into pieces by the vocabulary's own pattern; each piece is merged with a priority queue of
merge ranks over a doubly linked list of symbols, where queue entries of symbols merged meanwhile are
skipped as stale. Decoding concatenates vocabulary byte strings. Pieces repeat, so each worker keeps the
ids of pieces it has met in a table of bounded size; the table never changes a result.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern the public byte-level vocabulary was built with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class BytePairCodec:
    """Encode and decode under a table of merge ranks (bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, remembered: int = 1 << 17, longest: int = 64):
        self.ranks = ranks
        self.vocabulary = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.remembered, self.longest = remembered, longest
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: lowest rank first, leftmost first among equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        after = list(range(1, n + 1))  # start of the next symbol, n at the end
        before = list(range(-1, n - 1))
        end = list(range(1, n + 1))  # end of the symbol that starts here; 0 once it was merged away
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, left, stop = heapq.heappop(queue)
            if not end[left]:
                continue
            right = after[left]
            if right >= n or end[right] != stop:
                continue  # stale: one side has grown since
            end[left], end[right] = stop, 0
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                if (r := ranks.get(piece[left : end[after[left]]])) is not None:
                    heapq.heappush(queue, (r, left, end[after[left]]))
            if before[left] >= 0:
                p = before[left]
                if (r := ranks.get(piece[p:stop])) is not None:
                    heapq.heappush(queue, (r, p, stop))
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = after[at]
        return ids

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        if (ids := self.known.get(piece)) is None:
            ids = tuple(self.merge(piece.encode("utf-8", "replace")))
            if len(piece) <= self.longest:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def extend(self, text: str | None, into: array) -> None:
        if text:
            known, ids = self.known.get, self.piece_ids
            for piece in self.split(text):
                into.extend(known(piece) or ids(piece))

    def encode(self, text: str | None) -> list[int]:
        self.extend(text, out := array("i"))
        return out.tolist()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.__getitem__, ids)).decode("utf-8", "replace")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, ids = self.known.get, self.piece_ids
        return sum(len(known(p) or ids(p)) for p in self.split(text))


@lru_cache(maxsize=4)
def load_codec(path: str = RANKS) -> BytePairCodec:
    """The codec of a rank file, once per worker process."""
    with open(path, "rb") as f:
        return BytePairCodec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def encode_corpus(df: DataFrame, text: str = "text", ids: str = "ids", path: str = RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row's `keep` columns and `ids`, the token ids of its whole text. One narrow pass, no shuffle.

    Null and empty texts give the empty list; strings of special tokens are ordinary text; repeated rows
    stay repeated; other columns, whatever their names, are dropped before the rows reach Python.
    """
    narrow = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*(narrow.schema[k] for k in keep), T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path)
        for batch in batches:
            flat, ends = array("i"), np.zeros(batch.num_rows + 1, np.int32)
            for k, value in enumerate(batch.column(len(keep)), 1):
                codec.extend(value.as_py(), flat)
                ends[k] = len(flat)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists], names=[*keep, ids])

    return spread(narrow).mapInArrow(encode, schema)


def decode_corpus(df: DataFrame, ids: str = "ids", text: str = "text", path: str = RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The texts of lists of ids; a null list gives null, the empty list the empty text."""
    narrow = df.select(*keep, F.col(ids).alias("__ids"))
    schema = T.StructType([*(narrow.schema[k] for k in keep), T.StructField(text, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path)
        for batch in batches:
            texts = [None if v is None else codec.decode(v) for v in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, text])

    return narrow.mapInArrow(decode, schema)
