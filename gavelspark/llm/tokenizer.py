"""Encoding a corpus with a public byte-level BPE vocabulary (problem 6).

A pre-token is encoded with a rank queue: positions of mergeable pairs wait in one
bucket per merge rank, a three-level bitmap over the ranks gives the lowest rank
that waits by find-first-set, positions in a bucket come leftmost first, and an
entry whose pair has changed meanwhile is stale and skipped.  Symbols form a linked
list, so a merge costs constant time and a pre-token of n bytes O(n log n),
however long it is.  Pre-tokens recur, so short ones are encoded once per worker.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

#: Folder of the public vocabularies, unless a caller names another.
VOCABULARIES = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Pre-tokens longer than this are not kept; a worker keeps at most so many.
LONGEST_KEPT, MOST_KEPT = 48, 1_000_000

# Fixed value: the public pre-token pattern, with white space as Unicode defines it.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ids, which are also their merge ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class RankQueue:
    """Waiting positions by rank, with a three-level bitmap to find the lowest rank."""

    __slots__ = ("buckets", "low", "mid", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}
        self.mid: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word, block = rank >> 6, rank >> 12
        self.low[word] = self.low.get(word, 0) | 1 << (rank & 63)
        self.mid[block] = self.mid.get(block, 0) | 1 << (word & 63)
        self.top |= 1 << block

    def lowest(self) -> int:
        """The lowest waiting rank, or -1."""
        if not self.top:
            return -1
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = block << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def pop(self, rank: int) -> int:
        """The leftmost position of a waiting rank; an emptied bucket clears its bits."""
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            word, block = rank >> 6, rank >> 12
            self.low[word] &= ~(1 << (rank & 63))
            if not self.low[word]:
                self.mid[block] &= ~(1 << (word & 63))
                if not self.mid[block]:
                    self.top &= ~(1 << block)
        return position


def merge_all(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: lowest rank first, leftmost first, until no pair merges."""
    if not piece:
        return []
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # a symbol is piece[i:end[i]]; its start names it
    before = list(range(-1, n - 1))
    alive = bytearray(b"\1" * n)
    queue = RankQueue()
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            queue.push(rank, i)
    while (rank := queue.lowest()) >= 0:
        i = queue.pop(rank)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or get(piece[i : end[j]]) != rank:
            continue  # stale: the pair at i is another one by now
        alive[j] = 0
        end[i] = k = end[j]
        if k < n:
            before[k] = i
            rank = get(piece[i : end[k]])
            if rank is not None:
                queue.push(rank, i)
        h = before[i]
        if h >= 0:
            rank = get(piece[h:k])
            if rank is not None:
                queue.push(rank, h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


#: Tokens after which an Arrow batch is cut.
MOST_TOKENS = 2**26


class Encoder(dict):
    """Pre-token text to its ids; encodes what it has not seen."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import regex

        super().__init__()
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(merge_all(piece.encode("utf-8", "surrogatepass"), self.ranks))
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty texts have none."""
        return list(chain.from_iterable(map(self.__getitem__, self.split(text)))) if text else []


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(load_ranks(path))
    return _ENCODERS[path]


def encode_batches(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (key, text) to (key, ids)."""
    import numpy as np

    own = encoder(path)
    for batch in batches:
        get, split = own.__getitem__, own.split
        texts, first, held, parts = batch.column(1).to_pylist(), 0, 0, []
        for row, t in enumerate(texts):
            parts.append(np.fromiter(chain.from_iterable(map(get, split(t))), dtype=np.int32) if t else np.empty(0, np.int32))
            held += len(parts[-1])
            # A batch's offsets are of 32 bits, so one with very many tokens is cut between rows.
            if held >= MOST_TOKENS or row + 1 == len(texts):
                offsets = np.zeros(len(parts) + 1, np.int32)
                np.cumsum([len(p) for p in parts], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(parts)), ids], names=[batch.schema.names[0], "ids"])
                first, held, parts = row + 1, 0, []


def encode_corpus(documents: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """``key`` and ``ids array<int>`` of every row: no shuffle, one pass, whole texts.

    Null, empty texts: an empty list.  Blank texts are encoded like any other;
    tokenizer-like markers are ordinary text; no special tokens are added.  Repeated
    rows come out repeated.  ``vocabulary`` is the path of a rank file, which every
    executor can read.
    """
    path = vocabulary or f"{VOCABULARIES}/byte_bpe_50k.tiktoken"
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(lambda batches: encode_batches(batches, path), f"`{key}` {kind}, ids array<int>")
