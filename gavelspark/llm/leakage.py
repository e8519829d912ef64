"""Evaluation texts inside a training corpus (problem 7).

The test items are a BM25 inverted index with block maxima.  A query is a passage of
a document: a run of words that the index knows, at least eight long (unknown words
score nothing and end a run), cut into overlapping stretches so that eight
consecutive words are never parted.  Per item the least score of any eight
consecutive words of its own is a threshold that no leak can fall below, so taking
all items above it loses none.  Blocks of items are visited as in block-max WAND:
one is skipped if the sum of its block maxima over the query's words is below the
least threshold in it.  Candidates are then verified word by word.

The corpus is read once, whatever the number of items.  Up to SHARD items are one
index, which is broadcast.  Of more items, a filter of at most FILTER_BITS bits over
their eight-word stretches is broadcast first; the passages that it cannot rule out
are written to the shared folder, and index after index is asked about these only.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelspark.session import checkpoint

#: Consecutive words that make a leak.
RUN = 8
#: Words of one query stretch; neighbours share RUN - 1.
STRETCH = 40
#: Items per block of the index, and per broadcast index (larger sets are searched in shards).
BLOCK, SHARD = 16, 32_768
#: Bits of the stretch filter, at most (64 MiB); per stretch; and per part that a task sends.
FILTER_BITS, STRETCH_BITS, PART_BITS = 2**29, 16, 2**19
#: BM25 parameters.
K1, B = 1.2, 0.75

_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿\U000e0000-\U000e007f]")
_MARKUP = re.compile(r"<[/!?a-zA-Z][^<>]*>|&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,6});")
_MARKS = re.compile(r"[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃿︠-︯]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Folded words: case, accents, punctuation, markup, white space and invisible
    characters do not matter; an apostrophe does not part a word.  Null has none."""
    if not text:
        return []
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))).replace("’", "'").replace("ʼ", "'")
        text = text.casefold()
    else:
        text = text.lower()
    if "<" in text or "&" in text:
        text = _MARKUP.sub(" ", text)
    if "'" in text:
        text = text.replace("'", "")
    return _WORD.findall(text)


class ItemIndex:
    """BM25 inverted index of test items with block maxima and thresholds."""

    def __init__(self, items: list[tuple[int, list[str]]]) -> None:
        items = sorted((i, w) for i, w in items if len(w) >= RUN)
        self.ids = [i for i, _ in items]
        self.terms: dict[str, int] = {}
        coded = [[self.terms.setdefault(x, len(self.terms)) for x in w] for _, w in items]
        n, m = len(coded), len(self.terms)
        self.blocks = (n + BLOCK - 1) // BLOCK
        often = np.zeros(m)
        for w in coded:
            often[list(set(w))] += 1
        idf = np.log(1 + (n - often + 0.5) / (often + 0.5))
        mean = sum(map(len, coded)) / n if n else 1
        # Postings by block: rows of the block's own terms, a column per item of the block.
        self.postings: list[tuple[np.ndarray, np.ndarray]] = []
        self.least = np.full(n, np.inf, np.float32)
        self.shingles: dict[bytes, list[int]] = defaultdict(list)
        highest: list[np.ndarray] = []
        for b in range(self.blocks):
            part = coded[b * BLOCK : (b + 1) * BLOCK]
            own = np.array(sorted({x for w in part for x in w}), np.int32)
            impact = np.zeros((len(own) + 1, len(part)), np.float32)  # the last row is for absent terms
            for c, w in enumerate(part):
                code = np.array(w, np.int32)
                place = np.searchsorted(own, code)
                tf = np.bincount(place, minlength=len(own))
                impact[:-1, c] = idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
                scores = [impact[np.unique(place[k : k + RUN]), c].sum() for k in range(len(w) - RUN + 1)]
                self.least[b * BLOCK + c] = min(scores) * (1 - 1e-5)
                for key in {code[k : k + RUN].tobytes() for k in range(len(w) - RUN + 1)}:
                    self.shingles[key].append(b * BLOCK + c)
            highest.append(impact[:-1].max(axis=1))
            self.postings.append((own, impact))
        self.block_least = np.array([self.least[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.blocks)], np.float32)
        # Block maxima, sparse: the blocks of a term and its maxima there lie between two starts.
        terms = np.concatenate([own for own, _ in self.postings]) if n else np.zeros(0, np.int32)
        order = np.argsort(terms, kind="stable")
        self.at_block = np.repeat(np.arange(self.blocks, dtype=np.int32), [len(own) for own, _ in self.postings])[order] if n else terms
        self.maximum = np.concatenate(highest)[order] if n else np.zeros(0, np.float32)
        self.start = np.searchsorted(terms[order], np.arange(m + 1))

    def above(self, query: np.ndarray) -> list[int]:
        """All items whose score for the query's distinct words reaches their threshold."""
        distinct = np.unique(query)
        spans = [slice(self.start[t], self.start[t + 1]) for t in distinct]
        bound = np.bincount(np.concatenate([self.at_block[s] for s in spans]), np.concatenate([self.maximum[s] for s in spans]), self.blocks)
        found: list[int] = []
        for b in np.flatnonzero(bound >= self.block_least * (1 - 1e-5)):
            own, impact = self.postings[b]
            place = np.searchsorted(own, distinct)
            place[np.append(own, -1)[place] != distinct] = len(own)
            scores = impact[place].sum(axis=0)
            first = b * BLOCK
            found += [first + int(c) for c in np.flatnonzero(scores >= self.least[first : first + impact.shape[1]] * (1 - 1e-5))]
        return found

    def leaks(self, text_words: list[str]) -> dict[int, int]:
        """Items leaked in a document and how many of its eight-word stretches match."""
        n = len(text_words)
        if n < RUN or not self.ids:
            return {}
        get = self.terms.get
        code = np.fromiter((get(w, -1) for w in text_words), np.int32, n)
        known = np.concatenate(([0], (code >= 0).view(np.int8), [0]))
        edge = np.flatnonzero(np.diff(known))
        out: dict[int, int] = {}
        for start, end in zip(edge[::2], edge[1::2]):
            if end - start < RUN:
                continue
            for at in range(start, max(start + 1, end - RUN + 1), STRETCH - RUN + 1):
                query = code[at : min(end, at + STRETCH)]
                candidates = self.above(query) if len(query) >= RUN else []
                if not candidates:
                    continue
                wanted = set(candidates)
                for k in range(len(query) - RUN + 1):
                    for item in self.shingles.get(query[k : k + RUN].tobytes(), ()):
                        if item in wanted:
                            out[self.ids[item]] = out.get(self.ids[item], 0) + 1
        return out


@lru_cache(maxsize=500_000)
def _hash(word: str) -> int:
    code = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(code) << 32 | zlib.crc32(code, 0x5BD1E995)


_ODD = [pow(0x9E3779B97F4A7C15, k + 1, 2**64) | 1 for k in range(RUN)]


def stretch_places(text_words: list[str], bits: int) -> np.ndarray:
    """Two places in a filter of ``bits`` bits for each stretch of eight words (a row each)."""
    n = len(text_words) - RUN + 1
    if n < 1:
        return np.zeros((0, 2), np.int64)
    code = np.fromiter(map(_hash, text_words), np.uint64, len(text_words))
    mixed = np.zeros(n, np.uint64)
    for k, odd in enumerate(_ODD):
        mixed += code[k : k + n] * np.uint64(odd)
    mixed ^= mixed >> np.uint64(31)
    second = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return np.stack([mixed % np.uint64(bits), (second ^ second >> np.uint64(29)) % np.uint64(bits)], axis=1).astype(np.int64)


def stretch_filter(items: DataFrame, passage: str, bits: int) -> np.ndarray:
    """Bloom filter over the stretches of all items, packed; built on the executors in parts of
    PART_BITS, of which a task sends each at most once."""

    def parts(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(bits // 8, np.uint8)
        for frame in frames:
            for t in frame.iloc[:, 0]:
                at = stretch_places(words(t), bits).ravel()
                np.bitwise_or.at(own, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        step = PART_BITS // 8
        full = [k for k in range(0, len(own), step) if own[k : k + step].any()]
        yield pd.DataFrame({"part": [k // step for k in full], "bits": [own[k : k + step].tobytes() for k in full]})

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        every = reduce(np.bitwise_or, (np.frombuffer(b, np.uint8) for b in frame.bits))
        return pd.DataFrame({"part": [frame.part.iloc[0]], "bits": [every.tobytes()]})

    out = np.zeros(bits // 8, np.uint8)
    for r in items.select(passage).mapInPandas(parts, "part long, bits binary").groupBy("part").applyInPandas(merged, "part long, bits binary").toLocalIterator():
        at = r.part * PART_BITS // 8
        out[at : at + len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def _suspected(documents: DataFrame, packed: np.ndarray, doc_id: str, text: str, whole: bool) -> DataFrame:
    """doc_id, passages (word runs of which the filter rules out no stretch), held (all distinct
    words, if ``whole``) of the texts with such a run."""
    sent = documents.sparkSession.sparkContext.broadcast(packed)
    bits = len(packed) * 8

    def search(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        for frame in frames:
            out = []
            for d, t in zip(frame.iloc[:, 0], frame.iloc[:, 1]):
                own = words(t)
                at = stretch_places(own, bits)
                hit = ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                if len(edge):
                    out.append((d, [" ".join(own[a : b + RUN - 1]) for a, b in zip(edge[::2], edge[1::2])], " ".join(sorted(set(own))) if whole else ""))
            yield pd.DataFrame(out, columns=["d", "passages", "held"])

    return documents.select(doc_id, text).mapInPandas(search, f"d {documents.schema[doc_id].dataType.simpleString()}, passages array<string>, held string")


def _shard_of(items: DataFrame, columns: list[str], shard: int, shards: int) -> list:
    own = items.filter(F.pmod(F.xxhash64(columns[0]), F.lit(shards)) == shard) if shards > 1 else items
    return sorted(own.select(*columns).distinct().toLocalIterator(), key=repr)


def _search(documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, passage: str, parts: list[str]) -> DataFrame:
    """doc_id, item_id, stretches and, per further part of the items, the share of its distinct
    words that the text holds (null without any), all found in one pass over the texts."""
    shards = max(1, math.ceil(items.count() / SHARD))
    spark = documents.sparkSession
    names = [doc_id, item_id, "stretches", *[f"{p}_overlap" for p in parts]]
    kinds = f"`{doc_id}` {documents.schema[doc_id].dataType.simpleString()}, `{item_id}` {items.schema[item_id].dataType.simpleString()}, stretches long" + "".join(f", {p}_overlap double" for p in parts)

    def searched(texts: DataFrame, shard: int) -> tuple[DataFrame, Broadcast]:
        rows = _shard_of(items, [item_id, passage, *parts], shard, shards)
        index = ItemIndex([(r[0], words(r[1])) for r in rows])
        further = {r[0]: [frozenset(words(x)) for x in r[2:]] for r in rows}
        sent = spark.sparkContext.broadcast((index, further))

        def search(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index, further = sent.value
            for frame in frames:
                out = []
                for row in frame.itertuples(index=False, name=None):
                    runs = [words(row[1])] if shards == 1 else [p.split(" ") for p in row[1]]
                    leaks: dict[int, int] = {}
                    for run in runs:
                        for i, k in index.leaks(run).items():
                            leaks[i] = leaks.get(i, 0) + k
                    if leaks:
                        held = frozenset(runs[0] if shards == 1 else row[2].split(" ")) if parts else frozenset()
                        out += [(row[0], i, k, *(len(p & held) / len(p) if p else None for p in further[i])) for i, k in leaks.items()]
                yield pd.DataFrame(out, columns=names)

        return texts.mapInPandas(search, kinds), sent

    if shards == 1:
        found = searched(documents.select(doc_id, text), 0)[0]
    else:
        # About 100 stretches an item; a fuller filter only lets more passages through.
        bits = min(FILTER_BITS, max(PART_BITS, 1 << (shards * SHARD * 100 * STRETCH_BITS - 1).bit_length()))
        suspected = checkpoint(_suspected(documents, stretch_filter(items, passage, bits), doc_id, text, bool(parts)))
        done = []
        for shard in range(shards):  # one index at a time is held
            rows, sent = searched(suspected, shard)
            done.append(checkpoint(rows))
            sent.destroy()
        found = reduce(DataFrame.unionByName, done)
    return found.groupBy(doc_id, item_id).agg(*[F.max(n).alias(n) for n in names[2:]])


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """doc_id, item_id, stretches: every document and item such that the text holds at
    least eight consecutive words of the passage.

    The corpus is read once and never shuffled; only an index of about SHARD items at most, or
    the stretch filter, is sent to the executors.  Null and empty
    texts leak nothing; an item of fewer than eight words cannot leak; a repeated
    document gives one row.
    """
    return _search(documents, items, doc_id, text, item_id, passage, [])


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Leaks with the overlap of question and answer, and ``kind``: passage_only, with_answer
    (all words of the answer are there) or whole (most of the question, too)."""
    rated = _search(documents, items, "doc_id", "text", "item_id", "passage", ["question", "answer"])
    answered = F.coalesce(F.col("answer_overlap") == 1, F.lit(False))
    kind = F.when(answered & (F.col("question_overlap") >= 0.8), "whole").when(answered, "with_answer").otherwise("passage_only")
    return rated.withColumn("kind", kind)
