"""Benchmark decontamination: find the windows of documents that are copies of benchmark items.

A window has as many words as the item. Its fingerprint is the SimHash of its word shingles; a
multi-index of the items' fingerprints, one sorted list per block of bits, gives every item within
RADIUS bits: of BLOCKS blocks one at least differs in RADIUS // BLOCKS bits or fewer, and all such
values of each block are looked up. What it gives is verified by exact weighted-shingle similarity,
the sum of the smaller counts over the sum of the larger ones.

Windows are fingerprinted only where they can succeed: two windows of m shingles with similarity t share
at least 2tm / (1 + t) of them, so a running count of the shingles that any item has leaves out the rest
without loss. RADIUS lies far above the bits that a similarity of 0.8 flips (10 expected, deviation 3).

Scale: items are the stated query set. They are collected and broadcast in blocks of at most ITEM_BYTES of
text; documents are never shuffled, only found pairs are, to keep the best window of each.

Words are runs of characters other than white space and ASCII punctuation, lower-cased.

Defined results: null or empty texts and items match nothing; an item with fewer words than a shingle is
one shingle, so it must occur whole; equal items are found each by itself; among equally similar windows
the first counts; repeated documents give repeated rows; null keys are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS, BLOCK_BITS = 4, 16
ITEM_BYTES = 32 << 20
#: ASCII punctuation and white space to spaces; all other bytes stay.
_SIGNS = bytes(b if chr(b).isalnum() or b < 9 or 13 < b < 32 or b > 126 else 32 for b in range(256))
_MASKS = np.array([sum(1 << b for b in some) for k in range(RADIUS // BLOCKS + 1) for some in combinations(range(BLOCK_BITS), k)], np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SIGNS).split()


def shingles_of(words: list[bytes]) -> list[bytes]:
    k = min(SHINGLE, len(words))
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """SimHash of shingle hashes, repeats included."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
    return np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0]


def _hash(shingles: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s) for s in shingles], np.uint64)


def similarity(one: Counter, other: Counter) -> float:
    common = sum((one & other).values())
    return common / (one.total() + other.total() - common)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values are in a sorted array."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class MultiIndex:
    """Fingerprints by the value of each block of their bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = []
        for b in range(BLOCKS):
            value = (prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
            order = np.argsort(value, kind="stable")
            self.blocks.append((value[order], order))

    def within(self, wanted: np.uint64) -> np.ndarray:
        """Positions of all fingerprints within RADIUS bits of this one."""
        found = [np.zeros(0, np.int64)]
        for b, (values, order) in enumerate(self.blocks):
            near = _MASKS ^ ((wanted >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1))
            lo, hi = np.searchsorted(values, near, "left"), np.searchsorted(values, near, "right")
            for a, z in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                found.append(order[a:z])
        some = np.unique(np.concatenate(found))
        return some[np.bitwise_count(self.prints[some] ^ wanted) <= RADIUS]


@dataclass
class Sized:
    """Items of one size in words."""

    ids: list
    counts: list[Counter]
    index: MultiIndex


class Items:
    """A block of the benchmark, ready to search documents with."""

    def __init__(self, rows: list[tuple], threshold: float):
        self.threshold = threshold
        by_size: dict[int, list] = {}
        self.codes: dict[bytes, int] = {}
        for key, text in rows:
            words = words_of(text)
            if words:
                by_size.setdefault(len(words), []).append((key, shingles_of(words)))
                for w in words:
                    self.codes.setdefault(w, len(self.codes) + 1)
        self.sizes = {
            n: Sized([k for k, _ in some], [Counter(s) for _, s in some], MultiIndex(np.array([fingerprint(_hash(s)) for _, s in some], np.uint64)))
            for n, some in by_size.items()
        }
        self.known: dict[int, np.ndarray] = {}  # by words in a shingle: codes of the items' shingles
        self.own: dict[int, np.ndarray] = {}  # the same by words in an item
        for n, some in by_size.items():
            k = min(SHINGLE, n)
            mine = [self._grams(self._code(s.split()), k) for _, shingles in some for s in shingles]
            self.own[n] = np.unique(np.concatenate(mine))
            self.known[k] = np.union1d(self.known.get(k, np.zeros(0, np.uint64)), self.own[n])
        self.least = min((self._needed(n) for n in self.sizes), default=0)

    def _code(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.codes.get, words, repeat(0)), np.uint64, len(words))

    @staticmethod
    def _grams(codes: np.ndarray, k: int) -> np.ndarray:
        """A number for each run of k words; zero if one of them is in no item."""
        n = len(codes) - k + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        gram, all_known = np.zeros(n, np.uint64), np.ones(n, bool)
        for i in range(k):
            part = codes[i : i + n]
            gram = (gram ^ part) * np.uint64(0x9E3779B97F4A7C15)
            gram ^= gram >> np.uint64(32)
            all_known &= part > 0
        return np.where(all_known, gram | np.uint64(1), np.uint64(0))

    def _needed(self, n: int) -> int:
        shingles = n - min(SHINGLE, n) + 1
        return math.ceil(2 * self.threshold / (1 + self.threshold) * shingles - 1e-9)

    def search(self, text: str | None) -> list[tuple]:
        """(item, similarity, first word, words) of the best window for each item that the text holds."""
        words = words_of(text)
        if not words or not self.sizes:
            return []
        codes = self._code(words)
        if np.count_nonzero(codes) < self.least:
            return []
        hits = {}  # by words in a shingle: places of the items' shingles, and which
        for k, known in self.known.items():
            grams = self._grams(codes, k)
            some = np.flatnonzero(grams)
            some = some[_among(grams[some], known)]
            hits[k] = some, grams[some], len(grams)
        best: dict[object, tuple] = {}
        for n, sized in self.sizes.items():
            k, needed = min(SHINGLE, n), self._needed(n)
            places, grams, total = hits[k]
            m = n - k + 1
            if len(places) < needed or total < m:
                continue
            places = places[_among(grams, self.own[n])]
            if len(places) < needed:
                continue
            starts = np.arange(max(0, places[0] - m + 1), min(places[-1], total - m) + 1)
            enough = np.searchsorted(places, starts + m) - np.searchsorted(places, starts) >= needed
            for at in starts[enough].tolist():
                own = shingles_of(words[at : at + n])
                for i in sized.index.within(fingerprint(_hash(own))).tolist():
                    score = similarity(Counter(own), sized.counts[i])
                    if score >= self.threshold and score > best.get((i, n), (None, 0.0))[1]:
                        best[i, n] = (sized.ids[i], score, at, n)
        return list(best.values())


def _in_blocks(items: DataFrame, item: str, text: str, threshold: float, item_bytes: int) -> Iterator[Broadcast]:
    """The items, broadcast in blocks of about `item_bytes` of text, dealt by hash."""
    given = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / item_bytes))
    for block in range(blocks):
        own = given.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield items.sparkSession.sparkContext.broadcast(Items([tuple(r) for r in own.collect()], threshold))


def find_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    threshold: float = SIMILARITY, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """doc_id, item_id, similarity, start (word), n_words: the best window of each item in each document."""
    kind, of = docs.schema[key].dataType, items.schema[item].dataType
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def pairs(held: Broadcast) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(i, held.value.search(t.as_py())) for i, t in enumerate(batch.column("text"))]
                at = [i for i, some in found for _ in some]
                columns = list(zip(*(x for _, some in found for x in some))) or [[]] * 4
                kinds = [from_arrow, pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["id", "item", "similarity", "start", "n_words"],
                )

        from_arrow = to_arrow_type(of)
        return rows.mapInArrow(search, f"id {kind.simpleString()}, item {of.simpleString()}, similarity double, start long, n_words long")

    found = reduce(DataFrame.unionByName, map(pairs, _in_blocks(items, item, item_text, threshold, item_bytes)))
    return found.select(F.col("id").alias(key), F.col("item").alias(item), "similarity", "start", "n_words")


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    threshold: float = SIMILARITY, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The rows that hold no item, unchanged, all columns; one narrow pass, nothing is shuffled."""

    def clean(held: Broadcast):
        @F.pandas_udf("boolean")
        def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([not held.value.search(t) for t in texts], dtype=bool)

        return test

    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    for held in _in_blocks(items, item, item_text, threshold, item_bytes):
        rows = rows.where(clean(held)(F.col("text")))
    return rows.select("doc.*")
