"""SimHash near duplicates: fingerprints, a binary trie self-join within a number of bits, components.

A fingerprint has 64 bits; bit i is set if more than half of the text's word shingles have it set in
their XXH64 (seed 42). The distinct fingerprints form a binary trie, which is joined with itself: node
pairs go down together, each level adds the bits in which their paths differ, and a pair is dropped
as soon as these exceed the budget. Of two fingerprints within D bits, one half of the bits differs in
at most D // 2. So there are two tries, one with the halves swapped, and in the upper 32 levels the
budget is D // 2, in the lower ones D; no pair within D bits is lost, and few others go deep.

The upper levels are walked by Spark: node pairs at a depth at which a node holds about CELL
fingerprints, found by equality with the paths that differ in the allowed number of bits; pairs
that are still too large go down four levels at a time by joins with the counted nodes. Pairs of small
subtrees are then joined one by one inside tasks, whatever the skew. Tasks answer with spanning
edges instead of all pairs, so a dense group costs as many edges as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.session import store

SHINGLE = 3
MAX_BITS = 3
BITS = 64
HALF = 32
SEED = 42
CELL = 16_384  # fingerprints in a subtree that one task walks
STEP = 4  # levels that a pair too large goes down at once
FINAL = 256  # node pairs with so many fingerprint pairs are compared outright
FRONTIER = 1 << 18  # node pairs expanded together
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# ---------------------------------------------------------------- fingerprints


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned. A text of fewer words is one shingle; a text without words (or null) has 0."""
    words = (text or "").encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k].tolist(), ends[k:].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    of_byte = hashes.view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(of_byte[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([fingerprint_of(t, shingle) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# ---------------------------------------------------------------- the walk inside a task


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at `depth` turns to one in each range [lo, hi) of a node."""
    bit = np.uint64(1 << (BITS - 1 - depth))
    upper = (keys[lo] & ~(bit - np.uint64(1))) | bit
    return np.clip(np.searchsorted(keys, upper), lo, hi)


class _Forest:
    """Union of indices, by pointing at the smallest one."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            i, j = i[a != b], j[a != b]
            a, b = a[a != b], b[a != b]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, errors: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the pairs within `max_bits` between two subtrees, or within one (b is None).

    Keys are sorted and distinct; all of `a`, and all of `b`, share their first `depth` bits.
    """
    keys = a if b is None else np.concatenate([a, b])
    left, right, base = a, a if b is None else b, 0 if b is None else len(a)
    forest = _Forest(len(keys))
    stack = [(depth, *(np.array([x]) for x in (0, len(left), 0, len(right), errors)))]
    while stack:
        level, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            cut = len(alo) // 2
            stack += [(level, *(x[:cut] for x in (alo, ahi, blo, bhi, err))), (level, *(x[cut:] for x in (alo, ahi, blo, bhi, err)))]
            continue
        small = ((ahi - alo) * (bhi - blo) <= FINAL) | (level == BITS)
        if small.any():
            lo, n, other, m = alo[small], (ahi - alo)[small], blo[small], (bhi - blo)[small]
            total = np.cumsum(n * m)
            for first in range(0, len(lo), FRONTIER // 4):
                part = slice(first, first + FRONTIER // 4)
                size = (n * m)[part]
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                wide = np.repeat(m[part], size)
                i = np.repeat(lo[part], size) + place // wide
                j = np.repeat(other[part], size) + place % wide
                near = np.bitwise_count(left[i] ^ right[j]) <= max_bits
                if b is None:
                    near &= i < j
                forest.join(i[near], j[near] + base)
            del total
        rest = ~small
        if not rest.any():
            continue
        alo, ahi, blo, bhi, err = (x[rest] for x in (alo, ahi, blo, bhi, err))
        amid, bmid = _split(left, alo, ahi, level), _split(right, blo, bhi, level)
        same = (alo == blo) & (b is None)  # a node with itself: its two children meet once
        most = max_bits // 2 if level + 1 <= HALF else max_bits
        children = [
            (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
            tuple(x[~same] for x in (amid, ahi, blo, bmid, err + 1)),
        ]
        parts = [np.concatenate(x) for x in zip(*children)]
        live = (parts[0] < parts[1]) & (parts[2] < parts[3]) & (parts[4] <= most)
        if live.any():
            stack.append((level + 1, *(x[live] for x in parts)))
    linked = np.flatnonzero(forest.root != np.arange(len(keys)))
    return keys[linked], keys[forest.root[linked]]


# ---------------------------------------------------------------- the walk between nodes


def _swap(value: Column) -> Column:
    """The two halves of a fingerprint exchanged; its own inverse."""
    return F.shiftleft(value, HALF).bitwiseOR(F.shiftrightunsigned(value, HALF))


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, BITS - depth) if depth else F.lit(0).cast("long")


def _nodes(keys: DataFrame, depth: int) -> DataFrame:
    return keys.groupBy("trie", _prefix(F.col("key"), depth).alias("node")).agg(F.count("*").alias("n"))


def _budget(depth: int, max_bits: int) -> int:
    return max_bits // 2 if depth <= HALF else max_bits


def _leaf_pairs(keys: DataFrame, count: int, max_bits: int, cell: int) -> list[tuple[int, DataFrame]]:
    """Node pairs small enough for a task, by depth: columns trie, a, b, err (a <= b)."""
    depth = min(max(0, math.ceil(math.log2(max(count, 1) / cell))), HALF)
    nodes = store(_nodes(keys, depth), "trie-nodes")
    flips = [sum(1 << i for i in some) for k in range(_budget(depth, max_bits) + 1) for some in combinations(range(depth), k)]
    near = nodes.select("trie", F.col("node").alias("a"), F.col("n").alias("na"), F.explode(F.array(*map(F.lit, flips))).alias("flip"))
    near = near.withColumn("b", F.col("a").bitwiseXOR(F.col("flip").cast("long"))).where("a <= b")
    other = nodes.select("trie", F.col("node").alias("b"), F.col("n").alias("nb"))
    pairs = near.join(other, ["trie", "b"]).select("trie", "a", "b", F.bit_count("flip").alias("err"), "na", "nb")
    leaves = []
    while True:
        pairs = store(pairs, "node-pairs")
        large = F.greatest("na", "nb") > 4 * cell if depth < BITS else F.lit(False)
        leaves.append((depth, pairs.where(~large).select("trie", "a", "b", "err")))
        if pairs.where(large).isEmpty():
            return leaves
        down = min(STEP, BITS - depth)
        depth += down
        nodes = _nodes(keys, depth).withColumn("up", F.shiftrightunsigned("node", down))
        one = nodes.select("trie", F.col("up").alias("a"), F.col("node").alias("ca"), F.col("n").alias("ma"))
        two = nodes.select("trie", F.col("up").alias("b"), F.col("node").alias("cb"), F.col("n").alias("mb"))
        pairs = pairs.where(large).join(one, ["trie", "a"]).join(two, ["trie", "b"]).where("a < b or ca <= cb")
        mask = F.lit((1 << down) - 1)
        more = F.bit_count(F.col("ca").bitwiseAND(mask).bitwiseXOR(F.col("cb").bitwiseAND(mask)))
        pairs = pairs.select("trie", F.col("ca").alias("a"), F.col("cb").alias("b"), (F.col("err") + more).alias("err"),
                             F.col("ma").alias("na"), F.col("mb").alias("nb")).where(F.col("err") <= _budget(depth, max_bits))


def near_edges(fingerprints: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within `max_bits` of each other. One column of longs, distinct."""
    name = fingerprints.columns[0]
    both = F.array(F.struct(F.lit(0).alias("trie"), F.col(name).alias("key")), F.struct(F.lit(1).alias("trie"), _swap(F.col(name)).alias("key")))
    keys = fingerprints.select(F.explode(both).alias("x")).select("x.*")
    found = []
    for depth, pairs in _leaf_pairs(keys, fingerprints.count(), max_bits, cell):
        cells = keys.groupBy("trie", _prefix(F.col("key"), depth).alias("node"))
        used = pairs.select("trie", F.col("a").alias("node")).union(pairs.select("trie", F.col("b").alias("node"))).distinct()
        small = keys.withColumn("node", _prefix(F.col("key"), depth)).join(used, ["trie", "node"], "left_semi")
        cells = store(small.groupBy("trie", "node").agg(F.sort_array(F.collect_list("key")).alias("keys")), "trie-cells")
        one = cells.select("trie", F.col("node").alias("a"), F.col("keys").alias("left"))
        two = cells.select("trie", F.col("node").alias("b"), F.col("keys").alias("right"))
        within = pairs.where("a = b").join(one, ["trie", "a"]).withColumn("right", F.array().cast("array<long>"))
        across = pairs.where("a < b").join(one, ["trie", "a"]).join(two, ["trie", "b"])
        tasks = within.unionByName(across)

        def join(batches: Iterator[pd.DataFrame], depth: int = depth) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for x in batch.itertuples():
                    left = np.sort(np.asarray(x.left, np.int64).view(np.uint64))
                    right = np.sort(np.asarray(x.right, np.int64).view(np.uint64)) if x.a != x.b else None
                    ends = walk(left, right, depth, x.err, max_bits)
                    if x.trie:
                        ends = [(e << np.uint64(HALF)) | (e >> np.uint64(HALF)) for e in ends]
                    yield pd.DataFrame({"a": ends[0].view(np.int64), "b": ends[1].view(np.int64)})

        found.append(tasks.repartition(tasks.sparkSession.sparkContext.defaultParallelism * 4).mapInPandas(join, "a long, b long"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def groups(rows: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """(fingerprint, component) of each distinct fingerprint of `rows` (fingerprint, id).

    The component is the smallest id that links within `max_bits` reach, ids of equal fingerprints
    included. Null ids are passed over (a component of nothing else is null); so are null fingerprints.
    """
    first = rows.where("fingerprint is not null").groupBy("fingerprint").agg(F.min("id").alias("first"))
    first = store(first, "fingerprints")
    roots = components(near_edges(first.select("fingerprint"), max_bits, cell))
    linked = store(first.join(roots, first.fingerprint == roots.node).select("fingerprint", "first", "root"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    linked = linked.join(least, "root").select("fingerprint", "component")
    alone = first.join(linked, "fingerprint", "left_anti").select("fingerprint", F.col("first").alias("component"))
    return store(linked.unionByName(alone), "components")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows come back
    as often as they are given; a null key keeps its row and never names a component of others.
    """
    rows = docs.select(F.col(key).alias("id"), fingerprint(F.col(text), shingle).alias("fingerprint"))
    rows = store(rows, "document-fingerprints")
    found = rows.join(groups(rows, max_bits), "fingerprint", "left")
    return found.select(F.col("id").alias(key), as_hex(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id"))


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows, one of each group of near duplicates: that with the smallest key (nulls last), and of equal rows any one.

    All columns, whatever their names, come back unchanged.
    """
    rows = docs.select(F.struct("*").alias("doc"), fingerprint(F.col(text), shingle).alias("fingerprint"))
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "fingerprinted-rows")
    place = F.struct(F.col(f"doc.{key}").isNull().alias("none"), F.col(f"doc.{key}").alias("key"), "row")
    best = groups(rows.select("fingerprint", place.alias("id")), max_bits).select(F.col("component.row").alias("row")).distinct()
    return rows.join(best, "row", "left_semi").select("doc.*")
