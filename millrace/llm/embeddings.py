"""Embedding near duplicates: Euclidean p-stable hashing of normalised vectors, then exact cosines.

Vectors are compared only with vectors of the same label and dimension. Equal vectors are one class from the
start, so copies cost nothing later. A class is hashed in several tables: in each, `k` Gaussian projections of the
normalised vector are shifted, cut into steps of a fixed width, and folded into one bucket number. Two vectors at
the distance of the wanted cosine share a table's bucket with a known probability; `k` grows with the number of
vectors so that strangers rarely meet, and the number of tables so that a pair right at the threshold is missed
with probability `miss` at most (closer pairs far less).

Vectors travel only to buckets that hold another class. A bucket with many is cut into blocks, and each pair of
blocks is one group, so no task holds more than two blocks. Inside, all pairs are checked by their cosine in double
precision; a pair counts in the first table in which it meets, so no pair counts twice and no pair is written out:
tasks answer with the number of links per class and with spanning edges, at most one per class.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with nothing, nor
does one whose label is null; it is its own component. Equal and repeated rows are vectors of their own that link
with each other; a null key counts as a vector but never names the component of others. Other columns are left
out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.operators.skew import join_unique
from millrace.session import store

COSINE = 0.98
MISS = 1e-5  # of pairs right at the threshold
WIDTH = 10.0  # step of a projection, in distances of the threshold
STRANGERS = 0.1  # vectors at right angles expected in a vector's bucket
BLOCK = 4096
SMALL = 64  # groups up to this size are compared together
PAIRS = 1 << 16
SEED = 11


def chance(ratio: float) -> float:
    """That two vectors fall into one step of a projection; ratio = step width / their distance."""
    below = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def tables_for(vectors: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(projections per table, tables) for so many vectors of one label."""
    near, far = chance(WIDTH), chance(WIDTH * math.sqrt(1 - cosine))
    k = max(1, math.ceil(math.log(max(vectors, 2) / STRANGERS) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log1p(-(near**k)))


@cache
def _projections(dim: int, k: int, tables: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim, k, tables])
    fold = rng.integers(0, 1 << 63, (tables, k), np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.standard_normal((dim, tables * k)) / width, rng.random(tables * k), fold


def bucket_numbers(unit: np.ndarray, k: int, tables: int, width: float) -> np.ndarray:
    """32-bit bucket numbers, one row per vector (of length one) and one column per table."""
    lines, shift, fold = _projections(unit.shape[1], k, tables, width)
    steps = np.floor(unit @ lines + shift).astype(np.int64).view(np.uint64).reshape(len(unit), tables, k)
    return ((steps * fold).sum(axis=2, dtype=np.uint64) >> np.uint64(32)).astype(np.uint32)


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    found = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    found /= np.abs(found).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return found / np.sqrt(np.einsum("ij,ij->i", found, found))[:, None]


# ---------------------------------------------------------------- inside tasks


def _usable(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """id, label and the vector's bytes; null where it cannot link."""
    for batch in batches:
        vectors = batch.column("vector")
        if len(vectors) == 0:
            continue
        flat = vectors.flatten()
        size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy().astype(np.int64)
        stop = np.cumsum(size)
        values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        some = np.concatenate([[0], np.cumsum(values != 0)])
        fine = (bad[stop] == bad[stop - size]) & (some[stop] > some[stop - size])
        packed = (np.where(np.isfinite(values), values, 0) + 0.0).astype(kind)  # -0 is 0
        raw, width = packed.tobytes(), packed.itemsize
        kept = [raw[(b - n) * width : b * width] if ok else None for b, n, ok in zip(stop.tolist(), size.tolist(), fine.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(kept, pa.binary())], ["id", "label", "vec"])


def _hashed(batches: Iterator[pa.RecordBatch], kind: str, k: int, tables: int, width: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [x.as_py() for x in batch.column("vec")]
        numbers = np.empty((len(raw), tables), np.uint32)
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        for n in np.unique(length):
            for some in np.array_split(np.flatnonzero(length == n), -(-len(raw) // 1024)):
                if len(some):
                    numbers[some] = bucket_numbers(_units([raw[i] for i in some], kind), k, tables, width)
        signs = pa.FixedSizeListArray.from_arrays(pa.array(numbers.view(np.int32).ravel()), tables).cast(pa.list_(pa.int32()))
        yield batch.append_column("buckets", signs)


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes, the smallest one that the links (a, b) reach."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := root[root], root):
            root = up


class _Found:
    """Links of one slice of rows: weight per class, spanning edges."""

    def __init__(self, cls: np.ndarray, size: np.ndarray, signs: np.ndarray, table: np.ndarray):
        self.names, self.at = np.unique(cls, return_inverse=True)
        self.size, self.signs, self.table = size, signs, table
        self.links, self.root = np.zeros(len(self.names), np.int64), np.arange(len(self.names))

    def add(self, p: np.ndarray, q: np.ndarray) -> None:
        """Row pairs that are near; those that met in an earlier table are counted there."""
        for t in range(int(self.table[p].max(initial=0))):
            new = (self.signs[p, t] != self.signs[q, t]) | (t >= self.table[p])
            p, q = p[new], q[new]
        a, b, n = self.at[p], self.at[q], len(self.names)
        self.links += np.bincount(a, self.size[q], n).astype(np.int64) + np.bincount(b, self.size[p], n).astype(np.int64)
        self.root = _spanning(np.concatenate([a, np.arange(n)]), np.concatenate([b, self.root]), n)

    def batch(self) -> pa.RecordBatch:
        some, hung = np.flatnonzero(self.links), np.flatnonzero(self.root != np.arange(len(self.names)))
        a = np.concatenate([self.names[some], self.names[hung]])
        b = pa.array(np.concatenate([self.names[some], self.names[self.root[hung]]]), mask=np.arange(len(a)) < len(some))
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate([self.links[some], 0 * hung]))], ["a", "b", "n"])


def _compared(columns: dict[str, np.ndarray], starts: np.ndarray, unit: np.ndarray, cosine: float) -> pa.RecordBatch:
    """All groups of a slice. Rows of one group stand together; `mine` tells the block, `one` and `two` those of the group."""
    found = _Found(columns["cls"], columns["size"], columns["signs"], columns["t"])
    count = np.diff(np.append(starts, len(unit)))
    small = starts[(count <= SMALL) & (columns["one"] == columns["two"])[starts]]
    for m in range(2, SMALL + 1):
        of_size = small[count[np.searchsorted(starts, small)] == m]
        i, j = np.triu_indices(m, 1)
        for some in np.array_split(of_size, max(1, -(-len(of_size) * len(i) // PAIRS))):
            p, q = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
            near = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
            if near.any():
                found.add(p[near], q[near])
    for lo, n in zip(starts.tolist(), count.tolist()):
        alone = columns["one"][lo] == columns["two"][lo]
        if alone and n <= SMALL:
            continue
        rows = np.arange(lo, lo + n)
        mine = columns["mine"][rows] == columns["one"][rows]
        left, right = rows if alone else rows[mine], rows if alone else rows[~mine]
        step = max(1, 8 * PAIRS // n)
        for at in range(0, len(left), step):
            part = left[at : at + step]
            p, q = np.nonzero(unit[part] @ unit[right].T >= cosine)
            p, q = part[p], right[q]
            found.add(*((p[p < q], q[p < q]) if alone else (p, q)))
    return found.batch()


GROUP = ["label", "width", "t", "bucket", "one", "two"]


def _pairs(batches: Iterator[pa.RecordBatch], kind: str, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group that a batch cuts is held back until it is whole."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        starts = _starts(rows)
        rest = rows.slice(int(starts[-1])).combine_chunks() if len(starts) else rows
        yield from _slice(rows.slice(0, int(starts[-1]) if len(starts) else 0), kind, cosine)
    if rest is not None:
        yield from _slice(rest, kind, cosine)


def _starts(rows: pa.Table) -> np.ndarray:
    if not len(rows):
        return np.zeros(0, np.int64)
    new = np.zeros(len(rows), bool)
    new[0] = True
    for name in GROUP:
        column = rows[name].combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _slice(rows: pa.Table, kind: str, cosine: float) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    edges = np.flatnonzero(np.diff(rows["width"].to_numpy())) + 1  # vectors of one length at a time
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)]):
        part = rows.slice(lo, hi - lo)
        columns = {c: part[c].to_numpy() for c in ("cls", "size", "t", "one", "two", "mine")}
        signs = part["buckets"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns["signs"] = signs.reshape(len(part), -1)
        yield _compared(columns, _starts(part), _units(part["vec"].to_pylist(), kind), cosine)


# ---------------------------------------------------------------- plan


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = COSINE, miss: float = MISS, block: int = BLOCK,
) -> DataFrame:
    """key, n_links (other vectors within the cosine), component_id (smallest key reachable), kept (the component's own)."""
    if not 0 < cosine < 1:
        raise ValueError("the cosine must lie between 0 and 1")
    kind = "<f4" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    types = {c: vectors.schema[c].dataType.simpleString() for c in (key, label)}
    given = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = given.mapInArrow(lambda b: _usable(b, kind), f"id {types[key]}, label {types[label]}, vec binary")
    rows = rows.withColumn("vec", F.when(F.col("label").isNotNull(), F.col("vec"))).withColumn("digest", F.unhex(F.sha2("vec", 256)))
    rows = store(rows, "vectors")
    classes = rows.where("vec is not null").groupBy("label", "digest").agg(
        F.any_value("vec").alias("vec"), F.min("id").alias("least"), F.count(F.lit(1)).alias("size")
    )
    classes = store(classes.withColumn("cls", F.monotonically_increasing_id()).withColumn("width", F.octet_length("vec")), "vector-classes")
    largest = classes.groupBy("label", "width").count().agg(F.max("count")).first()[0] or 0
    width = WIDTH * math.sqrt(2 - 2 * cosine)
    k, tables = tables_for(largest, cosine, miss)
    named = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    signed = store(classes.mapInArrow(lambda b: _hashed(b, kind, k, tables, width), f"{named}, buckets array<int>"), "vector-buckets")

    entries = signed.select("cls", "label", "width", F.posexplode("buckets").alias("t", "bucket"))
    place = ["label", "width", "t", "bucket"]
    shared = entries.groupBy(*place).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = entries.join(shared, place).select("cls", "t", "bucket", F.ceil(F.col("members") / F.lit(block)).cast("int").alias("blocks"))
    sent = met.join(signed.select("cls", "label", "width", "vec", "size", "buckets"), "cls")
    sent = sent.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.withColumns({"one": F.least("mine", "other"), "two": F.greatest("mine", "other")}).drop("other", "blocks")
    placed = sent.repartition(*GROUP).sortWithinPartitions(*GROUP, "cls")
    found = store(placed.mapInArrow(lambda b: _pairs(b, kind, cosine), "a long, b long, n long"), "vector-links")

    links = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnsRenamed({"node": "cls"})
    linked = store(classes.select("cls", "least").join(roots, "cls"), "linked-vectors")
    first = linked.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component"))
    linked = join_unique(linked.select("cls", "root"), first, {"root": "of"}).select("cls", "component")
    result = classes.select("cls", "label", "digest", "least", "size").join(links, "cls", "left").join(linked, "cls", "left").select(
        F.col("label").alias("of_label"), F.col("digest").alias("of_digest"),
        (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "least").alias("component"),
    )
    result = store(result, "vector-results")
    out = join_unique(rows.select("id", "label", "digest"), result, {"label": "of_label", "digest": "of_digest"})
    component = F.when(F.col("of_digest").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
