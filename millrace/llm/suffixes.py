"""Removal of byte strings of a fixed length that start more than once in the corpus.

Exact, and in four steps, so that suffix arrays are built only where they can find something:

1. Anchors. Of every window of LENGTH - GRAM + 1 byte GRAMs, the one with the smallest hash is
   an anchor (about one byte in 85) and owns the string. Equal strings have the same gram as owner at the
   same place, so only grams that are anchors twice matter: a count by gram, then a semi-join.
2. Surroundings. The strings that an anchor owns lie next to each other around it. Equal surroundings
   are counted, not kept one by one; a gram whose surroundings are all equal is settled.
3. Shards. The distinct surroundings of the other grams go to shards of about SHARD_BYTES. A shard
   builds its suffix array by Larsson-Sadakane refinement (only groups not yet told apart are sorted
   again, by the rank twice as far on), takes common prefixes by Kasai's algorithm along all
   surroundings at once, and so finds the strings that occur twice. A gram with more surroundings
   than a shard holds is dealt over several; these publish the sorted digests of their strings, cut
   into ranges, and each range is merged by binary search.
4. Spans are put together by text and cut out.

Two places are told apart by row and offset, so overlapping matches count and no string matches itself.
Surroundings and texts are told apart by 128 bits of hash; strings within a shard byte by byte.

Defined results: a null or empty text has no bytes and nothing removed; texts shorter than LENGTH stay
whole; a repeated row is a copy like any other, and all of a text that occurs twice goes if it has
LENGTH bytes; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.urls import bloom_blocks, may_be_listed
from millrace.session import store

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1 << 20
SLICE_BYTES = 1 << 20
_TOP = np.uint64(2**64 - 1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


# ---------------------------------------------------------------- anchors


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each position (a power of two), by doubling."""
    h, size = (text.astype(np.uint64) + np.uint64(1)) * _MIX[0], 1
    for step in range(int(math.log2(GRAM))):
        h = h[:-size] * _MIX[step % 5] + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    return (h * _MIX[1]) ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, take: np.ufunc, fill: int) -> np.ndarray:
    """take over values[i : i + width] at each i, by running results within blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width + width, fill, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = take.accumulate(blocks, axis=1).ravel()
    back = np.ascontiguousarray(take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return take(back[:n], ahead[width - 1 : n + width - 1])


def anchors_of(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, offset, gram hash, first, last) of the anchors of some texts.

    An anchor owns the strings of `length` bytes that start from `first` to `last`: those in which it is the
    smallest gram, the leftmost of equals. Each string of a text has one owner.
    """
    width = length - GRAM + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes) - sizes
    whole = np.frombuffer(b"".join(texts), np.uint8)
    long = np.flatnonzero(sizes >= length)
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none.astype(np.uint64), none, none
    grams = _gram_hashes(whole)
    usable = np.zeros(len(whole) + 1, np.int8)  # strings that lie within one text
    np.add.at(usable, first[long], 1)
    np.add.at(usable, first[long] + sizes[long] - length + 1, -1)
    usable = np.cumsum(usable[:-1], dtype=np.int8)[: len(grams)].astype(bool)
    least = _sliding(grams, width, np.minimum, int(_TOP))
    # Runs of strings with the same smallest value, within a text; then the leftmost gram that has it.
    new = np.ones(len(grams), bool)
    new[1:] = (least[1:] != least[:-1]) | (usable[1:] != usable[:-1])
    new[first[long]] = True
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(grams)) - 1
    heads, tails = heads[usable[heads]], tails[usable[heads]]
    found = []
    while len(heads):
        value, at = least[heads], heads.copy()
        far = np.flatnonzero(grams[at] != value)
        step = np.zeros(len(at), np.int64)
        while len(far):
            step[far] += 1
            far = far[grams[at[far] + step[far]] != value[far]]
        at += step
        last = np.minimum(tails, at)
        found.append(np.stack([at, heads, last]))
        more = tails > at  # an equal gram further right owns the rest
        heads, tails = at[more] + 1, tails[more]
    at, head, tail = np.concatenate(found, axis=1)
    by = np.argsort(head)
    at, head, tail = at[by], head[by], tail[by]
    which = np.searchsorted(first, head, "right") - 1  # of texts that begin at one place, the last is not empty
    return which, at - first[which], grams[at], head - first[which], tail - first[which]


def _anchor_table(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Per text: its keys, row, size, and lists of grams, surroundings (hash), starts and ends."""
    for batch in batches:
        texts, held, from_row = [], 0, 0
        column = batch.column("text")
        for i in range(len(batch)):
            texts.append((column[i].as_py() or "").encode())
            held += len(texts[-1])
            if held >= SLICE_BYTES or i == len(batch) - 1:
                yield _anchor_batch(batch.slice(from_row, len(texts)), texts, length)
                texts, held, from_row = [], 0, i + 1


def _anchor_batch(batch: pa.RecordBatch, texts: list[bytes], length: int) -> pa.RecordBatch:
    which, at, grams, start, last = anchors_of(texts, length)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = last + length
    digest = xxhash.xxh3_64_intdigest
    around = np.array(
        [digest(texts[w][a:b], p - a) for w, p, a, b in zip(which.tolist(), at.tolist(), start.tolist(), stop.tolist())], np.uint64
    ).view(np.int64)
    cuts = pa.array(np.searchsorted(which, np.arange(len(texts) + 1)).astype(np.int32))
    lists = [
        pa.ListArray.from_arrays(cuts, pa.array(x))
        for x in (grams.view(np.int64), around, start.astype(np.int32), stop.astype(np.int32))
    ]
    columns = [batch.column("key1"), batch.column("key2"), pa.array(sizes), *lists]
    return pa.RecordBatch.from_arrays(columns, ["key1", "key2", "n_bytes", "grams", "around", "starts", "stops"])


# ---------------------------------------------------------------- suffix arrays


def _words(rows: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position of each row, first byte highest; zeros beyond the row."""
    wide = np.zeros((rows.shape[0], rows.shape[1] + 8), np.uint64)
    wide[:, : rows.shape[1]] = rows
    for size in (1, 2, 4):
        wide[:, :-size] = (wide[:, :-size] << np.uint64(8 * size)) | wide[:, size:]
        wide[:, -size:] <<= np.uint64(8 * size)
    return wide[:, :-8]


def suffix_array(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, words): all bytes of the rows by their places, sorted by group of the row and the bytes from there to its end.

    Equal ones are in the order of their places, as Kasai's algorithm needs it. Suffixes that end within the
    bytes compared so far are equal for good and are not sorted again.
    """
    n, width = rows.shape
    total = n * width
    words = _words(rows)
    left = np.maximum(np.repeat(sizes.astype(np.int32), width) - np.tile(np.arange(width, dtype=np.int32), n), 0)
    real = np.flatnonzero(left)  # rows are padded to one width
    some = words.ravel()[real]
    order = np.argsort(some)
    value = np.empty(len(real), np.int64)  # number of the word among the words
    value[order] = np.cumsum(np.append(False, some[order[1:]] != some[order[:-1]]))
    key = ((group.astype(np.int64) * total)[real // width] + value) * 9 + np.minimum(left[real], 8)
    by = np.argsort(key)
    order, key = real[by], key[by]
    new = np.append(True, key[1:] != key[:-1])
    rank = np.zeros(total, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(real)), 0))  # a group's rank is its first place
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of two or more
    equal, step = [], 8
    while len(slots) and step < width:
        items = order[slots]
        more = left[items] >= step
        equal.append(slots[~more])
        slots, items = slots[more], items[more]
        far = np.where(left[items] > step, rank[np.minimum(items + step, total - 1)] + 1, 0)
        key = rank[items] * (total + 1) + far
        by = np.argsort(key)
        items, key = items[by], key[by]
        order[slots] = items
        head = np.append(True, key[1:] != key[:-1])[: len(slots)]
        rank[items] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[~(head & np.append(head[1:], True)[: len(slots)])]
        step *= 2
    slots = np.concatenate([*equal, slots])
    slots.sort()
    order[slots] = order[slots][np.argsort(rank[order[slots]] * total + order[slots])]
    return order, words


def _equal_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of words (8 of a zero)."""
    high = x >> np.uint64(32)
    part = np.where(high > 0, high, x & np.uint64(0xFFFFFFFF))
    return np.where(high > 0, 0, 4) + (32 - np.frexp(part.astype(np.float64))[1]) // 8


def common_prefixes(
    order: np.ndarray, words: np.ndarray, sizes: np.ndarray, group: np.ndarray, limit: int, starts: np.ndarray
) -> np.ndarray:
    """Bytes that a position shares with the one before it in the array, up to `limit`, for the first `starts` of each row.

    Kasai's algorithm, on all rows at once.
    """
    n, width = words.shape
    before = np.empty(n * width, np.int64)
    before[order[1:]], before[order[0]] = order[:-1], -1
    shared = np.zeros((n, width), np.int64)
    have = np.zeros(n, np.int64)
    flat = words.ravel()
    everyone = np.arange(n)
    for j in range(max(0, starts.max())):
        row = everyone[starts > j]
        here = row * width + j
        other = before[here]
        have = np.maximum(have - 1, 0)
        ok = (other >= 0) & (group[row] == group[np.maximum(other, 0) // width])
        have[row[~ok]] = 0
        row, here, other = row[ok], here[ok], other[ok]
        room = np.clip(np.minimum(sizes[row] - j, sizes[other // width] - other % width), 0, limit)
        have[row] = np.minimum(have[row], room)
        live = np.arange(len(row))
        while len(live):
            more = have[row[live]]
            live, more = live[more < room[live]], more[more < room[live]]
            same = _equal_bytes(flat[here[live] + more] ^ flat[other[live] + more])
            have[row[live]] = np.minimum(more + same, room[live])
            live = live[same == 8]
        shared[row, j] = have[row]
    return shared.ravel()


class Shard:
    """The strings of `length` bytes in some surroundings, and which of them start in two places."""

    def __init__(self, pdf: pd.DataFrame, length: int):
        self.pdf, self.length = pdf, length
        sizes = pdf["text"].map(len).to_numpy()
        rows = np.zeros((len(pdf), sizes.max()), np.uint8)
        for i, text in enumerate(pdf["text"]):
            rows[i, : len(text)] = np.frombuffer(text, np.uint8)
        group = np.unique(pdf["gram"].to_numpy(), return_inverse=True)[1]
        order, words = suffix_array(rows, sizes, group)
        shared = common_prefixes(order, words, sizes, group, length, sizes - length + 1)
        self.width = rows.shape[1]
        full = order[(order % self.width) <= sizes[order // self.width] - length]  # that hold a whole string
        self.row, self.at = full // self.width, full % self.width
        head = shared[full] < length
        head[:1] = True
        self.heads = np.flatnonzero(head)
        self.member = np.cumsum(head) - 1  # which string
        place = np.unique(pdf["row"].to_numpy(), return_inverse=True)[1][self.row] << 40 | (pdf["start"].to_numpy()[self.row] + self.at)
        often = (pdf["n"].to_numpy() > 1)[self.row]
        if len(full):
            twice = np.minimum.reduceat(place, self.heads) != np.maximum.reduceat(place, self.heads)
            self.twice = twice | np.logical_or.reduceat(often, self.heads)
        else:
            self.twice = np.zeros(0, bool)

    def spans(self, strings: np.ndarray) -> pd.DataFrame:
        """Covered bytes of each of the surroundings, relative to their start, for the strings marked True."""
        hit = strings[self.member] if len(self.member) else np.zeros(0, bool)
        row, at = self.row[hit], self.at[hit]
        by = np.lexsort((at, row))
        row, at = row[by], at[by]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + self.length)
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(row))[: len(starts)] - 1
        own = self.pdf.iloc[row[starts]]
        return pd.DataFrame({
            "gram": own["gram"].to_numpy(), "around": own["around"].to_numpy(), "lo": at[starts].astype(np.int32),
            "hi": (at[ends] + self.length).astype(np.int32),
        })

    def runs(self, ranges: int) -> pd.DataFrame:
        """For other shards of the same gram: sorted digests of the strings, cut into ranges, with one place of each."""
        out = []
        for gram in np.unique(self.pdf["gram"].to_numpy()):
            own = np.flatnonzero(self.pdf["gram"].to_numpy()[self.row[self.heads]] == gram)
            some = self.heads[own]
            texts, rows, ats = self.pdf["text"].to_numpy(), self.row[some], self.at[some]
            digests = np.array([xxhash.xxh3_64_intdigest(texts[r][a : a + self.length]) for r, a in zip(rows, ats)], np.uint64)
            by = np.argsort(digests)
            cuts = np.searchsorted(digests[by], [np.uint64(i * (2**64 // ranges)) for i in range(ranges)] + [_TOP])
            cuts[-1] = len(by)
            for i in range(ranges):
                part = by[cuts[i] : cuts[i + 1]]
                if len(part):
                    own_rows = self.pdf.iloc[rows[part]]
                    out.append({
                        "gram": gram, "range": i, "digests": digests[part].tobytes(),
                        "rows": own_rows["row"].to_numpy(np.int64).tobytes(),
                        "places": (own_rows["start"].to_numpy(np.int64) + ats[part]).tobytes(), "twice": self.twice[own][part].tobytes(),
                    })
        return pd.DataFrame(out, columns=["gram", "range", "digests", "rows", "places", "twice"])


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Digests of strings that start in two places, over sorted runs (digests, rows, places, twice)."""
    found = [r[0][r[3]] for r in runs]
    for i, (digests, rows, places, _) in enumerate(runs):
        for other, rows2, places2, _ in runs[i + 1 :]:
            at = np.searchsorted(other, digests)
            near = np.minimum(at, len(other) - 1)
            same = (other[near] == digests) & ((rows2[near] != rows) | (places2[near] != places))
            found.append(digests[same])
    return np.unique(np.concatenate(found))


# ---------------------------------------------------------------- the job


SPANS = "gram long, around long, lo int, hi int"


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key1"), F.xxhash64(F.lit(1), text).alias("key2")]


def _settled_and_open(anchors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(anchors of repeated grams, settled surroundings, surroundings that need a shard)."""
    counts = anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("again"))
    counts = store(counts, "repeated-grams")  # so AQE can split the anchors of a frequent gram
    repeated = store(anchors.join(counts, F.col("gram") == F.col("again"), "left_semi"), "repeated-anchors")
    variants = repeated.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(F.struct("row", "start", "stop")).alias("one"))
    variants = store(variants, "surroundings")
    by_gram = variants.groupBy(F.col("gram").alias("of")).agg(F.count("*").alias("variants"))
    variants = variants.join(by_gram, F.col("gram") == F.col("of")).drop("of")
    settled = variants.where("variants = 1").select("gram", "around", F.lit(0).alias("lo"), (F.col("one.stop") - F.col("one.start")).alias("hi"))
    return repeated, settled, variants.where("variants > 1").select("gram", "around", "n", "variants", "one.*")


def _with_bytes(docs: DataFrame, wanted: DataFrame, text_keys: DataFrame) -> DataFrame:
    """The bytes of the surroundings, read from the texts they lie in; other texts are left out before the shuffle."""
    wanted = wanted.join(text_keys, "row")
    lists = wanted.groupBy("key1", "key2").agg(F.collect_list(F.struct("gram", "around", "n", "variants", "row", "start", "stop")).alias("wanted"))
    lists = store(lists, "wanted-surroundings")
    table = bloom_blocks(lists.select("key1"), "key1")
    texts = docs.select(*_keys(F.col("text")), "text")
    texts = texts.where(may_be_listed(texts, "key1", table)).join(lists, ["key1", "key2"])

    names = ["gram", "around", "n", "variants", "row", "start"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            mine = []
            for i, k in enumerate(zip(batch.column("key1").to_pylist(), batch.column("key2").to_pylist())):
                if k not in met:  # of the copies of a text in one task only the first is cut
                    met.add(k)
                    mine.append(i)
            batch = batch.take(pa.array(mine, pa.int64()))
            lists = batch.column("wanted")
            some = lists.flatten()
            columns = {n: some.field(n) for n in (*names, "stop")}
            of = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            raw = [t.as_py().encode() for t in batch.column("text")]
            parts = [raw[i][a:z] for i, a, z in zip(of.tolist(), columns["start"].to_pylist(), columns["stop"].to_pylist())]
            for at in range(0, len(parts), 10_000):
                cut_ = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays([*(columns[n][cut_] for n in names), pa.array(parts[cut_], pa.binary())], [*names, "text"])

    return texts.select("key1", "key2", "text", "wanted").mapInArrow(
        cut, "gram long, around long, n long, variants long, row long, start int, text binary"
    )


def _in_shards(windows: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Spans of the surroundings of grams with several."""
    each = 2 * length - GRAM
    total = windows.count() * each
    shards = max(1, math.ceil(total / shard_bytes))
    parts = F.ceil(F.col("variants") * each / shard_bytes).cast("int")
    dealt = windows.withColumns({
        "parts": parts, "part": F.when(parts > 1, F.pmod("around", parts)).otherwise(0),
        "shard": F.when(parts > 1, F.lit(-1)).otherwise(F.pmod("gram", F.lit(shards))),
    }).withColumn("own", F.when(F.col("parts") > 1, F.col("gram")).otherwise(F.lit(0)))
    near = dealt.where("parts = 1").groupBy("shard")
    far = store(dealt.where("parts > 1"), "split-grams")

    def alone(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(pdf, length)
        return shard.spans(shard.twice)

    spans = near.applyInPandas(alone, SPANS)
    if far.isEmpty():
        return spans

    def publish(pdf: pd.DataFrame) -> pd.DataFrame:
        return Shard(pdf, length).runs(int(pdf["parts"].iloc[0]))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [
            (np.frombuffer(x.digests, np.uint64), np.frombuffer(x.rows, np.int64), np.frombuffer(x.places, np.int64), np.frombuffer(x.twice, bool))
            for x in pdf.itertuples()
        ]
        return pd.DataFrame({"gram": pdf["gram"].iloc[0], "digests": [merge_runs(runs).tobytes()]})

    def answer(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"gram": [], "around": [], "lo": [], "hi": []})
        shard = Shard(left, length)
        twice = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in right["digests"]] or [np.zeros(0, np.uint64)]))
        texts, rows, ats = left["text"].to_numpy(), shard.row[shard.heads], shard.at[shard.heads]
        digests = np.array([xxhash.xxh3_64_intdigest(texts[r][a : a + length]) for r, a in zip(rows, ats)], np.uint64)
        at = np.minimum(np.searchsorted(twice, digests), max(len(twice) - 1, 0))
        return shard.spans(shard.twice | (twice[at] == digests if len(twice) else False))

    runs = far.groupBy("gram", "part").applyInPandas(publish, "gram long, range int, digests binary, rows binary, places binary, twice binary")
    again = runs.groupBy("gram", "range").applyInPandas(merge, "gram long, digests binary")
    places = far.select(F.col("gram").alias("of"), F.col("part").alias("to")).distinct()
    again = again.join(places, F.col("gram") == F.col("of")).select("of", "to", "digests")
    split = far.groupBy("gram", "part").cogroup(again.groupBy("of", "to")).applyInPandas(answer, SPANS)
    return spans.unionByName(split)


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(key1, key2, spans): the bytes to remove of each text that has any, as [lo, hi), sorted, overlapping."""
    given = docs.select(F.col("text"), *_keys(F.col("text")))
    kinds = "key1 long, key2 long, n_bytes long, grams array<long>, around array<long>, starts array<int>, stops array<int>"
    table = given.mapInArrow(lambda batches: _anchor_table(batches, length), kinds)
    table = store(table.where(F.size("grams") > 0).withColumn("row", F.monotonically_increasing_id()), "anchors")
    one = F.explode(F.arrays_zip("grams", "around", "starts", "stops"))
    anchors = table.select("row", one.alias("x")).select(
        "row", F.col("x.grams").alias("gram"), F.col("x.around").alias("around"), F.col("x.starts").alias("start"), F.col("x.stops").alias("stop")
    )
    repeated, settled, open_ = _settled_and_open(anchors)
    text_keys = table.select("row", "key1", "key2")
    # Copies of a text lie in many tasks and each yields the same surroundings.
    windows = store(_with_bytes(docs, open_, text_keys).dropDuplicates(["gram", "around"]), "surroundings-bytes")
    spans = store(settled.unionByName(_in_shards(windows, length, shard_bytes)), "spans-in-surroundings")
    spans = spans.select(F.col("gram").alias("g"), F.col("around").alias("a"), "lo", "hi")
    hits = repeated.join(spans, (F.col("gram") == F.col("g")) & (F.col("around") == F.col("a")))
    hits = hits.groupBy("row").agg(F.collect_set(F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))).alias("spans"))
    by_text = hits.join(text_keys, "row").groupBy("key1", "key2").agg(F.first("spans").alias("spans"))  # copies have the same spans
    return store(by_text.withColumn("spans", F.array_sort("spans")), "spans")


def cut_out(text: str | None, spans: list) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, maximal removed runs) of a text and its sorted spans."""
    raw = (text or "").encode()
    kept, end, runs, removed = [], 0, 0, 0
    for lo, hi in spans:
        if lo > end or (lo == 0 and runs == 0):
            kept.append(raw[end:lo])
            runs += 1
        removed += max(0, hi - max(lo, end))
        end = max(end, hi)
    kept.append(raw[end:])
    return b"".join(kept), removed, runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row (bytes need not be whole characters any more)."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(rows, length, shard_bytes)
    table = bloom_blocks(spans.select("key1"), "key1")
    rows = rows.select("id", "text", *_keys(F.col("text")))
    rows = rows.withColumn("maybe", may_be_listed(rows, "key1", table))
    kinds = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    whole = lambda: [
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
    ]
    joined = rows.where("maybe").join(spans, ["key1", "key2"], "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for x in pdf.itertuples():
                kept, removed, runs = cut_out(x.text, [(s["lo"], s["hi"]) for s in x.spans])
                out.append((x.id, len(x.text.encode()), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"id": "Int64"})

    some = joined.where("spans is not null").select("id", "text", "spans").mapInPandas(cut, kinds)
    none = joined.where("spans is null").select(*whole())
    return rows.where("not maybe").select(*whole()).unionByName(none).unionByName(some).withColumnRenamed("id", key)
