"""Packing by lexical retrieval: windows of tokens filled with documents that are alike.

1. Documents are tokenized and cut into pieces. Whole windows of long documents are sequences as they
   are; only the rest of each document, shorter than a window, is indexed.
2. Document frequencies of all terms (token ids) are summed over these rests, as vectors with one
   number per vocabulary entry, in rounds of FAN vectors.
3. Each rest goes to a partition by its most telling term (largest BM25 weight). A term that many rests
   share is salted by its document frequency, so copies never meet in one task.
4. A task reads its rests in the order of their two most telling terms, in shards of SHARD_TOKENS. Each
   shard has a BM25 inverted index. A seed document opens a window; the index returns the unused
   documents nearest to it, which fill the window in this order. The one that overflows it is cut, and
   what is left of it seeds the next window. An unfinished window goes on in the next shard.
5. At the end of a task, the last tokens become sequences with lengths of powers of two, so nothing is
   padded.

Defined results: a null or empty text is its end id alone; equal and repeated rows are packed each by
itself; a null key is kept; an empty table gives an empty table. Of equally near documents the first in
order is taken. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tokens import token_ids
from millrace.operators.order import PART_BITS
from millrace.session import store

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1_000_000
PART_TOKENS = 8_000_000
BATCH_BYTES = 4 << 20
FAN = 64
AHEAD = 32  # nearest documents that are put in order at once
K1, B = 1.2, 0.75


# ---------------------------------------------------------------- tokens


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of each text; last, how many rests hold each term (in a row of its own)."""
    tokens = token_ids(path)
    end = np.array([end_id], tokens.dtype).tobytes()
    size = tokens.dtype.itemsize
    seen = np.zeros(max(tokens.tokenizer.get_vocab_size(), end_id + 1), np.int64)
    terms = Terms(len(seen))
    kind, rows, held = None, [], 0
    for batch in batches:
        kind = batch.schema.field("id").type
        keys, texts = batch.column("id"), batch.column("text")
        for at, ids in enumerate(tokens.encode(x.as_py() for x in texts)):
            ids += end
            total = len(ids) // size
            for start in range(0, total, window):
                part = ids[start * size : (start + window) * size]
                rows.append((keys[at].as_py(), start, len(part) // size, total, part))
            if total % window:
                seen[terms.distinct(np.frombuffer(part, tokens.dtype))] += 1
            held += len(ids) + 100
            if held >= BATCH_BYTES:
                yield _batch(rows, kind)
                rows, held = [], 0
    if kind is not None:
        yield _batch(rows, kind)
        yield _batch([(None, -1, 0, 0, seen.astype("<i8").tobytes())], kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["id", "start", "length", "doc_tokens", "ids"]
    kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def tokenized(docs: DataFrame, tokenizer: str, key: str, text: str, window: int, end_id: int) -> DataFrame:
    """id, start, length, doc_tokens, ids of all pieces; rows with start -1 hold term counts instead."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, start long, length long, doc_tokens long, ids binary"
    pieces = rows.mapInArrow(lambda batches: _pieces(batches, tokenizer, window, end_id), schema)
    return store(pieces.withColumn("row", F.monotonically_increasing_id()), "token-pieces")


def _summed(vectors: DataFrame) -> np.ndarray:
    """The sum of count vectors (column ids): FAN of them at a time until FAN are left."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("ids"):
                one = np.frombuffer(x.as_buffer(), "<i8")
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["ids"])

    left = vectors.count()
    while left > FAN:
        left = math.ceil(left / FAN)
        vectors = store(vectors.repartition(left).mapInArrow(add, "ids binary"), "term-counts")
        left = min(left, vectors.count())
    found = [np.frombuffer(r[0], "<i8") for r in vectors.collect()]  # at most FAN vectors of the vocabulary's size
    return np.sum(found, axis=0) if found else np.zeros(0, np.int64)


# ---------------------------------------------------------------- retrieval


def inverse_frequency(df: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p((documents - df + 0.5) / (df + 0.5))


def weights(count: np.ndarray, length: int, mean: float, idf: np.ndarray) -> np.ndarray:
    return idf * count * (K1 + 1) / (count + K1 * (1 - B + B * length / mean))


class Terms:
    """Distinct terms of one text after the other, without sorting or hashing: the last place of each is marked in a table of the vocabulary."""

    def __init__(self, size: int):
        self.last, self.number, self.range = np.zeros(size, np.intp), np.zeros(size, np.intp), np.arange(1 << 13)

    def distinct(self, ids: np.ndarray) -> np.ndarray:
        if len(ids) > len(self.range):
            self.range = np.arange(2 * len(ids))
        at, place = ids.astype(np.intp), self.range[: len(ids)]
        self.last[at] = place
        return at[self.last[at] == place]

    def counted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term = self.distinct(ids)
        self.number[term] = self.range[: len(term)]
        return term, np.bincount(self.number[ids], minlength=len(term))


class Index:
    """BM25 postings of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        terms, owners, values = [], [], []
        self.terms = Terms(len(idf))
        for i, ids in enumerate(docs):
            term, count = self.terms.counted(ids)
            terms.append(term)
            owners.append(np.full(len(term), i, np.int32))
            values.append(weights(count, len(ids), mean, idf[term]).astype(np.float32))
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.owner, self.value = np.concatenate(owners)[order], np.concatenate(values)[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.unused = np.ones(len(docs), bool)

    def near(self, seed: np.ndarray) -> Iterator[int]:
        """Unused documents from the nearest on; those without a common term last, in order.

        The first ones fill a window in most cases, so the others are put in order only when they are asked for.
        """
        term = self.terms.distinct(seed)
        lo, n = self.first[term], self.first[term + 1] - self.first[term]
        place = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        score = np.bincount(self.owner[place], self.value[place], minlength=len(self.unused))
        left = np.flatnonzero(self.unused)
        score = score[left]
        least = np.partition(score, -AHEAD)[-AHEAD] if len(left) > AHEAD else -1.0
        for some in (score >= least, score < least):
            yield from left[some][np.argsort(-score[some], kind="stable")].tolist()


class Packer:
    """Fills windows; gives (sequence, offset, document, start, ids) of each piece.

    A sequence is named by the document and place that it starts with, so names never depend on which task packs it.
    """

    def __init__(self, window: int):
        self.window = window
        self.sequence, self.filled = None, 0
        self.open: list[tuple] = []  # pieces of the window being filled
        self.seed: np.ndarray | None = None

    def _put(self, doc: object, start: int, ids: np.ndarray) -> list[tuple]:
        """Adds a piece that fits; the pieces of the window, if it is full now."""
        if not self.filled:
            self.sequence = (doc, start)
        self.open.append((self.sequence, self.filled, doc, start, ids))
        self.filled += len(ids)
        if self.filled < self.window:
            return []
        done, self.open = self.open, []
        self.filled, self.seed = 0, None
        return done

    def add(self, doc: object, ids: np.ndarray) -> list[tuple]:
        """Adds a document, cut where the window ends; its rest seeds the next window."""
        if self.seed is None:
            self.seed = ids
        room = self.window - self.filled
        done = self._put(doc, 0, ids[:room])
        if len(ids) > room:
            self.seed = ids
            done += self._put(doc, room, ids[room:])
        return done

    def shard(self, docs: list[tuple[object, np.ndarray]], idf: np.ndarray, mean: float) -> Iterator[tuple]:
        """Packs all (document, ids) of a shard."""
        index = Index([ids for _, ids in docs], idf, mean)
        left = len(docs)
        while left:
            if self.seed is None:
                nearest = [int(index.unused.argmax())]
            else:
                nearest = index.near(self.seed)
            seed = self.seed
            for i in nearest:
                index.unused[i] = False
                left -= 1
                yield from self.add(*docs[i])
                if self.seed is not seed:
                    break

    def finish(self) -> Iterator[tuple]:
        """The last, unfinished window, cut into sequences with lengths of powers of two."""
        cuts = [1 << b for b in range(self.filled.bit_length() - 1, -1, -1) if self.filled >> b & 1]
        at, room = 0, cuts.pop(0) if cuts else 0
        for _, _, doc, start, ids in self.open:
            while len(ids):
                if not at:
                    self.sequence = (doc, start)
                yield self.sequence, at, doc, start, ids[: room - at]
                start, taken = start + min(len(ids), room - at), min(len(ids), room - at)
                ids, at = ids[taken:], at + taken
                if at == room:
                    at, room = 0, cuts.pop(0) if cuts else 0


# ---------------------------------------------------------------- the job


OUT = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _routed(batches: Iterator[pa.RecordBatch], idf: np.ndarray, df: np.ndarray, mean: float, dtype: np.dtype, room: int) -> Iterator[pa.RecordBatch]:
    """Adds the two most telling terms of each rest, and a salt as large as the first one is frequent."""
    terms = Terms(len(idf))
    for batch in batches:
        one, two, salt = [], [], []
        for ids, row in zip(batch.column("ids"), batch.column("row")):
            term, count = terms.counted(np.frombuffer(ids.as_buffer(), dtype))
            weight = weights(count, count.sum(), mean, idf[term])
            best = int(term[weight.argmax()])
            one.append(best)
            if len(term) > 1:
                weight[weight.argmax()] = -1
            two.append(int(term[weight.argmax()]))
            salt.append(row.as_py() % max(1, int(df[best]) // room))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(salt, pa.int64())],
            [*batch.schema.names, "term1", "term2", "salt"],
        )


def _packed(batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float, dtype: np.dtype, window: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    packer, docs, held, kind, out, size = Packer(window), [], 0, None, [], 0

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        table = [
            (key, first + start, len(ids), ids.astype("<u4").tobytes(), total, opener[3] * window + place, at)
            for (opener, place), at, (key, first, total, _), start, ids in pieces
        ]
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*table)) or [[]] * len(kinds)
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def flow() -> Iterator[tuple]:
        nonlocal docs, held, kind
        for batch in batches:
            kind = batch.schema.field("id").type
            columns = [batch.column(n) for n in ("id", "start", "doc_tokens", "number", "ids")]
            for key, start, total, number, ids in zip(*columns):
                docs.append(((key.as_py(), start.as_py(), total.as_py(), number.as_py()), np.frombuffer(ids.as_py(), dtype)))
                held += len(docs[-1][1])
                if held >= shard_tokens:
                    yield from packer.shard(docs, idf, mean)
                    docs, held = [], 0
        if docs:
            yield from packer.shard(docs, idf, mean)
        yield from packer.finish()

    for piece in flow():
        out.append(piece)
        size += 4 * len(piece[4])
        if size >= BATCH_BYTES:
            yield rows(out)
            out, size = [], 0
    if out:
        yield rows(out)


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS, part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset of every piece."""
    spark: SparkSession = docs.sparkSession
    dtype = token_ids(tokenizer).dtype
    pieces = tokenized(docs, tokenizer, key, text, window, end_id)
    df = _summed(pieces.where("start < 0").select("ids"))
    rests = pieces.where((F.col("start") >= 0) & (F.col("length") < window))
    whole = pieces.where(F.col("length") == window)
    part, place = F.shiftright("row", PART_BITS), F.col("row").bitwiseAND((1 << PART_BITS) - 1)
    count, total, widest = rests.agg(F.count("*"), F.sum("length"), F.max(place)).first()
    total = total or 0
    mean = total / max(count, 1) or 1.0
    parts = max(1, math.ceil(total / part_tokens))
    room = max(1, count // (4 * parts))  # rests of one term that may go to one place
    held = spark.sparkContext.broadcast((inverse_frequency(df, count), df))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, start long, length long, doc_tokens long, ids binary, row long"
    routed = rests.mapInArrow(
        lambda b: _routed(b, held.value[0], held.value[1], mean, dtype, room), schema + ", term1 int, term2 int, salt long"
    )
    routed = routed.repartition(parts, "term1", "salt").sortWithinPartitions("term1", "term2", "row")
    # Rows are numbered without gaps between their partitions, so that a number times the window still fits a long.
    number = F.shiftleft(part, int(widest or 0).bit_length()) + place
    packed = routed.select("id", "start", "doc_tokens", number.alias("number"), "ids").mapInArrow(
        lambda b: _packed(b, held.value[0], mean, dtype, window, shard_tokens), f"id {kind}, {OUT}"
    )

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), dtype).astype("<u4").tobytes() for x in batch.column("ids")]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    whole = whole.select("id", "start", "length", "ids", "doc_tokens", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    whole = whole.mapInArrow(widened, whole.schema)
    return packed.unionByName(whole).withColumnRenamed("id", key)
