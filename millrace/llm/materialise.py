"""Training-order materialisation: fixed-stride shards of token ids in a keyed random order.

1. Documents are tokenized, each ends with an end id, and the ids of a task form one stream. Streams
   follow each other in the order of the tasks, so every id has a global place and every `stride` ids
   are a sequence; the last one is filled up with `pad_id`.
2. A Feistel permutation with a key maps the sequence number to its slot. It works on a domain of an
   even number of bits; numbers beyond the count are mapped again until they fall within (cycle-walking),
   so it is a permutation of exactly the sequences, needs no table, and can be inverted.
3. Slots are dealt to shards of `shard_slots` by range. A task sorts the parts of its shards by slot and
   writes each shard from front to back; slot s lies at byte (s % shard_slots) * stride * width of
   shard s // shard_slots. Reading on from step n is a seek.

A shard is written under a name of its own and moved into place when complete, so lost or repeated tasks
leave whole shards only. Files are reached through `pyarrow.fs`.

Defined results: a null or empty text is its end id alone; equal and repeated rows follow each other as
given; no documents make no shards. Other columns than the text are left out.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tokens import token_ids
from millrace.llm.warc import _place
from millrace.session import store

STRIDE = 2048
SHARD_SLOTS = 4096
END_ID = 2
CHUNK_IDS = 1 << 18
ROUNDS = 6


# ---------------------------------------------------------------- the permutation


class Feistel:
    """A keyed permutation of range(count)."""

    def __init__(self, count: int, key: int, rounds: int = ROUNDS):
        self.count = count
        self.half = np.uint64(max(1, math.ceil(max(1, (count - 1).bit_length()) / 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) % 2**64) for r in range(rounds)]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(29))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(numbers, np.uint64), back)
        while (out := x >= np.uint64(self.count)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slot(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def number(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


# ---------------------------------------------------------------- streams


def _streams(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """The ids of a task in chunks: task, place of the chunk in its stream, number of ids, ids (zstd)."""
    tokens, part = token_ids(path), TaskContext.get().partitionId()
    end, packer = np.array([end_id], tokens.dtype).tobytes(), zstandard.ZstdCompressor(3)
    at, held, parts = 0, 0, []

    def chunk() -> pa.RecordBatch:
        raw = b"".join(parts)
        n = len(raw) // tokens.dtype.itemsize
        columns = [pa.array([x], k) for x, k in ((part, pa.int32()), (at, pa.int64()), (n, pa.int64()), (packer.compress(raw), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["part", "at", "n", "ids"])

    for batch in batches:
        for ids in tokens.encode(x.as_py() for x in batch.column("text")):
            parts += [ids, end]
            held += len(ids) // tokens.dtype.itemsize + 1
            if held >= CHUNK_IDS:
                yield chunk()
                at, held, parts = at + held, 0, []
    if parts:
        yield chunk()


def _placed(batches: Iterator[pa.RecordBatch], dtype: np.dtype, stride: int, order: Feistel, shard_slots: int) -> Iterator[pa.RecordBatch]:
    """Pieces of sequences: shard, slot, sequence, offset, ids (zstd)."""
    size, unpack, pack = dtype.itemsize, zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(3)
    for batch in batches:
        for base, at, ids in zip(batch.column("base"), batch.column("at"), batch.column("ids")):
            first, raw = base.as_py() + at.as_py(), unpack.decompress(ids.as_py())
            n = len(raw) // size
            numbers = np.arange(first // stride, (first + n - 1) // stride + 1)
            starts = np.maximum(numbers * stride - first, 0)
            stops = np.minimum((numbers + 1) * stride - first, n)
            slots = order.slot(numbers)
            pieces = [pack.compress(raw[a * size : b * size]) for a, b in zip(starts.tolist(), stops.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots // shard_slots), pa.array(slots), pa.array(numbers), pa.array(first + starts - numbers * stride), pa.array(pieces, pa.binary())],
                ["shard", "slot", "sequence", "offset", "ids"],
            )


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _written(batches: Iterator[pd.DataFrame], folder: str, dtype: np.dtype, stride: int, shard_slots: int, count: int, pad_id: int) -> Iterator[pd.DataFrame]:
    """Writes the shards of a task, whose rows come sorted by slot and offset; a row for each slot."""
    fs, root = _place(folder)
    unpack, size = zstandard.ZstdDecompressor(), dtype.itemsize * stride
    pad = np.array([pad_id], dtype).tobytes()
    out, shard, slot, name, held, sequence = None, None, None, "", [], None
    done: list[tuple] = []

    def put() -> None:
        raw = b"".join(held)
        n = len(raw) // dtype.itemsize
        out.write(raw + pad * (stride - n))
        done.append((slot, shard, sequence, n))

    def close() -> None:
        out.close()
        fs.move(f"{root}/{name}", f"{root}/{shard_name(shard)}")

    for pdf in batches:
        for x in pdf.itertuples():
            if x.slot != slot:
                if slot is not None:
                    put()
                if x.shard != shard:
                    if out is not None:
                        close()
                    shard, name = x.shard, f"_{uuid.uuid4().hex}"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                slot, sequence, held = x.slot, x.sequence, []
            held.append(unpack.decompress(x.ids))
        yield pd.DataFrame(done, columns=["slot", "shard", "sequence", "n_tokens"])
        done.clear()
    if out is not None:
        put()
        close()
        yield pd.DataFrame(done, columns=["slot", "shard", "sequence", "n_tokens"])


def materialise(
    docs: DataFrame, folder: str, tokenizer: str, seed: int = 1, text: str = "text", stride: int = STRIDE,
    shard_slots: int = SHARD_SLOTS, end_id: int = END_ID, pad_id: int = END_ID,
) -> DataFrame:
    """Writes the shards into `folder`; (slot, shard, sequence, n_tokens) of every sequence."""
    spark: SparkSession = docs.sparkSession
    dtype = token_ids(tokenizer).dtype
    rows = docs.select(F.col(text).alias("text"))
    streams = store(rows.mapInArrow(lambda b: _streams(b, tokenizer, end_id), "part int, at long, n long, ids binary"), "token-streams")
    sizes = {r[0]: r[1] for r in streams.groupBy("part").agg(F.sum("n")).collect()}  # one number per task
    count = math.ceil(sum(sizes.values()) / stride)
    bases, total = [], 0
    for part in sorted(sizes):
        bases.append((part, total))
        total += sizes[part]
    fs, root = _place(folder)
    fs.create_dir(root, recursive=True)
    order, shards = Feistel(max(count, 1), seed), max(1, math.ceil(count / shard_slots))
    based = streams.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")
    pieces = based.select("base", "at", "ids").mapInArrow(
        lambda b: _placed(b, dtype, stride, order, shard_slots), "shard long, slot long, sequence long, offset long, ids binary"
    )
    dealt = pieces.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot", "offset")  # its range of slots
    return store(
        dealt.mapInPandas(
            lambda b: _written(b, folder, dtype, stride, shard_slots, count, pad_id), "slot long, shard long, sequence long, n_tokens long"
        ),
        "shard-manifest",
    )


def read_slots(manifest: DataFrame, folder: str, dtype: np.dtype, stride: int = STRIDE, shard_slots: int = SHARD_SLOTS, from_slot: int = 0) -> DataFrame:
    """slot, shard, sequence, n_tokens, ids (little-endian, `n_tokens` of them), read from the shards, from a slot on."""
    size = stride * dtype.itemsize

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _place(folder)
        opened: tuple[int, pa.NativeFile] | None = None
        for pdf in batches:
            ids = []
            for x in pdf.itertuples():
                if opened is None or opened[0] != x.shard:
                    if opened is not None:
                        opened[1].close()
                    opened = x.shard, fs.open_input_file(f"{root}/{shard_name(x.shard)}")
                opened[1].seek(x.slot % shard_slots * size)
                ids.append(opened[1].read(size)[: x.n_tokens * dtype.itemsize])
            yield pdf.assign(ids=ids)

    wanted = manifest.where(F.col("slot") >= from_slot)
    return wanted.mapInPandas(read, "slot long, shard long, sequence long, n_tokens long, ids binary")
