"""Alignment of the tokens of two tokenizers, and how often each pair of token ids is linked in the corpus.

Both tokenizers cover the same bytes, a space and the text. All tokens of a slice of texts are sorted by their
start; the running maximum of their ends tells where groups break: where a start reaches it, all tokens before
have ended, so both tokenizers have a token end there. Inside a group, the tokens that overlap are expanded
into pairs, as many as there are boundaries. Links are the pairs that overlap (`overlap`) or, of these, those that
end at the same byte (`end`).

At scale: each slice of texts (a bounded number of characters, or one longer text) becomes one row with the tokens'
links as packed ids and the slice's own table of id pairs, counted. A slice is encoded some texts at a time and aligned in
windows that end where both sides have a token end, of one text or many, so beside the ids and links of the slice a worker
holds what one window needs (a longer text is encoded whole). Texts come to the workers in short pieces, as Spark bounds
the rows of what it sends at once, not their length. The tables of pairs are summed over the corpus; a
pair meets the sums once per slice, not once per link, and comes back to its slice, which then reads its links
again. Hot pairs are combined on the map side, and a join row is one pair of one slice. The highest count per
second id is a table with one row per vocabulary entry.

Defined results: a null or empty text, and one whose tokens of either side do not spell the space and the text
(the second tokenizer's mark for a space, in a text, is one such case), has no tokens: zeros and an empty string.
Special tokens' strings are plain text. Repeated rows are aligned each by itself and count each. Null keys stay.
Of pairs with the highest count all count as best. An empty table gives no rows. Other columns are left out,
whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.tokens import _byte_chars
from millrace.session import store

SLICE_CHARS = 4_000_000
PIECE_CHARS = 512  # of a row sent to a worker
PART_CHARS = 1 << 18  # encoded at once, or one longer text
WINDOW_TOKENS = 1 << 16  # of the first side, or as many as lie between two shared ends
#: Fixed value: the split pattern of byte-level vocabularies.
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"  # stands for a space in the pieces of a sentencepiece model
#: Rows are megabytes long; by default Parquet looks at the size of a page or group after 100 rows only.
ROW_BY_ROW = {"parquet.page.size.row.check.min": 1, "parquet.block.size": 1 << 24}
_OPEN: dict[tuple, object] = {}


# ---------------------------------------------------------------- tokenizers


class ByteLevel:
    """A byte-level BPE file. Its merges run over the ranks of the file, which a test holds against the file's own library."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        raw, added = _byte_chars(), {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if added.get(t) != i}
        self.spelled = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            self.spelled[i] = bytes(raw[c] for c in token)
        step = spec.get("pre_tokenizer") or {}
        self.plain = step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space") \
            and spec.get("normalizer") is None and spec["model"].get("dropout") is None and len(set(self.spelled)) == len(vocab) + bool(added)
        if self.plain:
            ranks = {self.spelled[i]: i for i in vocab.values()}
            self.merges = tiktoken.Encoding("bytes", pat_str=BYTE_PIECES, mergeable_ranks=ranks, special_tokens={})
        else:
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.plain:
            return [self.merges.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model; it puts the space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.model.id_to_piece(list(range(n))))
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


def opened(kind: type, path: str):
    """One per worker process and file."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]


# ---------------------------------------------------------------- alignment of one slice


@dataclass
class Aligned:
    """Tokens of several texts in one byte range; group and links by token number."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def coalesce(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token of both sides, which tile the same bytes up to their ends."""
    start = np.concatenate([[0], end_a[:-1], [0], end_b[:-1]])[: len(end_a) + len(end_b) + (not len(end_a)) + (not len(end_b))]
    end, side = np.concatenate([end_a, end_b]), np.repeat([0, 1], [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.concatenate([[False], start[order][1:] >= reach[:-1]])
    group = np.empty(len(end), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(end_a)], group[len(end_a) :]


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that share a byte, by their numbers, in order."""
    start_a = np.concatenate([[0], end_a[:-1]])
    first = np.searchsorted(end_b, start_a, side="right")
    last = np.searchsorted(end_b, end_a, side="left")
    wide = last - first + 1
    a = np.repeat(np.arange(len(end_a)), wide)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(first, wide)


def align(a: np.ndarray, b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray, linked: str) -> Aligned:
    """`length_a` and `length_b` are the bytes of each vocabulary entry."""
    if not len(a):
        none = np.zeros(0, np.int64)
        return Aligned(a, b, none, none, none, none)
    end_a, end_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    groups = coalesce(end_a, end_b)
    x, y = overlaps(end_a, end_b)
    if linked == "end":
        together = end_a[x] == end_b[y]
        x, y = x[together], y[together]
    return Aligned(a, b, *groups, x, y)


def windows(length_a: np.ndarray, length_b: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> Iterator[tuple[slice, slice]]:
    """The tokens of both sides in order, cut where both have an end: `size` of the first side or up to the next shared end."""
    at_a = at_b = 0
    wide = size
    while at_a < len(a):
        to_a = min(at_a + wide, len(a))
        end_a = np.cumsum(length_a[a[at_a:to_a]])
        take = wide  # tokens of the second side, until they reach as far
        while True:
            end_b = np.cumsum(length_b[b[at_b : at_b + take]])
            if at_b + take >= len(b) or end_b[-1] > end_a[-1]:
                break
            take *= 2
        if to_a == len(a):
            to_b = len(b)
        else:
            place = np.searchsorted(end_b, end_a, side="right")
            shared = np.flatnonzero((place > 0) & (end_b[np.maximum(place, 1) - 1] == end_a))
            if not len(shared):
                wide *= 2
                continue
            to_a, to_b = at_a + int(shared[-1]) + 1, at_b + int(place[shared[-1]])
        yield slice(at_a, to_a), slice(at_b, to_b)
        at_a, at_b, wide = to_a, to_b, size


class Slice:
    """Texts that are aligned together."""

    def __init__(self, left: ByteLevel, right: Pieces, linked: str, kind: pa.DataType):
        self.left, self.right, self.linked, self.kind = left, right, linked, kind
        self.length_a, self.length_b = (np.array(list(map(len, t.spelled)), np.int64) for t in (left, right))
        # Each id as text, followed by the sign that ends it: next id, other side, next group.
        self.shown = [[f"{i}{sign}".encode() for i in range(max(len(left.spelled), len(right.spelled))) for sign in ",|;"]][0]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        none = np.zeros(0, np.uint32)
        a, b = [none] * len(texts), [none] * len(texts)
        for some in _parts(texts, PART_CHARS):
            wanted = [" " + texts[i] for i in some]
            for i, text, x, y in zip(some, wanted, self.left.encode(wanted), self.right.encode([t[1:] for t in wanted])):
                raw = text.encode()
                if _spells(self.left.spelled, x, raw) and _spells(self.right.spelled, y, raw):
                    a[i], b[i] = x, y
        return a, b

    def row(self, keys: list, texts: list[str]) -> pa.RecordBatch:
        a, b = self.tokens(texts)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (a, b))
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        a, b = np.concatenate(a), np.concatenate(b)
        groups_to, links_to, digests = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), _Digests(n_a, last_a + last_b)
        groups, links, pairs, tables = 0, 0, [], []
        for of_a, of_b in windows(self.length_a, self.length_b, a, b, WINDOW_TOKENS):
            found = align(a[of_a].astype(np.int64), b[of_b].astype(np.int64), self.length_a, self.length_b, self.linked)
            ended = slice(*np.searchsorted(last_a, [of_a.start, of_a.stop], side="right"))  # texts whose last token is here
            groups_to[ended] = groups + found.group_a[last_a[ended] - of_a.start - 1] + 1
            links_to[ended] = links + np.searchsorted(found.link_a, last_a[ended] - of_a.start, side="left")
            groups, links = groups + int(found.group_a[-1]) + 1, links + len(found.link_a)
            pairs.append((found.a[found.link_a] << 32) | found.b[found.link_b])
            tables.append(np.unique(pairs[-1], return_counts=True))
            digests.add(self._signs(found), ended)
        known, times = _summed(tables)
        places = [np.searchsorted(known, x).astype("<u4").tobytes() for x in pairs]
        row = {
            "n_a": n_a, "n_b": n_b, "n_groups": np.diff(groups_to, prepend=0), "links_to": links_to, "pairs": known, "times": times,
            "id": pa.array(keys, self.kind), "groups_sha256": pa.array(digests.made, pa.string()),
        }
        lists = {c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in row.items()}
        return pa.RecordBatch.from_pydict({**lists, "links": pa.array([b"".join(places)], pa.binary())}, _fields(self.kind))

    def _signs(self, found: Aligned) -> list[bytes]:
        """The tokens of both sides as they are shown, group by group."""
        n_a, n_b = len(found.a), len(found.b)
        # A token's place: those of its side before it, and those of the other side in earlier groups (for b, in its own too).
        place_a = np.arange(n_a) + np.searchsorted(found.group_b, found.group_a, side="left")
        place_b = np.arange(n_b) + np.searchsorted(found.group_a, found.group_b, side="right")
        code = np.empty(n_a + n_b, np.int64)
        ends = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (found.group_a, found.group_b)]
        code[place_a] = 3 * found.a + ends[0]
        code[place_b] = 3 * found.b + 2 * ends[1]
        return list(map(self.shown.__getitem__, code.tolist()))


class _Digests:
    """Digests of texts whose tokens come window by window; `stops` counts the tokens of both sides up to the end of each."""

    def __init__(self, n: np.ndarray, stops: np.ndarray):
        self.some, self.stops, self.made = n > 0, stops, [""] * len(n)
        self.at, self.open = 0, hashlib.sha256()

    def add(self, signs: list[bytes], ended: slice) -> None:
        """The next tokens, and the texts that end with one of them."""
        done = 0
        for i in (np.flatnonzero(self.some[ended]) + ended.start).tolist():
            to = int(self.stops[i]) - self.at
            self.open.update(b"".join(signs[done:to])[:-1])
            self.made[i], self.open, done = self.open.hexdigest(), hashlib.sha256(), to
        self.open.update(b"".join(signs[done:]))
        self.at += len(signs)


def _parts(texts: list[str], chars: int) -> Iterator[list[int]]:
    """Places of the texts that are not empty, some at a time."""
    some, held = [], 0
    for i, text in enumerate(texts):
        if text:
            some.append(i)
            held += len(text)
            if held >= chars:
                yield some
                some, held = [], 0
    if some:
        yield some


def _spells(spelled: list[bytes], ids: np.ndarray, raw: bytes) -> bool:
    at = 0
    for lo in range(0, len(ids), WINDOW_TOKENS):
        said = b"".join(map(spelled.__getitem__, ids[lo : lo + WINDOW_TOKENS].tolist()))
        if raw[at : at + len(said)] != said:
            return False
        at += len(said)
    return at == len(raw)


def _summed(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One table of values and counts, by value, from several."""
    if not tables:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known, places = np.unique(np.concatenate([x for x, _ in tables]), return_inverse=True)
    times = np.zeros(len(known), np.int64)
    np.add.at(times, places, np.concatenate([n for _, n in tables]))
    return known, times


def _fields(kind: pa.DataType) -> pa.Schema:
    counts = [(c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups", "links_to", "pairs", "times")]
    return pa.schema([("id", pa.list_(kind)), *counts, ("groups_sha256", pa.list_(pa.string())), ("links", pa.binary())])


def _pieces(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, place, piece: each text in pieces that follow each other; one row without a piece if it is null or empty."""
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))
    return docs.select(F.col(key).alias("id"), F.posexplode_outer(cut).alias("place", "piece"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, str]]:
    """Keys and whole texts from their pieces."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = batch.column("piece").cast(pa.large_string())
        to = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        raw = memoryview(pieces.buffers()[2] or b"")
        first = np.flatnonzero(batch.column("place").fill_null(0).to_numpy() == 0)
        stops = to[np.append(first, len(pieces))].tolist()
        held.append(bytes(raw[to[0] : stops[0]]))
        for begun, lo, hi in zip(batch.column("id").take(pa.array(first)), stops, stops[1:]):
            if key is not None:
                yield key, b"".join(held).decode()
            key, held = begun, [bytes(raw[lo:hi])]
    if key is not None:
        yield key, b"".join(held).decode()


def _slices(batches: Iterator[pa.RecordBatch], left: str, right: str, linked: str, chars: int) -> Iterator[pa.RecordBatch]:
    work, keys, texts, held = None, [], [], 0
    for key, text in _texts(batches):
        if work is None:
            work = Slice(opened(ByteLevel, left), opened(Pieces, right), linked, key.type)
        keys.append(key.as_py())
        texts.append(text)
        held += len(text) + 50
        if held >= chars:
            yield work.row(keys, texts)
            keys, texts, held = [], [], 0
    if keys:
        yield work.row(keys, texts)


# ---------------------------------------------------------------- counts


def _judged(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of a slice with the sums over their links."""
    row = {c: rows[c][0] for c in rows.column_names}
    links = np.frombuffer(row["links"].as_buffer(), "<u4")
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    place = pairs["place"].to_numpy()
    count[place], best[place] = pairs["count"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
    to = np.concatenate([[0], row["links_to"].values.to_numpy()])
    sums = [np.diff(np.concatenate([[0], np.cumsum(x[links])])[to]) for x in (best, count)]
    named = {"n_links": np.diff(to), "n_best": sums[0], "count_sum": sums[1]}
    same = {c: row[c].values for c in ("id", "n_a", "n_b", "n_groups", "groups_sha256")}
    return pa.table({**same, **{c: pa.array(v) for c, v in named.items()}})


def _entries(slices: DataFrame) -> DataFrame:
    """slice, place, pair (first id in the upper 32 bits, second below), n: the table of pairs of each slice."""
    return slices.select("slice", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select(
        "slice", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n")
    )


def pair_counts(slices: DataFrame) -> DataFrame:
    """pair, count, best (no other first id is linked more often with this second id)."""
    second = F.col("pair").bitwiseAND((1 << 32) - 1)
    counts = store(_entries(slices).groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy(second.alias("of")).agg(F.max("count").alias("most"))  # a row per entry of the second vocabulary
    return counts.join(F.broadcast(highest), second == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame, left: str, right: str, key: str = "doc_id", text: str = "text", linked: str = "end", chars: int = SLICE_CHARS
) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    `left` is a byte-level tokenizer file, `right` a sentencepiece model; `linked` is "end" or "overlap".
    """
    if linked not in {"end", "overlap"}:
        raise ValueError("linked must be end or overlap")
    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups", "links_to", "pairs", "times"))
    schema = f"id array<{kind}>, {counts}, groups_sha256 array<string>, links binary"
    slices = _pieces(docs, key, text).mapInArrow(lambda b: _slices(b, left, right, linked, chars), schema)
    slices = store(slices.withColumn("slice", F.monotonically_increasing_id()), "token-links", **ROW_BY_ROW)
    known = _entries(slices).select("slice", "place", "pair").join(pair_counts(slices), "pair").select(F.col("slice").alias("of"), "place", "count", "best")
    links = slices.select("slice", "id", "n_a", "n_b", "n_groups", "links_to", "groups_sha256", "links")
    out = f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    judged = links.groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(_judged, out)
    return judged.select(F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
