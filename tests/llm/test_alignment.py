import bisect
import collections
import hashlib
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.session import store

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "it's 12345 <|endoftext|> don't <s> </s> <unk> <0x41> ", "  two  spaces\n\n\ttab 　 wide", "naïve café — “quoted” ½ ﬁ", "日本語のテキスト 中文字",
    "▁mark ▁▁", "a▁b", "\x00\x01 nul", "🙂👩‍👩‍👧 flags 🇩🇪", "Ａ ｆｕｌｌ", "é decomposed é", " ", "\n", "x" * 3000, " " * 500 + "end", "​﻿  z",
]


@pytest.fixture(scope="module")
def tokenizers():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    chars = {}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars.update({chr(b): b for b in printable})
    for i, b in enumerate(x for x in range(256) if x not in printable):
        chars[chr(256 + i)] = b
    return left, chars, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def tokens(tokenizers, text):
    """(ids, bytes) of both sides; none if one does not spell the space and the text."""
    left, chars, right = tokenizers
    if not text:
        return [], [], [], []
    a = left.encode(" " + text, add_special_tokens=False).ids
    spell_a = [bytes(chars[c] for c in left.id_to_token(i)) for i in a]
    b = right.encode(text)
    spell_b = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, right.id_to_piece(b))]
    raw = (" " + text).encode()
    if b"".join(spell_a) != raw or b"".join(spell_b) != raw:
        return [], [], [], []
    return a, b, spell_a, spell_b


def spans(spelled):
    at, out = 0, []
    for s in spelled:
        out.append((at, at + len(s)))
        at += len(s)
    return out


def brute(tokenizers, rows, linked):
    """One text at a time, one pair of tokens at a time."""
    texts, count = [], collections.Counter()
    for key, text in rows:
        a, b, sa, sb = tokens(tokenizers, text)
        sa, sb = spans(sa), spans(sb)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        links, j = [], 0
        for i, (lo, hi) in enumerate(sa):
            while j and sb[j - 1][1] > lo:
                j -= 1
            while j < len(sb) and sb[j][0] < hi:
                if sb[j][1] > lo and (linked == "overlap" or sb[j][1] == hi):
                    links.append((a[i], b[j]))
                j += 1
        groups = [([], []) for _ in cuts]
        for side, (ids, where) in enumerate(((a, sa), (b, sb))):
            for x, (_, end) in zip(ids, where):
                groups[bisect.bisect_left(cuts, end)][side].append(str(x))
        groups = ["|".join(map(",".join, g)) for g in groups]
        count.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        texts.append((key, len(a), len(b), len(groups), links, digest))
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(
        ((key, n_a, n_b, n, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), digest)
         for key, n_a, n_b, n, links, digest in texts), key=repr)


def found(docs, **options):
    got = alignment.align_tokens(docs, LEFT, RIGHT, **options)
    assert got.columns == ["doc_id", *NAMES]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("linked,chars", [("end", 4_000_000), ("end", 300), ("overlap", 300)])
def test_alignment_equals_brute_force(spark, tokenizers, text_of, linked, chars):
    rows = [(i, t) for i, t in enumerate([None, "", *ODD, *[text_of(i, 30) for i in range(20)]])]
    rows += [rows[3], rows[3], (None, "no key"), (2**60 + 1, text_of(9, 3000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs, linked=linked, chars=chars) == brute(tokenizers, rows, linked)


def test_given_texts(spark, sf, tokenizers):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(docs) == brute(tokenizers, [(r.doc_id, r.text) for r in docs.collect()], "end")


def test_odd_tables(spark, odd_docs, no_docs, tokenizers):
    assert found(no_docs) == []
    assert found(odd_docs) == brute(tokenizers, [(r.doc_id, r.text) for r in odd_docs.collect()], "end")
    none = spark.createDataFrame([("a", None), ("b", ""), ("c", "a▁b")], "doc_id string, text string")
    assert found(none) == [(k, 0, 0, 0, 0, 0, 0, "") for k in "abc"]


def test_byte_level_ids_equal_those_of_the_files_own_library(tokenizers):
    """Each entry that is text, and each code point among letters, digits, signs and spaces."""
    own, left = alignment.ByteLevel(LEFT), tokenizers[0]
    assert own.plain
    texts = [s.decode() for s in own.spelled if s and s.decode("utf-8", "ignore").encode() == s] + ODD
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000][::3] + [*range(0x3000)]
    texts += ["".join(f" a{chr(c)}a 1{chr(c)}1 .{chr(c)}. {chr(c)}{chr(c)}  {chr(c)} '{chr(c)}" for c in points[i : i + 50]) for i in range(0, len(points), 50)]
    want = [e.ids for e in left.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want


def test_a_dropped_boundary_joins_groups():
    import numpy as np

    a, b = alignment.coalesce(np.array([2, 5, 7, 9]), np.array([3, 5, 9]))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1]
    x, y = alignment.overlaps(np.array([2, 5, 7, 9]), np.array([3, 5, 9]))
    assert list(zip(x.tolist(), y.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 2)]


def rows_of(texts, chars=4_000_000, linked="end", size=3):
    """The rows of the slices, from pieces in batches of `size`."""
    pieces = [(i, at // 5, t[at : at + 5] or None) for i, t in enumerate(texts) for at in range(0, max(len(t), 1), 5)]
    names = {"id": pa.int64(), "place": pa.int32(), "piece": pa.string()}
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces[i : i + size]), names.values())], list(names))
        for i in range(0, len(pieces), size)
    ]
    return list(alignment._slices(iter(batches), LEFT, RIGHT, linked, chars))


@pytest.mark.parametrize("linked", ["end", "overlap"])
@pytest.mark.parametrize("tokens,part,size", [(1, 1, 1), (7, 50, 4), (300, 5000, 1000)])
def test_windows_and_parts_leave_the_rows_as_they_are(monkeypatch, text_of, linked, tokens, part, size):
    texts = ["", *ODD, "", *[text_of(i, 40) for i in range(4)], "a▁b", text_of(9, 700), ""]
    whole = rows_of(texts, linked=linked, size=10**6)
    monkeypatch.setattr(alignment, "WINDOW_TOKENS", tokens)
    monkeypatch.setattr(alignment, "PART_CHARS", part)
    assert len(whole) == 1 and rows_of(texts, linked=linked, size=size) == whole


def test_windows_end_where_both_sides_do():
    length = np.arange(10)
    a, b = np.array([2, 3, 4, 1, 5, 2]), np.array([5, 1, 3, 6, 2])  # shared ends at 5, 9, 15, 17
    found = [(a[x].tolist(), b[y].tolist()) for x, y in alignment.windows(length, length, a, b, 2)]
    assert found == [([2, 3], [5]), ([4], [1, 3]), ([1, 5], [6]), ([2], [2])]
    assert list(alignment.windows(length, length, a[:0], b[:0], 2)) == []


@pytest.mark.parametrize("joined,most", [(False, 60), (True, 100)])
def test_memory_of_a_slice(spark, tokenizers, text_of, joined, most):
    """Many texts, and one long text; a worker held 140 and 213 bytes for each character of a slice."""
    texts = [text_of(i, 400) for i in range(500)]
    texts = [" ".join(texts)] if joined else texts
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    pieces = alignment._pieces(docs, "doc_id", "text").toArrow().combine_chunks().to_batches()
    alignment.opened(alignment.ByteLevel, LEFT), alignment.opened(alignment.Pieces, RIGHT)
    tracemalloc.start()
    (row,) = alignment._slices(iter(pieces), LEFT, RIGHT, "end", 4_000_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row["n_a"][0].as_py() == [len(tokens(tokenizers, t)[0]) for t in texts]
    assert peak < most * sum(map(len, texts))


def test_texts_are_sent_in_short_pieces(spark):
    texts = [None, "", "x", "é\n\r\u2028🙂" * 1000, "\0" * 512, "y" * 513, "z" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    pieces = alignment._pieces(docs, "doc_id", "text")
    assert pieces.agg(F.max(F.char_length("piece"))).first()[0] == alignment.PIECE_CHARS
    for batch in (1, 7, 10_000):
        batches = pieces.toArrow().combine_chunks().to_batches(max_chunksize=batch)
        assert [(k.as_py(), t) for k, t in alignment._texts(iter(batches))] == [(i, t or "") for i, t in enumerate(texts)]


def test_long_rows_are_stored_in_short_groups(spark, monkeypatch):
    """Parquet compresses a page in buffers outside the heap; pages and groups of these rows were never cut."""
    found = {}
    monkeypatch.setattr(alignment, "store", lambda df, label, **options: found.setdefault(label, store(df, label, **options)))
    monkeypatch.setattr(alignment, "ROW_BY_ROW", alignment.ROW_BY_ROW | {"parquet.block.size": 1 << 16})
    docs = spark.createDataFrame([(i, f"{i} word " * 700) for i in range(30)], "doc_id long, text string").coalesce(1)
    assert len(alignment.align_tokens(docs, LEFT, RIGHT, chars=4000).collect()) == 30
    (file,) = found["token-links"].inputFiles()
    held = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert held.num_rows == 30 and held.num_row_groups > 1
