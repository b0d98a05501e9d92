import numpy as np
import pytest

from millrace.llm import packing
from millrace.llm.queries import TOKENIZER
from millrace.llm.tokens import token_ids


def checked(docs, got, window):
    """Every id in exactly one piece; sequences without gaps, full or of a power of two."""
    want = sorted(np.append(np.frombuffer(x, "<u2"), 2).astype("<u4").tobytes() for x in token_ids(TOKENIZER).encode(t for _, t in docs))
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or at < window and at & (at - 1) == 0
    whole = []
    for (_, total), some in pieces.items():
        starts = sorted(some, key=lambda r: (r.start, r.ids))
        times = sum(r.start == 0 for r in some)
        assert sum(r.length for r in some) == times * total
        if times == 1:
            assert [r.start for r in starts] == np.cumsum([0, *(r.length for r in starts[:-1])]).tolist()
            whole.append(b"".join(r.ids for r in starts))
    assert set(whole) <= set(want)
    assert sum(r.length for r in got) == sum(len(x) // 4 for x in want)


@pytest.mark.parametrize("shard_tokens, part_tokens", [(1_000_000, 8_000_000), (700, 3000)])
def test_pack(spark, text_of, shard_tokens, part_tokens):
    docs = [(i, text_of(i % 40, 5 + 37 * i % 400)) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = packing.pack(df, TOKENIZER, window=256, shard_tokens=shard_tokens, part_tokens=part_tokens).collect()
    checked(docs, got, 256)


def test_odd_documents(odd_docs, no_docs):
    got = packing.pack(odd_docs, TOKENIZER).collect()
    checked([(r.doc_id, r.text) for r in odd_docs.collect()], got, packing.WINDOW)
    assert {r.doc_id for r in got} == {r.doc_id for r in odd_docs.collect()}
    assert packing.pack(no_docs, TOKENIZER).count() == 0


@pytest.mark.parametrize("shard_tokens, part_tokens", [(1_000_000, 8_000_000), (700, 3000)])
def test_sequence_ids_survive_any_partitioning(spark, text_of, shard_tokens, part_tokens):
    docs = [(i, text_of(i % 40, 5 + 37 * i % 400)) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    packed = packing.pack(df, TOKENIZER, window=256, shard_tokens=shard_tokens, part_tokens=part_tokens)
    for partitions in (1, 3):
        checked(docs, packed.coalesce(partitions).collect(), 256)


def test_terms_equal_a_sorted_count():
    rng, terms = np.random.default_rng(3), packing.Terms(500)
    for n in (0, 1, 7, 300, 20_000):
        ids = rng.integers(0, 500, n).astype("<u2")
        term, count = terms.counted(ids)
        order = np.argsort(term)
        assert [x.tolist() for x in (term[order], count[order])] == [x.tolist() for x in np.unique(ids, return_counts=True)]
        assert sorted(terms.distinct(ids).tolist()) == np.unique(ids).tolist()


@pytest.mark.parametrize("ahead", [1, 2, 32])
def test_index_is_bm25(monkeypatch, ahead):
    monkeypatch.setattr(packing, "AHEAD", ahead)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 30, n) for n in (5, 20, 9, 40, 12)]
    df = np.bincount(np.concatenate([np.unique(x) for x in docs]), minlength=31)
    idf, mean = packing.inverse_frequency(df, len(docs)), np.mean([len(x) for x in docs])
    index = packing.Index(docs, idf, mean)
    index.unused[1] = False
    score = {}
    for i, x in enumerate(docs):
        score[i] = sum(
            np.log1p((5 - df[t] + 0.5) / (df[t] + 0.5)) * (x == t).sum() * 2.2 / ((x == t).sum() + 1.2 * (0.25 + 0.75 * len(x) / mean))
            for t in set(docs[3].tolist()) if t in x
        )
    assert list(index.near(docs[3])) == sorted((i for i in score if i != 1), key=lambda i: -score[i])


def test_like_goes_with_like(spark):
    """Two topics: windows are nearly pure."""
    topics = [[f"alpha{chr(97 + i)}" for i in range(20)], [f"zulu{chr(97 + i)}" for i in range(20)]]
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(rng.choice(topics[i % 2], 30))) for i in range(200)]
    got = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), TOKENIZER, window=1024).collect()
    mixed = {}
    for r in got:
        mixed.setdefault(r.sequence_id, set()).add(r.doc_id % 2)
    assert sum(len(x) == 1 for x in mixed.values()) >= len(mixed) - 3


def test_counts_are_summed_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 3)
    rows = [(np.arange(5, dtype="<i8") * i).tobytes() for i in range(20)]
    df = spark.createDataFrame([(bytearray(r),) for r in rows], "ids binary").repartition(20)
    assert packing._summed(df).tolist() == (np.arange(5) * sum(range(20))).tolist()
    assert packing._summed(df.where("false")).tolist() == []
