import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffixes


def naive(docs, length):
    seen = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for _, b in raw:
        for k in range(len(b) - length + 1):
            seen[b[k : k + length]] = seen.get(b[k : k + length], 0) + 1
    out = []
    for i, b in raw:
        covered = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                covered[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if covered[k] and not (k and covered[k - 1]))
        kept = bytes(c for c, m in zip(b, covered) if not m)
        out.append((i, len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def copies(text_of):
    """Passages in many places, near copies, periods, bytes of zero, text ends."""
    rng = random.Random(4)
    passages = [text_of(100 + i, 60)[: 150 + 30 * i] for i in range(6)]
    docs = []
    for i in range(70):
        text = text_of(i % 50, 80)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        if i % 9 == 0:
            at = rng.randrange(len(text) - 1)
            text = text[:at] + "é" + text[at + 1 :]
        docs.append((i, text))
    docs += [(100, "ab" * 400), (101, "ab" * 150 + "c"), (102, "x" * 201), (103, "x" * 199), (104, None), (105, "")]
    docs += [(106, "\0" * 260), (107, "q" + "\0" * 210), (108, passages[5]), (108, passages[5]), (None, passages[4])]
    return docs


@pytest.mark.parametrize("shard_bytes", [2 << 20, 4000])
def test_against_every_string(spark, copies, shard_bytes):
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    got = sorted((tuple(r) for r in suffixes.remove_repeats(docs, shard_bytes=shard_bytes).collect()), key=repr)
    assert got == naive(copies, 200)


def test_copies_between_other_texts_give_each_window_once(spark, text_of, monkeypatch):
    """A text that is a third of all rows, never beside a copy of itself, shares a passage with others."""
    passage = text_of(900, 90)[:420]
    hot = text_of(901, 60) + passage + text_of(902, 60)
    rows = []
    for i in range(150):
        other = text_of(i, 60)
        rows += [(3 * i, other), (3 * i + 1, hot), (3 * i + 2, passage + other if i < 3 else text_of(400 + i, 50))]
    kept = {}
    real = suffixes.store
    monkeypatch.setattr(suffixes, "store", lambda df, label: kept.setdefault(label, real(df, label)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in suffixes.remove_repeats(docs).collect()), key=repr)
    assert got == naive(rows, 200)
    windows = kept["surroundings-bytes"]
    assert 0 < windows.count() == windows.select("gram", "around").distinct().count() == windows.select("gram", "text").distinct().count()


def test_odd_documents(odd_docs, no_docs):
    got = sorted((tuple(r) for r in suffixes.remove_repeats(odd_docs).collect()), key=repr)
    assert got == naive([(r.doc_id, r.text) for r in odd_docs.collect()], 200)
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    rows = rng.integers(97, 99, (12, 90)).astype(np.uint8)
    rows[3] = rows[4]
    sizes = np.full(12, 90)
    sizes[5] = sizes[6] = 40
    rows[5:7, 40:] = 0
    group = np.arange(12) % 3
    group[4] = group[3]
    order, words = suffixes.suffix_array(rows, sizes, group)
    shared = suffixes.common_prefixes(order, words, sizes, group, 1000, sizes)
    real = [i for i in order if i % 90 < sizes[i // 90]]
    text = lambda i: rows[i // 90, i % 90 : sizes[i // 90]].tobytes()
    assert [(group[i // 90], text(i)) for i in real] == sorted((group[i // 90], text(i)) for i in real)
    before = {b: a for a, b in zip(order, order[1:])}
    for i in real:
        a = before.get(i)
        same = 0
        if a is not None and group[a // 90] == group[i // 90] and a % 90 < sizes[a // 90]:
            while same < min(len(text(a)), len(text(i))) and text(a)[same] == text(i)[same]:
                same += 1
        assert shared[i] == same


def test_each_string_has_one_owner(copies):
    texts = [(t or "").encode() for _, t in copies]
    owned = [np.zeros(len(t), int) for t in texts]
    grams = {}
    for w, p, gram, first, last in zip(*(x.tolist() for x in suffixes.anchors_of(texts))):
        owned[w][first : last + 1] += 1
        assert first <= p <= last + 200 - suffixes.GRAM and last <= p
        for k in range(first, last + 1):
            assert grams.setdefault(texts[w][k : k + 200], (gram, p - k)) == (gram, p - k)
    for t, n in zip(texts, owned):
        assert (n[: max(0, len(t) - 199)] == 1).all() and not n[max(0, len(t) - 199) :].any()
