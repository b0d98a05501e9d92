import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import decontaminate as d


@pytest.fixture(scope="module")
def leaks(text_of):
    rng = random.Random(8)
    items = [(i, text_of(900 + i, 20 + 7 * i).replace("\n", " ")) for i in range(12)]
    items += [(50, items[3][1]), (51, None), (52, ""), (53, "w1 w2"), (None, text_of(990, 44))]
    docs = []
    for i in range(60):
        text = text_of(i, 150)
        if i % 2:
            words = rng.choice(items[:13])[1].split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = "changed"
            at = rng.randrange(len(text))
            text = text[:at] + " " + " ".join(words).upper() + ", " + text[at:]
        docs.append((i, text))
    return docs + [(97, items[-1][1]), (None, items[2][1]), (98, None), (99, "w1 w2"), (99, "w1 w2")], items


def naive(docs, items):
    found = Counter()
    for i, text in docs:
        words = d.words_of(text)
        for k, item in items:
            size, want = len(d.words_of(item)), Counter(d.shingles_of(d.words_of(item)))
            if size and len(words) >= size:
                best = max(d.similarity(Counter(d.shingles_of(words[a : a + size])), want) for a in range(len(words) - size + 1))
                if best >= 0.8:
                    found[i, k, round(best, 9)] += 1
    return found


def test_against_all_windows(spark, leaks):
    docs, items = leaks
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = naive(docs, items)
    for size in (d.ITEM_BYTES, 1500):
        got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in d.find_leaks(*given, item_bytes=size).collect())
        assert got == want
    dirty = {i for i, _, _ in want}
    kept = d.without_leaks(*given, item_bytes=1500).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(i) for i, _ in docs if i not in dirty)
    assert len(dirty) > 10


def test_multi_index_gives_all_within_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    for k in range(40):
        near = prints[k].copy()
        for b in rng.choice(64, int(rng.integers(1, 24)), replace=False):
            near ^= np.uint64(1 << int(b))
        got = d.MultiIndex(prints).within(near)
        assert got.tolist() == np.flatnonzero(np.bitwise_count(prints ^ near) <= d.RADIUS).tolist()


def test_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quite another thing than all of these")], "item_id long, text string")
    kept = d.without_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert d.find_leaks(no_docs, items).count() == 0
    assert d.find_leaks(odd_docs, items.where("false")).count() == 0
    assert d.without_leaks(odd_docs, items.where("false")).count() == odd_docs.count()
