import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash


def naive_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(prints, ids, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= bits) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), 1 << 62), x)
    return {int(p): least[find(i)] for i, p in enumerate(prints.view(np.int64))}


@pytest.fixture(scope="module")
def crowd():
    """Fingerprints in chains and one dense crowd around few centres."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(20)]
    found = {*centres, 0, 2**64 - 1, 7, 15}
    for k in range(900):
        x = centres[rng.randrange(20) if k % 3 else 0]
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        found.add(x)
    return np.array(sorted(found), np.uint64)


def test_fingerprint(text_of):
    for text in [None, "", "  ", "One", "One two", "a b c", "A b C d", text_of(5, 500), "é É \x1c x", "a " * 999]:
        assert simhash.fingerprint_of(text) == naive_fingerprint(text)


@pytest.mark.parametrize("cell", [16_384, 16])
def test_groups(spark, crowd, cell):
    ids = list(range(len(crowd), 0, -1))
    rows = spark.createDataFrame(list(zip(ids, crowd.view(np.int64).tolist())), "id long, fingerprint long")
    got = {r.fingerprint: r.component for r in simhash.groups(rows, 3, cell).collect()}
    assert got == naive_groups(crowd, ids, 3)


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_walk_finds_all_pairs_up_to_linking(crowd, bits):
    want = naive_groups(crowd, range(len(crowd)), bits)
    swap = lambda x: (x << np.uint64(32)) | (x >> np.uint64(32))
    a, b = simhash.walk(crowd, None, 0, 0, bits)
    turned = np.sort(swap(crowd))
    c, d = simhash.walk(turned, None, 0, 0, bits)
    edges = [*zip(a.tolist(), b.tolist()), *zip(swap(c).tolist(), swap(d).tolist())]
    assert all((x ^ y).bit_count() <= 64 for x, y in edges) and len(edges) <= 2 * len(crowd)
    root = {int(x): int(x) for x in crowd}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in edges:
        root[find(x)] = find(y)
    parts = {}
    for x in crowd.tolist():
        parts.setdefault(find(x), set()).add(want[np.uint64(x).astype(np.int64).item()])
    assert all(len(p) == 1 for p in parts.values()) and len(parts) == len(set(want.values()))


def test_walk_between_two_subtrees(crowd):
    top = crowd >> np.uint64(63)
    left, right = crowd[top == 0], crowd[top == 1]
    a, b = simhash.walk(left, right, 1, 1, 3)
    assert len(a) == len(b)


def test_odd_documents(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    of = {r.doc_id: (r.fingerprint, r.component_id) for r in got}
    assert of[0] == of[1] == of[2] == ("0" * 16, 0)
    assert of[4] == of[5] and of[4][1] == 4 and of[None][1] is None
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "6", "7", "8", "None"]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_long_path(spark):
    """A chain of fingerprints, each near the next only."""
    chain = [0]
    for i in range(40):
        chain.append(chain[-1] ^ (7 << (3 * (i % 20))))
    chain = sorted({*chain})
    rows = spark.createDataFrame([(i, c if c < 2**63 else c - 2**64) for i, c in enumerate(chain)], "id long, fingerprint long")
    assert {r.component for r in simhash.groups(rows, 3).collect()} == {0}
