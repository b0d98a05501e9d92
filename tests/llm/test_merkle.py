import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree long, pos long, leaf string, hash string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, n_chars):
    return sha(*[shown(v) for v in (row.doc_id, row.source, row.lang, n_chars, row.text)])


def raised(nodes, arity):
    """All levels, from the given nodes to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def way(levels, at, arity, node):
    """(what the node becomes at the top, its siblings)."""
    siblings = []
    for nodes in levels[:-1]:
        run = nodes[at // arity * arity : at // arity * arity + arity]
        slot = at % arity
        siblings += run[:slot] + run[slot + 1 :]
        node = sha(*run[:slot], node, *run[slot + 1 :])
        at //= arity
    return node, siblings


def brute(rows, arity, changed):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.n_chars))
    members = {lang: sorted((r for r in rows if r.lang == lang), key=order) for lang in langs}
    trees = {lang: raised([leaf_of(r, r.n_chars) for r in members[lang]], arity) for lang in langs}
    top = raised([trees[lang][-1][0] for lang in langs], arity)
    out = []
    for j, lang in enumerate(langs):
        for i, r in enumerate(members[lang]):
            node = leaf_of(r, r.n_chars + 1 if changed(r) and r.n_chars is not None else r.n_chars)
            node, low = way(trees[lang], i, arity, node)
            node, high = way(top, j, arity, node)
            root = top[-1][0]
            out.append((r.doc_id, leaf_of(r, r.n_chars), trees[lang][-1][0], root, sha(*low, *high), node, node == root))
    return sorted(out, key=repr)


def found(docs, **options):
    n = F.col("n_chars").cast("decimal(20,0)")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, given={"n_chars": F.when(changed, n + 1).otherwise(n)}, **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def changed(row):
    return row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0


@pytest.fixture(scope="module")
def rows(spark, text_of):
    """Null and empty fields, a null and an empty group, lone groups, repeated rows, a long text, clashing names."""
    rng = random.Random(4)
    langs = [None, "", "de", "en", "en", "en", "zh", "é", "𝄞"]
    made = [(i, text_of(i, 5), rng.choice(langs), f"s{i % 3}", i * 3, 1, 2, "x", "y") for i in range(300)]
    made += [(2**60 + 1, None, "en", None, 2**63 - 1, 1, 2, "x", "y"), (-5, "", "lone", "", None, 1, 2, "x", "y")]
    made += [made[3], made[3], (None, "a", "en", "s", 0, 1, 2, "x", "y"), (7, text_of(1, 50_000), "en", "s", 0, 1, 2, "x", "y")]
    return spark.createDataFrame(made, SCHEMA).repartition(7)


@pytest.mark.parametrize("arity,height", [(2, 12), (2, 3), (3, 2), (5, 1)])
def test_manifest_equals_a_plain_tree(rows, arity, height):
    assert found(rows, arity=arity, height=height) == brute(rows.collect(), arity, changed)


def test_storage_order_and_block_size_change_nothing(rows):
    assert found(rows, height=2) == found(rows.repartition(3).orderBy(F.desc("text")), height=12)


def test_root_tells_any_change(rows):
    one = {r[3] for r in found(rows)}
    assert len(one) == 1
    assert one != {r[3] for r in found(rows.withColumn("source", F.when(F.col("doc_id") == 9, "z").otherwise(F.col("source"))))}
    assert one != {r[3] for r in found(rows.withColumn("text", F.when(F.col("text") != "", F.col("text"))))}  # empty is not null


def test_empty_and_single(spark, rows):
    assert found(rows.limit(0)) == []
    one = rows.where("doc_id = -5")
    (got,) = found(one)
    assert got[1] == got[2] == got[3] == got[5] and got[4] == sha() and got[6]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_fold_resumes_the_state_of_the_slot(n):
    children = [sha(str(i)).encode() for i in range(n)]
    parent = merkle.Parent(children)
    assert parent.digest.decode() == sha(*[c.decode() for c in children])
    for slot in range(n):
        assert parent.fold(slot, b"new") == merkle.digest(*children[:slot], b"new", *children[slot + 1 :])
        assert parent.fold(slot, children[slot]) == parent.digest  # the kept states are not used up
