import math

import numpy as np
import pytest

from millrace.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, id long, cls long, size long, a long, b long, digest string"


def brute(rows, cosine=embeddings.COSINE):
    rows = list(rows)
    usable = []
    for r in rows:
        v = r.embedding
        fine = r.label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, float) / math.sqrt(sum(x * x for x in map(float, v))) if fine else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and usable[i] is not None and usable[j] is not None and rows[i].label == rows[j].label
             and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= cosine] for i in range(n)]
    component, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        least = min((rows[j].vec_id for j in group if rows[j].vec_id is not None), default=None)
        for j in group:
            component[j] = least
    return sorted(((r.vec_id, len(near[i]), component[i], r.vec_id == component[i]) for i, r in enumerate(rows)), key=repr)


def found(vectors, **options):
    got = embeddings.near_duplicates(vectors, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, 4, 5, "d") for i, v, label in rows], SCHEMA)


def near_ones(rng, centre, n, cosine):
    """Vectors at the given cosine from a centre."""
    centre = centre / np.linalg.norm(centre)
    for _ in range(n):
        off = rng.standard_normal(len(centre))
        off -= off @ centre * centre
        off /= np.linalg.norm(off)
        yield cosine * centre + math.sqrt(1 - cosine**2) * off


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        for n in (1, 2, 2, 3, 5, 8, 70, 150):
            centre = rng.standard_normal(32)
            for v in near_ones(rng, centre, n, 0.9915):  # two of them are at about 0.983
                rows.append((len(rows), [float(x) for x in v * rng.uniform(0.1, 9)], label))
    rows += [(1000 + i, [float(x) for x in rng.standard_normal(32)], 0) for i in range(150)]
    rows += [(2000 + i, rows[40][1], rows[40][2]) for i in range(120)]  # copies of one
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


@pytest.mark.parametrize("block", [4096, 40])
def test_links_and_components_equal_brute_force(spark, clustered, block):
    vectors = frame(spark, clustered).repartition(5)
    assert found(vectors, block=block) == brute(vectors.collect())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 0), (2, one, 0), (2, one, 0), (3, one, None), (4, one, 1), (5, [2.0, 4.0, 6.0], 0), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, 0.0], 0), (9, [0.0, -0.0, 0.0], 0), (10, [nan, 1.0, 1.0], 0), (11, [inf, 1.0, 1.0], 0), (12, [None, 1.0, 1.0], 0),
        (13, [None, 1.0, 1.0], 0), (14, [1.0, 2.0], 0), (15, [1.0, 2.0], 0), (None, one, 0), (16, [-1.0, -2.0, -3.0], 0),
        (17, [1e-38, 0.0, 1e38], 0), (18, [0.0, 1e-38, 3e38], 0), (19, [1e-44, 0.0, 0.0], 0), (20, [3e-44, 0.0, 0.0], 0),
        (21, [-0.0, 1.0, 0.0], 0), (22, [0.0, 1.0, 0.0], 0), (None, [9.0, 0.0, 1.0], 0), (None, None, None),
    ]
    vectors = frame(spark, rows)
    got = found(vectors)
    want = brute(vectors.collect())
    assert [r for r in got if r[0] is not None] == [r for r in want if r[0] is not None]
    assert sorted((r[1], r[2] or -1) for r in got if r[0] is None) == sorted((r[1], r[2] or -1) for r in want if r[0] is None)


def test_empty_table_and_doubles(spark, clustered):
    assert found(frame(spark, [])) == []
    vectors = frame(spark, clustered[:200]).selectExpr("vec_id", "cast(embedding as array<double>) as embedding", "cast(label as string) as label")
    assert found(vectors) == brute(vectors.collect())


def test_recall_at_the_threshold():
    """Pairs right at the threshold, hashed as 100,000 and as 100,000,000 vectors of a label would be."""
    rng = np.random.default_rng(9)
    for vectors in (10**5, 10**8):
        k, tables = embeddings.tables_for(vectors)
        one = rng.standard_normal((3000, 48))
        one /= np.linalg.norm(one, axis=1)[:, None]
        two = np.concatenate([list(near_ones(rng, v, 1, 0.98)) for v in one])
        a, b = (embeddings.bucket_numbers(x, k, tables, embeddings.WIDTH * math.sqrt(0.04)) for x in (one, two))
        assert (a == b).any(axis=1).mean() > 0.9995
        assert (a[:-1] == b[1:]).any(axis=1).mean() < 0.001  # strangers stay apart


def test_given_table_holds_no_lost_link(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert found(vectors) == brute(vectors.collect())
