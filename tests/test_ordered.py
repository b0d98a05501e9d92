"""Dense index, order checks and quantiles against brute force."""

import random

import numpy as np
import pytest
from millrace.operators import quantiles as Q
from millrace.operators.order import flag_out_of_order, row_index


@pytest.mark.parametrize("buckets", [None, 1, 37])
def test_row_index_is_dense(spark, buckets):
    rnd = random.Random(1)
    data = [(rnd.choice([None, "a", "b", "b", "b"]), i, rnd.random()) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, i long, x double").repartition(5)
    got = row_index(df, ["k", "i"], "n", buckets).collect()
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert [(r["k"], r["i"], r["x"]) for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1000))


def brute(data, decreasing, strictly):
    """data: (p, o, v) -> set of (p, o) out of order."""
    last, bad = {}, set()
    for p, o, v in sorted(data, key=lambda t: (repr(t[0]), t[1])):
        if v is None:
            continue
        if p in last:
            b = last[p]
            ok = (v < b if strictly else v <= b) if decreasing else (v > b if strictly else v >= b)
            if not ok:
                bad.add((p, o))
        last[p] = v
    return bad


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("per_bucket", [None, 9, 60])
@pytest.mark.parametrize("decreasing, strictly", [(False, False), (True, True)])
def test_out_of_order(spark, seed, per_bucket, decreasing, strictly):
    rnd = random.Random(seed)
    # One partition holds half of the rows; long runs of nulls cross bucket edges; a null partition.
    data = []
    for o in range(600):
        p = rnd.choice([1, 1, 1, 2, 3, None])
        v = None if 100 < o < 200 or rnd.random() < 0.2 else rnd.randint(0, 50)
        data.append((p, o, v))
    df = spark.createDataFrame(data, "p int, o long, v int").repartition(4)
    got = flag_out_of_order(df, "v", ["o"], ["p"], "bad", decreasing, strictly, per_bucket).collect()
    assert len(got) == len(data)
    assert {(r["p"], r["o"]) for r in got if r["bad"]} == brute(data, decreasing, strictly)


@pytest.mark.parametrize("per_bucket", [None, 11])
def test_out_of_order_without_partition(spark, per_bucket):
    rnd = random.Random(5)
    data = [(0, o, None if 40 < o < 90 else rnd.randint(0, 9)) for o in range(300)]
    df = spark.createDataFrame([(o, v) for _, o, v in data], "o long, v int").repartition(3)
    got = flag_out_of_order(df, "v", ["o"], None, "bad", rows_per_bucket=per_bucket).collect()
    assert {(0, r["o"]) for r in got if r["bad"]} == brute(data, False, False)


@pytest.mark.parametrize("per_segment", [None, 40, 200])
@pytest.mark.parametrize("decreasing, strictly", [(False, False), (False, True), (True, False), (True, True)])
def test_ties_follow_the_least_breaking_order(spark, per_segment, decreasing, strictly):
    """Half of all rows share one order key, and most of those one value too."""
    rnd = random.Random(11)
    data = [(i, 7 if i % 2 else rnd.randint(0, 20), None if rnd.random() < 0.1 else 5 if i % 4 == 1 else rnd.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(data, "i long, o int, v int").repartition(6)
    got = flag_out_of_order(df, "v", ["o"], None, "bad", decreasing, strictly, per_segment).collect()
    assert sorted(r["i"] for r in got) == list(range(2000))
    last, want = None, []
    for _, o, v in sorted((t for t in data if t[2] is not None), key=lambda t: (t[1], -t[2] if decreasing else t[2])):
        if last is not None and not ((v < last if strictly else v <= last) if decreasing else (v > last if strictly else v >= last)):
            want.append((o, v))
        last = v
    assert sorted((r["o"], r["v"]) for r in got if r["bad"]) == sorted(want)


def test_segments_split_one_hot_order_key(spark, monkeypatch):
    """190,000 of 200,000 rows alike: no segment holds more than a few shares. No Python in the plan."""
    from millrace.operators import order

    kept = {}
    real = order.store
    monkeypatch.setattr(order, "store", lambda df, label: kept.setdefault("df", real(df, label)))
    df = spark.range(0, 200_000, 1, 40).selectExpr("if(id % 20 = 0, id, 1) as o", "1 as v")
    got = flag_out_of_order(df, "v", ["o"], rows_per_bucket=10_000, strictly=True)
    assert "Python" not in got._jdf.queryExecution().toString()
    assert got.where("_out_of_order").count() == 199_999
    sizes = [r["count"] for r in kept["df"].groupBy((kept["df"]["_at"] / 2**33).cast("int").alias("s")).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 30_000


@pytest.mark.parametrize("decreasing, strictly", [(False, False), (True, True)])
def test_small_segments_do_not_multiply_range_partitions(spark, monkeypatch, decreasing, strictly):
    """2,000 segments wanted: Spark samples for far fewer partitions. Nulls fill whole range partitions."""
    from millrace.operators import order

    kept = {}
    real = order.store
    monkeypatch.setattr(order, "store", lambda df, label: kept.setdefault("df", real(df, label)))
    rnd = random.Random(17)
    data = []
    for o in range(40_000):
        v = None if 8_000 < o < 14_000 or rnd.random() < 0.2 else rnd.randint(0, 50)
        data.append((1 if o < 30_000 else rnd.choice([2, 3, None]), o, v))
    df = spark.createDataFrame(data, "p int, o long, v int").repartition(4)
    got = flag_out_of_order(df, "v", ["o"], ["p"], "bad", decreasing, strictly, 20)
    assert got.columns == ["p", "o", "v", "bad"]
    rows = got.collect()
    assert sorted((r["o"], r["p"], r["v"]) for r in rows) == [(o, p, v) for p, o, v in data]
    assert {(r["p"], r["o"]) for r in rows if r["bad"]} == brute(data, decreasing, strictly)
    parts = kept["df"].selectExpr("shiftright(_at, 33) as part").distinct().count()
    assert 15 <= parts <= 100


@pytest.mark.parametrize("fetch", [10, 200, 10**6])
def test_exact_quantiles(spark, fetch):
    rnd = np.random.default_rng(3)
    values = np.concatenate([rnd.normal(size=2000), np.full(1500, 0.25), -np.exp(rnd.normal(size=500) * 4)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 0.999, 1.0]
    n, got = Q.exact_quantiles(df, "x", probs, fetch)
    assert n == len(values)
    assert got == pytest.approx(list(np.quantile(values, probs)))


def test_quantiles_of_nothing(spark):
    assert Q.exact_quantiles(spark.range(0).selectExpr("cast(id as double) as x"), "x", [0.5]) == (0, [None])


@pytest.mark.parametrize("hold", [8, Q.HOLD])
def test_quantiles_of_wide_decimals_that_share_a_double(spark, hold):
    from decimal import Decimal

    base = 12345678901234567890123456789012345678
    texts = [str(base + (i * 7919) % 1000 * (1 if i % 3 else 10**9)) for i in range(701)]
    for scale in (0, 2, 18):
        df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
        df = df.selectExpr(f"cast(concat(left(t, {38 - scale}), '.', right(t, {scale})) as decimal(38,{scale})) as d")
        values = sorted(Decimal(f"{t[:38 - scale]}.{t[38 - scale:]}") for t in texts)
        n, got = Q.exact_quantiles(df, "d", [0.0, 0.25, 0.5, 1.0], hold)
        assert (n, got) == (701, [values[0], values[175], values[350], values[-1]])


def test_quantiles_of_ties_short_decimals_infinity_and_nan(spark):
    from decimal import Decimal

    df = spark.range(0, 30_000, 1, 7).selectExpr(
        "if(id < 29990, 5, id) as tie", "case when id = 0 then double('-inf') when id = 1 then double('inf') when id = 2 then double('nan') else double(id) end as x",
        "if(id < 29990, 5, id) as `a ``b`",
    )
    got = Q.exact_quantiles_of(df, [("tie", [0.5, 1.0]), ("x", [0.0, 0.5, 1.0]), ("a `b", [0.999])], 50)
    assert got[0] == (30_000, [5, 29_999])
    assert got[1] == (29_999, [-np.inf, 15_001.0, np.inf])  # -inf, 3, 4, ...
    assert got[2] == (30_000, [5])
    small = spark.range(1000).selectExpr("cast(id / 1000 as decimal(18,18)) as d")
    assert Q.exact_quantiles(small, "d", [0.25], 20)[1] == [Decimal("0.24975")]


def test_all_ranks_of_all_columns_share_their_scans(spark, monkeypatch):
    scans = []
    real = Q._scan
    monkeypatch.setattr(Q, "_scan", lambda df, sqls: scans.append(len(sqls)) or real(df, sqls))
    df = spark.range(0, 400_000, 1, 8).selectExpr("id * 7919 % 400000 as a", "double(id) / 3 as b", "-id as c")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = Q.exact_quantiles_of(df, [("a", probs), ("b", probs), ("c", [0.5])])
    assert len(scans) == 3  # sketches, counts, the value itself
    assert [float(v) for v in got[0][1]] == pytest.approx([p * 399_999 for p in probs])
    assert got[1][1] == pytest.approx([p * 399_999 / 3 for p in probs])
    assert float(got[2][1][0]) == -199_999.5
