"""Edge cases of checks, the report and the split."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import report as report_module
from millrace.operators.report import run_checks
from millrace.operators.rules import CHECKS, check, spark_datetime_pattern, RowRule


def control(seq, name, threshold=None, ignore="Y", active="Y", **params):
    return {
        "seq_no": seq, "check": name, "parameters": params, "threshold_bad_records": threshold,
        "ignore_bad_records": ignore, "active": active, "type": "pre_check",
    }


@pytest.fixture
def df(spark):
    data = [(1, "a", 1.0), (2, None, 2.0), (2, "b", None), (3, "b", 50.0), (4, "c", float("nan"))]
    return spark.createDataFrame(data, "k int, s string, x double")


def one(df, *args, **kw):
    return run_checks(df, [control(1, *args, **kw)]).results[0]


def test_empty_frame_passes(df):
    none = df.limit(0)
    run = run_checks(none, [
        control(1, "column_values_to_not_be_null", column="s"),
        control(2, "column_values_to_be_unique", column="k"),
        control(3, "column_mean_to_be_between", column="x", min_value=1),
        control(4, "column_median_to_be_between", column="x", min_value=1),
        control(5, "column_values_to_be_increasing", column="x", order_by="k"),
        control(6, "column_most_common_value_to_be_in_set", column="s", value_set=["a"]),
        control(7, "column_proportion_of_unique_values_to_be_between", column="s", min_value=0.5),
        control(8, "column_distinct_values_to_be_in_set", column="s", value_set=["a"]),
    ])
    assert {r["seq_no"]: r["result"] for r in run.results} == {i: "PASS" for i in range(1, 9)}
    assert all(r["element_count"] == 0 for r in run.results)
    assert all(r["unexpected_percent"] in (None, 0.0) for r in run.results)


def test_all_null_column(spark):
    df = spark.range(3).selectExpr("cast(null as string) as s")
    r = one(df, "column_values_to_be_in_set", column="s", value_set=["a"])
    assert (r["result"], r["missing_count"], r["unexpected_percent"]) == ("PASS", 3, 0.0)


def test_no_active_check(df):
    run = run_checks(df, [control(1, "column_values_to_not_be_null", active="N", column="s")])
    assert [r["result"] for r in run.results] == [None]
    assert run.passed() and run.good().count() == 5 and run.bad().count() == 0
    assert run_checks(df, []).passed()


def test_bad_parameters_raise(df):
    for name, params in (
        ("column_values_to_not_be_null", {"column": "s", "colour": 1}),
        ("column_values_to_not_be_null", {"column": "nope"}),
        ("no_such_check", {}),
        ("column_values_to_be_increasing", {"column": "x", "order_by": []}),
    ):
        with pytest.raises(ValueError):
            run_checks(df, [control(1, name, **params)])
    with pytest.raises(ValueError):
        run_checks(df, [control(1, "reconciliation", aggregation="sum", source_column="x", target_column="x")]).results


def test_expect_prefix_is_accepted(df):
    assert one(df, "expect_column_to_exist", column="k")["result"] == "PASS"


def test_threshold_uses_the_whole_percent(spark):
    df = spark.range(1000).selectExpr("case when id < 339 then null else id end as v")
    r = one(df, "column_values_to_not_be_null", threshold=33, column="v")
    assert (r["result"], r["threshold_violated"], r["bad_records_count"]) == ("PASS", "Y", 339)
    r = one(df, "column_values_to_not_be_null", threshold=32, column="v", ignore="N")
    assert (r["result"], r["threshold_violated"], r["bad_records_count"]) == ("FAIL", "N", 0)
    r = one(df, "column_values_to_not_be_null", column="v")
    assert (r["result"], r["threshold_violated"]) == ("FAIL", "N")


def test_split_needs_a_failing_check(df):
    lenient = control(1, "column_values_to_not_be_null", threshold=50, column="s")
    run = run_checks(df, [lenient])
    assert run.passed() and run.good().count() == 5 and run.bad().count() == 0
    # With a failing check the lenient one rejects its rows too.
    run = run_checks(df, [lenient, control(2, "column_values_to_be_between", column="k", max_value=3)])
    assert sorted(run.rejecting) == [1, 2]
    assert sorted(r["k"] for r in run.bad().collect()) == [2, 4]
    assert run.good().count() == 3
    # A failing check that does not ignore bad records rejects nothing.
    run = run_checks(df, [control(2, "column_values_to_be_between", ignore="N", column="k", max_value=3)])
    assert not run.passed() and run.bad().count() == 0 and run.good().count() == 5


@pytest.mark.parametrize("limit", [0, 10**6])
def test_repeated_keys_by_both_joins(spark, monkeypatch, limit):
    """Broadcast of the repeated keys, and hot keys broadcast with the rest shuffled."""
    monkeypatch.setattr(report_module, "BROADCAST_KEYS", limit)
    monkeypatch.setattr(report_module, "HOT_KEYS", 3)
    df = spark.range(300).selectExpr(
        "id", "case when id < 100 then 7 when id < 200 then id div 2 when id < 210 then null else id end as k", "id % 2 as j"
    )
    run = run_checks(df, [control(1, "column_values_to_be_unique", column="k"), control(2, "compound_columns_to_be_unique", column_list=["k", "j"])])
    flagged = {r["id"]: r["_dq_failed"] for r in run.flagged().collect()}
    assert len(flagged) == 300
    for i, failed in flagged.items():
        assert (1 in failed) == (i < 200)
        # k is null from 200 to 209: j alone repeats there, which is no missing record.
        assert (2 in failed) == (i < 100 or 200 <= i < 210)
    assert run.bad().count() == 210


def test_nan_is_missing(df):
    run = run_checks(df, [
        control(1, "column_values_to_not_be_null", column="x"), control(2, "column_max_to_be_between", column="x", max_value=50),
        control(3, "column_sum_to_be_between", column="x", min_value=53, max_value=53), control(4, "column_values_to_be_between", column="x", max_value=49),
        control(5, "reconciliation", aggregation="count", source_column="x", target_column="x"),
        control(6, "column_median_to_be_between", column="x", min_value=2, max_value=2),
    ], source=df.where("not isnan(x)"))
    got = {r["seq_no"]: (r["result"], r["missing_count"], r["unexpected_count"]) for r in run.results}
    assert got == {1: ("FAIL", 0, 2), 2: ("PASS", 2, None), 3: ("PASS", 2, None), 4: ("FAIL", 2, 1), 5: ("PASS", None, None), 6: ("PASS", 2, None)}


def test_mostly(df):
    assert one(df, "column_values_to_not_be_null", column="s", mostly=0.8)["result"] == "PASS"
    assert one(df, "column_values_to_not_be_null", column="s", mostly=0.9)["result"] == "FAIL"


def test_types(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", "2024-01-01"), (None, None)], "a string, b string")
    assert one(df, "column_values_to_be_of_type", column="a", type_="int")["unexpected_count"] == 1
    assert one(df, "column_values_to_be_of_type", column="a", type_="float")["unexpected_count"] == 0
    assert one(df, "column_values_to_be_in_type_list", column="b", type_list=["int", "date"])["unexpected_count"] == 1
    assert one(df, "column_values_to_be_in_type_list", column="b", datatype="char")["unexpected_count"] == 0
    with pytest.raises(ValueError):
        run_checks(df, [control(1, "column_values_to_be_of_type", column="a", type_="money")])


def test_strftime_patterns():
    assert spark_datetime_pattern("%Y-%m-%d") == "yyyy-M-d"
    assert spark_datetime_pattern("%Y%m%dT%H:%M") == "yyyyMMdd'T'H:m"
    with pytest.raises(ValueError):
        spark_datetime_pattern("%Q")


def test_strftime_values(spark):
    df = spark.createDataFrame([("2024-1-5",), ("2024-02-30",), ("05.01.2024",), (None,)], "d string")
    assert one(df, "column_values_to_match_strftime_format", column="d", strftime_format="%Y-%m-%d")["unexpected_count"] == 2
    assert one(df, "column_values_to_match_strftime_format", column="d", strftime_format="%d.%m.%Y")["unexpected_count"] == 2


def test_most_common_with_ties(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",)], "s string")
    assert one(df, "column_most_common_value_to_be_in_set", column="s", value_set=["a"])["result"] == "FAIL"
    assert one(df, "column_most_common_value_to_be_in_set", column="s", value_set=["a"], ties_okay=True)["result"] == "PASS"
    assert one(df, "column_most_common_value_to_be_in_set", column="s", value_set=["c"], ties_okay=True)["result"] == "FAIL"


def test_approximate_variants(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    assert one(df, "column_unique_value_count_to_be_between", column="x", min_value=800, max_value=1200, approximate=True)["result"] == "PASS"
    assert one(df, "column_median_to_be_between", column="x", min_value=480, max_value=520, approximate=True)["result"] == "PASS"


def test_own_check(df):
    @check("column_values_to_be_even")
    def even(df, column):
        from pyspark.sql import functions as F

        return RowRule(column, F.col(column) % 2 != 0)

    try:
        assert one(df, "column_values_to_be_even", column="k")["unexpected_count"] == 2
    finally:
        del CHECKS["column_values_to_be_even"]


def test_one_scan_for_fused_checks(df):
    """Any number of row and total checks is one aggregate."""
    run = run_checks(df, [control(i, "column_values_to_not_be_null", column=c) for i, c in enumerate("ksx")] + [
        control(9, "column_mean_to_be_between", column="x"), control(10, "table_row_count_to_equal", value=5)])
    plan = run.report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 1


@pytest.mark.parametrize("values", [[1e-7, 4e-7], [1e23, -1e23, 0.25], [0.1] * 10, [-1.75, 0.5], [-0.25], [-0.5, -0.5], [], [None], [1e300, 1e300], [5, 7]])
def test_exact_sums(spark, values):
    from fractions import Fraction

    from millrace.functions.exact import mean_text, sum_number, sum_text

    kind = "long" if values == [5, 7] else "double"
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    text, number, mean = df.agg(*[F.expr(f("v", df.schema["v"].dataType)) for f in (sum_text, sum_number, mean_text)]).first()
    known = [v for v in values if v is not None]
    if not known:
        assert text is None and number is None and mean is None
        return
    exact = sum((Fraction(repr(v)) for v in known), Fraction(0))
    if abs(exact) < 10**30:
        assert abs(Fraction(text) - exact) <= Fraction(1, 10**6) * abs(exact) and abs(number - float(exact)) <= 1e-9 * abs(float(exact))
        if values != [1e23, -1e23, 0.25]:
            assert Fraction(text) == exact
    assert abs(Fraction(mean) - exact / len(known)) <= abs(exact) / 10**9


def test_large_value_does_not_stop_the_report(spark):
    df = spark.createDataFrame([(1, 1e23), (2, 1e300)], "id int, v double")
    got = [r.result for r in run_checks(df, [
        {"seq_no": 1, "check": "column_sum_to_be_between", "parameters": {"column": "v", "min_value": 0}},
        {"seq_no": 2, "check": "multicolumn_sum_to_equal", "parameters": {"column_list": ["v", "id"], "sum_total": 0}},
        {"seq_no": 3, "check": "column_max_to_be_between", "parameters": {"column": "v", "max_value": 1e301}},
        {"seq_no": 4, "check": "column_values_to_not_be_null", "parameters": {"column": "id"}},
    ]).report.orderBy("seq_no").collect()]
    assert got == ["PASS", "FAIL", "PASS", "PASS"]


@pytest.mark.parametrize("fetch", [50_000, 3])
def test_quantiles_keep_their_type(spark, fetch):
    from decimal import Decimal

    from millrace.operators.quantiles import exact_quantiles

    big = 9007199254740993
    df = spark.createDataFrame([(big + 2 * (i % 40), Decimal(i) / 1000) for i in range(201)], "k long, d decimal(20,3)").repartition(4)
    ks, ds = sorted(big + 2 * (i % 40) for i in range(201)), [Decimal(i) / 1000 for i in range(201)]
    assert exact_quantiles(df, "k", [0.0, 0.5, 1.0], fetch) == (201, [ks[0], ks[100], ks[200]])
    assert exact_quantiles(df, "d", [0.25, 0.5], fetch) == (201, [ds[50], ds[100]])
    assert exact_quantiles(df.limit(2).selectExpr("k"), "k", [0.5], fetch)[0] == 2
    two = spark.createDataFrame([(big,), (big + 1,)], "k long")
    assert exact_quantiles(two, "k", [0.5])[1] == [Decimal(big) + Decimal("0.5")]


def test_row_sums_of_large_and_small_numbers(spark):
    big = 5 * 10**18
    df = spark.createDataFrame([(big, 10**9), (big, 0), (2**62, 3)], "a long, b long")
    from millrace.functions.exact import row_sum_equals

    def sums(df, columns, total):
        return [r[0] for r in df.select(row_sum_equals(columns, [df.schema[c].dataType for c in columns], total)).collect()]

    assert sums(df, ["a", "b"], big) == [False, True, False]
    assert sums(df, ["a", "b"], 2**62 + 3) == [False, False, True]
    tiny = spark.createDataFrame([(1e-25, 1e-25), (1e-25, 3e-25), (1e-25, None)], "a double, b double")
    assert sums(tiny, ["a", "b"], 4e-25) == [False, True, None]
    wide = df.limit(1).selectExpr("cast('1000000000000000000.25' as decimal(38,18)) as a", "cast('-0.5' as decimal(38,30)) as b")
    assert sums(wide, ["a", "b"], "999999999999999999.75") == [True] and sums(wide, ["a", "b"], 10**18) == [False]


def test_totals_keep_fractions_of_large_and_tiny_numbers(spark):
    from millrace.functions.exact import number_text, sum_text
    from millrace.operators.reconcile import Recon, reconcile

    df = spark.sql("select cast(v as decimal(38,18)) as v from values ('1000000000000000000.25'), ('2000000000000000000.5'), ('-0.125') t(v)")
    kind = df.schema["v"].dataType
    text, low, high = df.agg(*[F.expr(x) for x in (sum_text("v", kind), number_text("min(v)", kind), number_text("max(v)", kind))]).first()
    assert (text, low, high) == ("3000000000000000000.625000", "-0.125000", "2000000000000000000.500000")
    for kind in ("double", "decimal(38,30)"):
        one, four = (spark.sql(f"select cast({v} as {kind}) as v") for v in ("1E-25", "4E-25"))
        recons = [Recon(i, k, "v", "v") for i, k in enumerate(("sum", "avg", "min", "max"))]
        assert {r.result for r in reconcile(one, four, recons).collect()} == {"FAIL"}
        assert {r.result for r in reconcile(four, four, recons).collect()} == {"PASS"}


@pytest.mark.parametrize("kind,values", [
    ("long", [2**63 - 1, 2**63 - 1, -(2**63), 5, -7] * 40),
    ("double", [0.1, -0.1, 1e9, 999999999.99, -1234567890123.45, 9.5e14, 0.000001, -0.000001, 1e-7, 123456789.123456, 2.0**53, 1e16 + 2, -0.0] * 9),
    ("double", [i / 100 for i in range(-500, 900)] + [i * 1e3 + 0.25 for i in range(300)]),
    ("decimal(12,2)", ["1234567890.12", "-0.01", "9999999999.99"] * 30),
    ("decimal(38,10)", ["9999999999999999999999999999.9999999999", "0.0000000001", "-5"]),
])
def test_totals_by_type_equal_exact_ones(spark, kind, values):
    from fractions import Fraction

    from millrace.functions.exact import sum_text

    given = [(str(v),) for v in values]
    df = spark.createDataFrame(given, "t string").selectExpr(f"cast(t as {kind}) as v").repartition(5)
    assert Fraction(df.agg(F.expr(sum_text("v", df.schema["v"].dataType))).first()[0]) == sum(Fraction(t) for t, in given)


def test_usual_numbers_take_the_quick_way(spark):
    """Money and counts are added as longs, not as decimals of every row."""
    from millrace.functions.exact import _quick

    df = spark.range(1000).selectExpr("cast(id * 1234.56 as double) as a", "cast(round(id * 0.07, 2) as double) as b", "id as c")
    for c in df.columns:
        assert df.where("not " + _quick(c, df.schema[c].dataType)[0]).count() == 0
    odd = spark.createDataFrame([(v,) for v in (1e-7, 1e300, float("nan"), float("inf"), -0.1, 1 / 3)], "v double").coalesce(1)
    assert [r[0] for r in odd.select(F.expr(_quick("v", odd.schema["v"].dataType)[0])).collect()] == [False, False, False, False, True, False]


@pytest.mark.parametrize("small", [True, False])
def test_sets_from_a_table(spark, tmp_path, monkeypatch, small):
    from millrace.operators import skew

    if not small:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(skew, "HOT_SAMPLE", 1.0)
    rows = [(i, "hot" if i < 900 else "rare" if i < 1000 else "off" if i < 1010 else None, float(i % 3)) for i in range(1020)]
    df = spark.createDataFrame(rows, "id long, t string, x double").repartition(5)
    names = spark.createDataFrame([("hot",), ("hot",), ("rare",), ("never",), (None,)], "name string")
    names.write.parquet(str(tmp_path / "names"))
    spark.sql("DROP TABLE IF EXISTS set_names")
    names.write.saveAsTable("set_names")
    sets = [names, {"path": str(tmp_path / "names"), "column": "name"}, {"table": "set_names", "column": "name"}]
    checks = ["column_values_to_be_in_set", "column_values_to_not_be_in_set", "column_distinct_values_to_be_in_set",
              "column_distinct_values_to_contain_set", "column_distinct_values_to_equal_set"]
    controls = [{"seq_no": i, "check": c, "parameters": {"column": "t", "value_set": sets[i % 3]}} for i, c in enumerate(checks)]
    run = run_checks(df, controls)
    got = [(r["element_count"], r["missing_count"], r["unexpected_count"], r["result"], r["details"]) for r in run.report.orderBy("seq_no").collect()]
    assert got == [
        (1020, 10, 10, "FAIL", None), (1020, 10, 1000, "FAIL", None), (1020, 10, None, "FAIL", "rows outside 10"),
        (1020, 10, None, "FAIL", "found 2 of 3 rows outside 10"), (1020, 10, None, "FAIL", "found 2 of 3 rows outside 10"),
    ]
    assert sorted(r["id"] for r in run_checks(df, controls[:1]).bad().collect()) == list(range(1000, 1010))
    assert sorted(r["id"] for r in run_checks(df, controls[1:2]).good().collect()) == list(range(1000, 1020))
    # a set of texts against numbers: what is no number is a member that no row holds; nan is none
    mixed = spark.createDataFrame([("0",), ("1.0",), ("1",), ("x",)], "v string")
    nans = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("nan"),)], "v double")
    of = lambda check, value_set: run_checks(df, [{"seq_no": 1, "check": check, "parameters": {"column": "x", "value_set": value_set}}]).results[0]
    assert of("column_distinct_values_to_contain_set", mixed)["details"] == "found 2 of 3 rows outside 340"
    assert of("column_distinct_values_to_equal_set", nans)["result"] == "PASS"
    assert of("column_values_to_be_in_set", mixed)["unexpected_count"] == 340
    empty = nans.limit(0)
    assert of("column_distinct_values_to_contain_set", empty)["result"] == "PASS"
    assert of("column_values_to_be_in_set", empty)["unexpected_count"] == 1020
    assert run_checks(df.limit(0), controls).results[3]["result"] == "FAIL"


def test_value_sets_that_name_no_column_are_refused(spark):
    df = spark.range(3)
    for value_set in ({"table": "t"}, {"column": "c"}, {"table": "t", "path": "p", "column": "c"}, spark.range(3).selectExpr("id", "id as b")):
        with pytest.raises(ValueError):
            run_checks(df, [{"seq_no": 1, "check": "column_values_to_be_in_set", "parameters": {"column": "id", "value_set": value_set}}])


def test_long_lists_need_one_aggregate(spark):
    df = spark.range(0, 5000, 1, 4).selectExpr("id", "cast(id as string) as t", "double(id) as x")
    checks = [
        {"seq_no": i, "check": "column_distinct_values_to_contain_set", "parameters": {"column": c, "value_set": values}}
        for i, (c, values) in enumerate([("id", list(range(0, 4000, 2))), ("t", [str(v) for v in range(2000)]), ("x", [1, 2.0, 2, 9999.5])])
    ]
    run = run_checks(df, checks)
    assert [r["details"] for r in run.results] == ["found 2000 of 2000 rows outside 3000", "found 2000 of 2000 rows outside 3000", "found 2 of 3 rows outside 4998"]
