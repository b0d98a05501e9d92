"""What the physical plans must look like, whatever the data size."""

import re

from pyspark.sql import functions as F

from millrace.functions.mask import mask_alpha
from millrace.operators.report import run_checks
from millrace.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["src_parquet"](spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in text
    scan = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "l_extendedprice" in scan and "l_tax" not in scan and "Exchange" not in text


def test_fused_checks_scan_once(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    checks = [{"seq_no": i, "check": name, "parameters": params} for i, (name, params) in enumerate([
        ("column_values_to_not_be_null", {"column": "o_custkey"}),
        ("column_values_to_be_in_set", {"column": "o_orderstatus", "value_set": ["O"]}),
        ("column_values_to_be_between", {"column": "o_totalprice", "min_value": 0}),
        ("column_mean_to_be_between", {"column": "o_totalprice"}),
        ("column_distinct_values_to_equal_set", {"column": "o_orderstatus", "value_set": ["O", "P"]}),
        ("table_columns_to_match_set", {"column_set": ["a"]}),
    ])]
    text = plan(run_checks(orders, checks).report)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1  # the one row of partial results
    assert "o_orderdate" not in next(line for line in text.splitlines() if "FileScan" in line)


def test_key_checks_on_one_column_share_a_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    checks = [
        {"seq_no": 1, "check": "column_values_to_be_unique", "parameters": {"column": "o_custkey"}},
        {"seq_no": 2, "check": "column_unique_value_count_to_be_between", "parameters": {"column": "o_custkey"}},
        {"seq_no": 3, "check": "column_proportion_of_unique_values_to_be_between", "parameters": {"column": "o_custkey"}},
    ]
    text = plan(run_checks(orders, checks).report)
    assert text.count("FileScan") == 1
    assert "Expand" not in text


def test_split_and_masks_do_not_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    run = run_checks(orders, [{"seq_no": 1, "check": "column_values_to_be_in_set", "parameters": {"column": "o_orderstatus", "value_set": ["O"]}}])
    assert "Exchange" not in plan(run.good()) and "Exchange" not in plan(run.bad())
    assert "Exchange" not in plan(mask_alpha(orders, ["o_orderstatus"]))


def test_small_lookup_is_broadcast(spark, sf):
    text = plan(QUERIES["auto_correct_left"](spark, sf))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_no_cross_join_anywhere(spark, sf):
    for name in ("dq_report", "recon_sum", "custom_check_report", "schema_compare", "one_to_one_map", "record_counts_recon", "chk_distinct_set"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_no_single_partition_window(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").withColumn("v", F.col("value"))
    run = run_checks(df, [{"seq_no": 1, "check": "column_values_to_be_increasing", "parameters": {"column": "v", "order_by": "event_id", "rows_per_bucket": 100}}])
    windows = [line for line in plan(run.flagged()).splitlines() if "Window [" in line]
    single = [line for line in windows if "windowspecdefinition(_segment" in line and "_at" not in line]
    assert len(windows) == 2 and len(single) == 1 and "last(_last" in single[0]  # over one row per segment


def test_single_partition_window_has_no_row_per_small_segment(spark):
    df = spark.range(1000).selectExpr("id as o", "id % 7 as v")
    run = run_checks(df, [{"seq_no": 1, "check": "column_values_to_be_increasing", "parameters": {"column": "v", "order_by": "o", "rows_per_bucket": 2}}])
    windows = [line for line in plan(run.flagged()).splitlines() if "Window [" in line]
    single = [line for line in windows if re.search(r"windowspecdefinition\(\w+#\d+L? ASC", line)]
    assert len(single) == 1 and "windowspecdefinition(_part#" in single[0]  # over one row per range partition


def test_compressible_table_is_not_broadcast(spark, tmp_path):
    """Its file is small, its rows are not."""
    from pyspark.sql import functions as F

    from millrace.operators.skew import BROADCAST_BYTES, fits_broadcast, join_unique, plan_bytes

    spark.range(90_000).select(F.col("id").alias("k"), F.expr("repeat('x', 1000)").alias("v")).write.parquet(f"{tmp_path}/wide")
    wide, left = spark.read.parquet(f"{tmp_path}/wide"), spark.range(50).toDF("j")
    assert plan_bytes(wide) < BROADCAST_BYTES and not fits_broadcast(wide)
    plan = join_unique(left, wide, {"j": "k"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert fits_broadcast(wide.select("k"))
