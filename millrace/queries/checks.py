"""Row, key, order, total and schema checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.report import run_checks
from millrace.queries.base import DIRTY_ORDERS, Case, Shape, cases_sql, check_query, query, table

STATUS = "o_orderstatus"
NO_STATUS = "o_orderstatus is null"


def dec(sql: str) -> str:
    """A number as the report prints it."""
    return f"cast(cast(round({sql}, 4) as decimal(38,4)) as varchar)"


check_query(
    "chk_not_null", DIRTY_ORDERS,
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=10),
    Case("column_values_to_not_be_null", {"column": "o_totalprice"}, "o_totalprice", bad="o_totalprice is null", ignore="N"),
    Case("column_values_to_not_be_null", {"column": "o_custkey"}, "o_custkey", bad="o_custkey is null"),
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, mostly=0.9),
)
check_query(
    "chk_null", DIRTY_ORDERS,
    Case("column_values_to_be_null", {"column": STATUS}, STATUS, bad="o_orderstatus is not null", threshold=95),
    Case("column_values_to_be_null", {"column": "o_orderkey"}, "o_orderkey", bad="o_orderkey is not null"),
)
check_query(
    "chk_unique", DIRTY_ORDERS,
    Case("column_values_to_be_unique", {"column": "o_orderkey"}, "o_orderkey", "o_orderkey is null", "c > 1", threshold=3,
         base=f"SELECT *, count(*) over (partition by o_orderkey) as c FROM ({DIRTY_ORDERS.sql}) x"),
    Case("column_values_to_be_unique", {"column": STATUS}, STATUS, NO_STATUS, "o_orderstatus is not null and c > 1",
         base=f"SELECT *, count(*) over (partition by o_orderstatus) as c FROM ({DIRTY_ORDERS.sql}) x"),
)
check_query(
    "chk_in_set", DIRTY_ORDERS,
    Case("column_values_to_be_in_set", {"column": STATUS, "value_set": ["O", "P", "F"]}, STATUS, NO_STATUS,
         "o_orderstatus not in ('O','P','F')", threshold=4),
    Case("column_values_to_be_in_set", {"column": STATUS, "value_set": ["O", "P", "F", "BAD"]}, STATUS, NO_STATUS,
         "o_orderstatus not in ('O','P','F','BAD')"),
)
# Customer keys as a set: every seventh is put out of reach, every fifth is doubled.
KEY_SET = Shape("customer", "case when c_custkey % 7 = 0 then -c_custkey else c_custkey end as k", twice="c_custkey % 5 = 0")
IN_KEYS = f"SELECT o.*, k.k is not null as listed FROM ({DIRTY_ORDERS.sql}) o LEFT JOIN (SELECT DISTINCT k FROM ({KEY_SET.sql}) y) k ON o.o_custkey = k.k"
KEY_TOTALS = (
    f"(SELECT count(DISTINCT o.o_custkey) FROM ({DIRTY_ORDERS.sql}) o JOIN ({KEY_SET.sql}) k ON o.o_custkey = k.k)",
    f"(SELECT count(DISTINCT k) FROM ({KEY_SET.sql}) y)",
)
TABLE_SET_CASES = [
    Case("column_values_to_be_in_set", {"column": "o_custkey"}, "o_custkey", "o_custkey is null", "not listed", threshold=20, base=IN_KEYS),
    Case("column_values_to_not_be_in_set", {"column": "o_custkey"}, "o_custkey", "o_custkey is null", "listed", base=IN_KEYS),
    Case("column_values_to_be_in_set", {"column": "o_custkey"}, "o_custkey", "o_custkey is null", "not listed", mostly=0.5, base=IN_KEYS),
    Case("column_distinct_values_to_be_in_set", {"column": "o_custkey"}, "o_custkey", "o_custkey is null", base=IN_KEYS,
         ok="count(*) filter (where not listed) = 0", details="'rows outside ' || count(*) filter (where not listed)"),
    *[
        Case(f"column_distinct_values_to_{test}_set", {"column": "o_custkey"}, "o_custkey", "o_custkey is null", base=IN_KEYS,
             ok=f"{KEY_TOTALS[0]} = {KEY_TOTALS[1]}{more}",
             details=f"'found ' || {KEY_TOTALS[0]} || ' of ' || {KEY_TOTALS[1]} || ' rows outside ' || count(*) filter (where not listed)")
        for test, more in (("contain", ""), ("equal", " and count(*) filter (where not listed) = 0"))
    ],
]


def _table_set_checks(spark, sf_dir):
    controls = [c.control(i) for i, c in enumerate(TABLE_SET_CASES, 1)]
    for control in controls:
        control["parameters"] = {**control["parameters"], "value_set": KEY_SET.frame(spark, sf_dir)}
    return run_checks(DIRTY_ORDERS.frame(spark, sf_dir), controls)


@query("chk_in_set_table", cases_sql(TABLE_SET_CASES, DIRTY_ORDERS.sql))
def chk_in_set_table(spark, sf_dir):
    """Values against all customer keys, by row and by value."""
    return _table_set_checks(spark, sf_dir).report


@query("dq_split_set_table", f"SELECT {', '.join(e.split(' as ')[-1] for e in DIRTY_ORDERS.exprs)} FROM ({IN_KEYS}) d WHERE listed")
def dq_split_set_table(spark, sf_dir):
    """Good rows: those whose customer is in the set; the path form of a set is used."""
    spec = {"path": f"{sf_dir}/customer.parquet", "column": "c_custkey"}
    keys = KEY_SET.frame(spark, sf_dir)
    return run_checks(DIRTY_ORDERS.frame(spark, sf_dir), [
        {"seq_no": 1, "check": "column_values_to_be_in_set", "parameters": {"column": "o_custkey", "value_set": keys}},
        {"seq_no": 2, "check": "column_values_to_be_in_set", "parameters": {"column": "o_custkey", "value_set": spec}},
    ]).good()


check_query(
    "chk_not_in_set", DIRTY_ORDERS,
    Case("column_values_to_not_be_in_set", {"column": STATUS, "value_set": ["BAD"]}, STATUS, NO_STATUS, "o_orderstatus = 'BAD'"),
)
PRICE = "o_totalprice is null"
check_query(
    "chk_between", DIRTY_ORDERS,
    Case("column_values_to_be_between", {"column": "o_totalprice", "min_value": 0, "max_value": 400000}, "o_totalprice",
         PRICE, "o_totalprice < 0 or o_totalprice > 400000", threshold=30),
    Case("column_values_to_be_between", {"column": "o_totalprice", "min_value": -1, "strict_min": True}, "o_totalprice",
         PRICE, "o_totalprice <= -1"),
    Case("column_values_to_be_between", {"column": "o_custkey", "max_value": 10**9, "strict_max": True}, "o_custkey",
         "o_custkey is null", "o_custkey >= 1000000000"),
)
DOCS = Shape("documents", "doc_id", "lang", "source", "n_chars", "case when doc_id % 13 = 0 then null else text end as text")
check_query(
    "chk_len_between", DOCS,
    Case("column_value_lengths_to_be_between", {"column": "text", "min_value": 50, "max_value": 10000}, "text",
         "text is null", "length(text) < 50 or length(text) > 10000", threshold=50),
)
check_query(
    "chk_len_equal", DOCS,
    Case("column_value_lengths_to_equal", {"column": "lang", "value": 2}, "lang", "lang is null", "length(lang) <> 2"),
    Case("column_value_lengths_to_equal", {"column": "source", "value": 4}, "source", "source is null", "length(source) <> 4"),
)
PAGES = Shape("pages", "page_id", "html", "case when page_id % 11 = 0 then 'ftp://nowhere' else url end as url")
check_query(
    "chk_regex", PAGES,
    Case("column_values_to_match_regex", {"column": "url", "regex": "^https?://[a-z.]+/"}, "url", "url is null",
         "not regexp_matches(url, '^https?://[a-z.]+/')", threshold=5),
    Case("column_values_to_match_regex", {"column": "html", "regex": "<title>[^<]+</title>"}, "html", "html is null",
         "not regexp_matches(html, '<title>[^<]+</title>')"),
)
check_query(
    "chk_not_regex", PAGES,
    Case("column_values_to_not_match_regex", {"column": "url", "regex": "#[a-z]+$"}, "url", "url is null",
         "regexp_matches(url, '#[a-z]+$')"),
    Case("column_values_to_not_match_regex", {"column": "html", "regex": "<script"}, "html", "html is null",
         "regexp_matches(html, '<script')", ignore="N"),
)
check_query(
    "chk_regex_list", PAGES,
    Case("column_values_to_match_regex_list", {"column": "url", "regex_list": ["/en/", "/fr/", "^ftp"]}, "url", "url is null",
         "not (regexp_matches(url, '/en/') or regexp_matches(url, '/fr/') or regexp_matches(url, '^ftp'))"),
    Case("column_values_to_match_regex_list", {"column": "url", "regex_list": ["^http", "example"], "match_on": "all"}, "url",
         "url is null", "not (regexp_matches(url, '^http') and regexp_matches(url, 'example'))"),
    Case("column_values_to_not_match_regex_list", {"column": "url", "regex_list": ["^ftp", "#top$"]}, "url", "url is null",
         "regexp_matches(url, '^ftp') or regexp_matches(url, '#top$')"),
)
check_query(
    "chk_strftime", DIRTY_ORDERS,
    Case("column_values_to_match_strftime_format", {"column": "order_day", "strftime_format": "%Y-%m-%d"}, "order_day",
         "order_day is null", "try_strptime(order_day, '%Y-%m-%d') is null", threshold=5),
    Case("column_values_to_match_strftime_format", {"column": "order_day", "strftime_format": "%d/%m/%Y"}, "order_day",
         "order_day is null", "try_strptime(order_day, '%d/%m/%Y') is null"),
)
check_query(
    "chk_date_parseable", DIRTY_ORDERS,
    Case("column_values_to_be_dateutil_parseable", {"column": "order_day"}, "order_day", "order_day is null",
         "try_cast(order_day as timestamp) is null"),
)
EVENTS = Shape("events", "event_id", "user_id", "value", "ts",
               "case when event_id % 13 = 0 then '{\"k\": ' when event_id % 31 = 0 then null else props end as props")
check_query(
    "chk_json", EVENTS,
    Case("column_values_to_be_json_parseable", {"column": "props"}, "props", "props is null", "not json_valid(props)", threshold=8),
)
check_query(
    "chk_type_list", DIRTY_ORDERS,
    Case("column_values_to_be_in_type_list", {"column": STATUS, "datatype": "char"}, STATUS, NO_STATUS, "false", threshold=33),
    Case("column_values_to_be_in_type_list", {"column": "order_day", "type_list": ["date", "int"]}, "order_day",
         "order_day is null", "try_cast(order_day as date) is null and try_cast(order_day as bigint) is null"),
    Case("column_values_to_be_of_type", {"column": "o_totalprice", "type_": "float64"}, "o_totalprice", PRICE, "false"),
    Case("column_values_to_be_of_type", {"column": "o_orderkey", "type_": "str"}, "o_orderkey", "o_orderkey is null",
         "o_orderkey is not null"),
)
EVENTS_PREV = f"""SELECT *, lag(value) over (order by event_id) as before, lag(ts) over (partition by user_id order by event_id) as ts_before,
    lag(value) over (partition by user_id order by event_id) as user_before FROM ({EVENTS.sql}) x"""
check_query(
    "chk_increasing", EVENTS,
    Case("column_values_to_be_increasing", {"column": "value", "order_by": "event_id"}, "value", "value is null",
         "value < before", threshold=50, base=EVENTS_PREV),
    Case("column_values_to_be_increasing", {"column": "ts", "order_by": "event_id", "partition_by": "user_id", "strictly": True},
         "ts", "ts is null", "ts <= ts_before", base=EVENTS_PREV),
    Case("column_values_to_be_decreasing", {"column": "value", "order_by": ["event_id"], "partition_by": ["user_id"], "rows_per_bucket": 2000}, "value",
         "value is null", "value > user_before", base=EVENTS_PREV),
)
TIED = Shape("events", "case when event_id % 2 = 0 then 0 else event_id % 1000 end as place", "user_id", "event_type",
             "case when event_id % 11 = 0 then null when event_id % 4 = 0 then 0.5 else value end as value")
TIED_PREV = f"""SELECT *, last_value(value ignore nulls) over (order by place, value rows between unbounded preceding and 1 preceding) as before,
    last_value(value ignore nulls) over (order by place, value desc rows between unbounded preceding and 1 preceding) as above,
    last_value(value ignore nulls) over (partition by event_type order by place, value rows between unbounded preceding and 1 preceding) as type_before
    FROM ({TIED.sql}) x"""
check_query(
    "chk_increasing_ties", TIED,  # half of all rows share one place, half of those one value too
    Case("column_values_to_be_increasing", {"column": "value", "order_by": "place", "rows_per_bucket": 1000}, "value", "value is null",
         "value < before", threshold=1, base=TIED_PREV),
    Case("column_values_to_be_decreasing", {"column": "value", "order_by": "place", "rows_per_bucket": 1000}, "value", "value is null",
         "value > above", base=TIED_PREV),
    Case("column_values_to_be_increasing", {"column": "value", "order_by": "place", "partition_by": "event_type", "strictly": True, "rows_per_bucket": 700},
         "value", "value is null", "value <= type_before", base=TIED_PREV),
)
CONV = Shape("conversations", "conv_id", "role", "case when conv_id % 7 = 0 and turn = 2 then 0 else turn end as turn", "turn as place")
check_query(
    "chk_increasing_turns", CONV,
    Case("column_values_to_be_increasing", {"column": "turn", "order_by": "place", "partition_by": "conv_id", "strictly": True},
         "turn", "turn is null", "turn <= before",
         base=f"SELECT *, lag(turn) over (partition by conv_id order by place) as before FROM ({CONV.sql}) x"),
)
LINES = Shape("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus",
              "l_extendedprice", "l_discount", "l_tax",
              "case when l_orderkey % 41 = 0 then null else l_quantity end as l_quantity",
              "case when l_orderkey % 43 = 0 then null else l_partkey end as part2")
check_query(
    "chk_pair_gt", LINES,
    Case("column_pair_values_A_to_be_greater_than_B", {"column_A": "l_extendedprice", "column_B": "l_quantity"},
         "l_extendedprice,l_quantity", "l_extendedprice is null and l_quantity is null",
         "not (l_extendedprice is null and l_quantity is null) and not coalesce(l_extendedprice > l_quantity, false)", threshold=2),
    Case("column_pair_values_A_to_be_greater_than_B",
         {"column_A": "l_discount", "column_B": "l_tax", "or_equal": True, "ignore_row_if": "either_value_is_missing"},
         "l_discount,l_tax", "l_discount is null or l_tax is null", "l_discount < l_tax"),
)
check_query(
    "chk_pair_equal", LINES,
    Case("column_pair_values_to_be_equal", {"column_A": "l_partkey", "column_B": "part2"}, "l_partkey,part2",
         "l_partkey is null and part2 is null", "l_partkey is distinct from part2", threshold=2),
    Case("column_pair_values_to_be_equal", {"column_A": "l_partkey", "column_B": "part2", "ignore_row_if": "either_value_is_missing"},
         "l_partkey,part2", "l_partkey is null or part2 is null", "l_partkey <> part2"),
)
check_query(
    "chk_pair_in_set", LINES,
    Case("column_pair_values_to_be_in_set",
         {"column_A": "l_returnflag", "column_B": "l_linestatus", "value_pairs_set": [["A", "F"], ["R", "F"], ["N", "O"]]},
         "l_returnflag,l_linestatus", "l_returnflag is null and l_linestatus is null",
         "(l_returnflag, l_linestatus) not in (('A','F'),('R','F'),('N','O'))"),
)
check_query(
    "chk_compound_unique", LINES,
    Case("compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_linenumber"]}, "l_orderkey,l_linenumber",
         "l_orderkey is null and l_linenumber is null", "c > 1", threshold=60,
         base=f"SELECT *, count(*) over (partition by l_orderkey, l_linenumber) as c FROM ({LINES.sql}) x"),
    Case("compound_columns_to_be_unique", {"column_list": ["l_quantity", "part2"], "ignore_row_if": "any_value_is_missing"},
         "l_quantity,part2", "l_quantity is null or part2 is null", "l_quantity is not null and part2 is not null and c > 1",
         base=f"SELECT *, count(*) over (partition by l_quantity, part2) as c FROM ({LINES.sql}) x"),
)
check_query(
    "chk_unique_in_record", LINES,
    Case("select_column_values_to_be_unique_within_record", {"column_list": ["l_linenumber", "l_suppkey", "l_partkey"]},
         "l_linenumber,l_suppkey,l_partkey", "l_linenumber is null and l_suppkey is null and l_partkey is null",
         "l_linenumber = l_suppkey or l_linenumber = l_partkey or l_suppkey = l_partkey"),
)
REPEATED = "o_orderkey % 50 = 0"
check_query(
    "chk_unique_mostly", DIRTY_ORDERS,
    Case("column_values_to_be_unique", {"column": "o_orderkey"}, "o_orderkey", "o_orderkey is null", REPEATED, mostly=0.9),
    Case("column_values_to_be_unique", {"column": "o_orderkey"}, "o_orderkey", "o_orderkey is null", REPEATED, mostly=0.99),
    Case("compound_columns_to_be_unique", {"column_list": ["o_orderkey", "o_custkey"]}, "o_orderkey,o_custkey", "false", REPEATED, mostly=0.9),
)
check_query(
    "chk_multicol_sum", LINES,
    Case("multicolumn_sum_to_equal", {"column_list": ["l_discount", "l_tax"], "sum_total": 0.1}, "l_discount,l_tax",
         "l_discount is null and l_tax is null",
         "cast(l_discount as decimal(28,6)) + cast(l_tax as decimal(28,6)) <> cast('0.1' as decimal(28,6))", threshold=95),
)
check_query(
    "chk_row_count", DIRTY_ORDERS,
    Case("table_row_count_to_be_between", {"min_value": 1, "max_value": 10**12}, "", ok="count(*) between 1 and 1000000000000",
         details="cast(count(*) as varchar)", missing_null=True),
    Case("table_row_count_to_equal", {"value": 7}, "", ok="count(*) = 7", details="cast(count(*) as varchar)", missing_null=True),
)
ORDER_NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_day", "o_orderpriority"]
check_query(
    "chk_col_count", DIRTY_ORDERS,
    Case("table_column_count_to_equal", {"value": 6}, "", ok="true", details="'6'", missing_null=True),
    Case("table_column_count_to_be_between", {"min_value": 7}, "", ok="false", details="'6'", missing_null=True),
)
check_query(
    "chk_columns_match", DIRTY_ORDERS,
    Case("table_columns_to_match_ordered_list", {"column_list": ORDER_NAMES}, ",".join(ORDER_NAMES), ok="true",
         details=f"'{','.join(ORDER_NAMES)}'", missing_null=True),
    Case("table_columns_to_match_set", {"column_set": [*ORDER_NAMES, "extra"]}, ",".join(sorted([*ORDER_NAMES, "extra"])),
         ok="false", details="'extra'", missing_null=True),
    Case("column_to_exist", {"column": "order_day", "column_index": 4}, "order_day", ok="true", missing_null=True),
    Case("column_to_exist", {"column": "nope"}, "nope", ok="false", missing_null=True),
)

for short, sql in (("min", "min"), ("max", "max")):
    check_query(
        f"chk_{short}", DIRTY_ORDERS,
        Case(f"column_{short}_to_be_between", {"column": "o_totalprice", "min_value": 0, "max_value": 1000000}, "o_totalprice",
             PRICE, ok=f"{sql}(o_totalprice) between 0 and 1000000", details=dec(f"{sql}(o_totalprice)")),
        Case(f"column_{short}_to_be_between", {"column": STATUS, "min_value": "BAD", "max_value": "P"}, STATUS, NO_STATUS,
             ok=f"{sql}(o_orderstatus) between 'BAD' and 'P'", details=f"{sql}(o_orderstatus)"),
    )
DEC_SUM = "sum(cast(o_totalprice as decimal(28,6)))"
check_query(
    "chk_mean", DIRTY_ORDERS,
    Case("column_mean_to_be_between", {"column": "o_totalprice", "min_value": 1, "max_value": 10}, "o_totalprice", PRICE,
         ok=f"cast({DEC_SUM} as double) / count(o_totalprice) between 1 and 10",
         details=dec(f"cast({DEC_SUM} as double) / count(o_totalprice)")),
)
check_query(
    "chk_sum", DIRTY_ORDERS,
    Case("column_sum_to_be_between", {"column": "o_totalprice", "min_value": 0}, "o_totalprice", PRICE, ok=f"{DEC_SUM} >= 0", details=dec(DEC_SUM)),
)
TINY = Shape(
    "orders", "o_orderkey", "case when o_orderkey % 3 = 0 then cast(0.0000001 as double) else cast(-0.0000001 as double) end as a",
    "cast(0.0000001 as double) as b", "case when o_orderkey % 7 = 0 then cast('1.5e23' as double) else cast(0.0000004 as double) end as big",
)
SMALL_SUM = "sum(cast(cast(b as varchar) as decimal(38,20)))"
check_query(
    "chk_sum_small", TINY,
    Case("column_sum_to_be_between", {"column": "b", "min_value": 0.0000001}, "b", "b is null", ok=f"{SMALL_SUM} >= 0.0000001", details=dec(SMALL_SUM)),
    Case("column_sum_to_be_between", {"column": "b", "max_value": 0.00000009}, "b", "b is null", ok="false", details=dec(SMALL_SUM)),
    Case("column_sum_to_be_between", {"column": "big", "max_value": 1e24}, "big", "big is null", ok="count(*) filter (where big > 1) <= 6",
         details="cast(sum(cast(big / 1e15 as hugeint)) * cast(1000000000000000 as hugeint) as varchar) || '.0000'"),
)
check_query(
    "chk_multicol_sum_small", TINY,
    Case("multicolumn_sum_to_equal", {"column_list": ["a", "b"], "sum_total": 0}, "a,b", "a is null and b is null", "o_orderkey % 3 = 0", threshold=50),
    Case("multicolumn_sum_to_equal", {"column_list": ["big", "b"], "sum_total": 0.0000005}, "big,b", "b is null", "o_orderkey % 7 = 0", threshold=50),
)
BIG_KEYS = Shape("orders", "9007199254740993 + 2 * o_orderkey as k", "cast(o_orderkey as decimal(30,10)) / 7 as d")
_MIDDLE = """(SELECT sum(cast(k as hugeint)) FROM (SELECT k, row_number() over (order by k) as r, count(*) over () as n FROM (SELECT 9007199254740993 + 2 * o_orderkey as k FROM orders) x) y
    WHERE r in ((n + 1) // 2, n // 2 + 1))"""
_TWICE = "(SELECT case when count(*) % 2 = 1 then 1 else 2 end FROM orders)"
check_query(
    "chk_median_bigint", BIG_KEYS,
    Case("column_median_to_be_between", {"column": "k", "min_value": 9007199254740994}, "k", "k is null", ok="true",
         details=f"cast(any_value({_MIDDLE} // {_TWICE}) as varchar) || case when any_value({_MIDDLE} % {_TWICE}) = 1 then '.5000' else '.0000' end"),
)
check_query(
    "chk_stdev", DIRTY_ORDERS,
    Case("column_stdev_to_be_between", {"column": "o_totalprice", "min_value": 0, "max_value": 10**9, "strict_min": True}, "o_totalprice",
         PRICE, ok="stddev_samp(o_totalprice) > 0", details=dec("stddev_samp(o_totalprice)")),
)
check_query(
    "chk_median", DIRTY_ORDERS,
    Case("column_median_to_be_between", {"column": "o_totalprice", "min_value": 0, "max_value": 500000}, "o_totalprice", PRICE,
         ok="quantile_cont(o_totalprice, 0.5) between 0 and 500000", details=dec("quantile_cont(o_totalprice, 0.5)")),
)
PROBS = [0.01, 0.25, 0.5, 0.9]
check_query(
    "chk_quantiles", DIRTY_ORDERS,
    Case("column_quantile_values_to_be_between",
         {"column": "o_totalprice", "quantile_ranges": {"quantiles": PROBS, "value_ranges": [[None, 0], [0, 10**6], [0, 10**6], [0, 10]]}},
         "o_totalprice", PRICE, ok="false", details="concat_ws(',', " + ", ".join(dec(f"quantile_cont(o_totalprice, {p})") for p in PROBS) + ")"),
)
check_query(
    "chk_unique_count", DIRTY_ORDERS,
    Case("column_unique_value_count_to_be_between", {"column": STATUS, "min_value": 3, "max_value": 4}, STATUS, NO_STATUS,
         ok="count(distinct o_orderstatus) between 3 and 4", details=dec("count(distinct o_orderstatus)")),
    Case("column_unique_value_count_to_be_between", {"column": "o_custkey", "max_value": 10}, "o_custkey", "o_custkey is null",
         ok="count(distinct o_custkey) <= 10", details=dec("count(distinct o_custkey)")),
)
check_query(
    "chk_unique_prop", DIRTY_ORDERS,
    Case("column_proportion_of_unique_values_to_be_between", {"column": "o_custkey", "min_value": 0.05, "max_value": 1}, "o_custkey",
         "o_custkey is null", ok="count(distinct o_custkey) / count(o_custkey) between 0.05 and 1",
         details=dec("count(distinct o_custkey) / count(o_custkey)")),
)


def _set_details(values: str, size: int) -> str:
    found = f"count(distinct o_orderstatus) filter (where o_orderstatus in ({values}))"
    outside = f"count(*) filter (where o_orderstatus not in ({values}))"
    return f"'found ' || {found} || ' of {size} rows outside ' || {outside}"


check_query(
    "chk_distinct_set", DIRTY_ORDERS,
    Case("column_distinct_values_to_be_in_set", {"column": STATUS, "value_set": ["O", "P", "F"]}, STATUS, NO_STATUS, ok="false",
         details=_set_details("'O','P','F'", 3)),
    Case("column_distinct_values_to_contain_set", {"column": STATUS, "value_set": ["O", "X"]}, STATUS, NO_STATUS, ok="false",
         details=_set_details("'O','X'", 2)),
    Case("column_distinct_values_to_contain_set", {"column": STATUS, "value_set": ["O", "BAD"]}, STATUS, NO_STATUS, ok="true",
         details=_set_details("'O','BAD'", 2)),
    Case("column_distinct_values_to_equal_set", {"column": STATUS, "value_set": ["O", "P", "F", "BAD"]}, STATUS, NO_STATUS, ok="true",
         details=_set_details("'O','P','F','BAD'", 4)),
)
_LEVELS = f"""SELECT max(c) as top, count(*) filter (where c = big) as ties, max(case when c = big and v = 'P' then 1 else 0 end) as hit
    FROM (SELECT o_orderstatus as v, count(*) as c, max(count(*)) over () as big FROM ({DIRTY_ORDERS.sql}) x
    WHERE o_orderstatus is not null GROUP BY 1) y"""
check_query(
    "chk_most_common", DIRTY_ORDERS,
    Case("column_most_common_value_to_be_in_set", {"column": STATUS, "value_set": ["P"]}, STATUS, NO_STATUS,
         ok="max(hit) = 1 and max(ties) = 1", details="'count ' || max(top) || ' values ' || max(ties)",
         base=f"SELECT * FROM ({DIRTY_ORDERS.sql}) d, ({_LEVELS}) l"),
    Case("column_most_common_value_to_be_in_set", {"column": STATUS, "value_set": ["BAD"], "ties_okay": True}, STATUS, NO_STATUS,
         ok="false", details="'count ' || max(top) || ' values ' || max(ties)",
         base=f"SELECT * FROM ({DIRTY_ORDERS.sql}) d, ({_LEVELS}) l"),
)
check_query(
    "chk_threshold_edge", DIRTY_ORDERS,
    # The percent has a fraction: its whole part is within the limit, the percent itself is not.
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=5),
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=5, ignore="N"),
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=4),
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=0),
)

# ---------------------------------------------------------------- whole reports and splits

REPORT_CASES = [
    Case("column_values_to_not_be_null", {"column": STATUS}, STATUS, bad=NO_STATUS, threshold=5),
    Case("column_values_to_be_in_set", {"column": STATUS, "value_set": ["O", "P", "F"]}, STATUS, NO_STATUS,
         "o_orderstatus not in ('O','P','F')", threshold=1),
    Case("column_values_to_be_between", {"column": "o_totalprice", "min_value": 0}, "o_totalprice", PRICE, "o_totalprice < 0", ignore="N"),
    Case("column_values_to_match_strftime_format", {"column": "order_day", "strftime_format": "%Y-%m-%d"}, "order_day",
         "order_day is null", "try_strptime(order_day, '%Y-%m-%d') is null", active="N"),
    Case("column_values_to_be_unique", {"column": "o_orderkey"}, "o_orderkey", "o_orderkey is null", "c > 1",
         base=f"SELECT *, count(*) over (partition by o_orderkey) as c FROM ({DIRTY_ORDERS.sql}) x"),
    Case("column_mean_to_be_between", {"column": "o_totalprice", "min_value": 1}, "o_totalprice", PRICE,
         ok=f"cast({DEC_SUM} as double) / count(o_totalprice) >= 1", details=dec(f"cast({DEC_SUM} as double) / count(o_totalprice)")),
    Case("column_unique_value_count_to_be_between", {"column": "o_orderkey", "min_value": 1}, "o_orderkey", "o_orderkey is null",
         ok="true", details=dec("count(distinct o_orderkey)")),
    Case("column_values_to_be_in_set", {"column": STATUS, "value_set": ["O", "P", "F", "BAD"]}, STATUS, NO_STATUS,
         "o_orderstatus not in ('O','P','F','BAD')", type="post_check"),
    Case("table_row_count_to_be_between", {"min_value": 1}, "", ok="count(*) >= 1", details="cast(count(*) as varchar)",
         missing_null=True, type="post_check"),
]


@query("dq_report", cases_sql(REPORT_CASES, DIRTY_ORDERS.sql))
def dq_report(spark, sf_dir):
    """Pre- and post-check reports of one task, together."""
    df = DIRTY_ORDERS.frame(spark, sf_dir)
    controls = [c.control(i) for i, c in enumerate(REPORT_CASES, 1)]
    pre, post = (run_checks(df, controls, type=t).report for t in ("pre_check", "post_check"))
    return pre.unionByName(post, allowMissingColumns=True)


_SPLIT = f"""SELECT *, concat_ws(',', case when o_orderstatus is null then '1' end,
    case when o_orderstatus not in ('O','P','F') then '2' end,
    case when count(*) over (partition by o_orderkey) > 1 then '5' end) as dq_failed FROM ({DIRTY_ORDERS.sql}) x"""


def _split(spark, sf_dir):
    controls = [c.control(i) for i, c in enumerate(REPORT_CASES, 1)]
    return run_checks(DIRTY_ORDERS.frame(spark, sf_dir), controls, type="pre_check")


@query("dq_split_good", f"SELECT * EXCLUDE (dq_failed) FROM ({_SPLIT}) y WHERE dq_failed = ''")
def dq_split_good(spark, sf_dir):
    return _split(spark, sf_dir).good()


@query("dq_split_bad", f"SELECT * FROM ({_SPLIT}) y WHERE dq_failed <> ''")
def dq_split_bad(spark, sf_dir):
    failed = F.array_join(F.array_sort("_dq_failed").cast("array<string>"), ",")
    return _split(spark, sf_dir).bad().withColumn("dq_failed", failed).drop("_dq_failed")


@query("dq_order_flags", """SELECT event_id, user_id, coalesce(value < lag(value) over (partition by user_id order by event_id), false) as out_of_order
    FROM events""")
def dq_order_flags(spark, sf_dir):
    """The rows that an order check finds."""
    from millrace.operators.order import flag_out_of_order

    df = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return flag_out_of_order(df, "value", ["event_id"], ["user_id"], "out_of_order").drop("value")
