"""Cross-frame checks: reconciliation, schemas, key mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import add_audit_columns, compound_key, upper_names
from millrace.operators.mapping import many_to_one_summary, many_to_one_violations, one_to_one_summary, one_to_one_violations
from millrace.operators.reconcile import RECON_KINDS, Recon, compare_schema, reconcile, schema_difference, without_audit
from millrace.operators.report import run_checks
from millrace.queries.base import Shape, query, table

# The target of a load that lost a few rows and changed a few values.
DRIFTED = Shape(
    "(SELECT * FROM orders WHERE o_orderkey % 97 <> 0) o",
    "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
    "case when o_orderkey % 101 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice",
)


def _drifted(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderkey % 97 <> 0").selectExpr(*DRIFTED.exprs)


_TOTAL_SQL = {
    "sum": "cast(coalesce(sum(cast({c} as decimal(28,6))), 0) as decimal(38,6))",
    "avg": "cast(cast(sum(cast({c} as decimal(28,6))) as double) / count({c}) as decimal(38,6))",
    "min": "min(cast({c} as decimal(28,6)))",
    "max": "max(cast({c} as decimal(28,6)))",
    "count": "count({c})",
}


def _recon_sql(kind: str) -> str:
    parts = []
    for i, c in enumerate(("o_totalprice", "o_custkey", "o_orderdate"), 1):
        if c == "o_orderdate" and kind in {"sum", "avg"}:
            continue
        total = _TOTAL_SQL[kind].format(c=c) if c != "o_orderdate" or kind == "count" else f"{kind}({c})"
        parts.append(f"""SELECT cast({i} as integer) as seq_no, '{kind}' as aggregation, s as source_value, t as target_value,
            case when s is not distinct from t then 'PASS' else 'FAIL' end as result FROM
            (SELECT (SELECT cast({total} as varchar) FROM orders) as s, (SELECT cast({total} as varchar) FROM ({DRIFTED.sql}) d) as t)""")
    return " UNION ALL ".join(parts)


def _recon(kind):
    def run(spark, sf_dir):
        columns = [(1, "o_totalprice"), (2, "o_custkey"), (3, "o_orderdate")]
        recons = [Recon(i, kind, c, c) for i, c in columns if c != "o_orderdate" or kind not in {"sum", "avg"}]
        return reconcile(table(spark, sf_dir, "orders"), _drifted(spark, sf_dir), recons)

    return run


for _kind in RECON_KINDS:
    query(f"recon_{_kind}", _recon_sql(_kind))(_recon(_kind))


# The target differs by 3e-7 in one row of fifty, where the source has 1e-7; prices are made tiny or huge.
_TINY = Shape("orders", "o_orderkey", "case when o_orderkey % 50 = 0 then cast(0.0000001 as double) else cast(0.000002 as double) end as v")
_TINY_OFF = Shape("orders", "o_orderkey", "case when o_orderkey % 50 = 0 then cast(0.0000004 as double) else cast(0.000002 as double) end as v")
_HUGE = Shape("orders", "o_orderkey", "cast('1.5e23' as double) as v")
_HUGE_OFF = Shape("orders", "o_orderkey", "case when o_orderkey % 50 = 0 then cast('2.5e23' as double) else cast('1.5e23' as double) end as v")
_PLAIN = r"regexp_replace({x}, '(\.\d{{6}}\d*?)0+$', '\1')"


def _size_sql(source: Shape, target: Shape, totals: dict[str, str], rows: list[tuple[int, str, Shape]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT cast({i} as integer) as seq_no, '{kind}' as aggregation, s as source_value, t as target_value,
        case when s = t then 'PASS' else 'FAIL' end as result FROM (SELECT (SELECT {totals[kind]} FROM ({source.sql}) a) as s,
        (SELECT {totals[kind]} FROM ({other.sql}) b) as t)""" for i, kind, other in rows)


_KINDS = ("sum", "min", "max")
_SMALL = {k: _PLAIN.format(x=f"cast({k}(cast(cast(v as varchar) as decimal(38,20))) as varchar)") for k in _KINDS}
_LARGE = {k: f"cast({k}(cast(v / 1e15 as hugeint)) * cast(1000000000000000 as hugeint) as varchar) || '.000000'" for k in _KINDS}
_ROWS = [(i + 3 * j, k, j) for j in (0, 1) for i, k in enumerate(_KINDS, 1)]


def _sized(source: Shape, target: Shape):
    def run(spark, sf_dir):
        """Against itself, then against the target that differs."""
        one = source.frame(spark, sf_dir)
        same = reconcile(one, one, [Recon(i, k, "v", "v") for i, k, j in _ROWS if not j])
        return same.unionByName(reconcile(one, target.frame(spark, sf_dir), [Recon(i, k, "v", "v") for i, k, j in _ROWS if j]))

    return run


query("recon_small_values", _size_sql(_TINY, _TINY_OFF, _SMALL, [(i, k, _TINY_OFF if j else _TINY) for i, k, j in _ROWS]))(_sized(_TINY, _TINY_OFF))
query("recon_large_values", _size_sql(_HUGE, _HUGE_OFF, _LARGE, [(i, k, _HUGE_OFF if j else _HUGE) for i, k, j in _ROWS]))(_sized(_HUGE, _HUGE_OFF))


@query("record_counts_recon", f"""SELECT (SELECT count(*) FROM orders) as source_rows, (SELECT count(*) FROM ({DRIFTED.sql}) d) as target_rows""")
def record_counts_recon(spark, sf_dir):
    """Rows on both sides."""
    source = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("source_rows")).withColumn("target_rows", F.lit(None).cast("long"))
    target = _drifted(spark, sf_dir).agg(F.count(F.lit(1)).alias("target_rows")).withColumn("source_rows", F.lit(None).cast("long"))
    return source.unionByName(target).agg(F.max("source_rows").alias("source_rows"), F.max("target_rows").alias("target_rows"))


def _target_with_changes(spark, sf_dir):
    """A target with audit columns, one column of another type and one more."""
    df = _drifted(spark, sf_dir).withColumn("o_custkey", F.col("o_custkey").cast("int")).withColumn("extra", F.lit("x"))
    return add_audit_columns(df, "loader")


@query("column_count_compare", f"""SELECT 'column_count_comparison' as "check", 'FAIL' as result, 'source has 6 columns, target has 7' as details,
    (SELECT count(*) FROM ({DRIFTED.sql}) d) as element_count""")
def column_count_compare(spark, sf_dir):
    run = run_checks(_target_with_changes(spark, sf_dir), [{"seq_no": 1, "check": "column_count_comparison"}], source=table(spark, sf_dir, "orders"))
    return run.report.select("check", "result", "details", "element_count")


@query("schema_compare", """SELECT * FROM (VALUES ('source', 'O_CUSTKEY|bigint'), ('target', 'O_CUSTKEY|int'), ('target', 'EXTRA|string')) v(side, entry)
    JOIN (SELECT 'source' as side, (SELECT count(*) FROM orders) as non_null_values
    UNION ALL SELECT 'target', (SELECT count(*) FROM orders WHERE o_orderkey % 97 <> 0)) n USING (side)""")
def schema_compare(spark, sf_dir):
    return schema_difference(table(spark, sf_dir, "orders"), _target_with_changes(spark, sf_dir))


@query("schema_compare_cols", f"""SELECT o_orderkey as "O_ORDERKEY", o_custkey as "O_CUSTKEY", o_orderstatus as "O_ORDERSTATUS",
    o_totalprice as "O_TOTALPRICE" FROM ({DRIFTED.sql}) d""")
def schema_compare_cols(spark, sf_dir):
    """A target as a comparison sees it: no audit columns, upper-case names."""
    target = add_audit_columns(_drifted(spark, sf_dir), "loader")
    seen = upper_names(without_audit(target)).select("O_ORDERKEY", "O_CUSTKEY", "O_ORDERSTATUS", "O_TOTALPRICE")
    assert compare_schema(target.drop("o_orderdate"), target)[0] is False
    return seen


# A label per part, but every 31st part takes the label of the part before it.
MAPPED = Shape("part", "p_partkey", "case when p_partkey % 31 = 0 then 'part ' || cast(p_partkey - 1 as string) else 'part ' || cast(p_partkey as string) end as label")
_ONE_PAIRS = f"SELECT DISTINCT p_partkey as a, label as b FROM ({MAPPED.sql}) m WHERE p_partkey is not null and label is not null"


@query("one_to_one_map", f"""SELECT (SELECT max(n) FROM (SELECT count(*) as n FROM ({_ONE_PAIRS}) p GROUP BY a) x) as max_b_per_a,
    (SELECT max(n) FROM (SELECT count(*) as n FROM ({_ONE_PAIRS}) p GROUP BY b) y) as max_a_per_b""")
def one_to_one_map(spark, sf_dir):
    return one_to_one_summary(MAPPED.frame(spark, sf_dir), "p_partkey", "label")


@query("one_to_one_violations", f"""SELECT a as p_partkey, b as label FROM ({_ONE_PAIRS}) p WHERE a in (SELECT a FROM ({_ONE_PAIRS}) q GROUP BY a HAVING count(*) > 1)
    or b in (SELECT b FROM ({_ONE_PAIRS}) r GROUP BY b HAVING count(*) > 1)""")
def one_to_one_bad(spark, sf_dir):
    return one_to_one_violations(MAPPED.frame(spark, sf_dir), "p_partkey", "label")


@query("one_to_one_brand_type", """SELECT p_brand, p_type FROM part WHERE p_brand is not null and p_type is not null GROUP BY ALL""")
def one_to_one_brand_type(spark, sf_dir):
    """Many-to-many columns: every pair is a violation."""
    return one_to_one_violations(table(spark, sf_dir, "part"), "p_brand", "p_type")


MANY = Shape("lineitem", "case when l_orderkey % 17 = 0 then null else l_orderkey end as l_orderkey", "l_linenumber")
_BLANK = f"SELECT coalesce(cast(l_orderkey as varchar), '') as a, coalesce(cast(l_linenumber as varchar), '') as b FROM ({MANY.sql}) m"


@query("multi_to_one_map", f"""SELECT count(*) as row_count, count(distinct (a, b)) as distinct_pairs, count(distinct a) as distinct_keys FROM ({_BLANK}) x""")
def multi_to_one_map(spark, sf_dir):
    return many_to_one_summary(MANY.frame(spark, sf_dir), "l_orderkey", "l_linenumber")


@query("multi_to_one_violations", f"""SELECT a as l_orderkey, b as l_linenumber, count(*) as occurrences FROM ({_BLANK}) x GROUP BY 1, 2 HAVING count(*) > 1""")
def multi_to_one_bad(spark, sf_dir):
    """Repeated pairs."""
    return many_to_one_violations(MANY.frame(spark, sf_dir), "l_orderkey", "l_linenumber")


@query("multi_to_one_repeated_keys", """SELECT cast(o_custkey as varchar) as o_custkey, cast(o_orderkey as varchar) as o_orderkey, cast(1 as bigint) as occurrences
    FROM orders WHERE o_custkey in (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def multi_to_one_repeated_keys(spark, sf_dir):
    """All pairs occur once, keys do not."""
    return many_to_one_violations(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


@query("compound_key", """SELECT coalesce(cast(l_orderkey as varchar), '') || '|' || cast(l_linenumber as varchar) as compound, count(*) as n
    FROM (SELECT case when l_orderkey % 17 = 0 then null else l_orderkey end as l_orderkey, l_linenumber FROM lineitem) x GROUP BY 1""")
def compound(spark, sf_dir):
    df = MANY.frame(spark, sf_dir)
    return df.groupBy(compound_key(["l_orderkey", "l_linenumber"]).alias("compound")).agg(F.count(F.lit(1)).alias("n"))


_VERDICTS = {
    ("1", "reconciliation"): f"(SELECT sum(cast(o_totalprice as decimal(28,6))) FROM orders) = (SELECT sum(cast(o_totalprice as decimal(28,6))) FROM ({DRIFTED.sql}) d)",
    ("2", "reconciliation"): f"(SELECT min(o_orderdate) FROM orders) = (SELECT min(o_orderdate) FROM ({DRIFTED.sql}) d)",
    ("3", "multi_to_one_mapping"): "(SELECT count(*) = count(distinct (o_orderkey, o_custkey)) and count(*) = count(distinct o_orderkey) FROM orders)",
    ("4", "one_to_one_mapping"): f"""(SELECT max(n) FROM (SELECT count(distinct o_custkey) as n FROM ({DRIFTED.sql}) d GROUP BY o_orderkey) x) <= 1
        and (SELECT max(n) FROM (SELECT count(distinct o_orderkey) as n FROM ({DRIFTED.sql}) d GROUP BY o_custkey) y) <= 1""",
    ("5", "schema_comparison"): "true",
}


@query("custom_check_report", " UNION ALL ".join(
    f"""SELECT cast({i} as integer) as seq_no, '{name}' as "check", case when {sql} then 'PASS' else 'FAIL' end as result""" for (i, name), sql in _VERDICTS.items()
))
def custom_check_report(spark, sf_dir):
    """Cross-frame checks through the same report as all others."""
    checks = [
        {"seq_no": 1, "check": "reconciliation", "parameters": {"aggregation": "sum", "source_column": "o_totalprice", "target_column": "o_totalprice"}},
        {"seq_no": 2, "check": "reconciliation", "parameters": {"aggregation": "min", "source_column": "o_orderdate", "target_column": "o_orderdate"}},
        {"seq_no": 3, "check": "multi_to_one_mapping", "parameters": {"column_A": "o_orderkey", "column_B": "o_custkey"}},
        {"seq_no": 4, "check": "one_to_one_mapping", "parameters": {"column_A": "o_orderkey", "column_B": "o_custkey"}},
        {"seq_no": 5, "check": "schema_comparison"},
    ]
    target = _drifted(spark, sf_dir).select(*table(spark, sf_dir, "orders").columns)
    return run_checks(target, checks, source=table(spark, sf_dir, "orders")).report.select("seq_no", "check", "result")
