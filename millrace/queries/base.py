"""Registered queries: name -> Spark query, and where SQL can say it, the same in SQL.

Queries run over whole tables. The test tables are clean, so defects are put in by expressions on
the key (`case when key % 17 = 0 then null ...`) that read the same in Spark and in the SQL check;
they change values, they do not select rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.report import run_checks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shape:
    """A table with defects: select expressions that Spark and the SQL check share."""

    def __init__(self, name: str, *exprs: str, twice: str | None = None):
        self.name, self.exprs, self.twice = name, exprs or ("*",), twice

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, self.name)
        if self.twice:
            df = df.unionAll(df.where(self.twice))
        return df.selectExpr(*self.exprs)

    @property
    def sql(self) -> str:
        source = self.name
        if self.twice:
            source = f"(SELECT * FROM {self.name} UNION ALL SELECT * FROM {self.name} WHERE {self.twice})"
        return f"SELECT {', '.join(self.exprs)} FROM {source}"


DIRTY_ORDERS = Shape(
    "orders",
    "o_orderkey",
    "o_custkey",
    "case when o_orderkey % 17 = 0 then null when o_orderkey % 23 = 0 then 'BAD' else o_orderstatus end as o_orderstatus",
    "case when o_orderkey % 37 = 0 then null when o_orderkey % 29 = 0 then cast(-1 as double) else o_totalprice end as o_totalprice",
    "case when o_orderkey % 19 = 0 then 'n/a' else cast(cast(o_orderdate as date) as string) end as order_day",
    "o_orderpriority",
    twice="o_orderkey % 50 = 0",
)


# ---------------------------------------------------------------- check cases


class Case:
    """One check with the SQL that says what it should find."""

    def __init__(self, check, params, column, missing="false", bad=None, ok=None, details=None, threshold=None,
                 ignore="Y", mostly=None, active="Y", custom=False, type="pre_check", base=None, missing_null=False):
        self.check, self.params, self.column, self.missing, self.bad = check, params, column, missing, bad
        self.ok, self.details, self.threshold, self.ignore = ok, details, threshold, ignore
        self.mostly, self.active, self.custom, self.type = mostly, active, custom, type
        self.base, self.missing_null = base, missing_null

    def control(self, seq_no: int) -> dict:
        params = dict(self.params, mostly=self.mostly) if self.mostly is not None else self.params
        return {
            "seq_no": str(seq_no), "check": self.check, "parameters": params, "active": self.active,
            "ignore_bad_records": self.ignore, "threshold_bad_records": self.threshold, "type": self.type,
        }

    def sql(self, seq_no: int, base: str) -> str:
        base = self.base or base
        limit = "cast(null as double)" if self.threshold is None else f"cast({self.threshold} as double)"
        column = f"'{self.column}'" if self.column else "cast(null as varchar)"
        head = f"cast({seq_no} as integer) as seq_no, '{self.check}' as \"check\", '{self.type}' as type"
        if self.active != "Y":
            return f"""SELECT {head}, cast(null as varchar) as "column", cast(null as bigint) as element_count,
                cast(null as bigint) as missing_count, cast(null as bigint) as unexpected_count,
                cast(null as double) as unexpected_percent, {limit} as threshold, cast(null as varchar) as result,
                'N' as threshold_violated, cast(null as bigint) as good_records_count,
                cast(null as bigint) as bad_records_count, cast(null as varchar) as details"""
        missing = "cast(null as bigint)" if self.missing_null else f"count(*) filter (where {self.missing})"
        if self.bad is not None:
            within = f"floor(p) <= {self.threshold}" if self.threshold is not None else "false"
            share = f"(n - m - u) / (n - m) >= {self.mostly}" if self.mostly is not None else "false"
            spoiled = f"(not (u = 0 or {share}) and '{self.ignore}' = 'Y')"
            over = f"p > {self.threshold}" if self.threshold is not None else "false"
            return f"""SELECT {head}, {column} as "column", n as element_count, m as missing_count, u as unexpected_count,
                p as unexpected_percent, {limit} as threshold,
                case when u = 0 or {share} or {within} then 'PASS' else 'FAIL' end as result,
                case when {spoiled} and {over} then 'Y' else 'N' end as threshold_violated,
                cast(n - case when {spoiled} then u else 0 end as bigint) as good_records_count,
                cast(case when {spoiled} then u else 0 end as bigint) as bad_records_count, cast(null as varchar) as details
                FROM (SELECT *, case when n - m > 0 then u * cast(100 as double) / (n - m) else cast(0 as double) end as p
                FROM (SELECT count(*) as n, {missing} as m, count(*) filter (where {self.bad}) as u FROM ({base}) d))"""
        counts = ("cast(null as bigint)",) * 2 if self.custom else ("count(*)", "cast(0 as bigint)")
        return f"""SELECT {head}, {column} as "column", count(*) as element_count, {missing} as missing_count,
            cast(null as bigint) as unexpected_count, cast(null as double) as unexpected_percent, {limit} as threshold,
            case when {self.ok} then 'PASS' else 'FAIL' end as result, 'N' as threshold_violated,
            {counts[0]} as good_records_count, {counts[1]} as bad_records_count,
            {self.details or 'cast(null as varchar)'} as details FROM ({base}) d"""


def cases_sql(cases: list[Case], base: str) -> str:
    return " UNION ALL ".join(c.sql(i, base) for i, c in enumerate(cases, 1))


def check_query(name: str, shape: Shape, *cases: Case) -> None:
    """Register the report of some checks over one table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_checks(shape.frame(spark, sf_dir), [c.control(i) for i, c in enumerate(cases, 1)]).report

    query(name, cases_sql(list(cases), shape.sql))(run)
