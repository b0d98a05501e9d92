"""Ordered SQL statement lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.mutate import delete_where, update_where
from millrace.sinks.tables import is_file_table, rewrite_where

MODES = ("begin", "normal", "skip")


@dataclass
class StatementResult:
    seq_no: int
    status: str
    frame: DataFrame | None = None
    error: Exception | None = None


def split_statements(text: str) -> list[str]:
    """Cuts at semicolons that end a line; those in quotes and comments do not count."""
    out, start, i = [], 0, 0
    while i < len(text):
        if text[i] in "'\"`":
            quote, i = text[i], i + 1
            while i < len(text) and text[i] != quote:
                i += 2 if text[i] == "\\" and quote != "`" else 1
        elif text.startswith("--", i):
            i = _after(text, "\n", i) - 2
        elif text.startswith("/*", i):
            i = _after(text, "*/", i) - 1
        elif text[i] == ";" and not text[i + 1 :].split("\n", 1)[0].strip():
            out.append(text[start:i])
            start = i + 1
        i += 1
    return [t.strip(" ;\n\t\r") for t in [*out, text[start:]] if t.strip(" ;\n\t\r")]


def _after(text: str, mark: str, i: int) -> int:
    found = text.find(mark, i)
    return len(text) if found < 0 else found + len(mark)


def statements_in_order(sql_list: list[dict]) -> list[tuple[int, str]]:
    """(seq_no, text) sorted, without trailing semicolons. One entry may hold several statements."""
    ordered = sorted(sql_list, key=lambda s: int(s["seq_no"]))
    return [(int(item["seq_no"]), text) for item in ordered for text in split_statements(item["sql_query"])]


@dataclass
class RowChange:
    """An UPDATE or DELETE as Spark's own parser reads it."""

    table: str
    alias: str
    where: Column | None
    values: dict[str, Column] | None  # None: delete


def read_change(spark: SparkSession, text: str) -> RowChange | None:
    """None for any other statement. Text that does not parse raises; so does what could change every row unawares."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    kind = plan.getClass().getSimpleName()
    if kind not in {"DeleteFromTable", "UpdateTable"}:
        return None
    table, alias = plan.table(), None
    if table.getClass().getSimpleName() == "SubqueryAlias":
        table, alias = table.child(), table.alias()
    if table.getClass().getSimpleName() != "UnresolvedRelation":
        raise ValueError(f"not a table that rows can be changed in: {text}")
    parts = [table.multipartIdentifier().apply(i) for i in range(table.multipartIdentifier().size())]
    column = lambda e: Column(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(e))
    where, values = plan.condition(), None
    if kind == "UpdateTable":
        where, values = where.get() if where.isDefined() else None, {}
        for i in range(plan.assignments().size()):
            one = plan.assignments().apply(i)
            names = [one.key().nameParts().apply(j) for j in range(one.key().nameParts().size())]
            if names[:-1] and names[:-1] not in ([alias], parts, parts[-1:]):
                raise ValueError(f"a field of a column cannot be set: {'.'.join(names)}")
            if names[-1] in values:
                raise ValueError(f"column {names[-1]} is set twice")
            values[names[-1]] = column(one.value())
    elif where.getClass().getSimpleName() == "Literal":
        where = None if where.sql() == "true" else where
    if where is None and alias is not None:  # `DELETE FROM t WHER` reads as an alias
        raise ValueError(f"no condition, but {alias!r} after the table: {text}")
    name = ".".join("`" + p.replace("`", "``") + "`" for p in parts)
    return RowChange(name, alias or parts[-1], None if where is None else column(where), values)


def run_statement(spark: SparkSession, text: str) -> DataFrame:
    """UPDATE and DELETE on tables of files go to our operators, everything else to spark.sql as it is."""
    change = read_change(spark, text)
    if change is None or not is_file_table(spark, change.table):
        return spark.sql(text)
    if change.values is None:
        rewrite_where(spark, change.table, change.where, lambda df: delete_where(df, change.where), alias=change.alias)
    else:
        rewrite_where(spark, change.table, change.where, lambda df: update_where(df, change.values, change.where), alias=change.alias)
    return spark.table(change.table).limit(0)


def run_sql_task(spark: SparkSession, task: dict, log: dict[int, str] | None = None) -> list[StatementResult]:
    """Run the statements that the restart mode asks for; stop at the first failure.

    `log` holds the status per seq_no of the run before: COMPLETED, FAILED or absent.
    """
    mode = (task.get("sql_execution") or {}).get("restart") or "begin"
    todo = restart_plan([int(s["seq_no"]) for s in task["sql_list"]], log or {}, mode)
    results = []
    for seq_no, text in statements_in_order(task["sql_list"]):
        if seq_no not in todo:
            continue
        try:
            results.append(StatementResult(seq_no, "COMPLETED", run_statement(spark, text)))
        except Exception as err:
            results.append(StatementResult(seq_no, "FAILED", error=err))
            break
    return results


def restart_plan(seq_nos: list[int], log: dict[int, str], mode: str) -> set[int]:
    """begin = all; normal = from the first one not completed; skip = all but the failed ones.

    The modes are named but not defined in task files; this reading is an assumption.
    """
    if mode not in MODES:
        raise ValueError(f"restart must be one of {', '.join(MODES)}")
    if mode == "begin":
        return set(seq_nos)
    if mode == "skip":
        return {s for s in seq_nos if log.get(s) != "FAILED"}
    pending = [s for s in seq_nos if log.get(s) != "COMPLETED"]
    return {s for s in seq_nos if pending and s >= min(pending)}


def restart_plan_frame(statements: DataFrame, keys: list[str]) -> DataFrame:
    """The same for a table of statement logs (keys, seq_no, status): one boolean per mode."""
    first = statements.groupBy(*keys).agg(
        F.min(F.when(~F.col("status").eqNullSafe("COMPLETED"), F.col("seq_no"))).alias("_first")
    )
    joined = statements.join(first, keys)
    return joined.select(
        *keys, "seq_no", "status",
        F.lit(True).alias("run_begin"),
        F.coalesce(F.col("seq_no") >= F.col("_first"), F.lit(False)).alias("run_normal"),
        (~F.col("status").eqNullSafe("FAILED")).alias("run_skip"),
    )
