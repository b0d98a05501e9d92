"""Source against target: totals, column counts, schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import AUDIT_COLUMNS
from millrace.functions.columns import nan_to_null
from millrace.functions.exact import FINE, FINE_TYPE, mean_text, name, number_text, same_number, sum_text

RECON_KINDS = ("sum", "avg", "min", "max", "count")


@dataclass(frozen=True)
class Recon:
    seq_no: int
    kind: str
    source_column: str
    target_column: str
    tolerance: float | None = None


def _is_number(df: DataFrame, column: str) -> bool:
    name = df.schema[column].dataType.typeName()
    return name in {"byte", "short", "integer", "long", "float", "double"} or name.startswith("decimal")


def _total(df: DataFrame, kind: str, column: str, number: bool) -> Column:
    """One side's total as text; smallest and largest values are found in the column's own type.

    Text that is no number counts as missing, but for smallest and largest values of two text columns."""
    if kind == "count":
        return F.count(F.col(column)).cast("string")
    if kind not in RECON_KINDS:
        raise ValueError(f"reconciliation kind must be one of {', '.join(RECON_KINDS)}")
    if kind in {"min", "max"} and not number:
        return (F.min if kind == "min" else F.max)(F.col(column)).cast("string")
    value, type_ = name(column), df.schema[column].dataType
    if type_.typeName() == "string":
        value, type_ = f"try_cast({value} as {FINE})", FINE_TYPE
    if kind == "sum":
        return F.expr(f"coalesce({sum_text(value, type_)}, '0.000000')")
    return F.expr(mean_text(value, type_) if kind == "avg" else number_text(f"{kind}({value})", type_))


def reconcile_totals(source: DataFrame, target: DataFrame, recons: list[Recon]) -> DataFrame:
    """One row with s<seq>, t<seq>, ok<seq> per reconciliation, in one pass per side.

    Each side is aggregated to one row; the two rows are put together by a union, not a join.
    """
    sides = []
    for tag, df in (("s", nan_to_null(source)), ("t", nan_to_null(target))):
        totals = []
        for r in recons:
            number = _is_number(source, r.source_column) or _is_number(target, r.target_column)
            column = r.source_column if tag == "s" else r.target_column
            totals.append(_total(df, r.kind, column, number).alias(f"v{r.seq_no}"))
        sides.append(df.agg(*totals).withColumn("side", F.lit(tag)))
    picked = [
        F.max(F.when(F.col("side") == tag, F.col(f"v{r.seq_no}"))).alias(f"{tag}{r.seq_no}")
        for r in recons for tag in ("s", "t")
    ]
    row = sides[0].unionByName(sides[1]).agg(*picked)
    return row.withColumns({f"ok{r.seq_no}": _same(r) for r in recons})


def _same(r: Recon) -> Column:
    s, t = F.col(f"s{r.seq_no}"), F.col(f"t{r.seq_no}")
    return same_number(s, t, r.tolerance) if r.kind in {"sum", "avg"} or r.tolerance is not None else s.eqNullSafe(t)


def _shown(r: Recon, column: str) -> Column:
    """A mean is compared to twenty digits and shown to six, unless it is very small."""
    text = F.col(column)
    six = F.when(F.abs(text.try_cast("double")) >= 0.001, text.try_cast("decimal(38,6)").cast("string"))
    return F.coalesce(six, text) if r.kind == "avg" else text


def reconcile(source: DataFrame, target: DataFrame, recons: list[Recon]) -> DataFrame:
    """One row per reconciliation: both values as text and PASS or FAIL."""
    rows = [
        F.struct(
            F.lit(r.seq_no).alias("seq_no"),
            F.lit(r.kind).alias("aggregation"),
            _shown(r, f"s{r.seq_no}").alias("source_value"),
            _shown(r, f"t{r.seq_no}").alias("target_value"),
            F.when(F.col(f"ok{r.seq_no}"), "PASS").otherwise("FAIL").alias("result"),
        )
        for r in recons
    ]
    return reconcile_totals(source, target, recons).select(F.inline(F.array(*rows)))


def without_audit(df: DataFrame, audit: bool = True) -> DataFrame:
    """The frame without the four audit columns, whatever their case."""
    return df.drop(*[c for c in df.columns if audit and c.upper() in AUDIT_COLUMNS])


def compare_column_count(source: DataFrame, target: DataFrame, audit: bool = True) -> tuple[bool, str | None]:
    s, t = len(source.columns), len(without_audit(target, audit).columns)
    return s == t, None if s == t else f"source has {s} columns, target has {t}"


def compare_schema(source: DataFrame, target: DataFrame, audit: bool = True) -> tuple[bool, str | None]:
    """Ordered NAME|type lists must be equal. Details: entries only in the source, else only in the target."""
    s = [f"{n.upper()}|{t}" for n, t in source.dtypes]
    t = [f"{n.upper()}|{t}" for n, t in without_audit(target, audit).dtypes]
    if s == t:
        return True, None
    off = sorted(set(s) - set(t)) or sorted(set(t) - set(s))
    return False, "schema differs: " + (",".join(off) if off else "order of columns")


def schema_difference(source: DataFrame, target: DataFrame, audit: bool = True) -> DataFrame:
    """One row per column that is only on one side, with its non-null values counted there."""
    sides = {"source": source, "target": without_audit(target, audit)}
    names = {k: {f"{n.upper()}|{t}": n for n, t in df.dtypes} for k, df in sides.items()}
    out = []
    for side, other in (("source", "target"), ("target", "source")):
        only = [e for e in names[side] if e not in names[other]]
        if not only:
            continue
        counted = sides[side].agg(*[F.count(F.col(names[side][e])).alias(f"c{i}") for i, e in enumerate(only)])
        rows = [
            F.struct(F.lit(side).alias("side"), F.lit(e).alias("entry"), F.col(f"c{i}").alias("non_null_values"))
            for i, e in enumerate(only)
        ]
        out.append(counted.select(F.inline(F.array(*rows))))
    if not out:
        return source.sparkSession.createDataFrame([], "side string, entry string, non_null_values long")
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
