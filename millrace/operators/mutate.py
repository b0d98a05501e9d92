"""UPDATE and DELETE as copy-on-write expressions: plain parquet tables have neither."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _condition(where: str | Column | None) -> Column:
    if where is None:
        return F.lit(True)
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


def update_where(df: DataFrame, changes: dict[str, str | Column], where: str | Column | None = None) -> DataFrame:
    """All right-hand sides see the old row, as in SQL. An unknown condition changes nothing."""
    types, hit = dict(df.dtypes), _condition(where)
    unknown = [c for c in changes if c not in types]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    return df.select(*[
        F.when(hit, (F.expr(changes[c]) if isinstance(changes[c], str) else changes[c]).cast(types[c]))
        .otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    return df.where(~_condition(where))
