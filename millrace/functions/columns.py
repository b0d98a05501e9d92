"""Projection, renaming, audit columns and other column-wise steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import as_list

STAMP = "yyyy-MM-dd HH:mm:ss"
REPORT_STAMP = "dd/MM/yyyy HH:mm:ss"
EVENT_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def project(df: DataFrame, select=None, alias=None) -> DataFrame:
    """Keep the named columns, then rename by position. Catalyst prunes the scan."""
    columns, names = as_list(select), as_list(alias)
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"no such column: {', '.join(missing)}")
        df = df.select(*columns)
    if names:
        if len(names) != len(df.columns):
            raise ValueError(f"{len(names)} alias names for {len(df.columns)} columns")
        df = df.toDF(*names)
    return df


def default_names(df: DataFrame) -> DataFrame:
    """column1, column2, ... for data without a header."""
    return df.toDF(*[f"column{i + 1}" for i in range(len(df.columns))])


def add_audit_columns(df: DataFrame, user: str, stamp: Column | None = None) -> DataFrame:
    """Who and when; the update pair holds one blank until an update happens."""
    stamp = F.current_timestamp() if stamp is None else stamp
    return df.withColumns({
        "CRTD_BY": F.lit(user),
        "CRTD_DTTM": F.date_format(stamp, STAMP),
        "UPDT_BY": F.lit(" "),
        "UPDT_DTTM": F.lit(" "),
    })


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in {"double", "float"}}
    return df.withColumns(floats) if floats else df


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def compound_key(columns: list[str], sep: str = "|") -> Column:
    """Readable key text. To compare keys use a struct: text cannot tell `a|` + `b` from `a` + `|b`."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])
