"""Masking of text, date and numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import as_list

WORD = r"[\p{L}\p{N}_]"  # letters and digits of every script, as `\w` means in Python; Java's own \w is ASCII


def mask_word_chars(column: Column | str, mark: str) -> Column:
    """Every word character becomes `mark`; separators stay, so the shape of the value shows."""
    column = F.col(column) if isinstance(column, str) else column
    quoted = mark.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(column, F.lit(WORD), F.lit(quoted))


def mask_alpha(df: DataFrame, columns: list[str], mark: str = "*") -> DataFrame:
    """Text columns only; a pattern does nothing to a number."""
    types = dict(df.dtypes)
    return df.withColumns({c: mask_word_chars(c, mark) for c in columns if types[c] == "string"})


def mask_date(df: DataFrame, columns: list[str], mark: str = "0") -> DataFrame:
    """Dates become text of the same shape: 2024-01-31 -> 0000-00-00."""
    types = dict(df.dtypes)
    shapes = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss"}
    out = {}
    for c in columns:
        text = F.date_format(c, shapes[types[c]]) if types[c] in shapes else F.col(c).cast("string")
        out[c] = mask_word_chars(text, mark)
    return df.withColumns(out)


def mask_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """The values go, the type stays."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.lit(None).cast(types[c]) for c in columns})


def mask_from_config(df: DataFrame, config: dict) -> DataFrame:
    """`{"msk_alpha": "*,name", "msk_date": "0,born", "msk_numeric": "salary"}`; the first part of
    alpha and date is the mark, empty for the default."""
    for key, mask, default in (("msk_date", mask_date, "0"), ("msk_alpha", mask_alpha, "*")):
        mark, *columns = (config.get(key) or "").split(",")
        columns = [c.strip() for c in columns if c.strip()]
        if columns:
            df = mask(df, columns, mark or default)
    columns = as_list(config.get("msk_numeric"))
    return mask_numeric(df, columns) if columns else df
