"""Fill nulls from a lookup table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import fits_broadcast, join_repeated, join_unique


def auto_correct(df: DataFrame, lookup: DataFrame, keys: dict[str, str], fills: dict[str, str], how: str = "left") -> DataFrame:
    """Nulls of the `fills` columns get the value of the lookup row with the same key.

    `keys` and `fills` map source column -> lookup column. "left" keeps each source row once: the
    lookup is reduced to one whole row per key: of those with the fewest nulls, the smallest. "inner" drops rows
    without a match and repeats rows whose key occurs several times in the lookup.
    With "left" and a lookup too big to broadcast, only rows that have something to fill are joined.
    """
    if how not in {"left", "inner"}:
        raise ValueError("how must be left or inner")
    key_names = {s: f"_key{i}" for i, s in enumerate(keys)}
    fill_names = {s: f"_fill{i}" for i, s in enumerate(fills)}
    right = lookup.select(
        *[F.col(l).alias(key_names[s]) for s, l in keys.items()],
        *[F.col(l).alias(fill_names[s]) for s, l in fills.items()],
    )
    filled = [
        F.coalesce(F.col(c), F.col(fill_names[c])).alias(c) if c in fills else F.col(c) for c in df.columns
    ]
    if how == "inner":
        return join_repeated(df, right, key_names).select(*filled)
    row = F.struct(*fill_names.values())
    gaps = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in fill_names.values()])
    right = right.groupBy(*key_names.values()).agg(F.min(F.struct(gaps.alias("gaps"), row.alias("row"))).alias("_best"))
    right = right.select(*key_names.values(), "_best.row.*")
    if fits_broadcast(lookup):
        return join_unique(df, right, key_names, small=True).select(*filled)
    gaps = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in fills])
    usable = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in keys])
    joined = join_unique(df.where(gaps & usable), right, key_names, small=False).select(*filled)
    return df.where(~(gaps & usable)).unionByName(joined)
