"""Joins with a table that has one row per key, safe against hot keys on the other side.

Small tables are broadcast after their rows have been measured. Otherwise the hottest keys, a bounded number,
are joined by broadcasting only their rows of the table, and the rest goes through a shuffle in
which no key is hot. Nothing is dropped: the two parts are disjoint and cover all rows.

A table in which keys repeat is joined row by row, so that AQE can split a key that is hot on either side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 1000
HOT_SAMPLE = 0.01
HOT_SEEN = 100


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate. For a scan it is that of compressed files, which may be far too low."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Bytes that the rows take in memory: counted rows, the measured lengths of texts, eight for any other value."""
    sizes = [F.lit(16)]
    for field in df.schema.fields:
        long = field.dataType.typeName() in {"string", "binary", "array", "map", "struct"}
        value = F.col(f"`{field.name}`")
        sizes.append(8 + F.coalesce(F.octet_length(value if field.dataType.typeName() == "binary" else value.cast("string")), F.lit(0)) if long else F.lit(8))
    return int(df.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, sizes).cast("long")), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the rows are measured to fit. Frames whose estimate is too large already are not measured."""
    limit = BROADCAST_BYTES if limit is None else limit
    return plan_bytes(df) <= limit and row_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast only when the rows are measured to fit; else leave the choice to AQE."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def hot_keys(df: DataFrame, columns: list[str]) -> DataFrame | None:
    """The keys seen most in a sample, at most HOT_KEYS. The sample steers balance, not the result."""
    seen = df.select(*columns).sample(HOT_SAMPLE, seed=17).groupBy(*columns).agg(F.count(F.lit(1)).alias("_seen"))
    top = seen.where(F.col("_seen") >= HOT_SEEN).orderBy(F.desc("_seen"), *columns).limit(HOT_KEYS).drop("_seen")
    rows = top.collect()
    return df.sparkSession.createDataFrame(rows, top.schema) if rows else None


def _equal(left: DataFrame, right: DataFrame, on: dict[str, str], null_safe: bool) -> Column:
    tests = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on.items()]
    return reduce(lambda x, y: x & y, tests)


def join_unique(
    left: DataFrame, right: DataFrame, on: dict[str, str], how: str = "left", null_safe: bool = False,
    small: bool | None = None, hot: DataFrame | None = None,
) -> DataFrame:
    """Join `left` with `right`, which has one row per key. `on` maps left -> right columns, whose names
    must differ; the right key columns stay in the result. `small` and `hot` may be given if known."""
    if small is None:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), _equal(left, right, on, null_safe), how)
    if hot is None:
        hot = hot_keys(left, list(on))
    if hot is None:
        return left.join(right.hint("merge"), _equal(left, right, on, null_safe), how)  # its estimate must not make it a broadcast
    names = {a: f"_hot{i}" for i, a in enumerate(on)}
    few = F.broadcast(hot.select(*[F.col(a).alias(n) for a, n in names.items()]))
    is_hot = _equal(left, few, names, True)
    hot_left, cold_left = left.join(few, is_hot, "left_semi"), left.join(few, is_hot, "left_anti")
    hot_right = right.join(few, _equal(right, few, {b: names[a] for a, b in on.items()}, True), "left_semi")
    hot_part = hot_left.join(F.broadcast(hot_right), _equal(hot_left, hot_right, on, null_safe), how)
    return hot_part.unionByName(cold_left.join(right.hint("merge"), _equal(cold_left, right, on, null_safe), how))


def join_repeated(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Inner join of `left` with `right`, in which a key may occur any number of times. `on` as in `join_unique`."""
    return left.join(F.broadcast(right) if fits_broadcast(right) else right.hint("merge"), _equal(left, right, on, False), "inner")
