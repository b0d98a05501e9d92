"""Key mappings between two columns: one-to-one and many-to-one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import fits_broadcast, hot_keys, join_unique


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").dropDuplicates(["a", "b"])


def one_to_one_summary(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the most b values of one a, the most a values of one b.

    Duplicates are dropped map-side first, so a hot key reaches the counts as its distinct pairs only,
    and those are counted map-side again.
    """
    pairs = _pairs(df, a, b)
    per_a = pairs.groupBy("a").agg(F.count("b").alias("n")).agg(F.max("n").alias("n")).select(F.lit("a").alias("side"), "n")
    per_b = pairs.groupBy("b").agg(F.count("a").alias("n")).agg(F.max("n").alias("n")).select(F.lit("b").alias("side"), "n")
    both = per_a.unionByName(per_b)
    return both.agg(
        F.coalesce(F.max(F.when(F.col("side") == "a", F.col("n"))), F.lit(0)).alias("max_b_per_a"),
        F.coalesce(F.max(F.when(F.col("side") == "b", F.col("n"))), F.lit(0)).alias("max_a_per_b"),
    )


def one_to_one_violations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs (a, b) whose a has several b, or whose b has several a.

    A key with several partners has min <> max, which needs no list of partners. The bad keys, one row
    each, are joined to the distinct pairs with hot keys apart.
    """
    here = df.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    flagged = _pairs(df, a, b)
    for own, other in (("a", "b"), ("b", "a")):
        bad = here.groupBy(own).agg((F.min(other) != F.max(other)).alias("_several")).where("_several")
        bad = bad.select(F.col(own).alias("_" + own), F.lit(True).alias("bad_" + own))
        small = fits_broadcast(here)
        hot = None if small else hot_keys(here, [own])
        flagged = join_unique(flagged, bad, {own: "_" + own}, small=small, hot=hot).drop("_" + own)
    return flagged.where("bad_a or bad_b").select(F.col("a").alias(a), F.col("b").alias(b))


def _blank(df: DataFrame, a: str, b: str) -> DataFrame:
    """Nulls count as the empty text; a column of another type has no empty text, so its null stays."""
    types = dict(df.dtypes)
    return df.select(*[
        (F.coalesce(F.col(c), F.lit("")) if types[c] == "string" else F.col(c)).alias(n) for c, n in ((a, "a"), (b, "b"))
    ])


def _pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return _blank(df, a, b).groupBy("a", "b").agg(F.count(F.lit(1)).alias("occurrences"))


def many_to_one_summary(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rows, distinct pairs, distinct a. Pairs are counted first, keys from the pair counts."""
    keys = _pair_counts(df, a, b).groupBy("a").agg(F.sum("occurrences").alias("rows"), F.count(F.lit(1)).alias("pairs"))
    return keys.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("distinct_pairs"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


def many_to_one_violations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that break the mapping, with their number of rows.

    Repeated pairs if there are any; otherwise the pairs of a repeated a.
    """
    summary = many_to_one_summary(df, a, b).first()
    if summary["row_count"] > summary["distinct_pairs"]:
        bad = _pair_counts(df, a, b).where("occurrences > 1")
    else:
        # Every row is a pair of its own here, so the rows themselves are the pairs.
        rows = _blank(df, a, b).withColumn("occurrences", F.lit(1).cast("long"))
        counts = rows.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("_a"))
        bad = join_unique(rows, counts, {"a": "_a"}, "left_semi", null_safe=True, small=fits_broadcast(rows))
    text = [F.coalesce(F.col(n).cast("string"), F.lit("")).alias(c) for n, c in (("a", a), ("b", b))]
    return bad.select(*text, "occurrences")
