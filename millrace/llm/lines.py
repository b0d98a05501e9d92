"""Line removal by distinct-site spread: a line found on many sites is boilerplate.

Every line hash gets a HyperLogLog sketch of the sites it occurs on; sketches are made per task and
merged by the aggregation, so a line that a third of all rows hold costs one sketch per task. A
line whose estimate is clearly above or below the limit is settled; those near it get an exact
distinct count. Lines are then taken out by a join on the line hash and one on the text.

Lines are what `\\n` separates, compared without spaces, tabs and carriage returns at their ends.
Every line with a word is looked at, and its sites alone decide; `min_words` may leave shorter lines out.

Defined results: a null text stays null and an empty one empty; a null site counts as no site; a line
repeated within a text counts once per site and is removed wherever it stands; a text of which no
word would be left is kept whole, as it is a copy and not boilerplate; equal rows are treated alike.
All other columns, whatever their names, come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import store

MIN_SITES = 10
MIN_WORDS = 1  # a line without a word is no boilerplate
LG_K = 12
NEAR = 0.25  # relative distance from the limit within which estimates are not trusted


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def line_hashes(text: Column, min_words: int) -> Column:
    """One hash per line, null for lines that are too short."""

    def one(line: Column) -> Column:
        words = F.size(F.filter(F.split(line, "[ \t\r]+"), lambda w: w != ""))
        return F.when(words >= min_words, F.xxhash64(_trimmed(line)))

    return F.transform(F.split(text, "\n"), one)


def spread_lines(docs: DataFrame, text: str, site: str, min_sites: int, min_words: int) -> DataFrame:
    """Hashes (`line`) of the lines found on at least `min_sites` distinct sites."""
    seen = docs.select(
        F.col(site).cast("string").alias("site"), F.explode(F.array_distinct(line_hashes(F.col(text), min_words))).alias("line")
    ).where("line is not null and site is not null")
    counted = seen.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
    counted = counted.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    counted = store(counted.where(F.col("sites") >= min_sites * (1 - NEAR)), "line-sites")
    sure = F.col("sites") > min_sites * (1 + NEAR)
    near = counted.where(~sure).select(F.col("line").alias("near"))
    pairs = seen.join(near, seen.line == near.near, "left_semi").distinct()
    exact = pairs.groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return store(counted.where(sure).select("line").unionByName(exact.select("line")), "spread-lines")


def remove_spread_lines(
    docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS
) -> DataFrame:
    """`doc` (the row as it was), `text` (without boilerplate lines), `n_lines`, `n_removed`."""
    spread = spread_lines(docs, text, site, min_sites, min_words)
    both = lambda t: [F.xxhash64(t).alias("key1"), F.xxhash64(F.lit(1), t).alias("key2")]
    lines = docs.select(*both(F.col(text)), F.posexplode(line_hashes(F.col(text), min_words)).alias("at", "hash"))
    hits = lines.where("hash is not null").join(spread, F.col("hash") == spread.line, "left_semi")
    hits = store(hits.groupBy("key1", "key2").agg(F.collect_set("at").alias("at")), "boilerplate-hits")  # so AQE can split copies
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("_text")).select("*", *both(F.col("_text")))
    rows = rows.join(hits, ["key1", "key2"], "left").withColumn("lines", F.split("_text", "\n"))
    left = F.array_join(F.filter("lines", lambda x, i: ~F.array_contains("at", i)), "\n")
    rows = rows.withColumn("left", F.when(F.col("at").isNotNull(), left))
    cut = F.col("left").isNotNull() & F.col("left").rlike(r"[^ \t\r\n]")
    return rows.select(
        "doc", F.when(cut, F.col("left")).otherwise(F.col("_text")).alias("text"),
        F.when(F.coalesce(F.col("_text"), F.lit("")) == "", 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(cut, F.size("at")).otherwise(0).cast("long").alias("n_removed"),
    )
