"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a bounded number of 512-bit blocks; a URL sets and tests bits of one block only. Its
blocks are made by an aggregation with `bit_or`, so that no task or driver ever holds the list, and
their number has a fixed upper limit, so that the broadcast has one too (16 MB). A longer list only
makes more false hits; every hit is then looked up in the list itself by an exact hash join, and
what misses the filter, usually nearly all rows, is not shuffled at all.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no rule and is
never listed; repeated rows are judged one by one; an empty list blocks nothing; an empty table gives
an empty table. Columns of the input other than the key and the URL are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 512
BITS_PER_URL = 12
PROBES = 8
MAX_BLOCKS = 1 << 18


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to `?` or `#`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` and default ports, path without closing slashes, query without tracking keys and sorted.

    Null where there is no `://`.
    """
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), ":(80|443)$", "")
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    query = F.array_sort(F.filter(query, lambda x: (x != "") & ~x.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)")))
    tail = F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.regexp_replace(path, "/+$", ""), tail))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; nulls if none fits. Rules: (verdict, host, path)."""
    name = verdict = F.lit(None).cast("string")
    for say, at, under in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        name = F.when(fits, at + under).otherwise(name)
        verdict = F.when(fits, say).otherwise(verdict)
    return name, verdict


def _probes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a URL and its bit places there, from two hashes."""
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(two, 9 * (i % 7)).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(7)]
    places += [F.shiftrightunsigned(one, 48).bitwiseAND(F.lit(BLOCK_BITS - 1))]
    return one.bitwiseAND(F.lit(blocks - 1)), places[:PROBES]


def bloom_blocks(listed: DataFrame, key: str) -> np.ndarray:
    """The filter of a list: (blocks, 8) words. Blocks are a power of two, at most MAX_BLOCKS."""
    count = listed.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * BLOCK_BITS < count * BITS_PER_URL:
        blocks *= 2
    block, places = _probes(F.col(key), blocks)
    bits = listed.select(block.alias("block"), F.explode(F.array_distinct(F.array(*places))).alias("bit"))
    words = [
        F.bit_or(F.when(F.shiftright("bit", 6) == w, F.expr("shiftleft(1L, cast(bit & 63 as int))")).otherwise(F.lit(0)))
        .alias(f"w{w}") for w in range(BLOCK_BITS // 64)
    ]
    table = np.zeros((blocks, BLOCK_BITS // 64), np.int64)
    for row in bits.groupBy("block").agg(*words).toLocalIterator():  # at most MAX_BLOCKS rows
        table[row[0]] = row[1:]
    return table.view(np.uint64)


def may_be_listed(df: DataFrame, key: str, table: np.ndarray) -> Column:
    """True for every listed key, and for a few others."""
    filter_bits = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def hit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        bits = filter_bits.value
        for block, places in batches:
            if not len(block):
                yield pd.Series([], dtype=bool)
                continue
            at = np.stack(places.to_numpy()).astype(np.uint64)
            words = bits[block.to_numpy()[:, None], (at >> np.uint64(6)).astype(np.int64)]
            yield pd.Series(((words >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1))

    block, places = _probes(F.col(key), len(table))
    return hit(block, F.array(*places))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, canonical, rule, listed, verdict of each row. `listed` has one column of canonical URLs.

    A rule decides; else a listed URL is blocked and any other allowed.
    """
    name = listed.columns[0]
    known = listed.select(F.col(name).alias("listed_url")).where(F.col("listed_url").isNotNull()).distinct()
    host, path = host_and_path(F.col(url))
    rows = pages.select(key, host.alias("host"), path.alias("path"), canonical(F.col(url)).alias("canonical"))
    table = bloom_blocks(known, "listed_url")
    rows = rows.withColumn("maybe", F.col("canonical").isNotNull() & may_be_listed(rows, "canonical", table))
    hits = rows.where("maybe").join(known, F.col("canonical") == F.col("listed_url"), "left")
    passed = rows.where("not maybe").withColumn("listed_url", F.lit(None).cast("string"))
    both = hits.unionByName(passed).withColumn("listed", F.col("listed_url").isNotNull())
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return both.select(
        key, "host", "path", "canonical", rule.alias("rule"), "listed",
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )
