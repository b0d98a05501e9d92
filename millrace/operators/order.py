"""Dense row index and order checks, both on ranges of similar size.

A window without a partition key pulls all rows into one task, and a window on a key pulls a hot key
into one task. Here rows are cut along the full sort key by Spark's range partitioning.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import plan_bytes
from millrace.session import store

PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 65_536
ROWS_PER_SEGMENT = 500_000
SPREAD = 64  # range partitions of an order check, until these hold ROWS_PER_SEGMENT rows each

PART_BITS = 33  # monotonically_increasing_id: partition number above, place in the partition below
PLACE = (1 << PART_BITS) - 1


def row_index(df: DataFrame, order_by: list[str], name: str = "index", buckets: int | None = None) -> DataFrame:
    """0, 1, 2, ... along `order_by` (which should identify a row, else ties are in any order).

    One range shuffle along the whole key, so a hot leading value is spread, and a sort inside each
    partition. The sorted rows are stored: partition sizes and rows then come from one and the same
    partitioning, whatever happens to executors. No window.
    """
    if buckets is None:
        parallel = df.sparkSession.sparkContext.defaultParallelism
        buckets = min(MAX_PARTITIONS, max(parallel, plan_bytes(df) // PARTITION_BYTES))
    placed = df.repartitionByRange(buckets, *order_by).sortWithinPartitions(*order_by)
    stored = store(placed.withColumn("_at", F.monotonically_increasing_id()), "indexed")
    part = F.shiftright("_at", PART_BITS).cast("int")
    sizes = sorted(tuple(r) for r in stored.groupBy(part.alias("part")).count().collect())
    starts = itertools.accumulate((rows for _, rows in sizes), initial=0)
    table = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "_part int, _start long")
    placed = stored.join(F.broadcast(table), part == F.col("_part"))  # at most MAX_PARTITIONS rows
    within = F.col("_at").bitwiseAND(PLACE)
    return placed.withColumn(name, F.col("_start") + within).drop("_at", "_part", "_start")


def flag_out_of_order(
    df: DataFrame,
    column: str,
    order_by: list[str],
    partition_by: list[str] | None = None,
    flag: str = "_out_of_order",
    decreasing: bool = False,
    strictly: bool = False,
    rows_per_bucket: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Adds a boolean: the row breaks the order against the last non-null value before it.

    Rows with equal order keys follow each other in the order that breaks least: rising for an increasing
    check, falling for a decreasing one. So the answer does not depend on where rows lie, but that of rows
    alike in keys and value any one may be the first. `rows` saves the count, if the caller knows it.

    The rows are cut into segments along partition columns, order columns, value and the partition they
    come from, so neither a hot partition nor a hot order key, nor copies of one row, fill a segment.
    A segment is summed up by its last non-null value; summaries merge from left to right, whatever the cut,
    and what a segment inherits enters it as one more row in front. `rows_per_bucket` sets the rows of a
    segment, not the number of range partitions: Spark samples rows on the driver for each of these.
    """
    parts = partition_by or []
    value = F.col(column)
    if rows is None:
        rows = df.count()
    segments = math.ceil(rows / (rows_per_bucket or ROWS_PER_SEGMENT))
    along = [*parts, *order_by, value.desc() if decreasing else value.asc()]
    if segments <= 1:
        cut, along = df.withColumn("_segment", F.lit(0)), along[len(parts):]
    else:
        cut, along = _segments(df, column, parts, along, segments, rows), ["_at"]
    window = Window.partitionBy("_segment", *parts).orderBy(*along)
    previous = F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    seen = cut.withColumn("_before", previous)
    if segments > 1:
        seen = seen.where("_at >= 0").drop("_at")
    before = F.col("_before")
    if decreasing:
        broken = value >= before if strictly else value > before
    else:
        broken = value <= before if strictly else value < before
    return seen.withColumn(flag, F.coalesce(broken, F.lit(False))).drop("_before", "_segment")


def _segments(df: DataFrame, column: str, parts: list[str], along: list, segments: int, rows: int) -> DataFrame:
    """The rows with `_segment` and `_at`, their place, and per segment a row with the place -1 that holds
    the last non-null value before the segment with its partition.

    The sorted rows are stored, so both passes see the same segments. A range partition is one segment, or
    is cut into segments by place if more are wanted than partitions. The window without a key runs over
    one row per range partition, at most MAX_PARTITIONS.
    """
    partitions = min(segments, MAX_PARTITIONS, max(SPREAD, math.ceil(rows / ROWS_PER_SEGMENT)))
    # Equal rows are told apart by their partition, which stays the same if a lost task runs again.
    along = [*along, F.col("_from")]
    placed = df.withColumn("_from", F.spark_partition_id()).repartitionByRange(partitions, *along)
    placed = placed.sortWithinPartitions(*along).drop("_from")
    stored = store(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    place = F.col("_at").bitwiseAND(PLACE)
    if partitions < segments:
        place = place % math.ceil(rows / segments)
    cut = stored.withColumn("_segment", F.col("_at") - place)  # the place of its first row
    held = list(dict.fromkeys([*parts, column]))
    last = F.max_by(F.struct(*held), F.when(F.col(column).isNotNull(), F.col("_at")))
    ends = cut.groupBy("_segment").agg(last.alias("_last"))
    if partitions < segments:
        ends = ends.withColumn("_part", F.shiftright("_segment", PART_BITS))
        last = F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_segment")))
        heads = _carried(ends.groupBy("_part").agg(last.alias("_last")), "_part").withColumn("_segment", F.lit(-1).cast("long"))
        carried = _carried(ends.unionByName(heads), "_segment", "_part").where("_segment >= 0")
    else:
        carried = _carried(ends, "_segment")
    carried = carried.select("_last.*", "_segment", F.lit(-1).cast("long").alias("_at"))
    return cut.unionByName(carried, allowMissingColumns=True)


def _carried(ends: DataFrame, along: str, *within: str) -> DataFrame:
    """`_last` becomes the last one that is not null before the row; rows without one are left out."""
    before = Window.partitionBy(*within).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumn("_last", F.last("_last", ignorenulls=True).over(before)).where("_last is not null")
