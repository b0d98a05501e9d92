"""REST payloads: records as JSON in batches of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import nan_to_null
from millrace.operators.order import row_index
from millrace.sinks.files import MICROS


def payload_batches(df: DataFrame, batch_rows: int, order_by: list[str] | None = None) -> DataFrame:
    """(batch_no, rows, payload): a JSON array of at most `batch_rows` records per row.

    With `order_by` batches are cut along a dense row index. Without it along the place of a row in
    its partition, which needs no sort. Either way a batch cannot grow with copies or hot keys.
    """
    clean = nan_to_null(df)
    record = F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false", **MICROS})
    if order_by:
        numbered = row_index(clean, order_by, "_i")
        batch = F.floor(F.col("_i") / batch_rows).cast("long")
    else:
        numbered = clean.withColumn("_i", F.monotonically_increasing_id())
        in_partition = F.col("_i").bitwiseAND((1 << 33) - 1)
        batch = F.col("_i") - F.pmod(in_partition, F.lit(batch_rows))
    records = numbered.select(batch.alias("batch_no"), "_i", record.alias("_record"))
    listed = F.sort_array(F.collect_list(F.struct("_i", "_record")))
    return records.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat(F.lit("["), F.concat_ws(",", F.transform(listed, lambda r: r["_record"])), F.lit("]")).alias("payload"),
    )
