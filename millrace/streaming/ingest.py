"""Incremental file ingestion with the row checks applied to each micro-batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.report import run_checks
from millrace.operators.rules import RowRule
from millrace.session import stored_until_end
from millrace.sinks.files import discard, exists
from millrace.sinks.tables import TargetError, operation_name


def ingest_stream(stream: DataFrame, checks: list, target: str, checkpoint: str, operation: str = "append") -> StreamingQuery:
    """Every new row goes to `dq_status=good` or `dq_status=bad`, with the checks it breaks.

    With `replace` the first micro-batch of a stream empties the target; all others append. A batch owns
    the folder of its stream and number and overwrites it, so a batch that is run again adds nothing twice,
    and a second stream into the same target adds to what is there. The stream's id is the one that Spark
    keeps in the checkpoint.
    Only row checks can be told batch by batch; others are refused.
    """
    spark = stream.sparkSession
    operation = operation_name(operation)
    if operation not in {"append", "replace"}:
        raise TargetError(f"a stream can append or replace, not {operation}")
    probe = run_checks(stream, checks)
    other = [c.check for c in probe.active if not isinstance(probe.rules.get(c.seq_no), RowRule)]
    if other:
        raise ValueError(f"not a row check: {', '.join(other)}")

    def write(batch: DataFrame, batch_id: int) -> None:
        with stored_until_end(spark):
            write_batch(batch, batch_id)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stream_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        folder = f"{target}/batch={stream_id}-{batch_id}"
        if batch_id == 0 and operation == "replace" and exists(spark, target) and not exists(spark, folder):
            discard(spark, target)
        flagged = run_checks(batch, checks).flagged()
        bad = F.size("_dq_failed") > 0
        out = flagged.withColumns({
            "dq_status": F.when(bad, "bad").otherwise("good"),
            "dq_failed": F.array_join(F.col("_dq_failed").cast("array<string>"), ","),
        }).drop("_dq_failed")
        out.write.mode("overwrite").partitionBy("dq_status").parquet(folder)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_ingested(spark, target: str, schema) -> DataFrame:
    """All batches, good and bad, with `dq_status`."""
    return spark.read.option("basePath", target).schema(schema).parquet(target)
