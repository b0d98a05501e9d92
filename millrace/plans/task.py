"""One task: read, features, pre-checks, stage, post-checks, publish, audit."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.config import is_yes, load_task
from millrace.functions.columns import add_audit_columns
from millrace.operators.report import CheckRun, run_checks
from millrace.plans.endpoints import open_target, read_source
from millrace.plans.features import apply_features
from millrace.plans.runstate import EventLog
from millrace.session import store, stored_until_end
from millrace.sinks.files import MICROS


@dataclass
class TaskResult:
    status: str
    events: EventLog
    pre: CheckRun | None = None
    post: CheckRun | None = None
    error: Exception | None = None

    def report(self) -> DataFrame | None:
        """Pre- and post-check results together, from the collected rows."""
        frames = [run.result_frame() for run in (self.pre, self.post) if run is not None]
        if not frames:
            return None
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


# Sources that are parsed row by row or queried again on every pass, and whose rows may change between
# passes. When checks will read them several times they are landed once as Parquet.
ROW_SOURCES = {
    "csv_read", "csvfile_read", "json_read", "xml_read", "rest_api_read", "mysql_read", "postgres_read", "mssql_read",
    "snowflake_read", "oracle_read",
}


class GateClosed(Exception):
    """A check failed, so the task stops."""


def _audit_checks(events: EventLog, run: CheckRun) -> None:
    for r in sorted(run.results, key=lambda r: r["seq_no"]):
        if r["result"] is not None:
            events.add("CHECK_PERFORMED", r["check"], r["seq_no"])
            events.add("RESULT", r["result"], r["seq_no"])


def write_split(run: CheckRun, path: str, file_type: str = "csv") -> None:
    """Good and rejected rows in one write: `dq_status=good` and `dq_status=bad` below `path`."""
    flagged = run.flagged(run.rejecting)
    status = F.when(F.size("_dq_failed") > 0, "bad").otherwise("good")
    out = flagged.withColumn("dq_status", status).drop("_dq_failed")
    out.write.mode("overwrite").partitionBy("dq_status").options(header=True, escape='"', **MICROS).format(file_type).save(path)


def run_task(
    spark: SparkSession,
    raw: dict,
    connections: dict[str, dict] | None = None,
    run_id: str | None = None,
    iteration: int = 1,
    audit_path: str | None = None,
    lookup: DataFrame | None = None,
    key=None,
    user: str = "millrace",
) -> TaskResult:
    """Run a task dictionary.

    A columnar source is scanned for the check metrics and once more for the write; key, order and
    quantile checks add scans of their columns. With checks, a row source and a frame with features are
    computed once and stored, so that both checks see the rows that are written; what was stored is
    deleted at the end, so the frames of `pre` and `post` can no longer be read, their results can.
    STARTED is in the audit table before the work begins.
    """
    task = load_task(raw)
    body = task["task"]
    events = EventLog(task.get("pipeline_id"), task.get("task_name") or "task", run_id or uuid.uuid4().hex, iteration)
    result = TaskResult("FAILED", events)
    events.add("STATUS", "STARTED")
    if audit_path:
        events.append_to(spark, audit_path)
    try:
        with stored_until_end(spark):
            _run(spark, body, connections or {}, events, result, lookup, key, user)
        result.status = "COMPLETED"
    except Exception as err:  # a failed task is a result, with its cause
        result.error = err
    events.add("STATUS", result.status)
    if audit_path:
        events.append_to(spark, audit_path)
    return result


def _connection(connections: dict, spec: dict) -> dict | None:
    name = spec.get("connection_name")
    return {"connection_name": name, **connections[name]} if name in connections else None


def _run(spark, body, connections, events, result, lookup, key, user) -> None:
    source, target = body["source"], body["target"]
    how = body.get("data_quality_execution") or {}
    checks = body.get("data_quality") or []
    sink = open_target(spark, target, _connection(connections, target))
    if (target.get("operation") or "").lower() == "drop":
        sink.drop()
        return
    read = read_source(spark, source, _connection(connections, source))
    df = apply_features(read, body.get("data_quality_features"), lookup, key)
    checked = is_yes(how.get("pre_check_enable")) or is_yes(how.get("post_check_enable"))
    if checked and (df is not read or _by_row(source)):
        df = store(df, "task-rows")
    _check_and_load(spark, body, how, checks, sink, df, events, result, user)


def _by_row(source: dict) -> bool:
    text = source["source_type"] == "aws_s3_read" and source.get("file_type") in {"csv", "json", "xml"}
    return text or source["source_type"] in ROW_SOURCES


def _check_and_load(spark, body, how, checks, sink, df, events, result, user) -> None:
    target = body["target"]

    if is_yes(how.get("pre_check_enable")):
        result.pre = run_checks(df, checks, source=df, type="pre_check")
        _audit_checks(events, result.pre)
        if not result.pre.passed():
            if how.get("rejected_path"):
                write_split(result.pre, how["rejected_path"])
            raise GateClosed("pre-check failed")

    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    audit = is_yes(target.get("audit_columns"))
    if audit:
        out = add_audit_columns(out, user)
    try:
        rows = sink.stage(out)
        events.add("SRC_RECORD_COUNT", seen.get["rows"])
        if is_yes(how.get("post_check_enable")):
            result.post = run_checks(sink.staged(), checks, source=df, type="post_check", audit_columns=audit)
            _audit_checks(events, result.post)
            if not result.post.passed():
                raise GateClosed("post-check failed")
        sink.publish()
        events.add("TRGT_RECORD_COUNT", rows)
    except Exception:
        sink.discard()
        raise
