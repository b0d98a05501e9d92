"""Run state as queries over an append-only table of audit events.

Every function first reduces events to one row per (pipeline, run, task) with a map-side aggregate,
so a pipeline that holds a large share of all events is small before anything is joined.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "pipeline_id long, name string, run_id string, sequence int, iteration int, "
    "audit_type string, audit_value string, process_dttm timestamp_ntz"
)
DONE = ("COMPLETED", "SUCCESS", "SKIPPED")  # SKIPPED: carried over by a restart, so it had succeeded
NOT_STARTED = "NOT STARTED"
PIPELINE_STATUS = "PIPELINE_STATUS"  # the audit type of a pipeline's own status; STATUS is a task's
TASK = ["pipeline_id", "run_id", "name"]


@dataclass
class EventLog:
    """Events of one task run, collected on the driver (a handful) and appended when asked to."""

    pipeline_id: int | None
    name: str
    run_id: str
    iteration: int = 1
    rows: list[tuple] = field(default_factory=list)
    written: int = 0

    def add(self, audit_type: str, value, sequence: int | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.rows.append((self.pipeline_id, self.name, self.run_id, sequence, self.iteration, audit_type, str(value), now))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, AUDIT_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        """Append the events that are not in the table yet."""
        new = spark.createDataFrame(self.rows[self.written:], AUDIT_SCHEMA)
        new.coalesce(1).write.mode("append").parquet(path)
        self.written = len(self.rows)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def _done(status: Column) -> Column:
    return status.isin(*DONE)


def task_status(events: DataFrame) -> DataFrame:
    """The last STATUS event of each task of each run."""
    last = F.struct("process_dttm", F.coalesce("sequence", F.lit(-1)), "audit_value")
    return events.where("audit_type = 'STATUS'").groupBy(*TASK).agg(
        F.max_by("audit_value", last).alias("status"),
        F.max("process_dttm").alias("status_dttm"),
    )


def latest_run(events: DataFrame) -> DataFrame:
    """Per pipeline: its newest run, that run's iteration and the mode a restart would use.

    The status is the pipeline's own last one; a run that has none (it was broken off, or the log is
    older) is COMPLETED if all tasks with a status succeeded, else FAILED.
    """
    own = F.col("audit_type") == PIPELINE_STATUS
    runs = events.groupBy("pipeline_id", "run_id").agg(
        F.max("process_dttm").alias("last_dttm"),
        F.max("iteration").alias("iteration"),
        F.max_by(F.when(own, F.col("audit_value")), F.when(own, F.struct("process_dttm", "audit_value"))).alias("own"),
    )
    newest = F.max(F.struct("last_dttm", "run_id", "iteration", "own")).alias("r")
    per = runs.groupBy("pipeline_id").agg(newest).select("pipeline_id", "r.*")
    tasks = task_status(events).groupBy("pipeline_id", "run_id").agg(F.every(_done(F.col("status"))).alias("fine"))
    per = per.join(tasks, ["pipeline_id", "run_id"], "left")
    status = F.coalesce("own", F.when(F.col("fine"), "COMPLETED").otherwise("FAILED"))
    done = _done(status)
    return per.select(
        "pipeline_id", "run_id", "last_dttm", status.alias("status"),
        F.when(done, "NORMAL").otherwise("RESTART").alias("next_mode"),
        F.when(done, F.col("iteration")).otherwise(F.col("iteration") + 1).alias("next_iteration"),
    )


def _latest_status(events: DataFrame) -> DataFrame:
    newest = latest_run(events).select("pipeline_id", "run_id")
    return task_status(events).join(newest, ["pipeline_id", "run_id"])


def restart_set(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """Tasks (pipeline_id, name) that a restart runs: all but those that succeeded in the newest run."""
    done = _latest_status(events).where(_done(F.col("status"))).select("pipeline_id", "name")
    return tasks.select("pipeline_id", "name").distinct().join(done, ["pipeline_id", "name"], "left_anti")


def skipped_events(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """Tasks that a restart carries over, as STATUS SKIPPED."""
    done = _latest_status(events).where(_done(F.col("status"))).select("pipeline_id", "name")
    return tasks.select("pipeline_id", "name").distinct().join(done, ["pipeline_id", "name"], "left_semi").select(
        "pipeline_id", "name", F.lit("STATUS").alias("audit_type"), F.lit("SKIPPED").alias("audit_value")
    )


def pipeline_rollup(events: DataFrame, tasks: DataFrame) -> DataFrame:
    """A run is COMPLETED if every task of it succeeded, those that are declared but never started included."""
    declared = tasks.select("pipeline_id", "name").distinct()
    seen = task_status(events).join(declared.withColumn("_declared", F.lit(True)), ["pipeline_id", "name"], "left")
    known, done = F.col("_declared").isNotNull(), _done(F.col("status"))
    by_run = seen.groupBy("pipeline_id", "run_id").agg(
        F.count_if(known & done).alias("_done"), F.count_if(~known).alias("_other"), F.count_if(~known & ~done).alias("_other_bad")
    )
    runs = events.select("pipeline_id", "run_id").distinct().join(by_run, ["pipeline_id", "run_id"], "left")
    runs = runs.join(declared.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("_all")), "pipeline_id", "left").na.fill(0)
    bad = F.col("_all") - F.col("_done") + F.col("_other_bad")
    return runs.select(
        "pipeline_id", "run_id", (F.col("_all") + F.col("_other")).alias("tasks"), bad.alias("not_successful"),
        F.when(bad == 0, "COMPLETED").otherwise("FAILED").alias("status"),
    )


def not_started(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """Tasks without a STATUS event in the newest run of their pipeline, or with NOT STARTED as the last one."""
    started = _latest_status(events).where(F.col("status") != NOT_STARTED).select("pipeline_id", "name")
    return tasks.select("pipeline_id", "name").distinct().join(started, ["pipeline_id", "name"], "left_anti")


def not_started_events(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """What a run that failed logs for the tasks it never reached."""
    return not_started(tasks, events).select(
        "pipeline_id", "name", F.lit("STATUS").alias("audit_type"), F.lit(NOT_STARTED).alias("audit_value")
    )


def flatten_dependencies(pipelines: DataFrame) -> DataFrame:
    """(pipeline_id, name, parents array) -> one row per parent; '0' for a task without parents."""
    return pipelines.select(
        "pipeline_id", F.col("name").alias("task_name"), F.explode_outer("parents").alias("parent")
    ).select("pipeline_id", "task_name", F.coalesce("parent", F.lit("0")).alias("task_depended_on"))


def dependencies_of(spark: SparkSession, pipeline_id: int, tasks_details: dict) -> DataFrame:
    """The same from a pipeline's `{task: 0 or [parents]}`."""
    rows = [(pipeline_id, t, [] if p == 0 else [str(x) for x in p]) for t, p in tasks_details.items()]
    return flatten_dependencies(spark.createDataFrame(rows, "pipeline_id long, name string, parents array<string>"))


def orphan_parents(flat: DataFrame) -> DataFrame:
    """Parents that are no task of their pipeline."""
    tasks = flat.select("pipeline_id", F.col("task_name").alias("task_depended_on")).distinct()
    return flat.where("task_depended_on <> '0'").join(tasks, ["pipeline_id", "task_depended_on"], "left_anti").select(
        "pipeline_id", "task_name", "task_depended_on"
    )


def validate_dependencies(flat: DataFrame) -> DataFrame:
    """Per pipeline: has a task to start with, and no unknown parent."""
    unknown = orphan_parents(flat).groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("orphans"))
    entry = flat.groupBy("pipeline_id").agg(F.count_if(F.col("task_depended_on") == "0").alias("entry_tasks"))
    joined = entry.join(unknown, "pipeline_id", "left").withColumn("orphans", F.coalesce("orphans", F.lit(0)))
    verdict = F.when(F.col("entry_tasks") == 0, "no entry task").when(F.col("orphans") > 0, "unknown parent").otherwise("ok")
    return joined.withColumn("verdict", verdict)


def ready_tasks(flat: DataFrame, status: DataFrame) -> DataFrame:
    """State of each task that has no status yet: READY, BLOCKED (a parent failed) or WAITING.

    `status` holds (pipeline_id, name, status).
    """
    begun = status.where(F.col("status") != NOT_STARTED)
    own = begun.select("pipeline_id", F.col("name").alias("task_name"))
    parent = begun.select("pipeline_id", F.col("name").alias("task_depended_on"), F.col("status").alias("_status"))
    open_tasks = flat.join(own, ["pipeline_id", "task_name"], "left_anti")
    root = F.col("task_depended_on") == "0"  # all roots share this key, and it has no status to look up
    seen = open_tasks.where(~root).join(parent, ["pipeline_id", "task_depended_on"], "left")
    seen = seen.select("pipeline_id", "task_name", F.coalesce(_done(F.col("_status")), F.lit(False)).alias("_fine"),
                       F.coalesce(F.col("_status") == "FAILED", F.lit(False)).alias("_failed"))
    roots = open_tasks.where(root).select("pipeline_id", "task_name", F.lit(True).alias("_fine"), F.lit(False).alias("_failed"))
    return seen.unionByName(roots).groupBy("pipeline_id", "task_name").agg(
        F.when(F.some("_failed"), "BLOCKED").when(F.every("_fine"), "READY").otherwise("WAITING").alias("state")
    )


def run_summary(events: DataFrame) -> DataFrame:
    """Per task of a run: counts, first and last time, last status, in one aggregate."""
    kind, value = F.col("audit_type"), F.col("audit_value")

    def total(name):
        return F.sum(F.when(kind == name, value.try_cast("bigint"))).alias(f"{name.split('_')[0].lower()}_count")

    is_status = kind == "STATUS"
    return events.groupBy(*TASK).agg(
        total("SRC_RECORD_COUNT"),
        total("TRGT_RECORD_COUNT"),
        F.min("process_dttm").alias("start_time"),
        F.max("process_dttm").alias("end_time"),
        F.max_by(F.when(is_status, value), F.when(is_status, F.struct("process_dttm", "audit_value"))).alias("status"),
    )


def record_counts(events: DataFrame) -> DataFrame:
    """Source and target rows per run and whether they agree."""
    s = run_summary(events)
    per = s.groupBy("pipeline_id", "run_id").agg(F.sum("src_count").alias("src_count"), F.sum("trgt_count").alias("trgt_count"))
    return per.withColumn("agree", F.col("src_count").eqNullSafe(F.col("trgt_count")))


def gate(events: DataFrame, sequences: list[int] | None = None) -> DataFrame:
    """Per task of a run: may it go on? Every RESULT event of the listed checks must be PASS."""
    results = events.where("audit_type = 'RESULT'")
    if sequences is not None:
        results = results.where(F.col("sequence").isin(sequences))
    return results.groupBy(*TASK).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("audit_value") != "PASS").alias("failed_checks"),
        F.every(F.col("audit_value") == "PASS").alias("passed"),
    )
