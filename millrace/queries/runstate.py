"""Audit events and run state, with `events` as the audit trail."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import runstate as R
from millrace.plans.sqltask import restart_plan_frame
from millrace.queries.base import Shape, query, table
from millrace.session import scratch_dir

# Users stand for tasks, 25 pipelines, one run per day.
AUDIT = Shape(
    "events",
    "user_id % 25 as pipeline_id",
    "'task_' || cast(user_id as string) as name",
    "'run_' || cast(cast(ts as date) as string) as run_id",
    "cast(event_id % 5 as int) as sequence",
    "cast(1 + event_id % 3 as int) as iteration",
    """case event_type when 'signup' then 'STATUS' when 'error' then 'STATUS'
       when 'view' then (case when event_id % 50 = 0 then 'PIPELINE_STATUS' else 'SRC_RECORD_COUNT' end)
       when 'click' then 'TRGT_RECORD_COUNT' else 'RESULT' end as audit_type""",
    """case event_type when 'signup' then (case when event_id % 11 = 0 then 'SKIPPED' when event_id % 13 = 0 then 'NOT STARTED' else 'COMPLETED' end)
       when 'error' then (case when event_id % 4 = 0 then 'FAILED' else 'COMPLETED' end)
       when 'purchase' then (case when value > 5 then 'PASS' else 'FAIL' end)
       when 'view' then (case when event_id % 50 <> 0 then cast(cast(floor(value) as bigint) as string) when event_id % 100 = 0 then 'COMPLETED' else 'FAILED' end)
       else cast(cast(floor(value) as bigint) as string) end as audit_value""",
    "ts as process_dttm",
)
# Customers stand for the tasks that pipelines declare.
TASKS = Shape("customer", "c_custkey % 25 as pipeline_id", "'task_' || cast(c_custkey as string) as name")
DONE = "('COMPLETED','SUCCESS','SKIPPED')"  # a task that a restart carries over had succeeded

_STATUS = f"""SELECT pipeline_id, run_id, name, arg_max(audit_value, (process_dttm, sequence, audit_value)) as status,
    max(process_dttm) as status_dttm FROM ({AUDIT.sql}) e WHERE audit_type = 'STATUS' GROUP BY 1, 2, 3"""
_RUNS = f"""SELECT pipeline_id, run_id, max(process_dttm) as last_dttm, max(iteration) as iteration,
    arg_max(audit_value, process_dttm) filter (where audit_type = 'PIPELINE_STATUS') as own FROM ({AUDIT.sql}) e GROUP BY 1, 2"""
_RUNS = f"""SELECT r.pipeline_id, r.run_id, last_dttm, iteration, coalesce(own, case when fine then 'COMPLETED' else 'FAILED' end) as status FROM ({_RUNS}) r
    LEFT JOIN (SELECT pipeline_id, run_id, bool_and(status in {DONE}) as fine FROM ({_STATUS}) s GROUP BY 1, 2) f USING (pipeline_id, run_id)"""
_LATEST = f"SELECT * FROM (SELECT *, row_number() over (partition by pipeline_id order by last_dttm desc, run_id desc) as rn FROM ({_RUNS}) r) x WHERE rn = 1"
_LATEST_STATUS = f"SELECT s.* FROM ({_STATUS}) s JOIN ({_LATEST}) l USING (pipeline_id, run_id)"


def _events(spark, sf_dir):
    return AUDIT.frame(spark, sf_dir)


@query("audit_events", AUDIT.sql)
def audit_events(spark, sf_dir):
    """Two appends to one event table, read back with its schema."""
    path = scratch_dir(spark, "audit")
    events = _events(spark, sf_dir)
    events.where("audit_type = 'STATUS'").write.mode("append").parquet(path)
    events.where("audit_type <> 'STATUS'").write.mode("append").parquet(path)
    return R.read_events(spark, path)


@query("task_status", _STATUS)
def task_status(spark, sf_dir):
    return R.task_status(_events(spark, sf_dir))


@query("latest_run", f"""SELECT pipeline_id, run_id, last_dttm, status, case when status in {DONE} then 'NORMAL' else 'RESTART' end as next_mode,
    cast(case when status in {DONE} then iteration else iteration + 1 end as integer) as next_iteration FROM ({_LATEST}) l""")
def latest_run(spark, sf_dir):
    return R.latest_run(_events(spark, sf_dir))


@query("restart_set", f"SELECT DISTINCT pipeline_id, name FROM ({TASKS.sql}) t WHERE (pipeline_id, name) NOT IN (SELECT (pipeline_id, name) FROM ({_LATEST_STATUS}) s WHERE status in {DONE})")
def restart_set(spark, sf_dir):
    return R.restart_set(TASKS.frame(spark, sf_dir), _events(spark, sf_dir))


@query("restart_skipped", f"""SELECT DISTINCT pipeline_id, name, 'STATUS' as audit_type, 'SKIPPED' as audit_value FROM ({TASKS.sql}) t
    WHERE (pipeline_id, name) IN (SELECT (pipeline_id, name) FROM ({_LATEST_STATUS}) s WHERE status in {DONE})""")
def restart_skipped(spark, sf_dir):
    return R.skipped_events(TASKS.frame(spark, sf_dir), _events(spark, sf_dir))


_DECLARED = f"SELECT DISTINCT pipeline_id, name FROM ({TASKS.sql}) t"
_EXPECTED = f"""SELECT pipeline_id, run_id, name FROM (SELECT DISTINCT pipeline_id, run_id FROM ({AUDIT.sql}) e) r JOIN ({_DECLARED}) d USING (pipeline_id)
    UNION SELECT pipeline_id, run_id, name FROM ({_STATUS}) s"""


@query("pipeline_rollup", f"""SELECT pipeline_id, run_id, count(*) as tasks, count(*) filter (where not fine) as not_successful,
    case when bool_and(fine) then 'COMPLETED' else 'FAILED' end as status FROM
    (SELECT x.*, coalesce(status in {DONE}, false) as fine FROM ({_EXPECTED}) x LEFT JOIN ({_STATUS}) s USING (pipeline_id, run_id, name)) y GROUP BY 1, 2""")
def pipeline_rollup(spark, sf_dir):
    """Declared tasks that a run never reached count."""
    return R.pipeline_rollup(_events(spark, sf_dir), TASKS.frame(spark, sf_dir))


@query("pipeline_rollup_seen", f"""SELECT pipeline_id, run_id, count(name) as tasks, count(*) filter (where name is not null and status not in {DONE}) as not_successful,
    case when bool_and(coalesce(status in {DONE}, true)) then 'COMPLETED' else 'FAILED' end as status FROM
    (SELECT DISTINCT pipeline_id, run_id FROM ({AUDIT.sql}) e) r LEFT JOIN ({_STATUS}) s USING (pipeline_id, run_id) GROUP BY 1, 2""")
def pipeline_rollup_seen(spark, sf_dir):
    """The same where no task is declared: those with a status decide."""
    return R.pipeline_rollup(_events(spark, sf_dir), TASKS.frame(spark, sf_dir).where("false"))


_STARTED = f"SELECT (pipeline_id, name) FROM ({_LATEST_STATUS}) s WHERE status <> 'NOT STARTED'"


@query("not_started", f"SELECT * FROM ({_DECLARED}) t WHERE (pipeline_id, name) NOT IN ({_STARTED})")
def not_started(spark, sf_dir):
    return R.not_started(TASKS.frame(spark, sf_dir), _events(spark, sf_dir))


@query("not_started_events", f"SELECT *, 'STATUS' as audit_type, 'NOT STARTED' as audit_value FROM ({_DECLARED}) t WHERE (pipeline_id, name) NOT IN ({_STARTED})")
def not_started_events(spark, sf_dir):
    return R.not_started_events(TASKS.frame(spark, sf_dir), _events(spark, sf_dir))


_SUMMARY = f"""SELECT pipeline_id, run_id, name,
    cast(sum(try_cast(audit_value as bigint)) filter (where audit_type = 'SRC_RECORD_COUNT') as bigint) as src_count,
    cast(sum(try_cast(audit_value as bigint)) filter (where audit_type = 'TRGT_RECORD_COUNT') as bigint) as trgt_count,
    min(process_dttm) as start_time, max(process_dttm) as end_time,
    arg_max(audit_value, process_dttm) filter (where audit_type = 'STATUS') as status FROM ({AUDIT.sql}) e GROUP BY 1, 2, 3"""


@query("run_summary", _SUMMARY)
def run_summary(spark, sf_dir):
    return R.run_summary(_events(spark, sf_dir))


@query("record_counts", f"""SELECT pipeline_id, run_id, cast(sum(src_count) as bigint) as src_count, cast(sum(trgt_count) as bigint) as trgt_count,
    sum(src_count) is not distinct from sum(trgt_count) as agree FROM ({_SUMMARY}) s GROUP BY 1, 2""")
def record_counts(spark, sf_dir):
    return R.record_counts(_events(spark, sf_dir))


@query("dq_gate", f"""SELECT pipeline_id, run_id, name, count(*) as checks, count(*) filter (where audit_value <> 'PASS') as failed_checks,
    bool_and(audit_value = 'PASS') as passed FROM ({AUDIT.sql}) e WHERE audit_type = 'RESULT' and sequence in (0, 1, 2, 4) GROUP BY 1, 2, 3""")
def dq_gate(spark, sf_dir):
    """The checks 0, 1, 2 and 4 of a task decide."""
    return R.gate(_events(spark, sf_dir), [0, 1, 2, 4])


# Orders stand for pipelines, their lines for tasks: line k waits for k-1, every third also for k-2.
# Lines that an order lacks are unknown parents.
_GRAPH = """SELECT DISTINCT l_orderkey as pipeline_id, l_linenumber as k FROM lineitem"""
_FLAT = f"""SELECT pipeline_id, 'l' || cast(k as string) as task_name, case when k = 1 then '0' else 'l' || cast(k - 1 as string) end as task_depended_on FROM ({_GRAPH}) g
    UNION ALL SELECT pipeline_id, 'l' || cast(k as string), 'l' || cast(k - 2 as string) FROM ({_GRAPH}) g WHERE k > 1 and k % 3 = 0"""
_ORPHANS = f"SELECT * FROM ({_FLAT}) f WHERE task_depended_on <> '0' and (pipeline_id, task_depended_on) NOT IN (SELECT (pipeline_id, task_name) FROM ({_FLAT}) t)"
_CODE = "min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) * 10 + min(l_suppkey) % 3"
_STATE_OF = "case when c >= 30 then (case c when 30 then 'SKIPPED' else 'COMPLETED' end) when c = 20 then 'NOT STARTED' when c > 20 then 'FAILED' end"
_STATE = f"""SELECT l_orderkey as pipeline_id, 'l' || cast(l_linenumber as string) as name, {_STATE_OF} as status
    FROM (SELECT l_orderkey, l_linenumber, {_CODE} as c FROM lineitem GROUP BY 1, 2) x"""


def _pipelines(spark, sf_dir):
    parents = F.expr("""case when k = 1 then array() when k % 3 = 0 then array('l' || (k - 1), 'l' || (k - 2)) else array('l' || (k - 1)) end""")
    graph = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pipeline_id"), F.col("l_linenumber").alias("k")).distinct()
    return graph.select("pipeline_id", F.concat(F.lit("l"), F.col("k").cast("string")).alias("name"), parents.alias("parents"))


def _flat(spark, sf_dir):
    return R.flatten_dependencies(_pipelines(spark, sf_dir))


def _states(spark, sf_dir):
    coded = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.expr(_CODE).alias("c"))
    return coded.selectExpr("l_orderkey as pipeline_id", "'l' || cast(l_linenumber as string) as name", f"{_STATE_OF} as status").where("status is not null")


@query("dep_flatten", _FLAT)
def dep_flatten(spark, sf_dir):
    return _flat(spark, sf_dir)


@query("dep_orphans", _ORPHANS)
def dep_orphans(spark, sf_dir):
    return R.orphan_parents(_flat(spark, sf_dir))


@query("dep_validate", f"""SELECT pipeline_id, entry_tasks, coalesce(orphans, 0) as orphans,
    case when entry_tasks = 0 then 'no entry task' when coalesce(orphans, 0) > 0 then 'unknown parent' else 'ok' end as verdict FROM
    (SELECT pipeline_id, count(*) filter (where task_depended_on = '0') as entry_tasks FROM ({_FLAT}) f GROUP BY 1) e
    LEFT JOIN (SELECT pipeline_id, count(*) as orphans FROM ({_ORPHANS}) o GROUP BY 1) o USING (pipeline_id)""")
def dep_validate(spark, sf_dir):
    return R.validate_dependencies(_flat(spark, sf_dir))


@query("ready_tasks", f"""SELECT pipeline_id, task_name, case when bool_or(coalesce(p.status = 'FAILED', false)) then 'BLOCKED'
    when bool_and(task_depended_on = '0' or coalesce(p.status in ('COMPLETED', 'SKIPPED'), false)) then 'READY' else 'WAITING' end as state
    FROM ({_FLAT}) f LEFT JOIN (SELECT pipeline_id, name as task_depended_on, status FROM ({_STATE}) s) p USING (pipeline_id, task_depended_on)
    WHERE (pipeline_id, task_name) NOT IN (SELECT (pipeline_id, name) FROM ({_STATE}) s WHERE status <> 'NOT STARTED') GROUP BY 1, 2""")
def ready_tasks(spark, sf_dir):
    return R.ready_tasks(_flat(spark, sf_dir), _states(spark, sf_dir))


_LOG = """SELECT l_orderkey, l_linenumber as seq_no, case min(l_returnflag) when 'A' then 'COMPLETED' when 'R' then 'FAILED' end as status
    FROM lineitem GROUP BY 1, 2"""


@query("sql_restart_plan", f"""SELECT l_orderkey, seq_no, status, true as run_begin, coalesce(seq_no >= first, false) as run_normal, status is distinct from 'FAILED' as run_skip
    FROM ({_LOG}) g LEFT JOIN (SELECT l_orderkey, min(seq_no) as first FROM ({_LOG}) h WHERE status is distinct from 'COMPLETED' GROUP BY 1) f USING (l_orderkey)""")
def sql_restart_plan(spark, sf_dir):
    """Orders stand for SQL tasks, lines for their statements."""
    log = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("seq_no")).agg(
        F.expr("case min(l_returnflag) when 'A' then 'COMPLETED' when 'R' then 'FAILED' end").alias("status")
    )
    return restart_plan_frame(log, ["l_orderkey"])
