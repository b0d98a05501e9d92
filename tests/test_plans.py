"""Tasks, SQL tasks, run state, bulk loads and the stream."""

import json
import os
import pathlib

import pytest

from millrace.plans import runstate as R
from millrace.plans.bulk import run_bulk
from millrace.plans.endpoints import open_target
from millrace.plans.sqltask import restart_plan, run_sql_task, statements_in_order
from millrace.plans.task import run_task
from millrace.sinks.tables import TargetError
from millrace.sources.files import SourceNotFound
from millrace.streaming.ingest import ingest_stream, read_ingested


def csv_task(tmp_path, checks=(), pre="N", post="N", **target):
    (tmp_path / "in").mkdir(exist_ok=True)
    for i in range(2):
        (tmp_path / "in" / f"part{i}.csv").write_text("id,name,born,pay,nation\n" + "".join(
            f"{i * 10 + j},Name {j},2024-01-0{j + 1},{j * 1.5},{'' if j == 2 else 'n' + str(j)}\n" for j in range(5)))
    return {
        "pipeline_id": 7, "task_name": "load",
        "task": {
            "source": {"source_type": "csv_read", "file_path": f"{tmp_path}/in/", "file_name": "*.csv", "delimiter": ",", "header": "Y",
                       "skip_header": None, "skip_footer": None, "quote_char": "", "escape_char": "None", "encoding": "",
                       "select_columns": "", "alias_columns": "None", "chunk_size": 1000},
            "target": {"target_type": "csv_write", "file_path": f"{tmp_path}/out/", "file_name": "people_%YYYY%", "delimiter": ";",
                       "audit_columns": "active", **target},
            "data_quality_execution": {"pre_check_enable": pre, "post_check_enable": post, "rejected_path": f"{tmp_path}/rejected"},
            "data_quality": list(checks),
        },
    }


NOT_NULL = {"seq_no": "1", "check": "column_values_to_not_be_null", "parameters": {"column": "nation"}, "active": "Y",
            "ignore_bad_records": "Y", "threshold_bad_records": 5, "type": "pre_check"}


def published(tmp_path):
    return [d for d in os.listdir(tmp_path / "out")] if (tmp_path / "out").exists() else []


def test_csv_to_csv_with_audit_trail(spark, tmp_path):
    audit = str(tmp_path / "audit")
    result = run_task(spark, csv_task(tmp_path), run_id="r1", audit_path=audit, user="me")
    assert (result.status, result.error) == ("COMPLETED", None)
    (name,) = published(tmp_path)
    assert name.startswith("people_20")
    out = spark.read.options(header=True, sep=";").csv(f"{tmp_path}/out/{name}")
    assert out.count() == 10 and out.columns[-4:] == ["CRTD_BY", "CRTD_DTTM", "UPDT_BY", "UPDT_DTTM"]
    events = R.read_events(spark, audit)
    assert [(r["audit_type"], r["audit_value"]) for r in events.orderBy("process_dttm").collect()] == [
        ("STATUS", "STARTED"), ("SRC_RECORD_COUNT", "10"), ("TRGT_RECORD_COUNT", "10"), ("STATUS", "COMPLETED")]
    summary = R.run_summary(events).first()
    assert (summary["src_count"], summary["trgt_count"], summary["status"]) == (10, 10, "COMPLETED")


def test_failing_pre_check_stops_and_splits(spark, tmp_path):
    result = run_task(spark, csv_task(tmp_path, [NOT_NULL], pre="Y"))
    assert result.status == "FAILED" and "pre-check" in str(result.error)
    assert published(tmp_path) == []
    split = spark.read.option("header", True).csv(f"{tmp_path}/rejected")
    assert {(r["dq_status"], r["count"]) for r in split.groupBy("dq_status").count().collect()} == {("good", 8), ("bad", 2)}
    assert ("RESULT", "FAIL") in [(e[5], e[6]) for e in result.events.rows]
    gate = R.gate(result.events.frame(spark), [1]).first()
    assert gate["passed"] is False


def test_post_check_keeps_the_old_target(spark, tmp_path):
    post = [{"seq_no": "2", "check": "reconciliation", "parameters": {"aggregation": "count", "source_column": "id", "target_column": "id"}, "type": "post_check"},
            {"seq_no": "3", "check": "column_count_comparison", "parameters": {}, "type": "post_check"},
            {"seq_no": "4", "check": "schema_comparison", "parameters": {}, "type": "post_check"}]
    good = run_task(spark, csv_task(tmp_path, post, post="Y"))
    assert (good.status, good.error) == ("COMPLETED", None)
    bad = csv_task(tmp_path, [{"seq_no": "2", "check": "table_row_count_to_equal", "parameters": {"value": 1}, "type": "post_check"}], post="Y")
    bad["task"]["source"]["select_columns"] = "id"
    result = run_task(spark, bad)
    assert result.status == "FAILED"
    (name,) = published(tmp_path)  # no stage is left behind
    assert len(spark.read.options(header=True, sep=";").csv(f"{tmp_path}/out/{name}").columns) == 9
    assert {r["result"] for r in good.report().collect()} == {"PASS"}


def test_features_in_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("MILLRACE_SECRET_COLUMN_KEY", "00" * 16)
    (tmp_path / "lookup.csv").write_text("code,label\n" + "".join(f"{i},L{i}\n" for i in range(20)))
    task = csv_task(tmp_path, audit_columns="inactive", target_type="parquet_write")
    task["task"]["data_quality_features"] = {
        "dq_auto_correction_required": "Y", "dq_lookup_file_path": f"{tmp_path}/lookup.csv", "dq_lkup_key_column": {"id": "code"},
        "dq_auto_correct_columns": {"nation": "label"}, "data_masking_required": "Y",
        "data_masking_columns": {"msk_alpha": ",name", "msk_date": ",born", "msk_numeric": "pay"},
        "data_encryption_required": "Y", "data_encryption_columns": "nation", "data_decryption_required": "N",
    }
    result = run_task(spark, task)
    assert (result.status, result.error) == ("COMPLETED", None)
    (name,) = published(tmp_path)
    got = {r["id"]: r for r in spark.read.parquet(f"{tmp_path}/out/{name}").collect()}
    assert got[12]["name"] == "**** *" and got[12]["born"].startswith("0000-00-00") and got[12]["pay"] is None
    assert got[1]["nation"] == got[11]["nation"] and got[2]["nation"] != got[12]["nation"] and len(got[2]["nation"]) > 40


def test_missing_source_fails_the_task(spark, tmp_path):
    task = csv_task(tmp_path)
    task["task"]["source"]["file_name"] = "none*.csv"
    result = run_task(spark, task)
    assert result.status == "FAILED" and isinstance(result.error, SourceNotFound)
    task["task"]["source"]["source_type"] = "fax_read"
    assert "fax_read" in str(run_task(spark, task).error)


@pytest.mark.parametrize("kind", ["parquet", "json", "xml", "orc"])
def test_file_targets_append(spark, tmp_path, kind):
    for _ in range(2):
        result = run_task(spark, csv_task(tmp_path, target_type=f"{kind}_write", operation="append", audit_columns="inactive"))
        assert result.error is None
    (name,) = published(tmp_path)
    reader = spark.read.option("rowTag", "row") if kind == "xml" else spark.read
    assert reader.format(kind).load(f"{tmp_path}/out/{name}").count() == 20


def test_object_store_target_and_source(spark, tmp_path):
    task = csv_task(tmp_path, target_type="aws_s3_write", file_type="parquet", operation="replace", file_path="out/", connection_name="store")
    store = {"store": {"base_url": f"{tmp_path}/"}}
    assert run_task(spark, task, store).error is None
    (day,) = os.listdir(tmp_path / "out")
    assert len(day) == 8
    back = csv_task(tmp_path, target_type="table_write", operation="create", table_name="from_store", audit_columns="N")
    back["task"]["source"] = {"source_type": "aws_s3_read", "file_type": "parquet", "file_path": "out/", "file_name": "", "connection_name": "store"}
    assert run_task(spark, back, store).error is None
    got = spark.table("from_store")
    assert got.count() == 10 and {t for _, t in got.dtypes} == {"string"}


def test_table_targets(spark, tmp_path):
    def load(operation, post="N", checks=()):
        return run_task(spark, csv_task(tmp_path, checks, post=post, target_type="table_write", operation=operation, schema="default", table_name="people"))

    assert load("append").status == "FAILED"
    assert load("create").status == "COMPLETED" and load("create").status == "FAILED"
    assert load("append").status == "COMPLETED" and spark.table("people").count() == 20
    rows = {"seq_no": "2", "check": "table_row_count_to_equal", "parameters": {"value": 3}, "type": "post_check"}
    assert load("truncate", "Y", [rows]).status == "FAILED" and spark.table("people").count() == 20
    assert load("truncate").status == "COMPLETED" and spark.table("people").count() == 10
    assert load("replace").status == "COMPLETED" and spark.table("people").count() == 10
    assert not [t.name for t in spark.catalog.listTables() if "stage" in t.name]
    assert load("drop").status == "COMPLETED" and not spark.catalog.tableExists("people")


def test_sql_task(spark):
    statements = [
        {"seq_no": 2, "sql_query": "INSERT INTO st VALUES (1, 'a,b = c'), (2, 'x');;"},
        {"seq_no": 1, "sql_query": "CREATE TABLE st (id INT, s STRING) USING parquet;"},
        {"seq_no": 3, "sql_query": "update st set s = concat(s, ', id = ', id), id = id + 10 where id = 1;\nDELETE FROM st WHERE id = 2;"},
        {"seq_no": 4, "sql_query": "SELECT no_such_column FROM st"},
        {"seq_no": 5, "sql_query": "SELECT * FROM st"},
    ]
    assert [s for s, _ in statements_in_order(statements)] == [1, 2, 3, 3, 4, 5]
    task = {"sql_execution": {"restart": "begin"}, "sql_list": statements}
    results = run_sql_task(spark, task)
    assert [(r.seq_no, r.status) for r in results][-1] == (4, "FAILED")
    assert [tuple(r) for r in spark.table("st").collect()] == [(11, "a,b = c, id = 1")]
    log = {r.seq_no: r.status for r in results}
    assert restart_plan([1, 2, 3, 4, 5], log, "normal") == {4, 5}
    assert restart_plan([1, 2, 3, 4, 5], log, "skip") == {1, 2, 3, 5}
    assert restart_plan([1, 2], {1: "COMPLETED", 2: "COMPLETED"}, "normal") == set()
    with pytest.raises(ValueError):
        restart_plan([1], {}, "maybe")
    del statements[3]
    task["sql_execution"]["restart"] = "normal"
    again = run_sql_task(spark, task, {1: "COMPLETED", 2: "COMPLETED", 3: "COMPLETED"})
    assert [r.seq_no for r in again] == [5] and again[0].frame.count() == 1


def test_update_and_delete_touch_matching_partitions_only(spark, tmp_path, as_rows):
    path = tmp_path / "pt"
    df = spark.range(40).selectExpr("id", "id * 2 as v", "case id % 4 when 0 then 'a' when 1 then \"o'b\" when 2 then 'c' end as p")
    df.coalesce(1).write.partitionBy("p").option("path", str(path)).saveAsTable("pt")

    def files():
        return {(f.parent.name, f.name) for f in path.rglob("*.parquet")}

    def run(text):
        (result,) = run_sql_task(spark, {"sql_list": [{"seq_no": 1, "sql_query": text}]})
        assert result.error is None, result.error

    before = files()
    run("DELETE FROM pt WHERE v >= 60 AND p = 'a'")
    after = files()
    assert {d for d, _ in before - after} == {"p=a"} and len(after) == 4
    run("UPDATE pt SET v = -1 WHERE id < 3")
    run("DELETE FROM pt WHERE id > 1000")
    assert files() != after
    run("DELETE FROM pt WHERE p = \"o'b\" AND id >= 0")
    run("DELETE FROM pt WHERE p IS NULL")
    run("UPDATE pt SET p = 'z' WHERE id = 2")
    got = {tuple(r) for r in spark.table("pt").collect()}
    want = {(i, -1 if i < 3 else i * 2, "z" if i == 2 else "a" if i % 4 == 0 else "c") for i in range(40) if i % 2 == 0 and not (i % 4 == 0 and i >= 30)}
    assert got == want


@pytest.fixture
def changed_table(spark, request):
    name = f"chg_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(0, 10, 1, 5).selectExpr("id", "cast(id as string) as s", "id % 2 = 0 as even").write.saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("text,want", [
    ("DELETE FROM {t} -- don't keep\n WHERE id = 2", {2}),
    ("/* it's; */ DELETE FROM {t} x WHERE x.id IN (SELECT id FROM range(3)) OR s = '--7'", {0, 1, 2}),
    ("DELETE FROM `{t}` WHERE s = 'a;b' OR s = \"5\" ;", {5}),
    ("DELETE FROM {t} WHERE cast(null as boolean)", set()),
    ("DELETE FROM {t} WHERE id = 99", set()),
    ("DELETE FROM {t}", set(range(10))),
])
def test_delete_reads_comments_quotes_and_subqueries(spark, changed_table, text, want):
    from millrace.plans.sqltask import run_statement

    run_statement(spark, text.format(t=changed_table))
    assert {r.id for r in spark.table(changed_table).collect()} == set(range(10)) - want


@pytest.mark.parametrize("text", [
    "DELETE FROM {t} WHER id = 2", "DELETE FROM {t} LIMIT 1", "DELETE FROM {t} WHER", "DELETE FROM {t} WHERE", "DELETE FROM {t} WHERE id = ",
    "DELETE FROM {t} WHERE nothing = 1", "UPDATE {t} SET id = 1 WHER id = 2", "UPDATE {t} SET nothing = 1 WHERE id = 2", "UPDATE {t} x SET id = 1",
    "UPDATE {t} SET id = 1, id = 2 WHERE id = 3", "UPDATE {t} SET s.a = 1 WHERE id = 1", "DELETE FROM none WHERE id = 1", "DELETE {t} WHERE id = 1",
])
def test_misspelt_changes_raise_and_keep_all_rows(spark, changed_table, text):
    from millrace.plans.sqltask import run_statement

    before = sorted(tuple(r) for r in spark.table(changed_table).collect())
    files = sorted(spark.table(changed_table).inputFiles())
    with pytest.raises(Exception):
        run_statement(spark, text.format(t=changed_table))
    spark.catalog.refreshTable(changed_table)
    assert sorted(tuple(r) for r in spark.table(changed_table).collect()) == before
    assert sorted(spark.table(changed_table).inputFiles()) == files


def test_update_reads_comments_brackets_and_quotes(spark, changed_table):
    from millrace.plans.sqltask import run_statement

    run_statement(spark, f"UPDATE {changed_table} SET s = concat('a, b = ', if(id > 2, s, '(')), -- it's old, id = 5\n even = (SELECT max(id) FROM range(3)) = 2 WHERE id < 4")
    want = [(i, "a, b = " + (str(i) if i > 2 else "("), True) if i < 4 else (i, str(i), i % 2 == 0) for i in range(10)]
    assert sorted(tuple(r) for r in spark.table(changed_table).collect()) == want


def test_only_files_with_a_matching_row_are_written_anew(spark, changed_table):
    from millrace.operators.mutate import delete_where, update_where
    from millrace.sinks.tables import rewrite_where

    files = lambda: set(spark.table(changed_table).inputFiles())
    before = files()
    assert rewrite_where(spark, changed_table, "id in (2, 3)", lambda df: delete_where(df, "id in (2, 3)")) == 1
    middle = files()
    assert len(before - middle) == 1 and len(before & middle) == len(before) - 1
    assert rewrite_where(spark, changed_table, "id = 99", lambda df: delete_where(df, "id = 99")) == 0 and files() == middle
    assert rewrite_where(spark, changed_table, "id in (0, 9)", lambda df: update_where(df, {"s": "'x'"}, "id in (0, 9)")) == 2
    assert len(files() & middle) == len(middle) - 2
    assert sorted((r.id, r.s) for r in spark.table(changed_table).collect()) == [(i, "x" if i in (0, 9) else str(i)) for i in range(10) if i not in (2, 3)]


def _rows(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(tuple(r) for r in spark.table(table).collect())


@pytest.mark.parametrize("other_columns", [False, True])
@pytest.mark.parametrize("step", range(4))
def test_a_failed_publish_leaves_a_whole_table(spark, changed_table, monkeypatch, step, other_columns):
    """Each statement of the publish in turn fails, or the run ends right before it."""
    from millrace.sinks import tables

    old = _rows(spark, changed_table)
    new = spark.range(3).selectExpr("id", "'n' as s", "true as even", *(["1 as more"] if other_columns else []))
    stage = tables.stage_table(new, changed_table)
    plain, seen = type(spark).sql, []

    def sql(self, text, *rest, **named):
        if text.startswith(("ALTER", "DROP")):
            seen.append(text)
            if len(seen) == step + 1:
                raise RuntimeError("lost")
        return plain(self, text, *rest, **named)

    monkeypatch.setattr(type(spark), "sql", sql)
    try:
        tables.publish_table(spark, stage, changed_table)
    except RuntimeError:
        pass
    monkeypatch.undo()
    tables.restore_table(spark, changed_table)
    assert _rows(spark, changed_table) in (old, [tuple(r) for r in new.collect()])
    tables.drop_stage(spark, stage) if step == 0 else None


def test_a_swap_cut_off_is_undone(spark, changed_table):
    from millrace.sinks import tables

    old = _rows(spark, changed_table)
    spark.sql(f"ALTER TABLE {changed_table} RENAME TO {changed_table}__{tables.OLD}1")
    assert tables.restore_table(spark, changed_table) and not tables.restore_table(spark, changed_table)
    assert _rows(spark, changed_table) == old


def test_published_table_moves_once_and_leaves_no_folder(spark, changed_table):
    from millrace.sinks.tables import write_table

    root = pathlib.Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    for operation in ("replace", "truncate", "truncate"):
        write_table(spark.table(changed_table).where("id > 6"), changed_table, operation)  # reads the table that it replaces
        assert [r[0] for r in _rows(spark, changed_table)] == [7, 8, 9]
        assert len([f for f in root.iterdir() if f.name.startswith(changed_table)]) == 1
    spark.sql(f"INSERT INTO {changed_table} VALUES (1, 'x', true)")
    assert spark.table(changed_table).count() == 4


def test_an_interrupted_change_is_completed(spark, changed_table, monkeypatch):
    from millrace.operators.mutate import delete_where
    from millrace.sinks import tables

    whole = tables.recover
    calls = []

    def dies(spark, table):
        calls.append(table)
        return whole(spark, table) if len(calls) == 1 else None  # the journal is written, then the run ends

    monkeypatch.setattr(tables, "recover", dies)
    tables.rewrite_where(spark, changed_table, "id < 5", lambda df: delete_where(df, "id < 5"))
    monkeypatch.undo()
    assert spark.table(changed_table).count() == 10  # nothing has moved yet
    assert tables.recover(spark, changed_table) == 1 and tables.recover(spark, changed_table) == 0
    assert {r.id for r in spark.table(changed_table).collect()} == set(range(5, 10))


def test_update_with_functions_and_subqueries(spark):
    spark.sql("DROP TABLE IF EXISTS upd")
    spark.range(6).selectExpr("id", "id as b", "id > 9 as a").write.saveAsTable("upd")
    from millrace.plans.sqltask import run_statement

    run_statement(spark, "UPDATE upd SET a = if(b > 2, b = 4, false), b = (SELECT max(id) FROM range(8)) WHERE id >= 3")
    assert sorted(tuple(r) for r in spark.table("upd").collect()) == [(0, 0, False), (1, 1, False), (2, 2, False), (3, 7, False), (4, 7, True), (5, 7, False)]


def test_dependencies(spark, as_rows):
    flat = R.dependencies_of(spark, 1, {"a": 0, "b": 0, "c": ["a", "b"], "d": ["c"], "e": ["b"]})
    assert as_rows(flat)[:2] == [(1, "a", "0"), (1, "b", "0")] and flat.count() == 6
    assert R.orphan_parents(flat).count() == 0
    status = spark.createDataFrame([(1, "a", "COMPLETED"), (1, "b", "FAILED")], "pipeline_id long, name string, status string")
    assert as_rows(R.ready_tasks(flat, status)) == [(1, "c", "BLOCKED"), (1, "d", "WAITING"), (1, "e", "BLOCKED")]
    status = status.replace("FAILED", "SUCCESS")
    assert as_rows(R.ready_tasks(flat, status)) == [(1, "c", "READY"), (1, "d", "WAITING"), (1, "e", "READY")]
    orphan = R.dependencies_of(spark, 2, {"x": ["missing"]})
    assert as_rows(R.orphan_parents(orphan)) == [(2, "x", "missing")]
    verdicts = {r["pipeline_id"]: r["verdict"] for r in R.validate_dependencies(flat.unionByName(orphan)).collect()}
    assert verdicts == {1: "ok", 2: "no entry task"}


def test_restart(spark, as_rows):
    events = spark.createDataFrame([
        (1, "a", "r1", None, 1, "STATUS", "COMPLETED", 1), (1, "b", "r1", None, 1, "STATUS", "FAILED", 2),
        (1, "a", "r2", None, 1, "STATUS", "STARTED", 3), (1, "a", "r2", None, 1, "STATUS", "COMPLETED", 4),
        (1, "b", "r2", None, 1, "STATUS", "FAILED", 5), (2, "z", "r9", None, 4, "STATUS", "COMPLETED", 6),
    ], "pipeline_id long, name string, run_id string, sequence int, iteration int, audit_type string, audit_value string, t int")
    events = events.selectExpr("* except (t)", "cast(timestamp_seconds(t) as timestamp_ntz) as process_dttm")
    tasks = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "z")], "pipeline_id long, name string")
    assert as_rows(R.restart_set(tasks, events)) == [(1, "b"), (1, "c")]
    assert as_rows(R.not_started(tasks, events)) == [(1, "c")]
    assert as_rows(R.latest_run(events).select("pipeline_id", "run_id", "next_mode", "next_iteration")) == [(1, "r2", "RESTART", 2), (2, "r9", "NORMAL", 4)]
    assert as_rows(R.pipeline_rollup(events, tasks)) == [(1, "r1", 3, 2, "FAILED"), (1, "r2", 3, 2, "FAILED"), (2, "r9", 1, 0, "COMPLETED")]
    assert as_rows(R.skipped_events(tasks, events)) == [(1, "a", "STATUS", "SKIPPED"), (2, "z", "STATUS", "SKIPPED")]


EVENTS = "pipeline_id long, name string, run_id string, sequence int, iteration int, audit_type string, audit_value string, t int"


def _history(spark, rows):
    events = spark.createDataFrame([(1, n, r, None, i, k, v, t) for t, (n, r, i, k, v) in enumerate(rows)], EVENTS)
    return events.selectExpr("* except (t)", "cast(timestamp_seconds(t) as timestamp_ntz) as process_dttm")


def test_three_runs_with_carried_over_tasks(spark, as_rows):
    """b fails twice; a is carried over each time and must not run again."""
    tasks = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "pipeline_id long, name string")
    first = [("a", "r1", 1, "STATUS", "COMPLETED"), ("b", "r1", 1, "STATUS", "FAILED"), ("c", "r1", 1, "STATUS", "NOT STARTED"),
             ("p", "r1", 1, R.PIPELINE_STATUS, "FAILED")]
    second = [("a", "r2", 2, "STATUS", "SKIPPED"), ("b", "r2", 2, "STATUS", "FAILED"), ("c", "r2", 2, "STATUS", "COMPLETED"),
              ("p", "r2", 2, R.PIPELINE_STATUS, "FAILED")]
    third = [("a", "r3", 3, "STATUS", "SKIPPED"), ("c", "r3", 3, "STATUS", "SKIPPED"), ("b", "r3", 3, "STATUS", "COMPLETED"),
             ("p", "r3", 3, R.PIPELINE_STATUS, "COMPLETED")]
    mode = lambda e: as_rows(R.latest_run(e).select("run_id", "status", "next_mode", "next_iteration"))
    one, two, three = _history(spark, first), _history(spark, first + second), _history(spark, first + second + third)
    assert as_rows(R.restart_set(tasks, one)) == [(1, "b"), (1, "c")] and as_rows(R.not_started(tasks, one)) == [(1, "c")]
    assert as_rows(R.restart_set(tasks, two)) == [(1, "b")] and R.restart_set(tasks, three).isEmpty()
    assert mode(two) == [("r2", "FAILED", "RESTART", 3)] and mode(three) == [("r3", "COMPLETED", "NORMAL", 3)]
    assert as_rows(R.pipeline_rollup(three, tasks)) == [(1, "r1", 3, 2, "FAILED"), (1, "r2", 3, 1, "FAILED"), (1, "r3", 3, 0, "COMPLETED")]
    flat = R.dependencies_of(spark, 1, {"a": 0, "b": ["a"], "c": ["a"]})
    status = spark.createDataFrame([(1, "a", "SKIPPED"), (1, "b", "NOT STARTED")], "pipeline_id long, name string, status string")
    assert as_rows(R.ready_tasks(flat, status)) == [(1, "b", "READY"), (1, "c", "READY")]


def test_a_late_success_hides_no_failure(spark, as_rows):
    events = _history(spark, [("a", "r1", 1, "STATUS", "FAILED"), ("b", "r1", 1, "STATUS", "COMPLETED")])
    assert as_rows(R.latest_run(events).select("status", "next_mode")) == [("FAILED", "RESTART")]
    tasks = spark.createDataFrame([(1, "b"), (1, "c"), (1, "d")], "pipeline_id long, name string")
    only = events.where("name = 'b'")
    assert as_rows(R.pipeline_rollup(only, tasks)) == [(1, "r1", 3, 2, "FAILED")]


def test_second_stream_adds_to_the_target(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    checks = [{"seq_no": 1, "check": "column_values_to_not_be_null", "parameters": {"column": "id"}}]

    def ingest(name, operation):
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        ingest_stream(stream, checks, f"{tmp_path}/out", f"{tmp_path}/{name}", operation).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    assert [ingest("a", "append"), ingest("b", "Append"), ingest("a", "append"), ingest("c", "replace"), ingest("c", "replace")] == [10, 20, 20, 10, 10]
    with pytest.raises(TargetError):
        ingest("d", "apend")


@pytest.mark.parametrize("word, rows", [("append", 15), ("Append", 15), ("APPEND ", 15), ("replace", 5), ("truncate", 5), (None, 5)])
def test_file_operations(spark, tmp_path, word, rows):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    target = open_target(spark, {"target_type": "parquet_write", "file_path": f"{tmp_path}/", "file_name": "t", "operation": word})
    target.stage(spark.range(5).toDF("id"))
    target.publish()
    assert spark.read.parquet(f"{tmp_path}/t").count() == rows


def test_unknown_file_operations_are_refused(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    for word in ("apend", "overwrite", "drop", "create"):
        with pytest.raises(TargetError):
            open_target(spark, {"target_type": "parquet_write", "file_path": f"{tmp_path}/", "file_name": "t", "operation": word})
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10 and os.listdir(tmp_path) == ["t"]


def test_bulk(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for i in range(2):
        (tmp_path / "a" / f"x{i}.json").write_text("\n".join(json.dumps({"v": j}) for j in range(3)))
    details = [{"subtask": "1", "source": {"file_path": f"{tmp_path}/a/", "file_type": "json"},
                "target": {"file_path": f"{tmp_path}/b", "file_type": "parquet", "operation": "append"}}]
    assert run_bulk(spark, details * 2) == [("1", 6), ("1", 6)]
    assert spark.read.parquet(f"{tmp_path}/b").count() == 12


def test_bulk_picks_files_and_keeps_the_target(spark, tmp_path):
    for folder, name, n in (("a", "x_1.json", 1), ("a", "y_1.json", 2), ("a/sub", "x_2.json", 4)):
        (tmp_path / folder).mkdir(exist_ok=True, parents=True)
        (tmp_path / folder / name).write_text("\n".join(json.dumps({"v": j}) for j in range(n)))

    def load(operation="replace", **source):
        entry = {"subtask": "1", "source": {"file_path": f"{tmp_path}/a/", "file_type": "json", "schema_ddl": "v int", **source},
                 "target": {"file_path": f"{tmp_path}/b", "file_type": "parquet", "operation": operation}}
        return run_bulk(spark, [entry])[0][1]

    assert load(files_filter_name="x*", subfolder_included="N") == 1
    assert load(object_prefix_name="y", object_sufix_name="json") == 2
    assert load(subfolder_included="Y", object_prefix_name="x") == 5
    with pytest.raises(TargetError):
        load("apend")
    assert spark.read.parquet(f"{tmp_path}/b").count() == 5 and sorted(os.listdir(tmp_path)) == ["a", "b"]


def test_task_leaves_nothing_and_logs_its_start(spark, tmp_path, monkeypatch):
    """What the task stored is gone, and STARTED was there before the work."""
    from millrace.plans import task as T

    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "millrace")
    (tmp_path / "in.csv").write_text("k,v\n1,a\n2,\n")
    raw = {"task_name": "t", "pipeline_id": 1, "task": {
        "source": {"source_type": "csv_read", "file_path": f"{tmp_path}/", "file_name": "in.csv"},
        "target": {"target_type": "parquet_write", "file_path": f"{tmp_path}/", "file_name": "out", "operation": "replace"},
        "data_quality_execution": {"pre_check_enable": "Y", "post_check_enable": "N"},
        "data_quality": [{"seq_no": "1", "check": "column_values_to_be_unique", "parameters": {"column": "k"}, "active": "Y",
                          "ignore_bad_records": "Y", "threshold_bad_records": 0, "type": "pre_check"}],
    }}
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    seen, real = [], T._run
    monkeypatch.setattr(T, "_run", lambda *a: (seen.extend(r["audit_value"] for r in R.read_events(spark, f"{tmp_path}/audit").collect()), real(*a)))
    result = run_task(spark, raw, audit_path=f"{tmp_path}/audit")
    assert result.error is None and seen == ["STARTED"]
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
    events = R.read_events(spark, f"{tmp_path}/audit")
    assert events.where("audit_type = 'STATUS'").count() == 2 and events.count() == len(result.events.rows)


def test_stream_is_incremental_and_replays_once(spark, tmp_path):
    schema = "id long, v string"
    checks = [{"seq_no": 1, "check": "column_values_to_not_be_null", "parameters": {"column": "v"}}]

    def land(name, lo, hi):
        spark.range(lo, hi).selectExpr("id", "case when id % 5 = 0 then null else 'x' end as v").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def ingest():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        ingest_stream(stream, checks, f"{tmp_path}/out", f"{tmp_path}/ck", "replace").awaitTermination()
        got = read_ingested(spark, f"{tmp_path}/out", f"{schema}, dq_failed string, batch string, dq_status string")
        return sorted((r["id"], r["dq_status"]) for r in got.collect())

    def want(n):
        return [(i, "bad" if i % 5 == 0 else "good") for i in range(n)]

    land("a", 0, 10)
    land("b", 10, 30)
    assert ingest() == want(30)
    land("c", 30, 45)
    assert ingest() == want(45)
    # A batch whose commit was lost runs again and adds nothing twice.
    commits = tmp_path / "ck" / "commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    assert ingest() == want(45)


def test_stream_refuses_table_checks(spark, tmp_path):
    stream = spark.readStream.schema("id long").parquet(str(tmp_path))
    with pytest.raises(ValueError):
        ingest_stream(stream, [{"seq_no": 1, "check": "column_values_to_be_unique", "parameters": {"column": "id"}}], "x", "y")
