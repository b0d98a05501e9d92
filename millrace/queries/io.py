"""Sources, sinks, write modes, SQL tasks, bulk loads and the stream: written and read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.report import run_checks
from millrace.plans.bulk import run_bulk
from millrace.plans.sqltask import run_sql_task
from millrace.plans.task import run_task, write_split
from millrace.queries.base import DIRTY_ORDERS, query, table
from millrace.session import scratch_dir
from millrace.sinks.files import write_dated, write_files
from millrace.sinks.payload import payload_batches
from millrace.sinks.tables import write_table
from millrace.sources.files import read_csv, read_json, read_orc, read_parquet, read_payload, read_prefix, read_xml
from millrace.sources.manifest import file_manifest
from millrace.streaming.ingest import ingest_stream, read_ingested

ORDERS_DDL = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
CUSTOMER_DDL = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _written(spark, sf_dir, name, file_type, options=None, df=None):
    path = scratch_dir(spark, name)
    write_files(table(spark, sf_dir, name) if df is None else df, path, file_type, options=options)
    return path


# ---------------------------------------------------------------- sources


@query("src_csv", "SELECT c_custkey as id, c_name as name, c_mktsegment as segment FROM customer")
def src_csv(spark, sf_dir):
    """`;` as delimiter, a header, some columns under new names, types inferred."""
    path = _written(spark, sf_dir, "customer", "csv", {"sep": ";"})
    df = read_csv(spark, path, delimiter=";", select="c_custkey,c_name,c_mktsegment", alias="id,name,segment")
    return df.withColumn("id", F.col("id").cast("long"))


@query("src_csv_compressed", "SELECT * FROM customer")
def src_csv_compressed(spark, sf_dir):
    path = _written(spark, sf_dir, "customer", "csv", {"compression": "gzip"})
    return read_csv(spark, path, schema=CUSTOMER_DDL)


@query("src_csv_quoted", "SELECT * FROM documents")
def src_csv_quoted(spark, sf_dir):
    """Whole documents with quotes, commas and line breaks inside the values."""
    path = _written(spark, sf_dir, "documents", "csv", {"quoteAll": True}, table(spark, sf_dir, "documents"))
    return read_csv(spark, path, schema="doc_id long, text string, lang string, source string, n_chars long", multi_line=True)


@query("proj_default_names", """SELECT c_custkey as column1, c_name as column2, c_nationkey as column3, c_acctbal as column4, c_mktsegment as column5
    FROM customer""")
def proj_default_names(spark, sf_dir):
    path = _written(spark, sf_dir, "customer", "csv", {"header": False})
    names = read_csv(spark, path, header=False)
    return names.withColumn("column1", F.col("column1").cast("long"))


@query("src_parquet", "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'")
def src_parquet(spark, sf_dir):
    """Column selection and the filter reach the scan."""
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet").where("l_shipdate >= timestamp_ntz'2000-01-01'").select("l_orderkey", "l_extendedprice")


@query("src_json", "SELECT * FROM events")
def src_json(spark, sf_dir):
    return read_json(spark, _written(spark, sf_dir, "events", "json"), lines=True, schema=EVENT_SCHEMA)


@query("src_xml", "SELECT * FROM customer")
def src_xml(spark, sf_dir):
    path = _written(spark, sf_dir, "customer", "xml")
    return read_xml(spark, path, schema=CUSTOMER_DDL)


@query("src_orc", "SELECT o_orderkey, o_orderpriority FROM orders")
def src_orc(spark, sf_dir):
    return read_orc(spark, _written(spark, sf_dir, "orders", "orc"), select=["o_orderkey", "o_orderpriority"])


@query("src_object_prefix", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def src_object_prefix(spark, sf_dir):
    """All objects below a prefix that have the extension of their type, in any depth."""
    root = scratch_dir(spark, "prefix")
    df = table(spark, sf_dir, "customer")
    write_files(df, f"{root}/land_a/2024", "csv")
    write_files(df, f"{root}/land_b", "csv")
    write_files(df, f"{root}/land_b/other", "json")
    write_files(df, f"{root}/elsewhere", "csv")
    return read_prefix(spark, f"{root}/land", "csv", schema=CUSTOMER_DDL)


@query("src_rest_payload", "SELECT * FROM customer")
def src_rest_payload(spark, sf_dir):
    """Responses landed as arrays of records."""
    path = scratch_dir(spark, "payload")
    batches = payload_batches(table(spark, sf_dir, "customer"), 100, ["c_custkey"])
    batches.select("payload").write.text(path)
    return read_json(spark, path, lines=True, schema=CUSTOMER_DDL)


@query("src_rest_wrapped", "SELECT * FROM customer")
def src_rest_wrapped(spark, sf_dir):
    """Responses that hold their records under a field, one per file, as they are landed."""
    path = scratch_dir(spark, "wrapped")
    df = table(spark, sf_dir, "customer")
    batches = payload_batches(df, 5000, ["c_custkey"])
    responses = batches.select(F.concat(F.lit('{"data":'), "payload", F.lit("}")).alias("value"))
    responses.write.option("maxRecordsPerFile", 1).text(path)
    return read_payload(spark, path, "data", f"data array<{df.schema.simpleString()}>")


@query("skip_header_footer", "SELECT * FROM customer")
def skip_header_footer(spark, sf_dir):
    """Files with a header, two lines to skip after it and one at the end, each file on its own."""
    path = scratch_dir(spark, "edges")
    df = table(spark, sf_dir, "customer").repartition(spark.sparkContext.defaultParallelism)
    header = ",".join(df.columns)
    lines = df.select(F.to_csv(F.struct(*df.columns)).alias("value"))

    def with_edges(batches):
        import pandas as pd

        yield pd.DataFrame({"value": [header, "skip,me", "and,me"]})
        yield from batches
        yield pd.DataFrame({"value": ["rows,of,this,file,end"]})

    lines.mapInPandas(with_edges, "value string").write.text(path)
    return read_csv(spark, path, skip_header=2, skip_footer=1, schema=CUSTOMER_DDL)


@query("skip_header_footer_inferred", """SELECT c_custkey as column1, c_name as column2, cast(c_nationkey as bigint) as column3, c_acctbal as column4,
    c_mktsegment as column5 FROM customer""")
def skip_header_footer_inferred(spark, sf_dir):
    """The same, with the types found after the edges are gone."""
    path = scratch_dir(spark, "edges")
    df = table(spark, sf_dir, "customer").repartition(spark.sparkContext.defaultParallelism)
    lines = df.select(F.to_csv(F.struct(*df.columns)).alias("value"))

    def with_edges(batches):
        import pandas as pd

        yield pd.DataFrame({"value": ["skip,this,line,of,text"]})
        yield from batches
        yield pd.DataFrame({"value": ["total,,,,", "end of file"]})

    lines.mapInPandas(with_edges, "value string").write.text(path)
    return read_csv(spark, path, header=False, skip_header=1, skip_footer=2)


@query("multi_source_join", """SELECT n_name, c_mktsegment, count(*) as orders, cast(sum(cast(o_totalprice as decimal(28,6))) as varchar) as total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def multi_source_join(spark, sf_dir):
    """CSV, JSON and Parquet sources in one join. Orders are summed per customer before they are joined."""
    customers = read_csv(spark, _written(spark, sf_dir, "customer", "csv"), schema=CUSTOMER_DDL)
    nations = read_json(spark, _written(spark, sf_dir, "nation", "json"), lines=True, schema="n_nationkey int, n_name string, n_regionkey int")
    orders = read_parquet(spark, f"{sf_dir}/orders.parquet", select=["o_custkey", "o_totalprice"])
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(28,6)")).alias("t")
    )
    joined = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "c_mktsegment").agg(
        F.sum("n").alias("orders"), F.sum("t").cast("decimal(38,6)").cast("string").alias("total")
    )


@query("file_manifest")
def q_file_manifest(spark, sf_dir):
    return file_manifest(spark, sf_dir, "*.parquet", True, "/landing", "tgt_", "_2024")


# ---------------------------------------------------------------- sinks


@query("sink_csv_roundtrip", "SELECT * FROM orders")
def sink_csv_roundtrip(spark, sf_dir):
    return read_csv(spark, _written(spark, sf_dir, "orders", "csv"), schema=ORDERS_DDL)


@query("sink_parquet_roundtrip", "SELECT * FROM lineitem")
def sink_parquet_roundtrip(spark, sf_dir):
    return read_parquet(spark, _written(spark, sf_dir, "lineitem", "parquet"))


@query("sink_json_roundtrip", "SELECT * FROM orders")
def sink_json_roundtrip(spark, sf_dir):
    return read_json(spark, _written(spark, sf_dir, "orders", "json"), lines=True, schema=ORDERS_DDL)


@query("sink_xml_roundtrip", "SELECT * FROM orders")
def sink_xml_roundtrip(spark, sf_dir):
    return read_xml(spark, _written(spark, sf_dir, "orders", "xml"), schema=ORDERS_DDL)


@query("sink_orc_roundtrip", "SELECT * FROM orders")
def sink_orc_roundtrip(spark, sf_dir):
    return read_orc(spark, _written(spark, sf_dir, "orders", "orc"))


@query("sink_dated_append", """SELECT cast('20240301' as integer) as load_dt, * FROM orders
    UNION ALL SELECT 20240302, * FROM orders UNION ALL SELECT 20240302, * FROM orders""")
def sink_dated_append(spark, sf_dir):
    """Day 1 is written twice with replace, day 2 twice with append."""
    path = scratch_dir(spark, "dated")
    df = table(spark, sf_dir, "orders")
    for day, operation in (("20240301", "replace"), ("20240301", "replace"), ("20240302", "append"), ("20240302", "append")):
        write_dated(df, path, "parquet", operation, day)
    return spark.read.parquet(path)


@query("sink_all_string", """SELECT cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
    cast(o_totalprice as varchar) as o_totalprice, cast(o_orderdate as varchar) as o_orderdate, o_orderpriority FROM orders""")
def sink_all_string(spark, sf_dir):
    path = scratch_dir(spark, "strings")
    write_dated(table(spark, sf_dir, "orders"), path, "parquet", "replace", "20240301", strings=True)
    return spark.read.parquet(path).drop("load_dt")


@query("rest_payload_batches", """SELECT cast(floor(i / 500) as bigint) as batch_no, count(*) as "rows", min(o_orderkey) as first_key, max(o_orderkey) as last_key
    FROM (SELECT o_orderkey, row_number() over (order by o_orderkey) - 1 as i FROM orders) x GROUP BY 1""")
def rest_payload_batches(spark, sf_dir):
    batches = payload_batches(table(spark, sf_dir, "orders"), 500, ["o_orderkey"])
    records = F.from_json("payload", "array<struct<o_orderkey: bigint>>")
    return batches.select(
        "batch_no", "rows", F.array_min(records["o_orderkey"]).alias("first_key"), F.array_max(records["o_orderkey"]).alias("last_key")
    )


@query("dq_split_write", f"""SELECT case when o_orderstatus is null or o_orderstatus = 'BAD' then 'bad' else 'good' end as dq_status, o_orderkey, o_orderstatus
    FROM ({DIRTY_ORDERS.sql}) x""")
def dq_split_write(spark, sf_dir):
    """Good and rejected rows from one write."""
    path = scratch_dir(spark, "split")
    run = run_checks(DIRTY_ORDERS.frame(spark, sf_dir), [
        {"seq_no": 1, "check": "column_values_to_not_be_null", "parameters": {"column": "o_orderstatus"}},
        {"seq_no": 2, "check": "column_values_to_not_be_in_set", "parameters": {"column": "o_orderstatus", "value_set": ["BAD"]}, "threshold_bad_records": 50},
    ])
    write_split(run, path, "parquet")
    return spark.read.parquet(path).select("dq_status", "o_orderkey", "o_orderstatus")


@query("task_rest_target", f"""SELECT o_orderkey, coalesce(o_orderstatus, 'none') as o_orderstatus, o_totalprice, order_day, o_custkey, o_orderpriority
    FROM ({DIRTY_ORDERS.sql}) x""")
def task_rest_target(spark, sf_dir):
    """A task from files to request bodies with checks on both sides; the bodies are read back as landed responses."""
    root = scratch_dir(spark, "rest")
    df = DIRTY_ORDERS.frame(spark, sf_dir)
    write_files(df.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("none"))), f"{root}/in", "orc")
    check = {"check": "column_values_to_not_be_null", "parameters": {"column": "o_orderstatus"}}
    done = run_task(spark, {"task_name": "to_rest", "task": {
        "source": {"source_type": "orc_read", "file_path": f"{root}/in"},
        "target": {"target_type": "rest_api_write", "file_path": f"{root}/out", "operation": "replace", "batch_rows": 700},
        "data_quality_execution": {"pre_check_enable": "Y", "post_check_enable": "Y"},
        "data_quality": [{**check, "seq_no": 1, "type": "pre_check"}, {**check, "seq_no": 2, "type": "post_check"}],
    }})
    if done.error is not None:
        raise done.error
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, order_day string, o_orderpriority string"
    return read_json(spark, f"{root}/out", lines=True, schema=schema)


# ---------------------------------------------------------------- write modes


def _database(spark) -> str:
    """A catalog database of its own below the shared folder."""
    path = scratch_dir(spark, "db")
    name = "millrace_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


_MODE_ORDERS = "SELECT * FROM orders"


def _mode_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("write_mode_create", _MODE_ORDERS)
def write_mode_create(spark, sf_dir):
    name = f"{_database(spark)}.target"
    write_table(_mode_orders(spark, sf_dir), name, "create")
    return spark.table(name)


@query("write_mode_append", f"{_MODE_ORDERS} UNION ALL {_MODE_ORDERS}")
def write_mode_append(spark, sf_dir):
    name = f"{_database(spark)}.target"
    write_table(_mode_orders(spark, sf_dir), name, "create if not exist")
    df = _mode_orders(spark, sf_dir)
    write_table(df.select(*reversed(df.columns)), name, "append")
    return spark.table(name)


@query("write_mode_truncate", "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders")
def write_mode_truncate(spark, sf_dir):
    name = f"{_database(spark)}.target"
    df = _mode_orders(spark, sf_dir)
    write_table(df, name, "create")
    write_table(df.withColumn("o_totalprice", F.col("o_totalprice") + 1), name, "truncate")
    return spark.table(name)


@query("write_mode_replace", "SELECT * EXCLUDE (o_totalprice), 'new' as extra FROM orders")
def write_mode_replace(spark, sf_dir):
    name = f"{_database(spark)}.target"
    df = _mode_orders(spark, sf_dir)
    write_table(df, name, "create")
    write_table(df.drop("o_totalprice").withColumn("extra", F.lit("new")), name, "replace")
    return spark.table(name)


# ---------------------------------------------------------------- SQL tasks


def _sql_task(spark, sf_dir, statements):
    db = _database(spark)
    table(spark, sf_dir, "customer").write.saveAsTable(f"{db}.customers")
    task = {
        "sql_execution": {"restart": "begin"},
        "sql_list": [{"seq_no": i, "sql_query": s.replace("{db}", db)} for i, s in statements],
    }
    results = run_sql_task(spark, task)
    if results[-1].error is not None:
        raise results[-1].error
    return results[-1].frame


@query("sql_select_where", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def sql_select_where(spark, sf_dir):
    return _sql_task(spark, sf_dir, [(1, "SELECT * FROM {db}.customers WHERE `c_mktsegment` = 'BUILDING' AND c_acctbal > 0;")])


@query("sql_count", "SELECT count(*) as n FROM customer")
def sql_count(spark, sf_dir):
    return _sql_task(spark, sf_dir, [(1, "SELECT COUNT(*) AS n FROM {db}.customers;;")])


@query("sql_insert", "SELECT * FROM customer UNION ALL SELECT -1, 'new', 0, 1.5, 'NONE' UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sql_insert(spark, sf_dir):
    return _sql_task(spark, sf_dir, [
        (3, "SELECT * FROM {db}.customers;"),
        (1, "INSERT INTO {db}.customers (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) VALUES (-1, 'new', 0, 1.5, 'NONE');"),
        (2, "INSERT INTO {db}.customers SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {db}.customers WHERE c_custkey >= 0;"),
    ])


@query("sql_update", """SELECT c_custkey, case when c_acctbal < 0 then 'OWES, A LOT' else c_name end as c_name, c_nationkey,
    case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal, 'ALL' as c_mktsegment FROM customer""")
def sql_update(spark, sf_dir):
    return _sql_task(spark, sf_dir, [
        (1, "UPDATE {db}.customers SET c_name = 'OWES, A LOT', c_acctbal = 0 WHERE c_acctbal < 0;"),
        (2, "UPDATE {db}.customers SET c_mktsegment = 'ALL';"),
        (3, "SELECT * FROM {db}.customers"),
    ])


@query("sql_delete", "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'")
def sql_delete(spark, sf_dir):
    return _sql_task(spark, sf_dir, [
        (1, "DELETE FROM {db}.customers WHERE `c_mktsegment` = 'BUILDING';"),
        (2, "SELECT * FROM {db}.customers"),
    ])


@query("sql_add_column", "SELECT *, coalesce(cast(null as varchar), 'unknown') as origin FROM customer")
def sql_add_column(spark, sf_dir):
    """Old rows have no value in a new column; its default is applied on read."""
    return _sql_task(spark, sf_dir, [
        (1, "ALTER TABLE {db}.customers ADD COLUMNS (origin STRING)"),
        (2, "SELECT * EXCEPT (origin), coalesce(origin, 'unknown') AS origin FROM {db}.customers"),
    ])


@query("sql_task_chain", """SELECT segment, count(*) as n FROM (SELECT case when c_nationkey = 3 then 'MOVED' else c_mktsegment end as segment FROM customer
    WHERE NOT (c_acctbal < 0)) x GROUP BY 1""")
def sql_task_chain(spark, sf_dir):
    """Create, insert, update, delete, select, in the order of their numbers."""
    return _sql_task(spark, sf_dir, [
        (50, "SELECT segment, count(*) AS n FROM {db}.copies GROUP BY segment;"),
        (10, "CREATE TABLE {db}.copies (id BIGINT, segment STRING, nation INT, balance DOUBLE) USING parquet;"),
        (20, "INSERT INTO {db}.copies SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal FROM {db}.customers;"),
        (30, "UPDATE {db}.copies SET segment = 'MOVED' WHERE nation = 3;"),
        (40, "DELETE FROM {db}.copies WHERE balance < 0;"),
    ])


# ---------------------------------------------------------------- tasks, bulk, stream


def _orders_task(sf_dir, target, **more):
    return {
        "pipeline_id": 1, "task_name": "orders",
        "task": {
            "source": {"source_type": "parquet_read", "file_path": f"{sf_dir}/", "file_name": "orders.parquet", "select_columns": " "},
            "target": {"target_type": "parquet_write", "file_path": target, "file_name": "/orders", "operation": "replace", "audit_columns": "inactive"},
            **more,
        },
    }


@query("task_run", "SELECT * FROM orders")
def task_run(spark, sf_dir):
    """A whole task: read, pre-checks, stage, post-checks against the source, publish."""
    target = scratch_dir(spark, "task")
    result = run_task(spark, _orders_task(
        sf_dir, target,
        data_quality_execution={"pre_check_enable": "Y", "post_check_enable": "Y"},
        data_quality=[
            {"seq_no": "1", "check": "column_values_to_not_be_null", "parameters": {"column": "o_orderkey"}, "type": "pre_check"},
            {"seq_no": "2", "check": "reconciliation", "parameters": {"aggregation": "sum", "source_column": "o_totalprice", "target_column": "o_totalprice"}, "type": "post_check"},
            {"seq_no": "3", "check": "schema_comparison", "parameters": {}, "type": "post_check"},
        ],
    ))
    if result.error:
        raise result.error
    return spark.read.parquet(f"{target}/orders")


@query("dq_post_gate", "SELECT * FROM orders")
def dq_post_gate(spark, sf_dir):
    """A load whose post-check fails: the target keeps what it had."""
    target = scratch_dir(spark, "gate")
    first = run_task(spark, _orders_task(sf_dir, target))
    again = _orders_task(
        sf_dir, target,
        data_quality_execution={"pre_check_enable": "N", "post_check_enable": "Y"},
        data_quality=[{"seq_no": "1", "check": "column_values_to_be_in_set", "parameters": {"column": "o_orderstatus", "value_set": ["O"]}, "type": "post_check"}],
    )
    again["task"]["source"]["select_columns"] = "o_orderkey,o_orderstatus"
    second = run_task(spark, again)
    if first.status != "COMPLETED" or second.status != "FAILED":
        raise AssertionError(f"{first.error} {second.error}")
    return spark.read.parquet(f"{target}/orders")


@query("bulk_subtasks", """SELECT 'customer' as name, count(*) as n, sum(c_custkey)::bigint as keys FROM customer
    UNION ALL SELECT 'part', count(*), sum(p_partkey)::bigint FROM part UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::bigint FROM supplier""")
def bulk_subtasks(spark, sf_dir):
    """Three tables from Parquet into three formats, then counted where they arrived."""
    root = scratch_dir(spark, "bulk")
    loads = (("customer", "csv", "c_custkey"), ("part", "orc", "p_partkey"), ("supplier", "json", "s_suppkey"))
    run_bulk(spark, [
        {"subtask": name, "source": {"file_path": f"{sf_dir}/{name}", "file_type": "parquet"}, "target": {"file_path": f"{root}/{name}", "file_type": kind}}
        for name, kind, _ in loads
    ])
    out = None
    for name, kind, key in loads:
        back = read_prefix(spark, f"{root}/{name}/", kind)
        one = back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("long")).alias("keys")).select(F.lit(name).alias("name"), "n", "keys")
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_ingest", """SELECT event_id, user_id, event_type, value, case when dq_failed = '' then 'good' else 'bad' end as dq_status, dq_failed FROM
    (SELECT *, concat_ws(',', case when value < 1 or value > 100 then '1' end, case when event_type = 'error' then '2' end) as dq_failed FROM events) x""")
def stream_ingest(spark, sf_dir):
    """The events as a file stream: each micro-batch is checked and split, then all are read back."""
    root = scratch_dir(spark, "stream")
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/event[s].parquet")
    checks = [
        {"seq_no": 1, "check": "column_values_to_be_between", "parameters": {"column": "value", "min_value": 1, "max_value": 100}},
        {"seq_no": 2, "check": "column_values_to_not_be_in_set", "parameters": {"column": "event_type", "value_set": ["error"]}},
    ]
    ingest_stream(stream, checks, f"{root}/out", f"{root}/checkpoint", "replace").awaitTermination()
    back = read_ingested(spark, f"{root}/out", f"{EVENT_SCHEMA}, dq_failed string, batch string, dq_status string")
    return back.select("event_id", "user_id", "event_type", "value", "dq_status", "dq_failed")


@query("stream_append_twice", "SELECT event_id, user_id, event_type, value, ts, case when value < 1 or value > 100 then 'bad' else 'good' end as dq_status FROM (SELECT * FROM events UNION ALL SELECT * FROM events) x")
def stream_append_twice(spark, sf_dir):
    """Two streams with checkpoints of their own into one target: the second adds to the first."""
    root = scratch_dir(spark, "stream")
    checks = [{"seq_no": 1, "check": "column_values_to_be_between", "parameters": {"column": "value", "min_value": 1, "max_value": 100}}]
    for name in ("first", "second"):
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/event[s].parquet")
        ingest_stream(stream, checks, f"{root}/out", f"{root}/{name}", "append").awaitTermination()
    back = read_ingested(spark, f"{root}/out", f"{EVENT_SCHEMA}, dq_failed string, batch string, dq_status string")
    return back.select("event_id", "user_id", "event_type", "value", "ts", "dq_status")
