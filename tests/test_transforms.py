"""Lookups, masks, encryption, update and delete, tables and databases."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.config import CheckRow, as_list, fill_date_placeholders, load_task, secret
from millrace.functions.crypto import decrypt_columns, derived_key, encrypt, encrypt_columns, key_from_hex
from millrace.functions.mask import mask_alpha, mask_date, mask_from_config, mask_numeric
from millrace.operators import skew
from millrace.operators.lookup import auto_correct
from millrace.operators.mapping import many_to_one_violations, one_to_one_summary, one_to_one_violations
from millrace.operators.skew import broadcast_if_small, hot_keys, join_unique
from millrace.operators.mutate import delete_where, update_where
from millrace.operators.reconcile import Recon, compare_column_count, compare_schema, reconcile
from millrace.sinks.tables import TargetError, jdbc_catalog, jdbc_write_plan, operation_name, write_table
from millrace.sources.jdbc import connection_options, hash_slices, read_jdbc, table_name

KEY = "000102030405060708090a0b0c0d0e0f"


@pytest.fixture(params=["broadcast", "shuffle", "hot"])
def plan(request, monkeypatch):
    """The three ways to join a table with one row per key."""
    if request.param != "broadcast":
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    if request.param == "hot":
        monkeypatch.setattr(skew, "HOT_SAMPLE", 0.9)
        monkeypatch.setattr(skew, "HOT_SEEN", 2)
    return request.param


def test_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SAMPLE", 0.5)
    df = spark.range(1000).selectExpr("case when id < 400 then 1 when id < 700 then null else id end as k")
    assert sorted(((r["k"] for r in hot_keys(df, ["k"]).collect())), key=repr) == [1, None]
    assert hot_keys(spark.range(100), ["id"]) is None


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_join_unique(spark, plan, how, null_safe):
    data = [(i, [None, "hot", "hot", "a", "b", str(i)][i % 6]) for i in range(120)]
    table = {None: 0, "hot": 1, "a": 2, "z": 3, "5": 4}
    left = spark.createDataFrame(data, "i int, k string").repartition(3)
    right = spark.createDataFrame(list(table.items()), "key string, v int")
    got = sorted(tuple(r) for r in join_unique(left, right, {"k": "key"}, how, null_safe).drop("key").collect())
    known = {k: v for k, v in table.items() if null_safe or k is not None}
    want = {
        "left": [(i, k, known.get(k)) for i, k in data],
        "inner": [(i, k, known[k]) for i, k in data if k in known],
        "left_semi": [(i, k) for i, k in data if k in known],
        "left_anti": [(i, k) for i, k in data if k not in known],
    }[how]
    assert got == sorted(want)


def test_auto_correct_all_plans(spark, plan, as_rows):
    df = spark.createDataFrame([(1, 1, None), (2, 1, "own"), (3, 9, None), (4, None, None), (5, 2, None)], "id int, k int, v string")
    lkp = spark.createDataFrame([(1, "one"), (1, "uno"), (2, None), (2, "two"), (None, "null")], "key int, val string")
    left = auto_correct(df, lkp, {"k": "key"}, {"v": "val"})
    assert as_rows(left) == [(1, 1, "one"), (2, 1, "own"), (3, 9, None), (4, None, None), (5, 2, "two")]
    inner = auto_correct(df, lkp, {"k": "key"}, {"v": "val"}, "inner")
    assert as_rows(inner) == [(1, 1, "one"), (1, 1, "uno"), (2, 1, "own"), (2, 1, "own"), (5, 2, "two"), (5, 2, None)]
    with pytest.raises(ValueError):
        auto_correct(df, lkp, {"k": "key"}, {"v": "val"}, "outer")


def test_broadcast_only_below_a_size(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    other = spark.range(10).withColumnRenamed("id", "l_orderkey")
    assert "broadcast" in broadcast_if_small(df).join(other, "l_orderkey")._jdf.queryExecution().logical().toString().lower()
    assert "strategy=broadcast" not in broadcast_if_small(df, 10).join(other, "l_orderkey")._jdf.queryExecution().analyzed().toString()


def test_masks(spark, as_rows):
    df = spark.createDataFrame([("Ñandú_1 ab-c", 5, dt.date(2024, 1, 31), None)], "s string, n int, d date, z string")
    assert mask_alpha(df, ["s", "n", "z"], "$").first()[:2] == ("$$$$$$$ $$-$", 5)
    assert mask_alpha(df, ["s"], "\\").first()["s"] == "\\" * 7 + " " + "\\" * 2 + "-\\"
    assert mask_date(df, ["d"]).first()["d"] == "0000-00-00"
    out = mask_numeric(df, ["n"])
    assert out.first()["n"] is None and dict(out.dtypes)["n"] == "int"
    got = mask_from_config(df, {"msk_alpha": ",s", "msk_date": "9,d", "msk_numeric": "n"}).first()
    assert tuple(got) == ("******* **-*", None, "9999-99-99", None)
    assert mask_from_config(df, {}).first() == df.first()


def test_no_password_stays_in_the_session(spark, monkeypatch):
    monkeypatch.setenv("MILLRACE_SECRET_PW_TEST", "s3cret!")
    connection = {"hostname": "h", "port": 1, "database": "d", "username": "u", "connection_name": "pw_test"}
    with jdbc_catalog(spark, "postgres", connection) as name:
        assert "s3cret!" in {spark.conf.get(f"spark.sql.catalog.{name}.{k}") for k in connection_options("postgres", connection)}
    assert "s3cret!" not in spark._jsparkSession.conf().getAll().toString()
    with pytest.raises(RuntimeError), jdbc_catalog(spark, "postgres", connection):
        raise RuntimeError
    assert "s3cret!" not in spark._jsparkSession.conf().getAll().toString()


def test_no_plan_prints_the_key(spark):
    """Neither the plan before nor after it ran, nor that of a frame made from it."""
    df = spark.createDataFrame([("a",), (None,), ("b",)], "s string")
    key = key_from_hex(KEY)
    nonce = hashlib.sha256(bytes.fromhex(KEY) + b"nonce").hexdigest()
    out = encrypt_columns(df, ["s"], key)
    back = decrypt_columns(out, ["s"], key)
    assert [r["s"] for r in back.collect()] == ["a", None, "b"]
    for frame in (out, back, back.groupBy("s").count(), spark.range(1).select(encrypt("id", key).alias("c"))):
        frame.collect()
        text = frame._jdf.queryExecution().toString().lower()
        for secret in (KEY.lower(), nonce):
            assert secret not in text and str(list(bytes.fromhex(secret)))[1:-1] not in text


def test_encryption(spark):
    df = spark.createDataFrame([("a",), ("a",), ("ü long text",), (None,), ("",)], "s string")
    key = key_from_hex(KEY)
    same = [r["s"] for r in encrypt_columns(df, ["s"], key).collect()]
    assert same[0] == same[1] and len({x[:24] for x in same if x}) == 3  # a nonce per value
    assert same[3] is None
    fresh = [r["s"] for r in encrypt_columns(df, ["s"], key, joinable=False).collect()]
    assert fresh[0] != fresh[1]
    back = decrypt_columns(encrypt_columns(df, ["s"], key), ["s"], key)
    assert [r["s"] for r in back.collect()] == ["a", "a", "ü long text", None, ""]
    number = spark.range(1).select(encrypt("id", key, derived_key(key, "nonce")).alias("c"))
    assert decrypt_columns(number, ["c"], key).first()["c"] == "0"


def test_update_and_delete(spark, as_rows):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "a int, b int")
    assert as_rows(update_where(df, {"a": "b", "b": "a"}, "b > 5")) == [(10, 1), (2, None), (30, 3)]
    assert as_rows(update_where(df, {"b": F.lit(0)})) == [(1, 0), (2, 0), (3, 0)]
    assert as_rows(delete_where(df, "b > 5")) == [(2, None)]
    assert delete_where(df).count() == 0
    with pytest.raises(ValueError):
        update_where(df, {"c": "1"})


def test_mappings(spark, plan, as_rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3), ("c", 4), ("d", 4), ("e", None), (None, 9)], "x string, y int")
    assert tuple(one_to_one_summary(df, "x", "y").first()) == (2, 2)
    assert as_rows(one_to_one_violations(df, "x", "y")) == [("b", 2), ("b", 3), ("c", 4), ("d", 4)]
    assert as_rows(many_to_one_violations(df, "x", "y")) == [("a", "1", 2)]
    no_pairs = df.distinct()
    assert as_rows(many_to_one_violations(no_pairs, "x", "y")) == [("b", "2", 1), ("b", "3", 1)]


def test_reconciliation_kinds(spark):
    a = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    b = spark.createDataFrame([("1.0",)], "y string")
    got = {r["aggregation"]: r for r in reconcile(a, b, [Recon(i, k, "x", "y") for i, k in enumerate(("sum", "avg", "min", "max", "count"))]).collect()}
    assert got["sum"]["result"] == "PASS" and got["sum"]["source_value"] == "1.000000"
    assert [got[k]["result"] for k in ("avg", "min", "max", "count")] == ["FAIL"] * 4
    close = reconcile(a, b, [Recon(1, "sum", "x", "y", 0.5)]).first()
    assert close["result"] == "PASS"
    empty = reconcile(a.limit(0), a.limit(0), [Recon(1, "avg", "x", "x"), Recon(2, "sum", "x", "x")]).collect()
    assert [r["result"] for r in empty] == ["PASS", "PASS"]
    with pytest.raises(ValueError):
        reconcile(a, b, [Recon(1, "mode", "x", "y")])


def test_schema_comparison(spark):
    a = spark.sql("select 1 as a, 'x' as b")
    assert compare_schema(a, spark.sql("select 1 as A, 'x' as B, ' ' as crtd_by")) == (True, None)
    assert compare_schema(a, spark.sql("select 1L as a, 'x' as b")) == (False, "schema differs: A|int")
    assert compare_schema(a, spark.sql("select 1 as a, 'x' as b, 2 as c")) == (False, "schema differs: C|int")
    assert compare_schema(a, spark.sql("select 'x' as b, 1 as a"))[0] is False
    assert compare_column_count(a, spark.sql("select 1 as a")) == (False, "source has 2 columns, target has 1")


def test_write_modes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS modes")
    df = spark.range(3)
    t = "modes.t"
    for operation in ("append", "truncate", "replace", "drop"):
        with pytest.raises(TargetError):
            write_table(df, t, operation)
    write_table(df, t, "create")
    with pytest.raises(TargetError):
        write_table(df, t, "create")
    write_table(df, t, "append")
    assert spark.table(t).count() == 6
    write_table(spark.table(t).where("id = 1"), t + "2", "CREATE IF NOT EXIST")
    write_table(df, t + "2", "create_if_not_exists")
    assert spark.table(t + "2").count() == 5
    write_table(df, t, "truncate")
    assert spark.table(t).count() == 3
    with pytest.raises(TargetError):
        write_table(df.withColumn("more", F.lit(1)), t, "append")
    with pytest.raises(TargetError):
        write_table(df.selectExpr("id as other"), t, "append")
    write_table(spark.table(t).selectExpr("id", "id * 2 as twice"), t, "replace")  # reads what it replaces
    assert spark.table(t).columns == ["id", "twice"] and spark.table(t).count() == 3
    write_table(None, t, "drop")
    assert not spark.catalog.tableExists(t)
    with pytest.raises(TargetError):
        write_table(df, t, "upsert")


def test_jdbc_plans(monkeypatch):
    """Options only: no database is started here."""
    assert operation_name("CREATE IF NOT EXIST") == "create_if_not_exists"
    assert jdbc_write_plan("truncate", True, "t") == ("overwrite", {"truncate": "true"})
    assert jdbc_write_plan("replace", True, "t") == ("overwrite", {"truncate": "false"})
    assert jdbc_write_plan("create", False, "t")[0] == "errorifexists"
    for operation, exists in (("create", True), ("append", False), ("drop", False), ("nonsense", True)):
        with pytest.raises(TargetError):
            jdbc_write_plan(operation, exists, "t")
    monkeypatch.setenv("MILLRACE_SECRET_MY_CONN", "pw")
    options = connection_options("postgres", {"hostname": "h", "port": 5, "database": "d", "username": "u", "connection_name": "my-conn"})
    assert options == {"url": "jdbc:postgresql://h:5/d", "driver": "org.postgresql.Driver", "user": "u", "password": "pw"}
    assert table_name({"schema": "s", "table_name": "t"}) == "s.t"
    assert table_name({"database": "d", "schema": "s", "table_name": "t"}) == "d.s.t"
    slices = hash_slices("k", 3)
    assert len(slices) == 3 and "IS NULL" in slices[0] and "IS NULL" not in slices[1]


class Recorder:
    """Stands for spark.read: keeps the options, returns a small frame."""

    def __init__(self, spark, answer):
        self.spark, self.answer, self.calls = spark, answer, []
        self.read = self

    def format(self, name):
        self.calls.append({"format": name})
        return self

    def options(self, **options):
        self.calls[-1].update(options)
        return self

    def load(self):
        return self.answer

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "table": table, "predicates": predicates, **properties})
        return self.answer


def test_jdbc_reads(spark):
    connection = {"url": "jdbc:x", "driver": "d"}
    rec = Recorder(spark, spark.sql("select 1 as lo, 90 as hi"))
    read_jdbc(rec, "mysql", {"query": "select a from t; ", "table_name": "t", "chunk_size": 1000}, connection)
    assert rec.calls == [{"format": "jdbc", "url": "jdbc:x", "driver": "d", "fetchsize": "1000", "query": "select a from t"}]
    rec.calls.clear()
    df = read_jdbc(rec, "mysql", {"query": " ", "schema": "s", "table_name": "t", "select_columns": "hi"}, connection)
    assert df.columns == ["hi"] and rec.calls[-1]["dbtable"] == "s.t" and "numPartitions" not in rec.calls[-1]
    read_jdbc(rec, "mysql", {"table_name": "t", "partition_column": "k", "partitions": 8}, connection)
    assert rec.calls[-2]["query"] == "SELECT MIN(k) AS lo, MAX(k) AS hi FROM t"
    assert {k: rec.calls[-1][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "k", "lowerBound": "1", "upperBound": "90", "numPartitions": "8"}
    read_jdbc(rec, "mysql", {"table_name": "t", "partition_column": "k", "partition_by_hash": True, "partitions": 4}, connection)
    assert len(rec.calls[-1]["predicates"]) == 4 and rec.calls[-1]["table"] == "t"


def test_hash_slices_cover_every_row_once(spark):
    df = spark.sql("select explode(array(-5, -1, 0, 1, 2, 7, null)) as k")
    assert sum(df.where(p).count() for p in hash_slices("k", 3)) == 7


def test_config(monkeypatch):
    raw = {"task": {"source": {"query": " ", "select_columns": "None", "delimiter": " "}, "target": {},
                    "data_quality": [{"seq_no": "1", "check": "x", "parameters": {"value_set": ["", "None"]}}]}}
    task = load_task(raw)
    assert task["task"]["source"] == {"query": None, "select_columns": None, "delimiter": " "}
    assert task["task"]["data_quality"][0]["parameters"]["value_set"] == ["", "None"]
    assert as_list("a, b,,") == ["a", "b"] and as_list(" ") is None and as_list(["x"]) == ["x"]
    day = dt.date(2024, 3, 5)
    assert fill_date_placeholders("f_%YYYY%_%MM%_%DD%", day) == "f_2024_03_05"
    assert fill_date_placeholders("f_%DDMMYYYY%.csv", day) == "f_05032024.csv"
    assert fill_date_placeholders("50%_plain", day) == "50%_plain"
    row = CheckRow.of({"seq_no": "3", "check": "expect_a", "threshold_bad_records": "", "active": "N"})
    assert (row.seq_no, row.check, row.threshold, row.active) == (3, "a", None, False)
    monkeypatch.delenv("MILLRACE_SECRET_NOPE", raising=False)
    with pytest.raises(KeyError):
        secret("nope")


@pytest.mark.parametrize("limit", [None, 0])
def test_both_fills_come_from_one_lookup_row(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "k int, city string, zip int")
    lookup = spark.createDataFrame([(1, "Aachen", 99), (1, "Zwolle", 11), (2, "Bonn", 5), (2, None, 1)], "k2 int, c string, z int")
    got = {tuple(r) for r in auto_correct(df, lookup, {"k": "k2"}, {"city": "c", "zip": "z"}).collect()}
    assert got == {(1, "Aachen", 99), (2, "x", 5)}
    every = sorted(tuple(r) for r in auto_correct(df, lookup, {"k": "k2"}, {"city": "c", "zip": "z"}, "inner").collect())
    assert every == [(1, "Aachen", 99), (1, "Zwolle", 11), (2, "x", 1), (2, "x", 5)]


def test_inner_lookup_splits_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    df = spark.range(200).selectExpr("id", "id % 50 as k", "case when id % 2 = 0 then 'own' end as v").repartition(8)
    lookup = spark.range(6000).selectExpr("case when id % 3 = 0 then 7 else id end as key", "concat('value ', id) as val").repartition(8)
    small = {"skewedPartitionThresholdInBytes": "1k", "skewedPartitionFactor": "1.2"}
    settings = {f"spark.sql.adaptive.skewJoin.{k}": v for k, v in small.items()} | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = auto_correct(df, lookup, {"k": "key"}, {"v": "val"}, "inner")
        got = sorted(tuple(r) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    values = {}
    for i in range(6000):
        values.setdefault(7 if i % 3 == 0 else i, []).append(f"value {i}")
    assert got == sorted((i, i % 50, "own" if i % 2 == 0 else v) for i in range(200) for v in values.get(i % 50, []))
    assert "collect_list" not in plan and "skew=true" in plan
