"""Readers and targets by the type names of a task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.config import fill_date_placeholders, is_yes
from millrace.functions.columns import all_strings, project
from millrace.sinks import files as sink
from millrace.sinks.payload import payload_batches
from millrace.sinks.tables import (
    TargetError, drop_stage, operation_name, publish_table, require_columns, require_state, restore_table, stage_table, write_jdbc, write_table,
)
from millrace.sources import files as src
from millrace.sources.jdbc import read_jdbc, table_name

BATCH_ROWS = 1000


def _path(spec: dict) -> str:
    return (spec.get("file_path") or "") + (spec.get("file_name") or "")


def _csv(spark, s, connection):
    return src.read_csv(
        spark, _path(s), s.get("delimiter"), s.get("quote_char"), s.get("escape_char"), s.get("encoding"),
        header=is_yes(s.get("header", "Y")), skip_header=int(s.get("skip_header") or 0),
        skip_footer=int(s.get("skip_footer") or 0), select=s.get("select_columns"), alias=s.get("alias_columns"),
        schema=s.get("schema_ddl"), multi_line=is_yes(s.get("multi_line")),
    )


def _names(s):
    return {"select": s.get("select_columns"), "alias": s.get("alias_columns")}


def _object_store(spark, s, connection):
    base = (connection or {}).get("base_url", "")
    options = {"multiLine": s.get("chunk_size") is None} if s["file_type"] == "json" else None
    df = src.read_prefix(spark, base + _path(s), s["file_type"], options, s.get("schema_ddl"))
    return project(df, **_names(s))


def _database(database):
    return lambda spark, s, connection: read_jdbc(spark, database, s, connection or {})


READERS = {
    "csv_read": _csv,
    "csvfile_read": _csv,
    "parquet_read": lambda spark, s, c: src.read_parquet(spark, _path(s), **_names(s)),
    "orc_read": lambda spark, s, c: src.read_orc(spark, _path(s), **_names(s)),
    "json_read": lambda spark, s, c: src.read_json(
        spark, _path(s), s.get("encoding"), is_yes(s.get("json_lines")), s.get("schema_ddl"), **_names(s)),
    "xml_read": lambda spark, s, c: src.read_xml(
        spark, _path(s), s.get("row_tag") or "row", s.get("encoding"), s.get("schema_ddl"), **_names(s)),
    "rest_api_read": lambda spark, s, c: src.read_payload(spark, _path(s), s.get("records"), s.get("schema_ddl")),
    "aws_s3_read": _object_store,
    "table_read": lambda spark, s, c: project(spark.sql(s["query"]) if s.get("query") else spark.table(table_name(s)), **_names(s)),
    "mysql_read": _database("mysql"),
    "postgres_read": _database("postgres"),
    "mssql_read": _database("mssql"),
    "snowflake_read": _database("snowflake"),
    "oracle_read": _database("oracle"),
}


def read_source(spark: SparkSession, source: dict, connection: dict | None = None) -> DataFrame:
    reader = READERS.get(source["source_type"])
    if reader is None:
        raise ValueError(f"unknown source_type {source['source_type']!r}")
    return reader(spark, source, connection)


class FileTarget:
    """Always staged: written next to the target, then renamed."""

    def __init__(self, spark, target, file_type, path, append=False, options=None, strings=False):
        self.spark, self.file_type, self.path, self.append = spark, file_type, path.rstrip("/"), append
        self.options, self.strings = options or {}, strings
        self.stage_path = f"{self.path}__stage_{uuid.uuid4().hex[:8]}"

    def stage(self, df: DataFrame) -> int:
        df = all_strings(df) if self.strings else df
        self.schema = df.schema
        return sink.write_files(df, self.stage_path, self.file_type, "errorifexists", self.options)

    def staged(self) -> DataFrame:
        """Read back with the written schema: text formats do not keep types, and guessing them costs a pass."""
        extra = {"csv": {"header": True, "escape": '"', **self.options}, "xml": {"rowTag": "row"}}.get(self.file_type, {})
        return self.spark.read.schema(self.schema).options(**extra).format(self.file_type).load(self.stage_path)

    def publish(self) -> None:
        sink.publish(self.spark, self.stage_path, self.path, self.append)

    def discard(self) -> None:
        if sink.exists(self.spark, self.stage_path):
            sink.discard(self.spark, self.stage_path)


class PayloadTarget(FileTarget):
    """Request bodies for a REST service: a line of text per batch, a JSON array of at most `batch_rows` records.

    The bodies are landed for whatever delivers them; nothing is sent from here.
    """

    def __init__(self, spark, target, path, append):
        super().__init__(spark, target, "text", path, append)
        self.batch_rows = int(target.get("batch_rows") or BATCH_ROWS)

    def stage(self, df: DataFrame) -> int:
        self.schema = df.schema
        seen = Observation()
        bodies = payload_batches(df, self.batch_rows).observe(seen, F.sum("rows").alias("rows"))
        bodies.select("payload").write.text(self.stage_path)
        return seen.get["rows"] or 0

    def staged(self) -> DataFrame:
        return self.spark.read.schema(self.schema).json(self.stage_path)


class TableTarget:
    """A catalog table, staged as a second table."""

    def __init__(self, spark, target, connection=None):
        self.spark, self.operation = spark, operation_name(target["operation"])
        self.table = table_name(target)
        self.stage_table = f"{self.table}__stage_{uuid.uuid4().hex[:8]}"

    def check(self, columns: list[str]) -> None:
        restore_table(self.spark, self.table)
        there = self.spark.catalog.tableExists(self.table)
        require_state(self.operation, there, self.table)
        if there and self.operation in {"append", "truncate"}:
            require_columns(self.spark.table(self.table).columns, columns, self.table)

    def drop(self) -> None:
        write_table(None, self.table, "drop")

    def stage(self, df: DataFrame) -> int:
        self.check(df.columns)
        seen = Observation()
        stage_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), self.table, name=self.stage_table)
        return seen.get["rows"]

    def staged(self) -> DataFrame:
        return self.spark.table(self.stage_table)

    def publish(self) -> None:
        if self.operation == "replace" or not self.spark.catalog.tableExists(self.table):
            publish_table(self.spark, self.stage_table, self.table)
        else:
            write_table(self.staged(), self.table, self.operation)
            self.discard()

    def discard(self) -> None:
        drop_stage(self.spark, self.stage_table)


class JdbcTarget:
    """A database table, staged as a second table of the database."""

    def __init__(self, spark, database, target, connection):
        self.spark, self.database, self.connection = spark, database, connection or {}
        self.target, self.operation = target, operation_name(target["operation"])
        self.stage_spec = {**target, "table_name": target["table_name"] + "_stage_" + uuid.uuid4().hex[:8], "operation": "create"}

    def drop(self) -> None:
        write_jdbc(None, self.database, self.target, self.connection)

    def stage(self, df: DataFrame) -> int:
        seen = Observation()
        write_jdbc(df.observe(seen, F.count(F.lit(1)).alias("rows")), self.database, self.stage_spec, self.connection)
        return seen.get["rows"]

    def staged(self) -> DataFrame:
        return read_jdbc(self.spark, self.database, self.stage_spec, self.connection)

    def publish(self) -> None:
        write_jdbc(self.staged(), self.database, self.target, self.connection)
        self.discard()

    def discard(self) -> None:
        write_jdbc(None, self.database, {**self.stage_spec, "operation": "drop"}, self.connection)


def _appends(spark, t, path) -> bool:
    """Whether a file target keeps what is there. Unknown words are refused, not taken for `replace`."""
    operation = operation_name(t.get("operation") or "replace")
    if operation == "drop":
        raise TargetError("a file target cannot be dropped")
    if operation == "create":
        require_state(operation, sink.exists(spark, path), path)
    return operation in {"append", "create_if_not_exists"}


def _file_target(file_type):
    def make(spark, t, connection):
        options = {}
        if file_type == "csv":
            options = {k: v for k, v in (("sep", t.get("delimiter")), ("encoding", src.charset(t.get("encoding")))) if v}
        path = fill_date_placeholders(_path(t))
        return FileTarget(spark, t, file_type, path, _appends(spark, t, path), options)

    return make


def _payload_target(spark, t, connection):
    path = (connection or {}).get("landing_path", "") + fill_date_placeholders(_path(t))
    return PayloadTarget(spark, t, path, _appends(spark, t, path))


def _dated_target(spark, t, connection):
    """Object store: a folder per load day; Parquet columns are written as text."""
    base = (connection or {}).get("base_url", "")
    day = fill_date_placeholders("%YYYYMMDD%")
    path = f"{base}{t.get('file_path') or ''}{day}/{fill_date_placeholders(t['file_name'])}"
    return FileTarget(spark, t, t["file_type"], path, _appends(spark, t, path), strings=t["file_type"] == "parquet")


def _jdbc_target(database):
    return lambda spark, t, connection: JdbcTarget(spark, database, t, connection)


WRITERS = {
    "csv_write": _file_target("csv"),
    "csvfile_write": _file_target("csv"),
    "parquet_write": _file_target("parquet"),
    "json_write": _file_target("json"),
    "xml_write": _file_target("xml"),
    "orc_write": _file_target("orc"),
    "aws_s3_write": _dated_target,
    "rest_api_write": _payload_target,
    "table_write": lambda spark, t, c: TableTarget(spark, t),
    "mysql_write": _jdbc_target("mysql"),
    "postgres_write": _jdbc_target("postgres"),
    "mssql_write": _jdbc_target("mssql"),
    "snowflake_write": _jdbc_target("snowflake"),
    "oracle_write": _jdbc_target("oracle"),
}


def open_target(spark: SparkSession, target: dict, connection: dict | None = None):
    maker = WRITERS.get(target["target_type"])
    if maker is None:
        raise TargetError(f"unknown target_type {target['target_type']!r}")
    return maker(spark, target, connection)
