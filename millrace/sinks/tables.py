"""Write modes on catalog tables and on database tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.jdbc import connection_options, table_name


FILE_FORMATS = {"parquet", "orc"}
OLD = "old_"  # in the name of a table that a swap has put aside


class TargetError(Exception):
    """The target is not in the state that the operation asks for."""


def operation_name(text: str) -> str:
    name = re.sub(r"[\s_]+", "_", (text or "").strip().lower())
    name = {"create_if_not_exist": "create_if_not_exists", "create_if_not_exists": "create_if_not_exists"}.get(name, name)
    if name not in {"create", "append", "truncate", "replace", "drop", "create_if_not_exists"}:
        raise TargetError(f"invalid operation {text!r}")
    return name


def require_state(operation: str, exists: bool, table: str) -> None:
    """create wants no table; append, truncate, replace and drop want one."""
    if operation == "create" and exists:
        raise TargetError(f"table {table} exists already")
    if operation in {"append", "truncate", "replace", "drop"} and not exists:
        raise TargetError(f"table {table} does not exist")


def require_columns(have: list[str], want: list[str], table: str) -> None:
    lacking = sorted({c.upper() for c in want} - {c.upper() for c in have})
    if lacking:
        raise TargetError(f"table {table} lacks the columns {', '.join(lacking)}")


def write_table(df: DataFrame | None, table: str, operation: str, file_format: str = "parquet") -> None:
    """The modes on a catalog table. truncate keeps the definition, replace takes the new one."""
    operation = operation_name(operation)
    spark = df.sparkSession if df is not None else SparkSession.active()
    there = spark.catalog.tableExists(table)
    require_state(operation, there, table)
    if operation == "drop":
        spark.sql(f"DROP TABLE {table}")
    elif operation == "replace" or not there:
        # The new table is complete before the old one goes, and `df` may read the old one.
        publish_table(spark, stage_table(df, table, file_format), table)
    else:
        columns = spark.table(table).columns
        require_columns(columns, df.columns, table)
        require_columns(df.columns, columns, "written frame")
        if operation == "truncate":
            overwrite_in_place(df.select(*columns), table)
        else:
            df.select(*columns).write.insertInto(table)


def beside(table: str, mark: str = "") -> str:
    """A new name in the table's database."""
    return f"{table.removesuffix('`')}__{mark}{uuid.uuid4().hex[:8]}{'`' * table.endswith('`')}"


def _takes_location(spark: SparkSession, table: str, schema, file_format: str) -> bool:
    """Whether the table can be pointed at other files: a table of plain files in one folder, with these columns."""
    if not spark.catalog.tableExists(table):
        return False
    found = _definition(spark, table)
    provider = found.provider().get().lower() if found.provider().isDefined() else ""
    plain = provider == file_format and provider in FILE_FORMATS and not found.partitionColumnNames().size() and not found.bucketSpec().isDefined()
    return plain and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]


def stage_table(df: DataFrame, table: str, file_format: str = "parquet", name: str | None = None) -> str:
    """Writes a second table beside `table`, in a folder of its own, which `publish_table` can hand over."""
    spark, stage = df.sparkSession, name or beside(table)
    writer = df.write.format(file_format)
    if _takes_location(spark, table, df.schema, file_format):
        folder = _definition(spark, table).location().toString().rstrip("/").split("__v_")[0]
        writer = writer.option("path", f"{folder}__v_{uuid.uuid4().hex}")
    writer.saveAsTable(stage)
    return stage


def drop_stage(spark: SparkSession, stage: str) -> None:
    """A stage that is not published, with its folder."""
    if spark.catalog.tableExists(stage):
        path = _path(spark, _definition(spark, stage).location().toString())
        spark.sql(f"DROP TABLE {stage}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_table(spark: SparkSession, stage: str, table: str) -> None:
    """The stage becomes the table. Whatever fails, the old table can be read, or the new one.

    If the table takes a location, one catalog change points it at the new folder; the old folder goes last. Other tables
    are renamed, not dropped, until the new one has their name; `restore_table` undoes a swap that was cut off.
    """
    restore_table(spark, table)
    found = _definition(spark, stage)
    file_format = found.provider().get().lower() if found.provider().isDefined() else ""
    if "__v_" in found.location().toString() and _takes_location(spark, table, spark.table(stage).schema, file_format):
        old = _definition(spark, table).location().toString()
        new = found.location().toString().replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.catalog.refreshTable(table)
        spark.sql(f"DROP TABLE {stage}")  # an external table: its files stay
        path = _path(spark, old)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
        return
    old = beside(table, OLD)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")


def restore_table(spark: SparkSession, table: str) -> bool:
    """Gives a table back its name if a swap ended between its two renames."""
    if spark.catalog.tableExists(table):
        return False
    database, _, name = table.replace("`", "").rpartition(".")
    # Names in the catalog are lower case.
    names = [t.name for t in spark.catalog.listTables(database or None, f"{name.lower()}__{OLD}*")]
    if not names:
        return False
    spark.sql(f"ALTER TABLE {database + '.' if database else ''}{sorted(names)[-1]} RENAME TO {table}")
    return True


def overwrite_in_place(df: DataFrame, table: str) -> None:
    """Replace the rows of a table by a frame that may read it; the definition stays. The frame is written out first."""
    spark = df.sparkSession
    if _definition(spark, table).provider().isDefined():
        kept = spark.table(table).schema
        typed = df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(df.columns, kept)])
        file_format = _definition(spark, table).provider().get().lower()
        if _takes_location(spark, table, typed.schema, file_format):
            publish_table(spark, stage_table(typed, table, file_format), table)
            return
    stage = beside(table)
    df.write.format("parquet").saveAsTable(stage)
    # insertInto takes the mode from the session only.
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "static")
    try:
        spark.table(stage).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)
    spark.sql(f"DROP TABLE {stage}")


# ---------------------------------------------------------------- changed rows

JOURNAL = "_rewrite-"  # names with an underscore in front are no data to Spark


def _definition(spark: SparkSession, table: str):
    session = spark._jsparkSession.sessionState()
    return session.catalog().getTableMetadata(session.sqlParser().parseTableIdentifier(table))


def is_file_table(spark: SparkSession, table: str) -> bool:
    """A plain table of files, which has no UPDATE and DELETE of its own."""
    if not spark.catalog.tableExists(table):
        raise TargetError(f"table {table} does not exist")
    found = _definition(spark, table)
    if found.tableType().name() == "VIEW":
        raise TargetError(f"{table} is a view")
    provider = found.provider().get().lower() if found.provider().isDefined() else ""
    return provider in FILE_FORMATS | {"csv", "json", "text", "hive"}


def rewrite_where(spark: SparkSession, table: str, where: Column | str | None, change, alias: str | None = None) -> int | None:
    """Copy-on-write of `change(rows)`, by file: only files that hold a matching row are read again and written anew.

    Returns their number; None if the whole table was written (no condition, a bucketed table, a text format). The new
    files are complete, and a journal names them and the old ones, before any file of the table moves; a run that
    dies after that is completed by the next change or by `recover`. In between, readers may see both.
    """
    recover(spark, table)
    found = _definition(spark, table)
    rows = spark.table(table).alias(alias or "t")
    if where is None or found.provider().get().lower() not in FILE_FORMATS or found.bucketSpec().isDefined():
        overwrite_in_place(change(rows), table)
        return None
    path = rows.metadataColumn("_metadata")["file_path"]
    old = sorted(r[0] for r in rows.where(where).select(path.alias("path")).distinct().collect())  # names; the driver lists the files anyway
    if not old:
        return 0
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    folder = found.location().toString().rstrip("/")
    mark = f"{folder}/{JOURNAL}{uuid.uuid4().hex}"
    after = change(rows.where(path.isin(old)))  # prunes the listing, so other files are not opened
    after.write.format(found.provider().get()).partitionBy(*parts).save(mark)
    fs, new = _files(spark, mark)
    names = [f for f in new if f.rsplit("/", 1)[-1].startswith("part-")]
    out = fs.create(_path(spark, f"{mark}.part"), True)
    out.write(bytearray(json.dumps({"old": old, "new": names}).encode()))
    out.close()
    if not fs.rename(_path(spark, f"{mark}.part"), _path(spark, f"{mark}.json")):
        raise TargetError(f"cannot write the journal {mark}.json")
    recover(spark, table)
    return len(old)


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def _files(spark: SparkSession, folder: str) -> tuple:
    """(file system, paths below a folder relative to it)."""
    root = _path(spark, folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, at = [], fs.listFiles(root, True)
    prefix = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    while at.hasNext():
        found.append(at.next().getPath().toUri().getPath().removeprefix(prefix))
    return fs, found


def recover(spark: SparkSession, table: str) -> int:
    """Completes changes whose journal is there: new files move in, old ones go. Returns how many there were."""
    found = _definition(spark, table)
    if not found.storage().locationUri().isDefined():
        return 0
    folder = found.location().toString().rstrip("/")
    root = _path(spark, folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    journals = [s.getPath() for s in (fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{JOURNAL}*.json")) or [])]
    for journal in journals:
        stream = fs.open(journal)
        given = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        stage = spark._jvm.org.apache.hadoop.fs.Path(journal.toString().removesuffix(".json"))
        for name in given["new"]:
            here, there = (spark._jvm.org.apache.hadoop.fs.Path(x, name) for x in (stage, root))
            if fs.exists(here):
                fs.mkdirs(there.getParent())
                if not fs.rename(here, there):
                    raise TargetError(f"cannot move {here} into {table}")
        for name in given["old"]:
            gone = _path(spark, name)
            fs.delete(gone, False)
            if not gone.getParent().equals(fs.makeQualified(root)) and not fs.listStatus(gone.getParent()):
                fs.delete(gone.getParent(), False)
        fs.delete(stage, True)
        fs.delete(journal, False)
    if journals:
        if found.partitionColumnNames().size():
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
    return len(journals)


# ---------------------------------------------------------------- databases


@contextmanager
def jdbc_catalog(spark: SparkSession, database: str, connection: dict) -> Iterator[str]:
    """The database as a Spark catalog, for existence and DROP. Its settings, password included, leave the session
    with the block, and no other use shares the catalog's name."""
    name = f"db_{uuid.uuid4().hex}"
    prefix = f"spark.sql.catalog.{name}"
    settings = {f"{prefix}.{key}": value for key, value in connection_options(database, connection).items()}
    settings[prefix] = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield name
    finally:
        for key in settings:
            spark.conf.unset(key)


def jdbc_write_plan(operation: str, exists: bool, table: str) -> tuple[str, dict[str, str]]:
    """Spark save mode and options of an operation on a database table."""
    operation = operation_name(operation)
    require_state(operation, exists, table)
    return {
        "create": ("errorifexists", {}),
        "append": ("append", {}),
        "create_if_not_exists": ("append", {}),
        "truncate": ("overwrite", {"truncate": "true"}),
        "replace": ("overwrite", {"truncate": "false"}),
        "drop": ("drop", {}),
    }[operation]


def write_jdbc(df: DataFrame | None, database: str, target: dict, connection: dict) -> None:
    """The modes on a database table. `partitions` bounds the number of open connections."""
    spark = df.sparkSession if df is not None else SparkSession.active()
    table = table_name(target)
    with jdbc_catalog(spark, database, connection) as catalog:
        mode, extra = jdbc_write_plan(target["operation"], spark.catalog.tableExists(f"{catalog}.{table}"), table)
        if mode == "drop":
            spark.sql(f"DROP TABLE {catalog}.{table}")
            return
        if mode == "append" and target.get("operation") == "append":
            require_columns(spark.table(f"{catalog}.{table}").columns, df.columns, table)
    options = {**connection_options(database, connection), **extra, "dbtable": table}
    options["numPartitions"] = str(target.get("partitions") or 16)
    if target.get("batch_size"):
        options["batchsize"] = str(target["batch_size"])
    df.write.format("jdbc").options(**options).mode(mode).save()
