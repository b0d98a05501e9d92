"""File sinks, staging and publishing."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import all_strings

FORMATS = ("csv", "parquet", "json", "xml", "orc")
#: Text formats write milliseconds unless told otherwise, and the rest of a time would be lost.
MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_files(df: DataFrame, path: str, file_type: str, mode: str = "overwrite", options: dict | None = None) -> int:
    """Write part files in parallel; the row count is observed during the write, not scanned again."""
    if file_type not in FORMATS:
        raise ValueError(f"file type must be one of {', '.join(FORMATS)}")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(file_type)
    defaults = {
        "csv": {"header": True, "escape": '"', **MICROS},
        "json": {"ignoreNullFields": False, **MICROS},
        "xml": {"rootTag": "data", "rowTag": "row", **MICROS},
    }.get(file_type, {})
    writer.options(**{**defaults, **(options or {})}).save(path)
    return seen.get["rows"]


def write_dated(df: DataFrame, path: str, file_type: str, operation: str, day: dt.date | str | None = None, strings: bool = False, options: dict | None = None) -> int:
    """One folder per load day. `replace` overwrites that day only, `append` adds files to it."""
    if operation not in {"replace", "append"}:
        raise ValueError("operation must be replace or append")
    day = day or dt.datetime.now(dt.timezone.utc).date()
    day = day if isinstance(day, str) else f"{day:%Y%m%d}"
    df = all_strings(df) if strings else df
    mode = "overwrite" if operation == "replace" else "append"
    return write_files(df, f"{path.rstrip('/')}/load_dt={day}", file_type, mode, options)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path: the one door to local, HDFS and object-store folders."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


class PublishError(Exception):
    """The target could not be put in place; it is as it was before."""


def discard(spark: SparkSession, stage: str) -> None:
    fs, p = file_system(spark, stage)
    if fs.exists(p) and not fs.delete(p, True):
        raise PublishError(f"could not delete {stage}")


def _moved(fs, source, target) -> None:
    """A rename that did what it says: file systems report some failures by False, others by raising."""
    try:
        done = fs.rename(source, target)
    except Py4JJavaError as error:
        raise PublishError(f"could not rename {source} to {target}: {error.java_exception}") from error
    if not done:
        raise PublishError(f"could not rename {source} to {target}")


def publish(spark: SparkSession, stage: str, path: str, append: bool = False) -> None:
    """Put a checked stage in place of the target, or add its part files to it.

    If a rename fails, what was moved goes back, so the target and the stage are as before, and
    PublishError is raised. The data is not copied on a file system; on an object store a rename
    copies and is not atomic. The stage must be on the same file system as the target.
    """
    fs, source = file_system(spark, stage)
    _, target = file_system(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(source):
        raise PublishError(f"there is no stage {stage}")
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        _moved(fs, source, target)
        return
    if append:
        done = []
        try:
            for item in fs.listStatus(source):
                name = item.getPath().getName()
                if not name.startswith(("_", ".")):
                    _moved(fs, item.getPath(), make(target, name))  # part names carry a unique id
                    done.append((item.getPath(), make(target, name)))
        except PublishError:
            for was, now in done:
                _moved(fs, now, was)
            raise
        discard(spark, stage)
        return
    old = make(f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    _moved(fs, target, old)
    try:
        _moved(fs, source, target)
    except PublishError:
        _moved(fs, old, target)
        raise
    discard(spark, old.toString())
