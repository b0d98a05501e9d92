"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    AQE re-plans joins at run time and splits skewed join partitions; time is UTC so that
    stamps mean the same on every executor.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of this machine: executors elsewhere could
    not read it, and it dies with its host.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context._jsc.sc().getCheckpointDir().get()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not created) in the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


_scopes = threading.local()  # a stream's batches run in a thread of their own


@contextmanager
def stored_until_end(spark: SparkSession) -> Iterator[None]:
    """Deletes what `store` writes inside when the block ends, also by an error."""
    outer, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        paths, _scopes.paths = _scopes.paths, outer
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def store(df: DataFrame, label: str, **options: int) -> DataFrame:
    """Write a frame once into the shared folder and go on from there.

    Cuts lineage, so that lost executors cost nothing downstream and every later pass sees the same
    rows; as Parquet, so that it reads only the columns it needs. The files stay until the block of
    `stored_until_end` ends that the call is in, if any. `options` are those of the Parquet writer.
    """
    path = scratch_dir(df.sparkSession, label)
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
