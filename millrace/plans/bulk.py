"""Bulk tasks: one load per subtask, files of one store and format into another."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from millrace.config import is_yes
from millrace.sinks.files import discard, exists, publish, write_files
from millrace.sinks.tables import TargetError, operation_name
from millrace.sources.files import read_prefix


def _read_options(source: dict) -> dict:
    """Which files of a folder: by name pattern, or by how names begin and end; subfolders count unless refused."""
    start, end = source.get("object_prefix_name") or "", source.get("object_sufix_name") or ""
    pattern = source.get("files_filter_name") or (f"{start}*{end}" if start or end else "")
    options = {"pathGlobFilter": pattern} if pattern else {}
    below = source.get("subfolder_included")
    return options if below is None else {**options, "recursiveFileLookup": is_yes(below)}


def run_bulk(spark: SparkSession, details: list[dict], read_options: dict | None = None) -> list[tuple[str, int]]:
    """(subtask, rows) per entry. Entries: subtask, source {file_path, file_type, and optionally
    files_filter_name, object_prefix_name, object_sufix_name, subfolder_included}, target {file_path,
    file_type, operation: append or replace}. Each entry is a distributed job of its own, written beside its
    target and published when complete."""
    done = []
    for d in details:
        s, t = d["source"], d["target"]
        operation = operation_name(t.get("operation") or "replace")
        if operation not in {"append", "replace"}:
            raise TargetError(f"a bulk load can append or replace, not {operation}")
        df = read_prefix(spark, s["file_path"], s["file_type"], {**_read_options(s), **(read_options or {})}, s.get("schema_ddl"))
        stage = f"{t['file_path'].rstrip('/')}__stage_{uuid.uuid4().hex[:8]}"
        try:
            rows = write_files(df, stage, t["file_type"], "errorifexists")
            publish(spark, stage, t["file_path"].rstrip("/"), operation == "append")
        finally:
            if exists(spark, stage):
                discard(spark, stage)
        done.append((str(d["subtask"]), rows))
    return done
