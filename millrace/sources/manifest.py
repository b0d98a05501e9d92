"""Bulk file tasks: which files go where, under which name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import as_list, blank_to_none, is_yes


def file_manifest(
    spark: SparkSession, folder: str, name_glob: str = "*", subfolders: bool = False,
    target_folder: str = "", prefix: str = "", suffix: str = "", operation: str = "copy",
) -> DataFrame:
    """One row per file: source path, size and target path. Only listings are read, no content.

    `a/b.csv` with prefix `x_` and suffix `_1` goes to `<target>/a/x_b_1.csv`.
    """
    if operation not in {"copy", "move"}:
        raise ValueError("operation must be copy or move")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
    files = reader.option("recursiveFileLookup", subfolders).load(folder).select("path", "length")
    base = folder.split(":", 1)[-1].rstrip("/").replace("//", "/") + "/"
    relative = F.substring_index("path", base, -1)
    name = F.substring_index(relative, "/", -1)
    below = F.substring(relative, F.lit(1), F.length(relative) - F.length(name))
    ext = F.regexp_extract(name, r"(\.[^.]*)?$", 0)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    target = F.concat(F.lit(target_folder.rstrip("/") + "/"), below, F.lit(prefix), stem, F.lit(suffix), ext)
    return files.select(
        relative.alias("source_file"), F.col("length").alias("bytes"), F.lit(operation).alias("operation"),
        target.alias("target_file"),
    )


def manifest_of_subtask(spark: SparkSession, detail: dict) -> DataFrame:
    """The manifest of one entry of a bulk task's `details`."""
    source, target = blank_to_none(detail["source"]), blank_to_none(detail["target"])
    return file_manifest(
        spark, source["file_path"], (as_list(source.get("files_filter_name")) or ["*"])[0],
        is_yes(source.get("subfolder_included")), target.get("file_path") or "",
        target.get("object_prefix_name") or "", target.get("object_sufix_name") or "",
        source.get("operation") or "copy",
    ).withColumn("subtask", F.lit(str(detail.get("subtask", ""))))
