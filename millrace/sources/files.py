"""File sources: delimited text, Parquet, JSON, XML, ORC, object-store prefixes, landed REST payloads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.config import blank_to_none
from millrace.functions.columns import default_names, project
from millrace.operators.skew import fits_broadcast
from millrace.session import store

# File extension looked for per file type.
EXTENSIONS = {"csv": ".csv", "json": ".json", "parquet": ".parquet", "xml": ".xml", "orc": ".orc"}
# Common spellings -> character sets that Spark reads.
CHARSETS = {
    "utf8": "utf-8", "latin-1": "iso-8859-1", "latin1": "iso-8859-1", "latin_1": "iso-8859-1", "iso8859-1": "iso-8859-1",
    "ascii": "us-ascii", "utf_8": "utf-8", "utf16": "utf-16", "utf_16": "utf-16", "utf32": "utf-32",
}


def charset(encoding: str | None) -> str:
    name = (encoding or "utf-8").lower()
    return CHARSETS.get(name, name)


class SourceNotFound(Exception):
    """No file matches the source path."""


def _load(reader, path) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(str(path)) from err
        raise


def _char(value: str | None, default: str) -> str:
    value = blank_to_none(value) if value != " " else value
    return {None: default, "\\t": "\t", "\\n": "\n"}.get(value, value)


def read_csv(
    spark: SparkSession,
    path: str,
    delimiter: str | None = ",",
    quote_char: str | None = '"',
    escape_char: str | None = None,
    encoding: str | None = "utf-8",
    header: bool = True,
    skip_header: int = 0,
    skip_footer: int = 0,
    select=None,
    alias=None,
    schema: str | None = None,
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text, all files of a glob as one frame; `.gz` and `.bz2` are read as they are.

    One schema for the whole read. Give `schema` for large inputs: inferring it reads the data once
    more. `skip_header` drops rows after the header and `skip_footer` rows at the end, per file.
    A doubled quote stands for a quote unless an escape character is given.
    """
    options = {
        "sep": _char(delimiter, ","),
        "quote": _char(quote_char, '"'),
        "escape": _char(escape_char, '"'),
        "encoding": charset(encoding),
    }
    if skip_header or skip_footer:
        if multi_line:
            raise ValueError("skipping rows needs one record per line")
        df = _read_skipping(spark, path, options, header, skip_header, skip_footer, schema, infer)
    else:
        reader = spark.read.format("csv").options(**options, header=header, multiLine=multi_line)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", infer)
        df = _load(reader, path)
        if not header and not schema:
            df = default_names(df)
    return project(df, select, alias)


def _fixed_splits(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings in which files are always cut into the same splits.

    Spark sizes the splits of small inputs by the number of cores that are there when a job starts, and
    by settings that may have changed since. The caller's session is left as it is.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    if own.conf.get("spark.sql.files.minPartitionNum", None) is None:
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def numbered_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Non-blank lines with their file, the start of their split, whether that is a first or last one of
    the file, and an id that grows along the split.

    The ids are used in two passes, so both must cut files into the same splits: the files are read in
    a session of their own.
    """
    fixed = _fixed_splits(spark)
    if charset(encoding) == "utf-8":
        lines = _load(fixed.read.format("text"), path)
    else:
        # The text source knows UTF-8 only; CSV with one column and no quotes yields lines of any encoding.
        # U+FFFF is no character, so no text holds the separator.
        reader = fixed.read.format("csv").options(sep="\uffff", quote="", encoding=charset(encoding))
        lines = _load(reader.schema("value string"), path)
    at = "_metadata.file_block_start"
    ends = f"{at} = 0 or {at} + _metadata.file_block_length >= _metadata.file_size"
    lines = lines.selectExpr("value", "_metadata.file_path as file", f"{at} as start", f"{ends} as at_end").where("trim(value) != ''")
    # An empty frame of the caller's session in front: what is made of the lines belongs to that session.
    none = spark.range(1).limit(0).selectExpr(*[f"cast(null as {t}) as {c}" for c, t in lines.dtypes])
    return none.unionAll(lines).withColumn("id", F.monotonically_increasing_id())


def edge_splits(lines: DataFrame, head: int, foot: int) -> DataFrame:
    """The splits that hold some of the first `head` or last `foot` lines of a file, with the ids to keep.

    Lines are counted per split (map-side); the window runs over one row per split, never over lines.
    """
    splits = lines.groupBy("file", "start", "at_end").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    up_to = Window.partitionBy("file").orderBy("start")
    n, first = F.col("n"), F.col("first")
    sized = splits.withColumns({
        "before": F.sum("n").over(up_to) - n,
        "total": F.sum("n").over(Window.partitionBy("file")),
    })
    top = F.greatest(F.lit(0), F.least(n, F.lit(head) - F.col("before")))
    tail = F.greatest(F.lit(0), F.least(n, F.lit(foot) - (F.col("total") - F.col("before") - n)))
    return sized.where((top > 0) | (tail > 0)).select(
        "file", "start", "at_end", (first + top).alias("keep_from"), (first + n - tail).alias("keep_to")
    )


def without_edge_lines(lines: DataFrame, head: int, foot: int) -> DataFrame:
    """One stored row per split at the edge of a file says which ids to keep. If these rows are measured to
    fit, they are broadcast and no line moves; else only the lines of first and last splits meet them by
    split, unless an edge reaches into a split between."""
    edges = store(edge_splits(lines, head, foot), "edges")
    moved, rest = lines, None
    if fits_broadcast(edges):
        edges = F.broadcast(edges)
    else:
        if edges.where("not at_end").isEmpty():
            moved, rest = lines.where("at_end"), lines.where("not at_end")
        edges = edges.hint("merge")
    kept = moved.join(edges.drop("at_end"), ["file", "start"], "left").where(
        F.col("keep_from").isNull() | ((F.col("id") >= F.col("keep_from")) & (F.col("id") < F.col("keep_to")))
    )
    kept = kept.select(*lines.columns)
    return kept if rest is None else kept.unionAll(rest)


def _read_skipping(spark, path, options, header, skip_header, skip_footer, schema, infer) -> DataFrame:
    names = _load(spark.read.format("csv").options(**options, header=header), path).columns
    if not header:
        names = [f"column{i + 1}" for i in range(len(names))]
    lines = numbered_lines(spark, path, options["encoding"])
    kept = without_edge_lines(lines, skip_header + (1 if header else 0), skip_footer)
    ddl = schema or ", ".join(f"`{n}` string" for n in names)
    parsing = {k: v for k, v in options.items() if k != "encoding"}
    df = kept.select(F.from_csv("value", ddl, parsing).alias("r")).select("r.*")
    return infer_types(df) if infer and not schema else df


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns to long, double or timestamp where every value fits: one aggregate, one row back."""
    steps = ("bigint", "double", "timestamp_ntz")
    tests = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{i}_{t}")
        for i, c in enumerate(df.columns) for t in steps
    ]
    filled = [F.count(F.col(c)).alias(f"{i}_n") for i, c in enumerate(df.columns)]
    row = df.agg(*tests, *filled).first()
    casts = {}
    for i, c in enumerate(df.columns):
        fit = [t for t in steps if row[f"{i}_{t}"] == 0]
        if fit and row[f"{i}_n"]:
            casts[c] = F.col(c).cast(fit[0])
    return df.withColumns(casts) if casts else df


def read_parquet(spark: SparkSession, path: str, select=None, alias=None, merge_schema: bool = False) -> DataFrame:
    return project(_load(spark.read.format("parquet").option("mergeSchema", merge_schema), path), select, alias)


def read_orc(spark: SparkSession, path: str, select=None, alias=None) -> DataFrame:
    return project(_load(spark.read.format("orc"), path), select, alias)


def read_json(spark: SparkSession, path: str, encoding: str | None = None, lines: bool = False, schema: str | None = None, select=None, alias=None) -> DataFrame:
    """A JSON array of records per file, or JSON lines (splittable; use it for large files)."""
    reader = spark.read.format("json").option("multiLine", not lines)
    if encoding:
        reader = reader.option("encoding", charset(encoding))
    if schema:
        reader = reader.schema(schema)
    return project(_load(reader, path), select, alias)


def read_xml(spark: SparkSession, path: str, row_tag: str = "row", encoding: str | None = None, schema: str | None = None, select=None, alias=None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if encoding:
        reader = reader.option("charset", charset(encoding))
    if schema:
        reader = reader.schema(schema)
    return project(_load(reader, path), select, alias)


def read_prefix(spark: SparkSession, prefix: str, file_type: str, options: dict | None = None, schema: str | None = None) -> DataFrame:
    """Every object below a prefix with the extension of its type, whatever its case.

    `prefix` may end inside a name, as an object-store listing allows.
    """
    if file_type not in EXTENSIONS:
        raise ValueError(f"file_type must be one of {', '.join(EXTENSIONS)}")
    ends = "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in EXTENSIONS[file_type])
    reader = spark.read.format(file_type).option("pathGlobFilter", "*" + ends).option("recursiveFileLookup", True)
    if file_type == "csv":
        reader = reader.options(header=True, inferSchema=schema is None, escape='"')
    if file_type == "xml":
        reader = reader.option("rowTag", "row")
    reader = reader.options(**(options or {}))
    if schema:
        reader = reader.schema(schema)
    return _load(reader, prefix if prefix.endswith("/") else prefix + "*")


def read_payload(spark: SparkSession, path: str, records: str | None = None, schema: str | None = None) -> DataFrame:
    """Landed REST responses: arrays of records, or objects that hold the array under `records`."""
    df = read_json(spark, path, schema=schema)
    return df.select(F.inline(F.col(records))) if records else df
