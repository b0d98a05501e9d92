"""File sources and sinks."""

import bz2
import gzip
import os

import pytest

from millrace.functions.columns import default_names, project
from millrace.sinks import files as sink
from millrace.sinks.files import PublishError, publish, write_dated, write_files
from millrace.sinks.payload import payload_batches
from millrace.operators import skew
from millrace.sources import files as src
from millrace.sources.manifest import file_manifest, manifest_of_subtask


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("split_bytes", ["64", "300", "134217728"])
@pytest.mark.parametrize("broadcast", [0, 10**8])
def test_skip_header_and_footer_per_file(spark, tmp_path, split_bytes, broadcast, monkeypatch):
    """Files cut into many splits; the edges may span splits; a file shorter than its edges."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast)
    for f in range(3):
        lines = ["id,name"] + [f"skip{f},{i}" for i in range(4)]
        lines += [f"{f * 1000 + i},name {i}" + ("\n" if i % 7 == 0 else "") for i in range(200)]
        lines += ["foot", "foot,er with a longer text so that it takes more than one split of the file to hold it", "foot"]
        put(tmp_path / f"f{f}.csv", "\n".join(lines) + "\n")
    put(tmp_path / "f9.csv", "id,name\nonly,one\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    settings = spark.conf.getAll
    try:
        df = src.read_csv(spark, str(tmp_path / "f*.csv"), skip_header=4, skip_footer=3)
        got = sorted((r["id"], r["name"]) for r in df.collect())
        assert spark.conf.getAll == settings
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(f * 1000 + i, f"name {i}") for f in range(3) for i in range(200)]
    assert df.dtypes == [("id", "bigint"), ("name", "string")]
    # The splits are those of the time of the read, and the frame belongs to the caller's session.
    assert sorted((r["id"], r["name"]) for r in df.collect()) == got
    df.createOrReplaceTempView("skipped_lines")
    assert spark.sql("SELECT count(*) FROM skipped_lines").first()[0] == 600
    spark.catalog.dropTempView("skipped_lines")


@pytest.mark.parametrize("head", [1, 60])
def test_without_broadcast_only_end_splits_move(spark, tmp_path, monkeypatch, head):
    """An edge of one line leaves the splits between alone; one of 60 lines reaches into them."""
    put(tmp_path / "a.txt", "".join(f"line {i:04}\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        lines = src.numbered_lines(spark, str(tmp_path / "a.txt"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    kept = src.without_edge_lines(lines, head, 1)
    assert sorted(r["value"] for r in kept.collect()) == [f"line {i:04}" for i in range(head, 999)]
    assert ("Union" in kept._jdf.queryExecution().optimizedPlan().toString()) == (head == 1)


def test_csv_options(spark, tmp_path, as_rows):
    path = put(tmp_path / "a.csv", 'k;name;note\n1;"Müller; ""X""";é\n2;Ñandú;\n', "latin-1")
    df = src.read_csv(spark, path, delimiter=";", encoding="latin-1")
    assert as_rows(df) == [(1, 'Müller; "X"', "é"), (2, "Ñandú", None)]
    named = src.read_csv(spark, path, delimiter=";", encoding="latin-1", select="k, note", alias="id,text")
    assert named.columns == ["id", "text"]
    skipped = src.read_csv(spark, path, delimiter=";", encoding="latin-1", skip_header=1)
    assert as_rows(skipped) == [(2, "Ñandú", None)]


def test_csv_without_header(spark, tmp_path, as_rows):
    path = put(tmp_path / "a.csv", "1,x\n2,y\n")
    df = src.read_csv(spark, path, header=False)
    assert df.columns == ["column1", "column2"] and as_rows(df) == [(1, "x"), (2, "y")]
    assert src.read_csv(spark, path, header=False, alias="a,b").columns == ["a", "b"]


def test_csv_tabs_and_escape(spark, tmp_path, as_rows):
    path = put(tmp_path / "a.csv", 'a\tb\n1\t"x \\"y\\""\n')
    assert as_rows(src.read_csv(spark, path, delimiter="\\t", escape_char="\\")) == [(1, 'x "y"')]


def test_compressed_csv(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    (tmp_path / "b.csv.bz2").write_bytes(bz2.compress(b"a,b\n3,4\n"))
    (tmp_path / "c.txt").write_bytes(b"a,b\n5,6\n")
    assert sorted(r["a"] for r in src.read_csv(spark, str(tmp_path / "*")).collect()) == [1, 3, 5]


def test_missing_source(spark, tmp_path):
    with pytest.raises(src.SourceNotFound):
        src.read_csv(spark, str(tmp_path / "no*.csv"))
    with pytest.raises(src.SourceNotFound):
        src.read_parquet(spark, str(tmp_path / "no.parquet"))


def test_json_array_and_wrapped_payload(spark, tmp_path, as_rows):
    path = put(tmp_path / "a.json", '[{"a": 1, "b": "x"},\n {"a": 2, "b": null}]')
    assert as_rows(src.read_json(spark, path)) == [(1, "x"), (2, None)]
    path = put(tmp_path / "b.json", '{"page": 1, "data": [{"a": 1}, {"a": 2}]}')
    assert as_rows(src.read_payload(spark, path, "data")) == [(1,), (2,)]


def test_xml_children_of_root(spark, tmp_path, as_rows):
    path = put(tmp_path / "a.xml", "<list><item><a>1</a><b>x</b></item><item><a>2</a></item></list>")
    assert as_rows(src.read_xml(spark, path, "item")) == [(1, "x"), (2, None)]


def test_prefix_matches_case_and_depth(spark, tmp_path):
    for name in ("in/x/a.csv", "in/x/deep/B.CSV", "in/xy.csv"):
        put(tmp_path / name, "v\n1\n")
    put(tmp_path / "in/x/c.txt", "v\n9\n")
    put(tmp_path / "in/other.csv", "v\n8\n")
    assert src.read_prefix(spark, f"{tmp_path}/in/x", "csv").count() == 3
    assert src.read_prefix(spark, f"{tmp_path}/in/x/", "csv").count() == 2
    with pytest.raises(ValueError):
        src.read_prefix(spark, str(tmp_path), "doc")


def test_null_fields_survive_json(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_files(spark.sql("select 1 as a, cast(null as string) as b"), path, "json") == 1
    assert "b" in src.read_json(spark, path, lines=True).columns


def test_dated_replace_and_append(spark, tmp_path):
    path, df = str(tmp_path / "d"), spark.range(5)
    for day, operation in (("20240101", "append"), ("20240102", "append"), ("20240102", "append"), ("20240101", "replace")):
        write_dated(df, path, "parquet", operation, day, strings=True)
    got = spark.read.parquet(path)
    assert dict(got.dtypes)["id"] == "string"
    assert sorted((r["load_dt"], r["count"]) for r in got.groupBy("load_dt").count().collect()) == [(20240101, 5), (20240102, 10)]


def test_publish_replaces_or_adds(spark, tmp_path):
    target = str(tmp_path / "t")
    for i, append in enumerate([False, True, True, False]):
        stage = str(tmp_path / f"s{i}")
        write_files(spark.range(i + 1), stage, "parquet")
        publish(spark, stage, target, append)
        assert not os.path.exists(stage)
        assert spark.read.parquet(target).count() == [1, 3, 6, 4][i]


@pytest.mark.parametrize("order", [None, ["id"]])
def test_payload_batches_are_bounded(spark, order):
    # All rows but the key are copies.
    df = spark.range(1005).selectExpr("id", "'same' as v", "double('NaN') as x").repartition(3)
    got = payload_batches(df, 100, order).collect()
    assert max(r["rows"] for r in got) <= 100 and sum(r["rows"] for r in got) == 1005
    import json

    ids = [rec["id"] for r in got for rec in json.loads(r["payload"])]
    assert sorted(ids) == list(range(1005))
    assert all(rec["x"] is None for r in got for rec in json.loads(r["payload"]))


def test_projection_errors(spark):
    with pytest.raises(ValueError):
        project(spark.range(1), "nope")
    with pytest.raises(ValueError):
        project(spark.range(1), None, "a,b")
    assert default_names(spark.range(1)).columns == ["column1"]


def test_manifest(spark, tmp_path, as_rows):
    for name in ("in/icp1.csv", "in/sub/icp2.csv", "in/other.csv", "in/icp3.txt", "in/icpnoext"):
        put(tmp_path / name, "x")
    detail = {
        "subtask": "1",
        "source": {"file_path": f"{tmp_path}/in/", "files_filter_name": "icp*", "subfolder_included": "yes", "operation": "move"},
        "target": {"file_path": "/out/", "object_prefix_name": "t_", "object_sufix_name": "_9"},
    }
    got = manifest_of_subtask(spark, detail).select("source_file", "bytes", "operation", "target_file")
    assert as_rows(got) == [
        ("icp1.csv", 1, "move", "/out/t_icp1_9.csv"), ("icp3.txt", 1, "move", "/out/t_icp3_9.txt"),
        ("icpnoext", 1, "move", "/out/t_icpnoext_9"), ("sub/icp2.csv", 1, "move", "/out/sub/t_icp2_9.csv"),
    ]
    assert file_manifest(spark, f"{tmp_path}/in", "*.csv").count() == 2


@pytest.mark.parametrize("append", [False, True])
def test_failed_rename_leaves_the_target(spark, tmp_path, monkeypatch, append):
    target, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    spark.range(10).coalesce(1).write.parquet(target)
    spark.range(7).repartition(3).write.parquet(stage)
    real, calls = sink._moved, []

    def failing(fs, a, b):
        calls.append((a, b))
        if len(calls) == 2:
            raise PublishError("disk is full")
        real(fs, a, b)

    monkeypatch.setattr(sink, "_moved", failing)
    with pytest.raises(PublishError):
        publish(spark, stage, target, append)
    assert spark.read.parquet(target).count() == 10 and spark.read.parquet(stage).count() == 7
    assert sorted(os.listdir(tmp_path)) == ["s", "t"]
    monkeypatch.undo()
    publish(spark, stage, target, append)
    assert spark.read.parquet(target).count() == (17 if append else 7) and os.listdir(tmp_path) == ["t"]


def test_missing_stage_leaves_the_target(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    with pytest.raises(PublishError):
        publish(spark, f"{tmp_path}/none", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10


def test_rename_that_answers_false_is_noticed(spark, tmp_path):
    class Fs:
        def rename(self, a, b):
            return False

    with pytest.raises(PublishError):
        sink._moved(Fs(), "a", "b")


def test_latin_lines_keep_control_characters(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("head\nx\x01y \xe9\nfoot\n".encode("latin-1"))
    lines = src.without_edge_lines(src.numbered_lines(spark, str(tmp_path), "iso-8859-1"), 1, 1)
    assert [r["value"] for r in lines.collect()] == ["x\x01y \xe9"]


@pytest.mark.parametrize("file_type", ["csv", "json", "xml"])
def test_text_formats_keep_microseconds(spark, tmp_path, file_type):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:09:58.778549' as a, timestamp'1969-12-31 23:59:59.000001' as b, cast(null as timestamp) as c")
    write_files(df, f"{tmp_path}/x", file_type)
    options = {"header": True, "rowTag": "row"}
    back = spark.read.schema(df.schema).options(**options).format(file_type).load(f"{tmp_path}/x")
    assert back.collect() == df.collect()
