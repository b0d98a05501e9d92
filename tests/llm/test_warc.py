import gzip
import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, Not, StringContains, StringStartsWith

from millrace.llm import warc
from millrace.session import scratch_dir


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 1200 + "</p>"
    rows = [(1, "http://a/", big), (2, "http://b/", big), (3, "http://c/\r\nWARC-Type: x", big), (4, None, "small"), (5, "http://d/", "small"),
            (6, "http://e/", None), (7, "http://f/", ""), (8, "u", "é\r\n\r\nWARC/1.1\r\n" + "ü" * 700), (None, "n", "y" * 1500),
            (None, "n", "y" * 1500), (9, "r", "z" * 1500), (9, "r", "z" * 1500)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")


@pytest.fixture(scope="module")
def archive(spark, pages):
    warc.register(spark)
    path = scratch_dir(spark, "warc-test")
    warc.records_of(pages).repartition(3).write.format("warc").option("file_bytes", 400).mode("append").save(path)
    return path


def test_round_trip(spark, pages, archive):
    got = spark.read.format("warc").load(archive).collect()
    assert Counter(r.record_type for r in got) == {"response": 10, "revisit": 2}
    read = {(r.record_id, r.target_uri, r.payload.decode()) for r in got if r.record_type == "response"}
    for row in pages.collect():
        key = f"urn:page:{'' if row.page_id is None else row.page_id}"
        uri = row.url and row.url.replace("\r", "%0D").replace("\n", "%0A")
        assert (key, uri, row.html or "") in read or row.page_id in (1, 2)
    for r in got:
        if r.record_type == "revisit":
            assert r.refers_to == "urn:page:3" and r.payload_length == 1207 and not r.payload
        else:
            assert r.payload_digest == "sha1:" + hashlib.sha1(r.payload).hexdigest() and r.payload_length == len(r.payload)


def test_pushed_predicates_skip_payloads(spark, archive):
    pushing = lambda: spark.read.format("warc").option("pushdown", "true").load(archive)
    found = pushing().where("record_type = 'revisit' and target_uri like 'http://a%'")
    assert [r.record_id for r in found.collect()] == ["urn:page:1"]
    given = [EqualTo(("record_type",), "revisit"), StringStartsWith(("target_uri",), "http://a"), Not(IsNull(("refers_to",))), GreaterThan(("payload_length",), 5)]
    assert [r.record_id for r in warc.read_archive(spark, archive, given).collect()] == ["urn:page:1"]
    with pytest.raises(ValueError):
        warc.read_archive(spark, archive, [EqualTo(("payload",), b"x")])
    asked, undone = [], []
    files = warc.PushingReader({"path": archive}, warc.Warc({}).schema() and spark.read.format("warc").load(archive).schema)
    rest = list(files.pushFilters([EqualTo(("record_type",), "revisit"), EqualTo(("payload",), b"x"), Not(IsNull(("target_uri",))), Not(EqualTo(("date",), ""))]))
    assert len(files.filters) == 2 and len(rest) == 2
    for part in files.partitions():
        for path in part.paths:
            list(warc.read_records(path, lambda f: f["warc-type"] == "revisit", lambda f: asked.append(f) or undone.append(f) or False))
    assert {f["warc-type"] for f in asked} == {"revisit"}
    none = spark.read.format("warc").option("decode", "").load(archive)
    assert none.where("payload is not null").isEmpty() and none.count() == 12


def test_filters_mean_what_sql_means(spark, archive):
    load = lambda: spark.read.format("warc").option("pushdown", "true").load(archive)
    plain = spark.createDataFrame(load().collect(), load().schema)
    for test in ["target_uri is null", "target_uri is not null and record_type in ('response', 'x')", "payload_length > 1000", "not (refers_to = 'a')",
                 "payload_length <= 5 or refers_to is null", "target_uri like '%c%'", "refers_to <=> null", "target_uri >= 'http://c'"]:
        assert load().where(test).count() == plain.where(test).count(), test


def test_one_frame_serves_many_queries(spark, archive):
    found = spark.read.format("warc").load(archive)
    few, many = found.where("record_type = 'revisit'"), found.where("record_type = 'response'")
    assert (few.count(), many.count(), found.count()) == (2, 10, 12)
    assert few.unionAll(many).count() == 12
    some = warc.read_archive(spark, archive, [EqualTo(("record_type",), "revisit")], decode=[])
    assert some.where("target_uri like 'http://a%'").count() == 1 and some.count() == 2


@pytest.mark.parametrize("kind", ["plain", "gzip members", "one gzip stream of many reads"])
def test_files_of_others(tmp_path, kind):
    records = [warc.record_bytes({"WARC-Type": t, "WARC-Record-ID": f"<urn:{i}>"}, b"B" * n) for i, (t, n) in
               enumerate([("warcinfo", 10), ("response", 0), ("resource", 300_000), ("metadata", 7)])]
    path = tmp_path / "x.warc"
    path.write_bytes(b"".join(records) if kind == "plain" else b"".join(gzip.compress(r) for r in records))
    got = list(warc.read_records(str(path), decode=lambda f: f["warc-type"] != "warcinfo"))
    assert [(f["warc-record-id"], None if p is None else len(p)) for f, p in got] == [("<urn:0>", None), ("<urn:1>", 0), ("<urn:2>", 300_000), ("<urn:3>", 7)]
    few = list(warc.read_records(str(path), wanted=lambda f: f["warc-type"] == "metadata"))
    assert [len(p) for _, p in few] == [7]
    path.write_bytes(path.read_bytes()[:-20])
    with pytest.raises(EOFError):
        list(warc.read_records(str(path)))


def test_partitions_group_files_and_empty_archive(spark, archive, tmp_path):
    schema = spark.read.format("warc").load(archive).schema
    one = warc.WarcReader({"path": archive}, schema).partitions()
    many = warc.WarcReader({"path": archive, "split_bytes": "1"}, schema).partitions()
    assert len(one) == 1 and len(many) == len(one[0].paths) > 3
    assert spark.read.format("warc").load(str(tmp_path)).count() == 0


def test_commit_keeps_only_winning_tasks(tmp_path):
    writer = warc.WarcWriter({"path": f"file://{tmp_path}"}, overwrite=True)
    batch = lambda n: iter([pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": n, "payload": b"x"}])])
    writer.commit([writer.write(batch("old"))])
    lost, won = writer.write(batch("lost")), writer.write(batch("won"))
    assert lost.names != won.names
    writer.commit([won, None])
    got = [f["warc-record-id"] for x in tmp_path.iterdir() for f, _ in warc.read_records(str(x))]
    assert got == ["<won>"]
    gone = writer.write(batch("gone"))
    writer.abort([gone, None])
    assert len(list(tmp_path.iterdir())) == 1


def test_two_writers_into_one_archive(tmp_path):
    batch = lambda n: iter([pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": n, "payload": b"x"}])])
    first, second = (warc.WarcWriter({"path": f"file://{tmp_path}"}, overwrite=False) for _ in range(2))
    done = [(w, [w.write(batch(f"{n}{i}")) for i in range(2)]) for n, w in (("a", first), ("b", second))]
    for writer, messages in done:
        writer.commit(messages)
    got = sorted(f["warc-record-id"] for x in tmp_path.iterdir() for f, _ in warc.read_records(str(x)))
    assert got == ["<a0>", "<a1>", "<b0>", "<b1>"]


def test_no_pages(spark, pages):
    assert warc.records_of(pages.where("false")).count() == 0
    assert warc.records_of(pages).where(F.col("payload").isNull()).count() == 2


def test_in_filter():
    assert warc._holds(In(("record_type",), ("a", "b")), {"warc-type": "b"}) and not warc._holds(StringContains(("target_uri",), "q"), {})
