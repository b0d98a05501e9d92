import pytest
from pyspark.sql import functions as F

from millrace.llm import lines


@pytest.fixture(scope="module")
def corpus(spark):
    wide, near, narrow = "this line is everywhere", "this line is on ten sites", "this line is on nine sites"
    rows = []
    for i in range(40):
        text = f"own line number {i} here\n  {wide}\t\r\nend of text {i} now"
        text += f"\n{near}" if i < 10 else ""
        text += f"\n{narrow}" if i < 9 else ""
        rows.append((i, text, f"s{i}"))
    rows += [(100, wide, "s1"), (101, f"{wide}\n \n{wide}", "s2"), (102, None, "s3"), (103, "", "s3"), (104, f"{narrow}\nrest stays here too", None),
             (105, narrow + "\nok", "s1"), (105, narrow + "\nok", "s1"), (None, f"a\n{wide}", "s5")]
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, source string, at string, n_lines int")


def test_removal(corpus):
    got = lines.remove_spread_lines(corpus)
    assert got.select("doc.*").columns == corpus.columns and got.count() == corpus.count()
    of = {r.doc.doc_id: r for r in got.collect()}
    assert of[0].text == "own line number 0 here\nend of text 0 now\nthis line is on nine sites" and of[0].n_removed == 2
    assert of[9].n_removed == 2 and of[20].n_removed == 1 and of[20].n_lines == 3
    assert of[100].text == "this line is everywhere" and of[100].n_removed == 0
    assert of[101].n_removed == 0 and of[102].text is None and of[103].text == "" and of[103].n_lines == 0
    assert of[104].n_removed == of[105].n_removed == 0
    assert of[None].text == "a" and of[None].n_removed == 1


@pytest.mark.parametrize("limit", [9, 10, 11, 40, 41])
def test_against_exact_counts(corpus, limit):
    got = {r.line for r in lines.spread_lines(corpus, "text", "source", limit, 4).collect()}
    flat = corpus.select("source", F.explode(F.split("text", "\n")).alias("l")).select("source", F.btrim("l", F.lit(" \t\r")).alias("l"))
    exact = flat.where(F.size(F.split("l", " ")) >= 4).groupBy("l").agg(F.countDistinct("source").alias("n")).where(F.col("n") >= limit)
    assert got == {r[0] for r in exact.select(F.xxhash64("l")).collect()}


def test_odd_documents(odd_docs, no_docs):
    got = lines.remove_spread_lines(odd_docs)
    assert got.select("doc.*").columns == odd_docs.columns
    assert sorted(map(str, (r.doc.text for r in got.collect()))) == sorted(map(str, (r.text for r in got.collect())))
    assert lines.remove_spread_lines(no_docs).count() == 0


def test_short_lines_count_too(spark):
    rows = [(i, f"text number {i}\nAll rights reserved.\n版权所有\n{'nine' if i < 9 else 'else ' + str(i)}", f"s{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    of = {r.doc.doc_id: r for r in lines.remove_spread_lines(docs).collect()}
    assert of[0].text == "text number 0\nnine" and of[11].text == "text number 11\nelse 11"
    assert {r.n_removed for r in of.values()} == {2}
    kept = lines.remove_spread_lines(docs, min_words=4).collect()
    assert {r.n_removed for r in kept} == {0}
