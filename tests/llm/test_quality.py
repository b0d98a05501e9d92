import re
from collections import defaultdict

import pytest

from millrace.llm import quality


def naive(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), twice, len(covered)


def test_statistics(spark, odd_docs, no_docs, text_of):
    texts = [None, "", "a", "a b c d e f g h", "x " * 8, "x " * 9, "x " * 23, "a b c d e f g h i a b c d e f g h", "é ü\x0bq\x0cz k",
             text_of(1, 60) * 2, "l\nl\n\n \nl \nl", "\U0001F600 # *|", "\0 \x1c \x1f", text_of(3, 30) + " ".join("abcdefgh") * 3]
    df = spark.createDataFrame([(t, 7) for t in texts], "text string, n_words int").union(odd_docs.selectExpr("text", "1"))
    for r in quality.with_statistics(df).collect():
        assert tuple(r[n] for n in quality.STATISTICS) == naive(r.text), r.text
    assert dict(quality.with_statistics(df).dtypes)["n_words"] == "bigint"
    assert quality.with_statistics(no_docs).count() == 0


@pytest.fixture(scope="module")
def graded(spark, text_of):
    """Bad texts are full of signs, or repeat themselves; a few labels are wrong."""
    rows = []
    for i in range(600):
        text = text_of(i, 60)
        bad = i % 4 == 0 or i % 7 == 0
        if i % 4 == 0:
            text = text.replace(" ", "%% ")
        elif i % 7 == 0:
            text = text[:80] * 6
        rows.append((i, text, int(not bad) if i % 97 else int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, None), (None, 1), (10_000, 0)], "doc_id long, quality int")
    return docs, labels


def test_learns_the_cause(graded):
    docs, labels = graded
    rules = quality.learn(quality.labelled_statistics(docs, labels))
    assert 2 <= len(rules.rules) <= 4
    got = {r.doc_id: r for r in quality.apply_rules(docs, rules).collect()}
    held = [i for i in got if i % 97]
    right = sum(got[i].kept == (not (i % 4 == 0 or i % 7 == 0)) for i in held)
    assert right / len(held) > 0.98
    clean = [i for i in held if i % 4 and i % 7]
    assert sum(got[i].rule is not None for i in clean) <= 0.02 * len(clean)
    signs = {"symbols_per_char", "symbols_per_word", "chars_per_word"}  # signs put behind words raise all three
    assert any(t.feature in signs for r in rules.rules for t in r.tests)
    assert all(r.bad >= 0.9 * (r.bad + r.good) for r in rules.rules)


def test_sample_is_bounded_and_steady(graded):
    docs, labels = graded
    some = quality.labelled_statistics(docs, labels, max_labelled=200)
    assert 100 < some.count() < 300
    assert some.exceptAll(quality.labelled_statistics(docs.repartition(7), labels.repartition(3), max_labelled=200)).isEmpty()


def test_nothing_to_learn(spark, graded, odd_docs):
    docs, labels = graded
    for few in (labels.where("false"), labels.where("quality = 1"), labels.where("quality = 0")):
        rules = quality.learn(quality.labelled_statistics(docs, few))
        assert rules.rules == []
    got = quality.apply_rules(odd_docs, rules).collect()
    assert all(r.kept != r.base_failed for r in got) and len(got) == odd_docs.count()
