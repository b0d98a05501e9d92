import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def folded(spark, rows):
    return {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(spark.createDataFrame(rows, EVENTS)).collect()}


def test_fold(spark):
    got = folded(spark, [
        (1, 1, 1, "open", "user", None), (1, 1, 3, "delta", None, "b"), (1, 1, 2, "delta", None, "a"), (1, 1, 2, "delta", None, "a"),
        (1, 2, 4, "open", "assistant", None), (1, 2, 5, "delta", None, "wrong"), (1, 2, 6, "regenerate", None, None),
        (1, 2, 7, "delta", None, "ri"), (1, 2, 8, "delta", None, "ght"),
        (1, 3, 9, "open", "user", None), (1, 3, 10, "delta", None, "x"), (1, 3, 11, "edit", None, "new"), (1, 3, 12, "delta", None, "!"),
        (1, 4, 13, "open", "assistant", None), (1, 5, 14, "delta", None, "orphan"), (1, 6, 15, "edit", None, None),
        (None, 1, 1, "open", "user", None), (1, 7, None, "delta", None, "early"), (1, 7, 16, "open", "user", None), (1, 4, 17, "other", None, "?"),
    ])
    assert got == {
        (1, 1): ("user", "ab"), (1, 2): ("assistant", "right"), (1, 3): ("user", "new!"), (1, 4): ("assistant", ""),
        (1, 5): ("", "orphan"), (1, 6): ("", ""), (None, 1): ("user", ""), (1, 7): ("user", ""),
    }


@pytest.fixture(scope="module")
def talks():
    hard = ["<|end|>", "<|user|>", r"<\|end|>", r"<\\|", "a<", "|b", "<", "\\", "", None, "<|<|<\\|", "é\n\r\0", "x" * 5000, r"\### Assistant: </turn> ok"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hard)]
    rows += [(2, None, None, "no role"), (2, 3, "role|>x", "y"), (2, 3, "assistant", "same turn"), (2, 3, "assistant", "same turn"), (None, 1, "assistant", "z")]
    rows += [(3, i, "assistant", hard[i % len(hard)]) for i in range(120)]
    return rows


def test_round_trip(spark, talks):
    rows = spark.createDataFrame([(*r, 1, "x") for r in talks], "conv_id long, turn long, role string, text string, seq long, message string")
    out = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.events_of(rows)))).collect()}
    want = {}
    for c, t, role, text in sorted(talks, key=lambda r: (str(r[0]), r[1] if r[1] is not None else -1, r[2] or "", r[3] is not None, r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(out) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in out[c].turns] == turns
        assert out[c].learned == "".join(t for r, t in turns if r == "assistant")


def test_marks_only_where_put(spark, talks):
    rows = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    for r in chat.render(chat.fold(chat.events_of(rows))).collect():
        n = sum(1 for t in talks if t[0] == r.conv_id)
        assert len(re.findall(r"<\|", r.formatted)) == 2 * n and r.formatted.endswith(chat.END)
        assert all(r.formatted[s.end :].startswith(chat.END) for s in r.loss)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="<|\\a>", max_size=8), min_size=20, max_size=20))
def test_escape(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    df = df.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t and "<|" not in r.e and (r.e == r.t or "<" in r.t)


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.render(chat.fold(chat.events_of(none)))).count() == 0


def test_no_python_in_the_plan(spark, sf):
    from millrace.llm.queries import QUERIES

    for name in ("op6_chat_format", "op2_quality_rules"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_known_digest(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.render(chat.fold(chat.events_of(rows)))).first()
    assert r.formatted == "<|user|>hi<|end|><|assistant|>yo<|end|>"
    assert hashlib.sha256(r.learned.encode()).hexdigest() == hashlib.sha256(b"yo").hexdigest()
