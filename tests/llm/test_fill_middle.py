"""Fill-in-middle against a plain version, and the rank index against all boundaries."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import fill_middle
from rollcall.llm.common import prepare

SCHEMA = "doc_id long, text string, n long, form string, prefix string, cut int, output string"


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, output = "plain", text
    elif h[3] % 100 < 20:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lengths = (None, None) if form == "plain" else (len(prefix), len(middle))
    return (doc_id, n, form, *lengths, sha(output), sha(text))


def corpus():
    rng = random.Random(3)
    alphabets = ["abc d\n", "aé ü", "漢字かな", "a𝄞漢é<", "<PSM>"]
    rows = [(i, "".join(rng.choice(alphabets[i % 5]) for _ in range(rng.randint(0, 400)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "null id é"), (None, "null id é"), (5, "again"), (1002, "x<M>y"), (1003, "<"), (1004, "<S")]
    rows += [(1005, "a" * 300_000 + "漢" * 300_000 + "é a" * 50_000), (1005, "a" * 300_000 + "漢" * 300_000 + "é a" * 50_000)]
    rows += [(1006, "𝄞" * 50_000), (-7, "minus")]
    return rows


def ordered(rows):
    return sorted(rows, key=str)


def test_equals_plain_version(spark):
    prepare(spark)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0, "x", "y", 1, "z") for i, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in fill_middle.digest(fill_middle.fill_in_middle(docs)).collect()]
    assert ordered(got) == ordered(expected(i, t) for i, t in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_parts_make_the_text(spark):
    prepare(spark)
    rows = [(i, t) for i, t in corpus() if t]
    docs = spark.createDataFrame([(i, t, 0, "x", "y", 1, "z") for i, t in rows], SCHEMA)
    whole = fill_middle.fill_in_middle(docs).filter("form <> 'plain'").selectExpr("doc_id", "concat(prefix, middle, suffix) text")
    assert {tuple(r) for r in whole.collect()} <= set(rows)


def test_empty_table(spark):
    prepare(spark)
    assert fill_middle.digest(fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA))).collect() == []


def test_whole_table_equals_plain_version(spark):
    from rollcall.llm.queries import QUERIES

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in QUERIES["op13_fill_in_middle"](spark, "/root/testdata/sf0.001").collect()]
    assert ordered(got) == ordered(expected(*r) for r in source)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("aé漢𝄞"), st.integers(1, 60)), max_size=30), st.integers(1, 20), st.integers(1, 16))
def test_rank_index(runs, bound, window):
    data = np.frombuffer("".join(c * n for c, n in runs).encode(), np.uint8)
    marks = fill_middle.boundaries(data)
    index = fill_middle.RankIndex.fit(marks, bound, window)
    assert (index.offset(np.arange(len(marks))) == marks).all()
    assert (np.abs(index.residual) <= bound + 1).all()


@pytest.mark.parametrize(("text", "segments"), [("plain text " * 5000, 1), ("漢字" * 5000, 1), ("a" * 5000 + "漢" * 5000 + "b" * 5000, 3)])
def test_segments_follow_the_slope(text, segments):
    marks = fill_middle.boundaries(np.frombuffer(text.encode(), np.uint8))
    assert len(fill_middle.RankIndex.fit(marks).first) <= segments + 1
