"""One row of every class of near copies, whatever the ids of its rows."""

import random

from rollcall.llm import near_dedup
from rollcall.llm.common import prepare


def passage(seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(120)]


def changed(words, at):
    return [*words[:at], "changed", *words[at + 1 :]]


def kept(spark, rows):
    prepare(spark)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    return [(r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()]


def test_near_copies_without_ids_leave_one(spark):
    a, b = passage(1), passage(2)
    got = kept(spark, [(None, a), (None, changed(a, 119)), (None, changed(a, 0)), (None, b), (None, b)])
    assert len(got) == 2 and " ".join(b) in {t for _, t in got}


def test_unrelated_texts_of_one_id_both_stay(spark):
    a, b, c = passage(1), passage(2), passage(3)
    got = kept(spark, [(7, a), (7, b), (8, changed(a, 119)), (9, changed(b, 119)), (None, c), (3, changed(c, 119))])
    assert sorted(got) == sorted([(7, " ".join(a)), (7, " ".join(b)), (3, " ".join(changed(c, 119)))])


def test_no_column_depends_on_the_pivots_of_a_bucket(spark, monkeypatch):
    prepare(spark)
    words = passage(4)
    docs = spark.createDataFrame([(i, " ".join(changed(words, i % 3 * 59) + [f"n{i}"])) for i in range(24)], "doc_id long, text string")
    answers = []
    for pivots in (2, 8, 100):
        monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
        answers.append(sorted(tuple(r) for r in near_dedup.classes(docs).collect()))
    assert answers[0] == answers[1] == answers[2]
    assert {r[3] for r in answers[0]} == {0}
