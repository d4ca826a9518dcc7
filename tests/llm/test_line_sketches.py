"""Sketches of lines are as far apart as their tokens, and are made for lines that need them."""

import random
import re

from pyspark.sql import functions as F

from rollcall.llm import line_dedup
from tests.llm.test_llm import edit_distance


def test_sketches_are_as_far_apart_as_tokens(spark):
    rng = random.Random(3)
    base = [rng.choice(["word", "of", "Ünder", "一", "x,y", "𝒳z"]) + str(i) * (i % 2) for i in range(40)]
    lines = [" ".join(base), "too few tokens here", "\t" * 9]
    for n in range(1, 9):
        cut = list(base)
        for _ in range(n):
            at = rng.randrange(len(cut))
            cut[at : at + 1] = rng.choice([[], ["other"], [cut[at], "one-more"], ["二丁"]])
        lines.append("  ".join(cut))
    split = [re.findall(r"[\x21-\x7E]+|[^\x00-\x7F]", line) for line in lines]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    for salt in (0, 1):
        rows = frame.select("i", line_dedup.sketch(F.col("line"), salt).alias("s")).collect()
        got = {r["i"]: r["s"] for r in rows}
        assert got[1] is None and got[2] is None
        assert all(len(got[i]) == len(split[i]) for i in got if i not in (1, 2))
        assert all(edit_distance(got[0], got[i]) == edit_distance(split[0], split[i]) for i in got if i not in (1, 2))


def test_finished_statements_leave_no_shuffle(spark):
    lines = [f"line number {i} is about {'abcdefghij'[i % 10] * 9} and so on" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    tracker = spark._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    known, links = line_dedup.near_links(docs)
    assert known.count() == 200 and links.count() > 0
    assert tracker.shuffleStatuses().size() <= before
