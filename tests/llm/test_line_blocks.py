"""Large groups of near lines: every link counts, and what is moved grows with the lines."""

import random

import pytest

from rollcall.llm import line_dedup
from tests.llm.test_line_lengths import near


def group(rng, n, size):
    """``n`` different lines, each a few words from one line of ``size`` words."""
    base = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(size)]
    out = {" ".join(base)}
    while len(out) < n:
        cut = list(base)
        for _ in range(rng.randint(1, min(3, size - 1))):
            at = rng.randrange(len(cut))
            cut[at : at + 1] = rng.choice([["other"], [], [cut[at] + "x"], [cut[at], "new"], ["y" + cut[at][1:]]])
        out.add(" ".join(cut))
    return sorted(out)


@pytest.mark.parametrize("block", [7, line_dedup.BLOCK])
def test_links_within_large_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "LARGE", 4)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = random.Random(5)
    lines = [line for size in (3, 18, 35, 66) for line in group(rng, 30, size)] + group(rng, 4, 20)
    rng.shuffle(lines)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_links"], r["n_near"]) for r in line_dedup.report(docs).collect()}
    linked = {i: [j for j, y in enumerate(lines) if j != i and near(x, y)] for i, x in enumerate(lines)}
    assert got == {i: (len(js), int(any(j < i for j in js))) for i, js in linked.items()}
    assert sum(map(len, linked.values())) > 500


def test_rows_grow_with_the_lines_of_a_group_not_with_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LARGE", 8)
    lines = group(random.Random(6), 400, 40)
    rows = {}
    for n in (200, 400):
        frame = spark.createDataFrame(list(enumerate(lines[:n])), "hash long, line string")
        found = line_dedup.candidates(frame)
        rows[n] = found.count()
        assert line_dedup.small_pairs(found).count() < 8 * n
    assert rows[400] < 3 * rows[200]
