"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import jaccard_join
from rollcall.llm.common import mix, prepare
from rollcall.llm.components import components

SCHEMA = "doc_id long, text string, node long, cell long, keys string, root int, k1 string, n int"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def expected(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            both = len(x & y)
            if x and y and 100 * both >= 90 * (len(x) + len(y) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def result(spark, rows):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, 1, 2, "x", 3, "y", 4) for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in jaccard_join.join(docs).drop("root").collect()), key=str)


def edited(rng, words, share):
    return " ".join(rng.choice("pqrst") * 3 if rng.random() < share else w for w in words)


def corpus(rng, families=25, members=8):
    rows = []
    for _ in range(families):
        words = ["".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(rng.choice([1, 2, 3, 5, 12, 13, 14, 22, 40, 90, 300]))]
        rows += [edited(rng, words[: len(words) - rng.choice([0, 0, 1, 2, 9])], rng.choice([0, 0.01, 0.03])) for _ in range(members)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_all_pairs(spark):
    rng = random.Random(8)
    rows = corpus(rng)
    rows += [(900, None), (901, ""), (902, " \n\t "), (None, rows[0][1]), (None, "only null ids here in this text"), (None, "only null ids here in this text")]
    rows += [(3, "another text with the id of three"), (903, "É A b"), (904, "É a B"), (905, "é a b"), (906, "a\x0bb\x0cc"), (907, "a b c"), (908, "a b c")]
    rows += [(909, "w " * 5000), (910, " ".join(f"w{i}" for i in range(30_000))), (911, " ".join(f"w{i}" for i in range(29_000)))]
    assert result(spark, rows) == expected(rows)


@pytest.mark.parametrize(("leaf", "block", "depth"), [(5, 3, 3), (12, 6, 1), (12, 4, 0)])
def test_large_regions(spark, monkeypatch, leaf, block, depth):
    rng = random.Random(leaf + depth)
    words = ["".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(120)]
    rows = [edited(rng, words, share) for share in (0.005, 0.01, 0.02, 0.04, 0.06) for _ in range(24)]
    rows += [edited(rng, words[i:] + words[:i], 0.01) for i in (30, 60, 90) for _ in range(15)]
    rows = list(enumerate(rows + [t for _, t in corpus(rng, 5, 6)]))
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "DEPTH", depth)
    assert result(spark, rows) == expected(rows)


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (1, None), (None, "")]) == [(1, 0, 1), (1, 0, 1), (None, 0, None)]


def test_whole_table_equals_all_pairs(spark):
    from rollcall.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_jaccard_join"](spark, folder).collect()), key=str)
    assert got == expected(rows)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 5))
def test_linked_sets_share_a_part(common, left, right, seed):
    both = common + left + right
    elements = mix(np.arange(1, both + 1, dtype=np.uint64) * np.uint64(seed + 3))
    x, y = np.sort(elements[: common + left]), np.sort(np.concatenate((elements[:common], elements[common + left :])))
    if 100 * common >= 90 * both:
        count = np.array([len(x), len(y)])
        keys = jaccard_join.part_keys(np.concatenate((x, y)), np.repeat([0, 1], count), count, seed)
        assert set(keys[0].tolist()) & set(keys[1].tolist())


@pytest.mark.parametrize("finish", [0, 20, 10**6])
def test_components(spark, monkeypatch, finish):
    prepare(spark)
    monkeypatch.setattr("rollcall.llm.components.FINISH", finish)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (5, 5), (300, 300)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert len({roots[i] for i in range(61)}) == len({roots[i] for i in range(100, 160)}) == len({roots[200], roots[201]}) == 1
    assert len(set(roots.values())) == 3 and 300 not in roots
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert found.filter(F.col("root").isNull()).isEmpty()
