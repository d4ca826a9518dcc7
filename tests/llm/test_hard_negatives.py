"""Hard negatives against a plain version; Strassen's products against numpy's."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import hard_negatives
from rollcall.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, row long, cell int, rank int, anchor long, place string"


def expected(rows, every=100):
    """rows: (vec_id, embedding, label)."""
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is not None and vec_id % 7 == 0 and label is not None:
            label = (label + 1) % 10
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    last = lambda i: math.inf if i is None else i
    out = []
    for a, (anchor_id, label, vector) in enumerate(kept):
        if anchor_id is None or anchor_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v, strict=False)), last(i), i, c, b) for b, (i, c, v) in enumerate(kept)]
        scored.sort(key=lambda s: s[:2])
        for positive in [s for s in scored if s[3] == label and s[4] != a][:5]:
            p = -positive[0]
            window = [s for s in scored if s[3] != label and 30 * p <= -100 * s[0] <= 90 * p][:10]
            out += [(anchor_id, positive[2], rank, s[2], p, -s[0]) for rank, s in enumerate(window, 1)]
    return sorted(out, key=str)


def result(spark, rows):
    prepare(spark)
    table = spark.createDataFrame([(i, v, c, 1, 2, 3, 4, "x") for i, v, c in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(hard_negatives.relabelled(table), F.col("vec_id") % 100 == 0)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_plain_version(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-0.2, 1) for _ in range(9)], rng.randrange(10)) for i in range(900)]
    assert result(spark, rows) == expected(rows)


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(9)
    nan, inf = float("nan"), float("inf")
    hot = [0.5, 0.5, 0.25]
    rows = [(i, hot, i % 2) for i in range(1, 500)]  # one vector, two labels: ties throughout
    rows += [(i, [rng.random() for _ in range(3)], rng.randrange(3)) for i in range(500, 800)]
    rows += [(600, [0.5, 0.4, 0.1], 2)] * 3 + [(None, [0.6, 0.2, 0.1], 1)] * 2 + [(None, None, 1), (None, hot, None)]
    rows += [(1000, None, 1), (1100, [0.1, None, 0.3], 1), (1200, [0.1, nan, 0.3], 1), (1300, [0.1, inf, 0.3], 1), (1400, hot, None)]
    rows += [(1500, [], 1), (1600, [1.0], 1), (1700, [0.0, 0.0, 0.0], 1), (-200, [0.9, -0.9, 0.5], 4), (1800, [1.0, 0.2, 0.2], 9)]
    assert result(spark, rows) == expected(rows)


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert result(spark, [(100, [0.5], 1), (2, [0.5], 2)]) == []


def test_many_cells_and_tiles(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [round(rng.uniform(0, 1), 1) for _ in range(5)], rng.randrange(10)) for i in range(3000)]
    monkeypatch.setattr(hard_negatives, "ANCHORS", 10)
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 700)
    assert result(spark, rows) == expected(rows)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_whole_table_equals_plain_version(spark, name):
    from rollcall.llm.queries import QUERIES

    folder = f"/root/testdata/{name}"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_hard_negatives"](spark, folder).collect()), key=str)
    assert got == expected(rows)
    assert got


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(1, 70), st.integers(0, 70), st.integers(0, 2**32), st.sampled_from([100, 2**40]))
def test_strassen_is_exact(m, k, n, seed, top):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-top, top, (m, k)), rng.integers(-min(top, 2**18), min(top, 2**18), (k, n))
    assert (hard_negatives.strassen(a, b, direct=4) == a @ b).all()
