"""Search of large buckets and the sieve of lines against brute force."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from rollcall.llm import line_dedup, near_dedup


def test_unsettled_pairs_lose_none(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**32, 60, dtype=np.uint32)
    sets = {}
    for node in range(40):
        cells = base[: 60 - node % 3].copy()
        at = rng.choice(len(cells), node % 9, replace=False)
        cells[at] = rng.integers(0, 2**32, len(at), dtype=np.uint32)
        sets[node] = np.sort(cells).tobytes()
    sets[40] = b""
    root = {node: node % 4 for node in sets}
    apart = {node for node in sets if node % 4}
    cells = spark.createDataFrame([(n, bytearray(c)) for n, c in sets.items()], "node long, cells binary")
    members = spark.createDataFrame(list(root.items()), "node long, root long")
    alone = spark.createDataFrame([(n,) for n in apart], "node long")
    got = {tuple(r) for r in near_dedup.unsettled_pairs(cells, members, alone, 0.8).collect()}
    wanted = {
        (a, b) for a, b in combinations(range(40), 2)
        if root[a] != root[b] and {a, b} & apart and near_dedup.jaccard(sets[a], sets[b]) >= 0.8
    }
    assert wanted and wanted <= got
    assert all(a < b and root[a] != root[b] for a, b in got)
    assert near_dedup.unsettled_pairs(cells, members, alone.limit(0), 0.8).isEmpty()


def test_sieve_keeps_every_wanted_line(spark):
    lines = spark.range(5000).select(F.xxhash64("id").alias("hash"), F.col("id").cast("string").alias("line"))
    wanted = lines.filter("cast(line as int) % 50 = 0").select("hash")
    passed = line_dedup.sieved(lines, wanted)
    assert passed.columns == lines.columns
    assert passed.join(wanted, "hash", "left_semi").count() == 100
    assert passed.count() < 200
    assert line_dedup.sieved(lines, wanted.limit(0)).isEmpty()
