"""Connected components of links, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import pin

#: Links that one task finishes; more are contracted first.
FINISH = 2**16


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            parent[root(a)] = root(b)
    yield pd.DataFrame({"node": list(parent), "to": [root(x) for x in parent]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """node, root of every linked node; ``links`` has the columns a and b (long).

    In each round a node moves to the node of its closed neighbourhood that comes first in an
    order drawn anew for the round, and links are renamed to where their ends have moved;
    links within a node go.  A random order leaves about half of the nodes at least, so rows
    over all rounds are in proportion to the links.  The last ``FINISH`` links, a megabyte,
    are one task's work.  Roots are the moves composed.
    """
    spark = links.sparkSession
    left = pin(links.select("a", "b").filter("a <> b").distinct(), "links")
    moves: list[DataFrame] = []
    while (rest := left.count()) > FINISH:
        def ranked(node: str, salt: int = len(moves)) -> Column:
            return F.struct(F.xxhash64(F.lit(salt), F.col(node)).alias("order"), F.col(node).alias("to"))

        both = left.union(left.select("b", "a")).toDF("node", "other")
        first = both.groupBy("node").agg(F.min(ranked("other")).alias("first"))
        moves.append(pin(first.select("node", F.least("first", ranked("node"))["to"].alias("to")), "moves"))
        for end in ("a", "b"):
            left = left.join(moves[-1].toDF(end, "to"), end).drop(end).withColumnRenamed("to", end)
        left = pin(left.select("a", "b").filter("a <> b").distinct(), "links")
    if rest:
        moves.append(pin(left.coalesce(1).mapInPandas(_finish, "node long, to long"), "moves"))
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    roots = moves[-1].toDF("node", "root")
    for move in reversed(moves[:-1]):
        roots = move.join(roots.toDF("to", "root"), "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return roots
