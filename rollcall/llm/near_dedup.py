"""Near-duplicate documents by DartMinHash and banded joining.

A text is the weighted set of its five-word shingles.  Darts fall on a board of one column
per element, as high as its weight, and a time axis; darts are a function of the element
and the unit cell alone, so equal regions of two sets are hit by the same darts.  Each dart
has a hashed coordinate, and the earliest dart of a coordinate is its sample: two sets
share it with probability equal to their weighted Jaccard similarity.  About
``SLOTS * (ln SLOTS + 2)`` darts are thrown per document, whatever its length.

Equal texts are folded into one node, named by a 64-bit hash of the text, so that
everything after works on distinct texts.  Bands of the signature give candidate pairs;
each pair is verified by its exact weighted Jaccard similarity, and classes are the
connected components of the verified links.  In a bucket every member is paired with the
``PIVOTS`` smallest nodes, so a large group yields rows in proportion to its size.  Members
that are not of the class of their bucket's smallest node by then are searched exactly: two
texts reach the threshold only if they share one of their rarest shingles, early enough.

Defined results: a null text is an empty one; texts without a word are one class; texts of
fewer than five words have one shingle; the class of rows with null ids only has a null id;
equal rows share a class, and of each class one row is kept, whatever ids its rows have or
share with other classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import PrefixHash, byte_chunks, fresh, mix, pin, texts
from rollcall.llm.components import components
from rollcall.llm.line_dedup import sieved

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
BAND_ROWS = 6
SLOTS = BANDS * BAND_ROWS
SEED = 97
PIVOTS = 8
#: Time levels below 1 in powers of two: long documents look at the first ones only.
EARLY = 8
NODE = "_text_hash"


def encode(text: str | None) -> bytes:
    """Words in ASCII lower case joined by single spaces."""
    return b" ".join((text or "").encode("utf-8", "replace").lower().split())


def shingles(parts: list[bytes], hasher: PrefixHash, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a chunk of encoded texts, and the text each belongs to."""
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    text_start = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    text_end = text_start + lengths
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate(([0], gaps + 1)) if len(data) else np.zeros(1, np.int64)
    ends = np.concatenate((gaps, [len(data)])) if len(data) else np.zeros(1, np.int64)
    owner = np.searchsorted(text_start, starts, "right") - 1
    some = ends > starts
    starts, ends, owner = starts[some], ends[some], owner[some]
    first = np.searchsorted(owner, np.arange(len(parts)))
    count = np.searchsorted(owner, np.arange(len(parts)), "right") - first
    rank = np.arange(len(starts)) - first[owner]
    begins = (rank == 0) | (rank + size <= count[owner])
    last = np.minimum(np.arange(len(starts)) + size - 1, (first + count - 1)[owner])
    return hasher.ranges(hasher.prefixes(data), starts[begins], ends[last[begins]]), owner[begins]


def elements(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of weight: the n-th copy of a shingle in a text is an element of its own."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    copy = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return mix(h + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), o


_POISSON: dict[float, np.ndarray] = {}


def _poisson(uniform: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts by inversion of uniform numbers."""
    if mean not in _POISSON:
        steps = np.cumsum([np.exp(-mean) * mean**k / float(np.prod(np.arange(1, k + 1, dtype=float))) for k in range(24)])
        _POISSON[mean] = steps
    return np.searchsorted(_POISSON[mean], uniform)


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def throw(cells: np.ndarray, owner: np.ndarray, until: np.ndarray, slots: int = SLOTS) -> tuple:
    """Darts with times below ``until`` (by text): text, coordinate, time, dart id."""
    out = []
    top = float(until.max(initial=0))
    levels = [(0.0, 2.0**-EARLY), *((2.0**-k, 2.0**-k) for k in range(EARLY, 0, -1)), *((float(k), 1.0) for k in range(1, int(np.ceil(top))))]
    live, least = np.arange(len(cells)), until.min(initial=np.inf)
    for number, (start, width) in enumerate(levels):
        if start >= least:  # levels come in order, so cells only drop out
            live = live[until[owner[live]] > start]
        if not len(live):
            break
        base = mix(cells[live] ^ np.uint64(SEED * 1_000_003 + number * 7919))
        count = _poisson(_uniform(base), width)
        hit = np.repeat(np.arange(len(live)), count)
        if not len(hit):
            continue
        copy = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(base[hit] + (copy.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        time = start + width * _uniform(mix(dart ^ np.uint64(0xA5A5A5A5)))
        text = owner[live][hit]
        inside = time < until[text]
        out.append((text[inside], (dart[inside] % np.uint64(slots)).astype(np.int64), time[inside], dart[inside]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def signatures(parts: list[bytes], hasher: PrefixHash, slots: int = SLOTS) -> np.ndarray:
    """One row of samples per text; texts without a word get zeros."""
    signature = np.zeros((len(parts), slots), np.uint64)
    hashes, owner = shingles(parts, hasher)
    cells, owner = elements(hashes, owner)
    mass = np.bincount(owner, minlength=len(parts)).astype(float)
    darts = slots * (np.log(slots) + 2)
    open_texts = mass > 0
    until = np.where(open_texts, darts / np.maximum(mass, 1), 0)
    while open_texts.any():
        mine = open_texts[owner]
        text, slot, time, dart = throw(cells[mine], owner[mine], np.where(open_texts, until, 0), slots)
        late = np.argsort(time)[::-1]  # what is written last stays: the earliest dart of a slot
        found = np.zeros(len(parts) * slots, np.uint64)
        found[(text * slots + slot)[late]] = dart[late] | np.uint64(1)
        found = found.reshape(len(parts), slots)
        done = open_texts & (found != 0).all(axis=1)
        signature[done] = found[done]
        open_texts &= ~done
        until *= 2  # some coordinate was not hit: look further in time
    return signature


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = PrefixHash(SEED)
    for rows, parts in byte_chunks(frames, encode, ("doc_id", "node")):
        signature = signatures(parts, hasher).reshape(len(parts), BANDS, BAND_ROWS)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(parts), BANDS))
        for k in range(BAND_ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, k])
        out = pd.DataFrame(rows, columns=["doc_id", "node"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out.assign(keys=list(key.view(np.int64)))


def _weighted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = PrefixHash(SEED)
    for rows, parts in byte_chunks(frames, encode, ("node",)):
        cells, owner = elements(*shingles(parts, hasher))
        cells = (cells >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((cells, owner))
        cells, owner = cells[order], owner[order]
        ends = np.searchsorted(owner, np.arange(len(parts)), "right")
        starts = np.searchsorted(owner, np.arange(len(parts)))
        nodes = [r[0] for r in rows]
        yield pd.DataFrame({"node": nodes, "cells": [cells[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})


def jaccard(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two sorted arrays of unit cells."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    if not len(x) and not len(y):
        return 1.0
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(x) + len(y) - shared)


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        likeness = [jaccard(x, y) for x, y in zip(frame["x"], frame["y"], strict=True)]
        yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "likeness": likeness})


def with_node(docs: DataFrame, name: str = NODE) -> DataFrame:
    return docs.withColumn(name, F.xxhash64(F.coalesce("text", F.lit(""))))


def candidate_pairs(keyed: DataFrame) -> DataFrame:
    """Every member of a bucket with the smallest nodes of the bucket.

    The pivots of all buckets of a node meet as one set before they become rows, because
    near copies share most of their buckets.
    """
    first = Window.partitionBy("key").orderBy("node")
    pivots = keyed.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= PIVOTS)
    pivots = pivots.groupBy("key").agg(F.collect_set("node").alias("pivots"))
    met = keyed.join(pivots, "key").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
    smaller = F.filter("pivots", lambda pivot: pivot < F.col("node"))
    return met.select(F.explode(smaller).alias("a"), F.col("node").alias("b"))


def _unit_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        parts = [np.frombuffer(data, np.uint32) for data in frame["cells"]]
        sizes = np.array([len(p) for p in parts], np.int32)
        cell = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.int64)
        yield pd.DataFrame({"node": np.repeat(frame["node"].to_numpy(), sizes), "cell": cell, "n": np.repeat(sizes, sizes)})


def unsettled_pairs(cells: DataFrame, members: DataFrame, apart: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b) of different roots, one side in ``apart``; ``members``: node, root.

    The rarest cells of a text come first.  Of a pair that reaches the threshold, the first
    shared cell lies in both prefixes, and behind it enough cells are left on either side;
    so no such pair is left out.
    """
    tokens = cells.join(members.select("node"), "node", "left_semi").select("node", "cells").mapInPandas(_unit_cells, "node long, cell long, n int")
    tokens = pin(tokens, "tokens")
    ranked = tokens.join(tokens.groupBy("cell").agg(F.count("*").alias("holders")), "cell")
    place = F.row_number().over(Window.partitionBy("node").orderBy("holders", "cell"))
    ranked = ranked.withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    ahead = (F.col("n") - F.col("place") + 1).alias("ahead")  # the cell itself and those behind it
    prefixes = pin(ranked.filter("holders > 1").select("node", "cell", "n", ahead).join(members, "node"), "prefixes")
    own = prefixes.join(apart, "node", "left_semi").alias("x")
    both = own.join(prefixes.alias("y"), F.expr("x.cell = y.cell and x.root <> y.root") & (
        F.least("x.ahead", "y.ahead") >= F.ceil((F.col("x.n") + F.col("y.n")) * (threshold / (1 + threshold)) - 1e-9)
    ))
    return both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def links(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and the verified links (a, b, likeness) between nodes."""
    named = with_node(texts(docs)).withColumnRenamed(NODE, "node")
    sketches = pin(named.mapInPandas(_sketch, "doc_id long, node long, keys array<long>"), "sketches")
    folded = sketches.groupBy("node").agg(F.first("keys").alias("keys"))
    keyed = folded.select("node", F.explode("keys").alias("key"))
    shared = pin(keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "shared")
    keyed = pin(sieved(keyed, shared, "key").join(shared, "key"), "buckets")
    wanted = pin(keyed.select("node").distinct(), "wanted")
    spelled = sieved(named.select("node", "text"), wanted, "node").join(wanted, "node", "left_semi")
    cells = pin(spelled.mapInPandas(_weighted, "node long, cells binary").dropDuplicates(["node"]), "cells")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(cells.select(F.col("node").alias("a"), F.col("cells").alias("x")), "a")
        both = both.join(cells.select(F.col("node").alias("b"), F.col("cells").alias("y")), "b")
        # lengths alone bound the similarity from above
        both = both.filter(F.least(F.length("x"), F.length("y")) >= threshold * F.greatest(F.length("x"), F.length("y")))
        return both.select("a", "b", "x", "y").mapInPandas(_measure, "a long, b long, likeness double").filter(F.col("likeness") >= threshold)

    found = pin(verified(candidate_pairs(keyed.select("node", "key"))), "links")
    large = pin(keyed.filter(F.col("members") > PIVOTS + 1).select("node", "key"), "large")
    roots = components(found)
    rooted = large.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    reference = rooted.groupBy("key").agg(F.min_by("root", "node").alias("reference"))
    apart = rooted.join(reference, "key").filter("root <> reference").select("node").distinct()
    rest = unsettled_pairs(cells, rooted.select("node", "root").distinct(), apart, threshold)
    return sketches.select("doc_id", "node"), pin(found.unionByName(verified(rest)).dropDuplicates(["a", "b"]), "links")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node, root and class_id (smallest id of the class) of every row."""
    rows, found = links(docs, threshold)
    rows = rows.join(components(found), "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    smallest = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(smallest, "root").select("doc_id", "node", "root", "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, that of the smallest id, nulls last, then text hash; all columns kept."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    chosen = classes(docs, threshold).groupBy("root").agg(F.min(order).alias("one"))
    chosen = chosen.select(F.col("one.doc_id").alias("_kept_id"), F.col("one.node").alias("_kept_node"))
    node = fresh(docs, NODE)
    rows = with_node(docs, node)
    kept_id, kept_node = fresh(rows, "_kept_id"), fresh(rows, "_kept_node")
    chosen = chosen.toDF(kept_id, kept_node)
    match = rows["doc_id"].cast("long").eqNullSafe(F.col(kept_id)) & (rows[node] == F.col(kept_node))
    return rows.join(chosen, match, "left_semi").dropDuplicates(["doc_id", node]).drop(node)
