"""Exact join of documents by the Jaccard similarity of their shingles, in metric regions.

The Jaccard distance is a metric.  Documents lie in a sparse space, at distances near 1 from
almost every other one, where no pivot divides them; so the first regions are families:
documents that agree on at least one part of their sets.  Sizes are split into levels; at a
level two sets that reach the threshold differ in at most D shingles, so of D + 1 parts, to
which shingles are dealt by hash, one at least is equal in both.  A document deals its set
at its own level and, where a smaller one can reach it, at the level below.  Documents with
an equal part are tied, and families are the components of the ties: no linked pair lies in
two of them.

A family of at most ``LEAF`` texts is joined in one task.  A larger one is divided first by
parts dealt under another hash, which takes chance ties apart, and then by Voronoi regions:
pivots are drawn, each text belongs to its nearest pivot and, by the triangle inequality,
is also copied to every region whose pivot is within twice the largest distance of a link
behind the nearest.  Two linked texts meet in the region of either.  Regions are divided
again as long as that lowers the number of pairs.  Regions whose texts are all linked to
their pivot are done.  What is left is joined in blocks of bounded size, each block with
each, but for blocks whose texts are all of the region's largest component by then.

Classes are the components of all links.  Shingles are compared by 64-bit hashes; texts are
told apart by 128 bits.

Defined results: a null text is an empty one; texts without a word are linked with nothing,
equal ones neither; a text with fewer words than a shingle is one shingle; equal texts are
linked; rows without an id take the smallest id of their class, null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import PrefixHash, byte_chunks, mix, pin, texts
from rollcall.llm.components import components
from rollcall.llm.near_dedup import encode, shingles

SHINGLE = 3
#: A link: LINK[0] * intersection >= LINK[1] * union.
LINK = (100, 90)
SEED = 1203
#: Smallest ratio between the bounds of the levels of sizes.
RATIO = 1.25
#: Texts of a region that are joined in one task.
LEAF = 1024
#: Texts of a block, where a region is joined in blocks.
BLOCK = 512
PIVOTS = 8
#: Divisions by pivots, one inside the other.
DEPTH = 3
#: Rows of 64 bits of a bitmap, the most that is broadcast.
SIEVE = 2**18


def levels(top: int = 2**31) -> tuple[np.ndarray, np.ndarray]:
    """Smallest size of each level, and the parts that a set is dealt to at it."""
    bounds, parts = [1], []
    while bounds[-1] <= top:
        start = bounds[-1]
        bounds.append(max(start + 1, int(start * RATIO), (start - 1) * LINK[0] // LINK[1] + 1))
        small = bounds[-1] - 1
        large = small * LINK[0] // LINK[1]
        parts.append((small + large) * (LINK[0] - LINK[1]) // (LINK[0] + LINK[1]) + 1)
    return np.array(bounds[:-1], np.int64), np.array(parts, np.int64)


def distinct_shingles(parts: list[bytes], hasher: PrefixHash) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and the text they are of."""
    hashes, owner = shingles(parts, hasher, SHINGLE)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def part_keys(hashes: np.ndarray, owner: np.ndarray, count: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Keys of all parts of each set: equal where level, part and the shingles in it are."""
    bounds, widths = levels()
    own = np.searchsorted(bounds, count, "right") - 1
    below = np.where((own > 0) & (LINK[0] * (bounds[np.maximum(own, 1)] - 1) >= LINK[1] * count), own - 1, -1)
    salted = mix(hashes + mix(np.array([seed + 1], np.uint64)))
    value = mix(salted ^ np.uint64(0x5851F42D4C957F2D))
    keys = []
    for level in (own, below):
        width = np.where((level >= 0) & (count > 0), widths[np.maximum(level, 0)], 0)
        start = np.concatenate(([0], np.cumsum(width)))
        used = width[owner] > 0
        mine = owner[used]
        place = start[mine] + (salted[used] % width[mine].astype(np.uint64)).astype(np.int64)
        low, high = value[used] & np.uint64(0xFFFFFFFF), value[used] >> np.uint64(32)
        total = np.bincount(place, low.astype(np.float64), start[-1]).astype(np.uint64)
        total += np.bincount(place, high.astype(np.float64), start[-1]).astype(np.uint64) << np.uint64(32)
        text = np.repeat(np.arange(len(count)), width)
        name = (level[text].astype(np.uint64) << np.uint64(40)) + (np.arange(start[-1]) - start[text]).astype(np.uint64)
        keys.append((mix(total + mix(name)), start))
    return [np.concatenate([k[s[i] : s[i + 1]] for k, s in keys]).view(np.int64) for i in range(len(count))]


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = PrefixHash(SEED)
    dealt: set = set()  # copies need to be dealt once
    for rows, parts in byte_chunks(frames, encode, ("doc_id", "k1", "k2")):
        hashes, owner = distinct_shingles(parts, hasher)
        count = np.bincount(owner, minlength=len(parts))
        keys: list = part_keys(hashes, owner, count)
        for i, (_, k1, k2) in enumerate(rows):
            if (k1, k2) in dealt:
                keys[i] = None
            dealt.add((k1, k2))
        out = pd.DataFrame(rows, columns=["doc_id", "k1", "k2"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out.assign(n=count, keys=keys)


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = PrefixHash(SEED)
    done: set = set()
    for rows, parts in byte_chunks(frames, encode, ("node", "cell")):
        hashes, owner = distinct_shingles(parts, hasher)
        ends = np.cumsum(np.bincount(owner, minlength=len(parts)))
        data = [x.tobytes() for x in np.split(hashes, ends[:-1])]
        new = [node not in done and not done.add(node) for node, _ in rows]
        yield pd.DataFrame(rows, columns=["node", "cell"]).assign(shingles=data)[new]


def _resown(frames: Iterator[pd.DataFrame], seed: int = 1) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        count = np.array([len(x) for x in sets], np.int64)
        keys = part_keys(np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), count), count, seed)
        yield pd.DataFrame({"node": frame["node"], "cell": frame["cell"], "keys": keys})


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def _nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regions of each text: (node, cell, region, linked pivot or null)."""
    reach = 2 * (LINK[0] - LINK[1]) / LINK[0] + 1e-9
    for frame in frames:
        rows = []
        for node, cell, data, pivots in zip(frame["node"], frame["cell"], frame["shingles"], frame["pivots"], strict=True):
            own = np.frombuffer(data, np.uint64)
            found = []
            for region, pivot in enumerate(pivots):
                other = np.frombuffer(pivot["shingles"], np.uint64)
                both = overlap(own, other)
                union = len(own) + len(other) - both
                found.append((1 - both / union, region, pivot["node"], LINK[0] * both >= LINK[1] * union))
            least = min(found)[0]
            rows += [(node, cell, region, pivot if linked else None) for far, region, pivot, linked in found if far <= least + reach]
        out = pd.DataFrame(rows, columns=["node", "cell", "region", "pivot"])
        out["pivot"] = out["pivot"].astype("Int64")
        yield out


def join_sets(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between sets, as many as keep linked ones together."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    _, element = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    marked = np.zeros(int(element.max(initial=-1)) + 1, bool)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(order) - 1):
        last = int(np.searchsorted(sizes, sizes[i] * LINK[0] // LINK[1], "right"))  # larger ones are too large
        if last <= i + 1:
            continue
        own = element[starts[i] : starts[i + 1]]
        marked[own] = True
        hits = marked[element[starts[i + 1] : starts[last]]]
        both = np.add.reduceat(hits, starts[i + 1 : last] - starts[i + 1], dtype=np.int64)
        marked[own] = False
        for j in np.flatnonzero(LINK[0] * both >= LINK[1] * (sizes[i] + sizes[i + 1 : last] - both)) + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                parent[a] = b
                links.append((order[i], order[int(j)]))
    return links


def _join_cell(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("node")
    nodes = frame["node"].to_numpy()
    links = join_sets([np.frombuffer(x, np.uint64) for x in frame["shingles"]])
    return pd.DataFrame({"a": nodes[[i for i, _ in links]], "b": nodes[[j for _, j in links]]}, dtype="int64")


def sieved(rows: DataFrame, by: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``by`` may be among the wanted: a broadcast bitmap of ``SIEVE`` * 64 bits.

    It only saves shuffling what a join would drop; where it is full it lets all pass.
    """
    def slot(c: Column) -> Column:
        return F.pmod(c, F.lit(SIEVE))

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(F.xxhash64(c), 32).bitwiseAND(63)).cast("int"))

    marks = wanted.groupBy(slot(F.col(by)).alias("_slot")).agg(F.bit_or(bit(F.col(by))).alias("_marks"))
    passed = rows.join(F.broadcast(marks), slot(rows[by]) == F.col("_slot"))
    return passed.filter(F.col("_marks").bitwiseAND(bit(F.col(by))) != 0).select(*rows.columns)


def families(keyed: DataFrame) -> DataFrame:
    """node, root of the nodes tied by equal keys; ``keyed``: node, key."""
    shared = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    shared = pin(shared.select("key", "first"), "shared")
    ties = sieved(keyed, "key", shared).join(shared, "key").filter("first < node")
    return components(ties.select(F.col("first").alias("a"), F.col("node").alias("b")))


class Regions:
    """Divides regions until they can be joined.  ``sets``: node, shingles, one row a node."""

    def __init__(self, sets: DataFrame):
        self.sets = sets
        self.links: list[DataFrame] = []

    def small(self, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Cells of up to ``LEAF`` texts are set down for joining; the larger ones are returned."""
        sizes = cells.groupBy("cell").agg(F.count("*").alias("size"))
        sizes = pin(sizes.filter("size > 1"), "sizes")
        fit = cells.join(sizes.filter(F.col("size") <= LEAF).select("cell"), "cell")
        self.join(fit)
        large = sizes.filter(F.col("size") > LEAF)
        return pin(cells.join(large, "cell"), "cells"), large

    def join(self, cells: DataFrame) -> None:
        rows = cells.select("node", "cell").join(self.sets, "node").select("cell", "node", "shingles")
        self.links.append(pin(rows.groupBy("cell").applyInPandas(_join_cell, "a long, b long"), "links"))

    def resow(self, cells: DataFrame) -> DataFrame:
        rows = cells.select("node", "cell").join(self.sets, "node").select("node", "cell", "shingles")
        keyed = rows.mapInPandas(_resown, "node long, cell long, keys array<long>").select("node", "cell", F.explode("keys").alias("key"))
        tied = families(pin(keyed.select("node", F.xxhash64("cell", "key").alias("key")), "keyed"))
        return tied.select("node", F.col("root").alias("cell"))

    def divide(self, cells: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
        """(cells divided by pivots, cells that are not worth dividing), with column size."""
        drawn = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(depth), "node"), "node"))
        pivots = cells.withColumn("place", drawn).filter(F.col("place") <= PIVOTS).select("cell", "node")
        # PIVOTS entries per cell
        pivots = pin(pivots.join(self.sets, "node").groupBy("cell").agg(F.collect_list(F.struct("node", "shingles")).alias("pivots")), "pivots")
        rows = cells.select("node", "cell").join(self.sets, "node").join(pivots, "cell")
        placed = rows.select("node", "cell", "shingles", "pivots").mapInPandas(_nearest, "node long, cell long, region int, pivot long")
        placed = pin(placed, "placed")
        self.links.append(placed.filter("pivot <> node").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        sizes = placed.groupBy("cell", "region").agg(F.count("*").alias("size"), F.count("pivot").alias("settled"))
        sizes = pin(sizes.withColumn("pairs", F.when(F.col("size") > F.col("settled"), F.col("size").cast("double") ** 2).otherwise(0.0)), "regions")
        before = cells.select("cell", F.col("size").alias("whole")).distinct()
        pays = sizes.groupBy("cell").agg(F.sum("pairs").alias("pairs")).join(before, "cell").filter(F.col("pairs") < 0.7 * F.col("whole").cast("double") ** 2)
        open_regions = sizes.filter("pairs > 0").select("cell", "region").join(pays.select("cell"), "cell")
        divided = placed.join(open_regions, ["cell", "region"])
        divided = divided.select("node", F.xxhash64(F.lit(depth), "cell", "region").alias("cell"))
        return pin(divided, "cells"), pin(cells.join(pays.select("cell"), "cell", "left_anti"), "cells")

    def blocks(self, cells: DataFrame) -> None:
        """Each block of a cell with each, unless both are of the cell's largest component."""
        known = self.classes()
        rows = pin(cells.select("node", "cell").join(known, "node", "left").select("node", "cell", F.coalesce("root", "node").alias("root")), "rooted")
        largest = rows.groupBy("cell", "root").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("inside"))
        rows = rows.join(largest, "cell")
        inside = F.col("root") == F.col("main")
        outer = F.ceil((F.col("size") - F.col("inside")) / BLOCK).cast("int")
        inner = F.ceil(F.col("inside") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64(F.lit("block"), "node"), F.when(inside, inner).otherwise(outer)).cast("int")
        rows = rows.select("node", "cell", inside.alias("inside"), outer.alias("outer"), inner.alias("inner"), block.alias("block"))

        def upto(n: str) -> Column:  # 0 .. n - 1
            return F.filter(F.sequence(F.lit(0), F.greatest(F.col(n) - 1, F.lit(0))), lambda i: i < F.col(n))

        def meeting(i: Column, j: Column, across: bool) -> Column:
            return F.struct(i.alias("i"), j.alias("j"), F.lit(across).alias("across"))

        own = F.transform(upto("outer"), lambda i: meeting(F.least(i, "block"), F.greatest(i, "block"), False))
        across = F.transform(upto("inner"), lambda j: meeting(F.col("block"), j, True))
        visited = F.transform(upto("outer"), lambda i: meeting(i, F.col("block"), True))
        meetings = F.when(F.col("inside"), visited).otherwise(F.concat(own, across))
        met = rows.select("node", "cell", F.explode(meetings).alias("met"))
        self.join(met.select("node", F.xxhash64(F.lit("blocks"), "cell", "met").alias("cell")))

    def classes(self) -> DataFrame:
        found = self.links[0].select("a", "b")
        for more in self.links[1:]:
            found = found.union(more.select("a", "b"))
        return pin(components(found), "classes")

    def run(self, cells: DataFrame) -> DataFrame:
        """node, root after all regions of ``cells`` (node, cell) are joined."""
        cells, large = self.small(cells)
        if not large.isEmpty():
            cells, large = self.small(self.resow(cells))
        for depth in range(DEPTH):
            if large.isEmpty():
                break
            divided, rest = self.divide(cells, depth)
            if not rest.isEmpty():
                self.blocks(rest)
            cells, large = self.small(divided)
        if not large.isEmpty():
            self.blocks(cells)
        return self.classes()


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, root (of the class) and component_id (its smallest id) of every row."""
    named = texts(docs).select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("2"), "text").alias("k2"), "text")
    sketches = pin(named.mapInPandas(_sketch, "doc_id long, k1 long, k2 long, n long, keys array<long>").withColumn("uid", F.monotonically_increasing_id()), "sketches")
    tied = pin(families(sketches.select(F.col("uid").alias("node"), F.explode("keys").alias("key"))), "families")
    # one node per text: its smallest number; the copies of a text are of one family
    names = pin(sketches.filter("n > 0").groupBy("k1", "k2").agg(F.min("uid").alias("node")), "texts")
    family = sketches.join(tied.withColumnRenamed("node", "uid"), "uid").groupBy("k1", "k2").agg(F.min("root").alias("cell"))
    family = pin(names.join(family, ["k1", "k2"]), "members")
    several = family.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    members = pin(family.join(several, "cell").select("k1", "k2", "node", "cell"), "members")
    spelled = sieved(named.drop("doc_id"), "k1", members).join(members, ["k1", "k2"])
    sets = pin(spelled.select("node", "cell", "text").mapInPandas(_sets, "node long, cell long, shingles binary").dropDuplicates(["node"]), "sets")
    roots = Regions(sets.select("node", "shingles")).run(sets.select("node", "cell"))
    rooted = names.join(roots, "node", "left").select("k1", "k2", F.coalesce("root", "node").alias("root"))
    rows = sketches.select("doc_id", "n", "k1", "k2").join(rooted, ["k1", "k2"], "left")
    smallest = rows.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("smallest"))
    rows = rows.join(smallest, "root", "left")
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "root", own.alias("component_id"))
