"""Hard negatives by exact inner products on tiles, multiplied by Strassen's recursion.

Vectors are scaled and floored to integers.  A stated set of anchors meets all rows on a
grid: anchors are dealt into ``ANCHORS`` rows per stripe, candidates into ``CANDIDATES`` per
column, and a cell of the grid is one task's work of bounded size, whatever the table.  A
cell goes through its tiles, multiplies each by Strassen's seven products on int64 matrices
(odd sizes are padded with zeros) and keeps heaps: of each anchor its first positives, or of
each anchor and positive the first negatives within the window that the positive's score
opens.  Heaps of cells merge by rank, before and after one shuffle.

Defined results: rows with a null label or vector, or with a null or non-finite component,
take no part; shorter vectors count as padded with zeros; null ids come last among ties and
are no anchors; repeated rows are rows of their own (an anchor's own row alone is left out
of its positives); an anchor without positives or a window without rows gives none.
Products are exact as long as they fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import pin

POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score between which a negative's score has to lie.
WINDOW = (30, 90)
SCALE = 256.0
ANCHORS = 4096
CANDIDATES = 4096
TILE = (512, 1024)
#: Matrices with a side of at most this many rows are multiplied directly.
DIRECT = 32
LOWEST = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The plain product; by way of doubles where no sum can reach 2^53, so that it is exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, direct: int = DIRECT) -> np.ndarray:
    """The product of two int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= direct:
        return _direct(a, b)
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    p1 = strassen(a11 + a22, b11 + b22, direct)
    p2 = strassen(a21 + a22, b11, direct)
    p3 = strassen(a11, b12 - b22, direct)
    p4 = strassen(a22, b21 - b11, direct)
    p5 = strassen(a11 + a12, b22, direct)
    p6 = strassen(a21 - a11, b11 + b12, direct)
    p7 = strassen(a12 - a22, b21 + b22, direct)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def first_of_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Marks the ``k`` highest allowed scores of each row, the leftmost ones among ties."""
    scores = np.where(allowed, scores, LOWEST)
    n = scores.shape[1]
    if n <= k:
        return allowed
    last = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > last
    ties = allowed & (scores == last)
    return above | (ties & (ties.cumsum(axis=1) <= k - above.sum(axis=1, keepdims=True)))


class Heap:
    """The first ``k`` (score descending, id ascending) of each key, tile after tile."""

    def __init__(self, k: int):
        self.k = k
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def push(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, key))  # ~ turns the order around without overflow
        key, score, ids = key[order], score[order], ids[order]
        kept = np.arange(len(key)) - np.searchsorted(key, key) < self.k
        self.key, self.score, self.id = key[kept], score[kept], ids[kept]


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows[name].to_numpy().astype(np.int64)


def _ids(rows: pa.Table) -> np.ndarray:
    return rows["vec_id"].fill_null(NO_ID).to_numpy().astype(np.int64)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(rows: pa.Table) -> np.ndarray:
    vectors = _whole(rows["vector"])
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


def _tiles(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple]:
    """(first anchor, candidates' order, scores) of each tile; candidates by id."""
    if not len(anchors) or not len(candidates):
        return
    a, b = _matrix(anchors), _matrix(candidates)
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    order = np.argsort(_ids(candidates), kind="stable")
    for top in range(0, len(a), TILE[0]):
        for left in range(0, len(b), TILE[1]):
            at = order[left : left + TILE[1]]
            yield top, at, strassen(a[top : top + TILE[0]], np.ascontiguousarray(b[at].T))


def _ids_out(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def _cell_positives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    own, other = _column(anchors, "row"), _column(candidates, "row")
    own_label, label, ids = _column(anchors, "label"), _column(candidates, "label"), _ids(candidates)
    heap = Heap(POSITIVES)
    for top, at, scores in _tiles(anchors, candidates):
        here = slice(top, top + len(scores))
        allowed = (own_label[here, None] == label[at]) & (own[here, None] != other[at])
        i, j = np.nonzero(first_of_rows(scores, allowed, POSITIVES))
        heap.push(own[here][i], scores[i, j], ids[at[j]])
    return pa.table({"anchor": heap.key, "positive_id": _ids_out(heap.id), "positive_score": heap.score})


def _cell_negatives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    own_label, label, ids = _column(anchors, "label"), _column(candidates, "label"), _ids(candidates)
    held = _whole(anchors["positive_scores"])
    count, flat, starts = np.diff(held.offsets.to_numpy()), held.flatten().to_numpy(), held.offsets.to_numpy()
    starts = starts - starts[0]
    heap = Heap(NEGATIVES)
    for top, at, scores in _tiles(anchors, candidates):
        here = np.arange(top, top + len(scores))
        apart = own_label[here, None] != label[at]
        for place in range(int(count.max(initial=0))):
            some = count[here] > place
            positive = flat[starts[here[some]] + place][:, None]
            mine = scores[some]
            allowed = apart[some] & (WINDOW[0] * positive <= 100 * mine) & (100 * mine <= WINDOW[1] * positive)
            i, j = np.nonzero(first_of_rows(mine, allowed, NEGATIVES))
            heap.push((here[some] * POSITIVES + place)[i], mine[i, j], ids[at[j]])
    anchor = _column(anchors, "row")[heap.key // POSITIVES]
    return pa.table({"anchor": anchor, "place": heap.key % POSITIVES + 1, "negative_id": _ids_out(heap.id), "negative_score": heap.score})


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """row (a number of its own), vec_id, label and integer vector of the rows that take part."""
    def whole(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    values = F.col("embedding").cast("array<double>")
    rows = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(values, whole))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(x * scale)).alias("vector"),
    )


def _share(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _on_grid(anchors: DataFrame, candidates: DataFrame, shape: tuple[int, int], cell, schema: str) -> DataFrame:
    """``cell`` over each meeting of a stripe of anchors with a column of candidates."""
    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(parts))

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    # anchors are candidates too: both sides come from one table, so one gets columns anew
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    left = left.withColumn("stripe", dealt(shape[0])).withColumn("cell", every(shape[1]))
    right = candidates.withColumn("cell", dealt(shape[1])).withColumn("stripe", every(shape[0]))
    return left.groupBy("stripe", "cell").cogroup(right.groupBy("stripe", "cell")).applyInArrow(cell, schema)


def _ranked(rows: DataFrame, keys: list[str], kind: str, k: int) -> DataFrame:
    """Heaps of cells merged: ``place`` from 1 within ``keys``, the first ``k`` kept."""
    order = [F.desc(f"{kind}_score"), F.asc_nulls_last(f"{kind}_id")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, for the rows ``anchors`` holds of.

    ``vectors`` has vec_id, label and embedding; ``anchors`` is a condition on vec_id.
    """
    rows = pin(quantised(vectors), "vectors")
    chosen = rows.filter(anchors & F.col("vec_id").isNotNull())
    shape = (_share(chosen.count(), ANCHORS), _share(rows.count(), CANDIDATES))
    found = _on_grid(chosen, rows, shape, _cell_positives, "anchor long, positive_id long, positive_score long")
    positives = pin(_ranked(found, ["anchor"], "positive", POSITIVES).withColumn("place", F.col("rank").cast("long")).drop("rank"), "positives")
    # at most POSITIVES entries per anchor
    scores = F.array_sort(F.collect_list(F.struct("place", "positive_score")))
    opened = positives.groupBy(F.col("anchor").alias("row")).agg(F.transform(scores, lambda x: x["positive_score"]).alias("positive_scores"))
    armed = chosen.join(opened, "row")
    found = _on_grid(armed, rows, shape, _cell_negatives, "anchor long, place long, negative_id long, negative_score long")
    negatives = _ranked(found, ["anchor", "place"], "negative", NEGATIVES)
    names = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives.join(names, "anchor"), ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Labels of every seventh id moved on by one, so that some rows are labelled wrongly."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)
