"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Documents are tokenized and cut (``pieces``).  Full pieces are sequences of their own; the
rest are dealt evenly into blocks of about ``BLOCK`` pieces.  Each block evolves on
several islands: an individual is a grouping of the block's pieces into bins; crossover
injects well-filled whole bins of one parent into another, drops the bins that hold a
piece twice and best-fits the displaced pieces.  After each epoch every island receives
the elite of its neighbour.  A block is bounded whatever the corpus size, and all state
between epochs is written to the shared folder.

Ids equal those of the ``tokenizers`` vocabulary given by ``vocabulary``; texts are encoded
from the same vocabulary as ranks (``ranks``), which is several times faster, and by
``tokenizers`` itself where a text spells out a special token.

Defined results: a null or empty text is one piece, the end id alone; null ids and repeated
rows are packed like any others; no document gives no piece.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import pin, texts

CAPACITY = 1024
END = 2
BLOCK = 16384
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 12
POPULATION = 5
#: A bin counts as well filled from this share.
WELL_FILLED = 0.995
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Longest run without white space that is left to the rank encoder.
LONG_RUN = 4000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache
def _encoder(vocabulary: str, ranks: str):
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        long_run = len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN
        if long_run or any(s in text for s in special):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than full."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, ranks: str = RANKS, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: place in its document, length and checksum of the ids."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(vocabulary, ranks)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.array([*encode(text), END], "<u4")
                rows += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts(len(ids), capacity))]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return texts(docs).mapInPandas(cut, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs: by volume, and by the pieces that cannot share one."""
    best = -(-int(lengths.sum()) // capacity) if len(lengths) else 0
    for k in np.unique(lengths[lengths <= capacity // 2])[:64]:
        alone = int((lengths > capacity - k).sum())
        halves = lengths[(lengths > capacity // 2) & (lengths <= capacity - k)]
        small = int(lengths[(lengths >= k) & (lengths <= capacity // 2)].sum())
        best = max(best, alone + len(halves) + max(0, -(-(small - (len(halves) * capacity - int(halves.sum()))) // capacity)))
    return best


def best_fit(order, lengths, bins: list[list[int]], room: list[int]) -> None:
    """Put the pieces, in this order, where the least room is left over; opens bins as needed."""
    free = sorted((r, b) for b, r in enumerate(room) if r)
    for item in order:
        size = lengths[item]
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            left, b = free.pop(at)
            bins[b].append(item)
            room[b] = left - size
        else:
            b = len(bins)
            bins.append([item])
            room.append(CAPACITY - size)
        if room[b]:
            bisect.insort(free, (room[b], b))


def fills(bins: list[list[int]], lengths) -> list[int]:
    """Ids in each bin."""
    return [sum(map(lengths.__getitem__, b)) for b in bins]


def crossover(mother: list[list[int]], father: list[list[int]], lengths, rng) -> list[list[int]]:
    """Inject well-filled bins of the father; best-fit what the overlapping bins held."""
    filled = [b for b, fill in zip(father, fills(father, lengths), strict=True) if fill >= WELL_FILLED * CAPACITY] or father
    chosen = [b for b, take in zip(filled, rng.random(len(filled)) < 0.5, strict=True) if take]
    injected = {i for b in chosen for i in b}
    bins, displaced = [list(b) for b in chosen], []
    held = fills(mother, lengths)
    worst = set(sorted(range(len(mother)), key=held.__getitem__)[: 1 + len(mother) // 50])
    room = [CAPACITY - n for n in fills(bins, lengths)]
    for k, b in enumerate(mother):
        if k in worst or not injected.isdisjoint(b):
            displaced += [i for i in b if i not in injected]
        else:
            bins.append(list(b))
            room.append(CAPACITY - held[k])
    displaced.sort(key=lambda i: -lengths[i])
    best_fit(displaced, lengths, bins, room)
    return bins


def fitness(bins: list[list[int]], lengths) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return len(bins), -sum([(n / CAPACITY) ** 2 for n in fills(bins, lengths)])


def _grouped(assignment) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for item, b in enumerate(assignment):
        bins.setdefault(b, []).append(item)
    return list(bins.values())


def evolve(lengths: list[int], elite, seed: int, generations: int = GENERATIONS) -> list[list[int]]:
    """One epoch of one island; ``elite`` is an assignment received from elsewhere or None."""
    rng = np.random.default_rng(seed)
    target = lower_bound(np.array(lengths, np.int64))
    people = []
    for k in range(POPULATION):
        noise = rng.normal(0, 4 * k, len(lengths)) if k else np.zeros(len(lengths))
        bins: list[list[int]] = []
        best_fit(np.argsort(-(np.array(lengths) + noise), kind="stable").tolist(), lengths, bins, [])
        people.append((fitness(bins, lengths), bins))
        if len(bins) <= target:
            return bins
    if elite is not None:
        bins = _grouped(elite)
        people.append((fitness(bins, lengths), bins))
    people.sort(key=lambda p: p[0])
    for _ in range(generations):
        if people[0][0][0] <= target:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        child = crossover(people[min(a, b)][1], people[max(a, b)][1], lengths, rng)
        score = fitness(child, lengths)
        if score < people[-1][0]:
            people[-1] = (score, child)
            people.sort(key=lambda p: p[0])
    return people[0][1]


_SOLUTION = "block long, island int, bins int, assignment array<int>, offsets array<int>"


def _epoch(number: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for block, island, lengths, elite in zip(frame["block"], frame["island"], frame["lengths"], frame["elite"], strict=True):
                lengths = [int(n) for n in lengths]
                bins = evolve(lengths, elite, (int(block) * ISLANDS + int(island)) * EPOCHS + number)
                assignment, offsets = [0] * len(lengths), [0] * len(lengths)
                for b, items in enumerate(bins):
                    place = 0
                    for i in items:
                        assignment[i], offsets[i] = b, place
                        place += lengths[i]
                rows.append((block, island, len(bins), assignment, offsets))
            yield pd.DataFrame(rows, columns=["block", "island", "bins", "assignment", "offsets"])

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Sequence and offset of every piece; ``cut`` is the result of ``pieces``."""
    if capacity != CAPACITY:
        raise ValueError("pieces are packed into sequences of CAPACITY ids")
    cut = pin(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    short = cut.filter(F.col("length") < capacity)
    blocks = max(1, -(-short.count() // block))
    spark = cut.sparkSession
    items = pin(
        short.groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("length", "row", *[c for c in columns if c != "length"]))).alias("items")),
        "blocks",
    )
    lengths = items.select("block", F.transform("items", lambda x: x["length"].cast("int")).alias("lengths"))
    islands = lengths.select("block", "lengths", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
    solved = None
    for number in range(EPOCHS):
        if solved is None:
            started = islands.withColumn("elite", F.lit(None).cast("array<int>"))
        else:
            moved = solved.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("assignment").alias("elite"))
            started = islands.join(moved, ["block", "island"])
        spread = started.repartition(min(blocks * ISLANDS, 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "block", "island")
        solved = pin(spread.mapInPandas(_epoch(number), _SOLUTION), f"islands{number}")
    best = solved.groupBy("block").agg(F.min_by(F.struct("assignment", "offsets"), F.struct("bins", "island")).alias("best"))
    packed = items.join(best, "block").select(
        "block", F.explode(F.arrays_zip("items", F.col("best.assignment").alias("bin"), F.col("best.offsets").alias("offset"))).alias("x")
    )
    packed = packed.select(
        *[F.col(f"x.items.{c}").alias(c) for c in columns],
        (F.col("block") * F.lit(2**32) + F.col("x.bin")).alias("sequence_id"),
        F.col("x.offset").cast("long").alias("offset"),
    )
    whole = cut.filter(F.col("length") >= capacity).select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)
