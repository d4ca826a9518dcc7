"""Removal of repeated byte strings by difference-cover suffix classes.

A byte is removed if a string of ``WINDOW`` bytes that covers it also starts anywhere else.
Two suffixes share their first ``WINDOW`` bytes if they fall into one class, so classes are
all that is needed of the suffix array's order, and suffixes are sorted by the hashes of
their beginnings, one bucket of hashes at a time.

A difference cover keeps that small.  Of every ``PERIOD`` places of a document only the
twelve of ``COVER`` are sampled; whatever two places are compared, some shift below
``PERIOD`` takes both to sampled ones.  Hence

1. blocks of ``BLOCK`` bytes at the sampled places are classed; a window can be repeated
   only if such a block in it is;
2. long ties are settled by the sample: where the ``SETTLE`` bytes from a sampled place
   recur, all windows that start in its period are repeated.  Of a class the smallest chunk
   alone still shows its windows to the others;
3. the windows that are left are classed one by one.

Hashes of 63 bits stand for the strings.  Texts are held in chunks of about ``CHUNK`` bytes;
a chunk sends a hash once, however often it holds it, so a string that a third of the
documents share reaches its bucket once per chunk.

Most blocks and open windows occur once.  They are sieved by shortened hashes first: of the
logarithm of the corpus size and ``SPARE`` bits more, so that a share of about
1 / 2 ** ``SPARE`` passes by chance at any size.  What passes is compared by whole hashes, a
block through the windows that it opens.  Sorted hashes travel as differences.  Chunks are
moved once, into a table bucketed by chunk that the later joins read in place; it is dropped,
like the other intermediate tables, when the last step is written.

Defined results: a null text is an empty one; texts under ``WINDOW`` bytes lose nothing;
repeated rows, and rows with null ids, are documents of their own, so equal long texts lose
everything; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import PrefixHash, pin, release, shuffle_width

WINDOW = 200
# A perfect difference set, every residue but 0 being one difference of two members.
PERIOD = 133
COVER = (0, 1, 3, 15, 46, 71, 75, 84, 94, 101, 112, 128)
BLOCK = WINDOW - PERIOD + 1
SETTLE = WINDOW + PERIOD - 1
CHUNK = 2_000_000
#: Bytes of text whose sampled hashes make one bucket.
BUCKET = 32_000_000
#: Bits of a shortened hash beyond the logarithm of the corpus size.
SPARE = 8
BITS = 63
SEED = 20250203

_COVERED = np.isin(np.arange(PERIOD), COVER)

_CHUNKS = "chunk long, doc_ids array<string>, lengths array<int>, data binary"
_REDUCED = f"{_CHUNKS}, places binary, done array<struct<doc_id:string,n_bytes:long,kept:string>>"
_DEALT = "bucket int, chunk long, words binary"
_HITS = "chunk long, hits binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


@contextmanager
def _small_batches(spark: SparkSession, rows: int = 4):
    """Few chunks per Arrow batch while a job is run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def _chunks(frames: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Documents joined to chunks, named by the partition and their number in it."""
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    parts: list[bytes] = []
    size = 0

    def row() -> pd.DataFrame:
        lengths = [len(p) for p in parts]
        return pd.DataFrame({"chunk": [number], "doc_ids": [list(ids)], "lengths": [lengths], "data": [_pack(b"".join(parts))]})

    for frame in frames:
        for doc_id, data in zip(frame["doc_id"], frame["data"], strict=True):
            ids.append(doc_id)
            parts.append(bytes(data))
            size += len(data)
            if size >= limit:
                yield row()
                ids, parts, size, number = [], [], 0, number + 1
    if ids:
        yield row()


def _left(lengths: np.ndarray) -> np.ndarray:
    """Bytes from each place to the end of its document."""
    ends = np.cumsum(lengths)
    return np.repeat(ends, lengths) - np.arange(int(ends[-1]) if len(ends) else 0)


def _samples(lengths: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Sampled places with a whole block behind them."""
    within = np.repeat(lengths, lengths) - left
    return np.flatnonzero(_COVERED[within % PERIOD] & (left >= BLOCK))


def _shrink(words: np.ndarray) -> bytes:
    """Ascending words as differences, one plane per byte, compressed."""
    steps = np.diff(words, prepend=np.zeros(1, np.uint64))
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _expand(data: bytes) -> np.ndarray:
    planes = _unpack(data).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class _Hashes:
    """Hashes of ``bits`` bits, the highest of 64, of strings of one chunk."""

    def __init__(self, hasher: PrefixHash, data: np.ndarray):
        self.hasher, self.prefixes = hasher, hasher.prefixes(data)

    def __call__(self, places: np.ndarray, size: int, bits: int = BITS) -> np.ndarray:
        return self.hasher.ranges(self.prefixes, places, places + size) >> np.uint64(64 - bits)


def _deal(chunk: int, hashes: np.ndarray, buckets: int, bits: int = BITS) -> pd.DataFrame:
    """One row per bucket, a range of hashes: distinct ones, marked if the chunk holds them more than once."""
    values, times = np.unique(hashes, return_counts=True)
    words = (values << np.uint64(1)) | (times > 1).astype(np.uint64)
    high = values >> np.uint64(bits - 32) if bits > 32 else values << np.uint64(32 - bits)
    bucket = ((high * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    names, starts = np.unique(bucket, return_index=True)
    pieces = np.split(words, starts[1:]) if len(names) else []
    return pd.DataFrame({"bucket": names.astype(np.int32), "chunk": np.full(len(names), chunk), "words": [_shrink(p) for p in pieces]})


def _class(frame: pd.DataFrame) -> pd.DataFrame:
    """Hashes of a bucket that occur more than once, back to their chunks; marked in the first one."""
    frame = frame.sort_values("chunk", kind="stable")
    parts = [_expand(w) for w in frame["words"]]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    words = np.concatenate(parts)
    key = words >> np.uint64(1)
    order = np.argsort(key, kind="stable")  # within a key by chunk
    key, owner, several = key[order], owner[order], (words[order] & np.uint64(1)).astype(bool)
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    run = np.cumsum(first) - 1
    recurs = (np.bincount(run) > 1) | (np.bincount(run, weights=several) > 0)
    keep = recurs[run]
    out = (key[keep] << np.uint64(1)) | first[keep].astype(np.uint64)
    owner = owner[keep]
    order = np.argsort(owner, kind="stable")
    names, starts = np.unique(owner[order], return_index=True)
    pieces = np.split(out[order], starts[1:]) if len(names) else []
    return pd.DataFrame({"chunk": frame["chunk"].to_numpy()[names], "hits": [_shrink(p) for p in pieces]})


def _hits(parts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and whether this chunk is the first to hold them."""
    if parts is None or not len(parts):
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    words = np.sort(np.concatenate([_expand(p) for p in parts]))
    return words >> np.uint64(1), (words & np.uint64(1)).astype(bool)


def _look_up(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are known, and where."""
    if not len(known):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes, at


def _spread(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Places within ``size`` behind any of ``starts``."""
    edge = np.zeros(n + size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:n]) > 0


def _windows(row, hasher: PrefixHash) -> tuple:
    """State after the long ties: hashes, bytes, open candidates to show, and settled starts."""
    data, lengths = _unpack(row.data), np.array(row.lengths, np.int64)
    left, hashed = _left(lengths), _Hashes(hasher, data)
    places = np.frombuffer(row.places, np.int32).astype(np.int64)
    n = len(data)
    # a window is a candidate if a recurring block lies in it
    behind = np.concatenate(([0], np.cumsum(np.bincount(places, minlength=n)))) if n else np.zeros(1, np.int64)
    at = np.arange(n)
    candidate = (left >= WINDOW) & (behind[np.minimum(at + PERIOD, n)] > behind[at])
    long = places[left[places] >= SETTLE]
    known, first = _hits(row.settled)
    found, where = _look_up(hashed(long, SETTLE), known)
    settled = _spread(long[found], PERIOD, n)
    quiet = _spread(long[found][~first[where[found]]], PERIOD, n) if len(first) else np.zeros(n, bool)
    return data, lengths, left, hashed, candidate, settled, quiet


def _per_chunk(body: Callable) -> Callable:
    """``body(row, hasher)`` for every row of the frames."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = PrefixHash(SEED)
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield body(row, hasher)

    return run


def _blocks(buckets: int, bits: int) -> Callable:
    def body(row, hasher):
        lengths = np.array(row.lengths, np.int64)
        hashed = _Hashes(hasher, _unpack(row.data))
        return _deal(row.chunk, hashed(_samples(lengths, _left(lengths)), BLOCK, bits), buckets, bits)

    return _per_chunk(body)


def _reduce(bits: int) -> Callable:
    return _per_chunk(lambda row, hasher: _reduced(row, hasher, bits))


def _reduced(row, hasher: PrefixHash, bits: int) -> pd.DataFrame:
    """The documents of a chunk that hold a recurring block; the others are done."""
    data, lengths = _unpack(row.data), np.array(row.lengths, np.int64)
    places = _samples(lengths, _left(lengths))
    places = places[_look_up(_Hashes(hasher, data)(places, BLOCK, bits), _hits(row.hits)[0])[0]]
    starts = np.cumsum(lengths) - lengths
    owner = np.searchsorted(starts, places, "right") - 1
    # of documents that start at one place all but the last are empty
    stays = np.bincount(owner, minlength=len(lengths)) > 0
    raw = data.tobytes()
    done = [
        {"doc_id": row.doc_ids[d], "n_bytes": int(lengths[d]), "kept": hashlib.sha256(raw[starts[d] : starts[d] + lengths[d]]).hexdigest()}
        for d in np.flatnonzero(~stays)
    ]
    kept = np.flatnonzero(stays)
    new_start = np.zeros(len(lengths), np.int64)
    new_start[kept] = np.cumsum(lengths[kept]) - lengths[kept]
    moved = (places - starts[owner] + new_start[owner]).astype(np.int32)
    return pd.DataFrame({
        "chunk": [row.chunk],
        "doc_ids": [[row.doc_ids[d] for d in kept]],
        "lengths": [lengths[kept].tolist()],
        "data": [_pack(b"".join(raw[starts[d] : starts[d] + lengths[d]] for d in kept))],
        "places": [moved.tobytes()],
        "done": [done],
    })


def _ties(buckets: int) -> Callable:
    def body(row, hasher):
        lengths, places = np.array(row.lengths, np.int64), np.frombuffer(row.places, np.int32).astype(np.int64)
        places = places[_left(lengths)[places] >= SETTLE]
        return _deal(row.chunk, _Hashes(hasher, _unpack(row.data))(places, SETTLE), buckets)

    return _per_chunk(body)


def _rest(buckets: int, bits: int) -> Callable:
    """Shortened hashes of the windows that are left."""

    def body(row, hasher):
        _, _, _, hashed, candidate, _, quiet = _windows(row, hasher)
        return _deal(row.chunk, hashed(np.flatnonzero(candidate & ~quiet), WINDOW, bits), buckets, bits)

    return _per_chunk(body)


def _shown(row, hashed: _Hashes, candidate: np.ndarray, quiet: np.ndarray, bits: int) -> np.ndarray:
    """Windows that are left and whose shortened hash recurs."""
    places = np.flatnonzero(candidate & ~quiet)
    return places[_look_up(hashed(places, WINDOW, bits), _hits(row.likely)[0])[0]]


def _whole(buckets: int, bits: int) -> Callable:
    def body(row, hasher):
        _, _, _, hashed, candidate, _, quiet = _windows(row, hasher)
        return _deal(row.chunk, hashed(_shown(row, hashed, candidate, quiet, bits), WINDOW), buckets)

    return _per_chunk(body)


def _cover(bits: int) -> Callable:
    return _per_chunk(lambda row, hasher: _covered(row, hasher, bits))


def _covered(row, hasher: PrefixHash, bits: int) -> pd.DataFrame:
    """Remove what repeated windows cover."""
    data, lengths, left, hashed, candidate, settled, quiet = _windows(row, hasher)
    shown = _shown(row, hashed, candidate, quiet, bits)
    found, _ = _look_up(hashed(shown, WINDOW), _hits(row.found)[0])
    settled[shown[found]] = True
    covered = _spread(np.flatnonzero(settled), WINDOW, len(data))
    begins = covered.copy()
    begins[1:] &= ~covered[:-1] | (left[:-1] == 1)
    out, start = [], 0
    for doc_id, n in zip(row.doc_ids, lengths.tolist(), strict=True):
        gone = covered[start : start + n]
        kept = hashlib.sha256(data[start : start + n][~gone].tobytes()).hexdigest()
        out.append((doc_id, n, int(gone.sum()), int(begins[start : start + n].sum()), kept))
        start += n
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _by_chunk(hits: DataFrame, name: str) -> DataFrame:
    return hits.groupBy("chunk").agg(F.collect_list("hits").alias(name))


def _bucketed(df: DataFrame, buckets: int) -> str:
    """Write ``df`` as a table of the current database, bucketed by chunk; returns its name."""
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "chunk").saveAsTable(name)
    return name


def removals(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    raw = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    chunks = pin(raw.mapInPandas(lambda frames: _chunks(frames, chunk), _CHUNKS), "chunks")
    size = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-size // BUCKET))
    bits = min(BITS, int(size).bit_length() + SPARE)

    def recurring(source: DataFrame, emit: Callable, label: str) -> DataFrame:
        dealt = source.mapInPandas(emit, _DEALT)
        return pin(dealt.groupBy("bucket").applyInPandas(_class, _HITS), label)

    with _small_batches(spark):
        blocks = recurring(chunks, _blocks(buckets, bits), "blocks")
        some = chunks.join(_by_chunk(blocks, "hits"), "chunk", "left")
        moved = _bucketed(some.mapInPandas(_reduce(bits), _REDUCED), buckets)
        release(chunks)
        release(blocks)
        open_chunks = spark.table(moved).drop("done")
        ties = recurring(open_chunks, _ties(buckets), "ties")
        tied = open_chunks.join(_by_chunk(ties, "settled"), "chunk", "left")
        likely = recurring(tied, _rest(buckets, bits), "likely")
        sieved = tied.join(_by_chunk(likely, "likely"), "chunk", "left")
        found = recurring(sieved, _whole(buckets, bits), "windows")
        text_result = RESULT.replace("doc_id long", "doc_id string")
        last = sieved.join(_by_chunk(found, "found"), "chunk", "left")
        cut = last.mapInPandas(_cover(bits), text_result)
        done = spark.table(moved).select(F.explode("done").alias("d")).select(
            "d.doc_id", "d.n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("d.kept").alias("kept_sha256")
        )
        result = pin(cut.unionByName(done).withColumn("doc_id", F.col("doc_id").cast("long")), "removals")
    for table in (ties, likely, found):
        release(table)
    spark.sql(f"DROP TABLE {moved}")
    return result
