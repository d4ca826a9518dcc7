"""Fill-in-middle transformation with a learned rank index for the cuts.

A cut is given in code points and made in bytes.  The boundaries between code points of the
UTF-8 texts of a batch are a monotone sequence of byte offsets; a piecewise-linear model of
it is fitted with a bounded error: a segment starts at a boundary and is extended for as
long as one line through its start stays within ``BOUND`` bytes of every further boundary
(the shrinking cone of possible slopes).  The integer differences between the boundaries and
the model are stored, one byte each.  The offset of a cut is the prediction of its rank plus
the stored difference, so it is exact whatever the model.  Plain ASCII is one segment of
slope 1, other scripts a segment per change of slope.

The bytes are cut by Spark itself; only ranks and offsets pass through Python.

Defined results: a null text is an empty one, with form ``plain``; a null id is hashed as
the empty string; equal rows have equal outputs; columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import texts

# The marks of the forms and the shares of plain and suffix-first outputs.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20
#: Largest distance in bytes between a boundary and the line of its segment.
BOUND = 100
#: Boundaries looked at first when a segment is fitted; doubled while the segment holds.
WINDOW = 4096
#: Bytes of text per index, at least one text.
CHUNK = 4_000_000


@dataclass
class RankIndex:
    """Segments (first rank, its offset, slope) and stored differences of all boundaries."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, bound: int = BOUND, window: int = WINDOW) -> RankIndex:
        first, slope = [], []
        at, n = 0, len(offsets)
        while at < n:
            end, middle = _reach(offsets, at, bound, window)
            first.append(at)
            slope.append(middle)
            at = end
        first = np.array(first, np.int64)
        index = cls(first, offsets[first], np.array(slope), np.zeros(0, np.int8))
        index.residual = (offsets - index.predict(np.arange(n))).astype(np.int8 if bound < 127 else np.int64)
        return index

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[segment] + np.rint(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residual[ranks]


def _reach(offsets: np.ndarray, start: int, bound: int, window: int) -> tuple[int, float]:
    """End of the longest segment from ``start`` and the middle of its cone of slopes."""
    low, high, at = -np.inf, np.inf, start + 1
    while at < len(offsets):
        steps = np.arange(at, min(at + window, len(offsets)))
        rise, run = offsets[steps] - offsets[start], steps - start
        lows = np.maximum(np.maximum.accumulate((rise - bound) / run), low)
        highs = np.minimum(np.minimum.accumulate((rise + bound) / run), high)
        crossed = lows > highs
        if crossed.any():
            k = int(crossed.argmax())
            if k:
                low, high = lows[k - 1], highs[k - 1]
            at += k
            break
        low, high, at = lows[-1], highs[-1], int(steps[-1]) + 1
        window *= 2
    return at, (low + high) / 2 if np.isfinite(high) else 0.0


def boundaries(data: np.ndarray) -> np.ndarray:
    """Offsets at which a code point of UTF-8 bytes starts, and the end."""
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def _offsets_of(data: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Byte offsets, from the start of each text, of ``ranks`` (one column per cut).

    ``starts``: the texts' first bytes in ``data``.  All texts share one index; the rank of
    a text's first code point in it is found among the boundaries.
    """
    marks = boundaries(data)
    index = RankIndex.fit(marks)
    origin = np.searchsorted(marks, starts)
    return index.offset(origin[:, None] + ranks) - starts[:, None]


def _chunks(sizes: np.ndarray, limit: int = CHUNK) -> list[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes each."""
    group = (np.cumsum(sizes) - 1).clip(0) // limit
    edges = np.flatnonzero(np.diff(group)) + 1
    bounds = [0, *edges.tolist(), len(sizes)]
    return [(a, b) for a, b in zip(bounds, bounds[1:], strict=False) if a < b]


OFFSETS = "first long, second long"


def _cut_offsets(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    data = text.cast(pa.large_binary()) if not pa.types.is_large_binary(text.type) else text
    place = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = data.buffers()[2]
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    ranks = np.stack([first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False)], axis=1).astype(np.int64)
    out = np.zeros(ranks.shape, np.int64)
    for a, b in _chunks(np.diff(place)):
        piece = raw[place[a] : place[b]]
        out[a:b] = _offsets_of(piece, place[a:b] - place[a], ranks[a:b])
    return pa.StructArray.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["first", "second"])


def byte_offsets(text: Column, first: Column, second: Column) -> Column:
    """Byte offsets of two cuts given in code points, by the rank index of each batch."""
    return F.arrow_udf(_cut_offsets, OFFSETS)(text, first, second)


def _draw(digest: Column, group: int) -> Column:
    """An 8-digit group of a hex digest as a number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _slice(data: Column, start: Column, end: Column | None = None) -> Column:
    length = (F.octet_length(data) if end is None else end) - start
    return F.substring(data, (start + 1).cast("int"), length.cast("int")).cast("string")


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Each text cut into prefix, middle and suffix and put together in its form.

    Returns doc_id, n (code points), form, prefix, middle, suffix (null if plain) and output.
    """
    n = F.char_length("text").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = texts(docs).withColumn("n", n).withColumn("digest", digest)
    one, two = _draw(F.col("digest"), 0) % (F.col("n") + 1), _draw(F.col("digest"), 1) % (F.col("n") + 1)
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (_draw(F.col("digest"), 2) % 100 >= TRANSFORMED_PERCENT)
    form = F.when(plain, PLAIN).when(_draw(F.col("digest"), 3) % 100 < SPM_PERCENT, SPM).otherwise(PSM)
    rows = rows.select("doc_id", "text", "n", form.alias("form"), byte_offsets(F.col("text"), F.least(one, two), F.greatest(one, two)).alias("cut"))
    data, kept = F.col("text").cast("binary"), F.col("form") != PLAIN
    rows = rows.withColumns({
        "prefix": F.when(kept, _slice(data, F.lit(0), F.col("cut.first"))),
        "middle": F.when(kept, _slice(data, F.col("cut.first"), F.col("cut.second"))),
        "suffix": F.when(kept, _slice(data, F.col("cut.second"))),
    })
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == PSM, psm).when(F.col("form") == SPM, spm).otherwise(F.col("text"))
    return rows.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def _between(text: Column, start: str, end: str) -> Column:
    """What stands between a mark at the start of ``text`` and the first ``end``."""
    return F.substring_index(F.substr(text, F.lit(len(start) + 1)), end, 1)


def _behind(text: Column, mark: str) -> Column:
    """What follows the first ``mark``."""
    return F.substr(text, F.locate(mark, text) + len(mark))


def restore(output: Column, form: Column) -> Column:
    """The text an output was made of, from the output and its form alone."""
    psm = F.concat(_between(output, PREFIX, SUFFIX), _behind(output, MIDDLE), _between(_behind_from(output, SUFFIX), SUFFIX, MIDDLE))
    spm = F.concat(_between(_behind_from(output, PREFIX), PREFIX, MIDDLE), _behind(output, MIDDLE), _between(output, SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def _behind_from(text: Column, mark: str) -> Column:
    """``text`` from its first ``mark`` on, the mark included."""
    return F.substr(text, F.locate(mark, text))


def digest(rows: DataFrame) -> DataFrame:
    """Lengths and digests of transformed rows and of the texts restored from them."""
    return rows.select(
        "doc_id", "n", "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
