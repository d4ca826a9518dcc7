"""Document fingerprints by consistent weighted sampling.

A text is its bag of words, each named by a 64-bit hash and weighted by its count.
For each of ``SLOTS`` samples a term has r, c ~ Gamma(2, 1) and b ~ U(0, 1); with weight w
its level is t = floor(ln w / r + b) and its key c exp(-r (t - b + 1)).  The term with the
smallest key is the sample, and two texts share the sample (term and level) with
probability equal to their generalised Jaccard similarity.

r, c and b are functions of (word hash, sample) alone, by a counter-based hash, so that no
two words share them.  A worker keeps those of up to ``CACHED`` words, which changes no result.

Defined results: a null or empty text, or one of white space only, has the fingerprint of
zeros and likeness 1 to another such text, 0 to the rest; equal texts have equal
fingerprints; null ids sort first, equal ids by a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import PrefixHash, mix, shuffle_width, texts

SLOTS = 64
SEED = 20240607
#: Places of the table of drawn words; a word has one place, and the first to come keeps it.
CACHED = 2**16
#: Words of one text whose keys are computed at a time.
BLOCK = 2048
#: Characters of short texts that are sampled together, so that each of their words is looked up once.
TOGETHER = 2**16

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _gamma(bits: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) numbers from 64 random bits each, as the sum of two exponential ones."""
    high = ((bits >> np.uint64(32)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-32)
    low = ((bits & np.uint64(0xFFFFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-32)
    return np.maximum(-np.log(high) - np.log(low), np.float32(1e-9))


def draw(words: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each word and sample."""
    x = mix(words ^ salts)
    log_c = np.log(_gamma(mix(x + np.uint64(0x9E3779B97F4A7C15))))
    b = (mix(x + np.uint64(0x3C6EF372FE94F82A)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
    return _gamma(x), log_c, b


def _keys(r: np.ndarray, log_c: np.ndarray, b: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    return log_c - r * (np.floor(log_weight / r + b) - b + 1)


class Sampler:
    def __init__(self, slots: int = SLOTS, seed: int = SEED, cached: int = CACHED):
        self.slots = slots
        self.salts = np.random.default_rng(seed).integers(0, 2**64, slots, dtype=np.uint64)
        self.hash = PrefixHash(seed)
        self.held = np.zeros(cached, np.uint64)
        self.drawn = np.empty((3, cached, slots), np.float32)
        self.once = np.empty((cached, slots), np.float32)

    def keys(self, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Log keys of words by samples; words that are not in the table are drawn."""
        place = (words % np.uint64(len(self.held))).astype(np.int64)
        log_weight = np.log(weights).astype(np.float32)[:, None]
        known = self.held[place] == words
        out = np.empty((len(words), self.slots), np.float32)
        at = np.flatnonzero(known & (weights == 1))
        out[at] = self.once[place[at]]
        at = np.flatnonzero(known & (weights > 1))
        out[at] = _keys(*self.drawn[:, place[at]], log_weight[at])
        at = np.flatnonzero(~known)
        if len(at):
            drawn = np.stack(draw(words[at][:, None], self.salts))
            out[at] = _keys(*drawn, log_weight[at])
            taken, first = np.unique(place[at], return_index=True)
            free = self.held[taken] == 0
            taken, first = taken[free], first[free]
            self.held[taken] = words[at[first]]
            self.drawn[:, taken] = drawn[:, first]
            self.once[taken] = _keys(*drawn[:, first], np.float32(0))
        return out

    def drawn_keys(self, words: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log keys at weight 1 of distinct words, and r, ln c and b of those at ``heavy``."""
        place = (words % np.uint64(len(self.held))).astype(np.int64)
        known = self.held[place] == words
        once, draws = np.empty((len(words), self.slots), np.float32), np.empty((3, len(heavy), self.slots), np.float32)
        once[known] = self.once[place[known]]
        at = np.flatnonzero(known[heavy])
        draws[:, at] = self.drawn[:, place[heavy[at]]]
        new = np.flatnonzero(~known)
        if len(new):
            drawn = np.stack(draw(words[new][:, None], self.salts))
            once[new] = _keys(*drawn, np.float32(0))
            at = np.flatnonzero(~known[heavy])
            draws[:, at] = drawn[:, np.searchsorted(new, heavy[at])]
            taken, first = np.unique(place[new], return_index=True)
            free = self.held[taken] == 0
            taken, first = taken[free], first[free]
            self.held[taken] = words[new[first]]
            self.drawn[:, taken] = drawn[:, first]
            self.once[taken] = once[new[first]]
        return once, draws

    def _together(self, texts: list[str]) -> np.ndarray:
        """The signatures of short texts; each distinct word is hashed, looked up or drawn once."""
        out = np.zeros((len(texts), self.slots), np.uint16)
        parts = [b" ".join(t.encode("utf-8", "replace").split()) for t in texts]
        raw = np.frombuffer(b" ".join(parts), np.uint8)
        text_start = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        gaps = np.flatnonzero(raw == 32)
        starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))
        some = ends > starts
        starts, ends = starts[some], ends[some]
        if not len(starts):
            return out
        words, word = np.unique(self.hash.ranges(self.hash.prefixes(raw), starts, ends), return_inverse=True)
        owner = np.searchsorted(text_start, starts, "right") - 1
        rows, weights = np.unique(owner * len(words) + word, return_counts=True)
        owner, word = np.divmod(rows, len(words))
        many = np.flatnonzero(weights > 1)
        heavy, of = np.unique(word[many], return_inverse=True)
        once, draws = self.drawn_keys(words, heavy)
        keys = once[word]
        keys[many] = _keys(*draws[:, of], np.log(weights[many]).astype(np.float32)[:, None])
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        best = np.array([bounds[i] + keys[bounds[i] : bounds[i + 1]].argmin(axis=0) for i in full])
        out[full] = self._samples(words[word[best]], weights[best])
        return out

    def _samples(self, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """16 bits of the word and level of each sample; the last axis is that of the samples."""
        level = np.zeros(words.shape, np.int64)  # that of weight 1, as b is below 1
        more = weights > 1
        r, _, b = draw(words[more], np.broadcast_to(self.salts, words.shape)[more])
        level[more] = np.floor(np.log(weights[more]).astype(np.float32) / r + b).astype(np.int64)
        sample = mix(words + mix(level.astype(np.uint64)))
        return (sample % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def signatures(self, texts: list[str]) -> list[np.ndarray]:
        """``signature`` of each text."""
        out: list[np.ndarray] = []
        group: list[str] = []
        size = 0
        for text in [*texts, None]:
            if group and (text is None or size + len(text) > TOGETHER):
                out += list(self._together(group)) if size <= TOGETHER else [self.signature(t) for t in group]
                group, size = [], 0
            if text is not None:
                group.append(text)
                size += len(text)
        return out

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of a text, by their hashes, and their weights."""
        data = b" ".join(text.encode("utf-8", "replace").split())
        if not data:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        raw = np.frombuffer(data, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        starts = np.concatenate(([0], gaps + 1))
        ends = np.concatenate((gaps, [len(raw)]))
        return np.unique(self.hash.ranges(self.hash.prefixes(raw), starts, ends), return_counts=True)

    def signature(self, text: str) -> np.ndarray:
        """16 bits per slot; zeros where the text has no word."""
        words, weights = self.counts(text)
        if not len(words):
            return np.zeros(self.slots, np.uint16)
        slot = np.arange(self.slots)
        least, best = np.full(self.slots, np.inf, np.float32), np.zeros(self.slots, np.int64)
        for start in range(0, len(words), BLOCK):
            keys = self.keys(words[start : start + BLOCK], weights[start : start + BLOCK])
            at = keys.argmin(axis=0)
            less = keys[at, slot] < least
            least[less], best[less] = keys[at, slot][less], start + at[less]
        return self._samples(words[best], weights[best])


@lru_cache
def sampler() -> Sampler:
    return Sampler()


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of (part, guest, id): each is compared with the one behind it."""
    sample = sampler()
    before = None
    for frame in frames:
        texts, pairs = [], []  # a pair is its id and the places of its text, the following and the edited one
        at = None if before is None else 0
        if before is not None:
            texts.append(before[1])
        for guest, doc_id, text in zip(frame["guest"], frame["doc_id"], frame["text"], strict=True):
            place = len(texts)
            if before is not None:
                pairs.append((before[0], at, place, place + 1))
                texts += [text, edited(before[1], text)]
            elif not guest:
                texts.append(text)
            before, at = (None, None) if guest else ((doc_id, text), place)
        marks = sample.signatures(texts)
        rows = [
            (
                doc_id, len(texts[own]), hashlib.sha256(texts[changed].encode("utf-8", "replace")).hexdigest(),
                text_of(marks[own]), text_of(marks[changed]), likeness(marks[own], marks[changed]), likeness(marks[own], marks[following]),
            )
            for doc_id, own, following, changed in pairs
        ]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def with_successors(docs: DataFrame) -> DataFrame:
    """Documents dealt into ranges of (id, text hash), each ended by the first row of the next.

    One shuffle of the texts.  An id that fills several ranges, such as null, is split by the
    hash.  Only the range bounds and the first row's id and hash of each range pass through
    the driver and are broadcast: as many as there are shuffle partitions.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("rank", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("hash", F.xxhash64("text"))
    width = shuffle_width(spark)
    found = Counter(int(b) for b in rows.stat.approxQuantile("rank", [i / width for i in range(1, width)], 0.2 / width))
    bounds = [(rank, -(2**63) + i * (2**64 // n)) for rank, n in sorted(found.items()) for i in range(n)]

    def reached(bound: Column) -> Column:
        return (bound["rank"] < F.col("rank")) | ((bound["rank"] == F.col("rank")) & (bound["hash"] <= F.col("hash")))

    listed = [F.struct(F.lit(rank).cast("long").alias("rank"), F.lit(h).cast("long").alias("hash")) for rank, h in bounds]
    rows = rows.withColumn("part", F.size(F.filter(F.array(*listed), reached)) if listed else F.lit(0))
    heads = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min(F.struct("rank", "hash")).alias("head")).select("part", "head.*").collect())
    guests = [(rank, h, heads[i - 1][0]) for i, (_, rank, h) in enumerate(heads)]
    guests = F.broadcast(spark.createDataFrame(guests, "rank long, hash long, visited int"))
    dealt = rows.join(guests, ["rank", "hash"], "left").select(
        "doc_id", "rank", "hash", "text",
        F.explode(F.array_compact(F.array(
            F.struct(F.col("part"), F.lit(False).alias("guest")),
            F.when(F.col("visited").isNotNull(), F.struct(F.col("visited").alias("part"), F.lit(True).alias("guest"))),
        ))).alias("place"),
    )
    dealt = dealt.select("place.part", "place.guest", "rank", "hash", "doc_id", "text")
    return dealt.repartition(width, "part").sortWithinPartitions("part", "guest", "rank", "hash").select("guest", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited form, and their likeness."""
    return with_successors(docs).mapInPandas(_compare, SCHEMA)
