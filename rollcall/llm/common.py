"""Helpers shared by the operators: sessions, scratch tables, byte hashing in batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import rollcall
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import configure, pin

__all__ = ["PrefixHash", "byte_chunks", "fresh", "mix", "pin", "prepare", "release", "shuffle_width", "table", "texts"]

#: Rows per Arrow batch: long documents make large rows, and a batch has to fit a worker.
ARROW_ROWS = 512


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(rollcall.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rollcall-code-"), "rollcall.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("rollcall", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release(pinned: DataFrame) -> None:
    """Delete a table written by ``pin`` that nothing reads any more."""
    files = pinned.inputFiles()
    if files:
        spark = pinned.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_chunks(frames: Iterator[pd.DataFrame], encode, columns: tuple[str, ...], limit: int = 2_000_000) -> Iterator[tuple[list, list[bytes]]]:
    """Rows regrouped into chunks of about ``limit`` bytes: (values of ``columns``, encoded texts)."""
    rows: list = []
    parts: list[bytes] = []
    size = 0
    for frame in frames:
        for *values, text in zip(*[frame[c] for c in columns], frame["text"], strict=True):
            data = encode(text)
            rows.append(values)
            parts.append(data)
            size += len(data)
            if size >= limit:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


class PrefixHash:
    """Hashes of arbitrary byte ranges of one buffer, all ranges at once.

    A polynomial over 64-bit words with an odd base: the hash of [s, e) is the difference
    of two prefix sums divided by ``base ** s``, so it depends on the bytes alone.
    """

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.base = int(rng.integers(1, 2**62)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((prefixes[ends] - prefixes[starts]) * self.down[starts])
