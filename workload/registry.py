"""Query registry and access to the supplied tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Rows of a scan task that are taken as they are, and rows of a part where a table is dealt.
PART_ROWS = 2**21
DEALT_ROWS = 2**18

QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._counted: dict[str, tuple[int, int, int]] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table in even parts: as its file is split, if that gives every core a part and
        none more than ``PART_ROWS`` rows, else dealt by its first column.

        The supplied files hold one row group each, hence one scan task whatever their size.
        The number of parts follows the rows and is given, because adaptive execution would
        merge parts by their bytes here, and what the adapters make of a row is far wider.
        """
        df = getattr(self, name)
        rows, split, largest = self._parts(name)
        cores = self.spark.sparkContext.defaultParallelism
        if split >= cores and largest <= PART_ROWS:
            return df
        return df.repartition(max(cores, -(-rows // DEALT_ROWS)), df.columns[0])

    def _parts(self, name: str) -> tuple[int, int, int]:
        """Rows, scan tasks and rows of the largest one, from the files' footers."""
        if name not in self._counted:
            parts = getattr(self, name).groupBy(F.spark_partition_id().alias("part")).count()
            found = parts.agg(F.sum("count"), F.count("*"), F.max("count")).first()
            self._counted[name] = tuple(n or 0 for n in found)
        return self._counted[name]

    def sql(self, text: str) -> DataFrame:
        """Run adapter SQL, written so that both engines read it, on the tables."""
        used = [t for t in TABLES if re.search(rf"\b(from|join) {t}\b", text)]
        text = re.sub(rf"\b(from|join) ({'|'.join(used)})\b", r"\1 {\2}", text).replace('"', "`")
        frames = {t: self.spread(t) if t == "lineitem" else getattr(self, t) for t in used}
        return self.spark.sql(text, **frames)


def query(name: str, oracle: str | None = None):
    """Register a query and, unless SQL cannot express it, its check statement."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand out the same values."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(QUERIES[name](Tables(configure(spark), sf_dir)))

    run.__name__ = name
    return run
