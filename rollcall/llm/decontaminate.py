"""Benchmark decontamination: size-partitioned MinHash containment search.

Shingles are five lower-cased words; a document is contaminated by an item if it holds at
least ``THRESHOLD`` of the item's distinct shingles.  One hash function orders all
shingles.  Items are partitioned by their number of shingles into classes [2^c, 2^(c+1)),
and each item is indexed by its minimum hashes, as many as the largest item of its class
could lose and still reach the threshold, plus one.  A document that contains the item
therefore holds at least one of them, however long it is, so the search loses nothing; each
candidate is then verified by exact containment of the shingles.

Documents probe with their shingles below the largest indexed hash.  No join is hinted: the
index is read from a written table, so Catalyst broadcasts it only while it is small.

An item of three or four words is one shingle of its own size, to be held whole; documents
are cut into runs of those sizes as well, where there are such items.

DataFrame functions only.  Defined results: a null text is empty; items of one or two words
would mark clean documents and are never found; items of equal shingles are found together;
a null item id counts as an item without a name; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import fresh, pin

SHINGLE = 5
SHORT = (3, 4)
THRESHOLD = 0.8
NODE = "_text_hash"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(word_list: Column, sizes: Sequence[int] = (SHINGLE,)) -> Column:
    """Distinct hashes of all runs of so many words."""

    def runs_of(w: Column, size: int) -> Column:
        starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))

    def runs(w: Column) -> Column:
        return F.concat(*[runs_of(w, size) for size in sizes])

    # bound to a name first, so that the words are not split anew for every run
    return F.array_distinct(F.get(F.transform(F.array(word_list), runs), F.lit(0)))


def index(items: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, list[int]]:
    """Items with their shingles, the minimum hashes that candidates must share, and the sizes
    of runs that items are made of."""
    cut = items.select("item_id", words(F.col("text")).alias("w"))
    own = F.least(F.size("w"), F.lit(SHINGLE)).alias("run")
    hashes = reduce(lambda rest, size: F.when(F.size("w") == size, shingles(F.col("w"), [size])).otherwise(rest), SHORT, shingles(F.col("w")))
    listed = cut.select("item_id", own, F.array_sort(hashes).alias("item_shingles"))
    # in order, so that items that differ in the order of their shingles alone are one
    listed = listed.filter(F.size("item_shingles") > 0).groupBy("run", "item_shingles").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    listed = pin(listed.select(F.xxhash64("run", "item_shingles").alias("item"), "run", "item_ids", "item_shingles"), "items")
    sizes = sorted({row["run"] for row in listed.select("run").distinct().collect()})  # at most three
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("item_shingles"))) + 1) - 1
    spare = (largest - F.ceil(largest * threshold - 1e-9) + 1).cast("int")
    minima = F.slice("item_shingles", 1, spare)
    return listed, pin(listed.select("item", F.explode(minima).alias("shingle")), "minima"), sizes or [SHINGLE]


def with_node(docs: DataFrame, name: str = NODE) -> DataFrame:
    return docs.withColumn(name, F.xxhash64(F.coalesce("text", F.lit(""))))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, item, item_ids, containment) of every contaminated text; node is the text's hash."""
    listed, minima, sizes = index(items, threshold)
    cutoff = minima.agg(F.max("shingle")).first()[0]
    texts = with_node(docs.select("text")).select(F.col(NODE).alias("node"), "text")
    hashed = texts.select("node", words(F.col("text")).alias("w")).select("node", shingles(F.col("w"), sizes).alias("s"))
    low = F.filter("s", lambda h: h <= F.lit(cutoff if cutoff is not None else -(2**63)))
    probes = hashed.select("node", F.explode(low).alias("shingle"))
    candidates = pin(probes.join(minima, "shingle").groupBy("node", "item").agg(F.count("*").alias("hits")), "candidates")
    again = texts.join(candidates.select("node", "item"), "node").select("node", "item", words(F.col("text")).alias("w"))
    again = again.select("node", "item", shingles(F.col("w"), sizes).alias("s")).join(listed, "item")
    held = F.size(F.array_intersect("s", "item_shingles")) / F.size("item_shingles")
    found = again.select("node", "item", "item_ids", held.alias("containment")).filter(F.col("containment") >= threshold)
    return pin(found.dropDuplicates(["node", "item"]), "leaks")


def judge(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: contaminated, its items and the largest containment."""
    found = leaks(docs, items, threshold)
    by_text = found.groupBy("node").agg(
        F.sort_array(F.flatten(F.collect_set("item_ids"))).alias("item_ids"), F.max("containment").alias("containment")
    )
    rows = with_node(docs.select("doc_id", "text")).select("doc_id", F.col(NODE).alias("node"))
    return rows.join(by_text, "node", "left").select(
        "doc_id",
        F.col("containment").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join("item_ids", ","), F.lit("")).alias("items"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns kept."""
    name = fresh(docs, NODE)
    found = leaks(docs, items, threshold).select(F.col("node").alias(name)).distinct()
    return with_node(docs, name).join(found, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
