"""Slowly changing attributes: latest state, spans, full history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.dedup import first_per_key
from rollcall.operators.shape import col_of, cols_of


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[Column] = ()
) -> DataFrame:
    """The row with the highest ``version`` per key.

    ``tie_break`` comes next; the remaining columns close the order.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    order = [F.desc_nulls_last(version), *tie_break, *[col_of(c).asc_nulls_last() for c in rest]]
    return first_per_key(df, keys, order)


def attribute_spans(
    df: DataFrame,
    attributes: Sequence[str],
    version: str,
    names: tuple[str, str] = ("first_year", "last_year"),
) -> DataFrame:
    """First and last version in which each attribute set occurs."""
    return df.groupBy(*cols_of(attributes)).agg(
        F.min(version).alias(names[0]), F.max(version).alias(names[1])
    )


def scd_current(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    effective: str,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Current attributes only: one open row per key that starts at ``effective``."""
    current = latest_per_key(df, keys, version, tie_break)
    return current.select(
        *cols_of(c for c in df.columns if c != version),
        F.lit(effective).alias("effective_date"),
        F.lit(None).cast("string").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_history(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    version: str,
    priority: Sequence[str] = (),
) -> DataFrame:
    """Type 2 history: one row per key and run of equal attributes.

    A run ends when an attribute changes, not when a version is missing.  ``end_date``
    is the first version of the next run and NULL for the current one.  Of several rows
    for a key and version the one with the lowest ``priority`` counts.

    One exchange: a task sends each distinct (version, priority, attributes) of a key once,
    and what it sends merges as a set, so the state of a key is bounded by its distinct
    versions, however often they occur.  The runs are found in the sorted set, each entry
    beside the one before it.
    """

    def ordered(c: str, nulls_last: bool = True) -> list[Column]:
        # structs compare field by field, NULL first
        absent = col_of(c).isNull() if nulls_last else col_of(c).isNotNull()
        return [absent, col_of(c)]

    fields = [*ordered(version, nulls_last=False), *(x for c in [*priority, *attributes] for x in ordered(c))]
    entry = F.struct(*[x.alias(f"f{i}") for i, x in enumerate(fields)])
    values = {c: f"f{2 * (i + 1 + len(priority)) + 1}" for i, c in enumerate(attributes)}

    def same(a: Column, b: Column, names: Sequence[str]) -> Column:
        return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])

    def with_neighbour(entries: str, after: bool) -> Column:
        """Structs (own, other) of each entry and the one before or after it, NULL at the end."""
        none = F.array(F.lit(None))
        shifted = F.slice(F.concat(F.col(entries), none), 2, F.size(entries)) if after else F.concat(none, F.col(entries))
        return F.slice(F.arrays_zip(F.col(entries).alias("own"), shifted.alias("other")), 1, F.size(entries))

    def changes(entries: str, names: Sequence[str]) -> Column:
        pairs = F.filter(with_neighbour(entries, after=False), lambda p: p["other"].isNull() | ~same(p["own"], p["other"], names))
        return F.transform(pairs, lambda p: p["own"])

    histories = df.groupBy(*cols_of(keys)).agg(F.sort_array(F.collect_set(entry)).alias("_entries"))
    histories = histories.withColumn("_entries", changes("_entries", ["f1"]))  # the first of each version
    histories = histories.withColumn("_runs", changes("_entries", list(values.values())))
    runs = histories.select(*cols_of(keys), F.explode(with_neighbour("_runs", after=True)).alias("_run"))
    return runs.select(
        *cols_of(keys),
        *[F.col(f"_run.own.{name}").alias(c) for c, name in values.items()],
        F.col("_run.own.f1").alias("effective_date"),
        F.col("_run.other.f1").alias("end_date"),
        F.col("_run.other").isNull().alias("is_current"),
    )
