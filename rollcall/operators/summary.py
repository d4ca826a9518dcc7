"""Aggregations and report queries: profiles, distributions, rankings, trends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.shape import col_of, cols_of


def group_profile(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Row count and further aggregates per group."""
    extra = [c.alias(name) for name, c in (aggs or {}).items()]
    return df.groupBy(*cols_of(by)).agg(F.count("*").alias("record_count"), *extra)


def distribution(
    df: DataFrame,
    by: Sequence[str],
    aggs: Mapping[str, Column] | None = None,
    descending: bool = False,
) -> DataFrame:
    """:func:`group_profile` in group order, or largest group first within the leading
    columns when ``descending``."""
    order = cols_of(by)
    if descending:
        order = [*cols_of(by[:-1]), F.desc("record_count"), col_of(by[-1])]
    return group_profile(df, by, aggs).orderBy(*order)


def drilldown(
    df: DataFrame, predicate: Column | str, by: Sequence[str], aggs: Mapping[str, Column] | None = None
) -> DataFrame:
    """Matching rows per group, largest group first within the leading columns."""
    return distribution(df.filter(predicate), by, aggs, descending=True)


def top_n(
    df: DataFrame,
    by: str,
    n: int,
    tie_break: Sequence[str],
    predicate: Column | str | None = None,
    columns: Sequence[str] | None = None,
    ascending: bool = False,
) -> DataFrame:
    """The ``n`` highest (or lowest) rows; each task keeps only its own best ``n``."""
    if predicate is not None:
        df = df.filter(predicate)
    first = col_of(by).asc_nulls_last() if ascending else col_of(by).desc_nulls_last()
    ranked = df.orderBy(first, *[col_of(c).asc_nulls_last() for c in tie_break]).limit(n)
    return ranked if columns is None else ranked.select(*cols_of(columns))


def sample(
    df: DataFrame,
    n: int,
    predicate: Column | str | None = None,
    columns: Sequence[str] | None = None,
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Filtered, projected, ordered preview of ``n`` rows, as a DataFrame."""
    if predicate is not None:
        df = df.filter(predicate)
    if order:
        df = df.orderBy(*order)
    if columns is not None:
        df = df.select(*cols_of(columns))
    return df.limit(n)


def numeric_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Non-NULL count, min, max, mean, sample standard deviation and total per column.

    All columns are read in one pass; the result has one row per column (and group).
    """
    stats = {
        "n": F.count,
        "min_value": F.min,
        "max_value": F.max,
        "mean_value": F.avg,
        "stddev_value": F.stddev,
        "total_value": F.sum,
    }

    def profile(c: str) -> Column:
        value = col_of(c).cast("double")
        return F.struct(F.lit(c).alias("measure"), *[f(value).alias(name) for name, f in stats.items()])

    grouped = df.groupBy(*cols_of(by)).agg(F.array(*[profile(c) for c in columns]).alias("_profiles"))
    return grouped.select(*cols_of(by), F.inline("_profiles"))


def distinct_counts(
    df: DataFrame, by: Sequence[str], columns: Mapping[str, str], count_null: bool = False
) -> DataFrame:
    """Row count and distinct values per group; ``columns`` maps output name to column.

    With ``count_null`` NULL is one more value, as in ``distinct().count()``.
    """

    def distinct(c: str) -> Column:
        known = F.count_distinct(col_of(c))
        if not count_null:
            return known
        return known + F.coalesce(F.max(col_of(c).isNull().cast("int")), F.lit(0))

    return group_profile(df, by, {name: distinct(c) for name, c in columns.items()})


def year_gap(
    df: DataFrame, year: str, entities: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Rows and distinct entities per year, to compare a year with its neighbours.

    ``entities`` maps an output name to an expression; rows where it is NULL do not
    count, so ``when(level == 'School', key)`` counts schools only.
    """
    aggs = {name: F.count_distinct(c) for name, c in entities.items()}
    return distribution(df, [year, *by], aggs)


def yearly_trend(
    df: DataFrame,
    measures: Sequence[str],
    year: Sequence[str] = ("school_year",),
    predicate: Column | str | None = None,
) -> DataFrame:
    """Rows, non-NULL values and mean of each measure per year, in year order."""
    if predicate is not None:
        df = df.filter(predicate)
    aggs: dict[str, Column] = {}
    for c in measures:
        aggs[f"{c}_known"] = F.count(col_of(c))
        aggs[f"{c}_mean"] = F.avg(col_of(c).cast("double"))
    return distribution(df, list(year), aggs)


def ranking(
    df: DataFrame, by: str, columns: Sequence[str], predicate: Column | str, ascending: bool = False
) -> DataFrame:
    """All matching rows ordered by one measure, ties in column order."""
    first = col_of(by).asc_nulls_last() if ascending else col_of(by).desc_nulls_last()
    rows = df.filter(predicate).select(*cols_of(columns))
    return rows.orderBy(first, *[col_of(c) for c in columns if c != by])


def key_frequency(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values."""
    return top_n(group_profile(df, [key]), "record_count", n, [key])
