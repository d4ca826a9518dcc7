"""Projection, filter, union and reshape operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cleanse import typed_null


def quoted(name: str) -> str:
    """Column reference that survives ``#``, ``/``, dots and spaces in the name."""
    return "`" + name.replace("`", "``") + "`"


def col_of(name: str) -> Column:
    return F.col(quoted(name))


def cols_of(names: Iterable[str]) -> list[Column]:
    return [col_of(name) for name in names]


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def with_missing(df: DataFrame, names: Iterable[str], data_type: str = "string") -> DataFrame:
    """Add the ``names`` that ``df`` lacks as typed NULL columns."""
    absent = {name: typed_null(data_type) for name in names if not has_column(df, name)}
    return df.withColumns(absent) if absent else df


def rename_project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the columns of ``mapping`` (raw name to output name), in its order."""
    return df.select(*[col_of(src).alias(dst) for src, dst in mapping.items()])


def level_filter(df: DataFrame, level: str, column: str = "detail_level") -> DataFrame:
    """Rows of one aggregation level; a plain equality, so it reaches the scan."""
    return df.filter(F.col(column) == level)


def require_any(df: DataFrame, *alternatives: Sequence[str]) -> DataFrame:
    """Rows with at least one non-NULL column in every group of ``alternatives``."""
    for group in alternatives:
        df = df.filter(reduce(lambda a, b: a | b, [col_of(c).isNotNull() for c in group]))
    return df


def year_range(
    df: DataFrame, first: str | None = None, last: str | None = None, column: str = "school_year"
) -> DataFrame:
    """School years compare as text: ``'2020-21' <= school_year <= last``."""
    if first is not None:
        df = df.filter(F.col(column) >= first)
    if last is not None:
        df = df.filter(F.col(column) <= last)
    return df


def drop_zero_padding(
    df: DataFrame,
    last_year: str = "2021-22",
    first_year: str | None = None,
    year: str = "school_year",
    measure: str = "enrollment_count",
) -> DataFrame:
    """Drop zero rows up to ``last_year``, where zero means "not offered"."""
    padded = (F.col(year) <= last_year) & (F.col(measure) == 0)
    if first_year is not None:
        padded = padded & (F.col(year) >= first_year)
    return df.filter(~F.coalesce(padded, F.lit(False)))


def union_with_drift(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a frame lacks becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """SQL ``UNION``: one distinct over the whole union, none per input."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def metric_family(
    groups: Iterable[str],
    metrics: Mapping[str, Column | object],
    name: str = "{metric}_{group}",
    output: str | None = None,
) -> list[Column]:
    """One column per group and metric.

    ``metrics`` maps a metric prefix to a function of the raw column.  ``name`` builds
    the raw column name, ``output`` the result name (lower-cased raw name by default).
    """
    out = []
    for group in groups:
        for metric, build in metrics.items():
            raw = name.format(metric=metric, group=group)
            alias = (output or name).format(metric=metric, group=group).lower()
            out.append(build(col_of(raw)).alias(alias))
    return out


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    families: Iterable[tuple[str, str, Sequence[str | None]]],
    names: Sequence[str] = ("subgroup_type", "subgroup_name"),
    values: Mapping[str, str] = {"count": "double", "percent": "decimal(5,1)"},
    drop_empty: bool = False,
) -> DataFrame:
    """Turn column families into rows: (type, name, value columns).

    ``families`` lists (type, name, columns) with one column, or None, per value.  The
    result is one Generate over the scan, without a shuffle.
    """
    cells: list[Column] = []
    families = list(families)
    for kind, label, columns in families:
        cells += [F.lit(kind), F.lit(label)]
        for source, data_type in zip(columns, values.values(), strict=True):
            cells.append(typed_null(data_type) if source is None else col_of(source).cast(data_type))
    stacked = F.stack(F.lit(len(families)), *cells).alias(*names, *values)
    long = df.select(*cols_of(ids), stacked)
    if drop_empty:
        long = require_any(long, list(values))
    return long


def component_pivot(
    df: DataFrame, by: Sequence[str], component: str, values: Sequence[str], measure: str
) -> DataFrame:
    """Components to columns.  ``max`` makes the cell deterministic if a key repeats."""
    return df.groupBy(*by).pivot(component, list(values)).agg(F.max(measure))
