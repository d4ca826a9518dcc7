"""Operators that bring differently shaped sources to one layout."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cleanse import first_present
from rollcall.operators.shape import col_of, cols_of


def consolidate_schemas(
    df: DataFrame, targets: Mapping[str, Sequence[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Merge old and new spellings: ``{output: [newest name, ..., oldest name]}``.

    A target without any existing source is a NULL string.
    """
    merged = [first_present(df.columns, names).alias(dst) for dst, names in targets.items()]
    return df.select(*merged, *cols_of(keep))


def tag_source(df: DataFrame, **tags: str) -> DataFrame:
    """Constant columns that tell which table a row came from."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def _lookup(df: DataFrame, keys: Sequence[str], fill: Sequence[str], required: Sequence[str]) -> DataFrame:
    known = df.dropna(subset=[*keys, *required])
    return known.select(*cols_of([*keys, *fill])).distinct()


def _fillable(keys: Sequence[str], fill: Sequence[str]) -> Column:
    lacking = reduce(lambda a, b: a | b, [col_of(c).isNull() for c in fill])
    return lacking & reduce(lambda a, b: a & b, [col_of(k).isNotNull() for k in keys])


def backfill(
    df: DataFrame,
    keys: Sequence[str],
    fill: Sequence[str],
    on_conflict: str = "fanout",
    required: Sequence[str] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Fill NULLs in ``fill`` from rows of ``df`` (or ``known``) with the same ``keys``.

    The lookup holds the distinct tuples whose keys and ``required`` columns (default:
    the first of ``fill``) are known.  A key with several tuples yields one row per
    tuple under ``fanout`` and stays NULL under ``null``.

    The rows are read once for the join and once, by four columns, for the lookup.  A row
    that needs no fill joins under a NULL key, which matches nothing, and a hash of its own,
    which spreads such rows where the join shuffles.
    """
    required = list(required or fill[:1])
    lookup = _lookup(df if known is None else known, keys, fill, required)
    if on_conflict == "null":
        tuples = [F.min(col_of(c)).alias(c) for c in fill]
        lookup = (
            lookup.groupBy(*cols_of(keys))
            .agg(F.count("*").alias("_tuples"), *tuples)
            .filter("_tuples = 1")
            .drop("_tuples")
        )
    elif on_conflict != "fanout":
        raise ValueError(f"on_conflict must be 'fanout' or 'null', not {on_conflict!r}")

    fillable = _fillable(keys, fill)
    found = lookup.select(
        *[col_of(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[col_of(c).alias(f"_fill_{i}") for i, c in enumerate(fill)],
        F.lit(0).cast("long").alias("_spread"),
    )
    same = [F.when(fillable, col_of(k)) == F.col(f"_key_{i}") for i, k in enumerate(keys)]
    same.append(F.when(fillable, F.lit(0).cast("long")).otherwise(F.xxhash64(*cols_of(df.columns))) == F.col("_spread"))
    position = {c: i for i, c in enumerate(fill)}
    return df.join(found, reduce(lambda a, b: a & b, same), "left").select(
        *[
            F.coalesce(col_of(c), F.col(f"_fill_{position[c]}")).alias(c) if c in position else col_of(c)
            for c in df.columns
        ]
    )


def backfill_apart(
    df: DataFrame,
    keys: Sequence[str],
    fill: Sequence[str],
    on_conflict: str = "fanout",
    required: Sequence[str] | None = None,
) -> DataFrame:
    """:func:`backfill` for large tables: rows that need no fill stay out of the join, for one
    more read of the table."""
    fillable = _fillable(keys, fill)
    filled = backfill(df.filter(fillable), keys, fill, on_conflict, required, known=df)
    return df.filter(~fillable).unionByName(filled)


def ambiguous_keys(
    df: DataFrame, keys: Sequence[str], fill: Sequence[str], required: Sequence[str] | None = None
) -> DataFrame:
    """Keys for which :func:`backfill` knows more than one tuple."""
    lookup = _lookup(df, keys, fill, list(required or fill[:1]))
    return lookup.groupBy(*cols_of(keys)).agg(F.count("*").alias("tuples")).filter("tuples > 1")


def conform(sources: Iterable[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Project every source to its named columns and union them by name.

    Names decide, not positions, so sources may list the columns in any order.
    """
    frames = [df.select(*[c.alias(name) for name, c in layout.items()]) for df, layout in sources]
    return reduce(lambda a, b: a.unionByName(b), frames)
