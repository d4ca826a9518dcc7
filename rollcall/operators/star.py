"""Star-schema operators: surrogate keys, dimension lookups, facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.shape import col_of, cols_of, level_filter
from rollcall.session import pin

# ``monotonically_increasing_id`` keeps the partition above this bit, the row below it.
_PARTITION_SHIFT = 33


def surrogate_key(
    df: DataFrame, name: str, order_by: Sequence[Column], start: int = 1
) -> DataFrame:
    """Dense long key ``start, start+1, ...`` in the order of a unique business key.

    The rows are sorted across the cluster and written with their position (partition,
    row) to the shared folder; the key is the position plus the number of rows in
    earlier partitions.  No task sees more than its range, and the driver sees one count
    per partition.  Runs two jobs: the write and the count.
    """
    placed = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    placed = pin(placed, name)
    part = F.shiftright("_at", _PARTITION_SHIFT)
    row = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).collect()
    # One entry per sort partition: its size is bounded by the shuffle width, not the data.
    # One entry per sort partition: its size is bounded by the shuffle width, not the data.
    # A join with them would do as well, but Catalyst would then guess the dimension's size.
    rows_in = {size["_part"]: size["_rows"] for size in sizes}
    offsets, before = [], start
    for i in range(max(rows_in, default=-1) + 1):
        offsets.append(F.lit(before).cast("long"))
        before += rows_in.get(i, 0)
    if not offsets:
        return placed.select(F.lit(None).cast("long").alias(name), *cols_of(df.columns))
    return placed.select(
        (F.array(*offsets)[part.cast("int")] + row).alias(name), *cols_of(df.columns)
    )


def surrogate_key_onto(
    df: DataFrame,
    previous: DataFrame,
    name: str,
    business_key: Sequence[str],
    order_by: Sequence[Column],
    keep_missing: bool = True,
) -> DataFrame:
    """:func:`surrogate_key` that keeps the keys of a previous load.

    Members that ``previous`` knows by their business key (NULL equals NULL) keep their key
    and get their new attributes; new members are numbered densely behind the highest key.
    Members that are gone keep their row unless ``keep_missing`` is off, because facts may
    refer to it; their keys are not given to others either way.
    """
    known = previous.select(*[col_of(c).alias(f"_old_{i}") for i, c in enumerate(business_key)], F.col(name))
    same = reduce(lambda a, b: a & b, [col_of(c).eqNullSafe(F.col(f"_old_{i}")) for i, c in enumerate(business_key)])
    kept = df.join(known, same).select(name, *cols_of(df.columns))
    highest = previous.agg(F.max(name)).first()[0]  # one number
    added = surrogate_key(df.join(known, same, "left_anti"), name, order_by, start=1 if highest is None else highest + 1)
    result = kept.unionByName(added)
    if not keep_missing:
        return result
    current = df.select(*[col_of(c).alias(f"_new_{i}") for i, c in enumerate(business_key)])
    seen = reduce(lambda a, b: a & b, [col_of(c).eqNullSafe(F.col(f"_new_{i}")) for i, c in enumerate(business_key)])
    return result.unionByName(previous.join(current, seen, "left_anti").select(name, *cols_of(df.columns)))


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def attach_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    key: str,
    null_as: Mapping[str, str] | None = None,
) -> DataFrame:
    """Left-join one surrogate key onto ``fact``; unmatched rows get a NULL key.

    ``on`` maps fact columns to dimension columns.  Columns named in ``null_as`` compare
    with NULL replaced by the given text, so NULL matches NULL *and* that text.

    There is no broadcast hint: a dimension read from a table (or pinned by
    :func:`surrogate_key`) has a known size and is broadcast below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one takes the sort-merge path,
    where AQE splits hot keys.
    """
    pairs = _pairs(on)
    null_as = null_as or {}
    lookup = dim.select(
        *[F.col(d).alias(f"_dim_{i}") for i, d in enumerate(pairs.values())], F.col(key).alias("_dim_key")
    )

    def side(column: Column, fact_name: str) -> Column:
        return F.coalesce(column, F.lit(null_as[fact_name])) if fact_name in null_as else column

    match = reduce(
        lambda a, b: a & b,
        [side(F.col(f), f) == side(F.col(f"_dim_{i}"), f) for i, f in enumerate(pairs)],
    )
    return fact.join(lookup, match, "left").select(*cols_of(fact.columns), F.col("_dim_key").alias(key))


def unmatched_keys(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Distinct natural keys of ``fact`` without a dimension row (NULL keys included).

    Keys are made distinct before the join, so a hot key crosses it once.
    """
    pairs = _pairs(on)
    keys = fact.select(*pairs).distinct()
    members = dim.select(*[F.col(d).alias(f"_dim_{i}") for i, d in enumerate(pairs.values())])
    match = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"_dim_{i}") for i, f in enumerate(pairs)])
    return keys.join(members, match, "left_anti")


def distribution_by_dim(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Fact rows per dimension attribute.

    The fact is counted per key before the join, so only one row per key is joined.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("_rows"))
    joined = per_key.join(dim.select(key, *by), key)
    return joined.groupBy(*by).agg(F.sum("_rows").alias("record_count"))


def build_fact(
    source: DataFrame,
    dims: Sequence[tuple[DataFrame, str | Mapping[str, str], str]],
    columns: Sequence[str],
    level: str | None = None,
) -> DataFrame:
    """Filter one level, attach the dimensions, keep their keys and ``columns``.

    ``dims`` lists (dimension, natural key, surrogate key).
    """
    fact = source if level is None else level_filter(source, level)
    natural = {f for _, on, _ in dims for f in _pairs(on)}
    fact = fact.select(*cols_of(dict.fromkeys([*natural, *columns])))
    for dim, on, key in dims:
        fact = attach_dimension(fact, dim, on, key)
    return fact.select(*[key for _, _, key in dims], *cols_of(columns))
