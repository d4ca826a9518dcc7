"""Aggregates as tables of mergeable state: kept per file or year, so that new data adds rows.

A state is computed over new data alone, appended to the states kept so far, and the merged
result equals the aggregate over all data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.shape import col_of, cols_of


def profile_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Rows, non-NULL values, min, max, mean, sum and squared deviations per column and part."""

    def part(c: str) -> Column:
        value = col_of(c).cast("double")
        n = F.count(value)
        return F.struct(
            F.lit(c).alias("measure"),
            F.count(F.lit(1)).alias("rows"),
            n.alias("n"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.avg(value).alias("mean_value"),
            F.sum(value).alias("total_value"),
            (F.var_pop(value) * n).alias("deviation"),
        )

    grouped = df.groupBy(*cols_of(by)).agg(F.array(*[part(c) for c in columns]).alias("_parts"))
    return grouped.select(*cols_of(by), F.inline("_parts"))


def merge_profiles(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The numeric profile of all parts together, with the share of missing values.

    Squared deviations add up around the common mean (Chan et al.), so nothing cancels.
    """
    keys = [*by, "measure"]
    whole = Window.partitionBy(*cols_of(keys))
    centre = F.sum(F.col("mean_value") * F.col("n")).over(whole) / F.sum("n").over(whole)
    apart = F.col("deviation") + F.col("n") * (F.col("mean_value") - F.col("_centre")) ** 2
    merged = state.withColumn("_centre", centre).groupBy(*cols_of(keys)).agg(
        F.sum("n").alias("n"),
        (F.sum("rows") - F.sum("n")).alias("n_missing"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.first("_centre").alias("mean_value"),
        F.sum(apart).alias("_apart"),
        F.sum("total_value").alias("total_value"),
    )
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("_apart") / (F.col("n") - 1)))
    return merged.select(
        *cols_of(keys), "n", "n_missing", "min_value", "max_value", "mean_value", spread.alias("stddev_value"), "total_value"
    )


def distinct_state(df: DataFrame, by: Sequence[str], codes: Mapping[str, str]) -> DataFrame:
    """Bitmaps of the codes that occur per part: exact distinct values without keeping them.

    ``codes`` maps an output name to a column of dense non-negative numbers, such as the
    surrogate key of a dimension.  A bitmap covers 32768 codes in 4 kB; a task sends one per
    part and range of codes that it has seen, whatever its rows, and rows are not expanded.
    """

    def bitmaps(name: str, column: str) -> DataFrame:
        known = df.filter(col_of(column).isNotNull())
        code = col_of(column).cast("long") + 1  # buckets count from 1
        return (
            known.groupBy(*cols_of(by), F.bitmap_bucket_number(code).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("bitmap"))
            .select(*cols_of(by), F.lit(name).alias("entity"), "bucket", "bitmap")
        )

    return reduce(lambda a, b: a.unionByName(b), [bitmaps(name, column) for name, column in codes.items()])


def merge_distinct(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values per entity and ``by``, over all parts of the state."""
    merged = state.groupBy(*cols_of([*by, "entity", "bucket"])).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*cols_of([*by, "entity"])).agg(F.sum(F.bitmap_count("bitmap")).alias("values"))
