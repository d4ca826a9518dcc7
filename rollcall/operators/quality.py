"""Data-quality checks.

Every check yields rows of one layout::

    check string, subject string, status string, observed double, expected string, n long

``status`` is ``pass``, ``fail`` or ``info``; ``n`` counts the rows the check is about
(violating rows, NULL rows, duplicated keys).  Checks over the rows of one table are
:class:`Check` objects, and :func:`run_checks` evaluates any number of them in a single
pass.  :func:`violations` gives the rows behind a check.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.shape import col_of, cols_of, component_pivot

REPORT_SCHEMA = "check string, subject string, status string, observed double, expected string, n bigint"


@dataclass(frozen=True)
class Check:
    """One output row: aggregates over a table, and the predicate of the rows counted."""

    check: str
    subject: str
    rows: Column
    observed: Column | None = None
    expected: str = ""
    passed: Column | None = None

    def row(self) -> Column:
        n = F.count_if(self.rows)
        observed = n if self.observed is None else self.observed
        status = F.lit("info")
        if self.passed is not None:
            status = F.when(F.coalesce(self.passed, F.lit(True)), "pass").otherwise("fail")
        return F.struct(
            F.lit(self.check).alias("check"),
            F.lit(self.subject).alias("subject"),
            status.alias("status"),
            observed.cast("double").alias("observed"),
            F.lit(self.expected).alias("expected"),
            n.cast("long").alias("n"),
        )


def no_rows(check: str, subject: str, rows: Column, expected: str = "") -> Check:
    """A check that fails if any row matches."""
    return Check(check, subject, rows, expected=expected, passed=F.count_if(rows) == 0)


def run_checks(df: DataFrame, *checks: Check | Iterable[Check]) -> DataFrame:
    """Evaluate all checks in one aggregation and return one row per check."""
    flat = [c for item in checks for c in ([item] if isinstance(item, Check) else item)]
    report = df.agg(F.array(*[c.row() for c in flat]).alias("_report"))
    return report.select(F.inline("_report"))


def violations(df: DataFrame, check: Check, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows a check counts."""
    rows = df.filter(check.rows)
    return rows if columns is None else rows.select(*cols_of(columns))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 2))


# -- keys ---------------------------------------------------------------------------


def null_keys(keys: Sequence[str]) -> list[Check]:
    return [no_rows("null_key", k, col_of(k).isNull(), "0") for k in keys]


def null_foreign_keys(keys: Sequence[str]) -> list[Check]:
    """Fact rows without a dimension row; observed is their percentage."""
    out = []
    for k in keys:
        missing = col_of(k).isNull()
        n = F.count_if(missing)
        out.append(Check("null_fk", k, missing, _percent(n, F.count("*")), "0", n == 0))
    return out


def key_format(column: str) -> Check:
    """Keys must be present and contain an underscore."""
    key = col_of(column)
    bad = key.isNull() | (key == "") | ~key.like(r"%\_%")
    return no_rows("key_format", column, bad, "%_%")


def key_unique(df: DataFrame, keys: Sequence[str], subject: str = "") -> DataFrame:
    """``n`` duplicated keys, ``observed`` surplus rows.  Counts are partial before the
    shuffle, so a hot key costs one row per task."""
    per_key = df.groupBy(*cols_of(keys)).agg(F.count("*").alias("_rows"))
    check = Check(
        "key_unique",
        subject or ",".join(keys),
        F.col("_rows") > 1,
        F.coalesce(F.sum("_rows") - F.count("*"), F.lit(0)),
        "0",
        F.count_if(F.col("_rows") > 1) == 0,
    )
    return run_checks(per_key, check)


# -- NULLs and text -------------------------------------------------------------------


def suppression_rate(columns: Sequence[str]) -> list[Check]:
    """NULL rows per measure; observed is their percentage."""
    return [
        Check("suppression", c, col_of(c).isNull(), _percent(F.count_if(col_of(c).isNull()), F.count("*")))
        for c in columns
    ]


def missing_attributes(columns: Sequence[str]) -> list[Check]:
    """Descriptive text that is NULL or empty."""
    return [Check("missing_attr", c, col_of(c).isNull() | (col_of(c) == "")) for c in columns]


def unparsed_values(cleaned: Mapping[str, tuple[Column, Iterable[str]]]) -> list[Check]:
    """Raw cells that are no suppression code and still clean to NULL.

    ``cleaned`` maps a raw column to its cleaning expression and codes.
    """
    from rollcall.functions.cleanse import unparsed

    return [
        no_rows("unparsed", raw, unparsed(col_of(raw), expression, tuple(codes)), "0")
        for raw, (expression, codes) in cleaned.items()
    ]


def null_summary(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column that has NULLs, in one pass."""
    total = F.count("*")
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(col_of(c).isNull()).cast("long").alias("null_count"),
            _percent(F.count_if(col_of(c).isNull()), total).alias("null_percent"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells")).filter("null_count > 0")


# -- values -----------------------------------------------------------------------------


def in_range(bounds: Mapping[str, tuple[float | None, float | None]]) -> list[Check]:
    """Smallest and largest value against the bounds; ``n`` rows lie outside."""
    out = []
    for c, (low, high) in bounds.items():
        value = col_of(c).cast("double")
        below = F.lit(False) if low is None else value < low
        above = F.lit(False) if high is None else value > high
        text = f"{'' if low is None else low}..{'' if high is None else high}"
        for name, extreme, outside in (("min", F.min(value), below), ("max", F.max(value), above)):
            out.append(Check(f"range_{name}", c, outside, extreme, text, F.count_if(outside) == 0))
    return out


def non_negative(columns: Sequence[str]) -> list[Check]:
    return [
        Check("non_negative", c, col_of(c) < 0, F.min(col_of(c)), ">= 0", F.min(col_of(c)) >= 0) for c in columns
    ]


def sign_profile(columns: Sequence[str]) -> list[Check]:
    """Zero and negative values; observed is their share of the known values."""
    out = []
    for c in columns:
        for name, rows in (("zero", col_of(c) == 0), ("negative", col_of(c) < 0)):
            out.append(Check(name, c, rows, _percent(F.count_if(rows), F.count(col_of(c)))))
    return out


def _sum_of(parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, cols_of(parts))


def parts_sum(parts: Sequence[str], total: str | float, tolerance: float = 0.0, subject: str = "") -> Check:
    """Parts add up to a column or constant; rows with a NULL part are not judged."""
    whole = col_of(total) if isinstance(total, str) else F.lit(total)
    off = F.abs(_sum_of(parts) - whole) > tolerance
    expected = f"{total} +- {tolerance}"
    return no_rows("parts_sum", subject or "+".join(parts), off, expected)


def subset_le_total(part: str, total: str) -> Check:
    return no_rows("subset_le_total", f"{part}<={total}", col_of(part) > col_of(total), "0")


def composite_inconsistent(
    df: DataFrame,
    by: Sequence[str],
    component: str,
    composite: str,
    parts: Sequence[str],
    measure: str,
    tolerance: float = 0.5,
) -> DataFrame:
    """Groups whose composite differs from the mean of its parts by more than the
    tolerance; groups with a missing component are not judged."""
    wide = component_pivot(df, by, component, [composite, *parts], measure).dropna(subset=[composite, *parts])
    mean = _sum_of(parts) / len(parts)
    return (
        wide.withColumn("calculated_composite", mean)
        .withColumn("diff", F.abs(col_of(composite) - F.col("calculated_composite")))
        .filter(F.col("diff") > tolerance)
    )


def composite_consistent(df: DataFrame, by, component, composite, parts, measure, tolerance=0.5) -> DataFrame:
    """Report row for :func:`composite_inconsistent`."""
    bad = composite_inconsistent(df, by, component, composite, parts, measure, tolerance)
    return run_checks(bad, no_rows("composite", composite, F.lit(True), f"mean +- {tolerance}"))


# -- volumes ------------------------------------------------------------------------------


def reconcile(raw: DataFrame, removed: DataFrame, built: DataFrame, subject: str = "rows") -> DataFrame:
    """Raw rows minus removed rows equal built rows; ``removed`` holds one row with the
    column ``removed_rows`` (see ``dedup_report``)."""
    zero = F.lit(0).cast("long")
    counted = (
        raw.agg(F.count("*").alias("raw"), zero.alias("gone"), zero.alias("built"))
        .unionByName(removed.agg(zero.alias("raw"), F.sum("removed_rows").alias("gone"), zero.alias("built")))
        .unionByName(built.agg(zero.alias("raw"), zero.alias("gone"), F.count("*").alias("built")))
    )
    difference = F.sum("raw") - F.sum("gone") - F.sum("built")
    return counted.agg(
        F.lit("reconcile").alias("check"),
        F.lit(subject).alias("subject"),
        F.when(difference == 0, "pass").otherwise("fail").alias("status"),
        F.sum("built").cast("double").alias("observed"),
        F.concat_ws(" - ", F.sum("raw"), F.sum("gone")).alias("expected"),
        F.abs(difference).alias("n"),
    )


def combine(*reports: DataFrame) -> DataFrame:
    """One report out of several."""
    return reduce(lambda a, b: a.unionByName(b), reports)
