"""The four dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cleanse import typed_null
from rollcall.functions.labels import TOTAL_SUBGROUP, subgroup_category, year_end, year_start
from rollcall.operators.conform import conform
from rollcall.operators.history import attribute_spans, scd2_history, scd_current
from rollcall.operators.shape import cols_of
from rollcall.operators.star import surrogate_key, surrogate_key_onto

# Fixed value: first year of the data, the start of every current school row.
EARLIEST_YEAR = "2010-11"
SCHOOL_ATTRIBUTES = (
    "institution_number",
    "institution_name",
    "district_code",
    "district_name",
    "detail_level",
    "grades_served",
)
_PRIORITY = "_priority"


def _numbered(
    members: DataFrame, key: str, business_key: Sequence[str], order: Sequence[Column], previous: DataFrame | None
) -> DataFrame:
    """Members with their key; those of a previous dimension keep it."""
    if previous is None:
        return surrogate_key(members, key, order)
    return surrogate_key_onto(members, previous, key, business_key, order)


def dim_year(*sources: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row per school year of the sources."""
    years = reduce(lambda a, b: a.unionByName(b), [s.select("school_year") for s in sources]).distinct()
    year = F.col("school_year")
    members = years.select(
        "school_year",
        year_start(year).alias("start_calendar_year"),
        year_end(year).alias("end_calendar_year"),
        year_end(year).alias("fiscal_year"),
        year_end(year).alias("sort_order"),
    )
    order = [F.asc_nulls_first("sort_order"), F.asc_nulls_first("school_year")]
    return _numbered(members, "year_key", ["school_year"], order, previous)


def subgroup_members(eog: DataFrame) -> DataFrame:
    label = F.col("subgroup")
    members = eog.select(F.col("subgroup_name").alias("subgroup")).distinct()
    return members.select(
        "subgroup",
        subgroup_category(label).alias("subgroup_category"),
        F.coalesce(label == TOTAL_SUBGROUP, F.lit(False)).alias("is_total"),
    )


def dim_subgroup(eog: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row per subgroup label, with its category."""
    order = [F.asc_nulls_first("subgroup_category"), F.asc_nulls_first("subgroup")]
    return _numbered(subgroup_members(eog), "subgroup_key", ["subgroup"], order, previous)


def _assessment(name: str, category: str, **known: Column) -> dict[str, Column]:
    layout = {"assessment_name": F.lit(name), "subject": F.col("test_component")}
    for c in ("grade_level", "assessment_format", "score_type"):
        layout[c] = known.get(c, typed_null("string"))
    return {**layout, "assessment_category": F.lit(category)}


def assessment_members(eog: DataFrame, eoc: DataFrame, sat: DataFrame, act: DataFrame) -> DataFrame:
    """Distinct assessments: end-of-grade by grade, SAT by format and score, ACT by score."""
    score = F.col("highest_recent_indicator")
    return conform(
        [
            (eog, _assessment("EOG", "State", grade_level=F.col("grade_level"))),
            (eoc, _assessment("EOC", "State")),
            (
                sat,
                _assessment(
                    "SAT", "College Readiness", assessment_format=F.col("sat_format"), score_type=score
                ),
            ),
            (act, _assessment("ACT", "College Readiness", score_type=score)),
        ]
    ).distinct()


def dim_assessment(
    eog: DataFrame, eoc: DataFrame, sat: DataFrame, act: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    members = assessment_members(eog, eoc, sat, act)
    columns = ("assessment_category", "assessment_name", "grade_level", "subject", "assessment_format", "score_type")
    return _numbered(members, "assessment_key", columns, [F.asc_nulls_first(c) for c in columns], previous)


def school_versions(*sources: DataFrame) -> DataFrame:
    """School attributes per year; sources listed first win a tie within a year."""
    columns = cols_of(("institution_key", *SCHOOL_ATTRIBUTES, "school_year"))
    frames = [s.select(*columns, F.lit(i).alias(_PRIORITY)) for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b), frames)


def dim_school(*sources: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Current attributes per institution (type 2 columns are constant).

    No distinct is needed first: the latest-row rank already drops copies before the
    shuffle.
    """
    current = scd_current(
        school_versions(*sources),
        ["institution_key"],
        "school_year",
        EARLIEST_YEAR,
        tie_break=[F.asc(_PRIORITY)],
    ).drop(_PRIORITY)
    return _numbered(current, "school_key", ["institution_key"], [F.asc_nulls_first("institution_key")], previous)


def school_spans(*sources: DataFrame) -> DataFrame:
    """First and last year of each attribute set of a school."""
    return attribute_spans(
        school_versions(*sources), ["institution_key", *SCHOOL_ATTRIBUTES], "school_year"
    )


def school_history(*sources: DataFrame) -> DataFrame:
    """Type 2 history of the schools."""
    return scd2_history(
        school_versions(*sources),
        ["institution_key"],
        SCHOOL_ATTRIBUTES,
        "school_year",
        priority=[_PRIORITY],
    )


def relabel(df: DataFrame, column: str, labels: dict[str, str]) -> DataFrame:
    """Map known labels to the spelling of the dimension; others stay."""
    return df.replace(labels, subset=[column])


def dim_profile(dim: DataFrame, key: str = "institution_key", names: Sequence[str] = ()) -> DataFrame:
    """Members, districts, and missing text per level of the school dimension."""
    missing = {c: F.count_if(F.col(c).isNull() | (F.col(c) == "")) for c in names}
    return dim.groupBy("detail_level").agg(
        F.count("*").alias("members"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_distinct("district_code").alias("districts"),
        *[c.alias(f"missing_{name}") for name, c in missing.items()],
    )
