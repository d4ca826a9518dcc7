"""The eight fact tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cleanse import typed_null
from rollcall.operators.conform import conform
from rollcall.operators.shape import drop_zero_padding, level_filter
from rollcall.operators.star import attach_dimension, build_fact
from rollcall.plans.dims import relabel
from rollcall.plans.feeds import ATTENDANCE_SUBGROUPS, ENROLLMENT_PROGRAMS, ENROLLMENT_SHARES

_SCHOOL = ("institution_key", "school_key")
_YEAR = ("school_year", "year_key")
_SUBGROUP = ("subgroup", "subgroup_key")

# Fixed value: the one subgroup whose raw name is cut short.
FACT_SUBGROUP_NAMES = {"hispani": "hispanic"}
# The pre-kindergarten share is the only program share the enrollment fact leaves out.
FACT_PROGRAMS = tuple(name for name, _ in ENROLLMENT_PROGRAMS.values() if name != "special_ed_pk")
PERFORMANCE_DIMENSIONS = ("assessment_name", "subject", "grade", "assessment_format", "score_type")


def _by_school_and_year(dims: Mapping[str, DataFrame]):
    return [(dims["school"], *_SCHOOL), (dims["year"], *_YEAR)]


def attendance_measures() -> list[Column]:
    """All five metrics for all students, count and chronic absence for the other groups."""
    out = [
        F.col("student_count_all"),
        F.col("five_or_fewer_percent_all").alias("five_or_fewer_pct_all"),
        F.col("six_to_fifteen_percent_all").alias("six_to_fifteen_pct_all"),
        F.col("over_15_percent_all").alias("over_15_pct_all"),
        F.col("chronic_absent_perc_all"),
    ]
    for raw in ATTENDANCE_SUBGROUPS[1:]:
        group = raw.lower()
        name = FACT_SUBGROUP_NAMES.get(group, group)
        for metric in ("student_count", "chronic_absent_perc"):
            out.append(F.col(f"{metric}_{group}").alias(f"{metric}_{name}"))
    return out


def fact_attendance(attendance: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    rows = level_filter(attendance, "School").select("institution_key", "school_year", *attendance_measures())
    measures = rows.columns[2:]
    return build_fact(rows, _by_school_and_year(dims), measures).select(*measures, "school_key", "year_key")


def fact_enrollment(enrollment: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    shares = [f"pct_{name}" for name in (*ENROLLMENT_SHARES.values(), *FACT_PROGRAMS)]
    return build_fact(enrollment, _by_school_and_year(dims), shares, level="School")


def fact_enrollment_by_grade(
    enrollment: DataFrame, dims: Mapping[str, DataFrame], zero_padding: bool = True
) -> DataFrame:
    """``zero_padding=False`` drops the zeros that mean "not offered" (2017 to 2022)."""
    if not zero_padding:
        enrollment = drop_zero_padding(enrollment)
    columns = ["enrollment_period", "grade_level", "enrollment_count"]
    return build_fact(enrollment, _by_school_and_year(dims), columns, level="School")


def _subgroup_fact(source, dims, columns, labels) -> DataFrame:
    rows = source.withColumnRenamed("subgroup_label", "subgroup")
    if labels:
        rows = relabel(rows, "subgroup", labels)
    joined = [*_by_school_and_year(dims), (dims["subgroup"], *_SUBGROUP)]
    return build_fact(rows, joined, columns, level="School")


def fact_dropout(
    dropout: DataFrame, dims: Mapping[str, DataFrame], labels: dict[str, str] | None = None
) -> DataFrame:
    """Subgroup labels match exactly; ``labels`` maps other spellings first."""
    return _subgroup_fact(dropout, dims, ["grade_range", "dropout_count", "dropout_rate"], labels)


def fact_graduation(
    graduation: DataFrame, dims: Mapping[str, DataFrame], labels: dict[str, str] | None = None
) -> DataFrame:
    columns = ["cohort_type", "graduate_count", "graduation_rate", "cohort_count"]
    return _subgroup_fact(graduation, dims, columns, labels)


def fact_revenues(revenues: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    columns = ["revenue_expenditure_type", "category", "amount", "amount_per_fte"]
    return build_fact(revenues, _by_school_and_year(dims), columns, level="School")


def fact_staffing(personnel: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """All levels: the personnel feed has no level column."""
    columns = ["employee_type", "data_category", "data_sub_category", "staff_count"]
    return build_fact(personnel, _by_school_and_year(dims), columns)


def proficiency_rate() -> Column:
    return F.col("proficient_pct") + F.col("distinguished_pct")


def _state_layout(name: str, grade: Column) -> dict[str, Column]:
    """State tests have no score; the proficiency rate stands in for it."""
    return {
        "institution_key": F.col("institution_key"),
        "school_year": F.col("school_year"),
        "subgroup": F.col("subgroup_name"),
        "subject": F.col("test_component"),
        "grade": grade,
        "num_tested": F.col("num_tested").cast("double"),
        "proficiency_rate": proficiency_rate().cast("double"),
        "avg_score": proficiency_rate().cast("double"),
        "participation_rate": typed_null("double"),
        "assessment_name": F.lit(name),
        "assessment_format": typed_null("string"),
        "score_type": typed_null("string"),
    }


def _college_layout(name: str, test_format: Column) -> dict[str, Column]:
    return {
        "institution_key": F.col("institution_key"),
        "school_year": F.col("school_year"),
        "subgroup": F.col("subgroup"),
        "subject": F.col("test_component"),
        "grade": typed_null("string"),
        "num_tested": F.col("institution_num_tested").cast("double"),
        "avg_score": F.col("institution_avg_score"),
        "proficiency_rate": typed_null("double"),
        "participation_rate": typed_null("double"),
        "assessment_name": F.lit(name),
        "assessment_format": test_format,
        "score_type": F.col("highest_recent_indicator"),
    }


def conform_assessments(
    eog: DataFrame, eoc: DataFrame, sat: DataFrame, act: DataFrame, keep_grade: bool = False
) -> DataFrame:
    """The four test feeds in one layout; ``keep_grade`` keeps the course grade."""
    return conform(
        [
            (eog, _state_layout("EOG", F.col("grade_level"))),
            (eoc, _state_layout("EOC", F.col("grade_level") if keep_grade else typed_null("string"))),
            (sat, _college_layout("SAT", F.col("sat_format"))),
            (act, _college_layout("ACT", typed_null("string"))),
        ]
    )


def performance_with_dimensions(tests: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Conformed tests with all four surrogate keys and their natural keys."""
    for name, (on, key) in {"school": _SCHOOL, "year": _YEAR, "subgroup": _SUBGROUP}.items():
        tests = attach_dimension(tests, dims[name], on, key)
    on = {c: "grade_level" if c == "grade" else c for c in PERFORMANCE_DIMENSIONS}
    nullable = {c: "" for c in ("grade", "assessment_format", "score_type")}
    return attach_dimension(tests, dims["assessment"], on, "assessment_key", null_as=nullable)


def fact_school_performance(
    eog: DataFrame,
    eoc: DataFrame,
    sat: DataFrame,
    act: DataFrame,
    dims: Mapping[str, DataFrame],
) -> DataFrame:
    """Row-preserving: several course grades may share one grain."""
    rows = performance_with_dimensions(conform_assessments(eog, eoc, sat, act), dims)
    return rows.select(
        "school_key",
        "year_key",
        "subgroup_key",
        "assessment_key",
        "num_tested",
        "avg_score",
        "proficiency_rate",
        "participation_rate",
    )


# Fact table: (silver tables it reads, builder).
FACTS = {
    "fact_attendance": (("attendance",), fact_attendance),
    "fact_dropout": (("dropout_rate",), fact_dropout),
    "fact_enrollment": (("enrollment_by_subgroup",), fact_enrollment),
    "fact_enrollment_by_grade": (("enrollment_by_grade",), fact_enrollment_by_grade),
    "fact_graduation": (("graduation_rate",), fact_graduation),
    "fact_revenues": (("revenues",), fact_revenues),
    "fact_school_performance": (("eog", "eoc", "sat", "act"), fact_school_performance),
    "fact_staffing": (("certified_personnel",), fact_staffing),
}
