"""Validation of each typed table and fact: which checks apply where."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from rollcall.operators import quality as Q
from rollcall.operators.dedup import dedup_report
from rollcall.operators.shape import union_with_drift
from rollcall.plans import feeds
from rollcall.plans.reconcile import feed_parts

PERCENT = (0, 100)
ACT_SCALE = (1, 36)
_LEVEL_COUNTS = tuple(f"{n.lower()}_count" for n in feeds.PROFICIENCY_LEVELS)
_LEVEL_SHARES = tuple(f"{n.lower()}_pct" for n in feeds.PROFICIENCY_LEVELS)
_ABSENCE_BUCKETS = ("five_or_fewer_percent_all", "six_to_fifteen_percent_all", "over_15_percent_all")
_ACT_PARTS = ("English", "Mathematics", "Reading", "Science")
_ENROLLMENT_SHARES = tuple(f"pct_{n}" for n in feeds.ENROLLMENT_SHARES.values())


def _assessment_checks() -> list[Q.Check]:
    return [
        *Q.suppression_rate(["num_tested", "proficient_pct"]),
        Q.parts_sum(_LEVEL_COUNTS, "num_tested", subject="level counts"),
        Q.parts_sum(_LEVEL_SHARES, 100.0, 0.5, subject="level shares"),
    ]


# Row checks of each typed table; all of a table run in one pass.
SILVER_CHECKS: dict[str, Callable[[], list[Q.Check]]] = {
    "act": lambda: Q.suppression_rate(["institution_num_tested", "institution_avg_score"]),
    "attendance": lambda: [
        *Q.suppression_rate(["student_count_all", "chronic_absent_perc_all"]),
        *Q.in_range({"chronic_absent_perc_all": PERCENT}),
        Q.parts_sum(_ABSENCE_BUCKETS, 100.0, 1.0, subject="absence buckets"),
    ],
    "certified_personnel": lambda: [
        *Q.suppression_rate(["staff_count"]),
        *Q.sign_profile(["staff_count"]),
        Q.key_format("institution_key"),
    ],
    "direct_certification": lambda: [
        *Q.suppression_rate(["direct_cert_percent", "poverty_student_count", "total_student_count"]),
        *Q.in_range({"direct_cert_percent": PERCENT}),
        Q.subset_le_total("poverty_student_count", "total_student_count"),
    ],
    "dropout_rate": lambda: [
        *Q.suppression_rate(["dropout_count", "dropout_rate"]),
        *Q.in_range({"dropout_rate": PERCENT}),
    ],
    "enrollment_by_grade": lambda: [
        *Q.suppression_rate(["enrollment_count"]),
        *Q.non_negative(["enrollment_count"]),
    ],
    "enrollment_by_subgroup": lambda: [
        *Q.suppression_rate(["pct_economically_disadvantaged"]),
        *Q.in_range({c: PERCENT for c in _ENROLLMENT_SHARES}),
    ],
    "eoc": _assessment_checks,
    "eog": _assessment_checks,
    "graduation_rate": lambda: [
        *Q.suppression_rate(["graduate_count", "graduation_rate"]),
        *Q.in_range({"graduation_rate": PERCENT}),
        *Q.non_negative(["graduate_count"]),
    ],
    "revenues": lambda: [
        *Q.suppression_rate(["amount_per_fte"]),
        *Q.sign_profile(["amount"]),
        Q.key_format("institution_key"),
    ],
    "sat": lambda: [
        *Q.suppression_rate(["district_code", "institution_num_tested", "institution_avg_score"]),
    ],
}

_SCHOOL_YEAR = ["school_key", "year_key"]
_WITH_SUBGROUP = [*_SCHOOL_YEAR, "subgroup_key"]
FACT_KEYS = {
    "fact_attendance": _SCHOOL_YEAR,
    "fact_dropout": _WITH_SUBGROUP,
    "fact_enrollment": _SCHOOL_YEAR,
    "fact_enrollment_by_grade": _SCHOOL_YEAR,
    "fact_graduation": _WITH_SUBGROUP,
    "fact_revenues": _SCHOOL_YEAR,
    "fact_school_performance": [*_WITH_SUBGROUP, "assessment_key"],
    "fact_staffing": _SCHOOL_YEAR,
}
FACT_GRAIN = {
    "fact_attendance": _SCHOOL_YEAR,
    "fact_dropout": [*_WITH_SUBGROUP, "grade_range"],
    "fact_enrollment": _SCHOOL_YEAR,
    "fact_enrollment_by_grade": [*_SCHOOL_YEAR, "enrollment_period", "grade_level"],
    "fact_graduation": [*_WITH_SUBGROUP, "cohort_type"],
    "fact_revenues": [*_SCHOOL_YEAR, "revenue_expenditure_type", "category"],
    "fact_school_performance": [*_WITH_SUBGROUP, "assessment_key"],
    "fact_staffing": [*_SCHOOL_YEAR, "employee_type", "data_category", "data_sub_category"],
}
FACT_CHECKS: dict[str, Callable[[], list[Q.Check]]] = {
    "fact_attendance": lambda: [
        *Q.in_range({c: PERCENT for c in ("chronic_absent_perc_all", "five_or_fewer_pct_all", "over_15_pct_all")}),
        *Q.suppression_rate(["student_count_all"]),
    ],
    "fact_dropout": lambda: Q.in_range({"dropout_rate": PERCENT}),
    "fact_enrollment": lambda: Q.in_range(
        {c: PERCENT for c in ("pct_economically_disadvantaged", "pct_english_learner", "pct_gifted")}
    ),
    "fact_enrollment_by_grade": lambda: Q.suppression_rate(["enrollment_count"]),
    "fact_graduation": lambda: Q.in_range({"graduation_rate": PERCENT}),
    "fact_revenues": lambda: Q.sign_profile(["amount"]),
    "fact_school_performance": lambda: Q.suppression_rate(["num_tested", "avg_score", "proficiency_rate"]),
    "fact_staffing": lambda: Q.sign_profile(["staff_count"]),
}


def validate_silver(name: str, silver: DataFrame) -> DataFrame:
    """Row checks, key uniqueness and, for ACT, scale and composite checks."""
    reports = [
        Q.run_checks(silver, SILVER_CHECKS[name]()),
        Q.key_unique(silver, feeds.SILVER_KEYS[name], name),
    ]
    if name == "act":
        composite = silver.filter("test_component = 'Composite'")
        reports.append(Q.run_checks(composite, Q.in_range({"institution_avg_score": ACT_SCALE})))
        reports.append(
            Q.composite_consistent(
                silver.filter("school_year >= '2020-21'"),
                ["school_year", "institution_key", "institution_name", "subgroup"],
                "test_component",
                "Composite",
                _ACT_PARTS,
                "institution_avg_score",
            )
        )
    return Q.combine(*reports)


def reconcile_silver(name: str, raw: Mapping[str, DataFrame], silver: DataFrame) -> DataFrame:
    """Raw rows minus duplicates equal typed rows, for feeds with one business key.

    Rows that a feed leaves out before de-duplication (no year, no district) are not
    part of the raw side.
    """
    parts = feed_parts(name, raw)
    kept = [feed.prepared(df) for feed, df in parts]
    removed = union_with_drift([dedup_report(df, feed.key) for (feed, _), df in zip(parts, kept, strict=True)])
    return Q.reconcile(union_with_drift(kept), removed, silver, name)


def validate_fact(name: str, fact: DataFrame) -> DataFrame:
    """Foreign keys and row checks in one pass, and the grain."""
    checks = [*Q.null_foreign_keys(FACT_KEYS[name]), *FACT_CHECKS[name]()]
    return Q.combine(Q.run_checks(fact, checks), Q.key_unique(fact, FACT_GRAIN[name], name))


def validate_school_dimension(dim: DataFrame) -> DataFrame:
    """Key presence and uniqueness, and missing text."""
    key = "institution_key"
    checks = [*Q.null_keys([key]), *Q.missing_attributes(["institution_name", "grades_served"])]
    return Q.combine(Q.run_checks(dim, checks), Q.key_unique(dim, [key], "dim_school"))

