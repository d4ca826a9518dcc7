"""Report queries on the typed tables, with their usual parameters as defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators import summary as S
from rollcall.operators.shape import col_of, level_filter

# Fixed value: the label of the total group in the rate reports.
RATE_TOTAL_LABEL = "ALL Students"


def chronic_absence_trend(attendance: DataFrame) -> DataFrame:
    """Statewide chronic absence by year."""
    rows = level_filter(attendance, "State").filter("chronic_absent_perc_all IS NOT NULL")
    return rows.select("school_year", "chronic_absent_perc_all").orderBy("school_year")


def worst_chronic_absence(attendance: DataFrame, year: str, n: int = 10) -> DataFrame:
    """Schools with the highest chronic absence in a year."""
    columns = ["institution_name", "district_name", "student_count_all", "chronic_absent_perc_all"]
    known = (
        (F.col("school_year") == year)
        & (F.col("detail_level") == "School")
        & F.col("chronic_absent_perc_all").isNotNull()
    )
    return S.top_n(attendance, "chronic_absent_perc_all", n, ["institution_key"], known, columns)


def _state_rates(df: DataFrame, group: str, value: str) -> DataFrame:
    total = (F.col("subgroup_label") == RATE_TOTAL_LABEL) & (col_of(group) == value)
    return level_filter(df, "State").filter(total).orderBy("school_year")


def dropout_trend(dropout: DataFrame, grade_range: str = "9-12") -> DataFrame:
    columns = ["school_year", "dropout_count", "dropout_rate"]
    return _state_rates(dropout, "grade_range", grade_range).select(*columns)


def graduation_trend(graduation: DataFrame, cohort: str = "4-Year") -> DataFrame:
    columns = ["school_year", "graduate_count", "graduation_rate", "cohort_count"]
    return _state_rates(graduation, "cohort_type", cohort).select(*columns)


def compare_groups(df: DataFrame, group: str, year: str, measures: list[str]) -> DataFrame:
    """Statewide totals of one year side by side per cohort type or grade range."""
    rows = level_filter(df, "State").filter(
        (F.col("school_year") == year) & (F.col("subgroup_label") == RATE_TOTAL_LABEL)
    )
    return rows.select(group, *measures).orderBy(group)


def subgroup_ranking(df: DataFrame, rate: str, count: str, group: str, value: str, year: str) -> DataFrame:
    """Statewide subgroups of one year by rate."""
    rows = (
        (F.col("school_year") == year) & (col_of(group) == value) & (F.col("detail_level") == "State")
    )
    return S.ranking(df, rate, ["subgroup_label", rate, count], rows)


def direct_certification_trend(direct: DataFrame) -> DataFrame:
    """Mean district percentage per year."""
    known = "detail_level = 'District' AND direct_cert_percent IS NOT NULL"
    return S.yearly_trend(direct, ["direct_cert_percent"], ("school_year", "fiscal_year"), known)


def demographic_trend(enrollment: DataFrame) -> DataFrame:
    """Mean district shares per year, over districts with a known poverty share."""
    measures = ["pct_economically_disadvantaged", "pct_english_learner", "pct_students_with_disabilities"]
    known = "detail_level = 'District' AND pct_economically_disadvantaged IS NOT NULL"
    return S.yearly_trend(enrollment, measures, predicate=known)


def enrollment_totals(enrollment: DataFrame, period: str = "Fall") -> DataFrame:
    """School enrollment of a period, summed per year."""
    rows = level_filter(enrollment, "School").filter(
        (F.col("enrollment_period") == period) & F.col("enrollment_count").isNotNull()
    )
    return S.distribution(rows, ["school_year"], {"total_enrollment": F.sum("enrollment_count")})


def category_totals(revenues: DataFrame) -> DataFrame:
    """Rows, total and mean amount per type and category, largest total first."""
    aggs = {"total_amount": F.sum("amount"), "avg_amount": F.avg("amount")}
    totals = S.group_profile(revenues, ["revenue_expenditure_type", "category"], aggs)
    return totals.orderBy(F.desc_nulls_last("total_amount"), "revenue_expenditure_type", "category")


def type_totals(revenues: DataFrame) -> DataFrame:
    """Rows, categories and total amount per type."""
    aggs = {"unique_categories": F.count_distinct("category"), "total_amount": F.sum("amount")}
    return S.distribution(revenues, ["revenue_expenditure_type"], aggs)


def revenue_coverage(revenues: DataFrame) -> DataFrame:
    """Districts, schools and source files per year, to spot an incomplete year."""
    school = F.when(F.col("detail_level") == "School", F.col("institution_key"))
    entities = {
        "districts": F.col("district_code"),
        "schools": school,
        "source_files": F.col("source_file"),
    }
    return S.year_gap(revenues, "school_year", entities)


def staffing_zeros(personnel: DataFrame, by: list[str]) -> DataFrame:
    """Zero staff counts per category, type or year."""
    return S.drilldown(personnel, "staff_count = 0", by)


def negative_amounts(revenues: DataFrame) -> DataFrame:
    """Negative amounts per type and category, with their sum."""
    by = ["revenue_expenditure_type", "category"]
    return S.drilldown(revenues, "amount < 0", by, {"total_negative_amount": F.sum("amount")})
