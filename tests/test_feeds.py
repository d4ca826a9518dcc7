"""Schemas of the typed tables, dimensions and facts, and edge cases of single feeds."""

import pytest

from rollcall.plans import facts, reports
from rollcall.plans.checks import SILVER_CHECKS, reconcile_silver, validate_fact, validate_silver
from rollcall.plans.dims import dim_year, relabel
from rollcall.plans.feeds import SILVER_KEYS, SILVER_SOURCES, build_sat, build_silver
from tests.conftest import rows_of
from workload.feed_queries import dimension, fact, raw_tables, silver
from workload.registry import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


S, I, D = "string", "int", "double"
PLACE = {
    "school_year": S, "detail_level": S, "district_code": S, "district_name": S, "institution_number": S,
    "institution_name": S, "grades_served": S,
}
TAIL = {"source_year": S, "source_file": S}
COUNTS = {
    "act": 20, "attendance": 85, "certified_personnel": 14, "direct_certification": 13, "dropout_rate": 14,
    "enrollment_by_grade": 13, "enrollment_by_subgroup": 40, "eoc": 20, "eog": 20, "graduation_rate": 14,
    "revenues": 15, "sat": 21,
}


@pytest.mark.parametrize("name", sorted(SILVER_SOURCES))
def test_silver_width_and_key(t, name):
    df = silver(t, name)
    assert len(df.columns) == COUNTS[name]
    assert set(SILVER_KEYS[name]) <= set(df.columns)
    assert name in SILVER_CHECKS


def test_silver_types(t):
    assert dict(silver(t, "dropout_rate").dtypes) == {
        **PLACE, "grade_range": S, "subgroup_label": S, "dropout_count": I, "dropout_rate": "decimal(5,2)",
        "institution_key": S, **TAIL,
    }
    levels = ("begin", "developing", "proficient", "distinguished")
    eog = dict(silver(t, "eog").dtypes)
    assert all(eog[f"{n}_count"] == I and eog[f"{n}_pct"] == "decimal(5,2)" for n in levels)
    direct = dict(silver(t, "direct_certification").dtypes)
    assert (direct["fiscal_year"], direct["direct_cert_percent"]) == (I, "decimal(5,1)")
    attendance = dict(silver(t, "attendance").dtypes)
    assert attendance["student_count_not_swd"] == I
    assert attendance["chronic_absent_perc_hispani"] == "decimal(5,1)"
    enrollment = dict(silver(t, "enrollment_by_subgroup").dtypes)
    assert (enrollment["count_eip_k_5"], enrollment["pct_eip_k_5"]) == (D, "decimal(5,1)")
    assert silver(t, "graduation_rate").columns[-1] == "source_year"
    sat, act = dict(silver(t, "sat").dtypes), dict(silver(t, "act").dtypes)
    assert (sat["national_num_tested"], act["national_num_tested"]) == (D, I)


def test_gold_columns(t):
    assert dimension(t, "year").dtypes == [
        ("year_key", "bigint"), ("school_year", S), ("start_calendar_year", I), ("end_calendar_year", I),
        ("fiscal_year", I), ("sort_order", I),
    ]
    assert dimension(t, "subgroup").columns == ["subgroup_key", "subgroup", "subgroup_category", "is_total"]
    assert dimension(t, "school").columns == [
        "school_key", "institution_key", "institution_number", "institution_name", "district_code",
        "district_name", "detail_level", "grades_served", "effective_date", "end_date", "is_current",
    ]
    attendance = fact(t, "fact_attendance")
    assert len(attendance.columns) == 35 and "chronic_absent_perc_hispanic" in attendance.columns
    assert len(fact(t, "fact_enrollment").columns) == 22
    assert "pct_special_ed_pk" not in fact(t, "fact_enrollment").columns
    assert fact(t, "fact_staffing").columns == [
        "school_key", "year_key", "employee_type", "data_category", "data_sub_category", "staff_count",
    ]


@pytest.mark.parametrize("name", ["dropout_rate", "act", "direct_certification", "revenues"])
def test_reconcile(t, name):
    raw = raw_tables(t, name)
    row = reconcile_silver(name, raw, build_silver(name, raw)).first()
    assert (row.status, row.n) == ("pass", 0)


def test_validation_bundles(t):
    got = {(r.check, r.subject): r.status for r in validate_silver("act", silver(t, "act")).collect()}
    assert got["range_max", "institution_avg_score"] == "fail"  # 36.5 occurs
    assert ("composite", "Composite") in got
    got = {(r.check, r.subject): r.status for r in validate_fact("fact_dropout", fact(t, "fact_dropout")).collect()}
    assert got["null_fk", "school_key"] == "fail"


def test_missing_raw_columns_become_null(spark):
    raw = spark.createDataFrame(
        [("2023-24", "601", "1", "9-12 Drop Outs -Black")],
        "LONG_SCHOOL_YEAR string, SCHOOL_DSTRCT_CD string, INSTN_NUMBER string, LABEL_LVL_1_DESC string",
    )
    row = build_silver("dropout_rate", {"dropout_rate": raw}).first()
    assert (row.institution_key, row.grade_range, row.dropout_rate, row.source_file) == ("601_1", "9-12", None, None)


def test_sat_conflict_modes(spark):
    schema = "INSTN_NUMBER string, INSTN_NAME string, SCHOOL_DISTRCT_CD string, SCHOOL_DSTRCT_NM string, LONG_SCHOOL_YEAR string"
    rows = [("1", "A", "601", "x", "2020-21"), ("1", "A", "602", "y", "2020-21"), ("1", "A", None, None, "2021-22")]
    raw = {"sat_recent": spark.createDataFrame(rows, schema)}
    assert build_sat(raw).count() == 4
    single = build_sat(raw, on_conflict="null")
    assert rows_of(single.select("institution_key")) == [("601_1",), ("602_1",), ("A",)]


def test_performance_row_preserving_and_optional_grade(t):
    eog, eoc, sat, act = (silver(t, n) for n in ("eog", "eoc", "sat", "act"))
    tests = facts.conform_assessments(eog, eoc, sat, act)
    assert tests.count() == sum(df.count() for df in (eog, eoc, sat, act))
    assert tests.filter("assessment_name = 'EOC' AND grade IS NOT NULL").count() == 0
    kept = facts.conform_assessments(eog, eoc, sat, act, keep_grade=True)
    assert kept.filter("assessment_name = 'EOC' AND grade IS NULL").count() == 0
    # Scores of college tests stay scores.
    assert tests.filter("assessment_name = 'SAT' AND proficiency_rate IS NOT NULL").count() == 0


def test_label_map_and_year_sources(spark, t):
    df = spark.createDataFrame([("ALL Students",), ("Black",), (None,)], "subgroup string")
    mapped = relabel(df, "subgroup", {"ALL Students": "All Students"})
    assert rows_of(mapped) == [("All Students",), ("Black",), (None,)]
    years = dim_year(silver(t, "enrollment_by_grade"), silver(t, "revenues"))
    assert "1996-97" in {r.school_year for r in years.collect()}
    by_label = facts.fact_dropout(
        silver(t, "dropout_rate"),
        {n: dimension(t, n) for n in ("school", "year", "subgroup")},
        labels={"ALL Students": "All Students"},
    )
    assert by_label.filter("subgroup_key IS NULL").count() == 0


def test_reports_run(t):
    attendance, dropout = silver(t, "attendance"), silver(t, "dropout_rate")
    graduation, revenues = silver(t, "graduation_rate"), silver(t, "revenues")
    enrollment = silver(t, "enrollment_by_grade")
    years = [r.school_year for r in reports.chronic_absence_trend(attendance).collect()]
    assert years == sorted(years)
    worst = reports.worst_chronic_absence(attendance, "1998-99").collect()
    rates = [r.chronic_absent_perc_all for r in worst]
    assert len(rates) == 10 and rates == sorted(rates, reverse=True)
    assert reports.dropout_trend(dropout).columns == ["school_year", "dropout_count", "dropout_rate"]
    assert reports.graduation_trend(graduation).columns[-1] == "cohort_count"
    compared = reports.compare_groups(graduation, "cohort_type", "1998-99", ["graduation_rate"])
    assert compared.columns == ["cohort_type", "graduation_rate"]
    ranked = reports.subgroup_ranking(dropout, "dropout_rate", "dropout_count", "grade_range", "9-12", "1998-99")
    assert ranked.columns == ["subgroup_label", "dropout_rate", "dropout_count"]
    trend = reports.direct_certification_trend(silver(t, "direct_certification")).collect()
    assert [r.fiscal_year for r in trend] == sorted(r.fiscal_year for r in trend)
    assert reports.demographic_trend(silver(t, "enrollment_by_subgroup")).count() > 0
    assert reports.enrollment_totals(enrollment).agg({"total_enrollment": "sum"}).first()[0] > 0
    totals = [r.total_amount for r in reports.category_totals(revenues).collect()]
    assert totals == sorted(totals, reverse=True)
    assert reports.type_totals(revenues).count() == 2
    assert reports.revenue_coverage(revenues).filter("schools > districts").count() > 0
    zeros = reports.staffing_zeros(silver(t, "certified_personnel"), ["data_category", "data_sub_category"])
    assert zeros.count() > 0
    assert reports.negative_amounts(revenues).filter("total_negative_amount >= 0").count() == 0
