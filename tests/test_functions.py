from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.functions import cleanse as C
from rollcall.functions import labels as L
from rollcall.functions.report_types import base_pattern, classify_report_type


def evaluate(table, column, *values, schema="v string"):
    df = table(schema, *[v if isinstance(v, tuple) else (v,) for v in values])
    return [r[0] for r in df.select(column.alias("result")).collect()]


CELLS = ("TFS", "N/A", "*", None, "15.0", "15.", "247.5", " 15 ", "1,234", "abc", "12", "-3")


def test_clean_int(table):
    got = evaluate(table, C.clean_int("v"), *CELLS)
    assert got == [None, None, None, None, None, None, None, 15, None, None, 12, -3]
    got = evaluate(table, C.clean_int("v", C.TFS_NA_STAR, strip_zeros=True), *CELLS)
    assert got == [None, None, None, None, 15, 15, None, 15, None, None, 12, -3]


def test_clean_double(table):
    got = evaluate(table, C.clean_double("v", C.TFS_NA), *CELLS)
    assert got == [None, None, None, None, 15.0, 15.0, 247.5, 15.0, None, None, 12.0, -3.0]
    assert evaluate(table, C.clean_double("v", ()), "TFS", "1.5") == [None, 1.5]


def test_clean_decimal_rounds_half_up_and_drops_overflow(table):
    got = evaluate(table, C.clean_decimal("v", 5, 1), "12.25", "12345.6", "TFS", "100.95", None, "x")
    assert got == [Decimal("12.3"), None, None, Decimal("101.0"), None, None]
    assert evaluate(table, C.clean_decimal("v", 5, 2), "99.999") == [Decimal("100.00")]


def test_suppress_keeps_other_text(table):
    assert evaluate(table, C.suppress("v"), "TFS", "N/A", None, "") == [None, "N/A", None, ""]
    assert evaluate(table, C.suppress("v", C.TFS_NA_STAR), "TFS", "N/A", "*", "7") == [None, None, None, "7"]


def test_strip_suffix(table):
    assert evaluate(table, C.strip_decimal_suffix("v"), "601.0", "601", "6.01", "601.00", None) == [
        "601",
        "601",
        "6.01",
        "601.00",
        None,
    ]


def test_unparsed_flags_lost_cells_only(table):
    got = evaluate(table, C.unparsed("v", C.clean_int("v")), "TFS", None, "12", "15.7")
    assert got == [False, False, False, True]


def test_composite_key(table):
    rows = (("601", "0101", "A"), (None, "0101", "A"), (None, None, "A"))
    schema = "d string, s string, name string"
    assert evaluate(table, C.composite_key("d", "s"), *rows, schema=schema) == ["601_0101", "0101", ""]
    got = evaluate(table, C.composite_key("d", "s", fallback="name"), *rows, schema=schema)
    assert got == ["601_0101", "A", "A"]


def test_first_present_ignores_case_and_absent_columns(table):
    column = C.first_present(["V", "other"], ["missing", "v"])
    assert evaluate(table, column, "x", None) == ["x", None]
    assert evaluate(table, C.first_present(["a"], ["b"]), "x") == [None]


def test_labels(table):
    grade, group = L.split_dropout_label(F.col("v"))
    cells = ("7-12 Drop Outs -Black", "9-12 Drop Outs -ALL Students", "no label", None)
    assert evaluate(table, grade, *cells) == ["7-12", "9-12", "9-12", "9-12"]
    assert evaluate(table, group, *cells) == ["Black", "ALL Students", "", None]
    cohort, group = L.split_graduation_label(F.col("v"))
    cells = ("5 Yr Grad Rate -Female", "Grad Rate -Female", "x")
    assert evaluate(table, cohort, *cells) == ["5-Year", "4-Year", "4-Year"]
    assert evaluate(table, group, *cells) == ["Female", "Female", ""]


def test_years(table):
    cells = ("2024.0", "2000", None, "abc", "2010")
    got = evaluate(table, L.fiscal_to_school_year(F.col("v")), *cells)
    assert got == ["2023-24", "1999-00", None, None, "2009-10"]
    assert evaluate(table, L.fiscal_to_school_year(F.col("v"), short=True), "2024.0") == ["23-24"]
    assert evaluate(table, L.year_start(F.col("v")), "2023-24", "2009-10", "x") == [2023, 2009, None]
    assert evaluate(table, L.year_end(F.col("v")), "2023-24", "2009-10", "x") == [2024, 2010, None]


def test_detail_level(table):
    column = L.derive_detail_level(F.col("d"), F.col("s"))
    rows = (("ALL", "ALL"), ("601", "ALL"), ("601", "1"), ("ALL", "1"), (None, None))
    got = evaluate(table, column, *rows, schema="d string, s string")
    assert got == ["State", "District", "School", "School", "School"]


def test_categories(table):
    got = evaluate(table, L.subgroup_category(F.col("v")), "All Students", "Male", "SWD", "ED", "Asian", "x", None)
    assert got == ["Total", "Gender", "Special Populations", "Economic Status", "Race/Ethnicity", "Other", "Other"]
    got = evaluate(
        table,
        L.classify_sat_format(F.col("v")),
        *("Evidence Based Reading and Writing - New", "Reading Test  Score - New", "Reading Test Score - New", "Combined"),
    )
    assert got == ["new", "new", "old", "old"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("SAT_New_Highest_2016.csv", "sat_new_highest"),
        ("sat_2022-23.csv", "sat"),
        ("SAT-2012.csv", "sat"),
        ("ACT_Highest_2015.csv", "act_highest"),
        ("act_2024.csv", "act"),
        ("4-Year_Graduation_Rate.csv", "graduation_rate"),
        ("5-Year_Cohort_Graduation.csv", "graduation_rate"),
        ("5-Year_Cohort.csv", "graduation_5year"),
        ("direct_certification_school_data.csv", "direct_certification_district"),
        ("direct_certification_school.csv", "direct_certification_school"),
        ("Mobility_District_2020.csv", "mobility_district"),
        ("EOC_by_Grade_2019.csv", "eoc_by_grade"),
        ("eog_2021-22.csv", "eog"),
        ("HS_Completer_Credentials.csv", "hs_completer_credentials"),
        ("Some Report 2019.csv", "some report"),
        ("Plain.csv", "plain"),
    ],
)
def test_report_type(table, name, expected):
    assert evaluate(table, classify_report_type(F.col("v")), name) == [expected]


def test_base_pattern(table):
    got = evaluate(
        table,
        base_pattern(F.col("v")),
        *("Attendance_2022-23.csv", "ACT_20260219_003226.csv", "Direct_FY2018.csv", "Direct_fy18_x.CSV", "Plain.CSV"),
    )
    assert got == ["attendance", "act", "direct", "direct", "plain"]
