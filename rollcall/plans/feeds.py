"""The twelve typed feeds, declared over their raw report columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cleanse import (
    TFS,
    TFS_NA,
    TFS_NA_STAR,
    composite_key,
    merge_columns,
    strip_decimal_suffix,
)
from rollcall.functions.labels import (
    AGGREGATE_CODE,
    classify_sat_format,
    derive_detail_level,
    fiscal_to_school_year,
    fiscal_year,
    split_dropout_label,
    split_graduation_label,
)
from rollcall.operators.conform import backfill, backfill_apart, tag_source
from rollcall.operators.dedup import dedup_rows, dedup_rows_large, few
from rollcall.operators.shape import require_any, union_with_drift, with_missing
from rollcall.plans.spec import LINEAGE_FIELDS, Feed, count, derived, measure, rate, text
from rollcall.session import pin

# Subgroups, metrics and programs in the raw column names.
ATTENDANCE_SUBGROUPS = (
    "ALL",
    "INDIAN",
    "ASIAN",
    "BLACK",
    "WHITE",
    "HISPANI",
    "MULTI",
    "FEMALE",
    "MALE",
    "SWD",
    "NOT_SWD",
    "ED",
    "NOT_ED",
    "LEP",
    "MIGRANT",
)
ATTENDANCE_RATES = (
    "FIVE_OR_FEWER_PERCENT",
    "SIX_TO_FIFTEEN_PERCENT",
    "OVER_15_PERCENT",
    "CHRONIC_ABSENT_PERC",
)
ENROLLMENT_SHARES = {
    "ASIAN": "asian",
    "NATIVE": "native",
    "BLACK": "black",
    "HISPANIC": "hispanic",
    "MULTIRACIAL": "multiracial",
    "WHITE": "white",
    "MALE": "male",
    "FEMALE": "female",
    "MIGRANT": "migrant",
    "ED": "economically_disadvantaged",
    "SWD": "students_with_disabilities",
    "LEP": "english_learner",
}
# The early-intervention program spells its percentage differently.
ENROLLMENT_PROGRAMS = {
    "REMEDIAL_GR_6_8": ("remedial_6_8", "ENROLL_PCT"),
    "EIP_K_5": ("eip_k_5", "ENROLL_PERCENT"),
    "REMEDIAL_GR_9_12": ("remedial_9_12", "ENROLL_PCT"),
    "SPECIAL_ED_K12": ("special_ed_k12", "ENROLL_PCT"),
    "ESOL": ("esol", "ENROLL_PCT"),
    "SPECIAL_ED_PK": ("special_ed_pk", "ENROLL_PCT"),
    "VOCATION_9_12": ("vocation_9_12", "ENROLL_PCT"),
    "ALT_PROGRAMS": ("alt_programs", "ENROLL_PCT"),
    "GIFTED": ("gifted", "ENROLL_PCT"),
}
PROFICIENCY_LEVELS = ("BEGIN", "DEVELOPING", "PROFICIENT", "DISTINGUISHED")
SCORE_LEVELS = {"NATIONAL": "national", "STATE": "state", "DSTRCT": "district", "INSTN": "institution"}
REVENUE_COLUMNS = {
    "school_year": ("LONG_SCHOOL_YEAR", "SCHOOL_YEAR"),
    "district_code": ("SCHOOL_DSTRCT_CD", "DISTRICT_CODE"),
    "district_name": ("SCHOOL_DSTRCT_NM", "DISTRICT_NAME"),
    "institution_number": ("INSTN_NUMBER", "SCHOOL_CODE"),
    "institution_name": ("INSTN_NAME", "SCHOOL_NAME"),
    "amount_per_fte": ("DOLLARS_PER_FTE", "Dollars per FTE"),
    "report_name": ("#RPT_NAME", "source_file"),
}

_YEAR, _DISTRICT, _SCHOOL = "LONG_SCHOOL_YEAR", "SCHOOL_DSTRCT_CD", "INSTN_NUMBER"
_PLACE = (_YEAR, _DISTRICT, _SCHOOL)
_PLACE_KEY = ("school_year", "district_code", "institution_number")

_year = text("school_year", _YEAR)
_level = text("detail_level", "DETAIL_LVL_DESC")
_district = text("district_code", _DISTRICT)
_district_name = text("district_name", "SCHOOL_DSTRCT_NM")
_school = text("institution_number", _SCHOOL)
_school_name = text("institution_name", "INSTN_NAME")
_grades = text("grades_served", "GRADES_SERVED_DESC")
_school_key = derived("institution_key", composite_key, _DISTRICT, _SCHOOL)
_PLACED = (_year, _level, _district, _district_name, _school, _school_name, _grades)


def _attendance_metrics():
    for group in ATTENDANCE_SUBGROUPS:
        yield count(f"student_count_{group}".lower(), f"STUDENT_COUNT_{group}")
        for prefix in ATTENDANCE_RATES:
            yield rate(f"{prefix}_{group}".lower(), f"{prefix}_{group}", 1)


def _enrollment_metrics():
    for raw, name in ENROLLMENT_SHARES.items():
        yield rate(f"pct_{name}", f"ENROLL_PCT_{raw}", 1, TFS_NA_STAR)
    for raw, (name, prefix) in ENROLLMENT_PROGRAMS.items():
        yield measure(f"count_{name}", f"ENROLL_COUNT_{raw}", TFS_NA_STAR)
        yield rate(f"pct_{name}", f"{prefix}_{raw}", 1, TFS_NA_STAR)


def _scores(counted, scored):
    for raw, name in SCORE_LEVELS.items():
        yield counted(f"{name}_num_tested", f"{raw}_NUM_TESTED_CNT")
    for raw, name in SCORE_LEVELS.items():
        yield scored(f"{name}_avg_score", f"{raw}_AVG_SCORE_VAL")


attendance = Feed(
    "attendance",
    key=_PLACE,
    fields=(*_PLACED, _school_key, *_attendance_metrics(), *LINEAGE_FIELDS),
    silver_key=_PLACE_KEY,
)

certified_personnel = Feed(
    "certified_personnel",
    key=(*_PLACE, "DATA_CATEGORY", "DATA_SUB_CATEGORY", "EMPLOYEE_TYPE"),
    fields=(
        *(_year, _district, _district_name, _school, _school_name, _grades),
        text("data_category", "DATA_CATEGORY"),
        text("data_sub_category", "DATA_SUB_CATEGORY"),
        text("employee_type", "EMPLOYEE_TYPE"),
        measure("staff_count", "MEASURE", codes=()),
        _school_key,
        *LINEAGE_FIELDS,
        text("report_name", "#RPT_NAME"),
    ),
    silver_key=(*_PLACE_KEY, "data_category", "data_sub_category", "employee_type"),
)

dropout_rate = Feed(
    "dropout_rate",
    key=(*_PLACE, "LABEL_LVL_1_DESC"),
    fields=(
        *_PLACED,
        derived("grade_range", lambda c: split_dropout_label(c)[0], "LABEL_LVL_1_DESC"),
        derived("subgroup_label", lambda c: split_dropout_label(c)[1], "LABEL_LVL_1_DESC"),
        count("dropout_count", "PROGRAM_TOTAL"),
        rate("dropout_rate", "PROGRAM_PERCENT", 2),
        _school_key,
        *LINEAGE_FIELDS,
    ),
    silver_key=(*_PLACE_KEY, "grade_range", "subgroup_label"),
)

graduation_rate = Feed(
    "graduation_rate",
    key=(*_PLACE, "LABEL_LVL_1_DESC"),
    fields=(
        *_PLACED,
        derived("cohort_type", lambda c: split_graduation_label(c)[0], "LABEL_LVL_1_DESC"),
        derived("subgroup_label", lambda c: split_graduation_label(c)[1], "LABEL_LVL_1_DESC"),
        count("graduate_count", "PROGRAM_TOTAL"),
        rate("graduation_rate", "PROGRAM_PERCENT", 2),
        count("cohort_count", "TOTAL_COUNT"),
        _school_key,
        text("source_year", "source_year"),
    ),
    silver_key=(*_PLACE_KEY, "cohort_type", "subgroup_label"),
)

enrollment_by_grade = Feed(
    "enrollment_by_grade",
    key=(*_PLACE, "ENROLLMENT_PERIOD", "GRADE_LEVEL"),
    fields=(
        *_PLACED,
        text("enrollment_period", "ENROLLMENT_PERIOD"),
        text("grade_level", "GRADE_LEVEL"),
        count("enrollment_count", "ENROLLMENT_COUNT"),
        _school_key,
        *LINEAGE_FIELDS,
    ),
    silver_key=(*_PLACE_KEY, "enrollment_period", "grade_level"),
)

enrollment_by_subgroup = Feed(
    "enrollment_by_subgroup",
    key=_PLACE,
    fields=(
        _year,
        _level,
        derived("district_code", strip_decimal_suffix, _DISTRICT),
        _district_name,
        derived("institution_number", strip_decimal_suffix, _SCHOOL),
        _school_name,
        _grades,
        derived(
            "institution_key",
            lambda d, s: composite_key(strip_decimal_suffix(d), strip_decimal_suffix(s)),
            *(_DISTRICT, _SCHOOL),
        ),
        *_enrollment_metrics(),
        *LINEAGE_FIELDS,
    ),
    silver_key=_PLACE_KEY,
)


def _assessment(name: str) -> Feed:
    """End-of-grade and end-of-course results share one layout."""
    return Feed(
        name,
        key=(_YEAR, "SCHOOL_DISTRCT_CD", _SCHOOL, "ACDMC_LVL", "SUBGROUP_NAME", "TEST_CMPNT_TYP_NM"),
        fields=(
            _year,
            text("district_code", "SCHOOL_DISTRCT_CD"),
            *(_district_name, _school, _school_name),
            text("grade_level", "ACDMC_LVL"),
            text("subgroup_name", "SUBGROUP_NAME"),
            text("test_component", "TEST_CMPNT_TYP_NM"),
            count("num_tested", "NUM_TESTED_CNT"),
            *[count(f"{level}_count".lower(), f"{level}_CNT") for level in PROFICIENCY_LEVELS],
            *[rate(f"{level}_pct".lower(), f"{level}_PCT", 2) for level in PROFICIENCY_LEVELS],
            derived("institution_key", composite_key, "SCHOOL_DISTRCT_CD", _SCHOOL),
            *LINEAGE_FIELDS,
        ),
        silver_key=(*_PLACE_KEY, "grade_level", "subgroup_name", "test_component"),
    )


eog = _assessment("eog")
eoc = _assessment("eoc")

# The two district spellings are both part of the raw key and merged afterwards.
act = Feed(
    "act",
    key=(_YEAR, _DISTRICT, "SCHOOL_DISTRCT_CD", _SCHOOL, "SUBGRP_DESC", "TEST_CMPNT_TYP_CD"),
    fields=(
        *(_year, _school, _school_name),
        derived("district_code", merge_columns, _DISTRICT, "SCHOOL_DISTRCT_CD"),
        _district_name,
        text("subgroup", "SUBGRP_DESC"),
        text("test_component", "TEST_CMPNT_TYP_CD"),
        derived(
            "institution_key",
            lambda a, b, s: composite_key(merge_columns(a, b), s),
            *(_DISTRICT, "SCHOOL_DISTRCT_CD", _SCHOOL),
        ),
        *_scores(lambda n, r: count(n, r, strip_zeros=True), measure),
        text("assessment_code", "#ASSMT_CD"),
        text("highest_recent_indicator", "HIGHEST_RECENT_IND"),
        *LINEAGE_FIELDS,
    ),
    silver_key=(*_PLACE_KEY, "subgroup", "test_component"),
    spellings=((_DISTRICT, "SCHOOL_DISTRCT_CD"),),
)

# SAT rows are distinct as a whole; see build_sat.
sat = Feed(
    "sat",
    key=(),
    fields=(
        *(_year, _school, _school_name),
        text("district_code", "SCHOOL_DISTRCT_CD"),
        _district_name,
        text("subgroup", "SUBGRP_DESC"),
        text("test_component", "TEST_CMPNT_TYP_CD"),
        text("sat_format", "sat_format"),
        text("highest_recent_indicator", "HIGHEST_RECENT_IND"),
        derived(
            "institution_key",
            lambda d, s, name: composite_key(d, s, fallback=name),
            *("SCHOOL_DISTRCT_CD", _SCHOOL, "INSTN_NAME"),
        ),
        *_scores(lambda n, r: measure(n, r, TFS_NA), lambda n, r: measure(n, r, TFS_NA)),
        text("assessment_code", "#ASSMT_CD"),
        *LINEAGE_FIELDS,
    ),
    silver_key=("school_year", "institution_key", "subgroup", "test_component", "highest_recent_indicator"),
)


def _revenue_value(name: str, cast: bool = False):
    build = (lambda *cs: merge_columns(*cs).try_cast("double")) if cast else merge_columns
    return derived(name, build, *REVENUE_COLUMNS[name])


def _merged_codes(build):
    """Apply ``build`` to the merged district and institution codes."""
    raw = (*REVENUE_COLUMNS["district_code"], *REVENUE_COLUMNS["institution_number"])
    return lambda d1, d2, s1, s2: build(merge_columns(d1, d2), merge_columns(s1, s2)), raw


_level_of, _code_columns = _merged_codes(derive_detail_level)
_key_of, _ = _merged_codes(composite_key)

revenues = Feed(
    "revenues",
    key=(
        *REVENUE_COLUMNS["school_year"],
        *REVENUE_COLUMNS["district_code"],
        *REVENUE_COLUMNS["institution_number"],
        "Revenues/Expenditures",
        "Description",
    ),
    fields=(
        _revenue_value("school_year"),
        _revenue_value("district_code"),
        _revenue_value("district_name"),
        _revenue_value("institution_number"),
        _revenue_value("institution_name"),
        derived("detail_level", _level_of, *_code_columns),
        text("revenue_expenditure_type", "Revenues/Expenditures"),
        text("category", "Description"),
        measure("amount", "REV_EXP_VALUE", codes=()),
        _revenue_value("amount_per_fte", cast=True),
        derived("institution_key", _key_of, *_code_columns),
        _grades,
        *LINEAGE_FIELDS,
        _revenue_value("report_name"),
    ),
    silver_key=(*_PLACE_KEY, "revenue_expenditure_type", "category"),
    prepare=lambda raw: require_any(raw, REVENUE_COLUMNS["school_year"], REVENUE_COLUMNS["district_code"]),
    spellings=tuple(REVENUE_COLUMNS[c] for c in ("school_year", "district_code", "institution_number")),
)


def _direct_certification(level: str) -> Feed:
    """District file or school file; district rows get the aggregate code."""
    school_raw = ("SCHOOL_ID",) if level == "School" else ()

    def school_code(*raw):
        return strip_decimal_suffix(raw[0]) if raw else F.lit(AGGREGATE_CODE)

    return Feed(
        f"direct_certification_{level.lower()}",
        key=("FISCAL_YEAR", "SYSTEM_ID", *school_raw),
        fields=(
            derived("school_year", fiscal_to_school_year, "FISCAL_YEAR"),
            derived("fiscal_year", fiscal_year, "FISCAL_YEAR"),
            derived("detail_level", lambda: F.lit(level)),
            derived("district_code", strip_decimal_suffix, "SYSTEM_ID"),
            text("district_name", "SYSTEM_NAME"),
            derived("institution_number", school_code, *school_raw),
            text("institution_name", "SCHOOL_NAME")
            if school_raw
            else derived("institution_name", lambda: F.lit(None).cast("string")),
            derived(
                "institution_key",
                lambda d, *s: composite_key(strip_decimal_suffix(d), school_code(*s)),
                *("SYSTEM_ID", *school_raw),
            ),
            rate("direct_cert_percent", "direct_cert_perc", 1, TFS),
            count("poverty_student_count", "K12_POVERTY_STUDENT_CT"),
            count("total_student_count", "K12_STUDENT_COUNT"),
            *LINEAGE_FIELDS,
        ),
        silver_key=_PLACE_KEY,
        prepare=lambda raw: raw.filter(F.col("FISCAL_YEAR").isNotNull()),
    )


direct_certification_district = _direct_certification("District")
direct_certification_school = _direct_certification("School")

# Highest or Recent by source table, and the tables that hold only the new format.
SAT_TABLES = {
    "sat": (None, False),
    "sat_highest": ("Highest", False),
    "sat_recent": ("Recent", False),
    "sat_new_highest": ("Highest", True),
    "sat_new_recent": ("Recent", True),
}
ACT_TABLES = ("act", "act_highest")
DIRECT_CERTIFICATION_TABLES = ("direct_certification_district", "direct_certification_school")


def sat_union(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The five SAT tables with format and indicator columns."""
    frames = []
    for table, (indicator, new_only) in SAT_TABLES.items():
        if table not in raw:
            continue
        df = with_missing(raw[table], ["TEST_CMPNT_TYP_CD"])
        if indicator is not None:
            df = tag_source(df, HIGHEST_RECENT_IND=indicator)
        sat_format = F.lit("new") if new_only else classify_sat_format(F.col("TEST_CMPNT_TYP_CD"))
        frames.append(df.withColumn("sat_format", sat_format))
    return with_missing(union_with_drift(frames), sat.raw_columns())


def build_sat(raw: Mapping[str, DataFrame], on_conflict: str = "fanout") -> DataFrame:
    """Union, backfill the district by school number and name, distinct, type.

    Rows are copies only if all their raw columns are equal, those that the feed does not
    read included.  The union is written once, so each of the five tables is read once; a
    large one is written again when filled, and only rows that lack something or recur move.
    """
    union = pin(sat_union(raw), "sat_union")
    keys, fill = [_SCHOOL, "INSTN_NAME"], ["SCHOOL_DISTRCT_CD", "SCHOOL_DSTRCT_NM"]
    if few(union):
        rows = dedup_rows(backfill(union, keys, fill, on_conflict))
    else:
        rows = dedup_rows_large(backfill_apart(union, keys, fill, on_conflict), "sat_filled")
    return rows.select(*[f.column() for f in sat.fields])


def build_act(raw: Mapping[str, DataFrame]) -> DataFrame:
    return act.build(union_with_drift([raw[t] for t in ACT_TABLES if t in raw]))


def build_direct_certification(raw: Mapping[str, DataFrame]) -> DataFrame:
    parts = (direct_certification_district, direct_certification_school)
    return union_with_drift([feed.build(raw[feed.name]) for feed in parts if feed.name in raw])


# Feeds that read the raw table of their own name.
SINGLE_FEEDS = {
    feed.name: feed
    for feed in (
        attendance,
        certified_personnel,
        dropout_rate,
        enrollment_by_grade,
        enrollment_by_subgroup,
        eoc,
        eog,
        graduation_rate,
        revenues,
    )
}
# Silver table: raw tables it reads.
SILVER_SOURCES = {
    **{name: (name,) for name in SINGLE_FEEDS},
    "act": ACT_TABLES,
    "sat": tuple(SAT_TABLES),
    "direct_certification": DIRECT_CERTIFICATION_TABLES,
}
SILVER_KEYS = {
    **{name: feed.silver_key for name, feed in SINGLE_FEEDS.items()},
    "act": act.silver_key,
    "sat": sat.silver_key,
    "direct_certification": _PLACE_KEY,
}


def build_silver(name: str, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Typed table ``name`` from the raw tables it reads."""
    if name == "act":
        return build_act(raw)
    if name == "sat":
        return build_sat(raw)
    if name == "direct_certification":
        return build_direct_certification(raw)
    return SINGLE_FEEDS[name].build(raw[name])
