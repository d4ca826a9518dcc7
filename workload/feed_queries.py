"""Typed feeds, dimensions and facts over the derived raw tables.

The check statements are written in SQL from the raw tables up; they share only the raw
table texts with the Spark side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from rollcall.plans import dims as D
from rollcall.plans import facts as FA
from rollcall.plans import staging
from rollcall.plans.feeds import SILVER_SOURCES, build_silver
from workload.raw_tables import RAW
from workload.registry import Tables, query


def raw_tables(t: Tables, silver: str) -> dict[str, DataFrame]:
    return {name: t.sql(RAW[name]) for name in SILVER_SOURCES[silver]}


def silver(t: Tables, name: str) -> DataFrame:
    return build_silver(name, raw_tables(t, name))


# -- SQL building blocks ----------------------------------------------------------------


def _code_free(c: str, codes: str = "'TFS'") -> str:
    return f"case when {c} in ({codes}) then null else {c} end"


def _int(c: str) -> str:
    return f"try_cast({_code_free(c)} as integer)"


def _dec(c: str, scale: int, codes: str = "'TFS'") -> str:
    return f"cast(try_cast({_code_free(c, codes)} as decimal(5,{scale})) as double)"


def _dbl(c: str, codes: str = "'TFS'") -> str:
    return f"try_cast({_code_free(c, codes)} as double)"


def newest(raw: str, keys: str, where: str = "true") -> str:
    """One row per key, the one from the newest file."""
    return (
        f"(select * from (select *, row_number() over (partition by {keys} "
        f"order by source_year desc nulls last, source_file desc nulls last) as rn "
        f"from ({raw}) as r where {where}) as ranked where rn = 1)"
    )


PLACE_SQL = """LONG_SCHOOL_YEAR as school_year, DETAIL_LVL_DESC as detail_level, SCHOOL_DSTRCT_CD as district_code,
  SCHOOL_DSTRCT_NM as district_name, INSTN_NUMBER as institution_number, INSTN_NAME as institution_name,
  GRADES_SERVED_DESC as grades_served, concat_ws('_', SCHOOL_DSTRCT_CD, INSTN_NUMBER) as institution_key"""
_PLACE_KEYS = "LONG_SCHOOL_YEAR, SCHOOL_DSTRCT_CD, INSTN_NUMBER"

# Column names of the feeds.
_groups = (
    "all", "indian", "asian", "black", "white", "hispani", "multi", "female",
    "male", "swd", "not_swd", "ed", "not_ed", "lep", "migrant",
)
_rates = ("five_or_fewer_percent", "six_to_fifteen_percent", "over_15_percent", "chronic_absent_perc")
_attendance = ", ".join(
    ", ".join(
        [f"{_int(f'STUDENT_COUNT_{g}')} as student_count_{g}"]
        + [
            f"{_dec(f'{m}_{g}', 1)} as {m}_{g}"
            for m in _rates
        ]
    )
    for g in _groups
)

_ALL_CODES = "'TFS', 'N/A', '*'"
_share_names = {
    "asian": "asian",
    "native": "native",
    "black": "black",
    "hispanic": "hispanic",
    "multiracial": "multiracial",
    "white": "white",
    "male": "male",
    "female": "female",
    "migrant": "migrant",
    "ed": "economically_disadvantaged",
    "swd": "students_with_disabilities",
    "lep": "english_learner",
}
_program_names = {
    "remedial_gr_6_8": "remedial_6_8",
    "eip_k_5": "eip_k_5",
    "remedial_gr_9_12": "remedial_9_12",
    "special_ed_k12": "special_ed_k12",
    "esol": "esol",
    "special_ed_pk": "special_ed_pk",
    "vocation_9_12": "vocation_9_12",
    "alt_programs": "alt_programs",
    "gifted": "gifted",
}


def _enrollment() -> str:
    out = []
    for raw, name in _share_names.items():
        out.append(f"{_dec(f'ENROLL_PCT_{raw}', 1, _ALL_CODES)} as pct_{name}")
    for raw, name in _program_names.items():
        share = "ENROLL_PERCENT" if raw == "eip_k_5" else "ENROLL_PCT"
        out.append(f"{_dbl(f'ENROLL_COUNT_{raw}', _ALL_CODES)} as count_{name}")
        out.append(f"{_dec(f'{share}_{raw}', 1, _ALL_CODES)} as pct_{name}")
    return ", ".join(out)


def _assessment(name: str) -> str:
    keys = "LONG_SCHOOL_YEAR, SCHOOL_DISTRCT_CD, INSTN_NUMBER, ACDMC_LVL, SUBGROUP_NAME, TEST_CMPNT_TYP_NM"
    levels = "begin developing proficient distinguished".split()
    return f"""select LONG_SCHOOL_YEAR as school_year, SCHOOL_DISTRCT_CD as district_code,
  SCHOOL_DSTRCT_NM as district_name, INSTN_NUMBER as institution_number, INSTN_NAME as institution_name,
  ACDMC_LVL as grade_level, SUBGROUP_NAME as subgroup_name, TEST_CMPNT_TYP_NM as test_component,
  {_int('NUM_TESTED_CNT')} as num_tested,
  {', '.join(f"{_int(f'{n}_CNT')} as {n}_count, {_dec(f'{n}_PCT', 2)} as {n}_pct" for n in levels)},
  concat_ws('_', SCHOOL_DISTRCT_CD, INSTN_NUMBER) as institution_key, source_year, source_file
from {newest(RAW[name], keys)} as picked"""


_score_levels = (("NATIONAL", "national"), ("STATE", "state"), ("DSTRCT", "district"), ("INSTN", "institution"))


def _act() -> str:
    both = f"select * from ({RAW['act']}) as a union all by name select * from ({RAW['act_highest']}) as b"
    keys = "LONG_SCHOOL_YEAR, SCHOOL_DSTRCT_CD, SCHOOL_DISTRCT_CD, INSTN_NUMBER, SUBGRP_DESC, TEST_CMPNT_TYP_CD"
    scores = ", ".join(
        f"try_cast(regexp_replace(nullif({r}_NUM_TESTED_CNT, 'TFS'), '\\.0*$', '') as integer) as {n}_num_tested, "
        f"{_dbl(f'{r}_AVG_SCORE_VAL')} as {n}_avg_score"
        for r, n in _score_levels
    )
    return f"""select LONG_SCHOOL_YEAR as school_year, INSTN_NUMBER as institution_number,
  INSTN_NAME as institution_name, coalesce(SCHOOL_DSTRCT_CD, SCHOOL_DISTRCT_CD) as district_code,
  SCHOOL_DSTRCT_NM as district_name, SUBGRP_DESC as subgroup, TEST_CMPNT_TYP_CD as test_component,
  concat_ws('_', coalesce(SCHOOL_DSTRCT_CD, SCHOOL_DISTRCT_CD), INSTN_NUMBER) as institution_key, {scores},
  "#ASSMT_CD" as assessment_code, HIGHEST_RECENT_IND as highest_recent_indicator, source_year, source_file
from {newest(both, keys)} as picked"""


def _sat() -> str:
    new = (
        "'Combined Test Score', 'Math Section Score - New', 'Reading Test  Score - New', "
        "'WritLang Test  Score - New', 'Evidence Based Reading and Writing - New', 'Essay Total', "
        "'Essay Analysis Score - New', 'Essay Reading Score - New', 'Essay Writing Score - New'"
    )
    by_name = f"case when TEST_CMPNT_TYP_CD in ({new}) then 'new' else 'old' end as sat_format"
    parts = [f"select *, {by_name} from ({RAW['sat']}) as s0"]
    for i, (table, indicator, fmt) in enumerate(
        (
            ("sat_highest", "Highest", by_name),
            ("sat_recent", "Recent", by_name),
            ("sat_new_highest", "Highest", "'new' as sat_format"),
            ("sat_new_recent", "Recent", "'new' as sat_format"),
        )
    ):
        parts.append(
            f"select *, '{indicator}' as HIGHEST_RECENT_IND, {fmt} from ({RAW[table]}) as t{i}"
        )
    scores = ", ".join(
        f"m.{r}_NUM_TESTED_CNT, m.{r}_AVG_SCORE_VAL" for r, _ in _score_levels
    )
    codes = "'TFS', 'N/A'"
    typed = ", ".join(
        f"{_dbl(f'{r}_NUM_TESTED_CNT', codes)} as {n}_num_tested, {_dbl(f'{r}_AVG_SCORE_VAL', codes)} as {n}_avg_score"
        for r, n in _score_levels
    )
    return f"""with every as ({' union all by name '.join(parts)}),
known as (select distinct INSTN_NUMBER, INSTN_NAME, SCHOOL_DISTRCT_CD, SCHOOL_DSTRCT_NM from every
  where SCHOOL_DISTRCT_CD is not null and INSTN_NUMBER is not null and INSTN_NAME is not null),
filled as (select distinct m.LONG_SCHOOL_YEAR, m.INSTN_NUMBER, m.INSTN_NAME, m.SUBGRP_DESC, m.TEST_CMPNT_TYP_CD,
    m.sat_format, m.HIGHEST_RECENT_IND, {scores}, m."#ASSMT_CD", m.source_year, m.source_file,
    coalesce(m.SCHOOL_DISTRCT_CD, k.SCHOOL_DISTRCT_CD) as SCHOOL_DISTRCT_CD,
    coalesce(m.SCHOOL_DSTRCT_NM, k.SCHOOL_DSTRCT_NM) as SCHOOL_DSTRCT_NM
  from every as m left join known as k on m.INSTN_NUMBER = k.INSTN_NUMBER and m.INSTN_NAME = k.INSTN_NAME)
select LONG_SCHOOL_YEAR as school_year, INSTN_NUMBER as institution_number, INSTN_NAME as institution_name,
  SCHOOL_DISTRCT_CD as district_code, SCHOOL_DSTRCT_NM as district_name, SUBGRP_DESC as subgroup,
  TEST_CMPNT_TYP_CD as test_component, sat_format, HIGHEST_RECENT_IND as highest_recent_indicator,
  case when SCHOOL_DISTRCT_CD is null then INSTN_NAME
    else concat_ws('_', SCHOOL_DISTRCT_CD, INSTN_NUMBER) end as institution_key,
  {typed}, "#ASSMT_CD" as assessment_code, source_year, source_file
from filled"""


def _direct_certification() -> str:
    def one(level: str) -> str:
        school = level == "School"
        raw = RAW[f"direct_certification_{level.lower()}"]
        keys = "FISCAL_YEAR, SYSTEM_ID" + (", SCHOOL_ID" if school else "")
        number = "regexp_replace(SCHOOL_ID, '\\.0$', '')" if school else "'ALL'"
        district = "regexp_replace(SYSTEM_ID, '\\.0$', '')"
        fy = "try_cast(regexp_replace(FISCAL_YEAR, '\\.0*$', '') as integer)"
        return f"""select concat(cast({fy} - 1 as varchar), '-', right(cast({fy} as varchar), 2)) as school_year,
  {fy} as fiscal_year, '{level}' as detail_level, {district} as district_code, SYSTEM_NAME as district_name,
  {number} as institution_number, {'SCHOOL_NAME' if school else 'cast(null as varchar)'} as institution_name,
  concat({district}, '_', {number}) as institution_key, {_dec('DIRECT_CERT_PERC', 1)} as direct_cert_percent,
  {_int('K12_POVERTY_STUDENT_CT')} as poverty_student_count, {_int('K12_STUDENT_COUNT')} as total_student_count,
  source_year, source_file
from {newest(raw, keys, 'FISCAL_YEAR is not null')} as picked"""

    return f"{one('District')} union all {one('School')}"


def _revenues() -> str:
    keys = (
        "SCHOOL_YEAR, LONG_SCHOOL_YEAR, DISTRICT_CODE, SCHOOL_DSTRCT_CD, SCHOOL_CODE, INSTN_NUMBER, "
        '"Revenues/Expenditures", Description'
    )
    present = (
        "(SCHOOL_YEAR is not null or LONG_SCHOOL_YEAR is not null) and "
        "(DISTRICT_CODE is not null or SCHOOL_DSTRCT_CD is not null)"
    )
    return f"""with merged as (select *, coalesce(SCHOOL_DSTRCT_CD, DISTRICT_CODE) as dist,
    coalesce(INSTN_NUMBER, SCHOOL_CODE) as inst from {newest(RAW['revenues'], keys, present)} as picked)
select coalesce(LONG_SCHOOL_YEAR, SCHOOL_YEAR) as school_year, dist as district_code,
  coalesce(SCHOOL_DSTRCT_NM, DISTRICT_NAME) as district_name, inst as institution_number,
  coalesce(INSTN_NAME, SCHOOL_NAME) as institution_name,
  case when dist = 'ALL' and inst = 'ALL' then 'State' when inst = 'ALL' then 'District' else 'School' end
    as detail_level,
  "Revenues/Expenditures" as revenue_expenditure_type, Description as category,
  try_cast(REV_EXP_VALUE as double) as amount,
  try_cast(coalesce(DOLLARS_PER_FTE, "Dollars per FTE") as double) as amount_per_fte,
  concat_ws('_', dist, inst) as institution_key, GRADES_SERVED_DESC as grades_served, source_year, source_file,
  coalesce("#RPT_NAME", source_file) as report_name
from merged"""


def _labelled(name: str, label: str, measures: str, tail: str) -> str:
    return f"""select {PLACE_SQL}, {label}, {measures}, {tail}
from {newest(RAW[name], _PLACE_KEYS + ', LABEL_LVL_1_DESC')} as picked"""


SILVER_SQL = {
    "attendance": f"""select {PLACE_SQL}, {_attendance}, source_year, source_file
from {newest(RAW['attendance'], _PLACE_KEYS)} as picked""",
    "certified_personnel": f"""select LONG_SCHOOL_YEAR as school_year, SCHOOL_DSTRCT_CD as district_code,
  SCHOOL_DSTRCT_NM as district_name, INSTN_NUMBER as institution_number, INSTN_NAME as institution_name,
  GRADES_SERVED_DESC as grades_served, DATA_CATEGORY as data_category, DATA_SUB_CATEGORY as data_sub_category,
  EMPLOYEE_TYPE as employee_type, try_cast(MEASURE as double) as staff_count,
  concat_ws('_', SCHOOL_DSTRCT_CD, INSTN_NUMBER) as institution_key, source_year, source_file,
  "#RPT_NAME" as report_name
from {newest(RAW['certified_personnel'], _PLACE_KEYS + ', DATA_CATEGORY, DATA_SUB_CATEGORY, EMPLOYEE_TYPE')} as p""",
    "dropout_rate": _labelled(
        "dropout_rate",
        "case when starts_with(LABEL_LVL_1_DESC, '7-12') then '7-12' else '9-12' end as grade_range, "
        "regexp_extract(LABEL_LVL_1_DESC, 'Drop Outs -(.*)', 1) as subgroup_label",
        f"{_int('PROGRAM_TOTAL')} as dropout_count, {_dec('PROGRAM_PERCENT', 2)} as dropout_rate",
        "source_year, source_file",
    ),
    "graduation_rate": _labelled(
        "graduation_rate",
        "case when starts_with(LABEL_LVL_1_DESC, '5 Yr') then '5-Year' else '4-Year' end as cohort_type, "
        "regexp_extract(LABEL_LVL_1_DESC, 'Grad Rate -(.*)', 1) as subgroup_label",
        f"{_int('PROGRAM_TOTAL')} as graduate_count, {_dec('PROGRAM_PERCENT', 2)} as graduation_rate, "
        f"{_int('TOTAL_COUNT')} as cohort_count",
        "source_year",
    ),
    "enrollment_by_grade": f"""select {PLACE_SQL}, ENROLLMENT_PERIOD as enrollment_period,
  GRADE_LEVEL as grade_level, {_int('ENROLLMENT_COUNT')} as enrollment_count, source_year, source_file
from {newest(RAW['enrollment_by_grade'], _PLACE_KEYS + ', ENROLLMENT_PERIOD, GRADE_LEVEL')} as picked""",
    "enrollment_by_subgroup": f"""select LONG_SCHOOL_YEAR as school_year, DETAIL_LVL_DESC as detail_level,
  regexp_replace(SCHOOL_DSTRCT_CD, '\\.0$', '') as district_code, SCHOOL_DSTRCT_NM as district_name,
  regexp_replace(INSTN_NUMBER, '\\.0$', '') as institution_number, INSTN_NAME as institution_name,
  GRADES_SERVED_DESC as grades_served,
  concat_ws('_', regexp_replace(SCHOOL_DSTRCT_CD, '\\.0$', ''), regexp_replace(INSTN_NUMBER, '\\.0$', ''))
    as institution_key,
  {_enrollment()}, source_year, source_file
from {newest(RAW['enrollment_by_subgroup'], _PLACE_KEYS)} as picked""",
    "eog": _assessment("eog"),
    "eoc": _assessment("eoc"),
    "act": _act(),
    "sat": _sat(),
    "direct_certification": _direct_certification(),
    "revenues": _revenues(),
}


def _register_silver(name: str) -> None:
    @query(f"silver_{name}", oracle=SILVER_SQL[name])
    def build(t: Tables) -> DataFrame:
        return silver(t, name)


for _name in SILVER_SQL:
    _register_silver(_name)


# -- dimensions -----------------------------------------------------------------------------

_versions = ", ".join(
    "institution_key institution_number institution_name district_code district_name detail_level "
    "grades_served school_year".split()
)
_school_versions = f"""select {_versions}, 0 as prio from ({SILVER_SQL['enrollment_by_grade']}) as e
  union all select {_versions}, 1 as prio from ({SILVER_SQL['revenues']}) as r"""
_attributes = (
    "institution_number asc nulls last, institution_name asc nulls last, district_code asc nulls last, "
    "district_name asc nulls last, detail_level asc nulls last, grades_served asc nulls last"
)

DIM_SQL = {
    "year": f"""select row_number() over (order by sort_order nulls first, school_year nulls first) as year_key, *
from (select distinct school_year, cast(substring(school_year, 1, 4) as integer) as start_calendar_year,
    cast(substring(school_year, 1, 4) as integer) + 1 as end_calendar_year,
    cast(substring(school_year, 1, 4) as integer) + 1 as fiscal_year,
    cast(substring(school_year, 1, 4) as integer) + 1 as sort_order
  from ({SILVER_SQL['enrollment_by_grade']}) as e) as years""",
    "subgroup": f"""select row_number() over (order by subgroup_category, subgroup nulls first) as subgroup_key, *
from (select distinct subgroup_name as subgroup,
    case when subgroup_name = 'All Students' then 'Total'
      when subgroup_name in ('Asian', 'Black', 'Hispanic', 'White', 'Multi-Racial', 'American Indian',
        'Pacific Islander', 'Two or More Races') then 'Race/Ethnicity'
      when subgroup_name in ('Male', 'Female') then 'Gender'
      when subgroup_name in ('English Learners', 'Students with Disabilities', 'SWD', 'EL',
        'Limited English Proficient', 'Migrant', 'Homeless') then 'Special Populations'
      when subgroup_name in ('Economically Disadvantaged', 'ED', 'Foster Care') then 'Economic Status'
      else 'Other' end as subgroup_category,
    coalesce(subgroup_name = 'All Students', false) as is_total
  from ({SILVER_SQL['eog']}) as g) as labels""",
    "assessment": f"""select row_number() over (order by assessment_category, assessment_name,
    grade_level nulls first, subject nulls first, assessment_format nulls first, score_type nulls first)
    as assessment_key, *
from (select 'EOG' as assessment_name, test_component as subject, grade_level,
    cast(null as varchar) as assessment_format, cast(null as varchar) as score_type,
    'State' as assessment_category from ({SILVER_SQL['eog']}) as g
  union select 'EOC', test_component, null, null, null, 'State' from ({SILVER_SQL['eoc']}) as c
  union select 'SAT', test_component, null, sat_format, highest_recent_indicator, 'College Readiness'
    from ({SILVER_SQL['sat']}) as s
  union select 'ACT', test_component, null, null, highest_recent_indicator, 'College Readiness'
    from ({SILVER_SQL['act']}) as a) as members""",
    "school": f"""select row_number() over (order by institution_key nulls first) as school_key, institution_key,
  institution_number, institution_name, district_code, district_name, detail_level, grades_served,
  '2010-11' as effective_date, cast(null as varchar) as end_date, true as is_current
from (select *, row_number() over (partition by institution_key
    order by school_year desc nulls last, prio, {_attributes}) as rn
  from ({_school_versions}) as v) as ranked where rn = 1""",
}


DIM_SOURCES = {
    "year": ("enrollment_by_grade",),
    "subgroup": ("eog",),
    "assessment": ("eog", "eoc", "sat", "act"),
    "school": ("enrollment_by_grade", "revenues"),
}
_DIM_BUILDERS = {
    "year": D.dim_year,
    "subgroup": D.dim_subgroup,
    "assessment": D.dim_assessment,
    "school": D.dim_school,
}


def dimension(t: Tables, name: str, source=silver) -> DataFrame:
    return _DIM_BUILDERS[name](*[source(t, s) for s in DIM_SOURCES[name]])


def _register_dim(name: str) -> None:
    @query(f"dim_{name}", oracle=DIM_SQL[name])
    def build(t: Tables) -> DataFrame:
        return dimension(t, name)


for _name in DIM_SQL:
    _register_dim(_name)


@query(
    "school_attribute_spans",
    oracle=f"""select institution_key, institution_number, institution_name, district_code, district_name,
  detail_level, grades_served, min(school_year) as first_year, max(school_year) as last_year
from ({_school_versions}) as v
group by institution_key, institution_number, institution_name, district_code, district_name, detail_level,
  grades_served""",
)
def school_attribute_spans(t: Tables) -> DataFrame:
    return D.school_spans(silver(t, "enrollment_by_grade"), silver(t, "revenues"))


_state = "institution_number, institution_name, district_code, district_name, detail_level, grades_served"


@query(
    "school_history",
    oracle=f"""with yearly as (select * from (select *, row_number() over (partition by institution_key, school_year
      order by prio, {_attributes}) as rn from ({_school_versions}) as v) as ranked where rn = 1),
marked as (select *, row({_state}) as state,
    lag(row({_state})) over (partition by institution_key order by school_year) as previous,
    row_number() over (partition by institution_key order by school_year) as pos from yearly),
starts as (select * from marked where pos = 1 or previous is distinct from state)
select institution_key, {_state}, school_year as effective_date,
  lead(school_year) over (partition by institution_key order by school_year) as end_date,
  lead(school_year) over (partition by institution_key order by school_year) is null as is_current
from starts""",
)
def school_history(t: Tables) -> DataFrame:
    return D.school_history(silver(t, "enrollment_by_grade"), silver(t, "revenues"))


# -- facts -----------------------------------------------------------------------------------

_SCHOOL_JOIN = f"left join ({DIM_SQL['school']}) as ds on f.institution_key = ds.institution_key"
_YEAR_JOIN = f"left join ({DIM_SQL['year']}) as dy on f.school_year = dy.school_year"
_SUBGROUP_JOIN = f"left join ({DIM_SQL['subgroup']}) as dg on f.subgroup_label = dg.subgroup"


def _fact(name: str, columns: str, level: bool = True, subgroup: bool = False) -> str:
    where = "where f.detail_level = 'School'" if level else ""
    key, join = (", dg.subgroup_key", _SUBGROUP_JOIN) if subgroup else ("", "")
    return f"""select ds.school_key, dy.year_key{key}, {columns}
from ({SILVER_SQL[name]}) as f {_SCHOOL_JOIN} {_YEAR_JOIN} {join} {where}"""


_tests = f"""select institution_key, school_year, subgroup_name as subgroup, test_component as subject,
    grade_level as grade, cast(num_tested as double) as num_tested,
    round(proficient_pct + distinguished_pct, 2) as proficiency_rate,
    round(proficient_pct + distinguished_pct, 2) as avg_score,
    'EOG' as assessment_name, cast(null as varchar) as assessment_format, cast(null as varchar) as score_type
  from ({SILVER_SQL['eog']}) as g
  union all select institution_key, school_year, subgroup_name, test_component, null, num_tested,
    round(proficient_pct + distinguished_pct, 2), round(proficient_pct + distinguished_pct, 2), 'EOC', null, null
  from ({SILVER_SQL['eoc']}) as c
  union all select institution_key, school_year, subgroup, test_component, null, institution_num_tested, null,
    institution_avg_score, 'SAT', sat_format, highest_recent_indicator from ({SILVER_SQL['sat']}) as s
  union all select institution_key, school_year, subgroup, test_component, null, institution_num_tested, null,
    institution_avg_score, 'ACT', null, highest_recent_indicator from ({SILVER_SQL['act']}) as a"""

_attendance_fact = ", ".join(
    [
        "student_count_all, five_or_fewer_percent_all as five_or_fewer_pct_all, "
        "six_to_fifteen_percent_all as six_to_fifteen_pct_all, over_15_percent_all as over_15_pct_all, "
        "chronic_absent_perc_all"
    ]
    + [
        f"student_count_{g} as student_count_{n}, chronic_absent_perc_{g} as chronic_absent_perc_{n}"
        for g in _groups[1:]
        for n in [{"hispani": "hispanic"}.get(g, g)]
    ]
)
_fact_shares = (
    "asian", "black", "hispanic", "white", "multiracial", "native",
    "male", "female", "economically_disadvantaged", "students_with_disabilities", "english_learner", "migrant",
    "gifted", "special_ed_k12", "esol", "remedial_6_8", "remedial_9_12", "eip_k_5",
    "vocation_9_12", "alt_programs",
)
_enrollment_fact = ", ".join(f"pct_{n}" for n in _fact_shares)

FACT_SQL = {
    "fact_attendance": _fact("attendance", _attendance_fact),
    "fact_dropout": _fact("dropout_rate", "grade_range, dropout_count, dropout_rate", subgroup=True),
    "fact_enrollment": _fact("enrollment_by_subgroup", _enrollment_fact),
    "fact_enrollment_by_grade": _fact("enrollment_by_grade", "enrollment_period, grade_level, enrollment_count"),
    "fact_graduation": _fact(
        "graduation_rate", "cohort_type, graduate_count, graduation_rate, cohort_count", subgroup=True
    ),
    "fact_revenues": _fact("revenues", "revenue_expenditure_type, category, amount, amount_per_fte"),
    "fact_school_performance": f"""select ds.school_key, dy.year_key, dg.subgroup_key, da.assessment_key,
  f.num_tested, f.avg_score, f.proficiency_rate, cast(null as double) as participation_rate
from ({_tests}) as f {_SCHOOL_JOIN} {_YEAR_JOIN}
left join ({DIM_SQL['subgroup']}) as dg on f.subgroup = dg.subgroup
left join ({DIM_SQL['assessment']}) as da on f.assessment_name = da.assessment_name and f.subject = da.subject
  and coalesce(f.grade, '') = coalesce(da.grade_level, '')
  and coalesce(f.assessment_format, '') = coalesce(da.assessment_format, '')
  and coalesce(f.score_type, '') = coalesce(da.score_type, '')""",
    "fact_staffing": _fact(
        "certified_personnel", "employee_type, data_category, data_sub_category, staff_count", level=False
    ),
}
_SUBGROUP_FACTS = ("fact_dropout", "fact_graduation", "fact_school_performance")


def fact(t: Tables, name: str) -> DataFrame:
    """A fact with its dimensions.  Typed tables that several of them read are written
    once, with the columns that they read; the others are read in place."""
    _, build = FA.FACTS[name]
    dims = ["school", "year"]
    if name in _SUBGROUP_FACTS:
        dims.append("subgroup")
    if name == "fact_school_performance":
        dims.append("assessment")
    staged = staging.stage([name, *(f"dim_{d}" for d in dims)], lambda s: silver(t, s))
    with ThreadPoolExecutor(len(dims)) as builders:
        built = dict(zip(dims, builders.map(lambda d: _DIM_BUILDERS[d](*staging.inputs(f"dim_{d}", staged)), dims), strict=True))
    return build(*staging.inputs(name, staged), built)


def _register_fact(name: str) -> None:
    @query(name, oracle=FACT_SQL[name])
    def build(t: Tables) -> DataFrame:
        return fact(t, name)


for _name in FACT_SQL:
    _register_fact(_name)
