"""Report-shaped raw tables derived from the supplied tables.

Each text is valid in both engines.  The supplied tables hold no NULLs, codes or
unmatched members, so the projections put them in.
"""

from __future__ import annotations

from rollcall.plans.feeds import (
    ATTENDANCE_RATES,
    ATTENDANCE_SUBGROUPS,
    ENROLLMENT_PROGRAMS,
    ENROLLMENT_SHARES,
    PROFICIENCY_LEVELS,
)

SCHOOL_YEAR = (
    "concat(cast(year(l_shipdate) as string), '-', lpad(cast((year(l_shipdate) + 1) % 100 as string), 2, '0'))"
)
IS_DISTRICT = "l_partkey % 50 = 0"
IS_STATE = "l_partkey % 50 = 0 and l_suppkey % 10 = 0"
DISTRICT = f"case when {IS_STATE} then 'ALL' else cast(l_suppkey as string) end"
SCHOOL = f"case when {IS_DISTRICT} then 'ALL' else cast(l_partkey % 20 as string) end"
LEVEL = f"case when {IS_STATE} then 'State' when {IS_DISTRICT} then 'District' else 'School' end"
DISTRICT_NAME = "concat('District ', cast(l_suppkey as string))"
SCHOOL_NAME = (
    "concat('School ', cast(l_partkey % 20 as string), case when l_shipdate >= timestamp '1999-01-01 00:00:00' "
    "and l_suppkey % 3 = 0 then ' Academy' else '' end)"
)
GRADES = "case when l_partkey % 3 = 0 then 'KK,01,02' when l_partkey % 3 = 1 then '09,10,11,12' else '' end"
FILE = (
    "concat('report_', cast(l_orderkey as string), '_', cast(l_partkey as string), '_', "
    "cast(l_suppkey as string), '_', cast(l_linenumber as string), '_', cast(cast(l_quantity as bigint) as string), "
    "'.csv')"
)
FOLDER = "concat('y', cast(year(l_shipdate) as string))"
SUBGROUP = (
    "case l_linenumber when 1 then 'All Students' when 2 then 'Black' when 3 then 'Female' "
    "when 4 then 'Students with Disabilities' when 5 then 'Economically Disadvantaged' "
    "when 6 then 'Gifted' else 'Two or More Races' end"
)
# Labels of the rate reports: one spelled as in the subgroup dimension, one not.
RATE_LABEL = "case when l_linenumber = 1 then 'ALL Students' when l_linenumber = 2 then 'Black' else 'Female' end"
SUBJECT = "case l_returnflag when 'A' then 'Mathematics' when 'N' then 'Science' else 'English Language Arts' end"


def whole(i: int) -> str:
    """The i-th count as text, with suppressed and missing cells."""
    return (
        f"case when (l_orderkey + {i}) % 11 = 0 then 'TFS' when (l_partkey + {i}) % 13 = 0 then null "
        f"else cast((cast(l_quantity as bigint) + {i}) % 60 as string) end"
    )


def percent(i: int, codes: tuple[str, ...] = ("TFS",)) -> str:
    """The i-th percentage as text with two decimals, 0.00 to 100.99."""
    hits = " ".join(f"when (l_orderkey + {i}) % 11 = {n} then '{c}'" for n, c in enumerate(codes))
    return (
        f"case {hits} else concat(cast((l_orderkey + {7 * i}) % 101 as string), '.', "
        f"lpad(cast((l_partkey * 3 + {i}) % 100 as string), 2, '0')) end"
    )


PLACE = f"""{SCHOOL_YEAR} as LONG_SCHOOL_YEAR, {DISTRICT} as SCHOOL_DSTRCT_CD, {SCHOOL} as INSTN_NUMBER,
  {LEVEL} as DETAIL_LVL_DESC, {DISTRICT_NAME} as SCHOOL_DSTRCT_NM, {SCHOOL_NAME} as INSTN_NAME,
  {GRADES} as GRADES_SERVED_DESC"""
# The two sources of the school dimension spell some districts differently, and the source
# of the year dimension labels one year differently, so that other reports have unmatched keys.
LISTED_DISTRICT = (
    f"case when {IS_STATE} then 'ALL' when l_suppkey % 7 = 0 then concat('X', cast(l_suppkey as string)) "
    "else cast(l_suppkey as string) end"
)
LISTED_PLACE = PLACE.replace(f"{DISTRICT} as", f"{LISTED_DISTRICT} as").replace(
    f"{SCHOOL_YEAR} as", f"case when year(l_shipdate) = 1996 then '2010-11' else {SCHOOL_YEAR} end as"
)
LINEAGE = f"{FOLDER} as source_year, {FILE} as source_file"

_families = [
    f"{whole(5 * i) if n == 0 else percent(5 * i + n)} as {metric}_{group}"
    for i, group in enumerate(ATTENDANCE_SUBGROUPS)
    for n, metric in enumerate(("STUDENT_COUNT", *ATTENDANCE_RATES))
]
_CODES = ("TFS", "N/A", "*")
_shares = [f"{percent(i, _CODES)} as ENROLL_PCT_{raw}" for i, raw in enumerate(ENROLLMENT_SHARES)]
_programs = [
    f"case when l_linenumber = 6 then 'N/A' when l_linenumber = 5 then '*' else {whole(i)} end "
    f"as ENROLL_COUNT_{raw}, {percent(20 + i, _CODES)} as {prefix}_{raw}"
    for i, (raw, (_, prefix)) in enumerate(ENROLLMENT_PROGRAMS.items())
]
_levels = [f"cast((l_partkey + {i}) % 9 as string) as {level}_CNT" for i, level in enumerate(PROFICIENCY_LEVELS)]
# Shares that add up to 100.00, except where the first one is off.
_level_shares = [
    "case when l_quantity < 3 then 'TFS' when l_partkey % 40 = 1 then '24.00' else '25.25' end as BEGIN_PCT",
    "cast(cast(20 + l_linenumber as decimal(5,2)) as string) as DEVELOPING_PCT",
    "cast(cast(30 - l_linenumber as decimal(5,2)) as string) as PROFICIENT_PCT",
    "case when l_quantity < 3 then 'TFS' else '24.75' end as DISTINGUISHED_PCT",
]


def _assessment(grade: str) -> str:
    return f"""select {SCHOOL_YEAR} as LONG_SCHOOL_YEAR, {DISTRICT} as SCHOOL_DISTRCT_CD, {SCHOOL} as INSTN_NUMBER,
  {DISTRICT_NAME} as SCHOOL_DSTRCT_NM, {SCHOOL_NAME} as INSTN_NAME, {grade} as ACDMC_LVL,
  {SUBGROUP} as SUBGROUP_NAME, {SUBJECT} as TEST_CMPNT_TYP_NM,
  case when l_quantity < 3 then 'TFS' when l_partkey % 30 = 2 then '99' else
    cast(l_partkey % 9 + (l_partkey + 1) % 9 + (l_partkey + 2) % 9 + (l_partkey + 3) % 9 as string) end
    as NUM_TESTED_CNT,
  {', '.join(_levels)}, {', '.join(_level_shares)}, {LINEAGE}
from lineitem"""


ACT_COMPONENT = (
    "case l_orderkey % 5 when 0 then 'Composite' when 1 then 'English' when 2 then 'Mathematics' "
    "when 3 then 'Reading' else 'Science' end"
)
SAT_COMPONENT = (
    "case l_orderkey % 6 when 0 then 'Combined Test Score' when 1 then 'Reading Test  Score - New' "
    "when 2 then 'Evidence Based Reading and Writing - New' when 3 then 'Essay Total' "
    "when 4 then 'Combined' else 'Mathematics' end"
)


def _scores(count: str, score: str) -> str:
    names = ("NATIONAL", "STATE", "DSTRCT", "INSTN")
    return ", ".join(
        f"{count.format(i=i)} as {n}_NUM_TESTED_CNT, {score.format(i=i)} as {n}_AVG_SCORE_VAL"
        for i, n in enumerate(names)
    )


_act_scores = _scores(
    "case when l_quantity < 4 then 'TFS' when l_linenumber = 7 then null else "
    "concat(cast((cast(l_quantity as bigint) + {i}) % 60 as string), case when l_orderkey % 2 = 0 then '.0' else '' end) end",
    "case when l_quantity < 4 then 'TFS' else concat(cast(1 + (l_orderkey + {i}) % 36 as string), '.5') end",
)
_sat_scores = _scores(
    "case when l_quantity < 4 then 'TFS' when l_linenumber = 6 then 'N/A' else "
    "concat(cast((cast(l_quantity as bigint) + {i}) % 60 as string), '.5') end",
    "case when l_quantity < 4 then 'N/A' else cast(400 + (l_orderkey + {i}) % 1200 as string) end",
)


def _act(columns: str, where: str) -> str:
    return f"""select {SCHOOL_YEAR} as LONG_SCHOOL_YEAR, {columns}, {SCHOOL} as INSTN_NUMBER,
  {DISTRICT_NAME} as SCHOOL_DSTRCT_NM, {SCHOOL_NAME} as INSTN_NAME, {SUBGROUP} as SUBGRP_DESC,
  {ACT_COMPONENT} as TEST_CMPNT_TYP_CD, {_act_scores}, '01' as "#ASSMT_CD",
  case when l_linestatus = 'F' then 'Highest' else 'Recent' end as HIGHEST_RECENT_IND, {LINEAGE}
from lineitem where {where}"""


def _sat(where: str, indicator: bool) -> str:
    """District code and name are missing in part of the rows, per school or per row."""
    ind = "case when l_linestatus = 'F' then 'Highest' else 'Recent' end as HIGHEST_RECENT_IND, " if indicator else ""
    return f"""select {SCHOOL_YEAR} as LONG_SCHOOL_YEAR,
  case when l_suppkey % 9 = 0 or l_orderkey % 17 = 0 then null else {DISTRICT} end as SCHOOL_DISTRCT_CD,
  case when l_suppkey % 9 = 0 or l_orderkey % 17 = 0 then null else {DISTRICT_NAME} end as SCHOOL_DSTRCT_NM,
  {SCHOOL} as INSTN_NUMBER,
  case when l_orderkey % 23 = 0 then null
    else concat('School ', cast(l_partkey % 20 as string), ' of ', cast(l_suppkey - l_suppkey % 2 as string)) end
    as INSTN_NAME,
  {SUBGROUP} as SUBGRP_DESC, {SAT_COMPONENT} as TEST_CMPNT_TYP_CD, {ind}{_sat_scores}, '02' as "#ASSMT_CD",
  {FOLDER} as source_year, concat('sat_', cast(l_orderkey % 3 as string), '.csv') as source_file
from lineitem where {where}"""


def _direct_certification(school: str) -> str:
    return f"""select case when l_linenumber = 7 then null else concat(cast(year(l_shipdate) as string), '.0') end
    as FISCAL_YEAR,
  concat(cast(l_suppkey as string), case when l_orderkey % 2 = 0 then '.0' else '' end) as SYSTEM_ID,
  {DISTRICT_NAME} as SYSTEM_NAME, {school}
  {percent(3)} as DIRECT_CERT_PERC, {whole(1)} as K12_POVERTY_STUDENT_CT, {whole(9)} as K12_STUDENT_COUNT,
  'x' as "_c1", {LINEAGE}
from lineitem"""


IS_OLD = "l_shipdate < timestamp '1998-01-01 00:00:00'"


def _revenues() -> str:
    """Old and new spellings side by side; each row fills one of them."""
    district, school = f"({LISTED_DISTRICT})", f"({SCHOOL})"
    old = {
        "SCHOOL_YEAR": SCHOOL_YEAR,
        "DISTRICT_CODE": district,
        "DISTRICT_NAME": DISTRICT_NAME,
        "SCHOOL_CODE": school,
        "SCHOOL_NAME": SCHOOL_NAME,
        '"Dollars per FTE"': "cast(cast(l_extendedprice as decimal(12,2)) as string)",
    }
    new = {
        "LONG_SCHOOL_YEAR": SCHOOL_YEAR,
        "SCHOOL_DSTRCT_CD": district,
        "SCHOOL_DSTRCT_NM": DISTRICT_NAME,
        "INSTN_NUMBER": school,
        "INSTN_NAME": SCHOOL_NAME,
        "DOLLARS_PER_FTE": "cast(cast(l_extendedprice as decimal(12,2)) as string)",
        '"#RPT_NAME"': "'Revenues and Expenditures'",
    }
    columns = [
        f"case when {cond} and l_orderkey % 29 <> 0 then {expr} end as {name}"
        for spellings, cond in ((old, IS_OLD), (new, f"not ({IS_OLD})"))
        for name, expr in spellings.items()
    ]
    return f"""select {', '.join(columns)},
  case when l_linestatus = 'F' then 'Revenues' else 'Expenditures' end as "Revenues/Expenditures",
  concat('Category ', cast(l_linenumber as string)) as Description,
  case when l_quantity < 2 then '0' when l_quantity < 4 then cast(-cast(l_tax * 100 as decimal(9,2)) as string)
    else cast(cast(l_extendedprice as decimal(12,2)) as string) end as REV_EXP_VALUE,
  {GRADES} as GRADES_SERVED_DESC, {LINEAGE}
from lineitem"""


RAW = {
    "attendance": f"select {PLACE}, {', '.join(_families)}, {LINEAGE} from lineitem",
    "certified_personnel": f"""select {PLACE},
  case when l_returnflag = 'A' then 'Gender' when l_returnflag = 'N' then 'Race' else 'Certificate' end
    as DATA_CATEGORY,
  concat('Sub ', cast(l_linenumber as string)) as DATA_SUB_CATEGORY,
  case when l_linestatus = 'F' then 'PK-12 Teachers' else 'Administrators' end as EMPLOYEE_TYPE,
  case when l_quantity < 3 then '0' when l_quantity < 4 then '-1' when l_quantity < 5 then null
    else concat(cast(cast(l_quantity as bigint) as string), '.5') end as MEASURE,
  'Certified Personnel' as "#RPT_NAME", {LINEAGE}
from lineitem""",
    "dropout_rate": f"""select {PLACE},
  concat(case when l_linestatus = 'F' then '7-12' else '9-12' end, ' Drop Outs -', {RATE_LABEL}) as LABEL_LVL_1_DESC,
  {whole(2)} as PROGRAM_TOTAL, {percent(4)} as PROGRAM_PERCENT, {LINEAGE}
from lineitem""",
    "graduation_rate": f"""select {PLACE},
  concat(case when l_linestatus = 'F' then '5 Yr Grad Rate -' else 'Grad Rate -' end, {RATE_LABEL})
    as LABEL_LVL_1_DESC,
  {whole(3)} as PROGRAM_TOTAL, {percent(6)} as PROGRAM_PERCENT, {whole(8)} as TOTAL_COUNT, {LINEAGE}
from lineitem""",
    "enrollment_by_grade": f"""select {LISTED_PLACE},
  case when l_linestatus = 'F' then 'Fall' else 'Spring' end as ENROLLMENT_PERIOD,
  case when l_linenumber = 7 then 'KK' else lpad(cast(l_linenumber as string), 2, '0') end as GRADE_LEVEL,
  {whole(0)} as ENROLLMENT_COUNT, {LINEAGE}
from lineitem""",
    "enrollment_by_subgroup": f"""select {SCHOOL_YEAR} as LONG_SCHOOL_YEAR,
  case when {IS_STATE} then 'ALL' else concat(cast(l_suppkey as string), case when l_orderkey % 2 = 0 then '.0' else '' end) end
    as SCHOOL_DSTRCT_CD,
  case when {IS_DISTRICT} then 'ALL' else concat(cast(l_partkey % 20 as string), '.0') end as INSTN_NUMBER,
  {LEVEL} as DETAIL_LVL_DESC, {DISTRICT_NAME} as SCHOOL_DSTRCT_NM, {SCHOOL_NAME} as INSTN_NAME,
  {GRADES} as GRADES_SERVED_DESC, {', '.join(_shares)}, {', '.join(_programs)}, {LINEAGE}
from lineitem""",
    "eog": _assessment("case when l_linenumber = 7 then null else concat('0', cast(3 + l_orderkey % 6 as string)) end"),
    "eoc": _assessment("cast(9 + l_orderkey % 4 as string)"),
    "act": _act(f"{DISTRICT} as SCHOOL_DSTRCT_CD", f"not ({IS_OLD})"),
    "act_highest": _act(f"{DISTRICT} as SCHOOL_DISTRCT_CD", IS_OLD),
    "sat": _sat("l_linenumber = 1", True),
    "sat_highest": _sat("l_linenumber in (2, 3)", False),
    "sat_recent": _sat("l_linenumber in (4, 5)", False),
    "sat_new_highest": _sat("l_linenumber = 6", False),
    "sat_new_recent": _sat("l_linenumber = 7", False),
    "direct_certification_district": _direct_certification(""),
    "direct_certification_school": _direct_certification(
        "concat(cast(l_partkey % 20 as string), case when l_orderkey % 2 = 0 then '.0' else '' end) as SCHOOL_ID, "
        "case when l_linenumber = 6 then null else concat('School ', cast(l_partkey % 20 as string)) end as SCHOOL_NAME,"
    ),
    "revenues": _revenues(),
}
