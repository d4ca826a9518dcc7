"""Classification of report files by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern on the lower-cased file name, report type); the first match wins.
REPORT_TYPE_RULES = (
    (r"attendance", "attendance"),
    (r"sat_highest", "sat_highest"),
    (r"sat_recent", "sat_recent"),
    (r"sat_new_highest", "sat_new_highest"),
    (r"sat_new_recent", "sat_new_recent"),
    (r"^sat[^_]", "sat"),
    (r"act_highest", "act_highest"),
    (r"^act[^_]", "act"),
    (r"^ap[^_]", "ap"),
    (r"graduation", "graduation_rate"),
    (r"5-year", "graduation_5year"),
    (r"dropout", "dropout_rate"),
    (r"enrollment_by_grade", "enrollment_by_grade"),
    (r"enrollment_by_subgroup", "enrollment_by_subgroup"),
    (r"direct.*certification.*_d", "direct_certification_district"),
    (r"direct.*certification.*_s", "direct_certification_school"),
    (r"directly_certified_district", "direct_certification_district"),
    (r"directly_certified_school", "direct_certification_school"),
    (r"(district.*mobility|mobility.*district)", "mobility_district"),
    (r"(school.*mobility|mobility.*school)", "mobility_school"),
    (r"^crct", "crct"),
    (r"^eoct", "eoct"),
    (r"^eoc_lexile", "eoc_lexile"),
    (r"^eoc_by_grade", "eoc_by_grade"),
    (r"^eoc[^_]", "eoc"),
    (r"^eog_lexile", "eog_lexile"),
    (r"^eog_by_grade", "eog_by_grade"),
    (r"^eog[^_]", "eog"),
    (r"^gaa", "gaa"),
    (r"^ghswt", "ghswt"),
    (r"^egwa", "egwa"),
    (r"certified_personnel", "certified_personnel"),
    (r"educator", "educator"),
    (r"salaries", "salaries"),
    (r"(district.*ppe|ppe.*district)", "ppe_district"),
    (r"(school.*ppe|ppe.*school)", "ppe_school"),
    (r"(district.*fesr|fesr.*district)", "fesr_district"),
    (r"(school.*fesr|fesr.*school)", "fesr_school"),
    (r"revenues", "revenues"),
    (r"el_exit.*state", "el_exit_state"),
    (r"el_exit.*district", "el_exit_district"),
    (r"ell_deferred", "ell_deferred"),
    (r"hs_complet.*credential", "hs_completer_credentials"),
    (r"hs_complet", "hs_completers"),
    (r"highschool_completer", "hs_completers"),
    (r"hope", "hope_eligible"),
    (r"retained", "retained"),
    (r"^c11", "c11_hs_graduates"),
    (r"^c12", "c12_hs_graduates"),
)
# Suffixes cut off a file name to get its base pattern, in this order.
NAME_SUFFIXES = (
    r"_\d{4}[-_]\d{2}.*",
    r"_\d{8}_\d{6}.*",
    r"(?i)_fy\d{2,4}.*",
    r"(?i)\.csv$",
)
FALLBACK_CUT = r"[_\s]\d.*"


def classify_report_type(file_name: Column) -> Column:
    """Report type of a file name; an unknown name is cut at its first number."""
    name = F.lower(file_name)
    result = F
    for pattern, report_type in REPORT_TYPE_RULES:
        result = result.when(name.rlike(pattern), report_type)
    base = F.lower(F.regexp_replace(file_name, FALLBACK_CUT, ""))
    return result.otherwise(F.replace(base, F.lit(".csv"), F.lit("")))


def base_pattern(file_name: Column) -> Column:
    """File name without year, timestamp, fiscal-year and extension suffixes."""
    name = file_name
    for suffix in NAME_SUFFIXES:
        name = F.regexp_replace(name, suffix, "")
    return F.lower(name)
