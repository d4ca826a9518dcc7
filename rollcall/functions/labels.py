"""Column functions that read years, levels and classes out of labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.cleanse import strip_zero_fraction

# Codes, label prefixes and categories of the source reports.
AGGREGATE_CODE = "ALL"
DROPOUT_RANGES = (("7-12", "7-12"),)
DROPOUT_DEFAULT_RANGE = "9-12"
DROPOUT_LABEL = r"Drop Outs -(.*)"
COHORT_TYPES = (("5 Yr", "5-Year"),)
COHORT_DEFAULT = "4-Year"
COHORT_LABEL = r"Grad Rate -(.*)"
# Two of the component names carry a double space in the source.
NEW_SAT_COMPONENTS = (
    "Combined Test Score",
    "Math Section Score - New",
    "Reading Test  Score - New",
    "WritLang Test  Score - New",
    "Evidence Based Reading and Writing - New",
    "Essay Total",
    "Essay Analysis Score - New",
    "Essay Reading Score - New",
    "Essay Writing Score - New",
)
TOTAL_SUBGROUP = "All Students"
SUBGROUP_CATEGORIES = {
    "Total": ("All Students",),
    "Race/Ethnicity": (
        "Asian",
        "Black",
        "Hispanic",
        "White",
        "Multi-Racial",
        "American Indian",
        "Pacific Islander",
        "Two or More Races",
    ),
    "Gender": ("Male", "Female"),
    "Special Populations": (
        "English Learners",
        "Students with Disabilities",
        "SWD",
        "EL",
        "Limited English Proficient",
        "Migrant",
        "Homeless",
    ),
    "Economic Status": ("Economically Disadvantaged", "ED", "Foster Care"),
}
OTHER_CATEGORY = "Other"


def categorize(c: Column, groups: dict[str, Sequence[str]], default: str) -> Column:
    """Name of the first group that lists the value, else ``default`` (also for NULL)."""
    result = F
    for name, members in groups.items():
        result = result.when(c.isin(*members), name)
    return result.otherwise(default)


def subgroup_category(c: Column) -> Column:
    return categorize(c, SUBGROUP_CATEGORIES, OTHER_CATEGORY)


def classify_sat_format(c: Column, components: Iterable[str] = NEW_SAT_COMPONENTS) -> Column:
    """``new`` for components of the redesigned test, else ``old``."""
    return categorize(c, {"new": tuple(components)}, "old")


def derive_detail_level(district: Column, institution: Column) -> Column:
    """Aggregation level from the two codes, where ``ALL`` marks an aggregate."""
    whole_district = institution == AGGREGATE_CODE
    return (
        F.when(whole_district & (district == AGGREGATE_CODE), "State")
        .when(whole_district, "District")
        .otherwise("School")
    )


def prefix_class(c: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """Class of the first matching prefix, else ``default``."""
    result = F
    for prefix, name in rules:
        result = result.when(c.startswith(prefix), name)
    return result.otherwise(default)


def split_label(
    c: Column, rules: Iterable[tuple[str, str]], default: str, pattern: str
) -> tuple[Column, Column]:
    """Split ``'7-12 Drop Outs -Asian'`` style labels into (class, subgroup)."""
    return prefix_class(c, rules, default), F.regexp_extract(c, pattern, 1)


def split_dropout_label(c: Column) -> tuple[Column, Column]:
    return split_label(c, DROPOUT_RANGES, DROPOUT_DEFAULT_RANGE, DROPOUT_LABEL)


def split_graduation_label(c: Column) -> tuple[Column, Column]:
    return split_label(c, COHORT_TYPES, COHORT_DEFAULT, COHORT_LABEL)


def fiscal_year(c: Column) -> Column:
    """``'2024.0'`` as int 2024."""
    return strip_zero_fraction(c).try_cast("int")


def fiscal_to_school_year(c: Column, short: bool = False) -> Column:
    """Fiscal year 2024 as school year ``'2023-24'`` (``'23-24'`` when ``short``).

    The four-digit form is the default because it is the one that matches the year
    dimension; NULL or unreadable years stay NULL.
    """
    year = fiscal_year(c)
    start = F.try_subtract(year, F.lit(1)).cast("string")
    if short:
        start = F.right(start, F.lit(2))
    return F.concat(start, F.lit("-"), F.right(year.cast("string"), F.lit(2)))


def year_start(c: Column) -> Column:
    """``'2023-24'`` as 2023."""
    return F.substring(c, 1, 4).try_cast("int")


def year_end(c: Column) -> Column:
    """``'2023-24'`` as 2024 and ``'1999-00'`` as 2000: the first such year after the start."""
    start, end = year_start(c), F.substring(c, 6, 2).try_cast("int")
    century = start - start % 100
    return century + end + F.when(end < start % 100, 100).otherwise(0)
