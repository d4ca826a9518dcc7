"""Typed tables shared by several dimensions and facts, written once with what those read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from rollcall.operators.shape import cols_of
from rollcall.plans.dims import SCHOOL_ATTRIBUTES
from rollcall.plans.facts import ATTENDANCE_SUBGROUPS, ENROLLMENT_SHARES, FACT_PROGRAMS
from rollcall.session import pin

_PLACE = ("institution_key", "school_year")
_SCHOOL_VERSION = ("institution_key", *SCHOOL_ATTRIBUTES, "school_year")
_STATE_TEST = (*_PLACE, "subgroup_name", "test_component", "num_tested", "proficient_pct", "distinguished_pct")
_COLLEGE_TEST = (
    *_PLACE, "subgroup", "test_component", "institution_num_tested", "institution_avg_score", "highest_recent_indicator",
)
_ATTENDANCE = tuple(
    f"{metric}_{group.lower()}" for group in ATTENDANCE_SUBGROUPS for metric in ("student_count", "chronic_absent_perc")
)

# Consumer: typed table to the columns it reads of it.
DEMAND: dict[str, dict[str, tuple[str, ...]]] = {
    "dim_year": {"enrollment_by_grade": ("school_year",)},
    "dim_school": {"enrollment_by_grade": _SCHOOL_VERSION, "revenues": _SCHOOL_VERSION},
    "dim_subgroup": {"eog": ("subgroup_name",)},
    "dim_assessment": {
        "eog": ("test_component", "grade_level"),
        "eoc": ("test_component",),
        "sat": ("test_component", "sat_format", "highest_recent_indicator"),
        "act": ("test_component", "highest_recent_indicator"),
    },
    "fact_attendance": {
        "attendance": (
            *_PLACE, "detail_level", *_ATTENDANCE, "five_or_fewer_percent_all", "six_to_fifteen_percent_all", "over_15_percent_all",
        )
    },
    "fact_dropout": {
        "dropout_rate": (*_PLACE, "detail_level", "subgroup_label", "grade_range", "dropout_count", "dropout_rate")
    },
    "fact_enrollment": {
        "enrollment_by_subgroup": (
            *_PLACE, "detail_level", *(f"pct_{name}" for name in (*ENROLLMENT_SHARES.values(), *FACT_PROGRAMS)),
        )
    },
    "fact_enrollment_by_grade": {
        "enrollment_by_grade": (*_PLACE, "detail_level", "enrollment_period", "grade_level", "enrollment_count")
    },
    "fact_graduation": {
        "graduation_rate": (
            *_PLACE, "detail_level", "subgroup_label", "cohort_type", "graduate_count", "graduation_rate", "cohort_count",
        )
    },
    "fact_revenues": {
        "revenues": (*_PLACE, "detail_level", "revenue_expenditure_type", "category", "amount", "amount_per_fte")
    },
    "fact_school_performance": {
        "eog": (*_STATE_TEST, "grade_level"),
        "eoc": _STATE_TEST,
        "sat": (*_COLLEGE_TEST, "sat_format"),
        "act": _COLLEGE_TEST,
    },
    "fact_staffing": {
        "certified_personnel": (*_PLACE, "employee_type", "data_category", "data_sub_category", "staff_count")
    },
}
# Tables that are written at a time.
WRITERS = 4


def demand(consumers: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """Typed table to the columns that any of the consumers reads."""
    columns: dict[str, dict[str, None]] = {}
    for consumer in consumers:
        for table, names in DEMAND[consumer].items():
            columns.setdefault(table, {}).update(dict.fromkeys(names))
    return {table: tuple(names) for table, names in columns.items()}


def stage(consumers: Iterable[str], build: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The typed tables of the consumers, each with the columns that are read.

    Tables are built a few at a time, because building one runs jobs of its own, and those of
    more than one consumer are written so, that one's last tasks leave no core idle; the
    others are left to be read in place.
    """
    consumers = list(consumers)
    uses = Counter(table for consumer in consumers for table in DEMAND[consumer])
    wanted = demand(consumers)
    shared = [table for table, n in uses.items() if n > 1]
    with ThreadPoolExecutor(WRITERS) as writers:
        tables = dict(zip(wanted, writers.map(lambda table: build(table).select(*cols_of(wanted[table])), wanted), strict=True))
        written = writers.map(lambda table: pin(tables[table], f"staged_{table}"), shared)
        tables.update(zip(shared, written, strict=True))
    return tables


def inputs(consumer: str, staged: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The typed tables of one consumer, in the order its builder takes them."""
    return [staged[table] for table in DEMAND[consumer]]
