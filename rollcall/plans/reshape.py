"""Long form of the two wide feeds: one row per place, year and subgroup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.shape import wide_to_long
from rollcall.plans.feeds import ATTENDANCE_RATES, ATTENDANCE_SUBGROUPS, ENROLLMENT_PROGRAMS

# Kinds of enrollment subgroups.
ENROLLMENT_KINDS = {
    "race_ethnicity": ("asian", "native", "black", "hispanic", "multiracial", "white"),
    "gender": ("male", "female"),
    "special_population": (
        "migrant",
        "economically_disadvantaged",
        "students_with_disabilities",
        "english_learner",
    ),
}


def enrollment_long(df: DataFrame, ids: Sequence[str], drop_empty: bool = False) -> DataFrame:
    """Typed subgroup enrollment as (subgroup_type, subgroup_name, count, percent)."""
    families = [
        (kind, name, (None, f"pct_{name}")) for kind, names in ENROLLMENT_KINDS.items() for name in names
    ]
    families += [
        ("program", name, (f"count_{name}", f"pct_{name}")) for name, _ in ENROLLMENT_PROGRAMS.values()
    ]
    return wide_to_long(df, ids, families, drop_empty=drop_empty)


def attendance_long(df: DataFrame, ids: Sequence[str], drop_empty: bool = False) -> DataFrame:
    """Typed attendance as one row per subgroup with its five metrics."""
    metrics = ["student_count", *[r.lower() for r in ATTENDANCE_RATES]]
    families = [
        ("attendance", group.lower(), [f"{m}_{group}".lower() for m in metrics])
        for group in ATTENDANCE_SUBGROUPS
    ]
    types = {m: "int" if m == "student_count" else "decimal(5,1)" for m in metrics}
    long = wide_to_long(df, ids, families, ("_kind", "subgroup"), types, drop_empty)
    return long.select(*ids, "subgroup", *[F.col(m) for m in metrics])
