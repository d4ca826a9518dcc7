"""Full load: report files to raw tables, typed tables, dimensions and facts.

Every layer reads the tables the layer before it wrote, so Catalyst knows their sizes
and a lost executor costs only the tasks of the current write.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans import dims
from rollcall.plans.checks import validate_fact, validate_silver
from rollcall.plans.facts import FACTS
from rollcall.plans.feeds import SILVER_SOURCES, build_silver
from rollcall.sources import files, tables
from rollcall.sources.tables import BRONZE, GOLD, SILVER, table_scan

# Dimension: (typed tables it reads, builder).
DIMENSIONS = {
    "dim_year": (("enrollment_by_grade",), dims.dim_year),
    "dim_school": (("enrollment_by_grade", "revenues"), dims.dim_school),
    "dim_subgroup": (("eog",), dims.dim_subgroup),
    "dim_assessment": (("eog", "eoc", "sat", "act"), dims.dim_assessment),
}
# The SAT table keeps its schema: a change is an error there.
FIXED_SCHEMA = ("sat",)


def table_name(report_type: str) -> str:
    """Catalog names hold letters, digits and underscores only."""
    return re.sub(r"\W", "_", report_type)


def load_bronze(spark: SparkSession, root: str, layer: str = BRONZE) -> dict[str, int]:
    """Replace the raw layer: one string table per report type, and the dictionary.

    The new tables are published together when all of them are written.  Where the upload
    has no dictionary, the one of the layer stays.
    """
    members = defaultdict(list)
    for report_type, groups in sorted(files.report_layout(spark, root).items()):
        members[table_name(report_type)] += groups
    dictionary = files.dictionary_files(spark, root)
    with tables.publication(spark, layer, whole=True) as new:
        rows = {name: new.write(files.read_groups(spark, groups, root), name) for name, groups in members.items()}
        if dictionary:
            rows[files.DICTIONARY_FOLDER] = new.write(files.read_with_inference(spark, dictionary), files.DICTIONARY_FOLDER)
        else:
            new.keep(files.DICTIONARY_FOLDER)
    return rows


def load_dictionary(spark: SparkSession, paths: str, layer: str = BRONZE) -> int:
    with tables.publication(spark, layer) as new:
        return new.write(files.read_with_inference(spark, paths), files.DICTIONARY_FOLDER)


def _available(spark: SparkSession, layer: str, names: Sequence[str]) -> dict[str, DataFrame]:
    present = set(tables.layer_tables(spark, layer))
    return {n: table_scan(spark, layer, n) for n in names if n in present}


def load_silver(
    spark: SparkSession, names: Sequence[str] | None = None, bronze: str = BRONZE, silver: str = SILVER
) -> dict[str, int]:
    """Write the typed tables whose raw tables exist."""
    rows = {}
    with tables.publication(spark, silver) as new:
        for name in names or SILVER_SOURCES:
            raw = _available(spark, bronze, SILVER_SOURCES[name])
            if not raw:
                continue
            mode = "fail" if name in FIXED_SCHEMA else "replace"
            rows[name] = new.write(build_silver(name, raw), name, on_schema_change=mode)
    return rows


def load_gold(spark: SparkSession, silver: str = SILVER, gold: str = GOLD) -> dict[str, int]:
    """Write the dimensions, then the facts whose typed tables exist.

    Members that a dimension of the layer knows keep their keys; new ones are numbered
    behind them.
    """
    rows = {}
    with tables.publication(spark, gold) as new:
        for name, (sources, build) in DIMENSIONS.items():
            found = _available(spark, silver, sources)
            if len(found) == len(sources):
                previous = _available(spark, gold, [name]).get(name)
                rows[name] = new.write(build(*found.values(), previous=previous), name)
        built = {d.removeprefix("dim_"): new.scan(d) for d in DIMENSIONS if d in rows}
        for name, (sources, build) in FACTS.items():
            found = _available(spark, silver, sources)
            if len(found) == len(sources):
                rows[name] = new.write(build(*found.values(), built), name)
    return rows


def validate(spark: SparkSession, silver: str = SILVER, gold: str = GOLD) -> dict[str, DataFrame]:
    """One report per typed table and fact, lazily."""
    reports = {n: validate_silver(n, df) for n, df in _available(spark, silver, list(SILVER_SOURCES)).items()}
    reports.update({n: validate_fact(n, df) for n, df in _available(spark, gold, list(FACTS)).items()})
    return reports
