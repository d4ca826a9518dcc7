"""Mergeable states against recomputation, and counts taken from writes."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rollcall.operators import states, summary
from rollcall.plans.reconcile import write_reconciled
from rollcall.sources import tables
from tests.conftest import plan_of, rows_of
from tests.test_publication import jobs, layer  # noqa: F401
from workload.feed_queries import raw_tables
from workload.registry import Tables

ROWS = "source_file string, v double, w double"


def table_of(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(f"f{rng.randrange(6)}", rng.choice([None, 1e9 + rng.random()]), None if i % 2 else float(i)) for i in range(n)]
    return rows, spark.createDataFrame(rows, ROWS)


def test_merged_profile_equals_recomputation(spark):
    rows, df = table_of(spark, 500)
    state = states.profile_state(df.filter("source_file < 'f4'"), ["v", "w"]).unionByName(states.profile_state(df.filter("source_file >= 'f4'"), ["v", "w"]))
    got = {r["measure"]: r for r in states.merge_profiles(state).collect()}
    known = [v for _, v, _ in rows if v is not None]
    assert got["v"]["n"] == len(known) and got["v"]["n_missing"] == 500 - len(known)
    # large values that differ little: nothing cancels
    assert math.isclose(got["v"]["stddev_value"], statistics.stdev(known), rel_tol=1e-6)
    whole = {r["measure"]: r for r in summary.numeric_profile(df, ["v", "w"]).collect()}
    for name in ("v", "w"):
        assert all(got[name][c] == whole[name][c] for c in ("n", "min_value", "max_value"))
        assert all(math.isclose(got[name][c], whole[name][c], rel_tol=1e-6) for c in ("mean_value", "total_value", "stddev_value"))


def test_profile_of_nulls_and_single_values(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", None, None)], ROWS)
    got = {r["measure"]: tuple(r)[1:] for r in states.merge_profiles(states.profile_state(df, ["v", "w"])).collect()}
    assert got == {"v": (0, 2, None, None, None, None, None), "w": (1, 1, 1.0, 1.0, 1.0, None, 1.0)}
    assert states.merge_profiles(states.profile_state(df.limit(0), ["v"])).count() == 0


def test_distinct_states_merge(spark):
    rng = random.Random(2)
    rows = [(f"y{rng.randrange(4)}", rng.choice([None, 0, 1, 32767, 32768, 32769, 70000, *range(50)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "y string, code int")
    parts = [states.distinct_state(df.filter(F.col("y") == f"y{i}"), ["y"], {"codes": "code"}) for i in range(4)]
    state = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[0])
    per_year = {r["y"]: r["values"] for r in states.merge_distinct(state, ["y"]).collect()}
    assert per_year == {y: len({c for z, c in rows if z == y and c is not None}) for y in {y for y, _ in rows}}
    assert states.merge_distinct(state).first()["values"] == len({c for _, c in rows if c is not None})
    assert "Expand" not in plan_of(states.distinct_state(df, ["y"], {"a": "code", "b": "code"}))


def test_reconciliation_scans_once(spark, layer, tmp_path):  # noqa: F811
    raw = {}
    for name, df in raw_tables(Tables(spark, "/root/testdata/sf0.001"), "direct_certification").items():
        df.write.parquet(str(tmp_path / name))
        raw[name] = spark.read.parquet(str(tmp_path / name))
    scanned = spark.read.parquet(str(tmp_path / "direct_certification_school")).filter("FISCAL_YEAR is not null").count()
    scanned += spark.read.parquet(str(tmp_path / "direct_certification_district")).filter("FISCAL_YEAR is not null").count()
    with tables.publication(spark, layer) as new:
        report = write_reconciled("direct_certification", raw, lambda df: new.write(df, "direct_certification"))
    row = report.first()
    written = tables.table_scan(spark, layer, "direct_certification").count()
    assert (row["status"], row["observed"], row["expected"]) == ("pass", written, f"{scanned} - {scanned - written}")
    before = jobs(spark)
    assert rows_of(tables.read_back(spark, layer, "direct_certification")) == [(f"{layer}.direct_certification", written, 13)]
    assert jobs(spark) - before <= 2  # the manifest and the local row
    # a write that loses rows fails
    with tables.publication(spark, layer) as new:
        report = write_reconciled("direct_certification", raw, lambda df: new.write(df, "direct_certification") - 1)
    assert report.first()["status"] == "fail"
    with pytest.raises(ValueError):
        write_reconciled("sat", {}, lambda df: 0)
