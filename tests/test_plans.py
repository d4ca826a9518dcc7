"""Plans of single operators: scans, exchanges and what is written; and results that hang on them."""

import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from rollcall.functions.labels import year_end
from rollcall.operators import conform, dedup, history, star
from rollcall.plans import facts, staging
from rollcall.plans.feeds import SAT_TABLES, build_sat, build_silver, eog, revenues
from rollcall.plans.spec import MissingKeyColumn
from tests.conftest import plan_of, rows_of
from workload.feed_queries import _DIM_BUILDERS, raw_tables, silver
from workload.registry import Tables

SF = "/root/testdata/sf0.001"


def scans(df):
    return len(re.findall(r"FileScan|Scan parquet|Scan ExistingRDD|LocalTableScan", plan_of(df)))


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|round|single)", plan_of(df), re.I))


@pytest.mark.parametrize(("label", "end"), [("2023-24", 2024), ("1999-00", 2000), ("1995-96", 1996), ("1899-00", 1900), ("2099-00", 2100), ("x", None)])
def test_year_end(spark, label, end):
    assert spark.range(1).select(year_end(F.lit(label))).first()[0] == end


def test_missing_key_column_is_an_error(spark):
    t = Tables(spark, SF)
    raw = raw_tables(t, "eog")["eog"]
    with pytest.raises(MissingKeyColumn, match="SUBGROUP_NAME"):
        eog.build(raw.drop("SUBGROUP_NAME"))
    assert eog.build(raw.drop("BEGIN_CNT")).filter("begin_count is not null").isEmpty()
    raw = raw_tables(t, "revenues")["revenues"]
    assert revenues.build(raw.drop("SCHOOL_YEAR")).columns == revenues.build(raw).columns
    with pytest.raises(MissingKeyColumn, match="LONG_SCHOOL_YEAR or SCHOOL_YEAR"):
        revenues.build(raw.drop("SCHOOL_YEAR", "LONG_SCHOOL_YEAR"))


def test_sat_rows_that_differ_in_an_unread_column_stay(spark):
    raw = raw_tables(Tables(spark, SF), "sat")
    plain = build_sat({"sat": raw["sat"]}).count()
    marked = raw["sat"].limit(1).withColumn("EXTRA", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("b"))))
    more = build_sat({"sat": raw["sat"].withColumn("EXTRA", F.lit("z")).unionByName(marked)}).count()
    assert more == plain + 2


def test_sat_reads_each_table_once(spark, tmp_path):
    raw = {}
    for name, df in raw_tables(Tables(spark, SF), "sat").items():
        df.write.parquet(str(tmp_path / name))
        raw[name] = spark.read.parquet(str(tmp_path / name))
    built = build_sat(raw)
    assert len(raw) == len(SAT_TABLES) == 5
    assert scans(built) == 2  # the union as it was written: its rows and its lookup
    assert not any(str(tmp_path / name) in plan_of(built) for name in raw)


def test_backfill_reads_rows_once(spark, tmp_path):
    rows = spark.range(3000).selectExpr("cast(id % 50 as string) k", "if(id % 3 = 0, null, cast(id % 50 as string)) d", "id")
    rows.write.parquet(str(tmp_path / "t"))
    filled = conform.backfill(spark.read.parquet(str(tmp_path / "t")), ["k"], ["d"])
    assert scans(filled) == 2
    assert filled.filter("d is null or d <> k").isEmpty() and filled.count() == 3000
    # complete rows spread where the join shuffles
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = conform.backfill(spark.read.parquet(str(tmp_path / "t")), ["k"], ["d"])
        assert "xxhash64" in plan_of(filled) and filled.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_has_one_exchange_and_long_keys(spark):
    versions = 100_000
    rows = spark.range(versions + 500).selectExpr(
        f"if(id < {versions}, 'hot', concat('k', id)) k", "lpad(cast(id as string), 8, '0') y", "cast(id div 2 % 7 as string) name", "0 p"
    )
    got = history.scd2_history(rows, ["k"], ["name"], "y", ["p"])
    assert exchanges(got) == 1
    hot = got.filter("k = 'hot'")
    assert hot.count() == versions // 2 and hot.filter("is_current").count() == 1
    assert hot.filter("end_date is not null and end_date <= effective_date").isEmpty()
    assert got.filter("k <> 'hot'").count() == 500


def test_history_equals_plain_version(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([None, *map(str, range(12))]), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), rng.randrange(2))
        for _ in range(400)
    ]
    expected = []
    last = lambda v: (v is None, "" if v is None else v if isinstance(v, str) else str(v))
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        years = sorted({r[1] for r in mine}, key=lambda v: (v is not None, v or ""))
        states = [min((r for r in mine if r[1] == y), key=lambda r: (r[4], last(r[2]), last(r[3])))[2:4] for y in years]
        starts = [i for i in range(len(years)) if i == 0 or states[i] != states[i - 1]]
        for n, i in enumerate(starts):
            end = years[starts[n + 1]] if n + 1 < len(starts) else None
            expected.append((key, *states[i], years[i], end, n + 1 == len(starts)))
    df = spark.createDataFrame(rows, "k string, y string, a string, b int, p int").repartition(5)
    got = history.scd2_history(df, ["k"], ["a", "b"], "y", ["p"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))


def test_sieved_dedup_equals_dedup(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(400)]), rng.choice([None, "a", "b"]), rng.randrange(5), str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, s string, v int, _n string").repartition(4)
    assert rows_of(dedup.dedup_sieved(df, ["k", "s"])) == rows_of(dedup.dedup(df, ["k", "s"]))
    single, recurring = dedup.split_recurring(df, ["k", "s"])
    assert single.count() + recurring.count() == 600
    assert single.groupBy("k", "s").count().filter("count > 1").isEmpty()
    # rows of keys that occur once meet no window
    assert "Window" not in plan_of(single)
    assert dedup.dedup_sieved(df.limit(0), ["k"]).count() == 0


def test_staged_tables_are_built_together(spark):
    """Two builders meet; one after the other they would wait in vain."""
    meeting = threading.Barrier(2)

    def build(table):
        meeting.wait(timeout=30)
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in staging.demand(["dim_school"])[table]))

    assert set(staging.stage(["dim_school"], build)) == {"enrollment_by_grade", "revenues"}


def test_keys_stay_over_loads(spark):
    order = [F.asc_nulls_first("code")]

    def load(codes, name, previous=None):
        df = spark.createDataFrame([(c, f"{name}{c}") for c in codes], "code string, label string")
        return star.surrogate_key(df, "key", order) if previous is None else star.surrogate_key_onto(df, previous, "key", ["code"], order)

    first = load(["b", None, "d"], "x")
    second = load(["a", "b", None, "c"], "y", first)
    assert rows_of(second) == rows_of(spark.createDataFrame(
        [(1, None, "yNone"), (2, "b", "yb"), (3, "d", "xd"), (4, "a", "ya"), (5, "c", "yc")], "key long, code string, label string"
    ))
    third = load(["a", "e"], "z", second)
    assert {r["code"]: r["key"] for r in third.collect()} == {None: 1, "b": 2, "d": 3, "a": 4, "c": 5, "e": 6}
    assert rows_of(load(["q"], "w", second.limit(0)).select("key", "code")) == [(1, "q")]
    df = spark.createDataFrame([("e", "1")], "code string, label string")
    assert rows_of(star.surrogate_key_onto(df, first, "key", ["code"], order, keep_missing=False)) == [(4, "e", "1")]


@pytest.mark.parametrize("name", sorted(staging.DEMAND))
def test_demand_is_what_a_consumer_reads(spark, tmp_path, name):
    """The staged columns suffice, and the consumer's plan reads every one of them."""
    t = Tables(spark, SF)
    staged = {}
    for table, columns in staging.demand([name]).items():
        path = str(tmp_path / table)
        silver(t, table).select(*columns).limit(20).write.parquet(path)
        staged[table] = spark.read.parquet(path)
    frames = staging.inputs(name, staged)
    if name.startswith("dim_"):
        _DIM_BUILDERS[name.removeprefix("dim_")](*frames)
        return
    dims = {
        "school": spark.range(1).selectExpr("'k' institution_key", "1L school_key"),
        "year": spark.range(1).selectExpr("'y' school_year", "1L year_key"),
        "subgroup": spark.range(1).selectExpr("'g' subgroup", "1L subgroup_key"),
        "assessment": spark.range(1).selectExpr("'a' assessment_name", "'s' subject", "'g' grade_level", "'f' assessment_format", "'t' score_type", "1L assessment_key"),
    }
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    plan = plan_of(facts.FACTS[name][1](*frames, dims))
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    read = set(re.findall(r"(\w+)#\d+", " ".join(re.findall(r"FileScan parquet \[([^\]]*)\]", plan))))
    assert read == {c for columns in staging.DEMAND[name].values() for c in columns}


def test_fact_writes_only_what_is_read(spark, monkeypatch):
    written = {}
    pin = staging.pin
    monkeypatch.setattr(staging, "pin", lambda df, label: written.setdefault(label, df.columns) and pin(df, label))
    consumers = ["fact_school_performance", "dim_school", "dim_year", "dim_subgroup", "dim_assessment"]
    staging.stage(consumers, lambda s: build_silver(s, raw_tables(Tables(spark, SF), s)))
    assert set(written) == {f"staged_{s}" for s in ("eog", "eoc", "sat", "act", "enrollment_by_grade")}
    for label, columns in written.items():
        assert tuple(columns) == staging.demand(consumers)[label.removeprefix("staged_")]
