import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.operators import conform, dedup, history, shape, star, summary
from tests.conftest import plan_of, rows_of

RAW = "k string, source_year string, source_file string, v string"


# -- de-duplication --------------------------------------------------------------------


def test_dedup_newest_file_wins_and_nulls_are_equal(table):
    df = table(
        RAW,
        ("a", "2022", "f1", "old"),
        ("a", "2023", "f0", "new"),
        ("a", "2023", "f0", "new"),
        (None, "2022", "f1", "x"),
        (None, "2022", "f2", "y"),
        ("b", None, None, "z"),
    )
    assert rows_of(dedup.dedup(df, ["k"]).select("k", "v")) == [("a", "new"), ("b", "z"), (None, "y")]


def test_dedup_same_file_takes_the_smallest_row(table):
    df = table(RAW, ("a", "2022", "f", "2"), ("a", "2022", "f", "1"), ("a", "2022", "f", None))
    assert rows_of(dedup.dedup(df, ["k"]).select("v")) == [("1",)]


def test_dedup_limits_groups_below_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = plan_of(dedup.dedup(df, ["k"]))
    assert "Partial" in plan or plan.count("WindowGroupLimit") == 2


def test_dedup_column_names_with_special_characters(table):
    df = table("`Revenues/Expenditures` string, `#RPT.NAME` string", ("a", "1"), ("a", "2"))
    assert rows_of(dedup.dedup(df, ["Revenues/Expenditures"])) == [("a", "1")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "a", "b"]),
            st.sampled_from([None, "2022", "2023"]),
            st.sampled_from([None, "f1", "f2"]),
            st.sampled_from([None, "1", "2", "3"]),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_dedup_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, RAW).repartition(3)

    def descending(v):
        return (v is None, [-ord(c) for c in v or ""])

    best = {}
    for row in sorted(rows, key=lambda r: (descending(r[1]), descending(r[2]), (r[3] is None, r[3] or ""))):
        best.setdefault(row[0], row)
    expected = sorted(best.values(), key=lambda r: [(v is None, str(v)) for v in r])
    assert rows_of(dedup.dedup(df, ["k"])) == expected


def test_duplicate_reports(table):
    df = table("y string, k string", ("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("2", None), ("2", None))
    assert rows_of(dedup.duplicate_keys(df, ["y", "k"])) == [("1", "a", 2), ("2", None, 2)]
    assert rows_of(dedup.worst_duplicates(df, ["y", "k"], 1)) == [("1", "a", 2)]
    assert rows_of(dedup.duplicate_breakdown(df, ["y", "k"], ["y"])) == [("1", 1)]
    assert rows_of(dedup.dedup_report(df, ["y", "k"])) == [(6, 4, 2, 33.33)]
    assert rows_of(dedup.dedup_report(df.limit(0), ["y", "k"])) == [(0, 0, 0, None)]
    assert dedup.dedup_rows(df).count() == 4


# -- conforming --------------------------------------------------------------------------


MEMBER = "school string, name string, district string, dname string"


def test_backfill(table):
    df = table(
        MEMBER,
        ("1", "A", "601", "One"),
        ("1", "A", None, None),  # unique match
        ("2", "B", None, None),  # no match
        ("3", "C", "602", "Two"),
        ("3", "C", "603", "Three"),
        ("3", "C", None, None),  # ambiguous
        (None, "A", None, None),  # unknown key
        ("1", "A", "601", None),  # name only
    )
    keys, fill = ["school", "name"], ["district", "dname"]
    got = rows_of(conform.backfill(df, keys, fill).distinct())
    assert ("1", "A", "601", "One") in got
    assert ("2", "B", None, None) in got
    assert (None, "A", None, None) in got
    assert [r for r in got if r[0] == "3"] == [("3", "C", "602", "Two"), ("3", "C", "603", "Three")]
    single = rows_of(conform.backfill(df, keys, fill, on_conflict="null"))
    assert ("3", "C", None, None) in single
    assert len(single) == 8
    # 601 is known with a name and without one, so that pair is ambiguous too.
    assert rows_of(conform.ambiguous_keys(df, keys, fill)) == [("1", "A", 2), ("3", "C", 2)]
    with pytest.raises(ValueError):
        conform.backfill(df, keys, fill, on_conflict="guess")


def test_backfill_matches_plain_left_join(spark):
    """Distinct rows equal a left join of every row with the lookup, as the rule states."""
    rng = random.Random(7)
    rows = [
        (
            rng.choice(["1", "2", None]),
            rng.choice(["A", "B"]),
            rng.choice(["601", "602", None]),
            rng.choice(["One", None]),
        )
        for _ in range(60)
    ]
    lookup = {r for r in rows if r[0] is not None and r[2] is not None}
    expected = set()
    for school, name, district, dname in rows:
        found = [r for r in lookup if (r[0], r[1]) == (school, name)] or [(None,) * 4]
        for match in found:
            expected.add((school, name, district or match[2], dname or match[3]))
    df = spark.createDataFrame(rows, MEMBER)
    got = conform.backfill(df, ["school", "name"], ["district", "dname"]).distinct()
    assert {tuple(r) for r in got.collect()} == expected


def test_union_follows_names_and_fills_missing(table):
    a = table("x int, y int", (1, 2))
    b = table("y int, x int, z int", (3, 4, 5))
    assert rows_of(shape.union_with_drift([a, b])) == [(1, 2, None), (4, 3, 5)]
    c = {"rate": F.col("x"), "score": F.col("y")}
    d = {"score": F.col("y"), "rate": F.col("x")}
    assert rows_of(conform.conform([(a, c), (b, d)]).select("rate", "score")) == [(1, 2), (4, 3)]


def test_consolidate_schemas(table):
    df = table("OLD_CD string, NEW_CD string, v int", ("1", None, 1), (None, "2", 2), ("3", "4", 3))
    merged = conform.consolidate_schemas(df, {"code": ("NEW_CD", "OLD_CD"), "name": ("ABSENT",)}, keep=["v"])
    assert rows_of(merged) == [("1", None, 1), ("2", None, 2), ("4", None, 3)]


# -- star ------------------------------------------------------------------------------------


def test_surrogate_key_is_dense_ordered_and_stable(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    first = rows_of(star.surrogate_key(df, "key", [F.asc("id")]).select("id", "key"))
    assert [tuple(r) for r in sorted(first)] == [(i, i + 1) for i in range(500)]
    again = star.surrogate_key(df.repartition(2), "key", [F.asc("id")], start=10)
    assert {r.key - r.id for r in again.collect()} == {10}
    assert star.surrogate_key(df.limit(0), "key", [F.asc("id")]).count() == 0


def test_attach_dimension(table):
    fact = table("code string, v int", ("a", 1), ("x", 2), (None, 3))
    dim = table("code string, key long, extra string", ("a", 10, "q"), ("b", 11, "q"))
    assert rows_of(star.attach_dimension(fact, dim, "code", "key")) == [("a", 1, 10), ("x", 2, None), (None, 3, None)]
    assert rows_of(star.unmatched_keys(fact, dim, "code")) == [("x",), (None,)]


def test_attach_dimension_null_as(table):
    fact = table("s string, g string", ("m", None), ("m", ""), ("m", "3"), (None, None))
    dim = table("subject string, grade string, key long", ("m", None, 1), ("m", "3", 2))
    got = star.attach_dimension(fact, dim, {"s": "subject", "g": "grade"}, "key", null_as={"g": ""})
    assert rows_of(got) == [("m", "", 1), ("m", "3", 2), ("m", None, 1), (None, None, None)]


def test_sort_merge_path_gives_the_same_result(spark, table):
    fact = table("code string, v int", *[("hot", i) for i in range(200)], ("a", 1), (None, 2), ("x", 3))
    dim = table("code string, key long", ("hot", 1), ("a", 2))
    joined = rows_of(star.attach_dimension(fact, dim, "code", "key"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = star.attach_dimension(fact, dim, "code", "key")
        assert "SortMergeJoin" in plan_of(merged)
        assert rows_of(merged) == joined
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_build_fact_and_distribution(table):
    src = table(
        "detail_level string, code string, y string, v int",
        *[("School", "a", "1", 5), ("School", "z", "1", 6), ("District", "a", "1", 7)],
    )
    schools = table("code string, school_key long, level string", ("a", 1, "L"))
    years = table("y string, year_key long", ("1", 9))
    fact = star.build_fact(src, [(schools, "code", "school_key"), (years, "y", "year_key")], ["v"], level="School")
    assert rows_of(fact) == [(1, 9, 5), (None, 9, 6)]
    assert rows_of(star.distribution_by_dim(fact, schools, "school_key", ["level"])) == [("L", 1)]


# -- history ----------------------------------------------------------------------------------


VERSION = "k string, y string, name string, p int"


def test_latest_and_current(table):
    df = table(VERSION, ("a", "2011-12", "new", 1), ("a", "2010-11", "old", 0), ("a", "2011-12", "first", 0))
    latest = history.latest_per_key(df, ["k"], "y", [F.asc("p")])
    assert rows_of(latest) == [("a", "2011-12", "first", 0)]
    current = history.scd_current(df, ["k"], "y", "2010-11", [F.asc("p")])
    assert rows_of(current.drop("p")) == [("a", "first", "2010-11", None, True)]


def test_spans(table):
    df = table(VERSION, ("a", "2010-11", "x", 0), ("a", "2012-13", "x", 0), ("a", "2013-14", "y", 0))
    assert rows_of(history.attribute_spans(df, ["k", "name"], "y")) == [
        ("a", "x", "2010-11", "2012-13"),
        ("a", "y", "2013-14", "2013-14"),
    ]


def test_scd2_history(table):
    df = table(
        VERSION,
        ("a", "2010-11", "x", 0),
        ("a", "2017-18", "x", 0),  # gap year: same run
        ("a", "2018-19", "y", 0),  # rename
        ("a", "2018-19", "z", 1),  # second source in the same year loses
        ("a", "2019-20", "x", 0),  # back to the old name: third run
        ("b", "2019-20", None, 0),
        ("b", "2020-21", None, 0),  # NULL attributes are equal
    )
    got = history.scd2_history(df, ["k"], ["name"], "y", priority=["p"])
    assert rows_of(got) == [
        ("a", "x", "2010-11", "2018-19", False),
        ("a", "x", "2019-20", None, True),
        ("a", "y", "2018-19", "2019-20", False),
        ("b", None, "2019-20", None, True),
    ]


# -- shape and summary --------------------------------------------------------------------------


def test_filters(table):
    df = table("a string, b string, c string", ("1", None, "x"), (None, None, "x"), (None, "2", None))
    assert rows_of(shape.require_any(df, ["a", "b"], ["c"])) == [("1", None, "x")]
    zero = table("school_year string, enrollment_count int", ("2021-22", 0), ("2022-23", 0), ("2021-22", None))
    assert rows_of(shape.drop_zero_padding(zero)) == [("2021-22", None), ("2022-23", 0)]


def test_level_filter_is_pushed_down(spark, tmp_path):
    spark.createDataFrame([("School", 1)], "detail_level string, v int").write.parquet(str(tmp_path / "t"))
    plan = plan_of(shape.level_filter(spark.read.parquet(str(tmp_path / "t")), "School").select("v"))
    assert "EqualTo(detail_level,School)" in plan


def test_metric_family(table):
    df = table("N_ALL string, N_MALE string", ("1", "2"))
    columns = shape.metric_family(["ALL", "MALE"], {"N": lambda c: c.cast("int")})
    assert df.select(*columns).columns == ["n_all", "n_male"]


def test_wide_to_long_has_no_shuffle(table):
    df = table("id int, count_a double, pct_a decimal(5,1), pct_b decimal(5,1)", (1, 2.0, None, None))
    families = [("program", "a", ("count_a", "pct_a")), ("race", "b", (None, "pct_b"))]
    long = shape.wide_to_long(df, ["id"], families)
    assert rows_of(long) == [(1, "program", "a", 2.0, None), (1, "race", "b", None, None)]
    assert "Exchange" not in plan_of(long)
    assert shape.wide_to_long(df, ["id"], families, drop_empty=True).count() == 1


def test_component_pivot(table):
    df = table("k int, c string, v double", (1, "A", 1.0), (1, "B", 2.0), (2, "A", 3.0), (2, "C", 9.0))
    assert rows_of(shape.component_pivot(df, ["k"], "c", ["A", "B"], "v")) == [(1, 1.0, 2.0), (2, 3.0, None)]


def test_top_n_breaks_ties_and_keeps_nulls_last(table):
    df = table("k string, v int", ("b", 5), ("a", 5), ("c", None), ("d", 1))
    assert [r.k for r in summary.top_n(df, "v", 2, ["k"]).collect()] == ["a", "b"]
    assert [r.k for r in summary.top_n(df, "v", 2, ["k"], ascending=True).collect()] == ["d", "a"]
    assert "TakeOrderedAndProject" in plan_of(summary.top_n(df, "v", 2, ["k"]))


def test_profiles(table):
    df = table("g string, v int, w string", ("a", 1, "x"), ("a", 3, None), ("b", None, "y"))
    profile = {r.measure: r for r in summary.numeric_profile(df, ["v"]).collect()}
    assert (profile["v"].n, profile["v"].min_value, profile["v"].max_value, profile["v"].total_value) == (2, 1, 3, 4)
    assert rows_of(summary.distinct_counts(df, ["g"], {"w": "w"})) == [("a", 2, 1), ("b", 1, 1)]
    assert rows_of(summary.distinct_counts(df, ["g"], {"w": "w"}, count_null=True)) == [("a", 2, 2), ("b", 1, 1)]
    assert [tuple(r) for r in summary.drilldown(df, "v > 0", ["g"]).collect()] == [("a", 2)]
    assert rows_of(summary.key_frequency(df, "g", 1)) == [("a", 2)]
    trend = summary.yearly_trend(df, ["v"], ("g",)).collect()
    assert [tuple(r) for r in trend] == [("a", 2, 2, 2.0), ("b", 1, 0, None)]
