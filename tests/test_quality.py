from rollcall.functions import cleanse as C
from rollcall.operators import quality as Q
from rollcall.operators.dedup import dedup_report


def report(df):
    return {(r.check, r.subject): (r.status, r.observed, r.n) for r in df.collect()}


def test_checks_share_one_pass(table):
    df = table("k string, v int, w int", ("a_1", 5, 1), ("ab", -1, 1), (None, None, 2), ("", 200, None))
    got = report(
        Q.run_checks(
            df,
            Q.null_keys(["k"]),
            Q.key_format("k"),
            Q.in_range({"v": (0, 100)}),
            Q.non_negative(["v", "w"]),
            Q.sign_profile(["v"]),
            Q.suppression_rate(["v"]),
            Q.missing_attributes(["k"]),
            Q.subset_le_total("v", "w"),
        )
    )
    assert got["null_key", "k"] == ("fail", 1.0, 1)
    assert got["key_format", "k"] == ("fail", 3.0, 3)
    assert got["range_min", "v"] == ("fail", -1.0, 1)
    assert got["range_max", "v"] == ("fail", 200.0, 1)
    assert got["non_negative", "v"] == ("fail", -1.0, 1)
    assert got["non_negative", "w"] == ("pass", 1.0, 0)
    assert got["negative", "v"] == ("info", 33.33, 1)
    assert got["zero", "v"] == ("info", 0.0, 0)
    assert got["suppression", "v"] == ("info", 25.0, 1)
    assert got["missing_attr", "k"] == ("info", 2.0, 2)
    assert got["subset_le_total", "v<=w"] == ("fail", 1.0, 1)


def test_empty_table_passes(table):
    df = table("k string, v int", ("a_1", 1)).limit(0)
    got = report(Q.run_checks(df, Q.null_keys(["k"]), Q.in_range({"v": (0, 1)}), Q.suppression_rate(["v"])))
    assert got["null_key", "k"][0] == "pass"
    assert got["range_min", "v"] == ("pass", None, 0)
    assert got["suppression", "v"] == ("info", None, 0)
    assert report(Q.key_unique(df, ["k"]))["key_unique", "k"] == ("pass", 0.0, 0)


def test_parts_with_null_are_not_flagged(table):
    df = table("a int, b int, t int", (1, 2, 3), (1, 2, 4), (1, None, 9), (1, 2, None))
    check = Q.parts_sum(["a", "b"], "t")
    assert report(Q.run_checks(df, check))["parts_sum", "a+b"] == ("fail", 1.0, 1)
    assert [tuple(r) for r in Q.violations(df, check).collect()] == [(1, 2, 4)]
    near = table("a decimal(5,2), b decimal(5,2)", *[])
    assert report(Q.run_checks(near, Q.parts_sum(["a", "b"], 100.0, 0.5)))["parts_sum", "a+b"][0] == "pass"


def test_key_unique_counts_keys_and_surplus(table):
    df = table("k string", ("a",), ("a",), ("a",), ("b",), (None,), (None,))
    assert report(Q.key_unique(df, ["k"]))["key_unique", "k"] == ("fail", 3.0, 2)


def test_foreign_keys(table):
    df = table("school_key long, year_key long", (1, 1), (None, 1))
    got = report(Q.run_checks(df, Q.null_foreign_keys(["school_key", "year_key"])))
    assert got["null_fk", "school_key"] == ("fail", 50.0, 1)
    assert got["null_fk", "year_key"] == ("pass", 0.0, 0)


def test_composite(table):
    df = table(
        "k string, c string, v double",
        *[("x", c, v) for c, v in (("Composite", 20.0), ("E", 20.0), ("M", 21.0))],
        *[("y", c, v) for c, v in (("Composite", 30.0), ("E", 20.0), ("M", 21.0))],
        ("z", "Composite", 1.0),
    )
    args = (["k"], "c", "Composite", ["E", "M"], "v")
    bad = Q.composite_inconsistent(df, *args).collect()
    assert [(r.k, r.diff) for r in bad] == [("y", 9.5)]
    assert report(Q.composite_consistent(df, *args))["composite", "Composite"] == ("fail", 1.0, 1)


def test_reconcile_and_null_summary(table):
    df = table("k string, v string", ("a", None), ("a", None), ("b", "x"))
    removed = dedup_report(df, ["k"])
    good = Q.reconcile(df, removed, df.dropDuplicates(["k"]), "t").first()
    assert (good.status, good.observed, good.expected, good.n) == ("pass", 2.0, "3 - 1", 0)
    assert Q.reconcile(df, removed, df, "t").first().status == "fail"
    assert [tuple(r) for r in Q.null_summary(df).collect()] == [("v", 2, 66.67)]


def test_unparsed(table):
    df = table("v string", ("TFS",), ("1.5",), ("2",))
    checks = Q.unparsed_values({"v": (C.clean_int("v"), C.TFS)})
    assert report(Q.run_checks(df, checks))["unparsed", "v"] == ("fail", 1.0, 1)
    assert [r.v for r in Q.violations(df, checks[0]).collect()] == ["1.5"]


def test_report_layout(table):
    df = table("v int", (1,))
    both = Q.combine(Q.run_checks(df, Q.sign_profile(["v"])), Q.key_unique(df, ["v"]))
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema)
    assert layout == Q.REPORT_SCHEMA
