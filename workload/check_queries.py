"""Data-quality checks and validation reports over the typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import cleanse as C
from rollcall.operators import dedup, quality
from workload.feed_queries import FACT_SQL, SILVER_SQL, fact, raw_tables, silver
from workload.operator_queries import FEED, feed
from workload.raw_tables import RAW
from workload.registry import query


def row(check: str, subject: str, n: str, observed: str = "", expected: str = "", ok: str = "") -> str:
    """One report row as a SELECT list; ``ok`` is a condition or empty for information."""
    status = f"case when coalesce({ok}, true) then 'pass' else 'fail' end" if ok else "'info'"
    return (
        f"select '{check}' as \"check\", '{subject}' as subject, {status} as status, "
        f"cast({observed or n} as double) as observed, '{expected}' as expected, cast({n} as bigint) as n"
    )


def report(source: str, *rows: str) -> str:
    return f"with s as ({source}) " + " union all ".join(f"{r} from s" for r in rows)


def hits(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def share(condition: str, of: str = "count(*)") -> str:
    return f"round({hits(condition)} * 100.0 / nullif({of}, 0), 2)"


def none(check: str, subject: str, condition: str, expected: str = "") -> str:
    return row(check, subject, hits(condition), expected=expected, ok=f"{hits(condition)} = 0")


# -- keys ------------------------------------------------------------------------------------


@query(
    "qc_reconcile",
    oracle=f"""with raw as ({RAW['dropout_rate']}), built as ({SILVER_SQL['dropout_rate']}),
sizes as (select (select count(*) from raw) as r, (select count(*) from built) as b,
  (select count(*) - count(distinct (LONG_SCHOOL_YEAR, SCHOOL_DSTRCT_CD, INSTN_NUMBER, LABEL_LVL_1_DESC)) from raw)
    as removed)
select 'reconcile' as "check", 'dropout_rate' as subject,
  case when r - removed = b then 'pass' else 'fail' end as status, cast(b as double) as observed,
  concat(cast(r as varchar), ' - ', cast(removed as varchar)) as expected, cast(abs(r - removed - b) as bigint) as n
from sizes""",
)
def qc_reconcile(t):
    raw = raw_tables(t, "dropout_rate")["dropout_rate"]
    keys = ["LONG_SCHOOL_YEAR", "SCHOOL_DSTRCT_CD", "INSTN_NUMBER", "LABEL_LVL_1_DESC"]
    return quality.reconcile(raw, dedup.dedup_report(raw, keys), silver(t, "dropout_rate"), "dropout_rate")


_SILVER_KEY = ["school_year", "district_code", "institution_number", "grade_range", "subgroup_label"]


def _unique(source: str, keys: list[str]) -> str:
    counted = f"select count(*) as c from ({source}) as f group by {', '.join(keys)}"
    return report(
        counted,
        row("key_unique", ",".join(keys), hits("c > 1"), "coalesce(sum(c) - count(*), 0)", "0", f"{hits('c > 1')} = 0"),
    )


@query("qc_key_unique", oracle=_unique(SILVER_SQL["dropout_rate"], _SILVER_KEY))
def qc_key_unique(t):
    return quality.key_unique(silver(t, "dropout_rate"), _SILVER_KEY)


@query("qc_raw_key_unique", oracle=_unique("select * from lineitem", ["l_orderkey", "l_linenumber"]))
def qc_raw_key_unique(t):
    return quality.key_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


_GRAIN = ["school_key", "year_key", "subgroup_key", "assessment_key"]


@query("qc_fact_grain", oracle=_unique(FACT_SQL["fact_school_performance"], _GRAIN))
def qc_fact_grain(t):
    return quality.key_unique(fact(t, "fact_school_performance"), _GRAIN)


@query(
    "qc_null_keys",
    oracle=report(
        RAW["sat"],
        none("null_key", "SCHOOL_DISTRCT_CD", "SCHOOL_DISTRCT_CD is null", "0"),
        none("null_key", "INSTN_NAME", "INSTN_NAME is null", "0"),
        none("null_key", "INSTN_NUMBER", "INSTN_NUMBER is null", "0"),
    ),
)
def qc_null_keys(t):
    keys = ["SCHOOL_DISTRCT_CD", "INSTN_NAME", "INSTN_NUMBER"]
    return quality.run_checks(t.sql(RAW["sat"]), quality.null_keys(keys))


@query(
    "qc_null_fk",
    oracle=report(
        FACT_SQL["fact_dropout"],
        *[
            row("null_fk", k, hits(f"{k} is null"), share(f"{k} is null"), "0", f"{hits(f'{k} is null')} = 0")
            for k in ("school_key", "year_key", "subgroup_key")
        ],
    ),
)
def qc_null_fk(t):
    keys = ["school_key", "year_key", "subgroup_key"]
    return quality.run_checks(fact(t, "fact_dropout"), quality.null_foreign_keys(keys))


@query(
    "qc_key_format",
    oracle=report(
        f"""select case when l_linenumber = 7 then district_code when l_linenumber = 6 then ''
    when l_linenumber = 5 then null else concat(district_code, '_', institution_number) end as k from ({FEED}) as f""",
        none("key_format", "institution_key", "k is null or k = '' or strpos(k, '_') = 0", "%_%"),
    ),
)
def qc_key_format(t):
    key = (
        F.when(F.col("l_linenumber") == 7, F.col("district_code"))
        .when(F.col("l_linenumber") == 6, "")
        .when(F.col("l_linenumber") != 5, C.composite_key("district_code", "institution_number"))
    )
    rows = feed(t).select(key.alias("institution_key"))
    return quality.run_checks(rows, quality.key_format("institution_key"))


# -- NULLs -------------------------------------------------------------------------------------


@query(
    "qc_suppression",
    oracle=report(
        SILVER_SQL["eog"],
        *[
            row("suppression", c, hits(f"{c} is null"), share(f"{c} is null"))
            for c in ("num_tested", "proficient_pct", "begin_pct")
        ],
    ),
)
def qc_suppression(t):
    return quality.run_checks(
        silver(t, "eog"), quality.suppression_rate(["num_tested", "proficient_pct", "begin_pct"])
    )




@query(
    "qc_null_summary",
    oracle=f"with s as ({SILVER_SQL['certified_personnel']}) select * from ("
    + " union all ".join(
        f"select '{c}' as column_name, {hits(f'{c} is null')} as null_count, {share(f'{c} is null')} as null_percent "
        "from s"
        for c in (
            "school_year district_code district_name institution_number institution_name grades_served "
            "data_category data_sub_category employee_type staff_count institution_key report_name"
        ).split()
    )
    + ") as x where null_count > 0",
)
def qc_null_summary(t):
    return quality.null_summary(silver(t, "certified_personnel"))


@query(
    "qc_missing_attr",
    oracle=report(
        SILVER_SQL["enrollment_by_grade"],
        *[
            row("missing_attr", c, hits(f"{c} is null or {c} = ''"))
            for c in ("institution_name", "grades_served")
        ],
    ),
)
def qc_missing_attr(t):
    checks = quality.missing_attributes(["institution_name", "grades_served"])
    return quality.run_checks(silver(t, "enrollment_by_grade"), checks)


@query(
    "qc_unparsed_values",
    oracle=report(
        FEED,
        none(
            "unparsed",
            "count_raw",
            "count_raw is not null and count_raw <> 'TFS' and not regexp_full_match(count_raw, '[0-9]+')",
            "0",
        ),
        none(
            "unparsed",
            "coded_raw",
            "coded_raw is not null and coded_raw <> 'TFS' and not regexp_full_match(coded_raw, '[0-9.]+')",
            "0",
        ),
    ),
)
def qc_unparsed_values(t):
    """Counts with a zero fraction read without stripping, and codes not declared."""
    cleaned = {
        "count_raw": (C.clean_int("count_raw"), C.TFS),
        "coded_raw": (C.clean_double("coded_raw"), C.TFS),
    }
    return quality.run_checks(feed(t), quality.unparsed_values(cleaned))


# -- values ---------------------------------------------------------------------------------------


def _range(c: str, low: str, high: str) -> list[str]:
    """Rows for the smallest and the largest value."""
    text = f"{low}..{high}"
    below, above = hits(f"{c} < {low}"), hits(f"{c} > {high}")
    return [
        row("range_min", c, below, f"min({c})", text, f"{below} = 0"),
        row("range_max", c, above, f"max({c})", text, f"{above} = 0"),
    ]


@query(
    "qc_range",
    oracle=report(
        SILVER_SQL["attendance"], *_range("chronic_absent_perc_all", "0", "100"), *_range("over_15_percent_all", "0", "50")
    ),
)
def qc_range(t):
    bounds = {"chronic_absent_perc_all": (0, 100), "over_15_percent_all": (0, 50)}
    return quality.run_checks(silver(t, "attendance"), quality.in_range(bounds))


@query(
    "qc_composite_range",
    oracle=report(
        f"select * from ({SILVER_SQL['act']}) as a where test_component = 'Composite'",
        *_range("institution_avg_score", "1", "36"),
    ),
)
def qc_composite_range(t):
    composite = silver(t, "act").filter("test_component = 'Composite'")
    return quality.run_checks(composite, quality.in_range({"institution_avg_score": (1, 36)}))


@query(
    "qc_nonneg",
    oracle=report(
        SILVER_SQL["graduation_rate"],
        *[
            row("non_negative", c, hits(f"{c} < 0"), f"min({c})", ">= 0", f"min({c}) >= 0")
            for c in ("graduate_count", "cohort_count")
        ],
    ),
)
def qc_nonneg(t):
    return quality.run_checks(
        silver(t, "graduation_rate"), quality.non_negative(["graduate_count", "cohort_count"])
    )


@query(
    "qc_zero_neg",
    oracle=report(
        SILVER_SQL["certified_personnel"],
        row("zero", "staff_count", hits("staff_count = 0"), share("staff_count = 0", "count(staff_count)")),
        row("negative", "staff_count", hits("staff_count < 0"), share("staff_count < 0", "count(staff_count)")),
    ),
)
def qc_zero_neg(t):
    return quality.run_checks(silver(t, "certified_personnel"), quality.sign_profile(["staff_count"]))


_COUNTS = ["begin_count", "developing_count", "proficient_count", "distinguished_count"]
_SHARES = ["begin_pct", "developing_pct", "proficient_pct", "distinguished_pct"]


@query(
    "qc_parts_sum",
    oracle=report(
        SILVER_SQL["eog"],
        none("parts_sum", "levels", f"{' + '.join(_COUNTS)} <> num_tested", "num_tested +- 0.0"),
    ),
)
def qc_parts_sum(t):
    return quality.run_checks(silver(t, "eog"), quality.parts_sum(_COUNTS, "num_tested", subject="levels"))


@query(
    "qc_pct_sum",
    oracle=report(
        SILVER_SQL["eoc"],
        none(
            "parts_sum", "shares", f"abs(round({' + '.join(_SHARES)} - 100, 2)) > 0.5", "100.0 +- 0.5"
        ),
    ),
)
def qc_pct_sum(t):
    return quality.run_checks(silver(t, "eoc"), quality.parts_sum(_SHARES, 100.0, 0.5, subject="shares"))


_BUCKETS = ["five_or_fewer_percent_all", "six_to_fifteen_percent_all", "over_15_percent_all"]


@query(
    "qc_bucket_sum",
    oracle=report(
        SILVER_SQL["attendance"],
        none("parts_sum", "buckets", f"abs(round({' + '.join(_BUCKETS)} - 100, 1)) > 1.0", "100.0 +- 1.0"),
    ),
)
def qc_bucket_sum(t):
    return quality.run_checks(silver(t, "attendance"), quality.parts_sum(_BUCKETS, 100.0, 1.0, subject="buckets"))


@query(
    "qc_parts_sum_violations",
    oracle=f"""select school_year, institution_key, num_tested, {', '.join(_COUNTS)} from ({SILVER_SQL['eog']}) as s
where {' + '.join(_COUNTS)} <> num_tested""",
)
def qc_parts_sum_violations(t):
    return quality.violations(
        silver(t, "eog"),
        quality.parts_sum(_COUNTS, "num_tested"),
        ["school_year", "institution_key", "num_tested", *_COUNTS],
    )


_COMPOSITE = f"""select school_year, subgroup, institution_number,
    max(case when test_component = 'Composite' then institution_avg_score end) as Composite,
    max(case when test_component = 'English' then institution_avg_score end) as English,
    max(case when test_component = 'Mathematics' then institution_avg_score end) as Mathematics,
    max(case when test_component = 'Reading' then institution_avg_score end) as Reading,
    max(case when test_component = 'Science' then institution_avg_score end) as Science
  from ({SILVER_SQL['act']}) as a group by school_year, subgroup, institution_number"""
_PARTS = ["English", "Mathematics", "Reading", "Science"]
_MEAN = "(English + Mathematics + Reading + Science) / 4"


@query(
    "qc_composite",
    oracle=f"""select *, {_MEAN} as calculated_composite, abs(Composite - {_MEAN}) as diff from ({_COMPOSITE}) as c
where abs(Composite - {_MEAN}) > 0.5""",
)
def qc_composite(t):
    by = ["school_year", "subgroup", "institution_number"]
    return quality.composite_inconsistent(
        silver(t, "act"), by, "test_component", "Composite", _PARTS, "institution_avg_score"
    )


@query(
    "qc_subset",
    oracle=report(
        SILVER_SQL["direct_certification"],
        none(
            "subset_le_total",
            "poverty_student_count<=total_student_count",
            "poverty_student_count > total_student_count",
            "0",
        ),
    ),
)
def qc_subset(t):
    check = quality.subset_le_total("poverty_student_count", "total_student_count")
    return quality.run_checks(silver(t, "direct_certification"), check)


# -- bundles ---------------------------------------------------------------------------------------


@query(
    "qc_eog_bundle",
    oracle=report(
        SILVER_SQL["eog"],
        *[row("suppression", c, hits(f"{c} is null"), share(f"{c} is null")) for c in ("num_tested", "proficient_pct")],
        *[
            r
            for c in _SHARES
            for r in _range(c, "0", "100")
        ],
        none("parts_sum", "counts", f"{' + '.join(_COUNTS)} <> num_tested", "num_tested +- 0.0"),
        none("parts_sum", "shares", f"abs(round({' + '.join(_SHARES)} - 100, 2)) > 0.5", "100.0 +- 0.5"),
    ),
)
def qc_eog_bundle(t):
    """All row checks of one table in a single pass."""
    return quality.run_checks(
        silver(t, "eog"),
        quality.suppression_rate(["num_tested", "proficient_pct"]),
        quality.in_range({c: (0, 100) for c in _SHARES}),
        quality.parts_sum(_COUNTS, "num_tested", subject="counts"),
        quality.parts_sum(_SHARES, 100.0, 0.5, subject="shares"),
    )
