"""Report queries over the typed tables, and table round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollcall.plans import facts, reports
from rollcall.plans.checks import validate_fact, validate_school_dimension
from rollcall.session import pin, shared_dir
from rollcall.sources import tables
from workload.check_queries import hits, none, report, row, share
from workload.feed_queries import DIM_SQL, FACT_SQL, SILVER_SQL, dimension, fact, silver
from workload.registry import query


def over(name: str, columns: str, rest: str) -> str:
    return f"select {columns} from ({SILVER_SQL[name]}) as s {rest}"


@query(
    "chronic_absence_trend",
    oracle=over(
        "attendance",
        "school_year, chronic_absent_perc_all",
        "where detail_level = 'State' and chronic_absent_perc_all is not null",
    ),
)
def chronic_absence_trend(t):
    return reports.chronic_absence_trend(silver(t, "attendance"))


@query(
    "worst_chronic_absence",
    oracle=over(
        "attendance",
        "institution_name, district_name, student_count_all, chronic_absent_perc_all",
        "where school_year = '1998-99' and detail_level = 'School' and chronic_absent_perc_all is not null "
        "order by chronic_absent_perc_all desc, institution_key limit 10",
    ),
)
def worst_chronic_absence(t):
    return reports.worst_chronic_absence(silver(t, "attendance"), "1998-99")


@query(
    "dropout_trend",
    oracle=over(
        "dropout_rate",
        "school_year, dropout_count, dropout_rate",
        "where detail_level = 'State' and subgroup_label = 'ALL Students' and grade_range = '9-12'",
    ),
)
def dropout_trend(t):
    return reports.dropout_trend(silver(t, "dropout_rate"))


@query(
    "graduation_trend",
    oracle=over(
        "graduation_rate",
        "school_year, graduate_count, graduation_rate, cohort_count",
        "where detail_level = 'State' and subgroup_label = 'ALL Students' and cohort_type = '4-Year'",
    ),
)
def graduation_trend(t):
    return reports.graduation_trend(silver(t, "graduation_rate"))


@query(
    "cohort_comparison",
    oracle=over(
        "graduation_rate",
        "cohort_type, graduate_count, graduation_rate, cohort_count",
        "where detail_level = 'State' and subgroup_label = 'ALL Students' and school_year = '1998-99'",
    ),
)
def cohort_comparison(t):
    measures = ["graduate_count", "graduation_rate", "cohort_count"]
    return reports.compare_groups(silver(t, "graduation_rate"), "cohort_type", "1998-99", measures)


@query(
    "direct_certification_trend",
    oracle=over(
        "direct_certification",
        "school_year, fiscal_year, count(*) as record_count, "
        "count(direct_cert_percent) as direct_cert_percent_known, "
        "round(avg(direct_cert_percent), 6) as direct_cert_percent_mean",
        "where detail_level = 'District' and direct_cert_percent is not null group by school_year, fiscal_year",
    ),
)
def direct_certification_trend(t):
    trend = reports.direct_certification_trend(silver(t, "direct_certification"))
    return trend.withColumn("direct_cert_percent_mean", F.round("direct_cert_percent_mean", 6))


@query(
    "enrollment_totals",
    oracle=over(
        "enrollment_by_grade",
        "school_year, count(*) as record_count, cast(sum(enrollment_count) as bigint) as total_enrollment",
        "where detail_level = 'School' and enrollment_period = 'Fall' and enrollment_count is not null "
        "group by school_year",
    ),
)
def enrollment_totals(t):
    return reports.enrollment_totals(silver(t, "enrollment_by_grade"))


@query(
    "category_totals",
    oracle=over(
        "revenues",
        "revenue_expenditure_type, category, count(*) as record_count, round(sum(amount), 2) as total_amount, "
        "round(avg(amount), 6) as avg_amount",
        "group by revenue_expenditure_type, category",
    ),
)
def category_totals(t):
    totals = reports.category_totals(silver(t, "revenues"))
    return totals.withColumns({"total_amount": F.round("total_amount", 2), "avg_amount": F.round("avg_amount", 6)})


@query(
    "type_totals",
    oracle=over(
        "revenues",
        "revenue_expenditure_type, count(*) as record_count, count(distinct category) as unique_categories, "
        "round(sum(amount), 2) as total_amount",
        "group by revenue_expenditure_type",
    ),
)
def type_totals(t):
    return reports.type_totals(silver(t, "revenues")).withColumn("total_amount", F.round("total_amount", 2))


@query(
    "revenue_coverage",
    oracle=over(
        "revenues",
        "school_year, count(*) as record_count, count(distinct district_code) as districts, "
        "count(distinct case when detail_level = 'School' then institution_key end) as schools, "
        "count(distinct source_file) as source_files",
        "group by school_year",
    ),
)
def revenue_coverage(t):
    return reports.revenue_coverage(silver(t, "revenues"))


@query(
    "staffing_zeros",
    oracle=over(
        "certified_personnel",
        "data_category, data_sub_category, count(*) as record_count",
        "where staff_count = 0 group by data_category, data_sub_category",
    ),
)
def staffing_zeros(t):
    return reports.staffing_zeros(silver(t, "certified_personnel"), ["data_category", "data_sub_category"])


@query(
    "negative_amounts",
    oracle=over(
        "revenues",
        "revenue_expenditure_type, category, count(*) as record_count, round(sum(amount), 2) as total_negative_amount",
        "where amount < 0 group by revenue_expenditure_type, category",
    ),
)
def negative_amounts(t):
    rows = reports.negative_amounts(silver(t, "revenues"))
    return rows.withColumn("total_negative_amount", F.round("total_negative_amount", 2))


@query(
    "fact_enrollment_without_padding",
    oracle=f"""select ds.school_key, dy.year_key, enrollment_period, grade_level, enrollment_count
from ({SILVER_SQL['enrollment_by_grade']}) as f
left join ({DIM_SQL['school']}) as ds on f.institution_key = ds.institution_key
left join ({DIM_SQL['year']}) as dy on f.school_year = dy.school_year
where f.detail_level = 'School' and not (f.school_year <= '2021-22' and coalesce(enrollment_count, 1) = 0)""",
)
def fact_enrollment_without_padding(t):
    typed = pin(silver(t, "enrollment_by_grade"), "silver_enrollment_by_grade")
    dims = {
        "school": dimension(t, "school", lambda t, s: typed if s == "enrollment_by_grade" else silver(t, s)),
        "year": dimension(t, "year", lambda t, s: typed),
    }
    return facts.fact_enrollment_by_grade(typed, dims, zero_padding=False)


_GRAIN = ["school_key", "year_key", "revenue_expenditure_type", "category"]


@query(
    "validate_fact_revenues",
    oracle=report(
        FACT_SQL["fact_revenues"],
        *[
            row("null_fk", k, hits(f"{k} is null"), share(f"{k} is null"), "0", f"{hits(f'{k} is null')} = 0")
            for k in ("school_key", "year_key")
        ],
        row("zero", "amount", hits("amount = 0"), share("amount = 0", "count(amount)")),
        row("negative", "amount", hits("amount < 0"), share("amount < 0", "count(amount)")),
    )
    + f""" union all select * from ({report(
        f"select count(*) as c from ({FACT_SQL['fact_revenues']}) as f group by {', '.join(_GRAIN)}",
        row("key_unique", "fact_revenues", hits("c > 1"), "coalesce(sum(c) - count(*), 0)", "0",
            f"{hits('c > 1')} = 0"),
    )}) as grain""",
)
def validate_fact_revenues(t):
    return validate_fact("fact_revenues", pin(fact(t, "fact_revenues"), "fact_revenues"))


@query(
    "validate_school_dimension",
    oracle=report(
        DIM_SQL["school"],
        none("null_key", "institution_key", "institution_key is null", "0"),
        *[
            row("missing_attr", c, hits(f"{c} is null or {c} = ''"))
            for c in ("institution_name", "grades_served")
        ],
        row(
            "key_unique",
            "dim_school",
            "count(*) - count(distinct institution_key)",
            expected="0",
            ok="count(*) = count(distinct institution_key)",
        ),
    ),
)
def validate_school_dimension_query(t):
    return validate_school_dimension(dimension(t, "school"))


@query(
    "write_modes",
    oracle=f"""with s as ({SILVER_SQL['dropout_rate']})
select 'replaced' as step, count(*) as written, count(*) as rows, 14 as columns from s
union all select 'same schema', count(*), count(*), 14 from s
union all select 'other schema refused', 0, count(*), 14 from s""",
)
def write_modes(t):
    """Overwrite, overwrite with a fixed schema, and a refused schema change."""
    layer = f"typed_{uuid.uuid4().hex[:12]}"
    tables.ensure_schema(t.spark, layer, f"{shared_dir(t.spark).rstrip('/')}/rollcall/{layer}")
    typed = pin(silver(t, "dropout_rate"), "silver_dropout_rate")
    tables.write_table(typed.drop("source_file"), layer, "dropout_rate")
    steps = []

    def record(step: str, written: int) -> None:
        seen = tables.read_back(t.spark, layer, "dropout_rate").drop("table_name")
        columns = [F.lit(step).alias("step"), F.lit(written).cast("long").alias("written"), *seen.columns]
        steps.append(pin(seen.select(*columns), "write_modes"))

    record("replaced", tables.write_table(typed, layer, "dropout_rate"))
    record("same schema", tables.write_table(typed, layer, "dropout_rate", on_schema_change="fail"))
    try:
        tables.write_table(typed.drop("source_year"), layer, "dropout_rate", on_schema_change="fail")
    except tables.SchemaChanged:
        record("other schema refused", 0)
    tables.reset_layer(t.spark, layer)
    t.spark.sql(f"DROP SCHEMA IF EXISTS {layer}")
    return steps[0].unionByName(steps[1]).unionByName(steps[2])
