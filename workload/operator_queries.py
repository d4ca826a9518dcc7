"""One query per operator, on report-shaped projections of the supplied tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import cleanse as C
from rollcall.functions import labels as L
from rollcall.functions.report_types import REPORT_TYPE_RULES
from rollcall.operators import conform, dedup, history, shape, star, summary
from rollcall.plans.dims import dim_profile
from rollcall.plans.feeds import ATTENDANCE_RATES, ATTENDANCE_SUBGROUPS
from rollcall.plans.reshape import attendance_long, enrollment_long
from rollcall.session import pin, shared_dir
from rollcall.sources import files, tables
from workload.feed_queries import DIM_SQL, SILVER_SQL, dimension, silver
from workload.raw_tables import RAW
from workload.registry import Tables, query

# One row per line item, shaped like a raw report.
FEED = """select
  concat(cast(year(l_shipdate) as string), '-', lpad(cast((year(l_shipdate) + 1) % 100 as string), 2, '0'))
    as school_year,
  cast(l_suppkey as string) as district_code,
  case when l_partkey % 50 = 0 then 'ALL' else cast(l_partkey as string) end as institution_number,
  case when l_partkey % 50 = 0 and l_suppkey % 10 = 0 then 'State' when l_partkey % 50 = 0 then 'District'
    else 'School' end as detail_level,
  concat(case when l_linestatus = 'F' then '7-12' else '9-12' end, ' Drop Outs -', l_returnflag) as dropout_label,
  concat(case when l_linestatus = 'F' then '5 Yr ' else '' end, 'Grad Rate -', l_returnflag) as graduation_label,
  case when l_quantity < 5 then 'TFS' when l_linenumber = 7 then null
    else concat(cast(cast(l_quantity as bigint) as string), case when l_orderkey % 2 = 0 then '.0' else '' end) end
    as count_raw,
  case when l_quantity < 5 then 'TFS' when l_linenumber = 6 then 'N/A' when l_linenumber = 5 then '*'
    else cast(cast(l_quantity as bigint) as string) end as coded_raw,
  case when l_quantity < 5 then 'TFS' else concat(cast(cast(l_discount * 100 as bigint) as string), '.',
    lpad(cast(l_partkey % 100 as string), 2, '0')) end as pct_raw,
  concat(cast(2000 + l_suppkey % 30 as string), case when l_orderkey % 2 = 0 then '.0' else '' end) as fiscal_raw,
  concat(cast(l_suppkey as string), case when l_orderkey % 3 = 0 then '.0' else '' end) as code_raw,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  concat('f', cast(l_suppkey % 3 as string)) as source_file
from lineitem"""
_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_IDS_SQL = ", ".join(_IDS)


def feed(t: Tables) -> DataFrame:
    return t.sql(FEED)


def from_feed(columns: str, rest: str = "") -> str:
    return f"with feed as ({FEED}) select {columns} from feed {rest}"


def column_query(name: str, sql: str, build) -> None:
    """A query that computes one column per feed row."""

    @query(name, oracle=from_feed(f"{_IDS_SQL}, {sql} as result"))
    def run(t: Tables) -> DataFrame:
        return feed(t).select(*_IDS, build().alias("result"))


# -- projections and filters ------------------------------------------------------------


@query(
    "rename_project",
    oracle=from_feed("school_year as year_label, district_code as district, l_orderkey as row_id"),
)
def rename_project(t):
    names = {"school_year": "year_label", "district_code": "district", "l_orderkey": "row_id"}
    return shape.rename_project(feed(t), names)


@query("level_filter", oracle=from_feed(f"{_IDS_SQL}, school_year", "where detail_level = 'School'"))
def level_filter(t):
    return shape.level_filter(feed(t), "School").select(*_IDS, "school_year")


@query(
    "null_schema_filter",
    oracle=f"""select SCHOOL_YEAR, LONG_SCHOOL_YEAR, DISTRICT_CODE, SCHOOL_DSTRCT_CD, source_file
from ({RAW['revenues']}) as r where coalesce(SCHOOL_YEAR, LONG_SCHOOL_YEAR) is not null
  and coalesce(DISTRICT_CODE, SCHOOL_DSTRCT_CD) is not null""",
)
def null_schema_filter(t):
    rows = shape.require_any(
        t.sql(RAW["revenues"]), ("SCHOOL_YEAR", "LONG_SCHOOL_YEAR"), ("DISTRICT_CODE", "SCHOOL_DSTRCT_CD")
    )
    return rows.select("SCHOOL_YEAR", "LONG_SCHOOL_YEAR", "DISTRICT_CODE", "SCHOOL_DSTRCT_CD", "source_file")


@query(
    "year_range_filter",
    oracle=from_feed(f"{_IDS_SQL}, school_year", "where school_year between '1996-97' and '1999-00'"),
)
def year_range_filter(t):
    return shape.year_range(feed(t), "1996-97", "1999-00").select(*_IDS, "school_year")


@query(
    "year_required_filter",
    oracle=f"""select FISCAL_YEAR, SYSTEM_ID, source_file from ({RAW['direct_certification_district']}) as r
where FISCAL_YEAR is not null""",
)
def year_required_filter(t):
    rows = shape.require_any(t.sql(RAW["direct_certification_district"]), ["FISCAL_YEAR"])
    return rows.select("FISCAL_YEAR", "SYSTEM_ID", "source_file")


@query(
    "predicate_filter",
    oracle=from_feed(
        f"{_IDS_SQL}, detail_level, count_raw",
        "where detail_level in ('State', 'District') and (count_raw is not null or l_quantity > 40) "
        "and abs(l_quantity - 25) > 10 and count_raw <> 'TFS'",
    ),
)
def predicate_filter(t):
    rows = feed(t).filter(
        "detail_level IN ('State', 'District') AND (count_raw IS NOT NULL OR l_quantity > 40) "
        "AND ABS(l_quantity - 25) > 10 AND count_raw != 'TFS'"
    )
    return rows.select(*_IDS, "detail_level", "count_raw")


@query(
    "drop_zero_padding",
    oracle=from_feed(
        f"{_IDS_SQL}, school_year, l_partkey % 4 as enrollment_count",
        "where not (school_year <= '1998-99' and l_partkey % 4 = 0)",
    ),
)
def drop_zero_padding(t):
    rows = feed(t).select(*_IDS, "school_year", (F.col("l_partkey") % 4).alias("enrollment_count"))
    return shape.drop_zero_padding(rows, last_year="1998-99")


@query(
    "typed_constants",
    oracle=from_feed(
        f"{_IDS_SQL}, cast(null as varchar) as grade, cast(null as double) as participation_rate, "
        "'EOG' as assessment_name, true as is_current"
    ),
)
def typed_constants(t):
    return feed(t).select(
        *_IDS,
        C.typed_null("string").alias("grade"),
        C.typed_null("double").alias("participation_rate"),
        F.lit("EOG").alias("assessment_name"),
        F.lit(True).alias("is_current"),
    )


# -- cleansing -------------------------------------------------------------------------------

column_query("suppress", "nullif(count_raw, 'TFS')", lambda: C.suppress("count_raw"))
column_query(
    "suppress_multi_code",
    "case when coded_raw in ('TFS', 'N/A', '*') then null else coded_raw end",
    lambda: C.suppress("coded_raw", C.TFS_NA_STAR),
)
column_query(
    "clean_int",
    "try_cast(case when coded_raw in ('TFS', 'N/A', '*') then null else coded_raw end as integer)",
    lambda: C.clean_int("coded_raw", C.TFS_NA_STAR),
)
column_query(
    "clean_int_strip",
    r"try_cast(regexp_replace(nullif(count_raw, 'TFS'), '\.0*$', '') as integer)",
    lambda: C.clean_int("count_raw", strip_zeros=True),
)
column_query(
    "clean_double",
    "try_cast(case when coded_raw in ('TFS', 'N/A') then null else coded_raw end as double)",
    lambda: C.clean_double("coded_raw", C.TFS_NA),
)
column_query(
    "clean_decimal_5_1",
    "cast(try_cast(nullif(pct_raw, 'TFS') as decimal(5,1)) as double)",
    lambda: C.clean_decimal("pct_raw", 5, 1),
)
column_query(
    "clean_decimal_5_2",
    "cast(try_cast(nullif(pct_raw, 'TFS') as decimal(5,2)) as double)",
    lambda: C.clean_decimal("pct_raw", 5, 2),
)
column_query(
    "strip_code_suffix",
    r"regexp_replace(code_raw, '\.0$', '')",
    lambda: C.strip_decimal_suffix("code_raw"),
)
column_query(
    "merge_columns",
    "case when l_linenumber % 2 = 0 then code_raw when l_linenumber < 5 then district_code end",
    lambda: C.merge_columns(
        F.when(F.col("l_linenumber") % 2 == 0, F.col("code_raw")),
        F.when(F.col("l_linenumber") < 5, F.col("district_code")),
    ),
)
column_query(
    "composite_key",
    "concat_ws('_', case when l_linenumber <> 7 then district_code end, institution_number)",
    lambda: C.composite_key(F.when(F.col("l_linenumber") != 7, F.col("district_code")), "institution_number"),
)
column_query(
    "composite_key_fallback",
    "case when l_linenumber = 7 then concat('School ', institution_number) "
    "else concat(district_code, '_', institution_number) end",
    lambda: C.composite_key(
        F.when(F.col("l_linenumber") != 7, F.col("district_code")),
        "institution_number",
        fallback=F.concat(F.lit("School "), F.col("institution_number")),
    ),
)
column_query(
    "detail_level",
    "case when institution_number = 'ALL' and l_suppkey % 10 = 0 then 'State' "
    "when institution_number = 'ALL' then 'District' else 'School' end",
    lambda: L.derive_detail_level(
        F.when(F.col("l_suppkey") % 10 == 0, "ALL").otherwise(F.col("district_code")), F.col("institution_number")
    ),
)
column_query(
    "split_label_grade",
    "concat(case when starts_with(dropout_label, '7-12') then '7-12' else '9-12' end, '|', "
    "regexp_extract(dropout_label, 'Drop Outs -(.*)', 1))",
    lambda: F.concat_ws("|", *L.split_dropout_label(F.col("dropout_label"))),
)
column_query(
    "split_label_cohort",
    "concat(case when starts_with(graduation_label, '5 Yr') then '5-Year' else '4-Year' end, '|', "
    "regexp_extract(graduation_label, 'Grad Rate -(.*)', 1))",
    lambda: F.concat_ws("|", *L.split_graduation_label(F.col("graduation_label"))),
)
_FY = r"try_cast(regexp_replace(fiscal_raw, '\.0*$', '') as integer)"
column_query(
    "fiscal_to_school_year",
    f"concat(cast({_FY} - 1 as varchar), '-', right(cast({_FY} as varchar), 2))",
    lambda: L.fiscal_to_school_year(F.col("fiscal_raw")),
)
column_query(
    "fiscal_to_short_year",
    f"concat(right(cast({_FY} - 1 as varchar), 2), '-', right(cast({_FY} as varchar), 2))",
    lambda: L.fiscal_to_school_year(F.col("fiscal_raw"), short=True),
)


@query(
    "year_parts",
    oracle="""select o_orderkey, cast(year(o_orderdate) as integer) as start_year,
  cast(year(o_orderdate) + 1 as integer) as end_year from orders""",
)
def year_parts(t):
    label = F.concat(
        F.year("o_orderdate").cast("string"),
        F.lit("-"),
        F.lpad(((F.year("o_orderdate") + 1) % 100).cast("string"), 2, "0"),
    )
    return t.orders.select("o_orderkey", L.year_start(label).alias("start_year"), L.year_end(label).alias("end_year"))


@query(
    "classify_format",
    oracle="""select p_partkey, case when p_type in ('PROMO', 'SMALL', 'ECONOMY') then 'new' else 'old' end
  as sat_format from part""",
)
def classify_format(t):
    components = ("PROMO", "SMALL", "ECONOMY")
    return t.part.select(
        "p_partkey", L.classify_sat_format(F.col("p_type"), components).alias("sat_format")
    )


@query(
    "subgroup_category",
    oracle="""select distinct subgroup_name, case when subgroup_name in ('Black', 'Two or More Races')
    then 'Race/Ethnicity' when subgroup_name = 'Female' then 'Gender' when subgroup_name = 'All Students' then 'Total'
    when subgroup_name = 'Students with Disabilities' then 'Special Populations'
    when subgroup_name = 'Economically Disadvantaged' then 'Economic Status' else 'Other' end as category
from (select case l_linenumber when 1 then 'All Students' when 2 then 'Black' when 3 then 'Female'
  when 4 then 'Students with Disabilities' when 5 then 'Economically Disadvantaged' when 6 then 'Gifted'
  else 'Two or More Races' end as subgroup_name from lineitem) as labels""",
)
def subgroup_category(t):
    names = t.sql(RAW["eog"]).select(F.col("SUBGROUP_NAME").alias("subgroup_name")).distinct()
    return names.withColumn("category", L.subgroup_category(F.col("subgroup_name")))


# -- schema merging and unions ---------------------------------------------------------------

_IS_OLD = "l_shipdate < timestamp '1998-01-01 00:00:00'"
_OLD_PART = f"""select l_orderkey, l_linenumber, cast(l_suppkey as string) as DISTRICT_CODE,
  cast(l_partkey as string) as SCHOOL_CODE, l_tax from lineitem where {_IS_OLD}"""
_NEW_PART = f"""select l_linenumber, l_orderkey, cast(l_suppkey as string) as SCHOOL_DSTRCT_CD,
  cast(l_partkey as string) as INSTN_NUMBER, l_discount from lineitem where not ({_IS_OLD})"""
_DRIFT = f"select * from ({_OLD_PART}) as a union all by name select * from ({_NEW_PART}) as b"


def drifted(t: Tables) -> DataFrame:
    return shape.union_with_drift([t.sql(_OLD_PART), t.sql(_NEW_PART)])


@query("union_with_drift", oracle=_DRIFT)
def union_with_drift(t):
    return drifted(t)


@query(
    "consolidate_schemas",
    oracle=f"""select coalesce(SCHOOL_DSTRCT_CD, DISTRICT_CODE) as district_code,
  coalesce(INSTN_NUMBER, SCHOOL_CODE) as institution_number, cast(null as varchar) as report_name, l_orderkey
from ({_DRIFT}) as u""",
)
def consolidate_schemas(t):
    targets = {
        "district_code": ("SCHOOL_DSTRCT_CD", "DISTRICT_CODE"),
        "institution_number": ("INSTN_NUMBER", "SCHOOL_CODE"),
        "report_name": ("#RPT_NAME",),
    }
    return conform.consolidate_schemas(drifted(t), targets, keep=["l_orderkey"])


@query(
    "first_present",
    oracle=f"""select l_orderkey, l_linenumber, coalesce(SCHOOL_DSTRCT_CD, DISTRICT_CODE) as result
from ({_DRIFT}) as u""",
)
def first_present(t):
    df = drifted(t)
    found = C.first_present(df.columns, ["DISTRICT_ID", "school_dstrct_cd", "DISTRICT_CODE"])
    return df.select("l_orderkey", "l_linenumber", found.alias("result"))


@query(
    "tag_source",
    oracle="""select o_orderkey, 'Highest' as indicator, 'orders' as source_table from orders
union all select l_orderkey, 'Recent', 'lineitem' from lineitem""",
)
def tag_source(t):
    a = conform.tag_source(t.orders.select("o_orderkey"), indicator="Highest", source_table="orders")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return a.unionByName(conform.tag_source(lines, indicator="Recent", source_table="lineitem"))


@query(
    "union_distinct",
    oracle="""select l_suppkey as member, l_linestatus as label from lineitem
union select o_custkey % 100, o_orderstatus from orders""",
)
def union_distinct(t):
    a = t.lineitem.select(F.col("l_suppkey").alias("member"), F.col("l_linestatus").alias("label"))
    b = t.orders.select((F.col("o_custkey") % 100).alias("member"), F.col("o_orderstatus").alias("label"))
    return shape.union_distinct([a, b])


@query(
    "conform_union",
    oracle="""select l_orderkey as id, 'EOG' as assessment_name, l_discount + l_tax as proficiency_rate,
  l_discount + l_tax as avg_score from lineitem where l_returnflag = 'A'
union all select l_orderkey, 'EOC', l_discount + l_tax, l_discount + l_tax from lineitem where l_returnflag = 'N'
union all select l_orderkey, 'SAT', null, l_quantity from lineitem where l_returnflag = 'R' and l_linestatus = 'F'
union all select l_orderkey, 'ACT', null, l_quantity from lineitem where l_returnflag = 'R' and l_linestatus <> 'F'""",
)
def conform_union(t):
    """Four slices that list rate and score in different orders."""
    rows, rate = t.lineitem, F.col("l_discount") + F.col("l_tax")
    state = {"id": F.col("l_orderkey"), "proficiency_rate": rate, "avg_score": rate}
    college = {
        "id": F.col("l_orderkey"),
        "avg_score": F.col("l_quantity"),
        "proficiency_rate": C.typed_null("double"),
    }
    college_rows = rows.filter("l_returnflag = 'R'")
    return conform.conform(
        [
            (rows.filter("l_returnflag = 'A'"), {**state, "assessment_name": F.lit("EOG")}),
            (rows.filter("l_returnflag = 'N'"), {**state, "assessment_name": F.lit("EOC")}),
            (college_rows.filter("l_linestatus = 'F'"), {**college, "assessment_name": F.lit("SAT")}),
            (college_rows.filter("l_linestatus <> 'F'"), {**college, "assessment_name": F.lit("ACT")}),
        ]
    )


# -- backfill ----------------------------------------------------------------------------------

_MEMBERS = """select o_orderkey, o_orderpriority as school,
  case when o_custkey % 31 = 0 then null else concat('N', cast(o_custkey % 400 as string)) end as school_name,
  case when o_orderkey % 5 = 0 then null when o_custkey % 400 < 40 then cast(o_custkey % 800 as string)
    else cast(o_custkey % 400 as string) end as district,
  case when o_orderkey % 7 = 0 then null else concat('District ', cast(o_custkey % 400 as string)) end as district_name
from orders"""
_KNOWN = """select distinct school, school_name, district, district_name from members
  where school is not null and school_name is not null and district is not null"""
_KEYS, _FILL = ["school", "school_name"], ["district", "district_name"]


@query(
    "backfill",
    oracle=f"""with members as ({_MEMBERS}), known as ({_KNOWN})
select m.o_orderkey, m.school, m.school_name, coalesce(m.district, k.district) as district,
  coalesce(m.district_name, k.district_name) as district_name
from members as m left join known as k on m.school = k.school and m.school_name = k.school_name
  and (m.district is null or m.district_name is null)""",
)
def backfill(t):
    return conform.backfill(t.sql(_MEMBERS), _KEYS, _FILL)


@query(
    "backfill_unambiguous",
    oracle=f"""with members as ({_MEMBERS}), known as ({_KNOWN}),
single as (select school, school_name, min(district) as district, min(district_name) as district_name from known
  group by school, school_name having count(*) = 1)
select m.o_orderkey, m.school, m.school_name, coalesce(m.district, k.district) as district,
  coalesce(m.district_name, k.district_name) as district_name
from members as m left join single as k on m.school = k.school and m.school_name = k.school_name""",
)
def backfill_unambiguous(t):
    return conform.backfill(t.sql(_MEMBERS), _KEYS, _FILL, on_conflict="null")


@query(
    "ambiguous_keys",
    oracle=f"""with members as ({_MEMBERS}), known as ({_KNOWN})
select school, school_name, count(*) as tuples from known group by school, school_name having count(*) > 1""",
)
def ambiguous_keys(t):
    return conform.ambiguous_keys(t.sql(_MEMBERS), _KEYS, _FILL)


# -- report files ------------------------------------------------------------------------------

# File names that reach every rule, including the fallback.
_BASE_NAMES = (
    "Attendance SAT_Highest SAT_Recent SAT_New_Highest SAT_New_Recent SAT-Scores sat ACT_Highest ACT-Scores AP-Scores "
    "4-Year_Graduation_Rate 5-Year_Cohort Dropout_Rate Enrollment_by_Grade Enrollment_by_Subgroup "
    "direct_certification_district direct_certification_school direct_certification_school_data "
    "FY15_directly_certified_district directly_certified_school District_Mobility School_Mobility CRCT EOCT "
    "EOC_Lexile EOC_by_Grade EOC-Results EOG_Lexile EOG_by_Grade EOG-Results GAA GHSWT EGWA Certified_Personnel "
    "Educator_Qualifications Salaries_Benefits PPE_District School_PPE District_FESR FESR_School "
    "Revenues_Expenditures EL_Exit_State EL_Exit_District ELL_Deferred HS_Completer_Credentials HS_Completers "
    "Highschool_Completer HOPE_Eligible Retained_Students C11_Report C12_Report Unknown_Report"
).split()


def _file_names() -> str:
    cases = " ".join(f"when {i} then '{name}'" for i, name in enumerate(_BASE_NAMES))
    return f"""select doc_id, concat(case doc_id % {len(_BASE_NAMES)} {cases} end,
    case doc_id % 4 when 0 then '_2022-23' when 1 then '_2023-24_2024-10-01' when 2 then '_20260219_003226'
      else '_FY2018' end, '.csv') as file_name,
  concat(cast(2010 + length(source) + doc_id % 9 as string), '-x') as source_year
from documents"""


FILE_NAMES = _file_names()
_CUT = r"[_\s]\d.*"
_TYPE = (
    "case "
    + " ".join(f"when regexp_matches(lower(file_name), '{p}') then '{kind}'" for p, kind in REPORT_TYPE_RULES)
    + f" else replace(lower(regexp_replace(file_name, '{_CUT}', '')), '.csv', '') end"
)
_PATTERN = (
    r"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(file_name, '_\d{4}[-_]\d{2}.*', ''), "
    r"'_\d{8}_\d{6}.*', ''), '_fy\d{2,4}.*', '', 'i'), '\.csv$', '', 'i'))"
)


@query("classify_report_type", oracle=f"select doc_id, {_TYPE} as report_type from ({FILE_NAMES}) as f")
def classify_report_type(t):
    return files.with_report_type(t.sql(FILE_NAMES)).select("doc_id", "report_type")


@query(
    "file_pattern_profile",
    oracle=f"""select {_PATTERN} as pattern, count(*) as files, min(source_year) as first_year,
  max(source_year) as last_year from ({FILE_NAMES}) as f group by 1""",
)
def file_pattern_profile(t):
    return files.file_pattern_profile(t.sql(FILE_NAMES))


@query(
    "group_files_by_type",
    oracle=f"""select {_TYPE} as report_type, count(*) as files, min(source_year) as first_year,
  max(source_year) as last_year from ({FILE_NAMES}) as f group by 1""",
)
def group_files_by_type(t):
    return files.group_files_by_type(t.sql(FILE_NAMES))


def _scratch(t: Tables, label: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/rollcall/{label}-{uuid.uuid4().hex}"


_YEAR_FILES = {
    "1995 to 1997": f"""select cast(l_orderkey as string) as ORDER_KEY, cast(l_linenumber as string) as "#LINE",
  l_returnflag as "Flag/Type", year(l_shipdate) as folder from lineitem where {_IS_OLD}""",
    "from 1998": f"""select l_returnflag as "Flag/Type", cast(l_orderkey as string) as ORDER_KEY,
  cast(l_suppkey as string) as "District Code", year(l_shipdate) as folder from lineitem where not ({_IS_OLD})""",
}


@query(
    "raw_csv_ingest",
    oracle=f"""select cast(l_orderkey as varchar) as ORDER_KEY,
  case when {_IS_OLD} then cast(l_linenumber as varchar) end as "#LINE", l_returnflag as "Flag/Type",
  case when not ({_IS_OLD}) then cast(l_suppkey as varchar) end as "District Code",
  concat('folder=', cast(year(l_shipdate) as varchar)) as source_year from lineitem""",
)
def raw_csv_ingest(t):
    """Yearly CSV folders with two headers in different order, listed and read back."""
    root = _scratch(t, "csv")
    for text in _YEAR_FILES.values():
        t.sql(text).write.mode("append").partitionBy("folder").option("header", True).csv(root)
    catalog = files.file_catalog(t.spark, root)
    paths = sorted(row["path"] for row in catalog.select("path").toLocalIterator())
    return files.read_raw_csv(t.spark, paths, root).drop("source_file")


@query(
    "read_with_inference",
    oracle="select n_nationkey, n_name as \"Nation Name\", n_regionkey from nation",
)
def read_with_inference(t):
    path = _scratch(t, "dictionary")
    named = t.nation.withColumnRenamed("n_name", "Nation Name")
    named.write.option("header", True).csv(path)
    return files.read_with_inference(t.spark, path)


@query(
    "layer_summary",
    oracle=f"""with dropout as ({RAW['dropout_rate']}), grad as ({RAW['graduation_rate']})
select 'dropout_rate' as table_name, count(*) as rows, count(distinct source_year) as years from dropout
union all select 'graduation_rate', count(*), count(distinct source_year) from grad
union all select '(all)', (select count(*) from dropout) + (select count(*) from grad), null""",
)
def layer_summary(t):
    """Raw tables written to a layer of their own, summarized, and dropped again."""
    layer = f"raw_{uuid.uuid4().hex[:12]}"
    tables.ensure_schema(t.spark, layer, _scratch(t, layer))
    for name in ("dropout_rate", "graduation_rate"):
        tables.write_table(t.sql(RAW[name]), layer, name)
    result = pin(tables.layer_summary(t.spark, layer), "layer_summary")
    tables.reset_layer(t.spark, layer)
    t.spark.sql(f"DROP SCHEMA IF EXISTS {layer}")
    return result


# -- duplicates --------------------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]


@query(
    "duplicate_keys",
    oracle="""select l_orderkey, l_linenumber, count(*) as row_count from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
)
def duplicate_keys(t):
    return dedup.duplicate_keys(t.lineitem, _LINE)


@query(
    "worst_duplicates",
    oracle="""select l_orderkey, l_linenumber, count(*) as row_count from lineitem
group by l_orderkey, l_linenumber having count(*) > 1 order by row_count desc, l_orderkey, l_linenumber limit 5""",
)
def worst_duplicates(t):
    return dedup.worst_duplicates(t.lineitem, _LINE, 5)


@query(
    "duplicate_breakdown",
    oracle=f"""with feed as ({FEED}), per_key as (select school_year, district_code, institution_number from feed
  group by school_year, district_code, institution_number having count(*) > 1)
select school_year, count(*) as duplicate_keys from per_key group by school_year""",
)
def duplicate_breakdown(t):
    return dedup.duplicate_breakdown(
        feed(t), ["school_year", "district_code", "institution_number"], ["school_year"]
    )


_NEWEST = """select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
    order by source_file desc, l_suppkey, l_partkey, school_year, l_extendedprice, l_quantity, pct_raw nulls last,
      dropout_label) as rn from feed) as r where rn = 1"""
# Some lines agree in supplier and part as well, so the order goes on to the columns the queries show.
_NEWEST_TIES = ("l_suppkey", "l_partkey", "school_year", "l_extendedprice", "l_quantity", "pct_raw", "dropout_label")


def newest_lines(t: Tables) -> DataFrame:
    order = [F.desc_nulls_last("source_file"), *[F.asc_nulls_last(c) for c in _NEWEST_TIES]]
    return dedup.dedup(feed(t), _LINE, order)


@query(
    "dedup",
    oracle=f"""with feed as ({FEED}) select l_orderkey, l_linenumber, l_suppkey, l_partkey, count_raw, source_file
from ({_NEWEST}) as n""",
)
def dedup_query(t):
    return newest_lines(t).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "count_raw", "source_file")


@query(
    "dedup_total_order",
    oracle=f"""with feed as ({FEED}) select district_code, institution_number, l_orderkey, source_file
from (select *, row_number() over (partition by district_code, institution_number
  order by source_file desc nulls last, l_orderkey) as rn
  from (select district_code, institution_number, l_orderkey, source_file from feed) as f) as r where rn = 1""",
)
def dedup_total_order(t):
    columns = ["district_code", "institution_number", "l_orderkey", "source_file"]
    return dedup.dedup(feed(t).select(*columns), ["district_code", "institution_number"])


_RECURRING = ["l_orderkey", "l_suppkey"]


@query(
    "dedup_sieved",
    oracle="""select l_orderkey, l_suppkey, l_partkey, l_linenumber from (select *, row_number() over (
  partition by l_orderkey, l_suppkey order by l_partkey, l_linenumber) as rn from lineitem) as r where rn = 1""",
)
def dedup_sieved(t):
    """Few keys recur, so nearly all rows go around the ordering."""
    rows = t.lineitem.select(*_RECURRING, "l_partkey", "l_linenumber")
    return dedup.dedup_sieved(rows, _RECURRING)


@query("dedup_rows", oracle="select distinct text, lang from documents")
def dedup_rows(t):
    return dedup.dedup_rows(t.documents.select("text", "lang"))


@query("distinct_projection", oracle=f"select distinct school_year, detail_level from ({FEED}) as f")
def distinct_projection(t):
    return dedup.dedup_rows(feed(t).select("school_year", "detail_level"))


@query(
    "dedup_report",
    oracle="""select count(*) as before_rows, count(distinct (l_orderkey, l_linenumber)) as after_rows,
  count(*) - count(distinct (l_orderkey, l_linenumber)) as removed_rows,
  round((count(*) - count(distinct (l_orderkey, l_linenumber))) * 100.0 / count(*), 2) as removed_percent
from lineitem""",
)
def dedup_report(t):
    return dedup.dedup_report(t.lineitem, _LINE)


# -- dimensions and history ----------------------------------------------------------------------

# Customer attributes per order year: the segment changes once, names differ by source.
_HISTORY = """select c_custkey, cast(year(o_orderdate) as string) as school_year, c_name,
  concat(c_mktsegment, case when year(o_orderdate) in (1998, 1999) then '-B' else '' end) as segment,
  case when o_orderpriority = '1-URGENT' then 0 else 1 end as priority
from orders join customer on o_custkey = c_custkey"""


@query(
    "surrogate_key",
    oracle="""select row_number() over (order by c_mktsegment desc, c_custkey) as customer_key, c_custkey,
  c_mktsegment from customer""",
)
def surrogate_key(t):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    return star.surrogate_key(rows, "customer_key", [F.desc("c_mktsegment"), F.asc("c_custkey")])


@query(
    "surrogate_key_incremental",
    oracle="""with first as (select c_custkey, c_mktsegment, row_number() over (order by c_mktsegment desc, c_custkey) as customer_key
  from customer where c_custkey % 3 = 0),
added as (select c_custkey, c_mktsegment, (select max(customer_key) from first)
    + row_number() over (order by c_mktsegment desc, c_custkey) as customer_key
  from customer where c_custkey % 3 = 1)
select customer_key, c_custkey, case when c_custkey % 2 = 0 then 'MOVED' else c_mktsegment end as c_mktsegment from first
  where c_custkey % 5 <> 0
union all select customer_key, c_custkey, c_mktsegment from first where c_custkey % 5 = 0
union all select customer_key, c_custkey, c_mktsegment from added""",
)
def surrogate_key_incremental(t):
    """A second load adds members, changes attributes of some and lacks others."""
    order = [F.desc("c_mktsegment"), F.asc("c_custkey")]
    rows = t.customer.select("c_custkey", "c_mktsegment")
    first = pin(star.surrogate_key(rows.filter("c_custkey % 3 = 0"), "customer_key", order), "first_load")
    moved = F.when((F.col("c_custkey") % 3 == 0) & (F.col("c_custkey") % 2 == 0), F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    second = rows.filter("c_custkey % 3 = 1 or c_custkey % 3 = 0 and c_custkey % 5 <> 0").withColumn("c_mktsegment", moved)
    return star.surrogate_key_onto(second, first, "customer_key", ["c_custkey"], order)


@query(
    "latest_per_key",
    oracle=f"""select c_custkey, school_year, segment, priority from (select *, row_number() over (
    partition by c_custkey order by school_year desc, priority, segment) as rn from ({_HISTORY}) as h) as r
where rn = 1""",
)
def latest_per_key(t):
    rows = t.sql(_HISTORY).select("c_custkey", "school_year", "segment", "priority")
    return history.latest_per_key(rows, ["c_custkey"], "school_year", [F.asc("priority")])


@query(
    "scd_current",
    oracle=f"""select c_custkey, segment, '2010-11' as effective_date, cast(null as varchar) as end_date,
  true as is_current from (select *, row_number() over (partition by c_custkey order by school_year desc, segment)
    as rn from ({_HISTORY}) as h) as r where rn = 1""",
)
def scd_current(t):
    rows = t.sql(_HISTORY).select("c_custkey", "school_year", "segment")
    return history.scd_current(rows, ["c_custkey"], "school_year", "2010-11")


@query(
    "attribute_spans",
    oracle=f"""select c_custkey, segment, min(school_year) as first_year, max(school_year) as last_year
from ({_HISTORY}) as h group by c_custkey, segment""",
)
def attribute_spans(t):
    return history.attribute_spans(t.sql(_HISTORY), ["c_custkey", "segment"], "school_year")


@query(
    "scd2_history",
    oracle=f"""with yearly as (select distinct c_custkey, school_year, segment from ({_HISTORY}) as h),
starts as (select * from (select *, lag(segment) over (partition by c_custkey order by school_year) as previous
    from yearly) as m where previous is null or previous <> segment)
select c_custkey, segment, school_year as effective_date,
  lead(school_year) over (partition by c_custkey order by school_year) as end_date,
  lead(school_year) over (partition by c_custkey order by school_year) is null as is_current from starts""",
)
def scd2_history(t):
    """The segment leaves and returns to its old value: three runs for some customers."""
    return history.scd2_history(t.sql(_HISTORY), ["c_custkey"], ["segment"], "school_year")


# -- joins ------------------------------------------------------------------------------------------

# Part of the suppliers are no members; codes start at 5000.
_DIM = """select s_suppkey + 5000 as district_key, cast(s_suppkey as string) as district_code, s_nationkey,
  s_name as district_name from supplier where s_acctbal > 2000"""


@query(
    "attach_dimension",
    oracle=f"""with feed as ({FEED}), dim as ({_DIM})
select {_IDS_SQL}, district_key from feed left join dim on feed.district_code = dim.district_code""",
)
def attach_dimension(t):
    joined = star.attach_dimension(feed(t), t.sql(_DIM), "district_code", "district_key")
    return joined.select(*_IDS, "district_key")


_SCORES = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag as assessment_name,
  case when l_linenumber < 3 then null when l_linenumber = 3 then '' else cast(l_linenumber as string) end as grade,
  case when l_linestatus = 'F' then 'new' end as assessment_format
from lineitem"""
_SCORE_DIM = """select row_number() over (order by assessment_name, grade_level, assessment_format) as assessment_key, *
from (select distinct l_returnflag as assessment_name,
  case when l_linenumber < 4 then null else cast(l_linenumber as string) end as grade_level,
  case when l_linestatus = 'F' then 'new' else '' end as assessment_format from lineitem
  where l_linenumber <> 7) as members"""


@query(
    "attach_dimension_multi",
    oracle=f"""with f as ({_SCORES}), d as ({_SCORE_DIM.replace('grade_level,', 'grade_level nulls first,', 1)})
select {_IDS_SQL}, d.assessment_key from f left join d on f.assessment_name = d.assessment_name
  and coalesce(f.grade, '') = coalesce(d.grade_level, '')
  and coalesce(f.assessment_format, '') = coalesce(d.assessment_format, '')""",
)
def attach_dimension_multi(t):
    """NULL grades match NULL members, and NULL formats match the empty text."""
    joined = star.attach_dimension(
        t.sql(_SCORES),
        t.sql(_SCORE_DIM),
        {"assessment_name": "assessment_name", "grade": "grade_level", "assessment_format": "assessment_format"},
        "assessment_key",
        null_as={"grade": "", "assessment_format": ""},
    )
    return joined.select(*_IDS, "assessment_key")


@query(
    "unmatched_keys",
    oracle=f"""with feed as ({FEED}), dim as ({_DIM})
select distinct district_code from feed where district_code not in (select district_code from dim)""",
)
def unmatched_keys(t):
    return star.unmatched_keys(feed(t), t.sql(_DIM), "district_code")


@query(
    "distribution_by_dim",
    oracle=f"""with feed as ({FEED}), dim as ({_DIM})
select s_nationkey, count(*) as record_count from feed join dim on feed.l_suppkey + 5000 = dim.district_key
group by s_nationkey""",
)
def distribution_by_dim(t):
    fact = feed(t).withColumn("district_key", F.col("l_suppkey") + 5000)
    return star.distribution_by_dim(fact, t.sql(_DIM), "district_key", ["s_nationkey"])


@query(
    "fact_build",
    oracle="""select c.c_custkey + 100 as customer_key, y.year_key, o.o_orderkey, o.o_totalprice
from (select *, cast(year(o_orderdate) as varchar) as school_year from orders where o_orderstatus = 'F') as o
left join customer as c on o.o_custkey = c.c_custkey and c.c_acctbal > 0
left join (select row_number() over (order by yr) as year_key, yr
  from (select distinct cast(year(o_orderdate) as varchar) as yr from orders where o_orderstatus = 'O') as ys) as y
  on o.school_year = y.yr""",
)
def fact_build(t):
    orders = t.orders.select(
        "o_orderkey",
        "o_totalprice",
        "o_custkey",
        F.year("o_orderdate").cast("string").alias("school_year"),
        F.col("o_orderstatus").alias("detail_level"),
    )
    customers = t.customer.filter("c_acctbal > 0").select(
        (F.col("c_custkey") + 100).alias("customer_key"), F.col("c_custkey").alias("o_custkey")
    )
    years = orders.filter("detail_level = 'O'").select("school_year").distinct()
    years = star.surrogate_key(years, "year_key", [F.asc("school_year")])
    dims = [(customers, "o_custkey", "customer_key"), (years, "school_year", "year_key")]
    return star.build_fact(orders, dims, ["o_orderkey", "o_totalprice"], level="F")


# -- reshaping ---------------------------------------------------------------------------------------


@query(
    "component_pivot",
    oracle="""select l_orderkey, max(case when l_returnflag = 'A' then l_quantity end) as A,
  max(case when l_returnflag = 'N' then l_quantity end) as N,
  max(case when l_returnflag = 'R' then l_quantity end) as R from lineitem group by l_orderkey""",
)
def component_pivot(t):
    return shape.component_pivot(t.lineitem, ["l_orderkey"], "l_returnflag", ["A", "N", "R"], "l_quantity")


_families = ", ".join(
    f"try_cast(nullif(STUDENT_COUNT_{g}, 'TFS') as integer) as student_count_{g}, "
    + ", ".join(
        f"cast(try_cast(nullif({m}_{g}, 'TFS') as decimal(5,1)) as double) as {m.lower()}_{g}"
        for m in ATTENDANCE_RATES
    )
    for g in (name.lower() for name in ATTENDANCE_SUBGROUPS)
)


@query("metric_family", oracle=f"select source_file, {_families} from ({RAW['attendance']}) as r")
def metric_family(t):
    metrics = {"STUDENT_COUNT": C.clean_int}
    metrics.update({m: lambda c: C.clean_decimal(c, 5, 1) for m in ATTENDANCE_RATES})
    columns = shape.metric_family(ATTENDANCE_SUBGROUPS, metrics)
    return t.sql(RAW["attendance"]).select("source_file", *columns)


_LONG_IDS = "school_year, institution_key"
_race = ("asian", "native", "black", "hispanic", "multiracial", "white")
_special = ("migrant", "economically_disadvantaged", "students_with_disabilities", "english_learner")
_programs = (
    "remedial_6_8 eip_k_5 remedial_9_12 special_ed_k12 esol special_ed_pk vocation_9_12 alt_programs gifted"
).split()


def _long(kind: str, name: str, count: str, percent: str) -> str:
    return f"select {_LONG_IDS}, '{kind}' as subgroup_type, '{name}' as subgroup_name, {count}, {percent} from s"


_enrollment_rows = [
    _long(kind, n, 'cast(null as double) as "count"', f'pct_{n} as "percent"')
    for kind, names in (("race_ethnicity", _race), ("gender", ("male", "female")), ("special_population", _special))
    for n in names
] + [_long("program", n, f"count_{n}", f"pct_{n}") for n in _programs]


@query(
    "wide_to_long",
    oracle=f"with s as ({SILVER_SQL['enrollment_by_subgroup']}) {' union all '.join(_enrollment_rows)}",
)
def wide_to_long(t):
    return enrollment_long(silver(t, "enrollment_by_subgroup"), ["school_year", "institution_key"])


@query(
    "attendance_wide_to_long",
    oracle=f"with s as ({SILVER_SQL['attendance']}) "
    + " union all ".join(
        f"select {_LONG_IDS}, '{g}' as subgroup, student_count_{g} as student_count, five_or_fewer_percent_{g} as "
        f"five_or_fewer_percent, six_to_fifteen_percent_{g} as six_to_fifteen_percent, over_15_percent_{g} as "
        f"over_15_percent, chronic_absent_perc_{g} as chronic_absent_perc from s"
        for g in (name.lower() for name in ATTENDANCE_SUBGROUPS)
    ),
)
def attendance_wide_to_long(t):
    return attendance_long(silver(t, "attendance"), ["school_year", "institution_key"])


# -- aggregation, ranking ------------------------------------------------------------------------------


@query(
    "group_profile",
    oracle=from_feed(
        "school_year, detail_level, count(*) as record_count, cast(sum(l_quantity) as double) as total, "
        "avg(l_quantity) as mean, count(count_raw) as known",
        "group by school_year, detail_level",
    ),
)
def group_profile(t):
    aggs = {"total": F.sum("l_quantity"), "mean": F.avg("l_quantity"), "known": F.count("count_raw")}
    return summary.group_profile(feed(t), ["school_year", "detail_level"], aggs)


_PROFILE = (
    "count({c}) as n, cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value, "
    "round(avg({c}), 6) as mean_value, round(stddev({c}), 6) as stddev_value, round(sum({c}), 2) as total_value"
)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "mean_value": F.round("mean_value", 6),
            "stddev_value": F.round("stddev_value", 6),
            "total_value": F.round("total_value", 2),
        }
    )


@query(
    "numeric_profile",
    oracle=" union all ".join(
        f"select '{c}' as measure, {_PROFILE.format(c=c)} from lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_tax")
    ),
)
def numeric_profile(t):
    return _rounded(summary.numeric_profile(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"]))


@query(
    "numeric_profile_by",
    oracle=f"""with feed as ({FEED}) select detail_level, 'l_quantity' as measure,
  {_PROFILE.format(c='l_quantity')} from feed group by detail_level""",
)
def numeric_profile_by(t):
    return _rounded(summary.numeric_profile(feed(t), ["l_quantity"], by=["detail_level"]))


@query(
    "count_distinct_by",
    oracle=from_feed(
        "school_year, count(*) as record_count, count(distinct district_code) as districts, "
        "count(distinct count_raw) + max(case when count_raw is null then 1 else 0 end) as counts",
        "group by school_year",
    ).replace("max(case", "cast(max(case").replace("else 0 end) as counts", "else 0 end) as bigint) as counts"),
)
def count_distinct_by(t):
    columns = {"districts": "district_code", "counts": "count_raw"}
    known = summary.distinct_counts(feed(t), ["school_year"], {"districts": "district_code"})
    both = summary.distinct_counts(feed(t), ["school_year"], columns, count_null=True)
    return known.join(both.select("school_year", "counts"), "school_year")


@query(
    "first_last_by",
    oracle=from_feed(
        "district_code, dropout_label, min(school_year) as first_year, max(school_year) as last_year",
        "group by district_code, dropout_label",
    ),
)
def first_last_by(t):
    return history.attribute_spans(feed(t), ["district_code", "dropout_label"], "school_year")


_TOP = "l_extendedprice, l_orderkey, l_linenumber, l_partkey"
_TIES = ["l_orderkey", "l_linenumber", "l_partkey"]


@query(
    "top_n",
    oracle=from_feed(_TOP, "where detail_level = 'School' order by l_extendedprice desc, l_orderkey, l_linenumber, "
                     "l_partkey limit 10"),
)
def top_n(t):
    return summary.top_n(
        feed(t), "l_extendedprice", 10, _TIES, "detail_level = 'School'", ["l_extendedprice", *_TIES]
    )


@query(
    "bottom_n",
    oracle=from_feed(_TOP, "order by l_extendedprice, l_orderkey, l_linenumber, l_partkey limit 10"),
)
def bottom_n(t):
    return summary.top_n(
        feed(t), "l_extendedprice", 10, _TIES, columns=["l_extendedprice", *_TIES], ascending=True
    )


@query(
    "sample_preview",
    oracle=from_feed(
        "l_orderkey, l_linenumber, l_partkey, school_year",
        "where school_year = '1997-98' order by l_orderkey desc, l_linenumber, l_partkey limit 5",
    ),
)
def sample_preview(t):
    order = [F.desc("l_orderkey"), "l_linenumber", "l_partkey"]
    return summary.sample(feed(t), 5, "school_year = '1997-98'", [*_TIES, "school_year"], order)


# -- reports ---------------------------------------------------------------------------------------------


@query(
    "trend_by_year",
    oracle=rf"""with feed as ({FEED}), typed as (
  select school_year, detail_level, try_cast(regexp_replace(nullif(count_raw, 'TFS'), '\.0*$', '') as integer) as n,
    cast(try_cast(nullif(pct_raw, 'TFS') as decimal(5,1)) as double) as rate from ({_NEWEST}) as x)
select school_year, count(*) as record_count, count(n) as student_count_known, avg(n) as student_count_mean,
  count(rate) as rate_known, round(avg(rate), 6) as rate_mean
from typed where detail_level = 'School' group by school_year""",
)
def trend_by_year(t):
    typed = newest_lines(t).select(
        "school_year",
        "detail_level",
        C.clean_int("count_raw", strip_zeros=True).alias("student_count"),
        C.clean_decimal("pct_raw", 5, 1).alias("rate"),
    )
    trend = summary.yearly_trend(shape.level_filter(typed, "School"), ["student_count", "rate"])
    return trend.withColumn("rate_mean", F.round("rate_mean", 6))


@query("coverage_by_year", oracle=from_feed("school_year, count(*) as record_count", "group by school_year"))
def coverage_by_year(t):
    return summary.distribution(feed(t), ["school_year"])


@query(
    "distribution",
    oracle=from_feed(
        "detail_level, count(*) as record_count, round(sum(l_extendedprice), 2) as total_amount",
        "group by detail_level",
    ),
)
def distribution(t):
    aggs = {"total_amount": F.round(F.sum("l_extendedprice"), 2)}
    return summary.distribution(feed(t), ["detail_level"], aggs)


@query(
    "coverage_crosstab",
    oracle=from_feed(
        "school_year, dropout_label, count(*) as record_count",
        "where school_year >= '1997-98' group by school_year, dropout_label",
    ),
)
def coverage_crosstab(t):
    rows = shape.year_range(feed(t), "1997-98")
    return summary.distribution(rows, ["school_year", "dropout_label"], descending=True)


_AMOUNTS = f"""select school_year, district_code, detail_level, dropout_label,
  case when l_quantity < 3 then 0 when l_quantity < 6 then -l_quantity else l_quantity end as amount from ({FEED}) as f"""


@query(
    "zero_drilldown",
    oracle=f"select detail_level, dropout_label, count(*) as record_count from ({_AMOUNTS}) as a where amount = 0 "
    "group by detail_level, dropout_label",
)
def zero_drilldown(t):
    return summary.drilldown(amounts(t), "amount = 0", ["detail_level", "dropout_label"])


def amounts(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    amount = F.when(q < 3, 0.0).when(q < 6, -q).otherwise(q)
    return feed(t).select("school_year", "district_code", "detail_level", "dropout_label", amount.alias("amount"))


@query(
    "negative_drilldown",
    oracle=f"select detail_level, dropout_label, count(*) as record_count, sum(amount) as total_amount "
    f"from ({_AMOUNTS}) as a where amount < 0 group by detail_level, dropout_label",
)
def negative_drilldown(t):
    aggs = {"total_amount": F.sum("amount")}
    return summary.drilldown(amounts(t), "amount < 0", ["detail_level", "dropout_label"], aggs)


@query(
    "outliers",
    oracle=from_feed(_TOP, "where l_extendedprice > 0 order by l_extendedprice desc, l_orderkey, l_linenumber, "
                     "l_partkey limit 10"),
)
def outliers(t):
    return summary.top_n(feed(t), "l_extendedprice", 10, _TIES, "l_extendedprice > 0", ["l_extendedprice", *_TIES])


@query(
    "year_gap",
    oracle=from_feed(
        "school_year, count(*) as record_count, count(distinct district_code) as districts, "
        "count(distinct case when detail_level = 'School' then concat(district_code, '_', institution_number) end) "
        "as schools, count(distinct source_file) as source_files",
        "group by school_year",
    ),
)
def year_gap(t):
    key = C.composite_key("district_code", "institution_number")
    entities = {
        "districts": F.col("district_code"),
        "schools": F.when(F.col("detail_level") == "School", key),
        "source_files": F.col("source_file"),
    }
    return summary.year_gap(feed(t), "school_year", entities)


@query(
    "key_frequency",
    oracle=from_feed(
        "institution_number, count(*) as record_count",
        "group by institution_number order by record_count desc, institution_number limit 10",
    ),
)
def key_frequency(t):
    return summary.key_frequency(feed(t), "institution_number", 10)


@query(
    "subgroup_ranking",
    oracle=f"""select school_year, subgroup_label, dropout_rate, dropout_count, institution_key
from ({SILVER_SQL['dropout_rate']}) as s
where school_year = '1998-99' and grade_range = '9-12' and detail_level = 'State'""",
)
def subgroup_ranking(t):
    return summary.ranking(
        silver(t, "dropout_rate"),
        "dropout_rate",
        ["school_year", "subgroup_label", "dropout_rate", "dropout_count", "institution_key"],
        "school_year = '1998-99' AND grade_range = '9-12' AND detail_level = 'State'",
    )


@query(
    "statewide_average_by_year",
    oracle=f"""select school_year, count(*) as record_count,
  count(pct_economically_disadvantaged) as pct_economically_disadvantaged_known,
  round(avg(pct_economically_disadvantaged), 6) as pct_economically_disadvantaged_mean,
  count(pct_english_learner) as pct_english_learner_known,
  round(avg(pct_english_learner), 6) as pct_english_learner_mean
from ({SILVER_SQL['enrollment_by_subgroup']}) as s
where detail_level = 'District' and pct_economically_disadvantaged is not null group by school_year""",
)
def statewide_average_by_year(t):
    measures = ["pct_economically_disadvantaged", "pct_english_learner"]
    trend = summary.yearly_trend(
        silver(t, "enrollment_by_subgroup"),
        measures,
        predicate="detail_level = 'District' AND pct_economically_disadvantaged IS NOT NULL",
    )
    return trend.withColumns({f"{m}_mean": F.round(f"{m}_mean", 6) for m in measures})


@query(
    "school_dimension_profile",
    oracle=f"""select detail_level, count(*) as members, count(*) - count(institution_key) as null_keys,
  count(distinct district_code) as districts,
  count(*) - count(nullif(institution_name, '')) as missing_institution_name,
  count(*) - count(nullif(grades_served, '')) as missing_grades_served
from ({DIM_SQL['school']}) as d group by detail_level""",
)
def school_dimension_profile(t):
    return dim_profile(dimension(t, "school"), names=["institution_name", "grades_served"])
