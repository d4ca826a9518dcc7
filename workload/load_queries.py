"""Loads as queries: raw files to a published layer, and what readers see meanwhile."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators import states
from rollcall.plans import feeds, load
from rollcall.plans.reconcile import write_reconciled
from rollcall.session import pin, shared_dir
from rollcall.sources import files, tables
from workload.feed_queries import SILVER_SQL, dimension, raw_tables, silver
from workload.raw_tables import RAW
from workload.registry import Tables, query


def scratch(t: Tables, label: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/rollcall/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_layer(t: Tables) -> Iterator[str]:
    """A layer of its own, dropped with all its versions in the end."""
    layer = f"layer_{uuid.uuid4().hex[:12]}"
    tables.ensure_schema(t.spark, layer, scratch(t, layer))
    try:
        yield layer
    finally:
        tables.reset_layer(t.spark, layer)
        t.spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def upload(t: Tables, root: str, rows: DataFrame) -> None:
    """Write ``rows`` as CSV files named by their columns ``folder`` and ``file``."""
    staging = scratch(t, "csv")
    dealt = rows.repartition("folder", "file")
    dealt.write.partitionBy("folder", "file").option("header", True).csv(staging)
    jvm = t.spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(staging).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for found in store.globStatus(path(f"{staging}/folder=*/file=*/part-*")):
        written = found.getPath()
        file = unquote(written.getParent().getName().removeprefix("file="))
        folder = unquote(written.getParent().getParent().getName().removeprefix("folder="))
        store.mkdirs(path(f"{root}/{folder}"))
        store.rename(written, path(f"{root}/{folder}/{file}"))


# -- raw load --------------------------------------------------------------------------------

_YEAR = "cast(year(l_shipdate) as string)"
# Reports whose header changes over the years, one of them below Exports, and the dictionary.
_UPLOADS = (
    f"""select cast(l_orderkey as string) as ORDER_KEY, cast(l_linenumber as string) as "#LINE", l_returnflag as "Flag/Type",
  concat('y', {_YEAR}) as folder, concat('Dropout_Rate_', {_YEAR}, '.csv') as file
from lineitem where year(l_shipdate) < 1996""",
    f"""select l_returnflag as "Flag/Type", cast(l_orderkey as string) as ORDER_KEY, cast(l_suppkey as string) as "District Code",
  concat('y', {_YEAR}) as folder, concat('Dropout_Rate_', {_YEAR}, '-', lpad(cast((year(l_shipdate) + 1) % 100 as string), 2, '0'),
  '_2024-10-01.csv') as file
from lineitem where year(l_shipdate) >= 1996""",
    """select cast(o_orderkey as string) as ORDER_KEY, o_orderpriority as PRIORITY,
  concat('y', cast(year(o_orderdate) as string), '/Exports') as folder, 'Attendance 2+3.csv' as file
from orders""",
    """select n_nationkey as "Column Key", n_name as "Column Name", 'data_dictionary' as folder, 'terms.csv' as file from nation""",
)


@query(
    "bronze_ingest",
    oracle="""select 'dropout_rate' as table_name, concat('y', year(l_shipdate)) as source_year,
  case when year(l_shipdate) < 1996 then concat('Dropout_Rate_', year(l_shipdate), '.csv')
    else concat('Dropout_Rate_', year(l_shipdate), '-', lpad(cast((year(l_shipdate) + 1) % 100 as varchar), 2, '0'), '_2024-10-01.csv')
    end as source_file,
  cast(l_orderkey as varchar) as order_key, case when year(l_shipdate) < 1996 then cast(l_linenumber as varchar) end as line,
  l_returnflag as flag, case when year(l_shipdate) >= 1996 then cast(l_suppkey as varchar) end as district, null as priority, null as term
from lineitem
union all select 'attendance', concat('y', year(o_orderdate)), 'Attendance 2+3.csv', cast(o_orderkey as varchar), null, null, null,
  o_orderpriority, null from orders
union all select 'data_dictionary', null, null, cast(n_nationkey as varchar), null, null, null, null, n_name from nation""",
)
def bronze_ingest(t):
    """Files of two report types, one with drifting headers, and the dictionary: listed,
    classified, loaded and read back from the published layer."""
    root = scratch(t, "upload")
    for text in _UPLOADS:
        upload(t, root, t.sql(text))
    names = {"#LINE": "line", "Flag/Type": "flag", "District Code": "district", "PRIORITY": "priority", "Column Name": "term"}
    with scratch_layer(t) as layer:
        load.load_bronze(t.spark, root, layer)
        frames = []
        for name in tables.layer_tables(t.spark, layer):
            rows = tables.table_scan(t.spark, layer, name).withColumnsRenamed({"Column Key": "order_key", "ORDER_KEY": "order_key", **names})
            frames.append(rows.select(F.lit(name).alias("table_name"), "*").withColumn("order_key", F.col("order_key").cast("string")))
        loaded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        columns = ["table_name", "source_year", "source_file", "order_key", *names.values()]
        return pin(loaded.select(columns), "bronze_ingest")


@query(
    "report_headers",
    oracle="""select report_type, n_columns, count(*) as files from (
  select distinct 'dropout_rate' as report_type, 3 as n_columns, year(l_shipdate) as y from lineitem
  union all select distinct 'attendance', 2, year(o_orderdate) from orders) as f
group by report_type, case when report_type = 'dropout_rate' and y < 1996 then 1 else 0 end, n_columns""",
)
def report_headers(t):
    """Files per report type and distinct header, from one job over the first lines."""
    root = scratch(t, "upload")
    for text in _UPLOADS:
        upload(t, root, t.sql(text))
    groups = [(kind, len(names), len(paths)) for kind, found in files.report_layout(t.spark, root).items() for names, paths in found]
    return t.spark.createDataFrame(groups, "report_type string, n_columns int, files long")


# -- publication -----------------------------------------------------------------------------


class _Stopped(Exception):
    pass


_FIRST = "select l_orderkey, l_quantity from lineitem where l_linenumber = 1"
_SECOND = "select l_orderkey, l_quantity, l_tax from lineitem where l_linenumber <= 2"


@query(
    "layer_publication",
    oracle=f"""with first as ({_FIRST}), second as ({_SECOND}), s(step, lines) as (
  select step, case when step = 'after' then 2 else 1 end from (values ('published'), ('during'), ('failed'), ('after')) as v(step))
select step, 'line' as table_name, case lines when 1 then (select count(*) from first) else (select count(*) from second) end as rows,
  case lines when 1 then (select sum(l_orderkey) from first) else (select sum(l_orderkey) from second) end as key_sum,
  lines + 1 as n_columns from s
union all select step, 'supplier', (select count(*) from supplier), (select sum(s_suppkey) from supplier), 1 from s""",
)
def layer_publication(t):
    """What a layer holds before, during and after a load, and after one that fails half-way."""
    first, second = t.sql(_FIRST), t.sql(_SECOND)
    suppliers = t.supplier.select("s_suppkey")
    seen = []
    with scratch_layer(t) as layer:

        def look(step: str) -> None:
            for name, key in (("line", "l_orderkey"), ("supplier", "s_suppkey")):
                rows = tables.table_scan(t.spark, layer, name)
                width = F.lit(len(rows.columns)).alias("n_columns")
                counted = rows.agg(F.count("*").alias("rows"), F.sum(key).cast("long").alias("key_sum"), width)
                seen.append(pin(counted.select(F.lit(step).alias("step"), F.lit(name).alias("table_name"), "*"), "seen"))

        with tables.publication(t.spark, layer) as new:
            new.write(first, "line")
            new.write(suppliers, "supplier")
        look("published")
        try:
            with tables.publication(t.spark, layer) as new:
                new.write(second, "line")
                look("during")
                raise _Stopped
        except _Stopped:
            look("failed")
        with tables.publication(t.spark, layer) as new:
            new.write(second, "line")
        look("after")
    return reduce(lambda a, b: a.unionByName(b), seen)


@query(
    "list_layer",
    oracle="""select 'customer' as table_name, count(*) as rows, 1 as load_number from customer
union all select 'supplier', count(*), 2 from supplier""",
)
def list_layer(t):
    """Tables of a layer with the rows and the load that its manifest names."""
    with scratch_layer(t) as layer:
        for names in (("customer", "supplier"), ("supplier",)):
            with tables.publication(t.spark, layer) as new:
                for name in names:
                    new.write(getattr(t, name), name)
        known = tables.manifest(t.spark, layer)
        listed = tables.list_layer(t.spark, layer).join(known, "table_name")
        number = F.substring_index("schema_name", "__", -1).cast("int").alias("load_number")
        return pin(listed.select("table_name", "rows", number), "list_layer")


# -- reconciliation from the write --------------------------------------------------------------

_RAW_ROWS = {
    **{name: f"select count(*) as r from ({RAW[name]}) as t" for name in feeds.SINGLE_FEEDS},
    "revenues": f"""select count(*) as r from ({RAW['revenues']}) as t
  where coalesce(LONG_SCHOOL_YEAR, SCHOOL_YEAR) is not null and coalesce(SCHOOL_DSTRCT_CD, DISTRICT_CODE) is not null""",
    "act": " union all ".join(f"select count(*) as r from ({RAW[name]}) as t" for name in feeds.ACT_TABLES),
    "direct_certification": " union all ".join(
        f"select count(*) as r from ({RAW[name]}) as t where FISCAL_YEAR is not null" for name in feeds.DIRECT_CERTIFICATION_TABLES
    ),
}


def _register_reconcile(name: str) -> None:
    @query(
        f"reconcile_{name}",
        oracle=f"""with raw as (select cast(sum(r) as bigint) as r from ({_RAW_ROWS[name]}) as parts),
built as (select count(*) as b from ({SILVER_SQL[name]}) as s)
select 'reconcile' as "check", '{name}' as subject, 'pass' as status, cast(b as double) as observed,
  concat(cast(r as varchar), ' - ', cast(r - b as varchar)) as expected, cast(0 as bigint) as n from raw, built""",
    )
    def build(t: Tables) -> DataFrame:
        """Counts of raw, kept and written rows, all from the job that writes the table."""
        with scratch_layer(t) as layer, tables.publication(t.spark, layer) as new:
            return write_reconciled(name, raw_tables(t, name), lambda df: new.write(df, name))


for _name in _RAW_ROWS:
    _register_reconcile(_name)


@query(
    "read_back_published",
    oracle=f"""select 'nation' as table_name, count(*) as rows, 3 as columns from nation
union all select 'dropout_rate', count(*), 14 from ({SILVER_SQL['dropout_rate']}) as s""",
)
def read_back_published(t):
    """Rows and columns of published tables, as counted when they were written."""
    with scratch_layer(t) as layer:
        with tables.publication(t.spark, layer) as new:
            new.write(t.nation, "nation")
            new.write(silver(t, "dropout_rate"), "dropout_rate")
        found = [tables.read_back(t.spark, layer, name) for name in ("nation", "dropout_rate")]
        names = F.substring_index("table_name", ".", -1).alias("table_name")
        return found[0].unionByName(found[1]).select(names, "rows", "columns")


# -- mergeable states ---------------------------------------------------------------------------

_MEASURES = ("l_quantity", "l_extendedprice", "l_tax")
_GAPS = """select year(l_shipdate) as source_year, case when l_partkey % 10 = 0 then null else l_quantity end as l_quantity,
  l_extendedprice, l_tax from lineitem"""


@query(
    "profile_incremental",
    oracle=" union all ".join(
        f"""select '{c}' as measure, count({c}) as n, count(*) - count({c}) as n_missing, cast(min({c}) as double) as min_value,
  cast(max({c}) as double) as max_value, round(avg(cast({c} as double)), 6) as mean_value,
  round(stddev_samp(cast({c} as double)), 6) as stddev_value, round(sum(cast({c} as double)), 2) as total_value
from ({_GAPS}) as g"""
        for c in _MEASURES
    ),
)
def profile_incremental(t):
    """States of the years before the last are kept; the last year's is added to them."""
    rows = t.sql(_GAPS)
    last = "source_year = 1998"
    kept = pin(states.profile_state(rows.filter(f"not ({last})"), _MEASURES, ["source_year"]), "profile_state")
    added = states.profile_state(rows.filter(last), _MEASURES, ["source_year"])
    merged = states.merge_profiles(kept.unionByName(added))
    rounded = {c: F.round(c, digits) for c, digits in (("mean_value", 6), ("stddev_value", 6), ("total_value", 2))}
    return merged.withColumns(rounded)


@query(
    "distinct_incremental",
    oracle="""select 'suppliers' as entity, year(l_shipdate) as source_year, count(distinct l_suppkey) as "values" from lineitem group by 2
union all select 'parts', year(l_shipdate), count(distinct l_partkey) from lineitem group by 2
union all select 'orders', year(l_shipdate), count(distinct l_orderkey) from lineitem group by 2
union all select 'suppliers', null, count(distinct l_suppkey) from lineitem
union all select 'parts', null, count(distinct l_partkey) from lineitem
union all select 'orders', null, count(distinct l_orderkey) from lineitem""",
)
def distinct_incremental(t):
    """Distinct codes per year and over all years, from bitmaps of two loads."""
    rows = t.lineitem.withColumn("source_year", F.year("l_shipdate"))
    codes = {"suppliers": "l_suppkey", "parts": "l_partkey", "orders": "l_orderkey"}
    kept = pin(states.distinct_state(rows.filter("source_year <= 1996"), ["source_year"], codes), "distinct_state")
    added = states.distinct_state(rows.filter("source_year > 1996"), ["source_year"], codes)
    state = kept.unionByName(added)
    whole = states.merge_distinct(state).withColumn("source_year", F.lit(None).cast("int"))
    return states.merge_distinct(state, ["source_year"]).unionByName(whole)


@query(
    "schools_per_year",
    oracle=f"""select school_year, count(distinct institution_key) as "values" from ({SILVER_SQL['enrollment_by_grade']}) as s
where institution_key is not null group by school_year""",
)
def schools_per_year(t):
    """Schools per year by bitmaps over the keys of the school dimension."""
    rows = pin(silver(t, "enrollment_by_grade").select("institution_key", "school_year"), "grades")
    schools = dimension(t, "school").select("institution_key", "school_key")
    state = states.distinct_state(rows.join(schools, "institution_key"), ["school_year"], {"schools": "school_key"})
    return states.merge_distinct(state, ["school_year"]).select("school_year", "values")
