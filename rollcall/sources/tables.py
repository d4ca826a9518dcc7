"""Layer tables: one schema per layer, one table per report type, dimension or fact.

A load publishes a layer in two phases.  Its tables are first written beside the old ones,
into a schema of their own version; when all of them and their manifest are there, the
views of the layer are pointed to them, the view of the manifest last.  A load that fails
drops its version and nothing else has changed; one that dies while views are pointed over
is finished or undone by :func:`recover`.  The version before is kept for queries that still
read it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.shape import quoted

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
MANIFEST = "layer_manifest"
_MANIFEST_SCHEMA = "table_name string, schema_name string, rows long"


class SchemaChanged(ValueError):
    """The new data does not have the schema of the existing table."""


def qualified(layer: str, table: str) -> str:
    return f"{layer}.{quoted(table)}"


def ensure_schema(spark: SparkSession, layer: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{at}")


def _objects(spark: SparkSession, layer: str) -> dict[str, bool]:
    """Name to whether it is a view (temporary views do not belong to a layer)."""
    return {t.name: t.tableType == "VIEW" for t in spark.catalog.listTables(layer) if not t.isTemporary}


def layer_tables(spark: SparkSession, layer: str) -> list[str]:
    """Sorted table names of a layer."""
    return sorted(name for name in _objects(spark, layer) if name != MANIFEST)


def list_layer(spark: SparkSession, layer: str) -> DataFrame:
    rows = [(layer, name) for name in layer_tables(spark, layer)]
    return spark.createDataFrame(rows, "layer string, table_name string")


def reset_layer(spark: SparkSession, layer: str) -> list[str]:
    """Drop every table of the layer, with all its versions, and return their names."""
    names = layer_tables(spark, layer)
    for name, view in _objects(spark, layer).items():
        spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {qualified(layer, name)}")
    for version in versions(spark, layer):
        spark.sql(f"DROP SCHEMA IF EXISTS {version} CASCADE")
    return names


def table_scan(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.table(qualified(layer, table))


def check_schema(df: DataFrame, name: str, on_schema_change: str) -> None:
    """Refuse ``df`` under ``fail`` if the table ``name`` exists with another schema."""
    spark = df.sparkSession
    if on_schema_change not in ("replace", "fail"):
        raise ValueError(f"on_schema_change must be 'replace' or 'fail', not {on_schema_change!r}")
    if on_schema_change == "fail" and spark.catalog.tableExists(name):
        old = [(f.name, f.dataType) for f in spark.table(name).schema]
        new = [(f.name, f.dataType) for f in df.schema]
        if sorted(old, key=str) != sorted(new, key=str):
            raise SchemaChanged(f"{name}: {new} does not match {old}")


def write_table(
    df: DataFrame,
    layer: str,
    table: str,
    on_schema_change: str = "replace",
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> int:
    """Overwrite a table and return the rows written.

    The count is observed during the write, so nothing is scanned again.  With
    ``on_schema_change='fail'`` an existing table of another schema is left untouched.
    """
    spark = df.sparkSession
    name = qualified(layer, table)
    check_schema(df, name, on_schema_change)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(file_format)
    if file_format == "delta":
        writer = writer.option("overwriteSchema", "true").option("delta.columnMapping.mode", "name")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return seen.get["rows"]


# -- publication in two phases ---------------------------------------------------------------


def versions(spark: SparkSession, layer: str) -> list[str]:
    """Schemas of the layer's versions, oldest first."""
    found = (d.name for d in spark.catalog.listDatabases(f"{layer}__*"))
    return sorted(name for name in found if name.removeprefix(f"{layer}__").isdigit())


def _entries(spark: SparkSession, schema: str) -> dict[str, tuple[str, int]] | None:
    """Table name to (schema, rows) by a manifest; None without one."""
    if not spark.catalog.tableExists(qualified(schema, MANIFEST)):
        return None
    rows = table_scan(spark, schema, MANIFEST).collect()  # one row per table of the layer
    return {row["table_name"]: (row["schema_name"], row["rows"]) for row in rows}


def manifest(spark: SparkSession, layer: str) -> DataFrame:
    """Tables of the published layer, the version each was written in, and its rows."""
    if not spark.catalog.tableExists(qualified(layer, MANIFEST)):
        return spark.createDataFrame([], _MANIFEST_SCHEMA)
    return table_scan(spark, layer, MANIFEST)


def snapshot(spark: SparkSession, layer: str) -> dict[str, DataFrame]:
    """All tables of the layer as of its manifest: of one load, also while another publishes."""
    return {name: table_scan(spark, schema, name) for name, (schema, _) in (_entries(spark, layer) or {}).items()}


class Publication:
    """A version of a layer that is being written; see :func:`publication`."""

    def __init__(self, spark: SparkSession, layer: str, schema: str, current: dict[str, tuple[str, int]]):
        self.spark, self.layer, self.schema, self.current = spark, layer, schema, current
        self.entries: dict[str, tuple[str, int]] = {}
        self.kept: set[str] = set()

    def write(self, df: DataFrame, name: str, on_schema_change: str = "replace", **options) -> int:
        """Write a table of the new version; ``fail`` compares with the published table."""
        check_schema(df, qualified(self.layer, name), on_schema_change)
        rows = write_table(df, self.schema, name, **options)
        self.entries[name] = (self.schema, rows)
        return rows

    def keep(self, name: str) -> None:
        """Take the published table over as it is, where there is one."""
        self.kept.add(name)
        if name in self.current:
            self.entries[name] = self.current[name]

    def scan(self, name: str) -> DataFrame:
        return table_scan(self.spark, self.entries[name][0], name)


def _point(spark: SparkSession, layer: str, name: str, schema: str) -> None:
    if _objects(spark, layer).get(name) is False:
        spark.sql(f"DROP TABLE {qualified(layer, name)}")  # a table from before versions
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(layer, name)} AS SELECT * FROM {qualified(schema, name)}")


def _switch(spark: SparkSession, layer: str, schema: str) -> None:
    """Point the layer's views to a complete version, the manifest last, and retire old ones."""
    before, entries = _entries(spark, layer) or {}, _entries(spark, schema)
    for name, (written_in, _) in sorted(entries.items()):
        _point(spark, layer, name, written_in)
    for name in before.keys() - entries.keys():
        spark.sql(f"DROP VIEW IF EXISTS {qualified(layer, name)}")
    _point(spark, layer, MANIFEST, schema)
    in_use = {written_in for written_in, _ in [*before.values(), *entries.values()]} | {schema}
    for version in versions(spark, layer):
        if version not in in_use:
            spark.sql(f"DROP SCHEMA IF EXISTS {version} CASCADE")


def recover(spark: SparkSession, layer: str) -> str | None:
    """Finish or undo what a load that died has left; the version that was finished, if any.

    A version with a manifest is complete, so its views are pointed over; one without is
    dropped.  One load at a time may run on a layer.
    """
    published = set((_entries(spark, layer) or {}).keys())
    current = {schema for schema, _ in (_entries(spark, layer) or {}).values()}
    newest = max(current, default="")
    finished = None
    for version in versions(spark, layer):
        if not spark.catalog.tableExists(qualified(version, MANIFEST)):
            if version not in current:
                spark.sql(f"DROP SCHEMA IF EXISTS {version} CASCADE")
        elif version > newest or not published:
            _switch(spark, layer, version)
            finished = version
    return finished


@contextmanager
def publication(spark: SparkSession, layer: str, whole: bool = False) -> Iterator[Publication]:
    """Write tables of a layer and publish all of them together, or none.

    Tables that the block does not write stay published, unless it replaces the ``whole``
    layer; then they go.
    """
    ensure_schema(spark, layer)
    recover(spark, layer)
    known = versions(spark, layer)
    number = int(known[-1].removeprefix(f"{layer}__")) + 1 if known else 1
    schema = f"{layer}__{number:06d}"
    ensure_schema(spark, schema, f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}__{number:06d}")
    new = Publication(spark, layer, schema, _entries(spark, layer) or {})
    try:
        yield new
        if not whole:
            for name in new.current.keys() - new.entries.keys():
                new.keep(name)
        rows = [(name, *entry) for name, entry in sorted(new.entries.items())]
        write_table(spark.createDataFrame(rows, _MANIFEST_SCHEMA), schema, MANIFEST)
    except BaseException:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
        raise
    _switch(spark, layer, schema)
    if whole:  # tables from before versions
        for name, view in _objects(spark, layer).items():
            if not view and name not in new.kept:
                spark.sql(f"DROP TABLE IF EXISTS {qualified(layer, name)}")


def layer_summary(spark: SparkSession, layer: str, tables: Sequence[str] | None = None) -> DataFrame:
    """Rows and distinct source years per table, and the grand total, in one job."""
    years = "source_year"

    def counts(name: str) -> DataFrame:
        df = table_scan(spark, layer, name)
        year = F.count_distinct(years) if years in df.columns else F.lit(None)
        return df.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"), year.cast("long").alias("years")
        )

    names = layer_tables(spark, layer) if tables is None else list(tables)
    if not names:
        return spark.createDataFrame([], "table_name string, rows long, years long")
    per_table = reduce(lambda a, b: a.unionByName(b), [counts(name) for name in names])
    total = per_table.agg(F.lit("(all)").alias("table_name"), F.sum("rows").alias("rows"))
    return per_table.unionByName(total, allowMissingColumns=True).orderBy("table_name")


def read_back(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """Row and column count of a written table.

    A published table is not read again: its rows were counted as they were written.
    """
    df = table_scan(spark, layer, table)
    known = (_entries(spark, layer) or {}).get(table)
    if known is not None:
        row = (f"{layer}.{table}", known[1], len(df.columns))
        return spark.createDataFrame([row], "table_name string, rows long, columns int")
    return df.agg(
        F.lit(f"{layer}.{table}").alias("table_name"),
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
    )
