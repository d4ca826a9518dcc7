"""Report files: discovery, classification, raw reading."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.report_types import base_pattern, classify_report_type
from rollcall.operators.shape import union_with_drift

# Layout of the upload folder.
DICTIONARY_FOLDER = "data_dictionary"
EXPORT_FOLDER = "Exports"
CSV_GLOB = "*.csv"

# Distinct headers whose names are read at a time.
HEADER_READERS = 16
# For the job that reads first lines: a split of this size is a whole file, and a task
# opens one file because each is charged as much again.  Few lines go to Python at a time.
_WHOLE_FILE = 1 << 40
_ONE_FILE_PER_TASK = {
    "spark.sql.files.maxPartitionBytes": str(_WHOLE_FILE),
    "spark.sql.files.openCostInBytes": str(_WHOLE_FILE),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
}


def _decoded(path: Column) -> Column:
    """File paths in Spark metadata are URL-encoded; ``+`` is a plain character there."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _year_and_name(relative: Column) -> tuple[Column, Column, Column]:
    """(year folder, file name, is a report) from a path below the root."""
    parts = F.split(relative, "/")
    depth = F.size(parts)
    name = F.element_at(parts, -1)
    folder = F.when(depth == 2, F.lit("")).when(
        (depth == 3) & (F.get(parts, F.lit(1)) == EXPORT_FOLDER), F.lit("")
    )
    year = F.get(parts, F.lit(0))
    return year, name, folder.isNotNull() & (year != DICTIONARY_FOLDER)


def _below(path: Column, root: str) -> Column:
    """The part of ``path`` after the root folder, whatever scheme it is written with."""
    folder = root.split(":", 1)[-1].strip("/")
    return F.substring_index(path, f"/{folder}/", -1)


def file_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Report files as (path, file_name, source_year).

    Files lie in ``<root>/<year>/`` or ``<root>/<year>/Exports/`` and end in ``.csv``
    (case matters); the data dictionary is separate.  Only the listing is read: the
    content column of the file source is pruned.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_GLOB)
        .load(root)
        .select("path")
    )
    year, name, wanted = _year_and_name(_below(F.col("path"), root))
    return listed.filter(wanted).select("path", name.alias("file_name"), year.alias("source_year"))


def file_pattern_profile(files: DataFrame) -> DataFrame:
    """Files and year span per base pattern, in pattern order."""
    return (
        files.groupBy(base_pattern(F.col("file_name")).alias("pattern"))
        .agg(
            F.count("*").alias("files"),
            F.min("source_year").alias("first_year"),
            F.max("source_year").alias("last_year"),
        )
        .orderBy("pattern")
    )


def with_report_type(files: DataFrame) -> DataFrame:
    return files.withColumn("report_type", classify_report_type(F.col("file_name")))


def group_files_by_type(files: DataFrame) -> DataFrame:
    """Files and year span per report type, in type order."""
    return (
        with_report_type(files)
        .groupBy("report_type")
        .agg(
            F.count("*").alias("files"),
            F.min("source_year").alias("first_year"),
            F.max("source_year").alias("last_year"),
        )
        .orderBy("report_type")
    )


def paths_by_type(files: DataFrame) -> dict[str, list[str]]:
    """Report type to sorted paths.  File names are all the driver holds."""
    found = defaultdict(list)
    for row in with_report_type(files).select("report_type", "path").toLocalIterator():
        found[row["report_type"]].append(row["path"])
    return {kind: sorted(paths) for kind, paths in sorted(found.items())}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _first_lines(batches: Iterator[pa.RecordBatch], alone: bool) -> Iterator[pa.RecordBatch]:
    """The first line of each file that is not blank; ``alone``: a task has one file."""
    seen = set()
    for batch in batches:
        found = {}
        for path, line in zip(batch["path"].to_pylist(), batch["line"].to_pylist(), strict=True):
            if path not in seen and line.strip():
                seen.add(path)
                found[path] = line
        if found:
            yield pa.RecordBatch.from_pydict({"path": list(found), "header": list(found.values())})
            if alone:
                return  # the rest of the file stays unread


@contextmanager
def _headers(spark: SparkSession, folder: str | None = None, paths: Sequence[str] = ()) -> Iterator[DataFrame]:
    """(path, header line) of all files below a folder, or of given files.

    One job whatever the number of files; to be run within the block, where its splits are
    whole files.  A task reads the start of its file only.
    """
    reader = spark.read
    if folder is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_GLOB)
    lines = reader.text(folder if folder is not None else list(paths))
    lines = lines.select(_decoded(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line"))
    with _settings(spark, _ONE_FILE_PER_TASK):
        alone = spark.conf.get("spark.sql.files.openCostInBytes") == str(_WHOLE_FILE)
        yield lines.mapInArrow(partial(_first_lines, alone=alone), "path string, header string")


def _with_names(spark: SparkSession, groups: Sequence[Sequence[str]]) -> list[tuple[list[str], list[str]]]:
    """Column names of groups of files with one header line each, by Spark's own rules."""

    def names(paths: Sequence[str]) -> list[str]:
        return spark.read.option("header", True).csv(paths[0]).columns

    with ThreadPoolExecutor(HEADER_READERS) as readers:
        return [(found, list(paths)) for found, paths in zip(readers.map(names, groups), groups, strict=True)]


def header_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """Group files with the same header: [(column names, paths)].

    One read over files with different headers would assign columns by position, so
    every distinct header gets a scan of its own.  All first lines are read in one job, and
    one small job more gives the names of each distinct header.  Files without a line are in
    no group.
    """
    if not paths:
        return []
    with _headers(spark, paths=paths) as headers:
        grouped = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return _with_names(spark, sorted(row["paths"] for row in grouped))


def report_layout(spark: SparkSession, root: str) -> dict[str, list[tuple[list[str], list[str]]]]:
    """Report type to its groups of (column names, paths), for all reports below ``root``.

    Listing, classes and headers come from one job.  What reaches the driver are file names,
    grouped by type and header.
    """
    year, name, wanted = _year_and_name(_below(F.col("path"), root))
    with _headers(spark, folder=root) as headers:
        reports = headers.filter(wanted).select("path", "header", name.alias("file_name"))
        grouped = (
            with_report_type(reports)
            .groupBy("report_type", "header")
            .agg(F.sort_array(F.collect_list("path")).alias("paths"))
            .collect()
        )
    rows = sorted((row["report_type"], row["paths"]) for row in grouped)
    layout = defaultdict(list)
    for (kind, _), group in zip(rows, _with_names(spark, [paths for _, paths in rows]), strict=True):
        layout[kind].append(group)
    return dict(layout)


def with_lineage(df: DataFrame, root: str) -> DataFrame:
    """Add ``source_year`` (folder) and ``source_file`` (name) from the file metadata."""
    year, name, _ = _year_and_name(_below(_decoded(F.col("_metadata.file_path")), root))
    return df.select("*", year.alias("source_year"), name.alias("source_file"))


def read_groups(spark: SparkSession, groups: Iterable[tuple[list[str], list[str]]], root: str) -> DataFrame:
    """Files grouped by header as one table of strings, with lineage columns.

    Columns that a file lacks are NULL there.
    """
    frames = []
    for names, members in groups:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        scan = spark.read.schema(schema).option("header", True).csv(members)
        frames.append(with_lineage(scan, root))
    return union_with_drift(frames)


def read_raw_csv(spark: SparkSession, paths: Sequence[str], root: str) -> DataFrame:
    """All files of one report type as strings, with lineage columns.

    Columns that a year lacks are NULL there.  Empty files (no header) add nothing.
    """
    groups = header_groups(spark, paths)
    if not groups:
        raise ValueError(f"no header in any of {len(paths)} files")
    return read_groups(spark, groups, root)


def dictionary_files(spark: SparkSession, root: str) -> list[str]:
    """Files of the data dictionary."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_GLOB)
        .load(root)
        .select("path")
    )
    inside = F.split(_below(F.col("path"), root), "/")
    own = listed.filter((F.size(inside) == 2) & (F.get(inside, F.lit(0)) == DICTIONARY_FOLDER))
    return sorted(row["path"] for row in own.toLocalIterator())


def read_with_inference(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """CSV with header and inferred types, for the data dictionary."""
    return spark.read.option("header", True).option("inferSchema", True).csv(paths)
