"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on.  Dimension joins carry no broadcast hint:
# Catalyst broadcasts a side only when its measured size is below the threshold, and
# the sort-merge path splits a hot key through AQE.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    # The JIT skips methods above 8000 bytes of bytecode, so one fused method over an
    # 85-column feed runs interpreted; at this limit Spark splits the work by column.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Wide projections stay out of fused methods, so that the joins and filters below them are still fused.
    "spark.sql.codegen.maxFields": "40",
    # A packed file of 128 MB may hold millions of rows, more than one task can sort as wide text.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Results go on as written tables, so what a finished statement shuffled is not read again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`ENGINE_CONF` to a running session."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "rollcall", cores: str = "8", **extra: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
    )
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would be
    lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="rollcall-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives executor loss and, unlike
    ``checkpoint()``, gives Catalyst the real size of the result, so that later joins
    broadcast it only when it is small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/rollcall/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
