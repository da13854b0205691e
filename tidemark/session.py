"""Session helpers: one place that builds a SparkSession for tests/bench and
resolves the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidemark") -> SparkSession:
    """Return the active session, or build a local one with sane defaults.

    On a cluster the caller's session (and its configuration) wins: this only
    builds a session when none is active.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and Spark runs locally
    (tests) a scratch folder is created and registered. On a cluster an unset
    folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # plain local mode only: its one process sees its own temporary folder
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: a machine-local "
                "folder is not visible to the executors")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def _ddl_width(ddl: str) -> int:
    """Number of top-level fields in a DDL schema string."""
    depth, width = 0, 1
    for ch in ddl:
        depth += ch in "(<"
        depth -= ch in ")>"
        width += ch == "," and depth == 0
    return width


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small driver-side table (rule metadata, verdicts) as a DataFrame.

    Built from pandas, so with Arrow enabled it becomes a local relation that
    the plan reads on the driver, without a job of its own.
    """
    import pandas as pd  # here, as executors' workers load this module too

    width = len(schema.fields) if isinstance(schema, T.StructType) else _ddl_width(schema)
    pdf = pd.DataFrame.from_records(rows, columns=[f"_{i}" for i in range(width)])
    pdf = pdf.astype(object).where(pdf.notna(), None)
    return spark.createDataFrame(pdf, schema)  # columns match the schema by position
