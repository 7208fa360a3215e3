"""Session settings the library relies on, and where it may write scratch data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The settings a session needs for the semantics and the skew handling.
# ANSI makes bad casts fail; AQE sizes joins and shuffles at run time and splits skewed join
# partitions, even where the split costs one more shuffle.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording the Python line of every expression costs more than building the expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names in `spark.checkpoint.dir`.

    A machine-local folder is used only in local mode, where one machine is all there is.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """A frame written to the shared folder and read back, for results that are read many times.

    Later steps scan the written columns instead of recomputing, and a lost executor costs
    nothing but the scan.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
