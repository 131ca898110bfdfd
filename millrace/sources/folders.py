"""Tables between two steps: written to the folder that driver and executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a broadcast side may have at most; they are counted.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, a local master (as in tests) gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = getattr(spark, "_millrace_folder", None)
        if base is None:
            base = spark._millrace_folder = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own: it is computed once, and a lost executor costs no lineage before it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a stored table) marked for a broadcast if it has at most ``limit`` rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
