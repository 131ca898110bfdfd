"""Readers of the tables, rows from parallel arrays, and codecs for the opaque payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DecodeError
from ..schema import JOBS, WORKERS


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The jobs table in the Parquet files at ``path``; no schema is guessed."""
    return spark.read.schema(JOBS).parquet(path)


def read_workers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WORKERS).parquet(path)


def write_jobs(jobs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes jobs for pruning: a folder for each queue, rows sorted by status and run_at, so that statistics help.

    Rows are dealt by queue and a hash of the id; a queue of any size spreads over the writers.
    """
    spread = jobs.repartition("job_type", F.pmod(F.xxhash64("id"), F.lit(64)))
    spread.sortWithinPartitions("job_type", "status", "run_at", "id").write.mode(mode).partitionBy("job_type").parquet(path)


def from_arrays(spark: SparkSession, **arrays: Sequence) -> DataFrame:
    """Rows from parallel arrays of one length, a column each."""
    if len({len(a) for a in arrays.values()}) > 1:
        raise ValueError("arrays of one length are needed")
    kinds = {f.name: f.dataType for f in JOBS}
    schema = T.StructType([T.StructField(k, kinds.get(k, T.StringType())) for k in arrays])
    return spark.createDataFrame(list(zip(*arrays.values(), strict=True)), schema)


def zipped(df: DataFrame, *arrays: str) -> DataFrame:
    """Rows from parallel array columns, position by position (two explodes would multiply)."""
    return df.select(F.inline(F.arrays_zip(*arrays)))


class JsonCodec:
    """Payloads as JSON of one schema."""

    def __init__(self, schema: T.StructType | str):
        self.schema = schema

    def decode(self, jobs: DataFrame) -> DataFrame:
        """``jobs`` with the column args; a payload that doesn't fit gives null fields."""
        return jobs.withColumn("args", F.from_json(F.col("job").cast("string"), self.schema, {"mode": "PERMISSIVE"}))

    def decode_all(self, jobs: DataFrame) -> DataFrame:
        """``decode``; raises DecodeError if any payload isn't JSON."""
        broken = jobs.where(F.try_parse_json(F.col("job").cast("string")).isNull())
        if not broken.isEmpty():
            raise DecodeError("a payload isn't JSON")
        return self.decode(jobs)

    def encode(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with the column job made of the given columns."""
        return df.withColumn("job", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
