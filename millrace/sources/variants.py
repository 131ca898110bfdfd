"""Payloads and results as VARIANT: parsed by the JVM, read by path, without a schema and without Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DecodeError


def parsed(jobs: DataFrame) -> DataFrame:
    """``jobs`` with the variants args (of the payload), meta (of the metadata) and outcome (of the result); what isn't JSON is null."""
    return jobs.withColumns({new: F.try_parse_json(F.col(old).cast("string")) for new, old in (("args", "job"), ("meta", "metadata"), ("outcome", "last_result")) if old in jobs.columns})


def field(value: Column | str, path: str, kind: str = "string") -> Column:
    """What stands at a path of a variant ("$.a.b[0]"), as a type; null if it isn't there or doesn't fit."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)


def outcomes(jobs: DataFrame, kind: str = "string") -> DataFrame:
    """id, status, ok (the result's value as ``kind``), err (the error's text) of the jobs that have a result."""
    rows = parsed(jobs.where("last_result is not null").select("id", "status", "last_result"))
    return rows.select("id", "status", field("outcome", "$.Ok", kind).alias("ok"), field("outcome", "$.Err").alias("err"))


def check(jobs: DataFrame) -> None:
    """Raises DecodeError if any payload isn't JSON."""
    if not parsed(jobs.select("job")).where("job is not null and args is null").isEmpty():
        raise DecodeError("a payload isn't JSON")
