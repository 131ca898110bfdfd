"""Scalar functions and driver-side helpers."""

from __future__ import annotations

import os
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..schema import ERROR_BYTES

#: Crockford's base 32, as ULIDs use it.
_DIGITS = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
CUT_MARK = "…[truncated]"


def ulid(at_ms: int | None = None, entropy: bytes | None = None) -> str:
    """26 characters: 48 bits of milliseconds, 80 random bits; ids sort by time."""
    ms = int(time.time() * 1000) if at_ms is None else at_ms
    if not 0 <= ms < 1 << 48:
        raise InvalidArgument("a ULID's time has 48 bits")
    n = ms << 80 | int.from_bytes(os.urandom(10) if entropy is None else entropy, "big")
    return "".join(_DIGITS[n >> shift & 31] for shift in range(125, -1, -5))


def new_ulid(now: Column) -> Column:
    """A ULID for each row, made by the executors: the time of ``now`` and random digits."""
    ms = (F.unix_micros(F.to_utc_timestamp(now.cast("timestamp"), F.current_timezone())) / 1000).cast("long")
    digit = lambda n: F.substring(F.lit(_DIGITS), (n + 1).cast("int"), F.lit(1))
    head = [digit(F.floor(ms / (32**k)) % 32) for k in range(9, -1, -1)]
    return F.concat(*head, *[digit(F.floor(F.rand() * 32)) for _ in range(16)])


def clamp_i32(n: int) -> int:
    return max(-(1 << 31), min((1 << 31) - 1, n))


def i32_from_u32(n: int) -> int:
    if not 0 <= n < 1 << 31:
        raise InvalidArgument(f"{n} doesn't fit a 32-bit whole number")
    return n


def cap_text(text: str, limit: int = ERROR_BYTES) -> str:
    """``text`` in at most ``limit`` bytes of UTF-8, cut between characters and marked."""
    raw = text.encode()
    if len(raw) <= limit:
        return text
    return raw[: limit - len(CUT_MARK.encode())].decode(errors="ignore") + CUT_MARK


def cap_text_column(text: Column, limit: int = ERROR_BYTES) -> Column:
    """``cap_text`` as a column: of the bytes that fit, those of a character that is cut go."""
    room = limit - len(CUT_MARK.encode())
    raw = F.encode(text, "UTF-8")
    # a prefix that ends within a character isn't valid; one to three bytes fewer are
    part = [F.substring(raw, 1, room - k) for k in range(4)]
    whole = F.coalesce(*[F.try_validate_utf8(p.cast("string")) for p in part])
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.concat(whole, F.lit(CUT_MARK)))


def next_status(ok: Column, attempt: Column, most: Column) -> Column:
    """Done for a success; for a failure Failed while attempts are left, else Killed."""
    return F.when(ok, "Done").when(most > attempt, "Failed").otherwise("Killed")


def result_json(ok: Column, value: Column) -> Column:
    """{"Ok": value} or {"Err": "text"}; ``value`` is JSON for a success, text for a failure."""
    good = F.concat(F.lit('{"Ok":'), F.coalesce(value, F.lit("null")), F.lit("}"))
    return F.when(ok, good).otherwise(F.to_json(F.struct(cap_text_column(F.coalesce(value, F.lit(""))).alias("Err"))))


def timestamp_of(seconds: Column) -> Column:
    """The timestamp, without zone, that lies so many seconds (a double) after 1970, to the microsecond."""
    whole = F.round(seconds * F.lit(1e6)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=whole.cast("decimal(18,6)"))


def epoch_seconds(at: Column) -> Column:
    """Seconds since 1970 as a whole number; null and earlier times are 0."""
    s = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)
    return F.greatest(F.coalesce(s, F.lit(0)), F.lit(0)).cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def ratio(part: Column, whole: Column, digits: int = 2, times: float = 100.0) -> Column:
    """times * part / whole, rounded half away from zero; null where whole is 0."""
    return F.round(F.lit(times) * part / F.nullif(whole, F.lit(0)), digits)
