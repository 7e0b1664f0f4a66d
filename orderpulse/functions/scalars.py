"""Scalar Column functions (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DISPLAY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def money(x: Column, precision: int, scale: int = 2) -> Column:
    """Round half-up to ``scale`` digits, typed decimal(precision, scale)."""
    return F.round(x.cast(f"decimal(38,{scale + 6})"), scale).cast(f"decimal({precision},{scale})")


def clamp(x: Column, low: Column, high: Column) -> Column:
    """``max(low, min(high, x))``; a null ``x`` stays null (greatest/least skip nulls)."""
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def instant_to_utc_ntz(instant: Column) -> Column:
    """A zoned instant as its UTC wall clock (timestamp_ntz), from its microseconds since the epoch:
    the session zone's wall clock (ambiguous when clocks go back) plays no part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.unix_micros(instant)
    # an interval of days and microseconds: whole days and the rest, each within its field's range
    day = 86_400_000_000
    return epoch + F.make_dt_interval(F.floor(micros / day).cast("int"), F.lit(0), F.lit(0),
                                      (F.pmod(micros, F.lit(day)) / 1_000_000).cast("decimal(18,6)"))


def parse_iso_utc(text: Column) -> Column:
    """ISO-8601 text with an offset -> UTC wall clock (timestamp_ntz); null if unparsable
    (``try_to_timestamp``: under ANSI mode ``to_timestamp`` would fail the whole batch)."""
    return instant_to_utc_ntz(F.try_to_timestamp(text))


def iso_utc(ts_ntz: Column) -> Column:
    """UTC wall clock -> ISO-8601 text with an explicit ``+00:00`` offset."""
    return F.concat(F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def to_day(ts: Column) -> Column:
    """Date grain of a timestamp, kept as timestamp_ntz at midnight."""
    return F.to_date(ts).cast("timestamp_ntz")


def truncate_ts(ts: Column, grain: str) -> Column:
    if grain in (None, "", "micros", "event"):
        return ts
    if grain == "day":
        return to_day(ts)
    raise ValueError(f"unknown ts grain {grain!r}")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated toward zero)."""
    return F.timestamp_diff("SECOND", start, end)


def add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def display_ts(ts: Column) -> Column:
    return F.date_format(ts, DISPLAY_FORMAT)


def synthetic_event_id(*cols: Column) -> Column:
    """Deterministic id for a message that carries none: replays get the same id. Every part is written
    with its length (or as null), so different messages never share an encoding."""
    parts = [c.cast("string") for c in cols]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)
