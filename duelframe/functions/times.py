"""Timestamp parsing and tokens. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import as_col, has_text, parse_number

MICROS_PER_HOUR = 3_600_000_000


def parse_utc(c) -> Column:
    """ISO text with ``Z`` or an offset -> timestamp; bad text -> null."""
    text = F.trim(as_col(c).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    return iso


def parse_utc_or_epoch(c) -> Column:
    """As :func:`parse_utc`, also epoch seconds written as a number."""
    seconds = parse_number(c)
    # Outside years 0001-9999 a number of seconds is no timestamp.
    in_range = seconds.between(-62135596800.0, 253402300799.0)
    return F.coalesce(parse_utc(c), F.when(in_range, F.timestamp_micros(
        F.rint(seconds * 1_000_000).cast("long"))))


def parse_kickoff(stamp, day, clock, tz: str = "America/New_York", default_clock: str | None = "00:00") -> Column:
    """UTC stamp when present, else local day and clock in ``tz`` moved to UTC.

    ``default_clock=None`` gives null for a day without a clock.
    """
    shown = F.when(has_text(clock), F.trim(as_col(clock)))
    if default_clock is not None:
        shown = F.coalesce(shown, F.lit(default_clock))
    text = F.when(has_text(day) & shown.isNotNull(), F.concat_ws(" ", F.trim(as_col(day)), F.upper(shown)))
    local = F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("yyyy-MM-dd h:mm a")))
    return F.coalesce(parse_utc(stamp), F.to_utc_timestamp(local, tz))


def kickoff_token(c) -> Column:
    return F.date_format(as_col(c), "yyyyMMdd_HHmm")


def minute_token(c) -> Column:
    return F.date_format(F.date_trunc("minute", as_col(c)), "yyyy-MM-dd'T'HH:mm")


def date_token(c) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd")


def local_display(c, tz: str = "America/Los_Angeles") -> Column:
    return F.date_format(F.from_utc_timestamp(as_col(c), tz), "EEE MM/dd h:mm a")


def tuesday_start(c) -> Column:
    """Start of the seven-day window that begins on Tuesday 00:00 UTC."""
    day = F.to_date(as_col(c))
    # weekday(): Monday is 0, so Tuesday is 1.
    return F.date_sub(day, F.pmod(F.weekday(day) - 1, F.lit(7)).cast("int")).cast("timestamp")


def seconds_between(a, b) -> Column:
    return F.abs(F.unix_micros(as_col(a)) - F.unix_micros(as_col(b))) / F.lit(1_000_000.0)
