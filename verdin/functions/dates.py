"""Calendar functions. Every function that needs "today" takes it as a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SPREADSHEET_EPOCH = dt.date(1899, 12, 30)  # day 0 of spreadsheet date serials


def date_parts(when: Column) -> dict[str, Column]:
    """Year, month, ISO week and weekday (Monday is 0)."""
    return {
        "year": F.year(when),
        "month": F.month(when),
        "week": F.weekofyear(when),
        "weekday": F.weekday(when),
    }


def week_label(when: Column) -> Column:
    """``2024-05``: year and the number of the Monday-based week; days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(when) + 6 - F.weekday(when)) / 7)
    return F.concat(F.lpad(F.year(when).cast("string"), 4, "0"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def from_serial(serial: Column) -> Column:
    """Timestamp of a spreadsheet date serial; the fraction is the time of day."""
    days = F.floor(serial)
    seconds = F.round((serial - days) * 86400).cast("int")
    start = F.date_add(F.lit(SPREADSHEET_EPOCH), days.cast("int")).cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def parse_moment(text: Column, pattern: str | None = None) -> Column:
    """Timestamp without zone from text; null when it cannot be read."""
    parsed = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def age_in_years(birth: Column, as_of: Column) -> Column:
    """Whole years between two dates; the birthday itself counts."""
    before = F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(as_of) - F.year(birth) - F.when(before, 1).otherwise(0)


def days_since(day: Column, as_of: Column) -> Column:
    return F.date_diff(as_of, day)


def format_date(day: Column, default: dt.date) -> Column:
    """``yyyy-MM-dd``, with a default for null."""
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(default.isoformat()))


def folder_date(day: Column) -> Column:
    """``M_D_YYYY`` without leading zeros, as used in folder names."""
    return F.concat_ws("_", F.month(day), F.dayofmonth(day), F.year(day))


def parse_folder_date(text: Column) -> Column:
    parts = F.split(text, "_")
    padded = F.concat_ws("-", parts[2], F.lpad(parts[0], 2, "0"), F.lpad(parts[1], 2, "0"))
    return F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")).cast("date")


def clock_time(text: Column) -> Column:
    """``HH:MM:SS`` from a clock text, a day fraction (0 <= x < 2) or ``H:MM``; empty when unreadable.

    A decimal comma is read as a point. A leading ``H:MM:SS`` is kept as written.
    """
    tidy = F.replace(F.trim(text), F.lit(","), F.lit("."))
    leading = F.regexp_extract(tidy, r"^(\d{1,2}:\d{2}:\d{2})", 1)
    number = tidy.try_cast("double")
    seconds = F.bround((number % 1) * 86400).cast("bigint") % 86400
    pieces = [F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60]
    from_fraction = F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in pieces])
    short = F.regexp_extract(tidy, r"^(\d{1,2}:\d{2})$", 1)
    hour, minute = F.split_part(short, F.lit(":"), F.lit(1)), F.split_part(short, F.lit(":"), F.lit(2))
    valid_short = (short != "") & (hour.try_cast("int") < 24) & (minute.try_cast("int") < 60)
    full = F.try_to_timestamp(tidy)
    return (
        F.when(tidy.isNull(), F.lit(""))
        .when(leading != "", leading)
        .when((number >= 0) & (number < 2), from_fraction)
        .when(valid_short, F.concat(F.lpad(hour, 2, "0"), F.lit(":"), minute, F.lit(":00")))
        .when(number.isNull() & full.isNotNull(), F.date_format(full, "HH:mm:ss"))
        .otherwise(F.lit(""))
    )


def time7(clock: Column) -> Column:
    """Clock text with seven decimals; empty stays empty."""
    return F.when(clock != "", F.concat(clock, F.lit(".0000000"))).otherwise(F.lit(""))
