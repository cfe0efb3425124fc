"""Parsing and arithmetic of the date forms that occur on pages and in batches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a naive timestamp; a zone suffix moves it to UTC first."""
    offset = F.regexp_extract(text, _ISO_OFFSET, 1)
    digits = F.regexp_replace(offset, r"\D", "")
    minutes = F.coalesce(F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    ahead = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    naive = F.regexp_replace(text, _ISO_OFFSET, "").try_cast("timestamp_ntz")
    return F.when(text.rlike(_ISO_OFFSET), naive - F.make_dt_interval(mins=ahead)).otherwise(text.try_cast("timestamp_ntz"))


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group)


def parse_dotted(text: Column) -> Column:
    """``2025.02.10 (월) 08:25``, year of two or four digits; null when it is no date."""
    pattern = r"(\d+)\.(\d+)\.(\d+)\D+(\d+):(\d+)"
    year = _part(text, pattern, 1)
    year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    rest = [F.lpad(_part(text, pattern, i), 2, "0") for i in range(2, 6)]
    iso = F.format_string("%s-%s-%s %s:%s:00", F.lpad(year, 4, "0"), *rest)
    # lpad also cuts longer runs; a run longer than its field is not a date
    fits = F.length(year) <= 4
    for i in range(2, 6):
        fits = fits & (F.length(_part(text, pattern, i)) <= 2)
    return F.when(fits & text.rlike(pattern), iso.try_cast("timestamp_ntz"))


def parse_month_day(text: Column, batch_time: Column) -> Column:
    """``yyyy.MM.dd HH:mm:ss``, or ``MM.dd HH:mm:ss`` in the batch's year.

    A yearless date that would lie after the batch belongs to the year before.
    """
    full = F.regexp_replace(text, r"^(\d{4})\.(\d{2})\.(\d{2}) ", "$1-$2-$3 ")
    short = F.regexp_replace(text, r"^(\d{2})\.(\d{2}) ", "-$1-$2 ")
    this_year = F.concat(F.year(batch_time).cast("string"), short).try_cast("timestamp_ntz")
    last_year = F.concat((F.year(batch_time) - 1).cast("string"), short).try_cast("timestamp_ntz")
    yearless = F.coalesce(F.when(this_year <= batch_time, this_year), last_year)
    return (
        F.when(text.rlike(r"^\d{4}\.\d{2}\.\d{2} "), full.try_cast("timestamp_ntz"))
        .when(text.rlike(r"^\d{2}\.\d{2} "), yearless)
    )


def iso_text(time: Column) -> Column:
    """A naive timestamp as ``yyyy-MM-ddTHH:mm:ss``; formatting it would pass through the session's zone."""
    return F.replace(F.substring(time.cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def join_iso(text: Column) -> Column:
    """Date and time separated by whitespace, joined by ``T``."""
    return F.regexp_replace(F.trim(text), r"\s+", "T")


def parse_short_date(text: Column) -> Column:
    """``25. 02. 10`` to ``2025-02-10``."""
    return F.concat(F.lit("20"), F.replace(F.regexp_replace(text, r"\s+", ""), F.lit("."), F.lit("-")))


def first_two_words(text: Column) -> Column:
    """Date and time of a label that may go on with other words."""
    return F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, 2), " ")


def range_class(text: Column, start: Column, end: Column) -> Column:
    """IN, OVER or UNDER the inclusive range; null when the text is no timestamp."""
    time = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), text.try_cast("timestamp_ntz"))
    return F.when(time > end, "OVER").when(time < start, "UNDER").when(time.isNotNull(), "IN")


def batch_number(time: Column, zone: str = "Asia/Seoul") -> Column:
    """Minutes since local midnight of a UTC time."""
    local = to_local(time, zone)
    return F.hour(local) * 60 + F.minute(local)


def to_local(time: Column, zone: str = "Asia/Seoul") -> Column:
    """UTC to local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), time)


def shift(time: Column, **parts: int) -> Column:
    """``time`` plus an interval given as ``hours=``, ``minutes=``, ...."""
    return time + F.make_interval(
        hours=F.lit(parts.get("hours", 0)),
        mins=F.lit(parts.get("minutes", 0)),
        days=F.lit(parts.get("days", 0)),
    )


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, without a detour through the session's time zone."""
    span = end - start
    days = F.extract(F.lit("DAY"), span).cast("bigint")
    hours = F.extract(F.lit("HOUR"), span)
    minutes = F.extract(F.lit("MINUTE"), span)
    micros = (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")
    return ((days * 24 + hours) * 60 + minutes) * 60_000_000 + micros


def elapsed(start: Column, end: Column) -> Column:
    """``HH:MM:SS`` between two times; hours do not wrap at a day."""
    seconds = F.floor(micros_between(start, end) / 1_000_000)
    return F.format_string(
        "%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60
    )


def months_after(date: Column, months: int) -> Column:
    """End of a window of ``months`` months; the day is clamped to the month's end."""
    return F.add_months(date, months)
