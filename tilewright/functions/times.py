"""Instants, ISO texts, dates in file names and search intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts that granule attributes are written in.
INSTANT_FORMATS = (
    "yyyyMMdd'T'HH:mm:ss",
    "yyyyMMdd'T'HH:mm:ss.SSSSSS",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
)


def parse_instant(text: Column) -> Column:
    """UTC timestamp of an attribute text, null when it is no date.

    A pattern that does not fit costs an exception inside, so compact layouts are tried only on
    texts that begin with eight digits.
    """
    compact = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in INSTANT_FORMATS])
    return F.when(text.rlike("^[0-9]{8}"), compact).otherwise(text.try_cast("timestamp"))


def iso_utc(instant: Column) -> Column:
    """``2017-02-21T20:47:10Z``; six fraction digits only when there is a fraction."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(instant, ".SSSSSS")
    return F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""), F.lit("Z"))


def updated_or_created(updated: Column, created: Column) -> Column:
    """The update instant when it parses, else the creation instant."""
    return F.coalesce(parse_instant(updated), parse_instant(created))


def name_dates(name: Column) -> Column:
    """Every run of eight digits in a file name, in order."""
    return F.regexp_extract_all(name, F.lit(r"([0-9]{8})"), F.lit(1))


def mid_date(name: Column) -> Column:
    """Day half way between the acquisition dates of the two scenes.

    A scene name carries two dates, so the second scene's own date is the third
    in the file name. Names with fewer give null.
    """
    dates = name_dates(name)
    start = F.try_to_date(F.try_element_at(dates, F.lit(1)), "yyyyMMdd")
    end = F.try_to_date(F.try_element_at(dates, F.lit(3)), "yyyyMMdd")
    return F.date_from_unix_date(F.floor((F.unix_date(start) + F.unix_date(end)) / 2).cast("int"))


def year_of_name(name: Column) -> Column:
    """Four-digit partition year by the file name."""
    return F.date_format(mid_date(name), "yyyy")


def year_of_text(mid_datetime: Column) -> Column:
    """Four-digit partition year by the item's own mid date text."""
    return F.substring(mid_datetime, 1, 4)


def years_in(interval: Column) -> Column:
    """Years an interval text touches, as texts: one instant or ``start/end``.

    An end left open counts as the year of the other end, so an interval open at one side has one
    year; without any year, or with the ends in the wrong order, there is none.
    """
    first = F.substring(F.trim(F.substring_index(interval, "/", 1)), 1, 4).try_cast("int")
    last = F.substring(F.trim(F.substring_index(interval, "/", -1)), 1, 4).try_cast("int")
    first, last = F.coalesce(first, last), F.coalesce(last, first)
    none = F.array().cast("array<int>")
    span = F.when(first <= last, F.sequence(first, last)).otherwise(none)
    return F.transform(span, lambda y: F.lpad(y.cast("string"), 4, "0"))


def _open_end(text: Column) -> Column:
    return F.when(F.trim(text).isin("", ".."), F.lit(None)).otherwise(F.trim(text))


def interval_start(interval: Column) -> Column:
    """Lower instant of ``a/b``, ``a/``, ``/b``, ``../b`` or a single instant."""
    return F.try_to_timestamp(_open_end(F.substring_index(interval, "/", 1)))


def interval_end(interval: Column) -> Column:
    """Upper instant of the same texts; inclusive."""
    return F.try_to_timestamp(_open_end(F.substring_index(interval, "/", -1)))


def split_interval(text: str | None) -> tuple[str | None, str | None]:
    """Driver-side counterpart of the two functions above, for a search argument."""
    if text is None or text == "all":
        return None, None
    ends = text.split("/")
    if len(ends) > 2:
        raise ValueError(f"not a datetime or interval: {text!r}")
    ends = [None if e.strip() in ("", "..") else e.strip() for e in ends]
    return (ends[0], ends[0]) if len(ends) == 1 else (ends[0], ends[1])
