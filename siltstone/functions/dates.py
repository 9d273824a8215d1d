"""Dates as forums write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAY = r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)\s+"
#: Fixed value: the exact form of a post's date.
POSTED = r"^[A-Z][a-z]{2} [A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d{2} (?:am|pm)$"


def forum_date(text: Column) -> Column:
    """'Thu Apr 19, 2012 2:19 pm' as a timestamp without zone; null for anything else. The weekday must be one, but isn't checked."""
    trimmed = F.trim(text)
    rest = F.regexp_replace(trimmed, WEEKDAY, "")
    return F.when(trimmed.rlike(WEEKDAY), F.try_to_timestamp(F.initcap(rest), F.lit("MMM d, yyyy h:mm a")).cast("timestamp_ntz"))


def well_formed(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(POSTED)


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def log_stamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
