"""Days and instants of one civil zone (KST by default), windows and deadlines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Seoul"


def civil_day(instant: Column, zone: str = ZONE) -> Column:
    """The zone's day of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def day_start(day: Column, zone: str = ZONE) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def deadline(day: Column, zone: str = ZONE) -> Column:
    """A day's deadline holds the whole day: midnight after it, in the zone, as a UTC instant."""
    return day_start(F.date_add(day, 1), zone)


def open_on(day: Column, start: Column, end: Column, closed: Column) -> Column:
    """Not closed, and within bounds; a missing bound passes."""
    return ~F.coalesce(closed, F.lit(False)) & (start.isNull() | (start <= day)) & (end.isNull() | (end >= day))


def date_kind(text: Column) -> Column:
    """DAY for a plain date or one at midnight ``Z``, INSTANT for a time with seconds and an offset, INVALID for anything else; null has none.

    Sources write days as midnight UTC, which tells a day and no time; midnight with a numeric offset is an instant.
    """
    day = F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")))
    exact = F.date_format(day, "yyyy-MM-dd") == F.substring(text, 1, 10)
    clock = (F.substring(text, 12, 2) <= "23") & (F.substring(text, 15, 2) <= "59") & (F.substring(text, 18, 2) <= "59")
    is_day = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}(T00:00:00(\.0+)?Z)?\z")
    is_instant = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z")
    ok = F.coalesce(exact, F.lit(False))
    return F.when(text.isNull(), F.lit(None).cast("string")).when(is_day & ok, "DAY").when(is_day, "INVALID").when(is_instant & ok & clock & F.try_to_timestamp(text).isNotNull(), "INSTANT").otherwise("INVALID")


def stated_day(text: Column) -> Column:
    """The day of a :func:`date_kind` DAY."""
    return F.when(date_kind(text) == "DAY", F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))))


def stated_instant(text: Column) -> Column:
    return F.when(date_kind(text) == "INSTANT", F.try_to_timestamp(text))


def in_window(day: Column, as_of: Column, days: int) -> Column:
    """The window of so many days that ends with as_of, both ends included."""
    return (day >= F.date_sub(as_of, days - 1)) & (day <= as_of)
