"""Time expressions.  The session time zone is expected to be UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole date and a whole time, T or a blank between them; fraction and zone may follow.
EVENT_TIME_SHAPES = ("____-__-__T__:__:__%", "____-__-__ __:__:__%")
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_event_time(text: str | Column) -> Column:
    """Event text to timestamp; null where the text is no full date and time.

    A cast alone would also take ``2026`` or ``T18:30``; with a format instead,
    parsing costs several times as much.
    """
    text = F.col(text) if isinstance(text, str) else text
    t_form, blank_form = EVENT_TIME_SHAPES
    return F.when(text.like(t_form) | text.like(blank_form), text.try_cast("timestamp"))


def iso_utc(t: str | Column) -> Column:
    return F.date_format(t, ISO_UTC_FORMAT)


def weekday_name(t: str | Column) -> Column:
    return F.date_format(t, "EEEE")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``; null beyond the range of an int."""
    return (F.unix_seconds(end) - F.unix_seconds(start)).try_cast("int")


def instant(as_of: str | dt.datetime | Column | None) -> Column:
    """The reference instant of a "last n days" report; now, unless given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def days_before(as_of, days: int) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def indian_datetime(t: str | Column) -> Column:
    """``12/9/2026, 6:30:10 pm``"""
    return F.lower(F.date_format(t, "d/M/yyyy, h:mm:ss a"))
