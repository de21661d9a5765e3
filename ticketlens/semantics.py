"""Patterns, modes and point-in-time handling shared by the operators.

Nothing in this package calls ``current_timestamp()``: every result is a
function of its inputs and of an explicit ``as_of`` moment.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns, matched without regard to case.
COMP_PATTERN = "%comp%"
SPECIAL_PATTERN = "%Special Event%"
PRESENTS_PATTERN = "%Presents%"
STOP_PATTERN = "%STOP%"
IGNORED_TAG_PATTERN = "IGNORE%"

# Status words.
SUBSCRIBED = "Subscribed"
UNSUBSCRIBED = "Unsubscribed"
OPTED_IN = "Yes"
OPTED_OUT = "No"

# Day windows and batch sizes.
RECENCY_WINDOWS = (360, 180, 90)
BOUNDARY_WINDOWS = (360, 90)
ORDERS_PER_BATCH = 5000
ROWS_PER_FILE = 1000

# Fixed value: entry stamp that marks a contact-name backfill.
BACKFILL_ENTRY = datetime(1999, 12, 31, 23, 59, 59)

# Weekday columns, Monday first.
WEEKDAY_LETTERS = ("M", "T", "W", "R", "F", "S", "U")

Moment = str | date | datetime


def as_moment(value: Moment) -> datetime:
    """A wall-clock datetime; dates mean midnight and any zone is dropped."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("T", " ")[:19])
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=None)


def at(value: Moment) -> Column:
    """The moment as a TIMESTAMP_NTZ literal, so no session zone can shift it."""
    return F.lit(as_moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(value: Moment, days: int) -> datetime:
    return as_moment(value) - timedelta(days=days)


def first_day_from(value: Moment) -> date:
    """First calendar day whose midnight is at or after the moment."""
    moment = as_moment(value)
    midnight = datetime(moment.year, moment.month, moment.day)
    return moment.date() if moment == midnight else moment.date() + timedelta(days=1)


def last_day_until(value: Moment) -> date:
    """Last calendar day whose midnight is at or before the moment."""
    return as_moment(value).date()


def days_between(day: Column, low: Moment, high: Moment) -> Column:
    """A DATE column's midnight lies in [low, high].

    The bounds are folded to DATE literals here, so the test stays a plain
    column-to-literal comparison that a Parquet scan can use.
    """
    return (day >= F.lit(first_day_from(low))) & (day <= F.lit(last_day_until(high)))


def in_last_days(day: Column, as_of: Moment, days: int) -> Column:
    return days_between(day, days_before(as_of, days), as_of)
