"""Which shows, orders and contacts a run has to look at.

Marks are half-open: rows after ``mark`` up to and including ``upper`` / ``as_of``,
both fixed before anything is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import is_valid_email
from ticketlens.operators.skew import semi_on, semi_on_dimension
from ticketlens.semantics import (
    BOUNDARY_WINDOWS,
    Moment,
    as_moment,
    at,
    days_before,
    days_between,
)


# Day of ``sys_entry_date``, by which a stored mart is partitioned.
ENTRY_DAY = "entry_day"


def valid_email(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_valid_email(F.col(column)))


def after_mark(moment: Column, mark: Moment, upper: Moment) -> Column:
    return (moment > at(mark)) & (moment <= at(upper))


def on_days(mart: DataFrame, days: Column) -> DataFrame:
    """Only the partitions a run needs, where the mart is stored by entry day."""
    return mart.where(days) if ENTRY_DAY in mart.columns else mart


def shows_to_repull(
    shows: DataFrame,
    events: DataFrame,
    venue_ids: Sequence[str],
    mark: Moment,
    lookback_days: int = 3,
    strict: bool = True,
) -> DataFrame:
    """Shows of the venues that start after the mark less the lookback."""
    bound = at(days_before(mark, lookback_days))
    start = F.col("start_date_time")
    wanted = events.where(F.col("venue_id").isin(*venue_ids))
    late = shows.where(start > bound if strict else start >= bound)
    return semi_on_dimension(late, wanted, "event_id", "id")


def changed_orders(
    mart: DataFrame, mark: Moment, upper: Moment, venue_ids: Sequence[str] | None = None
) -> DataFrame:
    """Order lines entered since the mark, all venues in one pass."""
    days = F.col(ENTRY_DAY).between(F.lit(as_moment(mark).date()), F.lit(as_moment(upper).date()))
    rows = valid_email(on_days(mart, days), "email").where(after_mark(F.col("sys_entry_date"), mark, upper))
    return rows if venue_ids is None else rows.where(F.col("venue_id").isin(*venue_ids))


def historical_orders(mart: DataFrame, cutoff: Moment, venue_ids: Sequence[str] | None = None) -> DataFrame:
    """Order lines entered before the cut-off, or without a readable entry date."""
    entered, day = F.col("sys_entry_date"), F.col(ENTRY_DAY)
    mart = on_days(mart, (day <= F.lit(as_moment(cutoff).date())) | day.isNull())
    rows = valid_email(mart, "email").where((entered < at(cutoff)) | entered.isNull())
    return rows if venue_ids is None else rows.where(F.col("venue_id").isin(*venue_ids))


def changed_contacts(
    wide: DataFrame, mart: DataFrame, shows: DataFrame, mark: Moment, as_of: Moment
) -> DataFrame:
    """Contacts entered since the mark, or with an order for a show that has started since."""
    started = shows.where(days_between(F.col("start_date_formatted"), mark, as_of))
    attendees = (
        semi_on_dimension(mart, started, "orderproduct_category", "id")
        .select(F.col("email").alias("email_address"), F.lit(1).alias("_attended"))
        .distinct()
    )
    entered = after_mark(F.col("sys_entry_date"), mark, as_of)
    return (
        valid_email(wide, "email_address")
        .join(attendees, "email_address", "left")
        .where(entered | F.col("_attended").isNotNull())
        .drop("_attended")
    )


def extra_push_contacts(
    wide: DataFrame, mart: DataFrame, shows: DataFrame, mark: Moment, as_of: Moment
) -> DataFrame:
    """:func:`changed_contacts` with the mark one day earlier; the caller keeps its mark."""
    return changed_contacts(wide, mart, shows, as_moment(mark) - timedelta(days=1), as_of)


def boundary_contacts(
    wide: DataFrame,
    mart: DataFrame,
    as_of: Moment,
    windows: Sequence[int] = BOUNDARY_WINDOWS,
    slack: int = 1,
) -> DataFrame:
    """Contacts with an order that is just entering or leaving a day window."""
    day = F.col("orderDate")
    near = F.lit(False)
    for days in windows:
        near = near | days_between(day, days_before(as_of, days + slack), days_before(as_of, days - slack))
    return semi_on(valid_email(wide, "email_address"), mart.where(near), "email_address", "email")


def contacts_at_venues(wide: DataFrame, mart: DataFrame, venue_ids: Sequence[str]) -> DataFrame:
    """Contacts with any order at one of the venues."""
    orders = mart.where(F.col("venue_id").isin(*venue_ids))
    return semi_on(valid_email(wide, "email_address"), orders, "email_address", "email")


def contacts_with_entry_date(wide: DataFrame, entry: Moment) -> DataFrame:
    """Contacts stamped with exactly this entry date (a backfill sentinel)."""
    return wide.where(F.col("sys_entry_date") == at(entry))


def distinct_emails(df: DataFrame, column: str = "email") -> DataFrame:
    return valid_email(df, column).select(column).distinct()
