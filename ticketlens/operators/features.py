"""Per-customer features.

Every feature aggregates orders by email before contacts come in, so a hot email
is combined before any shuffle and a join sees one row per customer. Restrict a
feature to known contacts with :func:`of_contacts`.

Inputs: ``orders``, ``shows``, ``events`` are the processed tables; ``counts`` is
``ticket_counts`` or ``order_number_totals``; ``as_of`` is the evaluation moment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import whole_units
from ticketlens.operators.marts import line_totals, place_orders
from ticketlens.operators.skew import lookup_join
from ticketlens.semantics import (
    RECENCY_WINDOWS,
    WEEKDAY_LETTERS,
    Moment,
    in_last_days,
    last_day_until,
)

KEY = "subscriber_key"


def of_contacts(feature: DataFrame, contacts: DataFrame) -> DataFrame:
    """Only rows of known contacts (contacts hold one row per email)."""
    return feature.join(contacts.select(F.col("email_address").alias(KEY)), KEY, "left_semi")


def for_all_contacts(feature: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every contact, with NULLs where the feature has no row."""
    return contacts.select(F.col("email_address").alias(KEY)).join(feature, KEY, "left")


def _by_email(orders: DataFrame):
    return orders.groupBy(F.col("email").alias(KEY))


def first_last_next_columns(day: Column, title: Column, venue: Column, as_of: Moment, seen: Column) -> list[Column]:
    """Aggregates for the first, last and next event as structs.

    A show on the day of ``as_of`` is past. Of several events on one date the lowest
    (title, venue) is taken; for the last event the day is negated so that the same
    minimum finds the latest day and the lowest title.
    """
    past = seen & (day <= F.lit(last_day_until(as_of)))
    ahead = seen & (day > F.lit(last_day_until(as_of)))
    forward = F.struct(F.unix_date(day).alias("d"), title.alias("t"), venue.alias("v"))
    backward = F.struct((-F.unix_date(day)).alias("d"), title.alias("t"), venue.alias("v"))
    return [
        F.min(F.when(past, forward)).alias("_first"),
        F.min(F.when(past, backward)).alias("_last"),
        F.min(F.when(ahead, forward)).alias("_next"),
    ]


def first_last_next_fields() -> list[Column]:
    return [
        F.date_from_unix_date("_first.d").alias("first_show_attended"),
        F.col("_first.t").alias("first_event_title"),
        F.col("_first.v").alias("first_event_venue"),
        F.date_from_unix_date(-F.col("_last.d")).alias("last_show_attended"),
        F.col("_last.t").alias("last_event_title"),
        F.col("_last.v").alias("last_event_venue"),
        F.date_from_unix_date("_next.d").alias("next_show_attending"),
        F.col("_next.t").alias("next_event_title"),
        F.col("_next.v").alias("next_event_venue"),
    ]


def first_last_next(visited: DataFrame, as_of: Moment) -> DataFrame:
    """First, last and next event per customer, in one pass over ``visits``."""
    columns = first_last_next_columns(
        F.col("start_date_formatted"), F.col("event_title"), F.col("event_venue"), as_of, F.lit(True)
    )
    return visited.groupBy(KEY).agg(*columns).select(KEY, *first_last_next_fields())


def ticket_lead_stats(orders: DataFrame, shows: DataFrame, counts: DataFrame) -> DataFrame:
    """Average days from purchase to show and average tickets per order."""
    starts = shows.select(F.col("id").alias("show_id"), "start_date_formatted")
    counted = counts.where(F.col("tickets").isNotNull()).select("order_number", "tickets")
    return _by_email(lookup_join(orders.join(starts, "show_id"), counted, "order_number", keys_from=orders)).agg(
        F.avg(F.datediff("start_date_formatted", "purchase_date_formatted")).alias("avg_purchase_to_show_days"),
        (F.sum("tickets") / F.count(F.lit(1))).alias("avg_tickets_per_order"),
    )


def paid_lifetime(orders: DataFrame, counts: DataFrame) -> DataFrame:
    """Paid orders, paid tickets and paid tickets per order."""
    counted = counts.where(F.col("paid_tickets").isNotNull()).select("order_number", "paid_tickets")
    return _by_email(lookup_join(orders, counted, "order_number")).agg(
        F.count(F.lit(1)).alias("total_lifetime_paid_orders"),
        F.sum("paid_tickets").alias("total_lifetime_paid_tickets"),
        (F.sum("paid_tickets") / F.count(F.lit(1))).alias("avg_tickets_per_paid_order"),
    )


def comp_lifetime(orders: DataFrame, shows: DataFrame, counts: DataFrame) -> DataFrame:
    """Complimentary orders, tickets, tickets per order and the last such show day."""
    starts = shows.select(F.col("id").alias("show_id"), "start_date_formatted")
    counted = counts.where(F.col("comp_tickets").isNotNull()).select("order_number", "comp_tickets")
    return _by_email(lookup_join(orders.join(starts, "show_id"), counted, "order_number", keys_from=orders)).agg(
        F.max("start_date_formatted").alias("last_comp_show_date"),
        F.count(F.lit(1)).alias("total_lifetime_comp_orders"),
        F.sum("comp_tickets").alias("total_lifetime_comp_tickets"),
        (F.sum("comp_tickets") / F.count(F.lit(1))).alias("avg_tickets_per_comp_order"),
    )


def lifetime_stats(
    orders: DataFrame, counts: DataFrame, flag: str, shows: DataFrame | None = None
) -> DataFrame:
    """Lifetime statistics by payment flag: ``not_comped`` or ``comped`` (needs shows)."""
    if flag == "not_comped":
        return paid_lifetime(orders, counts)
    if flag == "comped" and shows is not None:
        return comp_lifetime(orders, shows, counts)
    raise ValueError("flag must be 'not_comped', or 'comped' together with shows")


def weekday_columns(day: Column, mode: str, count_mode: str) -> list[Column]:
    """Seven aggregates, Monday first.

    ``mode="corrected"`` counts Monday under M. ``mode="reference"`` compares a
    Sunday-is-1 day number with 0 for M … 6 for U: M is always 0, each other column
    holds the weekday two before its own, and Saturdays are in none.
    ``count_mode="orders"`` counts orders, ``"reference"`` marks 0 or 1.
    """
    if mode not in ("corrected", "reference") or count_mode not in ("orders", "reference"):
        raise ValueError("mode is 'corrected' or 'reference', count_mode 'orders' or 'reference'")
    number = F.weekday(day) if mode == "corrected" else F.dayofweek(day)
    columns = []
    for position, letter in enumerate(WEEKDAY_LETTERS):
        hits = F.count_if(number == position)
        if count_mode == "reference":
            hits = F.least(hits, F.lit(1).cast("bigint"))
        columns.append(hits.alias(f"shows_attended_{letter}"))
    return columns


def weekday_attendance(
    orders: DataFrame, shows: DataFrame, mode: str = "corrected", count_mode: str = "orders"
) -> DataFrame:
    """Orders per weekday of the show, one column per weekday."""
    starts = shows.select(F.col("id").alias("show_id"), "start_date_formatted")
    return _by_email(orders.join(starts, "show_id")).agg(
        *weekday_columns(F.col("start_date_formatted"), mode, count_mode)
    )


def recency_columns(as_of: Moment, windows: Sequence[int] = RECENCY_WINDOWS) -> list[Column]:
    """Paid revenue, paid orders and complimentary orders of each window.

    Revenue is NULL where no paid order falls in the window; counts are 0.
    """
    columns = []
    for days in windows:
        recent = in_last_days(F.col("purchase_date_formatted"), as_of, days)
        paid = recent & (F.col("not_comped") == 1)
        comp = recent & (F.col("comped") == 1)
        columns += [
            whole_units(F.sum(F.when(paid, F.col("order_total")))).alias(f"paid_orders_revenue_{days}"),
            F.count_if(paid).alias(f"paid_orders_count_{days}"),
            F.count_if(comp).alias(f"comp_orders_count_{days}"),
        ]
    return columns


def recency_spend(orders: DataFrame, as_of: Moment, windows: Sequence[int] = RECENCY_WINDOWS) -> DataFrame:
    return _by_email(orders).agg(*recency_columns(as_of, windows))


def special_event_stats(orders: DataFrame, shows: DataFrame, events: DataFrame) -> DataFrame:
    """Special and presented event orders, last order day, phone of the newest order."""
    newest = F.struct("purchase_date_formatted", "id")
    return _by_email(place_orders(orders, shows, events)).agg(
        F.max_by("phone", newest).alias("phone"),
        F.max("purchase_date_formatted").alias("last_ordered_date"),
        F.count_if(F.col("special_event") == 1).alias("count_shows_special"),
        F.count_if(F.col("presents_event") == 1).alias("count_shows_persents"),
    )


def total_spend(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Ticket revenue of paid orders.

    Lines are summed per order number first, so the join meets one row per number.
    """
    revenue = line_totals(lines).drop("n_lines")
    paid = orders.where(F.col("not_comped") == 1).select("email", "order_number")
    return _by_email(lookup_join(paid, revenue, "order_number")).agg(
        whole_units(F.sum("line_cents")).alias("total_revenue")
    )
