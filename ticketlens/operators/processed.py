"""Cleaned copies of the base tables: parsed dates and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import date_part, digits_only
from ticketlens.semantics import COMP_PATTERN, PRESENTS_PATTERN, SPECIAL_PATTERN


def orderlines_processed(lines: DataFrame) -> DataFrame:
    return lines.select(
        "id",
        F.col("order_number").cast("string").alias("order_number"),
        "ticket_name",
        "ticket_price",
        "printed",
        "promo_code_id",
        "checked_in",
    )


def orders_processed(orders: DataFrame, comp_pattern: str = COMP_PATTERN) -> DataFrame:
    """Adds the purchase day and the comped / not_comped flags.

    A NULL payment method is neither; ingest stores '' for a missing one, which
    counts as paid.
    """
    comp = F.col("payment_method").ilike(comp_pattern)
    return orders.select(
        "id",
        "show_id",
        F.col("order_number").cast("string").alias("order_number"),
        "cust_id",
        "email",
        "phone",
        "purchase_date",
        "payment_method",
        "booking_type",
        "order_total",
        "new_customer",
        "sys_entry_date",
        "addons",
        date_part(F.col("purchase_date")).alias("purchase_date_formatted"),
        F.when(comp, 1).otherwise(0).alias("comped"),
        F.when(~comp, 1).otherwise(0).alias("not_comped"),
    )


def shows_processed(shows: DataFrame) -> DataFrame:
    """Adds the start day and its weekday (0 = Monday)."""
    day = date_part(F.col("start_date_time"))
    return shows.select(
        "id",
        "event_id",
        "start_date_time",
        "sold_out",
        "cancelled_at",
        day.alias("start_date_formatted"),
        F.weekday(day).alias("day_of_week"),
    )


def events_processed(
    events: DataFrame,
    special_pattern: str = SPECIAL_PATTERN,
    presents_pattern: str = PRESENTS_PATTERN,
) -> DataFrame:
    """Adds flags that are 1 or NULL, never 0."""
    return events.select(
        "id",
        "venue_id",
        "name",
        "logo_url",
        F.when(F.col("name").ilike(special_pattern), 1).alias("special_event"),
        F.when(F.col("name").ilike(presents_pattern), 1).alias("presents_event"),
    )


def clean_phones(df: DataFrame, column: str, keep_missing: bool = False) -> DataFrame:
    """Digits only; with ``keep_missing`` NULL and '' stay as they are."""
    phone = F.col(column)
    cleaned = digits_only(phone)
    if keep_missing:
        cleaned = F.when(phone.isNotNull() & (phone != ""), cleaned).otherwise(phone)
    return df.withColumn(column, cleaned)


