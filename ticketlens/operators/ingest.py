"""Nested API JSON to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import (
    clean_email,
    clean_name,
    clean_ticket_name,
    flag_text,
    parse_cents,
    wall_clock,
)
from ticketlens.operators.selection import valid_email
from ticketlens.operators.skew import one_per_key
from ticketlens.semantics import BACKFILL_ENTRY, Moment, at, days_before

SIGHTING_KEYS = ["venue_id", "order_number"]


def _tickets() -> Column:
    """All tickets of the order, whatever their type."""
    return F.coalesce(F.flatten(F.map_values("tickets")), F.array())


def flatten_orders(orders: DataFrame, entry_date: Moment) -> DataFrame:
    """One row per order and show it was seen under, with the venue for merging.

    The total adds the readable ticket prices; ``bad_prices`` counts the others.
    """
    prices = F.transform(_tickets(), lambda ticket: parse_cents(ticket["price"]))
    total = F.aggregate(prices, F.lit(0).cast("bigint"), lambda sum_, price: sum_ + F.coalesce(price, F.lit(0)))
    customer = F.col("customer")
    return orders.select(
        "venue_id",
        "id",
        "show_id",
        "order_number",
        customer["id"].alias("cust_id"),
        clean_email(customer["email"]).alias("email"),
        customer["phone"].alias("phone"),
        wall_clock(F.col("purchase_at")).alias("purchase_date"),
        F.coalesce(F.get("payments", F.lit(0))["payment_method"], F.lit("")).alias("payment_method"),
        "booking_type",
        total.alias("order_total"),
        flag_text(customer["new_customer"]).alias("new_customer"),
        at(entry_date).alias("sys_entry_date"),
        F.coalesce(
            F.array_join(F.transform("addons", lambda addon: addon["name"]), "\t"), F.lit("")
        ).alias("addons"),
        F.size(F.filter(prices, lambda price: price.isNull())).alias("bad_prices"),
    )


def _show_order() -> list[Column]:
    """Show ids as numbers, those that are none last and by text."""
    return [F.coalesce(F.col("show_id").try_cast("bigint"), F.lit(2**63 - 1)), F.col("show_id")]


def merge_order_sightings(
    flat: DataFrame, sequence: Column | None = None, keys: list[str] | None = None
) -> DataFrame:
    """One row per order of a venue: attributes as first seen, totals added up.

    ``sequence`` orders the sightings (default: show id, as a number).
    """
    keys = keys or SIGHTING_KEYS
    rest = [c for c in flat.columns if c not in (*keys, "order_total", "bad_prices")]
    order = F.struct((F.struct(*_show_order()) if sequence is None else sequence).alias("seq"), F.struct(*rest))
    first = F.min_by(F.struct(*rest), order)
    merged = flat.groupBy(*keys).agg(
        first.alias("_first"), F.sum("order_total").alias("order_total"), F.sum("bad_prices").alias("bad_prices")
    )
    return merged.select("*", "_first.*").drop("_first").select(*flat.columns)


def flatten_orderlines(orders: DataFrame) -> DataFrame:
    """One row per ticket; the id joins order number and ticket id."""
    by_type = orders.select("order_number", F.explode("tickets").alias("ticket_type", "of_type"))
    ticket = F.col("ticket")
    return by_type.select("order_number", "ticket_type", F.explode("of_type").alias("ticket")).select(
        F.concat_ws("-", "order_number", ticket["id"]).alias("id"),
        "order_number",
        clean_ticket_name(F.col("ticket_type")).alias("ticket_name"),
        parse_cents(ticket["price"]).alias("ticket_price"),
        flag_text(ticket["printed"]).alias("printed"),
        ticket["promo_code_id"].alias("promo_code_id"),
        flag_text(ticket["checked_in"]).alias("checked_in"),
    )


def first_sightings(orders: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """The first sighting of each order of a venue (default order: show id, as a number)."""
    return one_per_key(orders, SIGHTING_KEYS, order or [*_show_order(), F.col("id")])


def flatten_contacts(orders: DataFrame, entry_date: Moment) -> DataFrame:
    """Contacts of the orders, addresses that are missing left out."""
    customer = F.col("customer")
    contacts = orders.select(
        clean_email(customer["email"]).alias("email_address"),
        clean_name(customer["name"]).alias("name"),
        F.coalesce(clean_name(customer["first_name"]), F.lit("")).alias("name_first"),
        F.coalesce(clean_name(customer["last_name"]), F.lit("")).alias("name_last"),
        at(entry_date).alias("sys_entry_date"),
    )
    return valid_email(contacts, "email_address")


def backfill_contacts(orders: DataFrame) -> DataFrame:
    """Contacts stamped with the backfill sentinel instead of a load time."""
    return flatten_contacts(orders, BACKFILL_ENTRY)


def _catalog_events(catalog: DataFrame) -> DataFrame:
    return catalog.select("venue_id", F.explode("data").alias("event"))


def flatten_events(catalog: DataFrame) -> DataFrame:
    event = F.col("event")
    return _catalog_events(catalog).select(
        event["id"].alias("id"),
        "venue_id",
        clean_name(event["name"]).alias("name"),
        event["image_url"].alias("logo_url"),
    )


def recent_shows(catalog: DataFrame, mark: Moment, lookback_days: int = 4, strict: bool = True) -> DataFrame:
    """(venue, event, show) of shows that start after the mark less the lookback."""
    event = F.col("event")
    shows = _catalog_events(catalog).select(
        "venue_id", event["id"].alias("event_id"), F.explode(event["shows"]).alias("show")
    )
    start = wall_clock(F.col("show.start_date_time"))
    bound = at(days_before(mark, lookback_days))
    return shows.where(start > bound if strict else start >= bound).select(
        "venue_id", "event_id", F.col("show.id").alias("show_id")
    )


def flatten_shows(details: DataFrame) -> DataFrame:
    show = F.col("data")
    return details.select(
        F.col("show_id").alias("id"),
        show["event_id"].alias("event_id"),
        wall_clock(show["start_date_time"]).alias("start_date_time"),
        flag_text(show["sold_out"]).alias("sold_out"),
        wall_clock(show["event"]["cancelled_at"]).alias("cancelled_at"),
    )


def bad_price_report(merged: DataFrame) -> DataFrame:
    """Orders with ticket prices that were not readable."""
    return merged.where(F.col("bad_prices") > 0).select("venue_id", "order_number", "bad_prices")
