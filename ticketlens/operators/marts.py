"""The order-line mart, attendance rows and per-order ticket counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.operators.skew import is_small, lookup_join


def show_dimension(
    shows: DataFrame, events: DataFrame, venues: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """Shows with their event and, if given, venue: one row per show, keyed by ``show_id``."""
    show = shows.select(F.col("id").alias("show_id"), "event_id", "start_date_formatted", "day_of_week")
    event = events.select(
        F.col("id").alias("event_id"),
        "venue_id",
        F.col("name").alias("event_name"),
        "special_event",
        "presents_event",
        F.lit(1).alias("has_event"),
    )
    places = show.withColumn("has_show", F.lit(1)).join(event, "event_id", how)
    if venues is not None:
        venue = venues.select(F.col("id").alias("venue_id"), F.lit(1).alias("has_venue"))
        places = places.join(venue, "venue_id", how)
    return places


def place_orders(
    orders: DataFrame,
    shows: DataFrame,
    events: DataFrame,
    venues: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Orders with the columns of their :func:`show_dimension`.

    The dimensions are joined with each other first, so the orders meet them in one
    join. Spark's own size estimate of such a join is a product and far too high, so
    the shows are counted (one small job): few are broadcast, many are shuffled with
    hot shows kept apart.
    """
    places = show_dimension(shows, events, venues, how).drop("event_id", "day_of_week")
    if is_small(shows):
        return orders.join(F.broadcast(places), "show_id", how)
    return lookup_join(orders, places, "show_id", how)


def orders_mart(
    orders: DataFrame, lines: DataFrame, shows: DataFrame, events: DataFrame, venues: DataFrame
) -> DataFrame:
    """One row per order line with its order, event and venue (19 columns).

    Orders without lines, show, event or venue drop out; :func:`order_orphans`
    lists them.
    """
    placed = place_orders(orders, shows, events, venues)
    return (
        placed.withColumnsRenamed({"id": "externalid", "order_number": "orderNumber"})
        .join(
            lines.select(
                F.col("id").alias("unique_id"),
                F.col("order_number").alias("orderNumber"),
                "ticket_name",
                "ticket_price",
            ),
            "orderNumber",
        )
        .select(
            "unique_id",
            "externalid",
            "email",
            "orderNumber",
            F.col("purchase_date_formatted").alias("orderDate"),
            F.col("order_total").alias("totalPrice"),
            F.col("cust_id").alias("customerid"),
            F.col("payment_method").alias("shippingMethod"),
            F.col("ticket_name").alias("orderproduct_name"),
            F.col("ticket_price").alias("orderproduct_price"),
            F.col("show_id").alias("orderproduct_category"),
            "comped",
            "not_comped",
            "booking_type",
            "new_customer",
            "venue_id",
            "event_name",
            "sys_entry_date",
            "addons",
        )
    )


def order_orphans(
    orders: DataFrame, lines: DataFrame, shows: DataFrame, events: DataFrame, venues: DataFrame
) -> DataFrame:
    """Orders the mart leaves out, with the first missing link: line, show, event or venue."""
    with_lines = lines.select("order_number").distinct().withColumn("has_lines", F.lit(1))
    missing = (
        F.when(F.col("has_lines").isNull(), "line")
        .when(F.col("has_show").isNull(), "show")
        .when(F.col("has_event").isNull(), "event")
        .when(F.col("has_venue").isNull(), "venue")
    )
    narrow = orders.select("id", "order_number", "show_id", "email")
    placed = place_orders(narrow, shows, events, venues, how="left")
    return (
        lookup_join(placed, with_lines, "order_number", "left", keys_from=orders)
        .select("id", "order_number", "email", missing.alias("missing"))
        .where(F.col("missing").isNotNull())
    )


def visits(orders: DataFrame, shows: DataFrame, events: DataFrame, venues: DataFrame) -> DataFrame:
    """(email, day, title, venue) of every order with a show, event and venue."""
    return place_orders(orders.select("email", "show_id"), shows, events, venues).select(
        F.col("email").alias("subscriber_key"),
        "start_date_formatted",
        F.col("event_name").alias("event_title"),
        F.col("venue_id").alias("event_venue"),
    )


def attended_events(
    contacts: DataFrame, orders: DataFrame, shows: DataFrame, events: DataFrame, venues: DataFrame
) -> DataFrame:
    """:func:`visits` of known contacts, one row per order."""
    known = contacts.select(F.col("email_address").alias("subscriber_key"))
    emails = orders.select(F.col("email").alias("subscriber_key"))
    return lookup_join(
        visits(orders, shows, events, venues), known, "subscriber_key", keys_from=emails
    )


def ticket_counts(mart: DataFrame) -> DataFrame:
    """Tickets per order number: all, paid and complimentary, in one pass.

    A count is NULL, not 0, where the order number has no such line, so an inner
    join on one kind is a filter on its column.
    """
    return mart.groupBy(F.col("orderNumber").alias("order_number")).agg(
        F.count(F.lit(1)).alias("tickets"),
        F.nullif(F.count_if(F.col("not_comped") == 1), F.lit(0)).alias("paid_tickets"),
        F.nullif(F.count_if(F.col("comped") == 1), F.lit(0)).alias("comp_tickets"),
    )


def line_totals(lines: DataFrame) -> DataFrame:
    """Number and value of the lines per order number."""
    return lines.groupBy("order_number").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("ticket_price").alias("line_cents")
    )


def order_number_totals(placed: DataFrame, lines: DataFrame) -> DataFrame:
    """:func:`ticket_counts` plus line revenue per order number, without building the mart.

    ``placed`` are orders from :func:`place_orders`; those without a venue do not count.
    Lines and orders are each aggregated to one row per order number before they
    meet, so no line row is joined. Multiplying the counts equals counting the joined
    rows, also where several orders share a number.
    """
    per_lines = line_totals(lines)
    per_orders = (
        placed.where(F.col("has_venue") == 1)
        .groupBy("order_number")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("not_comped").alias("n_paid"),
            F.sum("comped").alias("n_comp"),
        )
    )
    return per_lines.join(per_orders, "order_number", "left").select(
        "order_number",
        "line_cents",
        (F.col("n_lines") * F.col("n_orders")).alias("tickets"),
        F.nullif(F.col("n_lines") * F.col("n_paid"), F.lit(0)).alias("paid_tickets"),
        F.nullif(F.col("n_lines") * F.col("n_comp"), F.lit(0)).alias("comp_tickets"),
    )


def duplicate_order_numbers(orders: DataFrame) -> DataFrame:
    """Order numbers carried by more than one order: these multiply lines in the mart."""
    return (
        orders.groupBy("order_number")
        .agg(F.count(F.lit(1)).alias("orders"))
        .where(F.col("orders") > 1)
    )
