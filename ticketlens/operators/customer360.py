"""The wide customer table: one row per contact, 45 columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import is_valid_email, whole_units
from ticketlens.operators import features as ft
from ticketlens.operators.marts import line_totals, order_number_totals, place_orders
from ticketlens.operators.skew import lookup_join
from ticketlens.semantics import RECENCY_WINDOWS, WEEKDAY_LETTERS, Moment

_WEEKDAYS = [f"shows_attended_{letter}" for letter in WEEKDAY_LETTERS]
_RECENCY = [
    f"{kind}_{days}"
    for days in RECENCY_WINDOWS
    for kind in ("paid_orders_revenue", "paid_orders_count", "comp_orders_count")
]


def _wide_columns() -> list[Column]:
    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    names = [
        "phone",
        "total_revenue",
        "last_ordered_date",
        "first_show_attended",
        "first_event_title",
        "first_event_venue",
        "last_show_attended",
        "last_event_title",
        "last_event_venue",
        "next_show_attending",
        "next_event_title",
        "next_event_venue",
        "avg_tickets_per_order",
    ]
    lifetime = [
        "total_lifetime_paid_orders",
        "total_lifetime_paid_tickets",
        "avg_tickets_per_paid_order",
        "total_lifetime_comp_orders",
        "total_lifetime_comp_tickets",
        "avg_tickets_per_comp_order",
        "last_comp_show_date",
    ]
    return [
        F.col("email_address"),
        F.col("name").alias("cust_name"),
        F.col("name_first").alias("cust_name_first"),
        F.col("name_last").alias("cust_name_last"),
        *map(F.col, names),
        # The wide table keeps this average as a whole number of days.
        F.round("avg_purchase_to_show_days").cast("int").alias("avg_purchase_to_show_days"),
        (count("total_lifetime_paid_orders") + count("total_lifetime_comp_orders")).alias("total_orders"),
        *map(F.col, lifetime),
        *map(F.col, _WEEKDAYS),
        *map(F.col, _RECENCY),
        F.col("count_shows_special"),
        F.col("count_shows_persents"),
        F.col("sys_entry_date"),
    ]


def customer_360_from_features(contacts: DataFrame, features: list[DataFrame]) -> DataFrame:
    """Contacts left-joined with feature tables that are already at hand."""
    keyed = contacts.withColumn(ft.KEY, F.col("email_address"))
    return reduce(lambda wide, feature: wide.join(feature, ft.KEY, "left"), features, keyed).select(
        *_wide_columns()
    )


def customer_features(
    orders: DataFrame,
    lines: DataFrame,
    shows: DataFrame,
    events: DataFrame,
    venues: DataFrame,
    as_of: Moment,
    weekday_mode: str = "corrected",
    count_mode: str = "orders",
    unique_order_numbers: bool = False,
) -> DataFrame:
    """All customer features in one aggregate over one pass of the orders.

    Each feature has its own population (orders with a show, with counted tickets,
    …), so each aggregate carries its condition, and a feature whose population is
    empty for a customer comes out NULL as a missed left join would.

    Orders that share a number multiply its lines, which takes a second, narrow pass
    over the orders; ``unique_order_numbers=True`` saves it where
    ``duplicate_order_numbers`` is known to be empty.
    """
    placed_orders = place_orders(orders, shows, events, venues, how="left")
    totals = line_totals(lines) if unique_order_numbers else order_number_totals(placed_orders, lines)
    named_orders = placed_orders.where(is_valid_email(F.col("email")))
    facts = lookup_join(named_orders, totals, "order_number", "left", keys_from=orders)
    if unique_order_numbers:
        tickets = F.when(F.col("has_venue") == 1, F.col("n_lines"))
        facts = facts.withColumns(
            {
                "tickets": tickets,
                "paid_tickets": F.when(F.col("not_comped") == 1, tickets),
                "comp_tickets": F.when(F.col("comped") == 1, tickets),
            }
        )

    placed = F.col("has_show") == 1
    with_event = F.col("has_event") == 1
    visited = F.col("has_venue") == 1
    counted = placed & F.col("tickets").isNotNull()
    paid = F.col("paid_tickets").isNotNull()
    comp = placed & F.col("comp_tickets").isNotNull()
    day = F.col("start_date_formatted")
    newest = F.struct("purchase_date_formatted", "id")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col(name)))

    def if_any(condition: Column, value: Column) -> Column:
        return F.when(F.count_if(condition) > 0, value)

    def named(column: Column, name: str) -> Column:
        return column.alias(name)

    weekdays = [
        named(if_any(placed, column), name)
        for name, column in zip(_WEEKDAYS, ft.weekday_columns(day, weekday_mode, count_mode), strict=True)
    ]
    aggregates = [
        *ft.first_last_next_columns(day, F.col("event_name"), F.col("venue_id"), as_of, visited),
        named(
            F.avg(F.when(counted, F.datediff(day, F.col("purchase_date_formatted")))), "avg_purchase_to_show_days"
        ),
        named(total(counted, "tickets") / F.nullif(F.count_if(counted), F.lit(0)), "avg_tickets_per_order"),
        named(F.nullif(F.count_if(paid), F.lit(0)), "total_lifetime_paid_orders"),
        named(F.sum("paid_tickets"), "total_lifetime_paid_tickets"),
        named(F.sum("paid_tickets") / F.nullif(F.count_if(paid), F.lit(0)), "avg_tickets_per_paid_order"),
        named(F.max(F.when(comp, day)), "last_comp_show_date"),
        named(F.nullif(F.count_if(comp), F.lit(0)), "total_lifetime_comp_orders"),
        named(total(comp, "comp_tickets"), "total_lifetime_comp_tickets"),
        named(total(comp, "comp_tickets") / F.nullif(F.count_if(comp), F.lit(0)), "avg_tickets_per_comp_order"),
        *weekdays,
        *ft.recency_columns(as_of),
        named(F.max_by("phone", F.when(with_event, newest)), "phone"),
        named(F.max(F.when(with_event, F.col("purchase_date_formatted"))), "last_ordered_date"),
        named(if_any(with_event, F.count_if(F.col("special_event") == 1)), "count_shows_special"),
        named(if_any(with_event, F.count_if(F.col("presents_event") == 1)), "count_shows_persents"),
        named(whole_units(total(F.col("not_comped") == 1, "line_cents")), "total_revenue"),
    ]
    return (
        facts.groupBy(F.col("email").alias(ft.KEY))
        .agg(*aggregates)
        .withColumns(_field_map())
        .drop("_first", "_last", "_next")
    )


def _field_map() -> dict[str, Column]:
    names = [
        f"{when}_{field}"
        for when, show in (("first", "show_attended"), ("last", "show_attended"), ("next", "show_attending"))
        for field in (show, "event_title", "event_venue")
    ]
    return dict(zip(names, ft.first_last_next_fields(), strict=True))


def customer_360(
    contacts: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    shows: DataFrame,
    events: DataFrame,
    venues: DataFrame,
    as_of: Moment,
    weekday_mode: str = "corrected",
    count_mode: str = "orders",
    unique_order_numbers: bool = False,
) -> DataFrame:
    """The wide table straight from the processed tables.

    Orders are scanned once and shuffled by email once; no feature table is built.
    """
    features = customer_features(
        orders, lines, shows, events, venues, as_of, weekday_mode, count_mode, unique_order_numbers
    )
    return with_features(contacts, features)


def with_features(contacts: DataFrame, features: DataFrame) -> DataFrame:
    """The wide table from :func:`customer_features`, one row per customer on both sides."""
    return customer_360_from_features(contacts, [features])


# Columns of each feature table, and the one that is set exactly where the table has a row.
FEATURE_TABLES: dict[str, tuple[list[str], str | None]] = {
    "avg_tickets_per_order": (["avg_purchase_to_show_days", "avg_tickets_per_order"], "avg_tickets_per_order"),
    "per_paid_order": (
        ["total_lifetime_paid_orders", "total_lifetime_paid_tickets", "avg_tickets_per_paid_order"],
        "total_lifetime_paid_orders",
    ),
    "per_comp_order": (
        [
            "last_comp_show_date",
            "total_lifetime_comp_orders",
            "total_lifetime_comp_tickets",
            "avg_tickets_per_comp_order",
        ],
        "total_lifetime_comp_orders",
    ),
    "weekday_attendence": (_WEEKDAYS, _WEEKDAYS[0]),
    "last_360": (_RECENCY, None),
    "special_shows": (
        ["phone", "last_ordered_date", "count_shows_special", "count_shows_persents"],
        "count_shows_special",
    ),
    "total_spend": (["total_revenue"], "total_revenue"),
}
# Tables that hold known contacts only.
_OF_CONTACTS = ("avg_tickets_per_order", "per_paid_order", "per_comp_order")


def split_features(features: DataFrame, contacts: DataFrame) -> dict[str, DataFrame]:
    """The eight feature tables as projections of one :func:`customer_features` table."""
    events = [ft.KEY, *_field_map()]
    tables = {"fln_event_data": ft.for_all_contacts(features.select(*events), contacts)}
    for name, (columns, present) in FEATURE_TABLES.items():
        table = features if present is None else features.where(F.col(present).isNotNull())
        table = table.select(ft.KEY, *columns)
        tables[name] = ft.of_contacts(table, contacts) if name in _OF_CONTACTS else table
    return tables
