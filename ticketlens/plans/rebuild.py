"""Rebuild of every derived table from the base tables."""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.operators import features as ft
from ticketlens.operators import marts
from ticketlens.operators import processed as pr
from ticketlens.operators.customer360 import customer_360, customer_features, split_features, with_features
from ticketlens.operators.selection import ENTRY_DAY
from ticketlens.operators.sms import enrich_message_email, sms_subscribers
from ticketlens.semantics import (
    COMP_PATTERN,
    PRESENTS_PATTERN,
    SPECIAL_PATTERN,
    STOP_PATTERN,
    Moment,
)
from ticketlens.sources.tables import expire_versions, read_version, write_version


@dataclass(frozen=True)
class BaseTables:
    """The base tables; those a job does not read may be left out."""

    contacts: DataFrame | None = None
    venues: DataFrame | None = None
    events: DataFrame | None = None
    shows: DataFrame | None = None
    orders: DataFrame | None = None
    orderlines: DataFrame | None = None
    messages: DataFrame | None = None
    crm_contacts: DataFrame | None = None


_PROCESSED = ("orders", "orderlines", "shows", "events")


@dataclass(frozen=True)
class Options:
    comp_pattern: str = COMP_PATTERN
    special_pattern: str = SPECIAL_PATTERN
    presents_pattern: str = PRESENTS_PATTERN
    stop_pattern: str = STOP_PATTERN
    weekday_mode: str = "corrected"
    count_mode: str = "orders"


def processed_tables(tables: BaseTables, options: Options = Options()) -> dict[str, DataFrame]:
    return {
        "orderlines_processed": pr.orderlines_processed(tables.orderlines),
        "orders_processed": pr.orders_processed(tables.orders, options.comp_pattern),
        "shows_processed": pr.shows_processed(tables.shows),
        "events_processed": pr.events_processed(
            tables.events, options.special_pattern, options.presents_pattern
        ),
    }


def feature_tables(
    tables: BaseTables,
    processed: dict[str, DataFrame],
    counts: DataFrame,
    as_of: Moment,
    options: Options = Options(),
) -> dict[str, DataFrame]:
    """The helper and the eight feature tables, each computed on its own.

    For one or two of them; :func:`rebuild_all` takes all from one aggregate.
    """
    orders, lines, shows, events = (processed[f"{name}_processed"] for name in _PROCESSED)
    contacts = tables.contacts
    visited = marts.visits(orders, shows, events, tables.venues)
    return {
        "attended_event_dates": marts.attended_events(contacts, orders, shows, events, tables.venues),
        "fln_event_data": ft.for_all_contacts(ft.first_last_next(visited, as_of), contacts),
        "avg_tickets_per_order": ft.of_contacts(ft.ticket_lead_stats(orders, shows, counts), contacts),
        "per_paid_order": ft.of_contacts(ft.paid_lifetime(orders, counts), contacts),
        "per_comp_order": ft.of_contacts(ft.comp_lifetime(orders, shows, counts), contacts),
        "weekday_attendence": ft.weekday_attendance(orders, shows, options.weekday_mode, options.count_mode),
        "last_360": ft.recency_spend(orders, as_of),
        "special_shows": ft.special_event_stats(orders, shows, events),
        "total_spend": ft.total_spend(orders, lines),
    }


def wide_table(
    tables: BaseTables, processed: dict[str, DataFrame], as_of: Moment, options: Options = Options()
) -> DataFrame:
    """The wide table as stored: phones reduced to digits."""
    wide = customer_360(
        tables.contacts,
        processed["orders_processed"],
        processed["orderlines_processed"],
        processed["shows_processed"],
        processed["events_processed"],
        tables.venues,
        as_of,
        options.weekday_mode,
        options.count_mode,
    )
    return pr.clean_phones(wide, "phone", keep_missing=True)


def by_entry_day(mart: DataFrame) -> DataFrame:
    """The mart with its entry day, rows of a day together and venues together within a file.

    Rebalancing lets adaptive execution split a full day and merge small ones.
    """
    days = mart.withColumn(ENTRY_DAY, F.col("sys_entry_date").cast("date"))
    return days.hint("rebalance", F.col(ENTRY_DAY)).sortWithinPartitions(ENTRY_DAY, "venue_id")


def rebuild_all(
    spark: SparkSession, tables: BaseTables, root: str, as_of: Moment, options: Options = Options()
) -> dict[str, DataFrame]:
    """Write every derived table under ``root`` in dependency order; returns them read back.

    Each table is written as the next version beside the one in use, so a failed run leaves
    the old tables readable; the last two versions stay. ``orders_mv`` has an ``entry_day``
    more, by which it is partitioned. All customer features are one aggregate over one pass of the orders, written once;
    the eight feature tables and the wide table are projections of it.
    """
    written: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        write_version(df, f"{root}/{name}", partition_by)
        expire_versions(spark, f"{root}/{name}")
        written[name] = read_version(spark, f"{root}/{name}", df.schema)
        return written[name]

    processed = {name: put(name, df) for name, df in processed_tables(tables, options).items()}
    orders, lines, shows, events = (processed[f"{name}_processed"] for name in _PROCESSED)

    def order_tables() -> None:
        mart = marts.orders_mart(orders, lines, shows, events, tables.venues)
        put("ticket_counts", marts.ticket_counts(put("orders_mv", by_entry_day(mart), [ENTRY_DAY])))
        put("attended_event_dates", marts.attended_events(tables.contacts, orders, shows, events, tables.venues))

    def customer_tables() -> None:
        features = put(
            "customer_features",
            customer_features(
                orders, lines, shows, events, tables.venues, as_of, options.weekday_mode, options.count_mode
            ),
        )
        for name, feature in split_features(features, tables.contacts).items():
            put(name, feature)
        wide = put(
            "contacts_mv", pr.clean_phones(with_features(tables.contacts, features), "phone", keep_missing=True)
        )
        crm = put("ac_mobile_contacts", pr.clean_phones(tables.crm_contacts, "mobile_number"))
        messages = put("mobile_uploads", enrich_message_email(tables.messages, crm, wide))
        put("contacts_mobile_mv", sms_subscribers(messages, options.stop_pattern))

    # Neither reads what the other writes: cores that the last tasks of one leave idle work on the other.
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(write)) for write in (order_tables, customer_tables)]
    for run in runs:
        run.result()
    return written
