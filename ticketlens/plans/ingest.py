"""Landed JSON into the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ticketlens.operators import ingest
from ticketlens.schemas import CONTACTS, EVENTS, ORDERLINES, ORDERS, SHOWS
from ticketlens.semantics import Moment
from ticketlens.sources.upsert import ENTITY_KEYS, upsert_table


def _store(spark: SparkSession, root: str, name: str, rows: DataFrame, schema: StructType) -> None:
    upsert_table(spark, f"{root}/{name}", rows.select(*schema.fieldNames()), ENTITY_KEYS[name], schema)


def ingest_orders(spark: SparkSession, orders: DataFrame, root: str, entry_date: Moment) -> None:
    """Flatten order sightings and upsert contacts, orders and order lines."""
    contacts = ingest.flatten_contacts(ingest.first_sightings(orders), entry_date)
    merged = ingest.merge_order_sightings(ingest.flatten_orders(orders, entry_date))
    _store(spark, root, "contacts", contacts, CONTACTS)
    _store(spark, root, "orders", merged, ORDERS)
    _store(spark, root, "orderlines", ingest.flatten_orderlines(orders), ORDERLINES)


def ingest_contact_names(spark: SparkSession, orders: DataFrame, root: str) -> None:
    """Backfill of contact names, stamped with the sentinel entry date."""
    _store(spark, root, "contacts", ingest.backfill_contacts(orders), CONTACTS)


def ingest_catalog(spark: SparkSession, catalog: DataFrame, root: str) -> None:
    _store(spark, root, "events", ingest.flatten_events(catalog), EVENTS)


def ingest_shows(spark: SparkSession, details: DataFrame, root: str) -> None:
    _store(spark, root, "shows", ingest.flatten_shows(details), SHOWS)
