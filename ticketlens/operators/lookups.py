"""Venue and order-link lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import clean_email


def with_venue_lookup(df: DataFrame, dim: DataFrame, venue_column: str, value: str) -> DataFrame:
    """Adds ``dim[value]`` for the venue and ``mapped``; unknown venues get NULL and false.

    ``dim`` has ``venue_id`` and the value. It is one row per venue, so Spark broadcasts
    it while it is below the session's size threshold.
    """
    lookup = dim.where(F.col(value).isNotNull()).select(F.col("venue_id").alias(venue_column), value)
    return df.join(lookup, venue_column, "left").withColumn("mapped", F.col(value).isNotNull())


def one_link_per_order(link: DataFrame) -> DataFrame:
    """One CRM id per (order number, connection): the lowest, so reruns agree."""
    return link.groupBy("order_number", "connection").agg(F.min("crm_id").alias("crm_id"))


def one_crm_id(contacts: DataFrame) -> DataFrame:
    """(_email, crm_id): one CRM id per email, the lowest; emails compare in key form."""
    keyed = contacts.where(F.col("crm_id").isNotNull()).select(clean_email(F.col("email")).alias("_email"), "crm_id")
    return keyed.groupBy("_email").agg(F.min("crm_id").alias("crm_id"))


def plan_contact_push(contacts: DataFrame, crm_ids: DataFrame) -> DataFrame:
    """Adds ``crm_id`` and ``action``: contact_edit where the CRM knows the email, else contact_add.

    ``contacts`` carries ``email_address``, ``crm_ids`` is (email, crm_id).
    """
    matched = clean_email(F.col("email_address")) == F.col("_email")
    known = contacts.join(one_crm_id(crm_ids), matched, "left").drop("_email")
    return known.withColumn("action", F.when(F.col("crm_id").isNull(), "contact_add").otherwise("contact_edit"))


def plan_order_push(orders: DataFrame, link: DataFrame) -> DataFrame:
    """Adds ``crm_id`` and ``action``: update where the order is linked, else add.

    ``orders`` carries ``orderNumber`` and ``connection``.
    """
    known = one_link_per_order(link).withColumnRenamed("order_number", "orderNumber")
    return orders.join(known, ["orderNumber", "connection"], "left").withColumn(
        "action", F.when(F.col("crm_id").isNull(), "add").otherwise("update")
    )
