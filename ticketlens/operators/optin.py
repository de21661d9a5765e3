"""Opt-in conflicts between text-message subscribers and CRM contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import capitalise, clean_email
from ticketlens.operators.selection import after_mark
from ticketlens.semantics import OPTED_IN, OPTED_OUT, SUBSCRIBED, Moment


def optin_conflicts(
    subscribers: DataFrame, crm_contacts: DataFrame, mark: Moment | None = None, as_of: Moment | None = None
) -> DataFrame:
    """Subscribers whose CRM status is missing or disagrees; with a mark, recent messages only."""
    subs = subscribers.where(F.col("email_address").isNotNull())
    if mark is not None:
        if as_of is None:
            raise ValueError("a mark needs an as_of")
        subs = subs.where(after_mark(F.col("last_message_date"), mark, as_of))
    crm = crm_contacts.select(
        clean_email(F.col("email")).alias("email_address"),
        F.col("optin_status").alias("ac_status"),
        F.col("date_last_updated").alias("ac_date"),
    )
    subscribed = F.col("mobile_status") == SUBSCRIBED
    status = capitalise(F.col("ac_status"))
    conflict = (
        F.col("ac_status").isNull() | ((status == OPTED_IN) & ~subscribed) | ((status == OPTED_OUT) & subscribed)
    )
    return (
        subs.join(crm, "email_address")
        .where(conflict)
        .select(
            "email_address",
            "mobile_number",
            "mobile_status",
            F.col("last_message_date").alias("mobile_date"),
            "ac_status",
            "ac_date",
        )
    )


def in_conflict_order(conflicts: DataFrame) -> DataFrame:
    return conflicts.orderBy("email_address", "mobile_number", "mobile_date")


def resolve_optin(conflicts: DataFrame) -> DataFrame:
    """The status to send: the CRM has none → the message status; else the later of the two.

    Equal statuses, equal dates and an unknown CRM date give no decision and no row.
    """
    message = F.when(F.col("mobile_status") == SUBSCRIBED, OPTED_IN).otherwise(OPTED_OUT)
    crm = capitalise(F.col("ac_status"))
    decision = (
        F.when(F.coalesce(crm, F.lit("")) == "", message)
        .when(crm == message, F.lit(None))
        .when(F.col("ac_date") > F.col("mobile_date"), crm)
        .when(F.col("mobile_date") > F.col("ac_date"), message)
    )
    return conflicts.withColumn("mobile_optin", decision).where(F.col("mobile_optin").isNotNull())
