"""Text-message subscribers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import clean_email, digits_only, is_valid_email, to_second
from ticketlens.operators.skew import lookup_join
from ticketlens.semantics import STOP_PATTERN, SUBSCRIBED, UNSUBSCRIBED


def message_email(email: Column) -> Column:
    """A message's email in join-key form; blank or "none" is missing."""
    cleaned = clean_email(email)
    return F.when(is_valid_email(cleaned), cleaned)


def clean_messages(messages: DataFrame) -> DataFrame:
    """Numbers as digits, NULL where there are none, and emails in join-key form."""
    number = F.nullif(digits_only(F.col("mobile_number")), F.lit(""))
    return messages.withColumns({"mobile_number": number, "email": message_email(F.col("email"))})


def emails_by_number(crm_contacts: DataFrame, wide: DataFrame) -> DataFrame:
    """(mobile_number, email): of the CRM contact with the number, else of the wide table's.

    Where one number has several emails the newest CRM contact, or the most recent
    orderer, gives its email; ties go to the lowest email. A blank number has none.
    """
    by_crm = _email_by_number(
        crm_contacts,
        digits_only(F.col("mobile_number")),
        message_email(F.col("email")),
        F.col("date_last_updated").cast("date"),
        "_crm_email",
    )
    by_wide = _email_by_number(
        wide,
        digits_only(F.col("phone")),
        message_email(F.col("email_address")),
        F.col("last_ordered_date"),
        "_wide_email",
    )
    both = by_crm.join(by_wide, "mobile_number", "full")
    return both.select("mobile_number", F.coalesce("_crm_email", "_wide_email").alias("_known_email"))


def enrich_message_email(messages: DataFrame, crm_contacts: DataFrame, wide: DataFrame) -> DataFrame:
    """Messages with clean numbers and emails, missing emails filled by :func:`emails_by_number`."""
    by_number = emails_by_number(crm_contacts, wide)
    return fill_email(lookup_join(clean_messages(messages), by_number, "mobile_number", "left"))


def fill_email(messages: DataFrame) -> DataFrame:
    return messages.withColumn("email", F.coalesce("email", "_known_email")).drop("_known_email")


def _email_by_number(df: DataFrame, number: Column, email: Column, day: Column, name: str) -> DataFrame:
    age = -F.coalesce(F.unix_date(day), F.lit(-(10**6)))
    return (
        df.where((number != "") & email.isNotNull())
        .groupBy(number.alias("mobile_number"))
        .agg(F.min(F.struct(age.alias("age"), email.alias("email")))["email"].alias(name))
    )


def subscriber_columns(stop_pattern: str = STOP_PATTERN) -> list[Column]:
    """Aggregates per number, usable in batch and in a stream.

    The newest message decides the status, and of messages in the same instant a
    stop request wins. ``_last`` and ``_stop`` are plain timestamps, so the status
    needs no message text in the aggregation state.
    """
    stamp = F.col("timestamp")
    return [
        F.min(stamp).alias("_join"),
        F.max(stamp).alias("_last"),
        F.max(F.when(F.col("body").ilike(stop_pattern), stamp)).alias("_stop"),
        F.max(F.when(F.col("email").isNotNull(), F.struct(stamp.alias("at"), F.col("email"))))["email"].alias(
            "email_address"
        ),
    ]


def subscriber_fields() -> list[Column]:
    unsubscribed = F.col("_stop") == F.col("_last")
    return [
        F.col("mobile_number"),
        F.when(unsubscribed, UNSUBSCRIBED).otherwise(SUBSCRIBED).alias("mobile_status"),
        F.col("email_address"),
        to_second(F.col("_join")).alias("join_date"),
        to_second(F.col("_last")).alias("last_message_date"),
    ]


def sms_subscribers(messages: DataFrame, stop_pattern: str = STOP_PATTERN) -> DataFrame:
    """One row per number: status, newest email, first and last message time.

    Numbers are compared as digits; messages without a number belong to nobody. Also
    the running table of a message stream: its state is three timestamps and one email per number.
    """
    known = clean_messages(messages).where(F.col("mobile_number").isNotNull())
    return known.groupBy("mobile_number").agg(*subscriber_columns(stop_pattern)).select(*subscriber_fields())
