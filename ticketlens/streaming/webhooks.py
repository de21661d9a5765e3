"""Opt-in webhooks: parse, route, keep CRM contacts current."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketlens.functions import clean_email, digits_only, is_valid_email, wall_clock, webhook_fields
from ticketlens.schemas import CRM_CONTACTS, WEBHOOK_JSON
from ticketlens.sources.tables import read_version, write_version
from ticketlens.sources.upsert import update_existing, upsert

# The routes of the two webhooks.
WEBHOOK_PATH = "/webhooks"
NEW_CONTACT = "new-contact"
MOBILE_CHANGE = "mobile-chng"


def webhook_route(path: Column, method: Column) -> Column:
    """'new-contact', 'mobile-chng' or NULL for anything else."""
    is_webhook = F.contains(path, F.lit(WEBHOOK_PATH)) & (method == "POST")
    return (
        F.when(is_webhook & F.contains(path, F.lit(NEW_CONTACT)), NEW_CONTACT)
        .when(is_webhook & F.contains(path, F.lit(MOBILE_CHANGE)), MOBILE_CHANGE)
    )


def webhook_rows(requests: DataFrame) -> DataFrame:
    """Routed requests as CRM contact rows; requests without a route or email are left out."""
    parsed = requests.select(
        webhook_route(F.col("path"), F.col("httpMethod")).alias("route"),
        webhook_fields(F.col("body")).alias("form"),
        wall_clock(F.col("received_at")).alias("date_last_updated"),
    )
    email = clean_email(F.col("form.email"))
    return parsed.where(F.col("route").isNotNull() & is_valid_email(email)).select(
        "route",
        email.alias("email"),
        digits_only(F.col("form.mobile_number")).alias("mobile_number"),
        F.col("form.optin_status").alias("optin_status"),
        "date_last_updated",
    )


def apply_webhooks(contacts: DataFrame, rows: DataFrame) -> DataFrame:
    """New contacts are upserted, mobile changes only touch contacts that exist.

    The newest request of an email wins, so replaying a batch changes nothing.
    """
    newest = [F.col("date_last_updated").desc_nulls_last()]
    created = rows.where(F.col("route") == NEW_CONTACT)
    changed = rows.where(F.col("route") == MOBILE_CHANGE)
    return update_existing(upsert(contacts, created, ["email"], newest), changed, ["email"], newest)


def read_webhooks(spark: SparkSession, source: str) -> DataFrame:
    return spark.readStream.schema(WEBHOOK_JSON).json(source)


def stream_optin_webhooks(requests: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Apply arriving webhooks to the versioned CRM contact table."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = webhook_rows(batch)
        if rows.isEmpty():
            return  # nothing for the table, so it is not rewritten
        contacts = read_version(batch.sparkSession, root, CRM_CONTACTS)
        write_version(apply_webhooks(contacts, rows), root)

    return (
        requests.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )
