"""Campaign tags of contacts.

Contact tags are kept long, one row per (email, tag): a set of pairs needs no list
per contact, and no contact can have too many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import digits_only
from ticketlens.operators.selection import after_mark
from ticketlens.operators.skew import lookup_join
from ticketlens.semantics import IGNORED_TAG_PATTERN, Moment


def _campaigns(subscribers: DataFrame, messages: DataFrame) -> DataFrame:
    """Distinct (email, campaign): messages collapse per number before the join.

    Numbers are compared as digits on both sides; a number without digits matches nothing.
    """
    number = digits_only(F.col("mobile_number")).alias("mobile_number")
    known = F.col("mobile_number") != ""
    sent = messages.select(number, "campaign").where(known).distinct()
    subs = subscribers.where(F.col("email_address").isNotNull()).select(F.col("email_address").alias("email"), number)
    return lookup_join(sent, subs.where(known), "mobile_number").select("email", "campaign")


def _map_key(campaign: str = "campaign") -> Column:
    """Campaigns are looked up whatever their case."""
    return F.lower(F.col(campaign)).alias("_campaign")


def backlog_tags(
    subscribers: DataFrame,
    messages: DataFrame,
    tag_map: DataFrame,
    ignored_pattern: str = IGNORED_TAG_PATTERN,
) -> DataFrame:
    """(email, tag) of mapped campaigns, tags to be ignored left out."""
    wanted = tag_map.where(~F.col("tag").ilike(ignored_pattern)).select(_map_key(), "tag")
    return (
        _campaigns(subscribers, messages)
        .select("email", _map_key())
        .join(wanted, "_campaign")
        .select("email", "tag")
        .distinct()
    )


def daily_tags(
    subscribers: DataFrame, messages: DataFrame, tag_map: DataFrame, mark: Moment, as_of: Moment
) -> DataFrame:
    """(email, tag) of subscribers with news since the mark; an unmapped campaign is its own tag."""
    recent = subscribers.where(after_mark(F.col("last_message_date"), mark, as_of))
    mapped = F.when(~F.col("tag").isin("", "None"), F.col("tag"))
    return (
        _campaigns(recent, messages)
        .select("email", "campaign", _map_key())
        .join(tag_map.select(_map_key(), "tag"), "_campaign", "left")
        .select("email", F.coalesce(mapped, "campaign").alias("tag"))
        .where(F.col("tag").isNotNull())
        .distinct()
    )


def tag_sets(contact_tags: DataFrame) -> DataFrame:
    """The tag set of each contact, one row per (email, tag)."""
    return contact_tags.select("email", "tag").distinct()


def all_tags(contact_tags: DataFrame) -> DataFrame:
    return contact_tags.select("tag").distinct()


def union_tags(*tables: DataFrame) -> DataFrame:
    """Set union of tag tables with equal columns."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first.distinct()


def missing_tags(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Tags in use that the CRM does not have yet."""
    return all_tags(wanted).join(existing.select("tag"), "tag", "left_anti")


def tag_assignments(contact_tags: DataFrame, tag_dim: DataFrame) -> DataFrame:
    """(email, tag, tag_id) to assign."""
    return contact_tags.join(tag_dim.select("tag", "tag_id"), "tag").select("email", "tag", "tag_id")
