"""Keyed upsert on plain Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketlens.operators.skew import join_on_keys, one_per_key
from ticketlens.sources import buckets


def newest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key. Remaining ties are settled by the row's own values."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    return one_per_key(df, keys, [*newest_first, *rest])


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], newest_first: list[Column] | None = None
) -> DataFrame:
    """``target`` with ``updates`` merged in, one row per key.

    Without ``newest_first`` an update replaces the stored row (last write wins). With it, the
    newer of the stored and the updated row stays, so a replayed old batch changes
    nothing. Applying the same updates twice equals applying them once.

    ``target`` holds one row per key, as every table written this way does. Rows
    without an update pass through an anti join and are neither sorted nor grouped;
    while the update keys are below the broadcast threshold they are not shuffled either.
    """
    updates = updates.select(*target.columns)
    changed = updates.select(*keys).distinct()
    untouched = join_on_keys(target, changed, keys, "left_anti")
    if newest_first is None:
        latest = newest_per_key(updates, keys, [])
    else:
        stored = join_on_keys(target, changed, keys, "left_semi")
        latest = newest_per_key(stored.unionByName(updates), keys, newest_first)
    return untouched.unionByName(latest)


def upsert_table(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    keys: list[str],
    schema: StructType,
    newest_first: list[Column] | None = None,
    keep: int = 2,
) -> int:
    """Upsert into a table stored in hash buckets and return the new version's number.

    Only the buckets that receive updates are read and rewritten (:mod:`ticketlens.sources.buckets`);
    without ``newest_first`` the update that comes last in the input wins. The newest ``keep``
    versions stay readable; older manifests and file sets that no kept version names are deleted.
    """
    version = buckets.upsert(spark, root, updates, keys, schema, newest_first)
    buckets.expire(spark, root, keep)
    return version


def update_existing(
    target: DataFrame, updates: DataFrame, keys: list[str], newest_first: list[Column]
) -> DataFrame:
    """As :func:`upsert`, but updates of unknown keys are dropped.

    The stored keys are first cut down to those with an update, so that a few updates
    do not shuffle the keys of a large table.
    """
    known = join_on_keys(target.select(*keys), updates.select(*keys).distinct(), keys, "left_semi")
    return upsert(target, join_on_keys(updates, known, keys, "left_semi"), keys, newest_first)


# Keys of the tables that ingest keeps current.
ENTITY_KEYS = {
    "events": ["id"],
    "shows": ["id"],
    "contacts": ["email_address"],
    "orders": ["id"],
    "orderlines": ["id"],
    "order_crm_link": ["order_number", "connection"],
}


def upsert_links(link: DataFrame, new_links: DataFrame) -> DataFrame:
    """CRM ids per (order number, connection), last write wins."""
    return upsert(link, new_links, ENTITY_KEYS["order_crm_link"])
