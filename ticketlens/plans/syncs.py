"""Outbound runs: which rows changed, what to send, how it went.

Each function returns lazy tables; writing them out and pushing them is the
caller's step, and results come back as a table for ``push_report`` and
``upsert_links``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.operators import optin, payloads, selection, tags
from ticketlens.operators.batches import with_batch_id
from ticketlens.operators.lookups import plan_order_push, with_venue_lookup
from ticketlens.semantics import BACKFILL_ENTRY, ORDERS_PER_BATCH, Moment

CONTACT_MODES = ("daily", "boundary", "extra", "venues", "backfill")


def contact_selection(
    mode: str,
    wide: DataFrame,
    mart: DataFrame,
    shows: DataFrame,
    mark: Moment,
    as_of: Moment,
    venue_ids: Sequence[str] = (),
) -> DataFrame:
    if mode == "daily":
        return selection.changed_contacts(wide, mart, shows, mark, as_of)
    if mode == "extra":
        return selection.extra_push_contacts(wide, mart, shows, mark, as_of)
    if mode == "boundary":
        return selection.boundary_contacts(wide, mart, as_of)
    if mode == "venues":
        return selection.contacts_at_venues(wide, mart, venue_ids)
    if mode == "backfill":
        return selection.contacts_with_entry_date(wide, BACKFILL_ENTRY)
    raise ValueError(f"mode must be one of {CONTACT_MODES}")


def contact_sync(
    mode: str,
    wide: DataFrame,
    mart: DataFrame,
    shows: DataFrame,
    lists: DataFrame,
    mark: Moment,
    as_of: Moment,
    venue_ids: Sequence[str] = (),
    null_text: str = "",
) -> tuple[DataFrame, DataFrame]:
    """(push plan, payloads of the ready contacts). Boundary runs attach no lists."""
    chosen = contact_selection(mode, wide, mart, shows, mark, as_of, venue_ids)
    with_list = mode != "boundary"
    return (
        payloads.contact_push_plan(chosen, lists, with_list),
        payloads.contact_payloads(chosen, lists, null_text=null_text, with_list=with_list),
    )


def order_push(
    lines: DataFrame,
    link: DataFrame,
    connections: DataFrame,
    crm_customers: DataFrame,
    numeric: bool = False,
) -> DataFrame:
    """Order payloads with their action, for orders whose customer the CRM knows.

    ``crm_customers`` is (connection, email, crm_customer_id), the outcome of pushing
    the customer payloads.
    """
    grouped = payloads.group_order_lines(lines)
    placed = with_venue_lookup(grouped, connections, "venue_id", "connection").where("mapped").drop("mapped")
    known = placed.join(crm_customers, ["connection", "email"])
    return payloads.order_payloads(plan_order_push(known, link), numeric)


def order_sync(
    mart: DataFrame,
    link: DataFrame,
    connections: DataFrame,
    crm_customers: DataFrame,
    mark: Moment,
    upper: Moment,
    venue_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Daily run: orders entered since the mark."""
    changed = selection.changed_orders(mart, mark, upper, venue_ids)
    return order_push(changed, link, connections, crm_customers)


def order_resync(
    mart: DataFrame,
    link: DataFrame,
    connections: DataFrame,
    crm_customers: DataFrame,
    cutoff: Moment,
    venue_ids: Sequence[str] | None = None,
    batch_size: int = ORDERS_PER_BATCH,
) -> DataFrame:
    """Historical run: numeric payloads, numbered in batches per venue."""
    lines = selection.historical_orders(mart, cutoff, venue_ids)
    pushed = order_push(lines, link, connections, crm_customers, numeric=True)
    return with_batch_id(pushed, "venue_id", ["orderNumber", "email"], batch_size)


def mobile_sync(
    subscribers: DataFrame, crm_contacts: DataFrame, mark: Moment | None = None, as_of: Moment | None = None
) -> DataFrame:
    """Payloads of the opt-in conflicts that have a decision."""
    return payloads.mobile_payloads(
        optin.resolve_optin(optin.optin_conflicts(subscribers, crm_contacts, mark, as_of))
    )


def tag_sync(
    subscribers: DataFrame,
    messages: DataFrame,
    tag_map: DataFrame,
    existing_tags: DataFrame,
    mark: Moment | None = None,
    as_of: Moment | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(contact tags, tags to create first); without a mark the whole backlog."""
    if mark is None:
        wanted = tags.backlog_tags(subscribers, messages, tag_map)
    else:
        if as_of is None:
            raise ValueError("a mark needs an as_of")
        wanted = tags.daily_tags(subscribers, messages, tag_map, mark, as_of)
    return wanted, tags.missing_tags(wanted, existing_tags).select(F.col("tag"))
