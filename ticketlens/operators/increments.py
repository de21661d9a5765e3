"""Lifetime customer features kept as mergeable partial states, updated from changed orders only.

Every order is one *fact row*: its customer and what it adds to each lifetime feature, with the
show, event, ticket count and line revenue lookups already resolved (:func:`order_facts`). A
customer's *state* is the signed sum of its fact rows: counts and sums, and three maxima (day of
the last complimentary show, newest order as (purchase day, id, phone)). States live in a
bucketed table keyed by customer (:mod:`ticketlens.sources.buckets`).

An increment is two sets of fact rows: ``removed`` (the old versions of changed or deleted orders)
and ``added`` (new and changed orders as they are now). Both are aggregated per customer *before*
any shuffle (partial aggregation combines a hot customer inside each task), the aggregate meets
the stored states of only the buckets it touches, sums add, maxima take the larger. A maximum
cannot be retracted by subtraction: where a removed row's value reaches the stored maximum, the
customer is *dirty* and its state is summed again from ``facts_of(dirty customers)``, i.e. from
its own current orders only. Nothing else is read. The per-customer aggregates of an increment are
written once below the table's root while it runs: several joins read them, and computing them
for each reader would read and join all changed orders again every time.

Features that depend on an evaluation day (recency windows, first/last/next show) are not lifetime
features and are not kept here. Dimension tables (shows, events, counts, line totals) are taken as
one row per key, as the processed tables are; a change of a dimension is an increment of the
orders that use it. Customers whose counts all return to zero keep a state row of zeros and appear
in no feature. NULL customer keys are a customer of their own, as in the full features.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions import whole_units
from ticketlens.operators.marts import line_totals, show_dimension
from ticketlens.operators.skew import join_on_keys
from ticketlens.semantics import WEEKDAY_LETTERS
from ticketlens.sources import buckets

KEY = "subscriber_key"
SIGN = "_sign"
WEEKDAYS = 7
# Fact columns that are summed with the row's sign.
SUMMED = [
    "lead", "lead_days", "lead_days_n", "lead_tickets",
    "paid", "paid_tickets",
    "comp", "comp_tickets",
    "show", *[f"wd_{d}" for d in range(WEEKDAYS)],
    "placed", "special", "presents",
    "spend", "spend_cents", "spend_cents_n",
]
# Fact columns whose maximum is kept; a removed value that reaches it makes the customer dirty.
MAXED = ["comp_day", "newest"]


def order_facts(
    orders: DataFrame,
    shows: DataFrame,
    events: DataFrame,
    counts: DataFrame,
    lines: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per order: customer, order id and number, and its share of every lifetime feature.

    ``counts`` is ``ticket_counts`` (one row per order number), ``lines`` the processed order lines;
    a job that keeps their ``line_totals`` as a table gives ``totals`` instead.
    An order whose show, event or count is missing adds nothing to the features that need them.
    """
    starts = shows.select(F.col("id").alias("show_id"), F.col("start_date_formatted").alias("_start"), F.lit(True).alias("_has_show"))
    places = show_dimension(shows, events).select("show_id", "special_event", "presents_event", F.lit(True).alias("_placed"))
    counted = counts.select("order_number", "tickets", "paid_tickets", "comp_tickets")
    totals = line_totals(lines) if totals is None else totals
    revenue = totals.select("order_number", F.col("line_cents").alias("_cents"), F.lit(True).alias("_has_lines"))
    rows = (
        orders.select(F.col("email").alias(KEY), "id", "order_number", "show_id", "purchase_date_formatted", "phone", "not_comped")
        .join(starts, "show_id", "left")
        .join(places, "show_id", "left")
        .join(counted, "order_number", "left")
        .join(revenue, "order_number", "left")
    )
    has_show = F.coalesce(F.col("_has_show"), F.lit(False))
    placed = F.coalesce(F.col("_placed"), F.lit(False))
    lead = has_show & F.col("tickets").isNotNull()
    days = F.datediff("_start", "purchase_date_formatted")
    comp = has_show & F.col("comp_tickets").isNotNull()
    spend = (F.col("not_comped") == 1) & F.coalesce(F.col("_has_lines"), F.lit(False))
    one = lambda c: c.cast("long")
    return rows.select(
        KEY,
        "id",
        "order_number",
        one(lead).alias("lead"),
        F.when(lead, days).cast("long").alias("lead_days"),
        one(lead & days.isNotNull()).alias("lead_days_n"),
        F.when(lead, F.col("tickets")).alias("lead_tickets"),
        one(F.col("paid_tickets").isNotNull()).alias("paid"),
        F.col("paid_tickets"),
        one(comp).alias("comp"),
        F.when(comp, F.col("comp_tickets")).alias("comp_tickets"),
        one(has_show).alias("show"),
        *[one(has_show & (F.weekday("_start") == d)).alias(f"wd_{d}") for d in range(WEEKDAYS)],
        one(placed).alias("placed"),
        one(placed & (F.col("special_event") == 1)).alias("special"),
        one(placed & (F.col("presents_event") == 1)).alias("presents"),
        one(spend).alias("spend"),
        F.when(spend, F.col("_cents")).alias("spend_cents"),
        one(spend & F.col("_cents").isNotNull()).alias("spend_cents_n"),
        F.when(comp, F.col("_start")).alias("comp_day"),
        F.when(placed, F.struct("purchase_date_formatted", "id", "phone")).alias("newest"),
    )


def _signed(facts: DataFrame, sign: int) -> DataFrame:
    return facts.select(KEY, *SUMMED, *MAXED, F.lit(sign).alias(SIGN))


def partial_states(changes: DataFrame) -> DataFrame:
    """Per customer: signed sums, the largest added and the largest removed value of each maximum."""
    sums = [F.coalesce(F.sum(F.col(c) * F.col(SIGN)), F.lit(0)).alias(c) for c in SUMMED]
    tops = [F.max(F.when(F.col(SIGN) > 0, F.col(c))).alias(c) for c in MAXED]
    gone = [F.max(F.when(F.col(SIGN) < 0, F.col(c))).alias(f"{c}_gone") for c in MAXED]
    return changes.groupBy(KEY).agg(*sums, *tops, *gone)


def states_of(facts: DataFrame) -> DataFrame:
    """States summed from scratch: the initial load, and dirty customers."""
    return partial_states(_signed(facts, 1)).drop(*[f"{c}_gone" for c in MAXED])


def apply_changes(
    spark: SparkSession,
    root: str,
    removed: DataFrame | None,
    added: DataFrame | None,
    facts_of: Callable[[DataFrame], DataFrame],
    buckets_count: int | None = None,
) -> int:
    """Fold one increment into the states at ``root``; returns the new version of the table.

    ``facts_of(keys)`` gives the current fact rows of the customers in ``keys`` (one column
    ``subscriber_key``); it is called for dirty customers only. A first call with no table at
    ``root`` treats the stored states as empty. Empty increments publish nothing.
    """
    parts = [_signed(df, s) for df, s in ((removed, -1), (added, 1)) if df is not None]
    if not parts:
        return -1
    work = f"{root}/staged/{uuid.uuid4().hex}"
    try:
        updates = _updates(spark, root, work, partial_states(reduce(DataFrame.unionByName, parts)), facts_of)
        return buckets.upsert(spark, root, updates, [KEY], updates.schema, buckets=buckets_count)
    finally:
        buckets.delete(spark, work)


def _staged(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _updates(
    spark: SparkSession, root: str, work: str, delta: DataFrame, facts_of: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The new states of the customers in ``delta``; what several joins read is written below ``work``."""
    delta = _staged(spark, f"{work}/delta", delta)
    current = buckets.read_manifest(spark, root)
    if current is None or not current.files:
        stored = spark.createDataFrame([], delta.drop(*[f"{c}_gone" for c in MAXED]).schema)
    else:
        touched = [r[0] for r in delta.select(buckets.bucket_of([KEY], current.buckets).alias("b")).distinct().collect()]
        stored = buckets.read_table(spark, root, buckets=touched)
    s = stored.select(KEY, *[F.col(c).alias(f"s_{c}") for c in SUMMED + MAXED])
    both = join_on_keys(delta, s, [KEY], "left")
    dirty = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{c}_gone") >= F.col(f"s_{c}"), F.lit(False)) for c in MAXED])
    merged = both.select(
        KEY,
        *[(F.coalesce(F.col(f"s_{c}"), F.lit(0)) + F.col(c)).alias(c) for c in SUMMED],
        *[F.greatest(F.col(f"s_{c}"), F.col(c)).alias(c) for c in MAXED],
        dirty.alias("_dirty"),
    )
    merged = _staged(spark, f"{work}/merged", merged)
    clean = merged.where(~F.col("_dirty")).drop("_dirty")
    dirty_keys = merged.where(F.col("_dirty")).select(KEY)
    if dirty_keys.isEmpty():
        return clean
    again = _staged(spark, f"{work}/again", states_of(join_on_keys(facts_of(dirty_keys), dirty_keys, [KEY], "left_semi")))
    # A dirty customer whose orders are all gone sums to nothing: it keeps a row of zeros.
    zeros = join_on_keys(dirty_keys, again.select(KEY), [KEY], "left_anti").select(
        KEY, *[F.lit(0).cast(clean.schema[c].dataType).alias(c) for c in SUMMED], *[F.lit(None).cast(clean.schema[c].dataType).alias(c) for c in MAXED]
    )
    return clean.unionByName(again.select(*clean.columns)).unionByName(zeros)


def _present(states: DataFrame, count: str) -> DataFrame:
    return states.where(F.col(count) > 0)


def lifetime_features(states: DataFrame) -> dict[str, DataFrame]:
    """The lifetime features from stored states, named and shaped as the full operators give them."""
    ratio = lambda a, b: (F.col(a) / F.col(b)).cast("double")
    return {
        "ticket_lead_stats": _present(states, "lead").select(
            KEY,
            F.when(F.col("lead_days_n") > 0, ratio("lead_days", "lead_days_n")).alias("avg_purchase_to_show_days"),
            ratio("lead_tickets", "lead").alias("avg_tickets_per_order"),
        ),
        "lifetime_stats_paid": _present(states, "paid").select(
            KEY,
            F.col("paid").alias("total_lifetime_paid_orders"),
            F.col("paid_tickets").alias("total_lifetime_paid_tickets"),
            ratio("paid_tickets", "paid").alias("avg_tickets_per_paid_order"),
        ),
        "lifetime_stats_comp": _present(states, "comp").select(
            KEY,
            F.col("comp_day").alias("last_comp_show_date"),
            F.col("comp").alias("total_lifetime_comp_orders"),
            F.col("comp_tickets").alias("total_lifetime_comp_tickets"),
            ratio("comp_tickets", "comp").alias("avg_tickets_per_comp_order"),
        ),
        "weekday_attendance": _present(states, "show").select(
            KEY, *[F.col(f"wd_{d}").alias(f"shows_attended_{letter}") for d, letter in enumerate(WEEKDAY_LETTERS)]
        ),
        "special_event_stats": _present(states, "placed").select(
            KEY,
            F.col("newest.phone").alias("phone"),
            F.col("newest.purchase_date_formatted").alias("last_ordered_date"),
            F.col("special").alias("count_shows_special"),
            F.col("presents").alias("count_shows_persents"),
        ),
        "total_spend": _present(states, "spend").select(
            KEY, whole_units(F.when(F.col("spend_cents_n") > 0, F.col("spend_cents"))).alias("total_revenue")
        ),
    }


def changed_orders(
    before: DataFrame, after: DataFrame, key: str = "id", rows: tuple[DataFrame, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``before`` and of ``after`` whose order (by ``key``) differs, is new or is gone.

    With ``rows``, a pair of tables with the same keys such as the stored fact rows of both, the
    rows are taken from these. Keys of equal rows come from a semi join, so repeated rows (or many
    rows without a key) are not paired with each other.
    """
    cols = after.columns
    digest = lambda df: df.select(key, F.unhex(F.sha2(F.to_json(F.struct(*cols)), 256)).alias("_s"))
    same = join_on_keys(digest(before), digest(after), [key, "_s"], "left_semi").select(key)
    return tuple(join_on_keys(df, same, [key], "left_anti") for df in rows or (before, after))
