"""Orders rolled up by customer and purchase day, with running totals; a window of days is two lookups.

:func:`day_rollup` sums each customer's orders per purchase day and carries running totals over
the days in order. The total of any range of days [low, high] is then the running total at the
last day up to ``high`` minus the one at the last day before ``low``: :func:`recency_from_rollup`
takes both as maxima of (day, totals) structs in one aggregate over the rollup, for every window
at once, without reading an order again. The rollup is built once and serves every evaluation day.

A customer's window partition holds one row per distinct purchase day, so it is bounded by the
calendar, not by the customer's orders: a customer with a third of all orders still has at most a
few thousand rows there. Orders without a purchase day count in no window but keep their customer
in the result; a NULL email is a customer of its own, as in :func:`features.recency_spend`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.functions import whole_units
from ticketlens.semantics import RECENCY_WINDOWS, Moment, days_before, first_day_from, last_day_until

KEY = "subscriber_key"
DAY = "day"
# Per-day sums that are carried as running totals.
TOTALS = ["paid_total", "paid_total_n", "paid_n", "comp_n"]


def day_rollup(orders: DataFrame) -> DataFrame:
    """One row per (customer, purchase day): the day's sums and the running totals up to it."""
    paid, comp = F.col("not_comped") == 1, F.col("comped") == 1
    per_day = orders.groupBy(F.col("email").alias(KEY), F.col("purchase_date_formatted").alias(DAY)).agg(
        F.sum(F.when(paid, F.col("order_total"))).alias("paid_total"),
        F.count_if(paid & F.col("order_total").isNotNull()).alias("paid_total_n"),
        F.count_if(paid).alias("paid_n"),
        F.count_if(comp).alias("comp_n"),
    )
    running = Window.partitionBy(KEY).orderBy(DAY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dated = F.col(DAY).isNotNull()
    return per_day.select(
        KEY, DAY, *[F.coalesce(F.sum(F.when(dated, F.col(c))).over(running), F.lit(0)).alias(f"cum_{c}") for c in TOTALS]
    )


def recency_from_rollup(rollup: DataFrame, as_of: Moment, windows: Sequence[int] = RECENCY_WINDOWS) -> DataFrame:
    """As :func:`features.recency_spend`: paid revenue, paid and complimentary orders per window."""
    cums = [f"cum_{c}" for c in TOTALS]
    at = lambda cond: F.max(F.when(cond, F.struct(DAY, *cums)))  # noqa: E731 - totals at the last day meeting cond
    high = F.lit(last_day_until(as_of))
    lows = {days: F.lit(first_day_from(days_before(as_of, days))) for days in windows}
    looked = rollup.groupBy(KEY).agg(
        at(F.col(DAY) <= high).alias("_upto"), *[at(F.col(DAY) < low).alias(f"_before_{d}") for d, low in lows.items()]
    )
    columns = []
    for days in windows:
        within = lambda c: F.coalesce(F.col(f"_upto.cum_{c}"), F.lit(0)) - F.coalesce(F.col(f"_before_{days}.cum_{c}"), F.lit(0))  # noqa: E731, B023
        columns += [
            whole_units(F.when(within("paid_total_n") > 0, within("paid_total"))).alias(f"paid_orders_revenue_{days}"),
            within("paid_n").alias(f"paid_orders_count_{days}"),
            within("comp_n").alias(f"comp_orders_count_{days}"),
        ]
    return looked.select(KEY, *columns)
