"""Numbered batches of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.operators.skew import join_on_keys
from ticketlens.semantics import ORDERS_PER_BATCH


def with_batch_id(
    df: DataFrame,
    venue: str,
    order: list[str],
    size: int = ORDERS_PER_BATCH,
    bucket_digits: int = 3,
) -> DataFrame:
    """Adds ``batch_id``: per venue 0, 1, 2, …, each of exactly ``size`` keys but the last.

    A key is a distinct value of the ``order`` columns within a venue; rows of one
    key share a batch; NULL is a value like any other. Batches follow the keys' MD5, which is as arbitrary as batch
    membership may be, but repeatable, and spreads any keys evenly: the leading
    digits cut each venue into 16**bucket_digits buckets, a running count over the
    buckets gives each its first position, and only the rows of one bucket are ever
    numbered together. No task sees a whole venue.
    """
    if not 1 <= bucket_digits <= 8:
        raise ValueError("bucket_digits must be between 1 and 8")
    text = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in order])
    digest = F.md5(text.cast("binary"))
    keys = (
        df.select(venue, *order)
        .distinct()
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.left("_digest", F.lit(bucket_digits)))
    )
    counts = keys.groupBy(venue, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(venue).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        venue, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(venue, "_bucket").orderBy("_digest", *order)
    numbered = keys.withColumn("_position", F.row_number().over(within))
    placed = join_on_keys(numbered, starts, [venue, "_bucket"], "inner").select(
        venue, *order, F.floor((F.col("_start") + F.col("_position") - 1) / size).alias("batch_id")
    )
    return join_on_keys(df, placed, [venue, *order], "inner")
