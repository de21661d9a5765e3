"""Helpers that keep one huge key from landing in one task.

Aggregates over a hot key are safe on their own: Spark combines before the shuffle.
Two cases need more:

* A join of two scanned or shuffled tables is split at run time by adaptive
  execution. It cannot do so where one side is an aggregate or join of its own, so
  such sides meet hot keys through :func:`lookup_join`.
* Picking rows of a key: :func:`pick_row` limits each key before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key set of at most this many rows is sent to every task; beyond it, shuffled.
BROADCAST_ROWS = 200_000
# A key is hot with more rows than this and more than a thousandth of all rows.
HOT_ROWS = 1_000_000
HOT_KEYS = 1000
# Keys that one frequency sketch keeps, and sketches that are merged side by side.
_SKETCH_KEYS = 4 * HOT_KEYS
_SKETCH_GROUPS = 256


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``max_rows`` rows; a plain count, which combines before its exchange."""
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a count shows that the rows fit; runs that count."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on NULL-safe equality of the keys; the right side's keys are not kept.

    The right keys are renamed first, so both sides may come from one table.
    """
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    equal = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, equal, how).drop(*[f"_right_{key}" for key in keys])


def hot_keys(df: DataFrame, key: str) -> list:
    """The hot values of ``key``, NULL included, at most ``HOT_KEYS`` of them.

    Runs one pass over the key column with a frequency sketch per task: no key is
    shuffled, and the sketches are merged in two steps. The counts are estimates,
    which is enough to route rows by.
    """
    row = (
        df.select(F.col(key).alias("key"), (F.spark_partition_id() % _SKETCH_GROUPS).alias("part"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(key, {_SKETCH_KEYS})").alias("sketch"))
        .groupBy(F.lit(1).alias("all"))  # a grouped aggregate, which may be empty
        .agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {_SKETCH_KEYS})").alias("sketch"))
        .selectExpr("n", f"approx_top_k_estimate(sketch, {HOT_KEYS}) AS top")
        .first()
    )
    if row is None:
        return []
    bound = max(HOT_ROWS, row["n"] // 1000)
    return [entry["item"] for entry in row["top"] if entry["count"] > bound]


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", keys_from: DataFrame | None = None
) -> DataFrame:
    """Join (inner, left or left_semi) with a side that has at most one row per key.

    Rows of hot keys, and unmatched NULL keys if they are many, stay where they are and
    meet the few right rows of those keys by broadcast; all other rows join as usual.
    Every row takes exactly one of the two ways. Looks for hot keys first (one job), in
    ``keys_from`` where an earlier, cheaper form of ``left`` has the same key column.
    """
    hot = hot_keys(left if keys_from is None else keys_from, key)
    if not hot:
        return left.join(right, key, how)
    values = [value for value in hot if value is not None]
    is_hot = F.coalesce(F.col(key).isin(values), F.lit(None in hot))
    few = F.broadcast(right.where(F.col(key).isin(values)))
    cold = left.where(~is_hot).join(right, key, how)
    return cold.unionByName(left.where(is_hot).join(few, key, how))


def semi_on(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` occurs in ``keys[key]``; ``df`` has few rows per value.

    The key side is reduced to distinct values first: a semi join cannot split a
    hot value on its right side, but the distinct collapses it before the shuffle.
    """
    return df.join(_distinct_keys(keys, on, key), on, "left_semi")


def semi_on_dimension(df: DataFrame, dim: DataFrame, on: str, key: str) -> DataFrame:
    """As :func:`semi_on` for a fact table, whose values may be hot, and a dimension.

    A dimension counted as small is broadcast, a large one meets the facts by
    :func:`lookup_join`.
    """
    wanted = _distinct_keys(dim, on, key)
    if is_small(wanted):
        return df.join(F.broadcast(wanted), on, "left_semi")
    return lookup_join(df, wanted, on, "left_semi")


def _distinct_keys(keys: DataFrame, on: str, key: str | None) -> DataFrame:
    return keys.select(F.col(key or on).alias(on)).distinct()


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order."""
    return pick_row(df, keys, order, 1)


def pick_row(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits each key to ``n`` rows before the shuffle as well (group limit), so
    a hot key costs ``n`` rows per map task, not its full size.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
