"""Packing of token sequences into padded batches by optimal length buckets.

The lengths of all pieces give one global histogram; dynamic programming chooses the bucket
boundaries that minimise the padding, and inside each bucket consecutive pieces form batches that
hold a budget of padded tokens. Sequences over ``max_len`` tokens are cut into full pieces and a
rest, so the histogram has at most ``max_len`` entries whatever the input.

Edge cases: a null or empty text is one piece that holds only the end token; ties in padding go to
the smaller boundary; repeated rows are packed as often as they occur; an empty table gives no rows;
null ids are packed like any other.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import BLANKS, store

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 65_536
# Rows that one task numbers, about.
PART_ROWS = 100_000


def count_words(text: str) -> Column:
    """Words between ASCII white space, and one end token: the length of a text in tokens."""
    one = F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[{BLANKS}]+", " "))
    words = F.octet_length(one) - F.octet_length(F.replace(one, F.lit(" "), F.lit(""))) + F.when(one == "", 0).otherwise(1)
    return (words + 1).cast("long")


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The at most ``buckets`` upper bounds with the least padding for the lengths counted.

    With cost(i, j) the padding of lengths i..j in one bucket, best[k][j] is the least over i of
    best[k-1][i] + cost(i, j); bounds are lengths that occur, and the last is the longest.
    """
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.float64)
    many, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    m = len(lengths)
    best, back = np.full(m + 1, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, m)):
        now, origin = best.copy(), np.full(m + 1, -1)  # -1: no further bucket used
        for j in range(1, m + 1):
            cost = best[:j] + (many[j] - many[:j]) * lengths[j - 1] - (total[j] - total[:j])
            i = int(np.argmin(cost))
            if cost[i] < now[j]:
                now[j], origin[j] = cost[i], i
        best = now
        back.append(origin)
    bounds, j = [], m
    for origin in reversed(back):
        if j and origin[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(origin[j])
    return bounds[::-1]


def pack(
    docs: DataFrame,
    length: Column,
    id_col: str = "doc_id",
    max_len: int = MAX_LEN,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start`` and ``length`` in tokens, ``bucket`` (its padded
    length) and ``batch_id``, unique over all buckets.

    Batches of a bucket hold budget // bucket pieces (one at least), all but its last exactly. The
    numbering is by hash part and running count over the parts: no task sees a whole bucket.
    """
    # A row tag fixed by the stored table: rows of a NULL or repeated id spread over the parts as well.
    sized = store(docs.select(F.col(id_col).alias("id"), length.alias("n"), F.monotonically_increasing_id().alias("_row")), "lengths")
    pieces = (
        sized.withColumn("piece", F.explode(F.expr(f"sequence(0L, greatest(0L, (n - 1) div {max_len}))")))
        .withColumn("start", F.col("piece") * max_len)
        .select("id", "_row", "piece", "start", F.least(F.lit(max_len), F.col("n") - F.col("start")).cast("long").alias("length"))
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bounds = boundaries(histogram, buckets)
    fits = [F.when(F.col("length") <= b, F.lit(b).cast("long")) for b in bounds]
    bucket = F.coalesce(*fits, F.lit(None).cast("long"))
    parts = max(16, 1 << (sum(histogram.values()) // PART_ROWS).bit_length())
    dealt = pieces.withColumns(
        {"bucket": bucket, "part": F.pmod(F.xxhash64("id", "_row", "piece"), F.lit(parts)).cast("int")}
    )
    # Numbers per (bucket, part): a few rows per task, which a window over the parts can add up.
    sizes = dealt.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("id", "_row", "piece", "length")) - 1
    per_batch = {b: max(1, budget // b) for b in bounds}
    held = [sum(n for size, n in histogram.items() if low < size <= b) for low, b in zip([0, *bounds], bounds)]
    first = dict(zip(bounds, accumulate((-(-n // per_batch[b]) for b, n in zip(bounds, held)), initial=0)))

    def of_bucket(table: dict[int, int]) -> Column:
        return F.coalesce(*[F.when(F.col("bucket") == b, F.lit(table[b]).cast("long")) for b in bounds], F.lit(1).cast("long"))

    numbered = dealt.withColumn("rank", rank).join(offsets, ["bucket", "part"])
    batch = of_bucket(first) + F.floor((F.col("before") + F.col("rank")) / of_bucket(per_batch)).cast("long")
    return numbered.select(F.col("id").alias(id_col), "piece", "start", "length", "bucket", batch.alias("batch_id"))
