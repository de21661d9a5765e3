"""Tables stored in hash buckets of one key, so that joins and aggregates on that key need no shuffle.

``bucketBy`` + ``sortBy`` write every table of a family into the same number of buckets of the
same key: a join or a group-by of two such tables on that key reads bucket i of both in task i,
without an exchange, and the sort inside each bucket lets a sort-merge join skip its sort. The
files live below the shared folder (``spark.checkpoint.dir``) and are registered in the session's
catalog under ``name``, which is how Spark finds their bucketing when they are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ticketlens.sources.scratch import scratch_dir


def write_colocated(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` in ``buckets`` buckets of ``key``, sorted by it, as table ``name``; return it read back.

    Rows with a NULL key share one bucket. An existing table ``name`` is replaced.
    """
    if buckets < 1:
        raise ValueError("at least one bucket")
    path = scratch_dir(df.sparkSession, f"colocated-{name}")
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
