"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, at which words and lines are cut everywhere in this subpackage.
BLANKS = "\t\n\x0b\f\r "
# Bytes of one Arrow batch between Spark and Python: a few very long texts fill one.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a session without one gets its own (local runs only)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table below the shared folder and read it again.

    Cuts the lineage like ``checkpoint()``, but compressed and by column; a lost executor
    costs a reread, and a join of two such tables can be split at run time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete tables of :func:`store` that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        root = shared_dir(spark).split(":", 1)[-1]
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if root in path:
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches end by size as well, so that long texts do not add up in a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


@contextmanager
def swept_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let each job run inside delete its shuffle files at its end rather than when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def utf8(text: str | Column) -> Column:
    """A text column as bytes, missing texts as empty ones."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``: the folds of the learned operators."""
    return F.crc32(F.col(id_col).cast("string")) % divisor


def label_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges a[i] - b[i]."""
    labels = np.arange(n)
    while len(a):
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        np.minimum.at(labels, before[a], low)
        np.minimum.at(labels, before[b], low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
        if np.array_equal(before, labels):
            break
    return labels


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge: root is the smallest node reachable.

    ``edges`` has two columns of one ordered type; loops and repeats do no harm. Rounds of
    large-star and small-star until nothing changes: each node is joined only with the minimum
    of its neighbourhood, so no neighbourhood is ever collected, and every round is stored.
    """
    a, b = edges.columns
    now = store(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select("v", "u"))
        lows = store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "lows")
        large = store(both.where("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lows_small = store(large.groupBy("u").agg(F.min("v").alias("m")), "lows")
        small = large.join(lows_small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = store(small.union(lows_small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(now, lows, large, lows_small)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
