"""Tables on Parquet: scan, full refresh, append and complete versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_table(
    spark: SparkSession, path: str, schema: StructType | None = None, where: Column | str | None = None
) -> DataFrame:
    """Scan a Parquet table; the predicate and the columns used later reach the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if where is None else df.where(where)


def load_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str | int,
    upper: str | int,
    partitions: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a database table in parallel ranges; Spark pushes filters and columns down."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a derived table. ``df`` must not read ``path``; see :func:`write_version`."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever storage it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions: those whose job left its success marker."""
    pattern, files = _hadoop_path(spark, f"{root}/version=*/_SUCCESS")
    markers = files.globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in markers)


def table_exists(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def read_version(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """The newest complete version; with a schema, an empty table before the first.

    Tables that upserts keep in buckets are read through their newest manifest, tables that streams
    keep as a delta log by merging their deltas on read.
    """
    from ticketlens.sources import buckets, deltas

    if deltas.is_log(spark, root):
        table = deltas.read_merged(spark, root)
        return table if schema is None else table.select(*schema.fieldNames())
    if buckets.is_bucketed(spark, root):
        table = buckets.read_table(spark, root)
        return table if schema is None else table.select(*schema.fieldNames())
    versions = _versions(spark, root)
    if versions:
        return load_table(spark, f"{root}/version={versions[-1]}", schema)
    if schema is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.createDataFrame([], schema)


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version next to the current one and return its number.

    The old version stays readable while the new one is computed from it, and a job
    that dies leaves no success marker, so readers never see half a table. One
    writer per table.
    """
    versions = _versions(df.sparkSession, root)
    number = versions[-1] + 1 if versions else 0
    df.write.mode("overwrite").parquet(f"{root}/version={number}", partitionBy=list(partition_by) or None)
    return number


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` complete versions; returns the deleted numbers.

    Keep as many as the longest-running reader needs.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    expired = _versions(spark, root)[:-keep]
    for number in expired:
        folder, files = _hadoop_path(spark, f"{root}/version={number}")
        files.delete(folder, True)
    return expired


def write_skippable(df: DataFrame, path: str, key: str, files: int, bloom: Sequence[str] = (), group_bytes: int = 128 << 20) -> None:
    """Write ``df`` so that a filter on ``key`` (or on a ``bloom`` column) reads little of it.

    Rows are range-partitioned on ``key`` into ``files`` files and sorted inside each, so every
    file and row group covers a narrow key range: the Parquet reader skips row groups whose
    min/max exclude an equality or range filter on ``key``. Columns in ``bloom`` get a Parquet
    Bloom filter per row group, which skips groups for equality filters on unsorted columns as
    well. Results are the same as of any other layout; only what is read changes.
    """
    writer = df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
    writer = writer.option("parquet.block.size", group_bytes)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def scan_rows(df: DataFrame) -> int:
    """Rows the Parquet scans of an executed ``df`` handed on (after row-group skipping, before filters)."""
    plan = df._jdf.queryExecution().executedPlan()
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet") or "FileSourceScan" in node.getClass().getSimpleName():
            total += int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return total
