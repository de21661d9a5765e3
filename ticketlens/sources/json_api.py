"""Readers for landed API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ticketlens.schemas import CATALOG_JSON, LANDED_ORDER_JSON, SHOW_JSON


def read_orders_json(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """Orders landed as ``root/venue_id=…/show_id=…/*.json``, one array of orders per file.

    ``lines=True`` reads one order per line instead; such files can be split between tasks.
    """
    return spark.read.schema(LANDED_ORDER_JSON).json(root, multiLine=not lines)


def read_catalog_json(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """Venue catalogues landed as ``root/venue_id=…/*.json``."""
    return spark.read.schema(CATALOG_JSON).json(root, multiLine=not lines)


def read_show_json(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """Show details landed as ``root/show_id=…/*.json``."""
    return spark.read.schema(SHOW_JSON).json(root, multiLine=not lines)


CORRUPT = "_corrupt_record"
SOURCE = "_source_file"
STATUS = "_status"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def read_quarantined(spark: SparkSession, root: str, schema: StructType, out: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read landed JSON, keeping records that cannot be read apart instead of failing or dropping them.

    Every record is written once below ``out``, in ``_status=good`` or ``_status=bad``, by one
    job: good rows in ``schema`` plus their source file, bad rows as their raw text
    (``_corrupt_record``) and source file. In the array-per-file form a file that is no valid
    array is one bad row holding the whole file. Returns (good, bad), read back from ``out``;
    either may be empty. Spark gives no line offset inside a file: the file names the place.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    raw = (
        spark.read.schema(wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(root, multiLine=not lines)
    )
    tagged = raw.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE),
        F.when(F.col(CORRUPT).isNull(), "good").otherwise("bad").alias(STATUS),
    )
    # Both statuses are open at once, so that no task sorts (and spills) its documents by status first.
    writers = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "2")
    try:
        tagged.write.partitionBy(STATUS).parquet(out, compression="zstd")
    finally:
        spark.conf.set(_WRITERS, writers)
    stored = spark.read.schema(tagged.schema).parquet(out)
    good = stored.where(F.col(STATUS) == "good").drop(CORRUPT, STATUS)
    bad = stored.where(F.col(STATUS) == "bad").select(CORRUPT, SOURCE)
    return good, bad


def quarantine_report(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Per source file: records read and records quarantined."""
    counted = good.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("good")).join(
        bad.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("bad")), SOURCE, "full"
    )
    return counted.select(SOURCE, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
