"""From raw documents to padded training batches, in four stages.

Every stage works on all rows its predecessor kept and returns the columns of ``documents``; the
last returns the pieces with their batches. Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import lines, packing, quality, simhash
from ticketlens.llm.common import bounded_batches, store
from ticketlens.llm.queries import quality_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    bounded_batches(spark)
    model = quality_model(spark, sf_dir, docs)
    return docs.withColumn("_score", quality.score(model, "text", "n_chars")).where("_score >= 0.5").drop("_score")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines found in at least ten documents; no document goes, ``n_chars`` follows."""
    columns = docs.columns
    done = lines.dedup_lines(docs, min_docs=10)
    done = done.withColumns({"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("long")})
    return done.select(*columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates.

    Rows that repeat an id are one document, of which the smallest row stays; rows without an id
    cannot be told apart and are all kept.
    """
    found = simhash.near_duplicates(docs, shingle=3, max_bits=3)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    first = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count()
    repeated = store(first.where("count > 1").select("doc_id"), "repeated")
    kept = docs.join(gone, "doc_id", "left_anti")
    if repeated.isEmpty():
        return kept
    others = [c for c in docs.columns if c != "doc_id"]
    again = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("_row"))
    once = kept.join(repeated, "doc_id", "left_anti")
    return once.unionByName(again.select("doc_id", "_row.*"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their length bucket and batch."""
    return packing.pack(docs, packing.count_words("text"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", keep_one_of_group),
    ("packing", pack_batches),
]

# A learned score and SimHash components have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
