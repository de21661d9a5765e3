"""One query per operator over its whole table, with the columns that are compared."""

from __future__ import annotations

import hashlib
import json
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import (
    alignment,
    bpe,
    chat,
    digests,
    lines,
    packing,
    pq_bpe,
    quality,
    repair,
    simhash,
    suffix_tree,
    token_counts,
    vectors,
)
from ticketlens.llm.common import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.95)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), packing.count_words("text"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    told = _table(spark, sf_dir, "conversations").select("conv_id", rows.alias("payload"))
    said = "</s>[INST] ok [/INST]"
    record = {"messages": [{"role": "user", "content": said}, {"role": "assistant", "content": said}]}
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(json.dumps(record)).alias("payload"))
    turns = chat.canonical_turns(told.union(extra), "conv_id")
    return chat.digests(chat.format_turns(turns), "conv_id")


def op5_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or _tokenizer("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(spark, F.col("ids"), path), 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    count = token_counts.token_count(spark, "text", path or _tokenizer("byte_bpe_50k.json"))
    counted = docs.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), count.alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def _edited(triples: list[tuple]) -> list[list]:
    """Digests of each text, of the text with its second half replaced, and of the next text."""
    kept = [len(text) - len(text) // 2 for _, text, _ in triples]
    edited = [(text[:k] + after[: len(text) - k]).encode() for (_, text, after), k in zip(triples, kept)]
    own = [digests.digest(text.encode()) for _, text, _ in triples]
    changed = [digests.digest(text) for text in edited]
    following = [digests.digest(after.encode()) for *_, after in triples[-1:]]
    following = [*own[1:], *following] if all(a[2] == b[1] for a, b in zip(triples, triples[1:])) else [
        digests.digest(after.encode()) for *_, after in triples
    ]
    return [
        [id_ for id_, *_ in triples],
        [len(text) for _, text, _ in triples],
        [hashlib.sha256(text).hexdigest() for text in edited],
        own,
        changed,
        digests.likenesses(own, changed).tolist(),
        digests.likenesses(own, following).tolist(),
    ]


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return digests.map_with_next(docs, _edited, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return done.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), gone AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN gone ON lines.key = gone.key
GROUP BY doc_id
"""


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    """Learned from the labelled rows of the training folds; ``n_chars`` is the metadata."""
    return quality.train(
        docs, _table(spark, sf_dir, "labels"), metadata=("n_chars",), where=remainder("doc_id", 3) != 1, max_rows=quality.MAX_ROWS
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model(spark, sf_dir, docs)
    scored = docs.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), quality.score(model, "text", "n_chars").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.align(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(_table(spark, sf_dir, "conversations"))


def op13_pq_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or _tokenizer("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pq_bpe.decode(pq_bpe.encode(docs, path, out="_ids"), path, "_ids", out="_decoded")
    return coded.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_tokens"),
        F.sha2(pq_bpe.le_uint32(F.col("_ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return {**named, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op9_line_dedup": OP9_SQL}
