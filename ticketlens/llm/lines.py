"""Removal of lines that many documents share, with built-in Spark functions only.

Lines become 128-bit hashes of their keys. The hashes are range-partitioned together with document
and position and sorted within partitions, so a stream over each partition sees the first line of
every (hash, document) next to its repeats and a hot hash simply spans several partitions. Counts
of first lines say which hashes repeat; what comes back is a bitmap of lines per document, and only
documents' own rows are ever put together with their text.

Edge cases: a null or empty text is one empty line; lines that are blank have no key and always
stay; a key repeated within one document counts once; equal rows (same id and text) are one
document; null ids are treated as any other id. A document that loses all its lines keeps its row
with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import BLANKS, discard, store

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DOC = ["_id", "_text_hash"]
_KEY = ["_h1", "_h2"]
# Lines per range partition, about; partitions grow in number, not in size.
PARTITION_LINES = 500_000


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else; texts that are all ASCII take the fast function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _document(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text_hash")]


def drop_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep_first: bool = False
) -> DataFrame:
    """One row per document that loses lines: ``_id``, ``_text_hash``, ``n_dropped`` and ``words``.

    ``words`` is the compressed keep bitmap: (word, bits) for every 64 lines of which some go, in
    order, a set bit for a line that goes; lines in no word stay. A line goes if its key is in at
    least ``min_docs`` documents; with ``keep_first`` the first of them, by id and position, stays.
    """
    spark = docs.sparkSession
    exploded = (
        docs.select(*_document(id_col, text_col), F.posexplode(_lines(text_col)).alias("_pos", "_line"))
        .select(*_DOC, "_pos", line_key(F.col("_line")).alias("_key"))
        .where("_key <> ''")
        .select(*_DOC, "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    lines = store(exploded, "lines")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines.count() // PARTITION_LINES)
    dealt = lines.repartitionByRange(parts, *_KEY, *_DOC, "_pos").sortWithinPartitions(*_KEY, *_DOC, "_pos")
    # The hashes with their documents are a prefix of the sort; a (hash, document) that straddles
    # two partitions is met again by the distinct count, which combines before it shuffles.
    firsts = dealt.groupBy(*_KEY, *_DOC).agg(F.min("_pos").alias("_pos"))
    common = (
        firsts.groupBy(*_KEY)
        .agg(F.count("*").alias("_n"), F.min(F.struct("_id", "_text_hash", "_pos")).alias("_first"))
        .where(F.col("_n") >= min_docs)
    )
    common = store(common.select(*_KEY, *(["_first"] if keep_first else [])), "common")
    gone = lines.join(common, _KEY, "inner" if keep_first else "left_semi")
    if keep_first:
        gone = gone.where(~F.struct("_id", "_text_hash", "_pos").eqNullSafe(F.col("_first")))
    words = (
        gone.groupBy(*_DOC, F.expr("_pos div 64").cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, _pos % 64))").alias("bits"))
        .groupBy(*_DOC)
        .agg(
            F.sum(F.bit_count("bits")).alias("n_dropped"),
            F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"),
        )
    )
    stored = store(words, "bitmaps")
    discard(lines, common)
    return stored


def _dense(words: Column) -> Column:
    """The bitmap's words with the missing ones filled in, so that a lookup is one array access."""
    before = F.concat(F.array(F.lit(-1)), F.transform(words, lambda w: w["word"]))
    return F.flatten(
        F.transform(
            words,
            lambda w, i: F.concat(F.array_repeat(F.lit(0).cast("long"), w["word"] - F.get(before, i) - 1), F.array(w["bits"])),
        )
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_kept``, ``_n_lines`` and ``_n_dropped``; all other columns as they were."""
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)],
                        *_document(id_col, text_col))
    marks = bitmaps.select(F.col("_id").alias("_mid"), F.col("_text_hash").alias("_mhash"), "n_dropped", _dense(F.col("words")).alias("_bits"))
    joined = keyed.join(
        marks.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_mid")) & (F.col("_text_hash") == F.col("_mhash")), "left"
    )
    at = docs.columns.index(text_col)
    text = F.coalesce(F.col(f"in_{at}"), F.lit(""))

    def stays(_, i):
        return F.coalesce(F.get("_bits", F.shiftright(i, 6)), F.lit(0).cast("long")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)))
        ) == 0

    kept = F.when(F.col("_bits").isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))
    return joined.select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)],
        kept.alias("_kept"),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("_n_dropped"),
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep_first: bool = False
) -> DataFrame:
    """``docs`` with the shared lines taken out of the text (``_kept``, ``_n_lines``, ``_n_dropped``)."""
    return apply_bitmaps(docs, drop_bitmaps(docs, id_col, text_col, min_docs, keep_first), id_col, text_col)
