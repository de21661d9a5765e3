"""Token counts of texts under a byte-level BPE file, by rank-synchronous array merging.

Texts are cut at the file's added tokens, which count one each, and the rest into pre-tokens; the
distinct new pre-tokens of a batch of texts are merged together as ragged arrays.

Edge cases: null and empty texts have no tokens; texts are counted whole, whatever their length;
repeated rows are counted alike; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches
from ticketlens.llm.merges import BLOCK, SYMBOL, Merger, from_json, pre_tokens


def token_count(spark: SparkSession, text: str | Column, path: str) -> Column:
    """Number of tokens the file at ``path`` gives a text; the file is read here and sent along."""
    bounded_batches(spark)
    merges, added = from_json(path)
    shared = spark.sparkContext.broadcast((merges.byte_ids, merges.keys, merges.ranks, merges.results))
    special = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = Merger(type(merges)(*shared.value))
        for array in arrays:
            counts, waiting, held = [0] * len(array), [], 0
            for i, value in enumerate(array):
                value = value.as_py()
                parts = special.split(value) if special else [value]
                counts[i] += len(parts) - 1
                for part in parts:
                    for block in pre_tokens(part):
                        waiting.append((i, block))
                        held += len(block)
                        if held >= BLOCK:
                            _add(counts, waiting, merger)
                            waiting, held = [], 0
            _add(counts, waiting, merger)
            yield pa.array(counts, pa.int64())

    column = F.col(text) if isinstance(text, str) else text
    return F.arrow_udf(run, "long")(F.coalesce(column, F.lit("")))


def _add(counts: list[int], waiting: list[tuple[int, list[str]]], merger: Merger) -> None:
    known = merger.symbols(block for _, block in waiting)
    for i, block in waiting:
        counts[i] += sum(map(len, map(known.__getitem__, block))) // SYMBOL
