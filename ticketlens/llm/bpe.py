"""Byte-level BPE encoding by overlapping chunks, and decoding.

Long texts are cut into chunks that overlap; every chunk is cut into pre-tokens and encoded on its
own, in any task. Where the pre-token boundaries of two neighbours agree inside their overlap, both
go on alike, since a pre-token depends only on the text after its start: the chunks are stitched
there. Should an overlap hold no common boundary (one pre-token longer than it), the text is walked
from the last sure boundary until it meets one. Decoding concatenates the tokens' bytes.

Edge cases: null and empty texts have no ids; ids outside the vocabulary cannot be decoded and
raise; repeated rows and null ids of rows are encoded like any other, one output row per input row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches
from ticketlens.llm.merges import _PRE, SYMBOL, Merger, Merges, from_ranks, pre_tokens

CHUNK = 1 << 15
OVERLAP = 1 << 10
SOME = 256
# A match that ends this many characters before the end of a chunk does not depend on what follows.
_SURE = 3


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(id, ``ids``) for every row; ``path`` is a rank file, read here and sent along."""
    spark = docs.sparkSession
    bounded_batches(spark)
    merges, _ = from_ranks(path)
    shared = spark.sparkContext.broadcast((merges.byte_ids, merges.keys, merges.ranks, merges.results))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short, long = texts.where(F.char_length("text") <= chunk), texts.where(F.char_length("text") > chunk)

    def whole(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = Merger(Merges(*shared.value))
        for array in arrays:
            parts = []
            for at in range(0, len(array), SOME):  # few texts at a time keep the worker small
                cut = [_PRE.findall(t) for t in array[at : at + SOME].to_pylist()]
                known = merger.symbols(cut)
                parts.append(_id_lists([b"".join(map(known.__getitem__, pieces)) for pieces in cut]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text, row = text.as_py(), batch.slice(i, 1)
                for k, start in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [row.column("row"), row.column("id"), pa.array([k]), pa.array([text[start : start + chunk + overlap]])],
                        ["row", "id", "k", "text"],
                    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(Merges(*shared.value))
        for batch in batches:
            starts, sizes, ids = [], [], []
            for text in batch.column("text"):
                found = list(chain.from_iterable(pre_tokens(text.as_py())))
                known = merger.symbols([found])
                symbols = [known[p] for p in found]
                lengths = np.fromiter(map(len, found), np.int32, len(found))
                starts.append((np.cumsum(lengths, dtype=np.int32) - lengths).tobytes())
                sizes.append((np.fromiter(map(len, symbols), np.int32, len(symbols)) // SYMBOL).astype(np.int32).tobytes())
                ids.append(b"".join(symbols))
            extra = [_id_lists(x) for x in (starts, sizes, ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "starts", "sizes", "ids"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        arrays = {c: [x.values.to_numpy() for x in table.column(c)] for c in ("starts", "sizes", "ids")}
        rows = [dict(zip(("text", *arrays), row)) for row in zip(table.column("text").to_pylist(), *arrays.values())]
        found = stitch(rows, chunk, Merger(Merges(*shared.value)))
        return pa.table({"id": table.column("id").combine_chunks().slice(0, 1), "ids": _id_lists([found.tobytes()])})

    id_type = texts.schema["id"].dataType.simpleString()
    chunks = long.withColumn("row", F.monotonically_increasing_id()).mapInArrow(cut, f"row long, id {id_type}, k long, text string")
    encoded = chunks.repartition("row", "k").mapInArrow(
        pieces, f"row long, id {id_type}, k long, text string, starts array<int>, sizes array<int>, ids array<int>"
    )
    stitched = encoded.groupBy("row").applyInArrow(join, f"id {id_type}, ids array<int>")
    plain = short.select("id", F.arrow_udf(whole, "array<int>")("text").alias("ids"))
    return plain.union(stitched).withColumnRenamed("id", id_col)


def _id_lists(rows: list[bytes]) -> pa.Array:
    """Rows given as the bytes of int32 arrays, as one array of lists."""
    offsets = np.cumsum([0, *map(len, rows)]) // SYMBOL
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def stitch(rows: list[dict], chunk: int, merger: Merger) -> np.ndarray:
    """Ids of one text from its chunks in order (``text``, and arrays ``starts``, ``sizes``, ``ids``)."""
    full = "".join(r["text"][:chunk] for r in rows[:-1]) + rows[-1]["text"]
    starts = [np.asarray(r["starts"], np.int64) + i * chunk for i, r in enumerate(rows)]
    tokens = [np.concatenate([[0], np.cumsum(np.asarray(r["sizes"], np.int64))]) for r in rows]
    ends = [i * chunk + len(r["text"]) for i, r in enumerate(rows)]
    out = [np.empty(0, np.int32)]
    pos, k = 0, 0
    while pos < len(full):
        at = int(np.searchsorted(starts[k], pos))
        last = k == len(rows) - 1
        if at < len(starts[k]) and starts[k][at] == pos:
            if last:
                out.append(rows[k]["ids"][tokens[k][at] :])
                break
            sure = starts[k][(starts[k] >= pos) & (starts[k] <= ends[k] - _SURE)]
            common = np.intersect1d(sure, starts[k + 1], assume_unique=True)
            to = int(common[0]) if len(common) else int(sure[-1]) if len(sure) else pos
            until = int(np.searchsorted(starts[k], to))
            out.append(rows[k]["ids"][tokens[k][at] : tokens[k][until]])
            pos = to
            if len(common):
                k += 1
                continue
        piece = _PRE.match(full, pos).group()  # no boundary in common: walk on
        out.append(np.frombuffer(merger.symbols([[piece]])[piece], np.int32))
        pos += len(piece)
        while k < len(rows) - 1 and pos >= ends[k] - _SURE:
            k += 1
    return np.concatenate(out)


def decode(spark: SparkSession, ids: str | Column, path: str) -> Column:
    """The bytes that an array of ids stands for (null or empty arrays: empty bytes)."""
    tokens = from_ranks(path)[1]
    blob = np.frombuffer(b"".join(tokens), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    shared = spark.sparkContext.broadcast((blob, offsets))

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blob, offsets = shared.value
        for array in arrays:
            yield gather_bytes(array, blob, offsets)

    return F.arrow_udf(run, "binary")(ids)


def gather_bytes(array: pa.Array, blob: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Per list of ids, its tokens' bytes joined: one gather from ``blob`` for the whole batch."""
    found = array.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(found) and (found.min() < 0 or found.max() >= len(offsets) - 1):
        raise ValueError("an id lies outside the vocabulary")
    sizes = offsets[found + 1] - offsets[found]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets[found] - (ends - sizes), sizes)
    per_row = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False))])
    rows = np.concatenate([[0], ends])[per_row.astype(np.int64)]
    data = blob[at].tobytes()
    return pa.Array.from_buffers(pa.binary(), len(array), [None, pa.py_buffer(rows.astype(np.int32)), pa.py_buffer(data)])
