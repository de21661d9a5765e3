"""BPE encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding.

A pre-token starts as one symbol per byte. Every adjacent pair that the file can merge enters a heap
keyed by (merge rank, position); the lowest entry is applied, its two symbols become one in the
linked list, and the pairs it forms with its neighbours enter the heap. Entries whose symbols have
changed since they were pushed are stale and skipped when they come up. Decoding concatenates the
vocabulary strings of the ids and reads them back as bytes.

Texts are cut at the file's added tokens first (unless ``split_added`` is false, when their strings
are plain text), the rest into pre-tokens by the file's pattern; every worker remembers the ids of
the pre-tokens it has merged, and forgets the older half when that memory is full.

Edge cases: null and empty texts have no ids and decode to ''; texts are encoded whole, whatever
their length; repeated rows, null ids and any other columns pass through, one output row per input
row; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches
from ticketlens.llm.merges import pre_tokens

# Pre-tokens whose ids one worker remembers before it forgets the older half.
MEMORY = 1 << 17


def byte_chars() -> list[str]:
    """The printable character that byte-level files write for each byte: itself, or the next code point from 256 up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b if b in printable else next(shifted)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE file: the byte symbols, the merge table and the bytes of every id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, pre = described["model"], described["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or described["normalizer"]:
            raise ValueError("only plain byte-level BPE files are read")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in described["added_tokens"]):
            raise ValueError("only added tokens without strip or normalisation rules are read")
        vocab: dict[str, int] = model["vocab"]
        back = {c: b for b, c in enumerate(byte_chars())}
        self.byte_ids = [vocab[c] for c in byte_chars()]
        # pair (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[(vocab[a], vocab[b])] = (rank, vocab[a + b])
        size = max([*vocab.values(), *(t["id"] for t in described["added_tokens"])]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        names = sorted(self.added, key=len, reverse=True)  # leftmost, then longest
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None


def merge_piece(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to one pre-token's symbols, lowest rank first and leftmost first on equal rank."""
    n = len(symbols)
    if n < 2:
        return symbols
    sym = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = merges.get((sym[i], sym[i + 1]))
        if found is not None:
            heap.append((found[0], i, sym[i], sym[i + 1], found[1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right, merged = heapq.heappop(heap)
        j = after[i]
        if sym[i] != left or j >= n or sym[j] != right:
            continue  # stale: one of its symbols has been merged since
        sym[i], sym[j] = merged, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        k = before[i]
        if k >= 0:
            found = merges.get((sym[k], merged))
            if found is not None:
                heapq.heappush(heap, (found[0], k, sym[k], merged, found[1]))
        if after[i] < n:
            found = merges.get((merged, sym[after[i]]))
            if found is not None:
                heapq.heappush(heap, (found[0], i, merged, sym[after[i]], found[1]))
    return [s for s in sym if s >= 0]


# Decoded bytes gathered at once; bounds the index arrays of a gather (8 bytes per byte).
GATHER = 1 << 20


class Encoder:
    """Encodes texts of one worker, remembering the ids of pre-tokens as int32 bytes."""

    def __init__(self, vocabulary: Vocabulary, split_added: bool = True) -> None:
        self.v = vocabulary
        self.split = vocabulary.added_pattern if split_added else None
        self.known: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            ids = merge_piece([self.v.byte_ids[b] for b in piece.encode()], self.v.merges)
            found = np.asarray(ids, np.int32).tobytes()
            if len(self.known) >= MEMORY:  # forget the older half; dicts keep their order of insertion
                for key in list(self.known)[: MEMORY // 2]:
                    del self.known[key]
            self.known[piece] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as an int32 array."""
        parts = self.split.split(text) if self.split else [text]
        out: list[bytes] = []
        for k, part in enumerate(parts):
            if k % 2:  # an added token's string
                out.append(np.asarray([self.v.added[part]], np.int32).tobytes())
                continue
            known = self.known.get
            for block in pre_tokens(part):
                found = [known(p) for p in block]
                if None in found:
                    found = [f if f is not None else self.piece(p) for f, p in zip(found, block)]
                out.extend(found)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        """The text of the concatenated vocabulary strings; bytes that are no UTF-8 read as U+FFFD."""
        table = self.v.token_bytes
        return b"".join(table[i] for i in ids).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, text_col: str = "text", split_added: bool = True, out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out`` (array<int>) of the ids of its whole text; ``path`` is a tokenizer file."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(path))

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value, split_added)
        for array in arrays:
            found = [encoder.encode(t) for t in array.to_pylist()]
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int64)
            values = np.concatenate(found) if found else np.empty(0, np.int32)
            yield pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())).cast(pa.list_(pa.int32()))

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out, F.arrow_udf(run, "array<int>")(text))


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with a column ``out``: the text of the ids (null ids: '')."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tokens = Vocabulary(path).token_bytes
    blob = np.frombuffer(b"".join(tokens), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    shared = spark.sparkContext.broadcast((blob, starts))

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blob, starts = shared.value
        for array in arrays:
            ids = array.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = starts[ids + 1] - starts[ids]
            row_tok = np.concatenate([[0], np.cumsum(array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            row_byte = np.concatenate([[0], np.cumsum(sizes)])[row_tok]
            said, r = [], 0
            while r < len(array):  # rows of about GATHER bytes at a time; a longer text alone, whole
                q = min(len(array), max(r + 1, int(np.searchsorted(row_byte, row_byte[r] + GATHER, side="right")) - 1))
                part, width = ids[row_tok[r] : row_tok[q]], sizes[row_tok[r] : row_tok[q]]
                ends = np.cumsum(width)
                # one gather of the vocabulary strings of these rows, in order: their concatenation
                at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[part] - (ends - width), width)
                joined, base = blob[at].tobytes(), int(row_byte[r])
                said += [joined[a - base : b - base].decode("utf-8", "replace") for a, b in zip(row_byte[r:q].tolist(), row_byte[r + 1 : q + 1].tolist())]
                r = q
            yield pa.array(said, pa.string())

    return docs.withColumn(out, F.arrow_udf(run, "string")(F.col(ids_col)))


def le_uint32(ids: Column) -> Column:
    """The ids of an array<int> as little-endian unsigned 32-bit integers, one binary value."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            values = array.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            lengths = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths) * 4]).astype(np.int32)
            yield pa.Array.from_buffers(pa.binary(), len(array), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])

    return F.arrow_udf(run, "binary")(ids)
