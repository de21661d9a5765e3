"""Document fingerprints as quartile bucket digests, and a bounded likeness of two of them.

Every window of five bytes gives byte triplets, hashed into buckets; a bucket's count is coded by
the quartile it falls in (two bits). The header holds a checksum, the length on a log scale and the
ratios of the quartiles. Two digests differ by the sum of their code differences (opposite quartiles
count double) and of their bounded header differences; the likeness is one minus that over its largest
possible value, so it lies between 0 and 1 and is 1 for equal digests.

Edge cases: null and empty texts have the digest of the empty text; texts under five bytes have no
triplets and differ by checksum and length only; a likeness with a null digest is null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches, utf8

BUCKETS = 256
# Offsets of the triplets within a window of five bytes.
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 4), (0, 1, 4))
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
_BLOCK = 1 << 20
_HEADER_MOST = 1 + 12 + 2 * 6
MOST = 6 * BUCKETS + _HEADER_MOST


def bucket_counts(text: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(raw) - 4), _BLOCK):
        part = raw[at : at + _BLOCK + 4].astype(np.uint32)
        n = len(part) - 4
        for (i, j, k), factor in zip(_TRIPLETS, _FACTORS):
            key = part[i : i + n] | part[j : j + n] << 8 | part[k : k + n] << 16
            hashed = (key * np.uint32(factor)) >> np.uint32(24)
            counts += np.bincount(hashed, minlength=BUCKETS)
    return counts


def digest(text: bytes) -> str:
    """Checksum, length code and quartile ratios (a byte each), then four bucket codes per byte; in hex."""
    counts = bucket_counts(text)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    body = (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).astype(np.uint8)
    length = min(255, int(8 * np.log2(len(text) + 1)))
    ratios = (int(16 * q1 / q3) % 16) << 4 | int(16 * q2 / q3) % 16 if q3 else 0
    return bytes([zlib.crc32(text) & 0xFF, length, ratios]).hex() + body.tobytes().hex()


def _codes(digests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), -1)
    return raw[:, :3].astype(np.int64), np.stack([raw[:, 3:] >> s & 3 for s in (0, 2, 4, 6)], axis=2).astype(np.int8)


def likenesses(left: list[str], right: list[str]) -> np.ndarray:
    if not left:
        return np.empty(0)
    (head_a, a), (head_b, b) = _codes(left), _codes(right)
    apart = np.abs(a - b)
    body = (apart + 3 * (apart == 3)).sum(axis=(1, 2), dtype=np.int64)
    around = lambda x: np.minimum(x % 16, -x % 16)  # noqa: E731  ratios wrap around
    header = (head_a[:, 0] != head_b[:, 0]) + np.minimum(12, np.abs(head_a[:, 1] - head_b[:, 1]))
    for shift in (0, 4):
        header = header + np.minimum(6, around((head_a[:, 2] >> shift) % 16 - (head_b[:, 2] >> shift) % 16))
    return 1 - (body + header) / MOST


def fingerprint(text: str | Column) -> Column:
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array([digest(x.as_py()) for x in array], pa.string())

    return F.arrow_udf(run, "string")(utf8(text))


def likeness(left: str | Column, right: str | Column) -> Column:
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        both = [(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())]
        known = [(x, y) for x, y in both if x is not None and y is not None]
        values = iter(likenesses([x for x, _ in known], [y for _, y in known]).tolist())
        return pa.array([None if x is None or y is None else next(values) for x, y in both], pa.float64())

    run.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(left, right)


# Rows of one range of ids, about; ranges grow in number, not in size.
RANGE_ROWS = 10_000


def map_with_next(docs: DataFrame, function, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that ``function(triples)`` gives for each document and the one after it.

    "After" is by ascending numeric id (null ids first, equal ids by text), and the first follows the
    last. Ids are dealt into ranges; the first document of a range is also sent to the range before,
    so every task streams its sorted rows and holds two texts at a time. ``function`` gets a list of
    (id, text, next text) and returns the columns of ``schema`` as lists. The driver holds one id per range.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ids = docs.select(F.col(id_col).alias("id"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ids.count() // RANGE_ROWS + 1)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = np.unique(np.array(ids.agg(F.percentile_approx("id", shares, max(10_000, 10 * ranges))).first()[0] or [0]))

    def part_of(values: pa.Array) -> np.ndarray:
        """Ranges (cut, cut]; null ids come before all others."""
        known = values.is_valid().to_numpy(zero_copy_only=False)
        return np.where(known, np.searchsorted(cuts, values.fill_null(0).to_numpy(zero_copy_only=False)) + 1, 0)

    def part(values: pa.Array) -> pa.Array:
        return pa.array(part_of(values), pa.int32())

    part.__annotations__ = {"values": pa.Array, "return": pa.Array}
    firsts = ids.groupBy(F.arrow_udf(part, "int")("id").alias("part")).agg(F.min("id").alias("id")).orderBy("part").collect()
    parts = [r["part"] for r in firsts]
    before = dict(zip(parts, parts[-1:] + parts[:-1]))
    first = {r["part"]: r["id"] for r in firsts}

    def to(values: pa.Array) -> pa.Array:
        own = part_of(values).tolist()
        return pa.array([[p, before[p]] if first[p] == v else [p] for p, v in zip(own, values.to_pylist())], pa.list_(pa.int32()))

    to.__annotations__ = {"values": pa.Array, "return": pa.Array}
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = rows.select("id", "text", F.posexplode(F.arrow_udf(to, "array<int>")("id")).alias("ahead", "to"))
    sent = sent.select("to", "ahead", "id", "text")
    ordered = sent.repartition(ranges, "to").sortWithinPartitions("to", "ahead", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = None, [f.split()[0] for f in schema.split(",")]
        for batch in batches:
            triples = []
            for to, is_ahead, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and held[0] == to:
                    triples.append((held[1], held[2], text))
                held = None if is_ahead else (to, id_, text)
            if triples:
                yield pa.RecordBatch.from_pydict(dict(zip(names, function(triples))))

    return ordered.mapInArrow(run, schema)
