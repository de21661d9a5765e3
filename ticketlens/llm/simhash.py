"""Near-duplicate texts by SimHash, found with covering locality-sensitive hashing.

A text's words (ASCII lower case, cut at ASCII white space) give shingles; each bit of the
fingerprint is the majority of that bit over the shingles' XXH64. Every bit position carries a
vector of GF(2)^(r+1), and there is one mask per non-zero vector v: the bits whose vector has an
odd product with v. Any r positions leave some v orthogonal to all of them, so two fingerprints
that differ in at most r bits agree under at least one of the 2^(r+1)-1 masks: nothing is missed.

Edge cases: a null or empty text has fingerprint zero and is linked like any other; equal
fingerprints are one node however many rows share them; rows with a null id get the component of
their fingerprint but never name one; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches, components, discard, label_components, store, utf8

SEED = 42
BITS = 64
# Distinct fingerprints of one bucket that one task compares directly (64 KiB); larger buckets
# are linked through shared probes, with equal results.
BUCKET = 8192
_SHINGLE_BLOCK = 1 << 18


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _SHINGLE_BLOCK):
        spans = zip(starts[at : at + _SHINGLE_BLOCK], ends[at : at + _SHINGLE_BLOCK])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhash(text: str | Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column, as a signed long."""

    def batches(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            prints = np.array([fingerprint(x.as_py(), shingle) for x in array], dtype=np.uint64)
            yield pa.array(prints.view(np.int64), pa.int64())

    return F.arrow_udf(batches, "long")(utf8(text))


def covering_masks(radius: int) -> list[int]:
    """Masks as signed longs: two numbers that differ in at most ``radius`` bits agree under one of them."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def links(prints: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct ``fp`` linked by chains of at most ``radius`` bits.

    Every edge is a true link, and every link within a bucket is spanned by edges: a bucket of n
    fingerprints yields fewer than n edges, never its pairs.
    """
    tables = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in covering_masks(radius)]))
    buckets = prints.select("fp", tables.alias("t", "key"))
    sizes = store(buckets.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = buckets.join(sizes, ["t", "key"])
    lists = members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    edges = lists.select("fps").mapInArrow(_bucket_edges(radius), "a long, b long")
    if not sizes.where(F.col("n") > bucket).isEmpty():
        edges = edges.union(_probe_edges(members.where(F.col("n") > bucket), radius))
    edges = store(edges.distinct(), "links")
    discard(sizes)
    return edges


def _bucket_edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, found = batch.column(0), []
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for start, end in zip(offsets[:-1], offsets[1:]):
                x = np.sort(values[start:end]).view(np.uint64)
                pairs = [np.empty((2, 0), np.int64)]
                for at in range(0, len(x), 1024):
                    near = np.bitwise_count(x[at : at + 1024, None] ^ x[None, at:]) <= radius
                    i, j = np.nonzero(near)
                    # One round of joining rows with their first partner keeps the pair list short.
                    pairs.append(np.stack([i[i < j], j[i < j]]) + at)
                    if sum(p.shape[1] for p in pairs) > 1 << 22:
                        pairs = [_spanning(len(x), np.concatenate(pairs, axis=1))]
                a, b = _spanning(len(x), np.concatenate(pairs, axis=1))
                found.append(np.stack([x[a], x[b]]).view(np.int64))
            a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _spanning(n: int, pairs: np.ndarray) -> np.ndarray:
    """A star per component of the pairs."""
    roots = label_components(n, *pairs)
    nodes = np.nonzero(roots != np.arange(n))[0]
    return np.stack([nodes, roots[nodes]])


def _probe_edges(members: DataFrame, radius: int) -> DataFrame:
    """Links of large buckets in space that grows with their members only.

    Two fingerprints within ``radius`` meet in a probe that one reaches with half the flips and the
    other with the rest, all of them among the bits the mask leaves out. Whoever reaches a probe is
    within ``radius`` of anyone who reaches it with half the flips, so a star to the smallest such
    fingerprint holds true links only and connects all that meet there.
    """
    few, masks = radius // 2, [mask % (1 << 64) for mask in covering_masks(radius)]

    def flips(mask: int, most: int) -> list[int]:
        free = [i for i in range(BITS) if not mask >> i & 1]
        return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(free, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [np.array(flips(mask, radius - few), np.uint64) for mask in masks]
        near = [len(flips(mask, few)) for mask in masks]  # fewest flips come first
        for batch in batches:
            for t, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                z = (table[t] ^ np.uint64(fp % (1 << 64))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(z), pa.array(np.full(len(z), fp)), pa.array(np.arange(len(z)) < near[t])], ["z", "fp", "near"]
                )

    probes = members.select("t", "fp").mapInArrow(run, "z long, fp long, near boolean")
    roots = probes.where("near").groupBy("z").agg(F.min("fp").alias("root"))
    return probes.join(roots, "z").where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """One row per input row: id, ``fp`` (signed long) and ``component_id``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most
    ``max_bits`` bits, the row's own id included.
    """
    bounded_batches(docs.sparkSession)
    prints = store(docs.select(F.col(id_col).alias("id"), simhash(text_col, shingle).alias("fp")), "prints")
    groups = store(prints.groupBy("fp").agg(F.min("id").alias("rep")), "groups")
    edges = links(groups.select("fp"), max_bits, bucket)
    roots = store(components(edges).select(F.col("node").alias("fp"), "root"), "roots")
    linked = store(groups.join(roots, "fp", "left"), "linked")
    # Tables of their own: a join with an aggregate could not split the rows of a large component.
    lowest = store(linked.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("lowest")), "lowest")
    named = store(
        linked.join(lowest, "root", "left")
        .select("fp", F.coalesce("lowest", "rep").alias("component_id")),
        "named",
    )
    discard(groups, edges, roots, linked, lowest)
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
