"""Language-model scores from a probabilistic suffix tree over bytes, next to a word baseline.

A text is lower-cased (A-Z) and cut into words at ASCII white space; the model reads the words joined by
single spaces, then an end symbol, as a sequence of bytes. All training texts are counted: windows
of DEPTH + 1 bytes, added up over the corpus, hold the next-symbol counts of every shorter context too.

A context is kept if it makes up at least ``P_MIN`` of all training positions and its next-symbol
distribution diverges from that of its suffix by more than ``GAIN`` nats per training position and
distinct successor.
Since the contexts of one length add up to one, at most DEPTH / P_MIN of them can be kept whatever the
corpus: that bounds what the driver sees and what is broadcast. A kept distribution is smoothed
with its suffix's (Witten-Bell), the root's with the uniform one over the symbols that a text
can hold, so the probabilities of all texts add up to one. The kept contexts, closed under suffixes and
prefixes, are the states of an automaton: from the longest kept suffix of what was read and the next byte
follows the next longest suffix, and many stretches of text are scored side by side.

The word baseline needs each word's corpus count. A chunk of texts is stored as indexes into its own word
list; the distinct words of a chunk (64-bit hashes) meet the corpus counts by hash and come back.

Edge cases: null and empty texts are the end symbol alone; without training texts both scores are
those of the smoothing alone; repeated rows count as often as they occur; null ids are held in, since
they have no fold; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches, discard, store, utf8

DEPTH = 6
P_MIN = 1e-6
GAIN = 2e-7
# Symbols counted under this fraction of the least context count are left to the suffix.
RARE = 16
SPACE, END, START = 0x20, 0x0A, 0x09
# Bytes a symbol sequence can hold: all but the other white space.
SYMBOLS = 252
CHUNK_BYTES = 16 << 20
_SEGMENT = 1024
_BLOCK = 1 << 22
_HELD = 1 << 22


def canonical(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + b"\n"


def windows(buffer: np.ndarray) -> np.ndarray:
    """Each position's symbol in the low byte, the DEPTH before it above; start padding is not predicted."""
    n = len(buffer) - DEPTH
    packed = np.zeros(n, np.int64)
    for i in range(DEPTH + 1):
        packed |= buffer[i : i + n].astype(np.int64) << 8 * (DEPTH - i)
    return packed[buffer[DEPTH:] != START]


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)


def count_windows(texts: DataFrame) -> DataFrame:
    """(w, n) over all rows of ``texts`` (one binary column): windows with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pad, parts, size = b"\t" * DEPTH, [], 0

        def counted() -> None:
            buffer = np.frombuffer(b"".join(parts), np.uint8)
            for at in range(0, len(buffer) - DEPTH, _BLOCK):
                held.append(np.unique(windows(buffer[at : at + _BLOCK + DEPTH]), return_counts=True))
            if sum(len(k) for k, _ in held) > _HELD:
                held[:] = [_merged(held)]

        for batch in batches:
            for text in batch.column(0):
                parts += [pad, canonical(text.as_py())]
                size += len(parts[-1]) + DEPTH
                if size >= _BLOCK:
                    counted()
                    parts, size = [], 0
            if sum(len(k) for k, _ in held) > _HELD:
                yield _pairs(*_merged(held))
                held.clear()
        if parts:
            counted()
        if held:
            yield _pairs(*_merged(held))

    return texts.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _pairs(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["w", "n"])


@dataclass(frozen=True)
class Model:
    """Transitions and log10 probabilities by state and symbol column."""

    column: np.ndarray  # of each byte; the last column is any byte never seen
    after: np.ndarray
    logp: np.ndarray


def train(texts: DataFrame, p_min: float = P_MIN, gain: float = GAIN) -> Model:
    """The tree of a corpus (one binary column of texts)."""
    bounded_batches(texts.sparkSession)
    level = store(count_windows(texts), "grams")
    total = level.agg(F.sum("n")).first()[0] or 0
    least = max(2, p_min * total)
    levels, stored = {}, [level]
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            cut = F.col("w").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
            level = store(level.groupBy(cut.alias("w")).agg(F.sum("n").alias("n")), "grams")
            stored.append(level)
        context = F.shiftright("w", 8)
        frequent = level.groupBy(context.alias("c")).agg(F.sum("n").alias("nc")).where(F.col("nc") >= (least if depth else 1))
        # Successors under a 64th of the least context count are left to the smoothing.
        rows = level.withColumn("c", context).join(frequent, "c").where((F.col("n") >= least / RARE) | F.lit(depth == 0))
        table = rows.select("w", "n", "nc").toArrow().sort_by("w")
        levels[depth] = tuple(table.column(c).to_numpy() for c in ("w", "n", "nc"))
    discard(*stored)
    return build(levels, max(1.5, gain * total))


def build(levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], gain: float) -> Model:
    """``levels``: per context length the packed (context, symbol), its count and the context's, for frequent contexts."""
    seen = np.unique(levels[0][0] & 0xFF)
    column = np.full(256, len(seen), np.int64)
    column[seen] = np.arange(len(seen))
    width = len(seen) + 1
    contexts, chosen, keep = {0: np.zeros(1, np.int64)}, {0: np.ones(1, bool)}, {0: np.ones(1, bool)}
    # Divergence of every frequent context from its suffix, over the successors listed for it.
    for depth in range(1, DEPTH + 1):
        (w, n, _), (w_up, n_up, _) = levels[depth], levels[depth - 1]
        contexts[depth], of = np.unique(w >> 8, return_inverse=True)
        m = len(contexts[depth])
        at = np.searchsorted(w_up, w & ((1 << 8 * depth) - 1))  # a frequent context's suffix is frequent, too
        at = np.minimum(at, max(0, len(w_up) - 1))
        tall = np.bincount(np.searchsorted(contexts[depth - 1], w_up >> 8), weights=n_up) if len(w_up) else np.zeros(1)
        up = np.searchsorted(contexts[depth - 1], (w >> 8) & ((1 << 8 * (depth - 1)) - 1))
        p, q = n / np.maximum(1, np.bincount(of, weights=n, minlength=m))[of], (n_up[at] / tall[up] if len(w) else n)
        chosen[depth] = np.bincount(of, weights=n * np.log(p / q) if len(w) else None, minlength=m) > gain * np.bincount(of, minlength=m)
        keep[depth] = chosen[depth].copy()
    # Kept contexts bring their suffixes and prefixes, all of them frequent.
    for depth in range(DEPTH, 1, -1):
        needed = contexts[depth][keep[depth]]
        for shorter in (needed & ((1 << 8 * (depth - 1)) - 1), needed >> 8):
            keep[depth - 1][np.searchsorted(contexts[depth - 1], shorter)] = True
    names = {depth: contexts[depth][keep[depth]] for depth in contexts}
    first = dict(enumerate(np.cumsum([0, *(len(names[d]) for d in range(DEPTH + 1))]).tolist()))
    after, prob = np.zeros((first[DEPTH + 1], width), np.int32), np.zeros((first[DEPTH + 1], width), np.float32)
    for depth in range(DEPTH + 1):
        rows = slice(first[depth], first[depth + 1])
        if depth:
            link = first[depth - 1] + np.searchsorted(names[depth - 1], names[depth] & ((1 << 8 * (depth - 1)) - 1))
            parent = prob[link]
            after[rows] = after[link]
        else:
            parent = np.full((1, width), 1 / SYMBOLS, np.float32)
        w, n, nc = levels[depth]
        at = np.searchsorted(contexts[depth], w >> 8)
        own = chosen[depth][at] & keep[depth][at]
        at = np.cumsum(keep[depth])[at[own]] - 1
        counts, all_of = np.zeros((len(names[depth]), width), np.float32), np.zeros(len(names[depth]))
        counts[at, column[w[own] & 0xFF]] = n[own]
        all_of[at] = nc[own]
        listed = counts.sum(axis=1, dtype=np.float64)
        # The suffix gets the occurrences with unlisted successors, and one for each listed one.
        share = ((counts > 0).sum(axis=1) + np.maximum(0, all_of - listed))[:, None]
        mixed = (counts + share * parent) / np.maximum(1, listed[:, None] + share)
        prob[rows] = np.where(listed[:, None] > 0, mixed, parent)
        if depth < DEPTH:
            longer = names[depth + 1]
            after[first[depth] + np.searchsorted(names[depth], longer >> 8), column[longer & 0xFF]] = first[depth + 1] + np.arange(len(longer))
    return Model(column.astype(np.uint8), after, np.log10(prob))


def log10_probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each canonical text."""
    pad = b"\t" * DEPTH
    ends = np.cumsum([len(t) + DEPTH for t in texts])
    out = np.zeros(len(texts))
    buffer = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    cuts = np.concatenate([[0], ends])
    for at in range(0, len(buffer), _BLOCK):
        part = buffer[max(0, at - DEPTH) : at + _BLOCK]
        if at == 0:
            part = np.concatenate([np.full(DEPTH, START, np.uint8), part])
        values = _stretch(model, part)
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        low = np.clip(cuts[:-1] - at, 0, len(values))
        high = np.clip(cuts[1:] - at, 0, len(values))
        out += sums[high] - sums[low]
    return out


def _stretch(model: Model, part: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol after the first DEPTH, zero for start padding."""
    n = len(part) - DEPTH
    rows = -(-n // _SEGMENT)
    padded = np.concatenate([part, np.full(rows * _SEGMENT - n, START, np.uint8)])
    segments = np.lib.stride_tricks.as_strided(padded, (rows, _SEGMENT + DEPTH), (_SEGMENT, 1))
    columns = np.ascontiguousarray(model.column[segments].T)
    width, after, logp = model.after.shape[1], model.after.ravel(), model.logp.ravel()
    state, out = np.zeros(rows, np.int32), np.empty((_SEGMENT, rows), np.float32)
    for t in range(_SEGMENT + DEPTH):
        at = state * np.int32(width) + columns[t] if model.after.size < 2**31 else state.astype(np.int64) * width + columns[t]
        if t >= DEPTH:
            out[t - DEPTH] = logp[at]
        state = after[at]
    values = out.T.ravel()[:n]
    values[part[DEPTH:] == START] = 0
    return values


def _encode(texts: list[bytes], training: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word indexes of all texts, tokens per text, and the words' hashes and training counts."""
    index: dict[bytes, int] = {}
    codes, sizes = [], []
    for text in texts:
        words = text.split()
        words.append(b"\n")
        codes.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint32, len(words)))
        sizes.append(len(words))
    flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
    learned = np.repeat(np.array(training, bool), sizes)
    counts = np.bincount(flat[learned], minlength=len(index))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), np.uint64, len(index)).view(np.int64)
    return flat, np.array(sizes, np.int64), hashes, counts


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", p_min: float = P_MIN) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows where ``held_out`` is not true and scores all of them.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("out"), utf8(text_col).alias("text"))
    model = train(rows.where(~F.col("out")).select("text"), p_min)
    shared = spark.sparkContext.broadcast((model.column, model.after, model.logp))
    id_type = rows.schema["id"].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, task, made = Model(*shared.value), TaskContext.get().partitionId(), 0
        ids, outs, texts, size = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            scores = log10_probabilities(tree, texts)
            codes, sizes, hashes, counts = _encode(texts, [not o for o in outs])
            planes = np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T)
            lists = [pa.array([x]) for x in (outs, sizes, scores, hashes, counts)]
            blob = pa.array([zlib.compress(planes.tobytes(), 1)], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | made]), pa.array([ids], pa.list_(id_kind)), *lists, blob],
                ["chunk", "ids", "outs", "sizes", "scores", "hashes", "counts", "codes"],
            )

        for batch in batches:
            id_kind = batch.schema.field("id").type
            for id_, out, text in zip(*(batch.column(c) for c in ("id", "out", "text"))):
                ids.append(id_.as_py())
                outs.append(out.as_py())
                texts.append(canonical(text.as_py()))
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield chunk()
                    made, ids, outs, texts, size = made + 1, [], [], [], 0
        if ids:
            yield chunk()

    encoded = store(
        rows.mapInArrow(
            chunks,
            f"chunk long, ids array<{id_type}>, outs array<boolean>, sizes array<long>, scores array<double>, "
            "hashes array<long>, counts array<long>, codes binary",
        ),
        "chunks",
    )
    asked = encoded.select("chunk", F.posexplode(F.arrays_zip("hashes", "counts")).alias("pos", "w"))
    asked = asked.select("chunk", "pos", F.col("w.hashes").alias("h"), F.col("w.counts").alias("n"))
    known = store(
        asked.selectExpr(
            "chunk", "pos", "sum(n) OVER (PARTITION BY h) AS c", "row_number() OVER (PARTITION BY h ORDER BY chunk, pos) = 1 AS first"
        ),
        "counts",
    )
    totals = known.where("first").agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    tokens, distinct = totals["n"] or 0, totals["v"]

    def finish(_, left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        at = right.column("pos").to_numpy()
        count = np.zeros(len(at), np.int64)
        count[at] = right.column("c").to_numpy()
        sizes = np.array(row["sizes"], np.int64)
        planes = np.frombuffer(zlib.decompress(row["codes"]), np.uint8).reshape(4, -1)
        codes = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
        starts = np.cumsum(sizes) - sizes
        base = np.log10((count + 1) / (tokens + distinct + 1))
        return pa.table(
            {
                id_col: left.column("ids").combine_chunks().flatten(),
                "held_out": pa.array(row["outs"], pa.bool_()),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat((count > 0)[codes].astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(sizes), tokens)),
                "base_score": pa.array(np.add.reduceat(base[codes], starts)),
                "score": pa.array(row["scores"], pa.float64()),
            }
        )

    texts = encoded.select("chunk", "ids", "outs", "sizes", "scores", "codes")
    return (
        texts.groupBy("chunk")
        .cogroup(known.select("chunk", "pos", "c").groupBy("chunk"))
        .applyInArrow(
            finish,
            f"{id_col} {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
