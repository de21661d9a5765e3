"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: hashed words (weight 1 / sqrt(number of distinct buckets)), each
structure statistic as the bin it falls in, and bins of numeric metadata columns. The score is

    sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),

so the pairwise interactions cost one pass over the non-zero entries. The model is fitted on at most
``max_rows`` labelled rows (those with the lowest hash of their id), everything else covers all rows.
Texts are measured whole.

Edge cases: null and empty texts have the statistics of an empty text and get a score; null metadata
is a bin of its own; without labelled rows the model scores every text 0.5; labels that are null are
left out; a document with several label rows is learned from once per row; repeated rows and ids are
scored alike; input columns keep their names and values.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches, utf8

MAX_ROWS = 6000
WORD_BUCKETS = 1 << 12
BINS = 24
FACTORS = 8
_NAMES = ("upper", "digit", "symbol", "high", "blank", "punct_end", "word_len", "long_words", "short_words", "repeats",
          "lines", "line_repeats", "line_len", "symbol_words", "symbol_ends", "plain_words", "length", "capital_words", "echoes")
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_ALNUM[128:] = True
_SOFT = np.zeros(256, bool)  # the marks of ordinary sentences
_SOFT[list(b".,;:?!'\"()-")] = True
_INSIDE = np.ones(256, bool)  # of words
_INSIDE[[9, 10, 11, 12, 13, 32]] = False
_SYMBOL = ~_ALNUM & ~_SOFT & _INSIDE


def measure(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word buckets (distinct, sorted) and structure statistics of one text."""
    words = text.split()
    distinct = set(words)
    buckets = np.unique(np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct)) % WORD_BUCKETS)
    raw = np.frombuffer(text, np.uint8)
    hist = np.bincount(raw, minlength=256)
    n, w = max(1, len(raw)), max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    k = max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    inside = _INSIDE[raw]
    ends = raw[inside & np.append(~inside[1:], True)] if len(raw) else raw
    starts = raw[inside & np.insert(~inside[:-1], 0, True)] if len(raw) else raw
    plain = _ALNUM[ends] & _ALNUM[starts]
    stats = [
        hist[65:91].sum() / n,
        hist[48:58].sum() / n,
        hist[_SYMBOL].sum() / n,
        hist[128:].sum() / n,
        hist[[9, 10, 11, 12, 13, 32]].sum() / n,
        np.count_nonzero(_SOFT[ends]) / w,
        lengths.sum() / w,
        np.count_nonzero(lengths > 20) / w,
        np.count_nonzero(lengths == 1) / w,
        1 - len(distinct) / w,
        k / w,
        1 - len(set(lines)) / k,
        w / k,
        np.count_nonzero(_SYMBOL[starts]) / w,
        np.count_nonzero(_SYMBOL[ends]) / w,
        np.count_nonzero(plain) / w,
        np.log1p(len(raw)),
        np.count_nonzero((starts >= 65) & (starts <= 90)) / w,
        sum(map(eq, words, words[1:])) / w,
    ]
    return buckets.astype(np.int32), np.array(stats)


@dataclass(frozen=True)
class Model:
    """Bin edges of statistics and metadata, and the machine's parameters."""

    edges: np.ndarray  # (statistics + metadata, BINS - 1)
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, buckets: np.ndarray, numbers: np.ndarray) -> float:
        index, x = vector(buckets, numbers, self.edges)
        linear = self.w0 + float(self.w[index] @ x)
        vx = self.v[index] * x[:, None]
        z = linear + 0.5 * float((vx.sum(axis=0) ** 2 - (vx**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def vector(buckets: np.ndarray, numbers: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero entries: words first, then one bin (the last for a missing number) per statistic."""
    bins = (numbers[:, None] >= edges).sum(axis=1)
    bins[np.isnan(numbers)] = BINS
    index = np.concatenate([buckets, WORD_BUCKETS + np.arange(len(numbers)) * (BINS + 1) + bins])
    x = np.ones(len(index))
    x[: len(buckets)] = 1 / np.sqrt(max(1, len(buckets)))
    return index, x


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], n_numbers: int, epochs: int = 12, seed: int = 1) -> Model:
    """Logistic loss, Adam over mini-batches; deterministic for rows in a given order."""
    size = WORD_BUCKETS + n_numbers * (BINS + 1)
    rng = np.random.default_rng(seed)
    w0, w, v = np.zeros(1), np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    if not rows:
        return Model(np.zeros((n_numbers, BINS - 1)), 0.0, w, np.zeros_like(v))
    numbers = np.stack([r[1] for r in rows])
    edges = np.stack([_edges(column) for column in numbers.T])
    y = np.array([r[2] for r in rows], float)
    entries = [vector(b, s, edges) for b, s, _ in rows]
    w0[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    params, moments, step = [w0, w, v], None, 0
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            index = np.concatenate([entries[i][0] for i in chosen])
            x = np.concatenate([entries[i][1] for i in chosen])
            sizes = np.array([len(entries[i][0]) for i in chosen])
            first, row = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(chosen)), sizes)
            vx = v[index] * x[:, None]
            s = np.add.reduceat(vx, first, axis=0)
            z = w0[0] + np.add.reduceat(w[index] * x, first) + 0.5 * (s**2 - np.add.reduceat(vx**2, first, axis=0)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[chosen]) / len(chosen)
            gw, gv = 1e-5 * w, 1e-4 * v
            np.add.at(gw, index, error[row] * x)
            np.add.at(gv, index, (error[row] * x)[:, None] * (s[row] - vx))
            step += 1
            for p, g, (m1, m2) in zip(params, (np.array([error.sum()]), gw, gv), moments):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Model(edges, float(w0[0]), w, v)


def _edges(column: np.ndarray) -> np.ndarray:
    known = column[~np.isnan(column)]
    if not len(known):
        return np.zeros(BINS - 1)
    # Half of the bins by rank, half by width: quantiles alone cannot tell rare extremes apart.
    rank = np.quantile(known, np.linspace(0, 1, BINS // 2 + 1)[1:])
    low, high = np.quantile(known, [0.001, 0.999])
    return np.sort(np.concatenate([rank, np.linspace(low, high, BINS - 1 - len(rank))]))


def _measured(text: pa.Array, extra: list[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    columns = [a.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for a in extra]
    for i, x in enumerate(text):
        buckets, stats = measure(x.as_py())
        yield buckets, np.concatenate([stats, [c[i] for c in columns]])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: tuple[str, ...] = (),
    where: Column | None = None,
    max_rows: int = MAX_ROWS,
) -> Model:
    """Fit on at most ``max_rows`` labelled documents (``where`` limits them), by hash of the id.

    Only the sampled rows' features reach the driver: at most ``max_rows`` vectors of at most
    ``WORD_BUCKETS`` entries, also when ids repeat among the documents (the bound is applied after
    the join, by hash of id and text); the sampled ids are at most ``max_rows`` and are broadcast.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(where) if where is not None else known
    chosen = (
        known.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(max_rows)
    )
    picked = chosen.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    columns = [utf8(text_col).alias("_text"), *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(metadata)]]
    joined = docs.select(F.col(id_col).alias("_id"), *columns).join(F.broadcast(picked), "_id")
    # Repeated ids in the documents would multiply the picked rows: the bound holds after the join.
    rows = joined.orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_text"), "_text", "_label").limit(max_rows).drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_measured(batch.column("_text"), [batch.column(f"_m{i}") for i in range(len(metadata))]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b.tolist() for b, _ in found], pa.list_(pa.int32())),
                    pa.array([s.tolist() for _, s in found], pa.list_(pa.float64())),
                    batch.column("_label"),
                ],
                ["buckets", "numbers", "label"],
            )

    ordered = rows.select("_text", *[f"_m{i}" for i in range(len(metadata))], "_label").mapInArrow(
        run, "buckets array<int>, numbers array<double>, label int"
    )
    table = ordered.toArrow().to_pylist()
    table.sort(key=lambda r: (r["buckets"], r["numbers"], r["label"]))  # task order must not matter
    examples = [(np.array(r["buckets"], np.int32), np.array(r["numbers"], float), r["label"]) for r in table]
    return fit(examples, len(_NAMES) + len(metadata))


def score(model: Model, text: str | Column, *metadata: str) -> Column:
    """The model's score of a text column, 0 to 1, higher for label 1."""

    def run(arrays: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *extra in arrays:
            yield pa.array([model.score(b, s) for b, s in _measured(texts, extra)], pa.float64())

    def run_text(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run((a,) for a in arrays)

    function = F.arrow_udf(_typed(run, len(metadata)) if metadata else _typed(run_text, 0), "double")
    return function(utf8(text), *[F.col(m).cast("double") for m in metadata])


def _typed(run, extra: int):
    """Arrow functions over iterators are told apart by their annotations."""
    run.__annotations__ = (
        {"arrays": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
        if extra
        else {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    )
    return run
