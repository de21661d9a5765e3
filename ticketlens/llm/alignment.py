"""Alignment of two tokenizations of one text by divide and conquer at shared cuts.

Tokenizer A is a byte-level BPE file (merged by :mod:`ticketlens.llm.merges`, long pre-tokens by
:mod:`ticketlens.llm.pq_bpe`; its added tokens' strings are plain text) applied to space + text;
tokenizer B a sentencepiece model, which adds the space itself. Each token stands for bytes: A's entry read back through the byte alphabet, B's
piece in UTF-8 with U+2581 as a space and ``<0xHH>`` as the byte HH.

A cut is a byte offset at which an A token and a B token both end. An interval between two cuts is
split at a common end near its middle, found by bisecting B's ends for A's ends walked outward from
the middle; both halves are split alike, and an interval without an inner cut is a leaf group (all
intervals of one level at once, as arrays). A space after anything but white space is always a cut:
A's pattern starts a pre-token there, and a model without pieces that go on past a space ends one
(:func:`cuts_at_spaces`; other models have no cut that is known beforehand). The stretches between
these first cuts are words, and a worker remembers how it has aligned a word. Links are the pairs of A and B tokens whose byte ranges
overlap: each elementary byte segment between consecutive token ends gives one. An id
pair's count is the number of documents (rows) holding it linked, over the whole table; a link is
best when its count is the highest of all pairs of its A id, ties included.

Edge cases: null or empty texts, and texts whose joined A or B bytes differ from space + text (a
model that changes the text), have no tokens: every count is 0 and ``groups_sha256`` is ''. Each
row is its own document, so repeated rows and repeated or null ids count once each; other columns
are dropped and cannot clash; an empty table gives an empty table; long texts are aligned whole.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches, store
from ticketlens.llm.merges import _PRE, BLOCK, Merger, Merges, pre_tokens
from ticketlens.llm.pq_bpe import Vocabulary, merge_piece

# Characters of text whose tokens one numpy pass aligns together.
CHUNK = 1 << 20
# Words, and characters of words, that one worker remembers before it forgets those met only once.
MEMORY, MEMORY_CHARS = 3 << 17, 1 << 23
# Bytes of the longest pre-token that is merged with others at once; longer ones take a heap each, in n log n steps.
LONG = 64
# Pair counts up to this many rows are sent to every task; larger tables are joined by shuffle.
BROADCAST_PAIRS = 2_000_000


def piece_bytes(path: str) -> list[bytes]:
    """Bytes of every sentencepiece id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            out.append(b"")
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def cut_groups(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """Leaf groups (a_from, a_to, b_from, b_to) in order; both end lists are increasing and share their last value."""
    groups, todo = [], [(0, len(a_ends), 0, len(b_ends))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        found = None
        for k in _outward(a0, a1 - 2, (a0 + a1 - 2) // 2):
            j = bisect_left(b_ends, a_ends[k], b0, b1 - 1)
            if j < b1 - 1 and b_ends[j] == a_ends[k]:
                found = (k, j)
                break
        if found is None:
            groups.append((a0, a1, b0, b1))
            continue
        k, j = found
        todo.append((k + 1, a1, j + 1, b1))  # right half waits, left half goes first
        todo.append((a0, k + 1, b0, j + 1))
    return groups


def _outward(low: int, high: int, middle: int) -> Iterator[int]:
    """low .. high, from the middle outward."""
    if low > high:
        return
    yield middle
    for d in range(1, high - low + 1):
        if middle + d <= high:
            yield middle + d
        if middle - d >= low:
            yield middle - d


def cut_levels(a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None):
    """The same leaf groups as :func:`cut_groups`, all intervals of a level split at once.

    ``lo``/``hi`` are the A token ranges of the starting intervals (default: one over all), whose
    last ends must be common. Returns, per leaf group in order, the index of its last A token and of
    its last B token. The common ends are located by one bisection of B's ends for all of A's; then
    every interval of a level takes the inner common end nearest its middle (the right one on a tie),
    until no interval has one.
    """
    j = np.searchsorted(b_ends, a_ends)
    common = np.flatnonzero((j < len(b_ends)) & (b_ends[np.minimum(j, len(b_ends) - 1)] == a_ends))
    lo = np.array([0]) if lo is None else lo
    hi = np.array([len(a_ends)]) if hi is None else hi
    first = np.searchsorted(common, lo)
    stop = np.searchsorted(common, hi - 1)  # inner cuts of an interval: common[first:stop]
    leaves_hi = []
    while len(lo):
        leaf = first >= stop
        leaves_hi.append(hi[leaf])
        lo, hi, first, stop = lo[~leaf], hi[~leaf], first[~leaf], stop[~leaf]
        middle = (lo + hi - 2) // 2
        right = np.clip(np.searchsorted(common, middle), first, stop - 1)
        left = np.maximum(right - 1, first)
        at = np.where(middle - common[left] < common[right] - middle, left, right)
        pick = common[at]
        lo, hi = np.concatenate([lo, pick + 1]), np.concatenate([pick + 1, hi])
        first, stop = np.concatenate([first, at + 1]), np.concatenate([at, stop])
    a_last = np.sort(np.concatenate(leaves_hi)) - 1
    return a_last, j[a_last]


def cuts_at_spaces(path: str, pieces: list[bytes]) -> bool:
    """Whether the model always ends a token before a space that follows anything but a space.

    So it is for a BPE model that leaves the text as it is and none of whose pieces holds such a space:
    symbols merge only into pieces, so none ever crosses one, and each side merges as it does alone.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2 as described
    except ImportError:  # needs protobuf; without it nothing is known of the model
        return False
    model = described.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trained, normal = model.trainer_spec, model.normalizer_spec
    return (
        trained.model_type == trained.BPE
        and not trained.treat_whitespace_as_suffix
        and normal.add_dummy_prefix
        and normal.escape_whitespaces
        and not normal.remove_extra_whitespaces
        and not normal.precompiled_charsmap
        and not any(b" " in piece.lstrip(b" ") for piece in pieces)
    )


def tokenizers(a_path: str, b_path: str) -> tuple[Merges, np.ndarray, str, list[bytes], bool]:
    """What an :class:`Aligner` needs of both files: A's merges and token sizes, B's path and token bytes, whether B cuts at spaces."""
    vocabulary, b_bytes = Vocabulary(a_path), piece_bytes(b_path)
    keys = np.array([a << 32 | b for a, b in vocabulary.merges], np.int64)
    ranks, merged = np.array(list(vocabulary.merges.values()), np.int32).reshape(-1, 2).T
    a_sizes = np.array([len(t) for t in vocabulary.token_bytes], np.int64)
    return Merges(np.array(vocabulary.byte_ids, np.int32), keys, ranks, merged), a_sizes, b_path, b_bytes, cuts_at_spaces(b_path, b_bytes)


# White space before a space, where A's pre-tokens may run on; and where words begin in texts that have it.
_RUN = regex.compile(r"\s ")
_WORDS = regex.compile(r"(?s)(?<=\S)(?= .)")


def words(text: str) -> list[str]:
    """space + text cut before every space that follows no white space, each part without its first space.

    A space that ends the text stays with the last word, so that no part is empty.
    """
    if text[0] == " " or _RUN.search(text):
        return [part[1:] for part in _WORDS.split(" " + text)]
    found = text.split(" ")
    if not found[-1]:
        found[-2:] = [found[-2] + " "]
    return found


class Rows(dict):
    """word -> its row; a word that is looked up for the first time gets the next row and is noted in ``new``."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = row = len(self)
        return row


class Aligner:
    """Aligns batches of texts; holds one worker's tokenizers and the words it has aligned, as arrays."""

    def __init__(self, merges: Merges, a_sizes: np.ndarray, b_path: str, b_bytes: list[bytes], split: bool, chunk: int = CHUNK, memory: int = MEMORY) -> None:
        import sentencepiece

        self.merges, self.merger, self.a_sizes = merges, Merger(merges), a_sizes
        self.byte_ids = merges.byte_ids.tolist()
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes, self.b_sizes = b_bytes, np.array([len(t) for t in b_bytes], np.int64)
        self.a_bits = max(1, (len(a_sizes) - 1).bit_length())
        self.b_bits = max(1, (len(b_bytes) - 1).bit_length())
        self.split, self.chunk, self.memory = split, chunk, memory
        self._start()

    def _start(self) -> None:
        self.known, self.held = Rows(), 0
        self.used = np.empty(0, np.int64)  # how often each word was met
        self.good = np.empty(0, bool)  # both tokenizers give the word's bytes
        self.counts = np.empty((0, 4), np.int32)  # A tokens, B tokens, groups, links
        self.links = np.empty(0, np.int64)  # A id << b_bits | B id of every link, word after word
        self.first = np.empty(0, np.int64)  # a word's first link
        self.said = pa.array([], pa.large_binary())  # a word's groups, each closed by ";"

    def _forget(self) -> None:
        """Keep the words met more than once, unless they fill most of the memory."""
        keep, parts = np.flatnonzero(self.used > 1), list(self.known)
        kept = list(map(parts.__getitem__, keep.tolist()))
        held = sum(map(len, kept))
        if len(kept) > self.memory * 3 // 4 or held > MEMORY_CHARS * 3 // 4:
            self._start()
            return
        self.known, self.held = Rows(zip(kept, count())), held
        self.used, self.good, self.counts = self.used[keep] // 2, self.good[keep], self.counts[keep]
        n_links = self.counts[:, 3].astype(np.int64)
        self.links = self.links[_runs(self.first[keep], n_links)]
        self.first = np.cumsum(n_links) - n_links
        self.said = self.said.take(pa.array(keep))

    def batch(self, texts: list[str | None]) -> dict[str, np.ndarray | list[str]]:
        """Per text n_a, n_b, n_groups, groups_sha256 and n_pairs; la, lb, ln: the linked id pairs of all texts with their counts."""
        n = len(texts)
        out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_pairs")} | {"groups_sha256": [""] * n}
        pairs: list[tuple[np.ndarray, ...]] = []
        docs, parts, held = [], [], 0
        for d, text in enumerate(texts):
            if not text:
                continue
            docs.append(d)
            parts.append(words(text) if self.split else [text])
            held += len(text)
            if held >= self.chunk:  # the arrays of one pass stay small, a long text is still whole
                pairs.append(self._joined(docs, parts, out))
                docs, parts, held = [], [], 0
        if docs:
            pairs.append(self._joined(docs, parts, out))
        for k, arrays in zip(("la", "lb", "ln"), zip(*pairs) if pairs else [()] * 3):
            out[k] = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
        return out

    def _joined(self, docs: list[int], parts: list[list[str]], out: dict) -> tuple[np.ndarray, ...]:
        """Alignments of texts from those of their words; fills ``out`` and returns the linked pairs."""
        rows = self._rows(list(chain.from_iterable(parts)))
        docs, size = np.array(docs), np.array([len(p) for p in parts])
        good = np.logical_and.reduceat(self.good[rows], np.cumsum(size) - size)
        if not good.all():
            rows, docs, size = rows[np.repeat(good, size)], docs[good], size[good]
        if not len(docs):
            return (np.empty(0, np.int64),) * 3
        counts = self.counts[rows]
        total = np.add.reduceat(counts, np.cumsum(size) - size, axis=0, dtype=np.int64)
        out["n_a"][docs], out["n_b"][docs], out["n_groups"][docs] = total[:, 0], total[:, 1], total[:, 2]
        bits = self.a_bits + self.b_bits
        keys = np.repeat(np.arange(len(docs)) << bits, total[:, 3]) | self.links[_runs(self.first[rows], counts[:, 3].astype(np.int64))]
        keys.sort()
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times, keys = np.diff(new, append=len(keys)), keys[new]
        out["n_pairs"][docs] = np.bincount(keys >> bits, minlength=len(docs))
        said = self.said.take(pa.array(rows))
        ends = np.frombuffer(said.buffers()[1], np.int64)[said.offset :]
        data, bounds = memoryview(said.buffers()[2]), ends[np.append(0, np.cumsum(size))].tolist()
        for k, d in enumerate(docs.tolist()):  # without the last ";"
            out["groups_sha256"][d] = hashlib.sha256(data[bounds[k] : bounds[k + 1] - 1]).hexdigest()
        return (keys >> self.b_bits) & ((1 << self.a_bits) - 1), keys & ((1 << self.b_bits) - 1), times

    def _rows(self, parts: list[str]) -> np.ndarray:
        """Row of every word in the arrays, those not remembered aligned first."""
        if len(self.known) > self.memory or self.held > MEMORY_CHARS:
            self._forget()
        rows = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        self.used += np.bincount(rows, minlength=len(self.used))
        return rows

    def _learn(self, new: list[str]) -> None:
        """Align words and append them to the arrays."""
        texts = [" " + w for w in new]
        raw = [t.encode() for t in texts]
        length = np.array([len(r) for r in raw], np.int64)
        a, a_count = self._a_ids(texts)
        lists = self.model.encode(new, num_threads=1)
        b_count = np.array([len(x) for x in lists], np.int64)
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(b_count.sum()))
        a_size = _sums(self.a_sizes[a], a_count)
        b_size = _sums(self.b_sizes[b], b_count)
        good = (a_size == length) & (b_size == length)
        said = b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(lists)))
        if not good.all() or said != b"".join(raw):  # unknown pieces, or characters that B writes otherwise
            hi = np.cumsum(b_size).tolist()
            good &= np.array([said[e - s : e] == r for e, s, r in zip(hi, b_size.tolist(), raw)])
        counts, n = np.zeros((len(new), 4), np.int32), len(self.links)
        groups = pa.array([], pa.large_binary())
        if good.any():
            a, b = a[np.repeat(good, a_count)], b[np.repeat(good, b_count)]
            n_groups, n_links, links, groups = self._aligned(a, b, a_count[good], b_count[good])
            counts[good] = np.stack([a_count[good], b_count[good], n_groups, n_links], 1)
            self.links = np.concatenate([self.links, links])
        if not good.all():  # words that give no tokens have no groups
            groups = groups.take(pa.array(np.cumsum(good) - 1, mask=~good))
        self.said = pa.concat_arrays([self.said, groups])
        self.first = np.concatenate([self.first, n + np.cumsum(counts[:, 3], dtype=np.int64) - counts[:, 3]])
        self.counts, self.good = np.concatenate([self.counts, counts]), np.concatenate([self.good, good])
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        self.held += sum(map(len, new))

    @cached_property
    def pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        """The merge table as :func:`merge_piece` reads it."""
        keys, ranks, merged = self.merges.keys.tolist(), self.merges.ranks.tolist(), self.merges.results.tolist()
        return {(k >> 32, k & 0xFFFFFFFF): (r, m) for k, r, m in zip(keys, ranks, merged)}

    def _a_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all texts, one after the other, and how many each has."""
        ids, counts = [], np.zeros(len(texts), np.int64)
        waiting, owner, held = [], [], 0
        for i, text in enumerate(texts):
            for block in pre_tokens(text) if len(text) > BLOCK else (_PRE.findall(text),):
                waiting.append(block)
                owner.append(i)
                held += len(block)
                if held >= BLOCK:
                    ids.append(self._merged(waiting, owner, counts))
                    waiting, owner, held = [], [], 0
        ids.append(self._merged(waiting, owner, counts))
        return np.concatenate(ids).astype(np.int64), counts

    def _merged(self, blocks: list[list[str]], owner: list[int], counts: np.ndarray) -> np.ndarray:
        """A's ids of lists of pre-tokens, each different one merged once; adds their numbers to the owners' counts."""
        index = Rows()
        at = np.fromiter(map(index.__getitem__, chain.from_iterable(blocks)), np.int64)
        if not len(at):
            return np.empty(0, np.int32)
        pieces = [p.encode() for p in index.new]
        found = self.merger.merge([p if len(p) <= LONG else b"" for p in pieces])
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                found[i] = np.array(merge_piece([self.byte_ids[b] for b in p], self.pairs), np.int32)
        size = np.array(list(map(len, found)), np.int64)
        np.add.at(counts, owner, _sums(size[at], np.array(list(map(len, blocks)), np.int64)))
        return np.concatenate(found)[_runs((np.cumsum(size) - size)[at], size[at])]

    def _aligned(self, a: np.ndarray, b: np.ndarray, a_count: np.ndarray, b_count: np.ndarray) -> tuple:
        """Per word the numbers of groups and links; then all links as A id << b_bits | B id; per word its groups."""
        a_hi, b_hi = np.cumsum(a_count), np.cumsum(b_count)
        # Ends over all words: they follow each other, and every word's last end is common.
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_last, b_last = cut_levels(a_ends, b_ends, a_hi - a_count, a_hi)
        n_groups = np.diff(np.searchsorted(a_last, a_hi - 1, side="right"), prepend=0)
        # Links: each elementary byte segment between consecutive ends lies in one A and one B token.
        ends = np.union1d(a_ends, b_ends)
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        owner = np.repeat(np.arange(len(a_count)), a_count)[at_a]
        # Groups: A ids, '|', B ids, ';'.
        a_closes, b_closes = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_closes[a_last], b_closes[b_last] = 1, 1
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        separators = pa.array([",", "|", ";"]).take(pa.array(np.concatenate([a_closes, 2 * b_closes])))
        ids = pc.binary_join_element_wise(pc.cast(pa.array(np.concatenate([a, b])), pa.string()), separators, "")
        offsets = np.concatenate([[0], np.cumsum(a_count + b_count)]).astype(np.int32)
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.take(pa.array(order))), "")
        links = (a[at_a] << self.b_bits) | b[at_b]
        return n_groups, np.bincount(owner, minlength=len(a_count)), links, groups.cast(pa.large_string()).cast(pa.large_binary())


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    hi = np.cumsum(counts)
    return upto[hi] - upto[hi - counts]


def _runs(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of runs of ``counts`` values that begin at ``first``, one run after the other."""
    return np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype()), kind))


# One aligner per Python worker, that of its last broadcast, so that its memory of words outlives a task.
_ALIGNERS: dict[str, Aligner] = {}


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, *tokenizers(a_path, b_path)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, *both = shared.value
        if key not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[key] = Aligner(*both)
        aligner = _ALIGNERS[key]
        for batch in batches:
            found = aligner.batch(batch.column("_al_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_al_row"), batch.column("_al_id")]
                + [pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups")]
                + [pa.array(found["groups_sha256"], pa.string())]
                + [_lists(found[k], found["n_pairs"], t) for k, t in (("la", pa.int32()), ("lb", pa.int32()), ("ln", pa.int64()))],
                ["_al_row", "_al_id", "n_a", "n_b", "n_groups", "groups_sha256", "la", "lb", "ln"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("_al_row"), F.col(id_col).alias("_al_id"), F.col(text_col).alias("_al_text")
    )
    schema = (
        f"_al_row long, _al_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "la array<int>, lb array<int>, ln array<long>"
    )
    aligned = store(rows.mapInArrow(run, schema), "aligned")
    # One row per (document, linked id pair) with its multiplicity: each document counts a pair once.
    linked = aligned.select("_al_row", F.inline(F.arrays_zip(F.col("la").alias("a"), F.col("lb").alias("b"), F.col("ln").alias("n"))))
    counts = store(linked.groupBy("a", "b").agg(F.count("*").alias("docs")), "pair_counts")
    # At most one row per A id of the vocabulary: bounded by the file, safe to send to every task.
    tops = counts.groupBy("a").agg(F.max("docs").alias("top"))
    rated = counts.join(F.broadcast(tops), "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))
    if counts.count() <= BROADCAST_PAIRS:
        rated = F.broadcast(rated)
    per_doc = (
        linked.join(rated, ["a", "b"])
        .groupBy("_al_row")
        .agg(
            F.sum("n").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("docs")).alias("count_sum"),
        )
    )
    done = aligned.join(per_doc, "_al_row", "left").select(
        F.col("_al_id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
    return done

