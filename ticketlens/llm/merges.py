"""Rank-synchronous pair merging over batches of pre-tokens held as ragged numpy arrays."""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import regex

# Fixed value: the published pre-token pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.iinfo(np.int32).max
# Longer pre-tokens are merged one pair at a time from a heap, in n log n steps, with the same result.
LONG = 1024
# Bytes of one symbol in a remembered result.
SYMBOL = np.dtype(np.int32).itemsize
# Pre-tokens whose result a worker remembers.
CACHE = 1 << 18


@dataclass(frozen=True)
class Merges:
    """Pairs of symbols with the rank of their merge and the symbol it gives, as plain arrays."""

    byte_ids: np.ndarray  # symbol of each single byte
    keys: np.ndarray  # left << 32 | right
    ranks: np.ndarray
    results: np.ndarray


def from_ranks(path: str) -> tuple[Merges, list[bytes]]:
    """A rank file: a pair merges if its bytes together are a token, in order of that token's rank."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    pairs = [
        (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    keys, results = np.array(pairs, np.int64).reshape(-1, 2).T
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return Merges(byte_ids, keys, results.astype(np.int32), results.astype(np.int32)), tokens


def from_json(path: str) -> tuple[Merges, list[str]]:
    """A byte-level BPE file with an ordered merge list; also its added tokens, which stand for themselves."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, pre = described["model"], described["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or described["normalizer"]:
        raise ValueError("only plain byte-level BPE files are counted")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in described["added_tokens"]):
        raise ValueError("only added tokens without strip rules are counted")
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
    results = np.array([vocab[a + b] for a, b in merges], np.int32)
    # Byte-level files write each byte as one printable character: itself, or the next code point from 256 up.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    byte_ids = np.array([vocab[chr(b if b in printable else next(shifted))] for b in range(256)], np.int32)
    return Merges(byte_ids, keys, np.arange(len(keys), dtype=np.int32), results), [t["content"] for t in described["added_tokens"]]


class Merger:
    """Merges many pre-tokens at a time; holds a hash table of the pairs and a bounded memory of results."""

    def __init__(self, merges: Merges) -> None:
        self.byte_ids = merges.byte_ids
        bits = max(4, int(len(merges.keys) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._slots = np.full(1 << bits, -1, np.int64)
        self._keys, self._ranks, self._results = merges.keys, merges.ranks, merges.results
        left, at = np.arange(len(self._keys)), self._hash(self._keys)
        while len(left):  # linear probing, all keys of a round at once
            free = self._slots[at] < 0
            self._slots[at[free]] = left[free]
            lost = self._slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self._mask
        self._known: dict[str, bytes] = {}

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the merges, -1 where it does not merge."""
        keys = left.astype(np.int64) << 32 | right
        found, todo, at = np.full(len(keys), -1), np.arange(len(keys)), self._hash(keys)
        while len(todo):
            slot = self._slots[at]
            hit = (slot >= 0) & (self._keys[slot] == keys[todo])
            found[todo[hit]] = slot[hit]
            on = (slot >= 0) & ~hit
            todo, at = todo[on], (at[on] + 1) & self._mask
        return found

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The symbols that survive in each piece.

        In every round each unfinished sequence applies its lowest-ranked pair, leftmost first on
        equal rank; all sequences move together, and those without a pair left drop out.
        """
        done: list[np.ndarray] = [self._merge_long(p) if len(p) > LONG else None for p in pieces]
        owner = np.array([i for i, p in enumerate(pieces) if len(p) <= LONG and p], np.int64)
        for i, p in enumerate(pieces):
            if not p:
                done[i] = np.empty(0, np.int32)
        if not len(owner):
            return done
        lengths = np.array([len(pieces[i]) for i in owner], np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in owner), np.uint8)]
        last = np.cumsum(lengths) - 1
        which = np.append(self.find(sym[:-1], sym[1:]), -1)
        which[last] = -1
        while True:
            starts = np.cumsum(lengths) - lengths
            rank = np.where(which >= 0, self._ranks[which], NONE)
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():
                for i, s, n in zip(owner[over].tolist(), starts[over].tolist(), lengths[over].tolist()):
                    done[i] = sym[s : s + n].copy()
                stays = np.repeat(~over, lengths)
                sym, which, rank = sym[stays], which[stays], rank[stays]
                owner, lengths, least = owner[~over], lengths[~over], least[~over]
                if not len(owner):
                    return done
                starts = np.cumsum(lengths) - lengths
            hits = np.flatnonzero(rank == np.repeat(least, lengths))
            of = np.searchsorted(starts, hits, side="right") - 1
            at = hits[np.append(True, of[1:] != of[:-1])]  # one per sequence: the leftmost
            sym[at] = self._results[which[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, which = sym[keep], which[keep]
            lengths -= 1
            at -= np.arange(len(at))
            starts = np.cumsum(lengths) - lengths
            right = at[at < starts + lengths - 1]
            which[at] = -1
            which[right] = self.find(sym[right], sym[right + 1])
            left = at[at > starts] - 1
            which[left] = self.find(sym[left], sym[left + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        sym = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        index = {int(k): i for i, k in enumerate(self._keys)} if not hasattr(self, "_index") else self._index
        self._index, ranks, results = index, self._ranks, self._results
        n = len(sym)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                found = index.get(sym[i] << 32 | sym[j], -1)
                if found >= 0:
                    heapq.heappush(heap, (int(ranks[found]), i, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i] = int(results[index[a << 32 | b]])
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([s for s, ok in zip(sym, alive) if ok], np.int32)

    def symbols(self, pieces: Iterable[list[str]]) -> dict[str, bytes]:
        """Symbols of every piece in the lists, as the bytes of an int32 array; the answer may hold more pieces."""
        if len(self._known) > CACHE:
            self._known = {}
        known = self._known
        new = list(set().union(*pieces).difference(known))
        for p, ids in zip(new, self.merge([p.encode() for p in new])):
            known[p] = ids.tobytes()  # far smaller than lists of numbers, and joined without reading them
        return known


_PRE = regex.compile(PATTERN)
# Texts up to this many characters are cut at once, longer ones in runs of as many pre-tokens.
BLOCK = 1 << 18


def pre_tokens(text: str):
    """Lists of consecutive pre-tokens; a very long text never exists as one list."""
    if len(text) <= BLOCK:
        yield _PRE.findall(text)
        return
    block: list[str] = []
    for match in _PRE.finditer(text):
        block.append(match.group())
        if len(block) >= BLOCK:
            yield block
            block = []
    yield block
