"""Suffix order with common prefixes by induced sorting, the tuples in queues that spill to disk.

A suffix that is smaller than the next one is of type S, else L; an S suffix behind an L suffix is a
seed. Seeds are sorted by naming the stretches between them and sorting the suffixes of the names:
in memory where the names are few, else by this method again. One scan upwards from the seeds puts
the L suffixes into place, one downwards from those the S suffixes: a suffix that is scanned hands
its predecessor to the queue of the predecessor's first symbol. The queues are read in order of
symbols, first in first out, so together they are a monotone priority queue. A tuple is a suffix and the length
of its common prefix with the one before it in its queue, which is one more than the least such
length that was scanned between the two that handed them on.

The symbols themselves stay in memory; tuples, several times larger, don't have to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np

from .common import filesystem

#: Names up to this many have their suffixes sorted in memory, by doubling; longer ones by induction.
MEMORY_NAMES = 1 << 22
#: Bytes of tuples that the queues of one scan hold in memory.
QUEUE_BYTES = 96 << 20
_MOST = np.iinfo(np.int32).max


class Queues:
    """First-in first-out queues of (suffixes, common prefixes) by symbol; beyond ``limit`` bytes the largest go to files in ``folder``.

    Each spill is a file of its own, removed when it is read, so a queue needs no file that grows.
    """

    def __init__(self, folder: str | None, limit: int = QUEUE_BYTES):
        self.folder, self.limit, self.held, self.spilled = folder, limit, 0, 0
        self.blocks: dict[int, list] = {}

    def put(self, symbol: int, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        self.blocks.setdefault(symbol, []).append((suffixes, prefixes))
        self.held += suffixes.nbytes + prefixes.nbytes
        if self.held > self.limit and self.folder:
            self._spill()

    def _spill(self) -> None:
        size = {k: sum(b[0].nbytes + b[1].nbytes for b in blocks if not isinstance(b, str)) for k, blocks in self.blocks.items()}
        for symbol in sorted(size, key=size.get, reverse=True):
            if self.held <= self.limit // 2:
                break
            # Blocks in memory may stand behind files of the same queue: only the tail is in memory.
            blocks = self.blocks[symbol]
            first = next(i for i, b in enumerate([*blocks, ""]) if not isinstance(b, str) or not b)
            tail = blocks[first:]
            if tail:
                path = f"{self.folder}/{uuid.uuid4().hex}"
                files, at = filesystem(path)
                files.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with files.open_output_stream(at, compression=None) as out:
                    for column in (np.concatenate([b[i] for b in tail]) for i in (0, 1)):
                        np.save(out, column, allow_pickle=False)
                self.blocks[symbol] = [*blocks[:first], path]
                self.held -= size[symbol]
                self.spilled += 1

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that is in a queue now, in order; the queue is empty afterwards."""
        blocks = self.blocks.pop(symbol, None)
        if not blocks:
            return None
        parts = []
        for b in blocks:
            if isinstance(b, str):
                files, at = filesystem(b)
                with files.open_input_file(at) as f:
                    parts.append(tuple(np.load(f, allow_pickle=False) for _ in range(2)))
                files.delete_file(at)
            else:
                self.held -= b[0].nbytes + b[1].nbytes
                parts.append(b)
        return parts[0] if len(parts) == 1 else tuple(np.concatenate([p[i] for p in parts]) for i in (0, 1))


def suffix_types(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is of type S, and how often its first symbol stands there in a row."""
    n = len(s)
    turns = np.flatnonzero(s[:-1] != s[1:])
    place = np.cumsum(np.append(0, s[:-1] != s[1:])[:n])
    ends = np.append(turns, n - 1)[place]
    rising = np.append(s[turns] < s[turns + 1], False)  # the end of all is the smallest
    return rising[place], (ends - np.arange(n) + 1).astype(np.int32)


def name_stretches(s: np.ndarray, seeds: np.ndarray, kinds: int) -> np.ndarray:
    """Ranks (equal for equal stretches) of the stretches from each seed to the next one, both included.

    Behind its end a stretch counts as greater than any symbol, behind the end of all as smaller.
    """
    n, bits = len(s), int(kinds + 2).bit_length()
    step = 63 // bits
    lengths = np.append(seeds[1:], n) - seeds + 1
    rank, active, at = np.zeros(len(seeds), np.int64), np.arange(len(seeds)), 0
    while len(active):
        word = np.zeros(len(active), np.int64)
        for k in range(at, at + step):
            places = seeds[active] + k
            symbol = np.where(places < n, s[np.minimum(places, n - 1)].astype(np.int64) + 1, 0)
            word = word << bits | np.where(k < lengths[active], symbol, kinds + 1)
        by = np.lexsort((word, rank[active]))
        rank[active[by]] = _regrouped(rank[active[by]], word[by])
        at += step
        active = active[lengths[active] >= at]  # one that ends just here still lacks its end
        if len(active):
            _, group, times = np.unique(rank[active], return_inverse=True, return_counts=True)
            active = active[times[group] > 1]
    return rank


def _regrouped(rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """New ranks of sorted rows: a group's rank is its first member's place within the old group."""
    at = np.arange(len(rank))
    group = np.maximum.accumulate(np.where(np.append(True, rank[1:] != rank[:-1]), at, 0))
    part = np.maximum.accumulate(np.where(np.append(True, (rank[1:] != rank[:-1]) | (key[1:] != key[:-1])), at, 0))
    return rank + part - group


def doubled(rank: np.ndarray) -> np.ndarray:
    """The suffix order of ranks (a rank is the number of smaller ones), comparing twice as many each round."""
    n, width, rank = len(rank), 1, rank.copy()
    active = np.arange(n)
    while True:
        _, group, times = np.unique(rank[active], return_inverse=True, return_counts=True)
        active = active[times[group] > 1]
        if not len(active):
            return np.argsort(rank, kind="stable")
        ahead = active + width
        key = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.lexsort((key, rank[active]))
        rank[active[by]] = _regrouped(rank[active[by]], key[by])
        width *= 2


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of suffixes of bytes, ``most`` at the most."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(most + 16, np.uint8)))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out, active = np.zeros(len(a), np.int64), np.arange(len(a))
    for at in range(0, most, 8):
        differ = words[a[active] + at] ^ words[b[active] + at]
        ended = differ != 0
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        out[active[ended]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        active = active[~ended]
        if not len(active):
            break
    out[active] = most
    return np.minimum(np.minimum(out, most), n - np.maximum(a, b)).astype(np.int32)


class _Scan:
    """One scan: what is scanned hands on its predecessors of one type."""

    def __init__(self, s: np.ndarray, wanted: np.ndarray, kinds: int, queues: Queues, prefixes: bool):
        self.s, self.wanted, self.queues, self.prefixes = s, wanted, queues, prefixes
        #: The least common prefix scanned since each symbol's queue got its last; -1 before its first.
        self.since = np.full(kinds if prefixes else 1, -1, np.int32)

    def hand_on(self, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        before = suffixes - 1
        rows = np.flatnonzero((before >= 0) & self.wanted[before])
        least = np.minimum(self.since, prefixes.min()) if self.prefixes else self.since
        if len(rows):
            symbols = self.s[before[rows]]
            by = np.argsort(symbols, kind="stable")
            rows, symbols = rows[by], symbols[by]
            cuts = np.append(np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])), len(rows)).tolist()
            more = np.append(prefixes, np.int32(_MOST - 1)) if self.prefixes else None
            for a, z in zip(cuts[:-1], cuts[1:]):
                own, symbol = rows[a:z], int(symbols[a])
                shared = prefixes[: z - a]
                if self.prefixes:
                    between = np.minimum.reduceat(more, np.append(0, own + 1))
                    between[0] = min(between[0], self.since[symbol])
                    shared, least[symbol] = between[:-1] + np.int32(1), between[-1]
                self.queues.put(symbol, before[own], shared)
        self.since = least


def suffix_order(s: np.ndarray, kinds: int, folder: str | None, most: int = 0, memory: int = MEMORY_NAMES, limit: int = QUEUE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``s`` (whole numbers below ``kinds``) in order, in blocks, with the common prefix with the one before.

    Common prefixes are right up to ``most`` (longer ones may show as ``most`` or more); with 0 they
    aren't made, which is all that the order of names needs.
    """
    n = len(s)
    if not n:
        return
    small, runs = suffix_types(s)
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    place = np.int32 if n < 1 << 31 else np.int64
    if len(seeds):
        rank = name_stretches(s, seeds, kinds)
        if len(seeds) <= memory or len(np.unique(rank)) == len(rank):
            order = doubled(rank)
        else:
            order = np.concatenate([block for block, _ in suffix_order(rank, len(rank), folder, 0, memory, limit)])
        seeds = seeds[order].astype(place)
    else:
        seeds = seeds.astype(place)
    first = s[seeds]
    shared = np.zeros(len(seeds), np.int32)
    if most and len(seeds):
        shared[1:] = common_prefixes(s, seeds[:-1], seeds[1:], most)
    symbols = np.unique(s).tolist()
    starts, ends = np.searchsorted(first, symbols, "left").tolist(), np.searchsorted(first, symbols, "right").tolist()

    def border(a: int, b: int) -> int:
        """The common prefix of an L and an S suffix of one first symbol."""
        return min(runs[a], runs[b])

    up, larges = _Scan(s, ~small, kinds, Queues(folder, limit), most > 0), Queues(folder, limit)
    up.queues.put(int(s[-1]), np.array([n - 1], place), np.zeros(1, np.int32))
    if most:
        up.since[s[-1]] = 0  # the empty suffix, smaller than all, hands on the last symbol
    for symbol, a, z in zip(symbols, starts, ends):
        last = None
        while (block := up.queues.take(symbol)) is not None:
            larges.put(symbol, *block)
            up.hand_on(*block)
            last = int(block[0][-1])
        if a < z:
            own = shared[a:z].copy()
            own[0] = border(last, int(seeds[a])) if most and last is not None else 0
            up.hand_on(seeds[a:z], own)
    down, smalls = _Scan(s, small, kinds, Queues(folder, limit), most > 0), Queues(folder, limit)
    for symbol in reversed(symbols):
        last = None
        while (block := down.queues.take(symbol)) is not None:
            smalls.put(symbol, *block)
            down.hand_on(*block)
            last = int(block[0][-1])
        block = larges.take(symbol)
        if block is not None:
            larges.put(symbol, *block)
            own = np.append(np.int32(0), block[1][:0:-1])
            if most and last is not None:
                own[0] = border(int(block[0][-1]), last)
            down.hand_on(block[0][::-1], own)
    for symbol in symbols:
        large, tail = larges.take(symbol), smalls.take(symbol)
        if large is not None:
            yield large
        if tail is not None:
            own = np.append(np.int32(0), tail[1][:0:-1])
            if most and large is not None:
                own[0] = border(int(large[0][-1]), int(tail[0][-1]))
            yield tail[0][::-1], own
