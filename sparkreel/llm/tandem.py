"""Periodic runs in word sequences: stretches in which words q apart are identical.

The method is that of Gusfield and Stoye. Ukkonen's suffix tree of a sequence gives its Lempel-Ziv
blocks; at every block border the common extensions give squares that cover the leftmost ones; these
are placed in the tree, and walks over suffix links turn them until the tree holds every distinct
square. The leaves below a square are its occurrences, and occurrences that follow each other merge
into a run. Time is linear in the sequence, apart from the occurrences that are listed.

A run of exponent e holds each of its words e times or more, so a word that occurs less often between
two words already left out can't be part of one, and neither can it extend one. Leaving such words
out until none is left cuts texts into the stretches that get a tree; most prose has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, slices, split_words

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Bytes of texts taken at a time.
SLICE_BYTES = 1 << 19
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Ukkonen's tree of ``s``, numbers from 0 of which the last occurs once. Node 0 is the root."""

    def __init__(self, s: list[int]):
        n, self.m = len(s), max(s) + 1
        self.s, m = s, self.m
        start, end, link, edges = [0], [0], [0], {}
        node, edge, length, left = 0, 0, 0, 0
        for i, c in enumerate(s):
            left, last = left + 1, 0
            while left:
                if not length:
                    edge = i
                key = node * m + s[edge]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(start)
                    start.append(i), end.append(n), link.append(0)
                    if last:
                        link[last], last = node, 0
                else:
                    along = end[below] - start[below]
                    if length >= along:
                        edge, length, node = edge + along, length - along, below
                        continue
                    if s[start[below] + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(start[below]), end.append(start[below] + length), link.append(0)
                    start.append(i), end.append(n), link.append(0)
                    start[below] += length
                    edges[key], edges[split * m + c], edges[split * m + s[start[below]]] = split, split + 1, below
                    if last:
                        link[last] = split
                    last = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, i - left + 1
        self.edges, self.link = edges, link
        self._order(start, end)

    def _order(self, start: list[int], end: list[int]) -> None:
        """Parents, depths, leaves in order, and for each node its span of leaves and the least of them."""
        nodes, n = len(start), len(self.s)
        keys = np.fromiter(self.edges.keys(), np.int64, nodes - 1)
        below = np.fromiter(self.edges.values(), np.int64, nodes - 1)
        parents = keys // self.m
        by = np.argsort(parents, kind="stable")
        first_child = np.searchsorted(parents[by], np.arange(nodes + 1)).tolist()
        children = below[by].tolist()
        parent = [0] * nodes
        for v, p in zip(below.tolist(), parents.tolist()):
            parent[v] = p
        depth, low, leaves, order, stack = [0] * nodes, [0] * nodes, [], [], [0]
        while stack:
            v = stack.pop()
            order.append(v)
            low[v] = len(leaves)
            if v:
                depth[v] = depth[parent[v]] + end[v] - start[v]
            a, b = first_child[v], first_child[v + 1]
            if a == b:
                leaves.append(n - depth[v])
            else:
                stack += children[a:b]
        first, high = [n] * nodes, [0] * nodes
        for v in reversed(order):
            if first_child[v] == first_child[v + 1]:
                first[v], high[v] = leaves[low[v]], low[v] + 1
            p = parent[v]
            if v:
                first[p], high[p] = min(first[p], first[v]), max(high[p], high[v])
        self.parent, self.depth, self.first, self.low, self.high, self.order, self.leaves = parent, depth, first, low, high, order, leaves

    def blocks(self) -> list[int]:
        """Where the Lempel-Ziv blocks start, and the end of the last: each is the longest earlier match, or one new symbol."""
        s, m, at, borders = self.s, self.m, 0, [0]
        n = len(s) - 1  # the last symbol is the end mark
        while at < n:
            node, known = 0, 0
            while True:
                node = self.edges[node * m + s[at + known]]
                if self.first[node] >= at:
                    break
                known = self.depth[node]
            at += max(known, 1)
            borders.append(at)
        return borders


def _prefix_matches(s: list[int]) -> list[int]:
    """For each place how long a stretch from there equals the beginning of ``s``."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def covering_squares(s: list[int], borders: list[int]) -> dict[int, set[int]]:
    """Lengths of squares by their start, such that turning them to the right leads to every leftmost square."""
    n, out = borders[-1], {}
    for b in range(len(borders) - 1):
        h, h1 = borders[b], borders[b + 1]
        h2 = borders[b + 2] if b + 2 < len(borders) else n
        size = h1 - h
        if h1 < n:  # squares that start in the block and end in the next
            ahead = _prefix_matches([*s[h1 : min(h1 + size, n)], -1, *s[h:h1]])[-size:]
            behind = _prefix_matches(s[max(0, h1 - 2 * size) : h1][::-1])
            for k in range(1, size + 1):
                if forward := min(ahead[size - k], k):
                    back = min(behind[k], k) if k < len(behind) else 0
                    if forward + back >= k:
                        q = h1 - k
                        out.setdefault(max(q - back, q - k + 1), set()).add(2 * k)
        far = min(h2 - h, n - h)
        if h:  # squares that start before the block and whose first half ends in it
            ahead = _prefix_matches(s[h : min(h + 2 * far, n)])
            text = s[h : h + far][::-1]
            behind = _prefix_matches([*s[max(0, h - far) : h][::-1], -1, *text])[-len(text) :]
            for k in range(1, far + 1):
                forward = min(ahead[k], k) if k < len(ahead) else 0
                back = min(behind[len(text) - k], k)
                if forward and back and forward + back >= k:
                    start = max(h - back, h - k + 1)
                    if start + k <= h1:
                        out.setdefault(start, set()).add(2 * k)
    return out


def squares(tree: SuffixTree) -> set[tuple[int, int]]:
    """``(length, node)`` of every distinct square; it ends on the edge into the node."""
    s, m, parent, depth, first, link, edges = tree.s, tree.m, tree.parent, tree.depth, tree.first, tree.link, tree.edges
    held = {i: sorted(lengths) for i, lengths in covering_squares(s, tree.blocks()).items()}
    waiting: dict[int, list[int]] = {}
    placed = []
    for v in reversed(tree.order):  # a square hangs at its least leaf and climbs to its edge
        mine = held.get(first[v]) if tree.high[v] - tree.low[v] == 1 and v not in waiting else waiting.pop(v, None)
        if not mine or not v:
            continue
        up = parent[v]
        while mine and mine[-1] > depth[up]:
            placed.append((mine.pop(), v))
        if mine and first[up] == first[v]:
            waiting[up] = mine
    found = set(placed)
    for length, v in placed:
        while True:  # drop the first symbol over the suffix link, put it behind the last
            i, c = first[v], s[first[v]]
            w = link[parent[v]]
            at = depth[w]
            while at < length - 1:
                w = edges[w * m + s[i + 1 + at]]
                at = depth[w]
            if at == length - 1:
                w = edges.get(w * m + c)
                if w is None:
                    break
            elif s[first[w] + length - 1] != c:
                break
            if (length, w) in found:
                break
            found.add((length, w))
            v = w
    return found


def find_runs(s: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in the numbers ``s`` (from 0), by start, then period."""
    n = len(s)
    if n < max(min_length, 2):
        return []
    tree = SuffixTree([*s, max(s) + 1])
    ends, periods, out = np.zeros(n, np.int64), np.ones(n, np.int64), []
    by_length: dict[int, list[int]] = {}
    for length, v in squares(tree):
        by_length.setdefault(length, []).append(v)
    leaves = np.array(tree.leaves, np.int64)
    for length in sorted(by_length):
        q, starts = length // 2, []
        for v in by_length[length]:
            i = tree.first[v]
            if ends[i] >= i + length and q % periods[i] == 0:
                continue  # four or more of a shorter period: its run is known
            starts.append(leaves[tree.low[v] : tree.high[v]])
        if not starts:
            continue
        at = np.sort(np.concatenate(starts))
        breaks = np.flatnonzero(np.diff(at) > 1)
        for a, z in zip(at[np.append(0, breaks + 1)].tolist(), at[np.append(breaks, len(at) - 1)].tolist()):
            e = z + length
            if e - a >= 4 * q:
                longer = ends[a:e] < e
                periods[a:e][longer], ends[a:e][longer] = q, e
            if e - a >= max(min_length, min_exponent * q):
                out.append((a, e - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(of: np.ndarray, codes: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Where runs can be: stretches of words that all occur ``min_exponent`` times or more in theirs."""
    at, part = np.arange(len(codes)), of
    kinds = int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        _, place, times = np.unique(part * kinds + codes[at], return_inverse=True, return_counts=True)
        often = times[place] >= min_exponent
        if not often.all():
            at = at[often]
        cut = np.append(True, (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]])) if len(at) else np.empty(0, bool)
        part = np.cumsum(cut)
        sizes = np.bincount(part)
        wide = sizes[part] >= min_length
        if often.all() and wide.all():
            break
        at, part = at[wide], part[wide]
    starts = np.flatnonzero(np.append(True, np.diff(part) != 0)) if len(at) else np.empty(0, np.int64)
    firsts, lasts = at[starts], at[np.append(starts[1:] - 1, len(at) - 1)] if len(at) else at
    return list(zip(firsts.tolist(), (lasts + 1).tolist()))


def mark_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
    rewrite: Callable[[str, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per document; nothing is shuffled.

    ``runs``: start, length and period in words, by start, then period, of every stretch of
    ``min_length`` words and ``min_exponent`` periods at least that no neighbour extends.
    ``collapsed``: the words, joined by one space, without those that lie in a run behind its first
    period. ``rewrite(id as text, number of words)`` may name the word that takes each place first.
    Null and empty texts have no words; a null id is "" to ``rewrite``; repeated rows repeat, ties
    don't matter; an empty table gives no rows; extra columns are ignored.
    """
    if min_exponent < 2:
        raise ValueError("a run holds two periods at least")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                bounds, codes, words = split_words(part.column(2))
                codes = codes.astype(np.int64)
                if rewrite:
                    for name, a, z in zip(part.column(1).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                        source = rewrite(name, z - a)
                        if source is not None:
                            codes[a:z] = codes[a:z][source]
                of = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(part.num_rows)]
                kept = np.ones(len(codes), bool)
                for a, z in stretches(of, codes, min_length, min_exponent):
                    local = np.unique(codes[a:z], return_inverse=True)[1].tolist()
                    doc = int(of[a])
                    for start, length, period in find_runs(local, min_length, min_exponent):
                        found[doc].append((a + start - int(bounds[doc]), length, period))
                        kept[a + start + period : a + start + length] = False
                offsets = np.append(0, np.cumsum(kept))[bounds].astype(np.int32)
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(codes[kept]))), " ")
                runs = pa.array([[{"start": r[0], "length": r[1], "period": r[2]} for r in rs] for rs in found], _RUNS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(bounds)), runs, text], ["doc_id", "n_words", "runs", "collapsed"])

    return map_rows(rows, f"doc_id long, n_words long, runs {RUNS}, collapsed string", run)


def digests(marked: DataFrame) -> DataFrame:
    """``marked`` as counts, the run of greatest exponent (ties: first start, then period), and hashes of runs and text."""
    best = F.expr(f"aggregate(runs, cast(null as {RUNS[6:-1]}), (m, r) -> if(m is null or r.length * m.period > m.length * r.period, r, m))")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return marked.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), sha(listed).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
