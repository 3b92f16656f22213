"""SimHash near-duplicate search with a Gray-order hierarchical index.

A document's 64-bit fingerprint is taken over three-word shingles. Distinct fingerprints are the
nodes; copies only add members. Fingerprints at most ``max_bits`` apart are found so:

* The 64 bits are cut into six bands. Of two fingerprints that differ in at most two bits, four
  bands at least are equal, so the pair meets under one of the 15 choices of four bands. The masked
  pattern of those bands is the top level of the index and is Spark's shuffle key. What is left
  free is at most 22 bits, so a group can't hold more than 2**22 fingerprints (32 MB).
* Within a group fingerprints stand in Gray-rank order. Runs of ``FANOUT`` share a node that keeps
  the bits common to them (mask and pattern), less what its parent already keeps. A query goes down
  from the top adding up differing bits and leaves out a whole node once they exceed the limit.
* Only links that join two components of the group leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise, partitions
from .components import connected_components, join_labels

SEED = 42
SHINGLE = 3
MAX_BITS = 2
FANOUT = 8
#: (lowest bit, width) of the six bands.
BANDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
_CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one text; zero where there is no word."""
    words = (text or "").encode().lower().split()  # ASCII case and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash_of, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):
        part = [hash_of(line[a:b], SEED) for a, b in zip(starts[i : i + _CHUNK].tolist(), ends[i : i + _CHUNK].tolist())]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id long, fp long", run)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the top node level down to the fingerprints: (mask, pattern), without the parent's bits."""
    ones, zeros = x, ~x
    full = [(ones | zeros, x)]
    while len(ones) > FANOUT:
        at = np.arange(0, len(ones), FANOUT)
        ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        full.append((ones | zeros, ones))
    out = [full[-1]]
    for upper, (mask, pattern) in zip(full[:0:-1], full[-2::-1]):
        out.append((mask & ~np.repeat(upper[0], FANOUT)[: len(mask)], pattern))
    return out


def group_links(x: np.ndarray, max_bits: int = MAX_BITS, batch: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the near fingerprints of one group ``x`` in Gray order (positions)."""
    levels, n = _levels(x), len(x)
    label = np.arange(n)
    for lo in range(0, n, batch):
        q = np.arange(lo, min(n, lo + batch))
        mask, pattern = levels[0]
        who, node = np.repeat(q, len(mask)), np.tile(np.arange(len(mask)), len(q))
        apart = np.bitwise_count((x[who] ^ pattern[node]) & mask[node]).astype(np.int64)
        for depth, (mask, pattern) in enumerate(levels[1:], 2):
            span = FANOUT ** (len(levels) - depth + 1)
            near = (apart <= max_bits) & (who < (node + 1) * span)
            who, apart = np.repeat(who[near], FANOUT), np.repeat(apart[near], FANOUT)
            node = (node[near][:, None] * FANOUT + np.arange(FANOUT)).ravel()
            inside = node < len(mask)
            who, node, apart = who[inside], node[inside], apart[inside]
            apart = apart + np.bitwise_count((x[who] ^ pattern[node]) & mask[node])
        near = (apart <= max_bits) & (who < node)
        label = join_labels(label, who[near], node[near])
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _partition_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def solve(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
            sizes = ends - starts
            left, right = [], []
            size = np.repeat(sizes, sizes)
            small = size <= FANOUT  # one node: its fingerprints are compared at once
            for k in range(1, FANOUT):
                at = np.flatnonzero(small[:-k] & (key[:-k] == key[k:])) if len(key) > k else []
                near = np.bitwise_count(fp[at] ^ fp[np.asarray(at, np.int64) + k]) <= max_bits if len(at) else []
                if len(at):
                    left.append(fp[at[near]])
                    right.append(fp[at[near] + k])
            for i in np.flatnonzero(sizes > FANOUT):
                x = fp[starts[i] : ends[i]]
                a, b = group_links(x, max_bits)
                left.append(x[a])
                right.append(x[b])
            if not sum(map(len, left)):
                return None
            a, b = (np.concatenate(v).view(np.int64) for v in (left, right))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            key = np.concatenate((rest_key, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((rest_fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(key):
                continue
            end = int(np.searchsorted(key, key[-1])) if key[0] <= key[-1] else int(np.flatnonzero(key != key[-1])[-1] + 1)
            rest_key, rest_fp = key[end:], fp[end:]
            if end and (out := solve(key[:end], fp[:end])) is not None:
                yield out
        if len(rest_key) > 1 and (out := solve(rest_key, rest_fp)) is not None:
            yield out

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)``: enough to connect all near ones.

    Exact for ``max_bits`` up to 2, the number of bands a pair may differ in.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    keys = []
    for t, bands in enumerate(combinations(range(6), 4)):
        mask = sum(((1 << BANDS[i][1]) - 1) << BANDS[i][0] for i in bands)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(signed))))
    rank = F.col("fp")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    rows = (
        fps.select("fp", rank.alias("rank"))
        .select(F.explode(F.array(*keys)).alias("key"), "fp", "rank")
        .repartition(partitions(fps.sparkSession), "key")
        .sortWithinPartitions("key", "rank")
        .select("key", "fp")
    )
    return map_rows(rows, "a long, b long", _partition_links(max_bits)).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document.

    * ``fingerprint``: 16 lower-case hex digits. Null and wordless texts have fingerprint zero and
      link like any other.
    * ``component_id``: the least doc_id reachable over links, itself included. A null doc_id keeps
      its row and never names a component unless all its members' ids are null (then null).
    * Repeated rows stay repeated; an empty table gives an empty result; other columns are ignored.
    """
    members = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialise(members.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(near_links(classes, max_bits))
    named = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    named = materialise(named, "named")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = materialise(named.join(ids, "root").select("fp", "component_id"), "lookup")
    return members.join(lookup, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_named(docs: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id names its component in ``groups(doc_id, component_id)``, and those without an id."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names may hold any character
    own = F.col(f"c{docs.columns.index(id_col)}")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    named = numbered.join(kept, own.cast("long") == F.col("kept_id"), "left_semi")
    return named.union(numbered.where(own.isNull())).toDF(*docs.columns)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group.

    Rows that share an id with the kept document (repeated rows) are all kept; so are rows with a
    null id, which can't be told apart.
    """
    return keep_named(docs, near_duplicates(docs, id_col, text_col, max_bits), id_col)
