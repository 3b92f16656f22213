"""Best-fit-decreasing packing of token pieces into sequences.

Pieces of one length are alike, so the packing needs only the histogram of lengths: at most
``capacity`` numbers, whatever the corpus. The driver runs best-fit decreasing on it, with a
segment tree over remaining capacities that finds the tightest open bin in logarithmic time, and
places as many equal pieces at a time as there are equal bins. Executors then number the pieces of
each length and read their places off the resulting intervals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_rows, materialise, partitions, slices
from .wordpieces import encoder

CAPACITY = 2048
END_ID = 0
#: Bytes of texts encoded at a time.
SLICE_BYTES = 4 << 20


class CapacityTree:
    """Which remaining capacities have open bins; least such capacity at or above a length."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size < capacity + 1:
            self.size *= 2
        self.any = bytearray(2 * self.size)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def push(self, room: int, bins: tuple[int, int]) -> None:
        self.bins[room].append(bins)
        at = room + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at //= 2

    def pop(self, room: int) -> tuple[int, int]:
        out = self.bins[room].pop()
        if not self.bins[room]:
            at = room + self.size
            self.any[at] = 0
            while at > 1 and not self.any[at ^ 1]:
                at //= 2
                self.any[at] = 0
        return out

    def tightest(self, length: int) -> int | None:
        at = length + self.size
        if self.any[at]:
            return length
        while at > 1 and not (at % 2 == 0 and self.any[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """``(length, rank, count, bin, offset)``: pieces rank.. of that length go to bins bin.. at offset."""
    tree, places, opened = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank, fit = histogram[length], 0, capacity // length
        while left and (room := tree.tightest(length)) is not None:
            first, size = tree.pop(room)
            n = min(left, size)
            places.append((length, rank, n, first, capacity - room))
            tree.push(room - length, (first, n))
            if size > n:
                tree.push(room, (first + n, size - n))
            left, rank = left - n, rank + n
        # No open bin is left for this length: whole new bins of it, then one with the remainder.
        for bins, layers in ((left // fit, fit), (1, left % fit)):
            if bins and layers:
                for layer in range(layers):
                    places.append((length, rank, bins, opened, layer * length))
                    rank += bins
                tree.push(capacity - layers * length, (opened, bins))
                opened += bins
    return places


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)``; ids as 32-bit little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                bounds, ids = enc.encode_all(part.column(1))
                ids = np.insert(ids, bounds[1:], end_id)  # the end after each document
                first = bounds + np.arange(len(bounds))
                total = np.diff(first)
                pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(pieces)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(total[doc] - start, capacity)
                data, at = ids.astype("<u4").tobytes(), 4 * (first[:-1][doc] + start)
                parts = [data[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                columns = [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(map(zlib.crc32, parts), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(parts, pa.binary())] if with_ids else [])], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""), run)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length``) plus ``sequence_id`` and ``offset``.

    The pieces of a length are numbered within salts dealt out when they are written, and counts
    per (length, salt) shift the numbers; so a length that a third of all pieces share is spread.
    """
    salts = partitions(pieces.sparkSession)
    salted = materialise(pieces.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))), "pieces")
    counts = materialise(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    places = np.array(best_fit_decreasing(histogram, capacity) or [(0, 0, 0, 0, 0)], np.int64)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    shift = 50
    first_keys = (places[:, 0] << shift) + places[:, 1]
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # capacity times salts rows, which grow with the partitions: joined in the order and places that numbering needs anyhow, never broadcast.
    offsets = counts.select("length", "salt", before.alias("before")).hint("merge")
    order = [c for c in ("doc_id", "piece", "start") if c in pieces.columns]
    own = F.row_number().over(W.partitionBy("length", "salt").orderBy(*order)) - 1
    ranked = salted.withColumn("own", own).join(offsets, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    columns = [*pieces.columns, "rank"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(first_keys, (length << shift) + rank, "right") - 1
            out = [pa.array(places[at, 3] + rank - places[at, 1]), pa.array(places[at, 4])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return map_rows(ranked.select(*columns), fields, run)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    Documents longer than ``capacity`` are cut into pieces of that length (the last may be
    shorter), others stay whole. Null and empty texts are the end id alone. A null doc_id keeps its
    rows, repeated rows are packed as often as they occur, other columns are ignored, and an empty
    table gives no rows. Sequences are gapless from offset 0 and hold at most ``capacity`` ids.
    """
    return place_pieces(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids=False), capacity)


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(sequence_id, ids)``: whole sequences, ids as 32-bit little-endian bytes; at most ``capacity`` pieces each."""
    placed = place_pieces(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
