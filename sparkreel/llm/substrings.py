"""Removal of long byte strings that occur more than once anywhere in the corpus.

Two equal strings of ``window`` bytes have the same anchor: the leftmost of the ``ANCHOR`` bytes in them
whose hash is least. The windows of a text fall into segments by anchor (some 170 starts each), and only
segments of one anchor have to be compared:

* segments that occur twice are found by a count of their hashes (128 bits), whatever their number;
* of the others, one of each kind goes with its bytes to the shard of its anchor, if the anchor has
  several kinds. A shard's suffixes are sorted by external induced sorting (``induced.py``) with their
  common prefixes, and neighbours that share ``window`` bytes are repeats.

Texts are written once, in compressed blocks, and never shuffled: the tasks that hold a block read what
they need to know about it from tables that are sorted by block. An anchor's segments of distinct bytes
meet in one shard; a shard holds many anchors up to ``SHARD_BYTES``, or one anchor that has more.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, map_rows, materialise, new_path, partitions, slices
from .induced import suffix_order

WINDOW, ANCHOR = 400, 64
#: Bytes of text in a block, about (a longer text is a block of its own), and window starts taken at a time.
BLOCK_BYTES, CHUNK = 4 << 20, 1 << 19
#: Bytes whose suffixes are sorted together, about; one anchor's segments stay together.
SHARD_BYTES = 4 << 20
_BASE, _U = 0x9E3779B97F4A7C15, np.uint64
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def cut_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(block, ids, sizes, data)``: texts in UTF-8 behind each other, compressed; nothing is shuffled."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal ids, texts, size, number
            number += 1
            sizes = np.array([len(t) for t in texts], "<i8")
            columns = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes.tobytes()], pa.binary()), pa.array([squeeze.compress(b"".join(texts))], pa.binary())]
            ids, texts, size = [], [], 0
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "sizes", "data"])

        for batch in batches:
            for part in slices(batch, 1, BLOCK_BYTES // 8):
                ids += part.column(0).to_pylist()
                own = part.column(1).cast(pa.binary()).to_pylist()
                texts += own
                size += sum(map(len, own))
                if size >= BLOCK_BYTES:
                    yield out()
        if ids:
            yield out()

    return map_rows(rows, "block long, ids array<long>, sizes binary, data binary", run)


def _bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8) if data else np.empty(0, np.uint8)


def anchors(data: np.ndarray, window: int = WINDOW, width: int = ANCHOR) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For runs of window starts of ``data``: each window's anchor (its place in ``data``) and the anchor's hash, with the run's first start."""
    reach, bits = window - width + 1, _U(CHUNK + 2 * window).item().bit_length()
    forth = _powers(_BASE, CHUNK + window)
    back = _powers(pow(_BASE, -1, 1 << 64), CHUNK + window)
    for first in range(0, len(data) - window + 1, CHUNK):
        part = data[first : first + CHUNK + window - 1]
        sums = np.append(_U(0), np.cumsum(part * forth[: len(part)], dtype=_U))
        h = (sums[width:] - sums[:-width]) * back[: len(part) - width + 1]
        h = (h ^ (h >> _U(31))) * _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        # The place in the low bits makes the leftmost the least of equal hashes.
        keys = h >> _U(bits) << _U(bits) | np.arange(len(h), dtype=_U)
        starts = len(part) - window + 1
        rows = -(-len(keys) // reach)
        square = np.full(rows * reach, np.iinfo(_U).max, _U)
        square[: len(keys)] = keys
        square = square.reshape(rows, reach)
        upto = np.minimum.accumulate(square, axis=1).ravel()
        since = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(since[:starts], upto[reach - 1 : reach - 1 + starts]) & _U((1 << bits) - 1)
        at = least.astype(np.int64)
        yield first + at, h[at].view(np.int64), first


def segments(data: np.ndarray, sizes: np.ndarray, window: int = WINDOW, width: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, end of starts, and anchor hash of the segments of texts that stand behind each other."""
    ends = np.cumsum(sizes)
    out = []
    for anchor, h, first in anchors(data, window, width):
        start = first + np.arange(len(anchor))
        doc = np.searchsorted(ends, start, "right")
        inside = start + window <= ends[doc]
        cut = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])))
        upto = np.append(cut[1:], len(anchor))
        own = inside[cut]
        out.append((start[cut[own]], first + upto[own], h[cut[own]]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def segment_rows(blocks: DataFrame, window: int, width: int) -> DataFrame:
    """``(block, first, upto, anchor, content)``: every segment, with a hash of its windows' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, packed in zip(*(c.to_pylist() for c in batch.columns)):
                data = _bytes(packed)
                first, upto, anchor = segments(data, np.frombuffer(sizes, "<i8"), window, width)
                view = memoryview(data)
                content = [xxhash.xxh3_128_digest(view[a : z + window - 1]) for a, z in zip(first.tolist(), upto.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), block)), pa.array(first), pa.array(upto), pa.array(anchor), pa.array(content, pa.binary())], ["block", "first", "upto", "anchor", "content"])

    return map_rows(blocks.select("block", "sizes", "data"), "block long, first long, upto long, anchor long, content binary", run)


def by_block(df: DataFrame, name: str) -> Callable[[int], pa.Table]:
    """A function for tasks that reads the rows of one block from ``df``, written in ranges of blocks.

    It carries a path and two numbers for each file. A task's blocks follow each other, so it keeps
    the file that it read last.
    """
    found = materialise(df, f"{name}-unsorted")  # the ranges are sampled, which would make the rows twice
    table = materialise(found.repartitionByRange("block").sortWithinPartitions("block", "first"), name)
    path = F.input_file_name()
    files = sorted(tuple(r) for r in table.groupBy(path.alias("file")).agg(F.min("block").alias("low"), F.max("block").alias("high")).select("low", "high", "file").collect())
    lows, names, held = [f[0] for f in files], [c for c in df.columns if c != "block"], {}
    empty = pa.schema([(c, pa.int64() if c != "open" else pa.bool_()) for c in names]).empty_table()

    def read(block: int) -> pa.Table:
        at = bisect.bisect_right(lows, block) - 1
        if at < 0 or files[at][1] < block:
            return empty
        if at not in held:
            held.clear()
            system, inner = filesystem(files[at][2])
            held[at] = pq.read_table(inner, filesystem=system).combine_chunks()
        rows = held[at]
        a, z = np.searchsorted(rows.column("block").to_numpy(), [block, block + 1]).tolist()
        return rows.slice(a, z - a).select(names)

    return read


def with_bytes(blocks: DataFrame, read: Callable[[int], pa.Table], window: int) -> DataFrame:
    """The segments that ``read`` knows of, with the bytes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(*(c.to_pylist() for c in batch.columns)):
                rows = read(block)
                if not rows.num_rows:
                    continue
                view = memoryview(_bytes(packed))
                first, upto = rows.column("first").to_numpy(), rows.column("upto").to_numpy()
                data = pa.array([view[a : z + window - 1] for a, z in zip(first.tolist(), upto.tolist())], pa.binary())
                columns = {c: rows.column(c).combine_chunks() for c in ("first", "upto", "anchor", "open")}
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(first), block)), **columns, "data": data})

    return map_rows(blocks.select("block", "data"), "block long, first long, upto long, anchor long, open boolean, data binary", run)


def repeated_starts(data: list[bytes], owned: list[int], window: int, folder: str | None) -> list[np.ndarray]:
    """For each segment, which of its first ``owned`` places start ``window`` bytes that another owned place starts too."""
    text = np.frombuffer(b"\0".join([*data, b""]), np.uint8)
    bases = np.cumsum([0] + [len(d) + 1 for d in data[:-1]])
    mine, twice = np.zeros(len(text), bool), np.zeros(len(text), bool)
    for base, n in zip(bases.tolist(), owned):
        mine[base : base + n] = True
    last, least = -1, 0
    for suffixes, shared in suffix_order(text, 256, folder, window):
        rows = np.flatnonzero(mine[suffixes])
        more = np.append(shared, np.int32(np.iinfo(np.int32).max))
        between = np.minimum.reduceat(more, np.append(0, rows + 1))
        if last >= 0:
            between[0] = min(between[0], least)
        places = np.append(np.int64(max(last, 0)), suffixes[rows])
        meet = np.flatnonzero(between[: len(rows)] >= window)
        if last < 0:
            meet = meet[meet > 0]
        twice[places[meet]] = True
        twice[places[meet + 1]] = True
        if len(rows) or last >= 0:
            least, last = int(between[-1]), int(places[-1])
    return [twice[base : base + n] for base, n in zip(bases.tolist(), owned)]


def _shards(window: int, folder: str):
    names = ["block", "first", "upto"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            found: list[list[int]] = [[], [], []]
            flags = repeated_starts([w[4] for w in waiting], [w[2] - w[1] for w in waiting], window, folder)
            for (block, first, _, is_open, _, _), twice in zip(waiting, flags):
                if is_open and twice.any():
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], twice.view(np.int8), [0])))).tolist()
                    for a, z in zip(edges[::2], edges[1::2]):
                        for column, value in zip(found, (block, first + a, first + z)):
                            column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "first", "upto", "open", "data", "anchor"))):
                if size >= SHARD_BYTES and row[5] != waiting[-1][5]:
                    yield out()
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[4])
        if waiting:
            yield out()

    return run


def repeats(blocks: DataFrame, window: int = WINDOW, width: int = ANCHOR) -> DataFrame:
    """``(block, first, upto)``: runs of places in blocks that start ``window`` bytes which start elsewhere too."""
    spark = blocks.sparkSession
    rows = materialise(segment_rows(blocks, window, width), "segments")
    kinds = materialise(rows.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("block", "first", "upto")).alias("one")), "kinds")
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single")).where("kinds > 1 and single > 0")
    compared = kinds.join(mixed.select("anchor"), "anchor").select("one.*", "anchor", (F.col("n") == 1).alias("open"))
    carried = with_bytes(blocks, by_block(compared, "compared"), window)
    parts = max(partitions(spark), blocks.count())
    met = map_rows(carried.repartition(parts, "anchor").sortWithinPartitions("anchor"), "block long, first long, upto long", _shards(window, new_path(spark, "queues")))
    copies = rows.join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"]).select("block", "first", "upto")
    return copies.unionByName(met)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``, one row per document, texts as UTF-8.

    Every byte under a string of ``window`` bytes that also starts anywhere else, in this text or
    another, is removed; ``spans`` (start, end) are the maximal removed runs and ``kept`` is the rest.
    Strings are judged on the input. Null, empty and shorter texts lose nothing; rows of one text
    (repeated rows too) lose all of it where it has ``window`` bytes; null ids keep their rows; ties
    don't matter. An empty table gives no rows; extra columns are ignored.
    """
    blocks = materialise(cut_blocks(docs, id_col, text_col), "blocks")
    read = by_block(repeats(blocks, window, min(ANCHOR, window)), "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, sizes, packed in zip(*(c.to_pylist() for c in batch.columns)):
                data, sizes, rows = _bytes(packed), np.frombuffer(sizes, "<i8"), read(block)
                bounds = np.append(0, np.cumsum(sizes))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, rows.column("first").to_numpy(), 1)
                np.add.at(change, rows.column("upto").to_numpy() + window - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                heads = np.zeros(len(data) + 1, bool)
                heads[bounds] = True
                before = np.append(False, gone[:-1]) if len(gone) else gone
                after = np.append(gone[1:], False) if len(gone) else gone
                starts = np.flatnonzero(gone & (~before | heads[:-1]))
                ends = np.flatnonzero(gone & (~after | heads[1:])) + 1
                offsets = np.searchsorted(starts, bounds)
                base = np.repeat(bounds[:-1], np.diff(offsets))
                pairs = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"])
                left = np.append(0, np.cumsum(~gone))[bounds]
                rest = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(left), pa.py_buffer(data[~gone])])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs), rest.cast(pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return map_rows(blocks, "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary", run)
