"""Token ids of documents in sorted-string-table shards.

A shard holds documents in key order: zstd-compressed blocks of prefix-compressed entries, a sparse
index with the first key of each block, a Bloom filter over the keys, and a fixed footer::

    block*  index  bloom  footer

Entry: varint shared key bytes, varint own key bytes, varint value bytes, own key bytes, value.
A key is the doc_id as 8 big-endian bytes with the sign bit flipped (bytes sort as numbers do), or
empty for a null doc_id, which sorts first. A value is the document's ids, 2 bytes each where the
vocabulary allows it, else 4, little-endian.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import filesystem, map_rows, materialise, new_path, partitions, publish, remove, slices
from .wordpieces import encoder

MAGIC = b"SRTOKSS1"
FOOTER = struct.Struct("<QQQQQQHHI8s")
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 256 << 20
#: Bytes of ids in a task that writes shards, about, and of texts encoded at a time.
PART_BYTES, SLICE_BYTES = 64 << 20, 4 << 20
BLOOM_BITS, BLOOM_PROBES = 10, 7
END_ID = 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def _probes(keys: np.ndarray, bits: int) -> np.ndarray:
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return (keys[:, None] + step[:, None] * np.arange(BLOOM_PROBES, dtype=np.uint64)) % np.uint64(bits)


class ShardWriter:
    """Adds documents in key order to an open binary file; memory is one block, the index and key hashes."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.at = self.entries = self.ids = 0
        self.block, self.first, self.last, self.before = bytearray(), None, b"", 0
        self.index, self.hashes = [], []
        self.zip = zstandard.ZstdCompressor(level=1)

    def add(self, doc_id: int | None, value: bytes) -> None:
        """``value``: the ids, ``width`` little-endian bytes each."""
        key = key_of(doc_id)
        if self.first is None:
            self.first, self.last, self.before = key, b"", self.ids
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.hashes.append(xxhash.xxh64_intdigest(key))
        self.entries += 1
        self.ids += len(value) // self.width
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.first is None:
            return
        packed = self.zip.compress(bytes(self.block))
        self.out.write(packed)
        self.index.append((self.first, self.at, len(packed), self.before))
        self.at += len(packed)
        self.block, self.first = bytearray(), None

    def size(self) -> int:
        return self.at + len(self.block)

    def finish(self) -> None:
        self._flush()
        index = b"".join(_varint(len(k)) + k + _varint(at) + _varint(n) + _varint(before) for k, at, n, before in self.index)
        bits = max(64, BLOOM_BITS * self.entries + 7 & ~7)
        bloom = np.zeros(bits, np.uint8)
        for i in range(0, len(self.hashes), 1 << 16):
            bloom[_probes(np.array(self.hashes[i : i + (1 << 16)], np.uint64), bits).ravel()] = 1
        bloom = np.packbits(bloom).tobytes()
        self.out.write(index)
        self.out.write(bloom)
        self.out.write(FOOTER.pack(self.entries, self.ids, self.at, len(index), self.at + len(index), bits, self.width, BLOOM_PROBES, zlib.crc32(index + bloom), MAGIC))


class Shard:
    """A written shard: lookups by binary search, and a scan in key order."""

    def __init__(self, uri: str):
        files, path = filesystem(uri)
        self.file = files.open_input_file(path)
        end = self.file.size()
        tail = self.file.read_at(FOOTER.size, end - FOOTER.size)
        self.entries, self.ids, at, n, bloom_at, self.bits, self.width, _, crc, magic = FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        rest = self.file.read_at(end - FOOTER.size - at, at)
        if zlib.crc32(rest) != crc:
            raise ValueError(f"{uri}: index or filter is damaged")
        index, self.bloom = rest[:n], np.frombuffer(rest[bloom_at - at :], np.uint8)
        self.keys, self.blocks, i = [], [], 0
        while i < len(index):
            size, i = _read_varint(index, i)
            self.keys.append(index[i : i + size])
            i += size
            pos, i = _read_varint(index, i)
            size, i = _read_varint(index, i)
            before, i = _read_varint(index, i)
            self.blocks.append((pos, size, before))
        self.unzip = zstandard.ZstdDecompressor()

    def _entries(self, number: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
        pos, size, start = self.blocks[number]
        data, at, key = self.unzip.decompress(self.file.read_at(size, pos)), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            own, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + own]
            at += own
            ids = np.frombuffer(data, f"<u{self.width}", n // self.width, at)
            at += n
            yield key, start, ids
            start += len(ids)

    def scan(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the shard, ids), in key order."""
        for number in range(len(self.blocks)):
            for key, start, ids in self._entries(number):
                yield id_of(key), start, ids

    def may_hold(self, doc_id: int | None) -> bool:
        at = _probes(np.array([xxhash.xxh64_intdigest(key_of(doc_id))], np.uint64), self.bits)[0].astype(np.int64)
        return bool((self.bloom[at >> 3] >> (7 - (at & 7)) & 1).all())

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of a document (the first of rows that share its id), or None."""
        return next(self.get_all(doc_id), None)

    def get_all(self, doc_id: int | None) -> Iterator[np.ndarray]:
        """The ids of all rows with an id."""
        key = key_of(doc_id)
        if not self.may_hold(doc_id):
            return
        for number in range(max(0, bisect.bisect_left(self.keys, key) - 1), len(self.keys)):
            if self.keys[number] > key:
                return
            for found, _, ids in self._entries(number):
                if found == key:
                    yield ids


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """``(doc_id, tie, place, ids)`` and the bytes of an id in them: two where vocabulary and end allow it, else four."""
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, 3, SLICE_BYTES):
                bounds, ids = enc.encode_all(part.column(3))
                data = np.insert(ids, bounds[1:], end_id).astype(f"<u{width}").tobytes()
                offsets = (bounds + np.arange(len(bounds))) * width
                values = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*part.columns[:3], values], ["doc_id", "tie", "place", "ids"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("place"), text.alias("text"))
    return map_rows(rows, "doc_id long, tie long, place long, ids binary", run), width


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all documents in ascending doc_id order; the manifest of shards.

    Texts are encoded where they are read; their ids are written once and dealt out by ranges of
    doc_id (ties: by text, then by place in the input), so one id that many rows share is no single
    task, in as many parts as ``PART_BYTES`` asks for. A task writes its range in order, starting a new
    shard at ``shard_bytes``. Shards are renamed into place, and only those in the manifest count:
    a task that runs twice leaves a file that nothing refers to.
    Manifest: path, first and last doc_id, n_docs, n_ids, part, roll, start (ids in all shards before).
    """
    spark = docs.sparkSession
    encoded, width = encode_documents(docs, tokenizer, end_id, id_col, text_col)
    encoded = materialise(encoded, "encoded")
    parts = -(-int(encoded.agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()[0]) // PART_BYTES)
    order = ["doc_id", "tie", "place"]
    rows = encoded.repartitionByRange(max(partitions(spark), parts), *order).sortWithinPartitions(*order).select("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, roll = TaskContext.get().partitionId(), 0
        flow = (row for b in batches for s in slices(b, 1, SLICE_BYTES) for row in zip(s.column(0).to_pylist(), s.column(1).to_pylist()))
        item = next(flow, None)
        while item is not None:
            path = f"{folder}/shard-{part:06d}-{roll:04d}-{uuid.uuid4().hex}.sst"
            seen: dict = {"first": item[0]}

            def fill(out) -> None:
                nonlocal item
                writer = ShardWriter(out, width)
                while item is not None and writer.size() < shard_bytes:
                    writer.add(*item)
                    seen["last"] = item[0]
                    item = next(flow, None)
                writer.finish()
                seen.update(docs=writer.entries, ids=writer.ids)

            publish(path, fill)
            yield pa.RecordBatch.from_pylist([{"path": path, "first": seen["first"], "last": seen["last"], "n_docs": seen["docs"], "n_ids": seen["ids"], "part": part, "roll": roll}], pa.schema([("path", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("part", pa.int32()), ("roll", pa.int32())]))
            roll += 1

    manifest = materialise(map_rows(rows, "path string, first long, last long, n_docs long, n_ids long, part int, roll int", run), "manifest")
    remove(encoded)
    before = W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def lookup(manifest: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids)`` for each distinct id of ``ids`` that a shard holds, ids as 32-bit little-endian bytes.

    An id goes to the shards whose range spans it (more than one only where rows share it: each row
    is found), and a task opens a shard once, tries its filter and searches its index. A null id
    finds the rows without one. Of the manifest the driver takes 16 bytes a shard, to find ranges by.
    """
    spark, low = manifest.sparkSession, -(1 << 63)
    numbered = manifest.select("part", "roll", F.coalesce("first", F.lit(low)).alias("first"), F.coalesce("last", F.lit(low)).alias("last"))
    spans = numbered.orderBy("part", "roll").select("part", "roll", "first", "last").toArrow()
    first, last = (spans.column(c).to_numpy() for c in ("first", "last"))
    part, roll = (spans.column(c).to_numpy() for c in ("part", "roll"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).fill_null(low).to_numpy()
            start, end = np.searchsorted(last, key, "left"), np.searchsorted(first, key, "right")
            times = np.maximum(end - start, 0)
            row = np.repeat(np.arange(len(key)), times)
            at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(part[at]), pa.array(roll[at])], ["doc_id", "part", "roll"])

    wanted = ids.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    pairs = map_rows(wanted, "doc_id long, part int, roll int", find).join(manifest.select("part", "roll", "path"), ["part", "roll"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, opened = None, None
        for batch in batches:
            for path, doc_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != opened:
                    shard, opened = Shard(path), path
                found = [x.astype("<u4").tobytes() for x in shard.get_all(doc_id)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(found), pa.int64()), pa.array(found, pa.binary())], ["doc_id", "ids"])

    dealt = pairs.select("path", "doc_id").repartition(partitions(spark), "path").sortWithinPartitions("path", "doc_id")
    return map_rows(dealt, "doc_id long, ids binary", run)


def read_shards(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, from the files of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, start, ids in Shard(path).scan():
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    rows = manifest.select("path", "start").repartition(partitions(manifest.sparkSession), "path")
    return map_rows(rows, "doc_id long, start long, n_tokens long, ids_crc32 long", run)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token shards to the shared folder and return what the files hold.

    Null and empty texts have the end id alone. A null doc_id sorts first. Repeated rows are
    written as often as they occur. An empty table writes no shard and gives no rows.
    """
    folder = new_path(docs.sparkSession, "tokens")
    return read_shards(materialise(write_shards(docs, tokenizer, folder, end_id, id_col, text_col), "shards"))
