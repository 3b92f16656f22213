"""WARC archives, each record its own Zstandard frame under a shared dictionary.

A file starts with a skippable frame that embeds the dictionary; every record follows as a frame of
its own, so records can be read one by one. Payloads that are stored once already are written as
revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, map_rows, materialise, new_path, partitions, publish

#: Fixed by the format: the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Fixed by the WARC standard: the profile of a revisit with an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are always stored.
MIN_REVISIT_BYTES = 1000
#: The dictionary is trained on at most so many records, chosen by hash, at most so many bytes of
#: each. It only changes how small the files are; every record is written.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1024, 8192, 64 << 10
#: Bytes of payload in a task that writes archives, and of frames in a file, about.
PART_BYTES, FILE_BYTES = 32 << 20, 1 << 30
#: Rows that are alike (one page_id and payload) are dealt to so many places.
SALTS = 8
DATE = "2000-01-01T00:00:00Z"
LEVEL = 3


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record; ``payload`` is None for a revisit. ``digest``: hex SHA-1 of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if payload is None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = http + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """page_id, url, type, payload (None in a revisit), payload_bytes, payload_digest, refers_to of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    page = lambda urn: int(urn[10:-1]) if len(urn) > 11 else None
    revisit = fields["WARC-Type"] == "revisit"
    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload and header differ")
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": digest, "refers_to": page(fields["WARC-Refers-To"]) if revisit else None}


def read_archive(uri: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, in order; memory is one chunk and one record."""
    files, path = filesystem(uri)
    with files.open_input_stream(path, compression=None) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{uri} has no leading dictionary")
        raw = file.read(size)
        unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        frame, data = unzip.decompressobj(), file.read(chunk)
        parts: list[bytes] = []
        while data:
            parts.append(frame.decompress(data))
            if frame.eof:
                yield b"".join(parts)
                data, frame, parts = frame.unused_data or file.read(chunk), unzip.decompressobj(), []
            else:
                data = file.read(chunk)


def train_dictionary(pages: DataFrame, keys: DataFrame) -> bytes:
    """A Zstandard dictionary over records of ``pages(page_id, url, payload)``; empty if there are too few.

    The records are picked by hash among ``keys(page_id, digest)``; only theirs are cut out of the payloads.
    """
    picked = keys.select("page_id", "digest").distinct().orderBy(F.xxhash64("digest", "page_id")).limit(SAMPLE_RECORDS)
    names = {(r["page_id"], r["digest"]) for r in picked.collect()}
    wanted = F.col("page_id").isin([i for i, _ in names if i is not None]) | (F.col("page_id").isNull() & F.lit(any(i is None for i, _ in names)))
    size = F.octet_length("payload")
    at = F.pmod(F.xxhash64("page_id"), F.greatest(size - SAMPLE_BYTES, F.lit(1))) + 1
    part = pages.where(wanted).select("page_id", "url", F.sha1("payload").alias("digest"), size.alias("size"), F.substring(F.col("payload"), at.cast("int"), F.lit(SAMPLE_BYTES)).alias("part"))
    found = {(p["page_id"], p["digest"]): p for p in part.join(F.broadcast(picked), ["digest"], "left_semi").dropDuplicates(["page_id", "digest"]).toArrow().to_pylist()}  # SAMPLE_RECORDS rows
    samples = [record(p["page_id"], p["url"], p["part"], p["size"], p["digest"], None) for _, p in sorted(found.items(), key=repr)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES, part_bytes: int = PART_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row; the manifest ``(path, n_records)`` of the files that count.

    The payload itself moves once, into as many parts as ``part_bytes`` asks for; which record is
    stored is settled on digests alone. A task starts a new file at ``file_bytes`` of frames. Files
    are renamed into place, so a task that runs twice leaves a file that no manifest names.
    """
    payload = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keys = materialise(rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")), "digests")
    parts = max(partitions(pages.sparkSession), -(-int(keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) // part_bytes))
    large = keys.where(F.col("size") >= min_revisit)
    stored = large.groupBy("digest").agg(F.max("page_id").alias("stored"), F.count("*").alias("n")).where("n > 1").drop("n")
    stored = materialise(stored, "stored")  # two plain shuffles meet in the join, so that Spark can split a frequent payload
    again = large.join(stored, "digest").where("page_id != stored or (page_id is null and stored is not null)").select("page_id", "digest", "stored").distinct()
    dictionary = train_dictionary(rows, keys)
    # One text is the key of both sides, so that the join takes the dealing by bytes as it is. Its
    # salt spreads rows that are alike; of the verdict on a page, a narrow row, there is one a salt.
    name = F.concat_ws(" ", F.col("salt").cast("string"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest").alias("name")
    verdicts = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(name, F.lit(True).alias("again"), "stored").hint("merge")
    salted = rows.withColumns({"salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"), "digest": F.sha1("payload")})
    dealt = salted.select(name, "page_id", "url", "payload", "digest").repartition(parts, "name").join(verdicts, "name", "left")
    dealt = dealt.select("page_id", "url", F.when(F.col("again").isNull(), F.col("payload")).alias("payload"), F.octet_length("payload").alias("size"), "digest", "stored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flow = (row for b in batches for i in range(0, b.num_rows, 64) for row in b.slice(i, 64).to_pylist())
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        row = next(flow, None)
        while row is not None:
            path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
            count = 0

            def fill(out) -> None:
                nonlocal count, row
                size = out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                while row is not None and (not count or size < file_bytes):
                    size += out.write(squeeze.compress(record(row["page_id"], row["url"], row["payload"], row["size"], row["digest"], row["stored"])))
                    count += 1
                    row = next(flow, None)

            publish(path, fill)
            yield pa.RecordBatch.from_pylist([{"path": path, "n_records": count}])

    return materialise(map_rows(dealt, "path string, n_records long", run), "archives")


def read_archives(manifest: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record, from the files.

    A stored payload is hashed again while reading; one that differs from its header is an error.
    """
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for data in read_archive(path):
                    rows.append({k: v for k, v in parse(data).items() if k not in ("payload", "url")})
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    paths = manifest.select("path").repartition(partitions(manifest.sparkSession), "path")
    return map_rows(paths, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long", run)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return what the files hold, per page.

    A null html is an empty payload; a null url has no target header, and control characters and
    blanks in a url are percent-encoded. Of equal payloads of ``MIN_REVISIT_BYTES`` or more the
    record with the largest page_id is the response. Repeated rows (same page_id and payload) are
    alike: all responses or all revisits. A null page_id has an empty record id and revisits the
    largest id there is; if all ids of a payload are null, all are responses. An empty table
    writes no file. Other columns are ignored.
    """
    return read_archives(write_archives(pages, new_path(pages.sparkSession, "warc"), id_col, url_col, text_col))
