"""Sets of frames as bitmaps: one row for each video and stretch of 32,768 frames.

A bitmap is Spark's own (bit p of byte p // 8), so it is built, merged and counted by its functions
and shuffles as 4 KB at the most, however many records want its frames. What Spark has no function for
(shifting, difference, listing) is done on whole bitmaps in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stem
from .frames import selected_frames

BITS = 32_768
BYTES = BITS // 8


def bucket_of(frame: Column) -> Column:
    return ((frame - F.pmod(frame, F.lit(BITS))) / BITS).cast("long")


def collect_bitmaps(records: DataFrame) -> DataFrame:
    """``(video_path, bucket, frames)``: the union of the frames of all records of a video. Partial bitmaps are made before the shuffle."""
    frame = F.col("frame_index")
    rows = records.select("video_path", F.explode(selected_frames()).alias("frame_index")).where(frame.isNotNull())
    return rows.groupBy("video_path", bucket_of(frame).alias("bucket")).agg(F.bitmap_construct_agg(F.pmod(frame, F.lit(BITS))).alias("frames"))


def from_frames(frames: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, bucket, frames)`` of rows with ``frame_index``; repeated rows count once."""
    frame = F.col("frame_index")
    return frames.groupBy(*keys, bucket_of(frame).alias("bucket")).agg(F.bitmap_construct_agg(F.pmod(frame, F.lit(BITS))).alias("frames"))


def union(*sets: DataFrame) -> DataFrame:
    """The union by all columns but ``frames``."""
    rows = sets[0]
    for s in sets[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy(*[c for c in rows.columns if c != "frames"]).agg(F.bitmap_or_agg("frames").alias("frames"))


def _each(df: DataFrame, schema: str, fn) -> DataFrame:
    """``fn(batch)`` yields the batches of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def _kinds(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def dilate(sets: DataFrame, n: int, bounds: DataFrame | None = None) -> DataFrame:
    """``(video_path, bucket, frames)`` with ``n`` (below 32,768) neighbours on each side of every frame.

    A bitmap is shifted as one number; what leaves it goes to the buckets beside it, which are then
    merged. With ``bounds(video_path, total_frames)`` the sets are clipped to 0 <= frame < total_frames
    (null: no upper bound); ``n`` = 0 changes nothing, and clips nothing.
    """
    if not n:
        return sets
    if not 0 < n < BITS:
        raise ValueError(f"n must be below {BITS}")
    mask = (1 << BITS) - 1

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for path, bucket, frames in zip(*(c.to_pylist() for c in batch.columns)):
            wide, done = int.from_bytes(frames, "little"), 0
            while done < 2 * n:  # from one frame to 2n + 1 of them, by doubling
                step = min(done + 1, 2 * n - done)
                wide |= wide << step
                done += step
            for at, part in ((-1, wide << BITS - n & mask), (0, wide >> n & mask), (1, wide >> BITS + n)):
                if part:
                    for column, value in zip(out, (path, bucket + at, part.to_bytes(BYTES, "little"))):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["video_path", "bucket", "frames"])

    merged = union(_each(sets.select("video_path", "bucket", "frames"), "video_path string, bucket long, frames binary", spread))
    if bounds is None:
        return merged

    def clip(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for path, bucket, frames, total in zip(*(c.to_pylist() for c in batch.columns)):
            bits = int.from_bytes(frames, "little")
            if total is not None:
                bits &= (1 << min(max(total - bucket * BITS, 0), BITS)) - 1
            if bits:
                for column, value in zip(out, (path, bucket, bits.to_bytes(BYTES, "little"))):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["video_path", "bucket", "frames"])

    inside = merged.where("bucket >= 0").join(bounds.select("video_path", "total_frames"), "video_path")
    return _each(inside.select("video_path", "bucket", "frames", "total_frames"), "video_path string, bucket long, frames binary", clip)


def difference(wanted: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """``wanted`` without the frames of ``existing``, joined by ``keys`` and bucket; rows left empty go."""
    there = existing.select(*keys, "bucket", F.col("frames").alias("there"))
    names = [c for c in wanted.columns if c != "frames"]
    joined = wanted.join(there, [*keys, "bucket"], "left").select(*names, "frames", "there")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        left = []
        for frames, there in zip(batch.column("frames").to_pylist(), batch.column("there").to_pylist()):
            bits = int.from_bytes(frames, "little") & ~int.from_bytes(there or b"", "little")
            left.append(bits.to_bytes(BYTES, "little") if bits else None)
        columns = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(left, pa.binary())], [*names, "frames"])

    return _each(joined, f"{_kinds(wanted, names)}, frames binary", run).where("frames is not null")


def count_frames(sets: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, n)``: frames by ``keys``, counted in the bitmaps."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("frames")).alias("n"))


def list_bits(sets: DataFrame) -> DataFrame:
    """A row for each frame, with ``frame_index`` in place of bucket and bitmap."""
    names = [c for c in sets.columns if c not in ("bucket", "frames")]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buckets, frames = batch.column("bucket").to_pylist(), batch.column("frames").to_pylist()
        for at in range(0, batch.num_rows, 16):  # half a million frames at the most
            found = [bucket * BITS + np.flatnonzero(np.unpackbits(np.frombuffer(f, np.uint8), bitorder="little")) for bucket, f in zip(buckets[at : at + 16], frames[at : at + 16])]
            place = pa.array(np.repeat(np.arange(at, at + len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(place) for c in names], pa.array(np.concatenate(found))], [*names, "frame_index"])

    return _each(sets.select(*names, "bucket", "frames"), f"{_kinds(sets, names)}, frame_index long", run)


def named(sets: DataFrame) -> DataFrame:
    return sets.withColumn("video_name", stem(F.col("video_path")))
