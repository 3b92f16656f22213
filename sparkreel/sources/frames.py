"""Frame files and frame decoding.

Decoding is behind a function ``decode(video_path, frames)`` that yields ``(frame, image bytes)``
for those it can read, since video libraries differ from place to place.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyarrow import fs
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXISTING_FRAMES, FRAME_STATUS

Decode = Callable[[str, list[int]], Iterable[tuple[int, bytes]]]
#: A video's frames are dealt out in runs of so many, so that a long video is not one task.
RUN = 2048


def list_frames(spark: SparkSession, folder: str) -> DataFrame:
    """``(video_name, frame_index)`` of ``folder/{video}/{number}.jpg``, one level deep; other names are left out.

    Only paths are read, not the files. Names are taken as they are, whatever characters they hold.
    """
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/*/*.jpg")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EXISTING_FRAMES)
    parts = F.split("path", "/")
    named = files.select(F.element_at(parts, -2).alias("video_name"), F.expr("try_cast(regexp_extract(path, '([^/]+)\\\\.jpg$', 1) as bigint)").alias("frame_index"))
    return named.where(F.col("frame_index").isNotNull())


def _runs(frames: DataFrame) -> DataFrame:
    """Frames dealt out by video and run, in order within."""
    return frames.withColumn("run", F.expr(f"frame_index div {RUN}")).repartition("video_path", "run").sortWithinPartitions("video_path", "frame_index").drop("run")


def _by_video(batches: Iterator) -> Iterator[tuple[str, str, list[int]]]:
    """(path, name, frames) of contiguous rows of one video in a batch."""
    for batch in batches:
        for (path, name), part in batch.groupby(["video_path", "video_name"], sort=False):
            yield path, name, [int(x) for x in part["frame_index"]]


def extract_frames(wanted: DataFrame, decode: Decode, folder: str, digits: int = 6, video_root: str = "", profile: ResourceProfile | None = None) -> DataFrame:
    """Write ``folder/{video_name}/{number}.jpg``, on any storage pyarrow opens, and return ``(video_path, video_name, frame_index, status)``.

    ``decode`` yields the files' bytes. A frame that can't be read, or any frame of a video that
    can't be opened, is 'failed'. A file is written under another name and renamed, so a task that
    runs twice leaves the same files.
    """

    def run(batches):
        import pandas as pd

        for path, name, frames in _by_video(batches):
            done = set()
            files, base = fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
            files.create_dir(f"{base}/{name}", recursive=True)
            try:
                for frame, image in decode(os.path.join(video_root, path) if video_root else path, frames):
                    target = f"{base}/{name}/{frame:0{digits}d}.jpg"
                    part = f"{target}.{uuid.uuid4().hex}.part"
                    with files.open_output_stream(part, compression=None) as out:
                        out.write(image)
                    files.move(part, target)
                    done.add(frame)
            except OSError:
                pass  # what wasn't written is reported as failed
            yield pd.DataFrame({"video_path": path, "video_name": name, "frame_index": frames, "status": ["success" if f in done else "failed" for f in frames]})

    return _runs(wanted).mapInPandas(run, FRAME_STATUS, profile=profile)


def decode_frames(wanted: DataFrame, decode: Decode, max_frames: int | None = None) -> DataFrame:
    """``(video_path, frame_index, image)`` of the frames that can be read.

    ``max_frames`` leaves out later frames before any is decoded.
    """
    if max_frames is not None:
        wanted = wanted.where(F.col("frame_index") < max_frames)
    if "video_name" not in wanted.columns:
        wanted = wanted.withColumn("video_name", F.lit(""))

    def run(batches):
        import pandas as pd

        for path, _, frames in _by_video(batches):
            rows = [(path, f, image) for f, image in decode(path, frames)]
            yield pd.DataFrame(rows, columns=["video_path", "frame_index", "image"])

    return _runs(wanted.select("video_path", "video_name", "frame_index")).mapInPandas(run, "video_path string, frame_index long, image binary")


def whole_videos(videos: DataFrame, decode: Decode, max_frames: int | None = None) -> DataFrame:
    """All frames of ``videos(video_path, total_frames)``, or the first ``max_frames`` of each."""
    last = F.col("total_frames") if max_frames is None else F.least("total_frames", F.lit(max_frames))
    frames = videos.where(last > 0).select("video_path", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long") - 1)).alias("frame_index"))
    return decode_frames(frames, decode)
