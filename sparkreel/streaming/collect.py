"""Frames of records as they arrive."""

from __future__ import annotations

import json

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import stem
from ..operators.bitmaps import collect_bitmaps, list_bits, named, union
from ..operators.frames import selected_frames
from ..schemas import FRAME_INPUT
from ..storage import opened


def stream_frames(spark: SparkSession, folder: str) -> DataFrame:
    """``(video_path, video_name, frame_index)`` of new record files, duplicates within the state dropped."""
    records = spark.readStream.schema(FRAME_INPUT).json(folder)
    frames = records.select("video_path", stem(F.col("video_path")).alias("video_name"), F.explode(selected_frames()).alias("frame_index"))
    return frames.dropDuplicates(["video_path", "frame_index"])


def append_frames(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the frames of all files that are there to a Parquet table, then stop. Files seen before are skipped."""
    return stream_frames(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


BITMAPS = "video_path string, bucket long, frames binary"


class FrameTable:
    """The frames of all videos so far as bitmaps, a version for each batch of a stream.

    A batch merges its bitmaps into the version before and writes the version of its own number, which
    is there when ``done/<number>.json`` is; a batch that is run again replaces what it left, so every
    record counts once however often the stream stops. There is a row for each video and 32,768 frames,
    not for each frame. Versions more than two behind are removed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.files, self.path = opened(self.folder)

    def versions(self) -> list[int]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/done", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found)

    def read(self, before: int | None = None) -> DataFrame:
        """The newest version, or the newest of a batch ``before`` that one."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return self.spark.createDataFrame([], BITMAPS)
        return self.spark.read.schema(BITMAPS).parquet(f"{self.folder}/version={known[-1]}")

    def frames(self) -> DataFrame:
        """``(video_path, video_name, frame_index)`` of the newest version."""
        return list_bits(named(self.read())).select("video_path", "video_name", "frame_index")

    def merge(self, records: DataFrame, batch: int) -> None:
        """Merge a batch; what a batch has merged already stays as it is."""
        if batch in self.versions():
            return
        union(self.read(batch), collect_bitmaps(records)).write.mode("overwrite").parquet(f"{self.folder}/version={batch}")
        self.files.create_dir(f"{self.path}/done", recursive=True)
        with self.files.open_output_stream(f"{self.path}/done/{batch}.json", compression=None) as f:
            f.write(json.dumps({"batch": batch}).encode())
        for old in self.versions()[:-3]:
            self.files.delete_file(f"{self.path}/done/{old}.json")
            self.files.delete_dir(f"{self.path}/version={old}")


def collect_stream(spark: SparkSession, folder: str, table: FrameTable, checkpoint: str, files_a_batch: int | None = None) -> StreamingQuery:
    """Merge the frames of all record files that are there into ``table``, then stop; a later call goes on where this one ended."""
    reader = spark.readStream.schema(FRAME_INPUT)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.json(folder).writeStream.foreachBatch(table.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
