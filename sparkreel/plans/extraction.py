"""Records to frame files and a summary."""

from __future__ import annotations

import json
import time
import warnings

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.frames import by_name, collect_frames, flag_existing, summarise
from ..sources.frames import Decode, extract_frames, list_frames
from ..sources.records import read_frame_input
from ..storage import written


class VideoFigures(Mapping):
    """Figures by video name, read from a table when they are asked for; iterating streams them in order of the names."""

    def __init__(self, table: DataFrame):
        self.table = table

    def __getitem__(self, name: str) -> dict:
        row = self.table.where(F.col("video_name") == name).first()
        if row is None:
            raise KeyError(name)
        return row["figures"].asDict()

    def __iter__(self) -> Iterator[str]:
        return (name for name, _ in self.items())

    def __len__(self) -> int:
        return self.table.count()

    def items(self) -> Iterator[tuple[str, dict]]:
        return ((r["video_name"], r["figures"].asDict()) for r in self.table.orderBy("video_name").toLocalIterator())


def run_extraction(spark: SparkSession, jsonl: str, folder: str, decode: Decode, dilation: int = 0, digits: int = 6, video_root: str = "", workers: int | None = None) -> dict:
    """Collect, write what is missing, and return the summary.

    What was there before is written down before any file is, so a lost executor can't find the new
    files among the old; so is what became of every frame, from which the figures of all videos come
    in one pass. Totals are counted while that table is written. ``per_video`` is a mapping over a
    table: the driver holds one video at a time.
    """
    began = time.time()
    wanted = collect_frames(read_frame_input(spark, jsonl), dilation)
    existing = written(list_frames(spark, folder), "existing")
    flagged = written(flag_existing(wanted, existing), "wanted")
    tried = extract_frames(flagged.where("not there").drop("there"), decode, folder, digits, video_root)
    seen, is_ = Observation(), lambda s: F.count_if(F.col("status") == s)
    every = tried.unionByName(flagged.where("there").select("video_path", "video_name", "frame_index", F.lit("present").alias("status")))
    status = written(every.observe(seen, F.count("*").alias("frames"), is_("success").alias("extracted"), is_("failed").alias("failed")), "status")
    videos = written(summarise(status, existing), "videos")
    count, skipped = videos.agg(F.count("*"), F.coalesce(F.sum("skipped"), F.lit(0))).first()
    out = {
        "statistics": {
            "total_videos": count, "total_frames": seen.get["frames"], "extracted_frames": seen.get["extracted"], "skipped_frames": skipped,
            "failed_frames": seen.get["failed"], "processing_time_seconds": time.time() - began,
        },
        "per_video": VideoFigures(written(by_name(videos), "figures")),
        "jsonl_file": jsonl,
        "output_dir": folder,
        "timestamp": time.strftime("%Y-%m-%d %H:%M:%S"),
        "temporal_dilation": dilation,
    }
    return out | ({} if workers is None else {"num_workers": workers})


def _indented(value: object, by: str) -> str:
    return json.dumps(value, indent=2, ensure_ascii=False).replace("\n", "\n" + by)


def save_summary(summary: dict | None, path: str) -> None:
    """Write a summary, a video at a time; without one, warn and write nothing."""
    if not summary:
        warnings.warn("no summary to save; run the extraction first", stacklevel=2)
        return
    with open(path, "w", encoding="utf-8") as file:
        for at, (key, value) in enumerate(summary.items()):
            file.write(f"{',' if at else '{'}\n  {json.dumps(key)}: ")
            if isinstance(value, VideoFigures):
                n = -1
                for n, (name, figures) in enumerate(value.items()):
                    file.write(f"{',' if n else '{'}\n    {json.dumps(name, ensure_ascii=False)}: {_indented(figures, '    ')}")
                file.write("\n  }" if n >= 0 else "{}")
            else:
                file.write(_indented(value, "  "))
        file.write("\n}")
