"""Question files to samples."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import format_answer, join_path, sample_id
from ..operators.ordering import numbered
from ..schemas import ANNOTATIONS


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of a few paths that exist, on any storage that Spark reads."""
    from pyspark.errors import AnalysisException

    found = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path).limit(0).count()
            found.append(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def read_annotations(spark: SparkSession, json_dir: str, tasks: list[str] | tuple[str, ...]) -> DataFrame:
    """``(task_order, task, position, item)``: one row per item of each ``{task}.json``.

    Each file is one JSON array; the position in the file is part of an item's id, so the text is
    parsed as a whole and exploded with positions. A missing file is skipped. Task names may hold any
    character: each file is read under its own.
    """
    items = F.posexplode(F.from_json("value", ANNOTATIONS, {"mode": "FAILFAST"})).alias("position", "item")
    out = spark.createDataFrame([], f"task_order int, task string, position int, item {ANNOTATIONS[6:-1]}")
    for order, task in enumerate(tasks):  # a few files
        for path in existing_paths(spark, [re.sub(r"([\[\]{}*?\\])", r"\\\1", f"{json_dir.rstrip('/')}/{task}.json")]):
            out = out.union(spark.read.text(path, wholetext=True).select(F.lit(order).alias("task_order"), F.lit(task).alias("task"), items))
    return out


def build_samples(items: DataFrame, video_dir: str, metadata: DataFrame) -> DataFrame:
    """Samples of items whose video is in ``metadata(video_path, total_frames)`` with frames in it.

    ``sample_id`` counts items of a file before any are skipped, ``sample_index`` all samples after,
    in order of files and places.
    """
    named = items.select(
        "task_order", "task", "position", F.col("item.*"),
        join_path(F.lit(video_dir), F.col("task"), F.col("item.video")).alias("video_path"),
    )
    kept = named.join(metadata.where("total_frames > 0").select("video_path", "total_frames"), "video_path")
    return numbered(kept, "task_order", "position", name="sample_index").select(
        sample_id(F.col("task"), F.col("position")).alias("sample_id"),
        "sample_index",
        F.coalesce("question_type", "task").alias("task_type"),
        "video_path",
        F.col("video").alias("video_filename"),
        "question",
        "candidates",
        "answer",
        format_answer(F.col("answer"), F.col("candidates")).alias("formatted_answer"),
        F.coalesce("duration", F.lit(0.0)).alias("duration"),
        F.col("total_frames").cast("long").alias("total_frames"),
    )


def existing_videos(samples: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose video is among ``files(video_path)``."""
    return samples.join(files.select("video_path").distinct(), "video_path", "left_semi")


def probe_frame_counts(paths: DataFrame, probe) -> DataFrame:
    """``(video_path, total_frames)`` of distinct paths; ``probe(path)`` reads the container's header.

    A failure is -1. Each path is probed once, however many items share it.
    """

    def run(batches):
        for batch in batches:
            counts = []
            for path in batch["video_path"]:
                try:
                    counts.append(int(probe(path)))
                except Exception:  # an unreadable video is left out by its count
                    counts.append(-1)
            yield batch.assign(total_frames=counts)

    return paths.select("video_path").distinct().mapInPandas(run, "video_path string, total_frames long")
