"""Frames wanted by buckets: union, dilation, and what is still to extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stem


def selected_frames(mining_result: str = "mining_result") -> Column:
    """All frames of both buckets, as an array; nested field access lets Parquet read only these lists."""
    pos, neg = F.col(f"{mining_result}.pos_bucket.frame_indices"), F.col(f"{mining_result}.neg_bucket.frame_indices")
    return F.flatten(F.concat(F.coalesce(pos, F.array()), F.coalesce(neg, F.array())))


def videos(records: DataFrame, order: str = "line_no") -> DataFrame:
    """``(video_path, video_name, sample_count, total_frames, stem_collision)``.

    ``total_frames`` is that of a video's first record by ``order``, null (no bound) included.
    ``stem_collision``: another path has the same name, so both share an output folder.
    """
    grouped = records.groupBy("video_path").agg(F.count("*").alias("sample_count"), F.min_by(F.struct("total_frames"), order).alias("first"))
    named = grouped.select("video_path", stem(F.col("video_path")).alias("video_name"), "sample_count", F.col("first.total_frames").alias("total_frames"))
    shared = named.groupBy("video_name").agg(F.count("*").alias("paths"))
    return named.join(shared, "video_name").select("video_path", "video_name", "sample_count", "total_frames", (F.col("paths") > 1).alias("stem_collision"))


def collect_frames(records: DataFrame, dilation: int = 0, order: str = "line_no") -> DataFrame:
    """``(video_path, video_name, frame_index)``: distinct frames, with ``dilation`` neighbours on each side.

    Only a dilated set is clipped to the video. Frames are made distinct before they are dilated,
    so that the second shuffle holds at most 2 * dilation + 1 rows for each.
    """
    frames = records.select("video_path", F.explode(selected_frames()).alias("frame_index")).distinct()
    if dilation > 0:
        bounds = records.groupBy("video_path").agg(F.min_by(F.struct("total_frames"), order).alias("first"))
        near = F.explode(F.sequence(F.col("frame_index") - dilation, F.col("frame_index") + dilation)).alias("frame_index")
        inside = (F.col("frame_index") >= 0) & (F.col("first.total_frames").isNull() | (F.col("frame_index") < F.col("first.total_frames")))
        frames = frames.select("video_path", near).distinct().join(bounds, "video_path").where(inside).select("video_path", "frame_index")
    return frames.select("video_path", stem(F.col("video_path")).alias("video_name"), "frame_index")


def frames_to_extract(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Wanted frames that aren't among ``existing(video_name, frame_index)``."""
    return wanted.join(existing.select("video_name", "frame_index"), ["video_name", "frame_index"], "left_anti").select("video_path", "video_name", "frame_index")


def flag_existing(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """``wanted`` with ``there``: whether ``existing(video_name, frame_index)`` holds the frame."""
    files = existing.select("video_name", "frame_index").distinct().withColumn("_file", F.lit(True))
    return wanted.join(files, ["video_name", "frame_index"], "left").select(*wanted.columns, F.col("_file").isNotNull().alias("there"))


def summarise(status: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of ``per_video_summary`` from one pass over ``(video_path, video_name, status)``, 'present' for frames that were there."""
    of = lambda s: F.count_if(F.col("status") == s)
    want = status.groupBy("video_path", "video_name").agg(F.count("*").alias("total_frames"), of("success").alias("success"), of("present").alias("skipped_requested"), of("failed").alias("failed"))
    have = existing.select("video_name", "frame_index").distinct().groupBy("video_name").agg(F.count("*").alias("skipped"))
    out = want.join(have, "video_name", "left").fillna(0, ["skipped"])
    return out.select("video_path", "video_name", "total_frames", "success", "skipped", "skipped_requested", "failed")


def per_video_summary(wanted: DataFrame, existing: DataFrame, status: DataFrame) -> DataFrame:
    """A row per video: frames wanted, extracted, failed, and skipped.

    ``skipped`` counts every frame file of the video's folder, ``skipped_requested`` those wanted.
    ``status``: (video_path, frame_index, status) with 'success' or 'failed' of frames that were tried.
    """
    tried = status.select("video_path", "frame_index", "status")
    flagged = flag_existing(wanted, existing).join(tried, ["video_path", "frame_index"], "left")
    return summarise(flagged.withColumn("status", F.coalesce("status", F.when(F.col("there"), "present"))), existing)


def extraction_totals(per_video: DataFrame) -> DataFrame:
    """One row of totals over all videos."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_video.agg(
        F.count("*").alias("total_videos"), total("total_frames").alias("total_frames"), total("success").alias("extracted_frames"),
        total("skipped").alias("skipped_frames"), total("failed").alias("failed_frames"),
    )


def per_video_map(per_video: DataFrame) -> DataFrame:
    """One row with a map from video name to its figures; of paths with one name the last stays.

    All videos are in that one row, as the summary's format asks; ``by_name`` has a row for each.
    """
    return by_name(per_video).agg(F.map_from_entries(F.collect_list(F.struct("video_name", "figures"))).alias("per_video"))


def by_name(per_video: DataFrame) -> DataFrame:
    """``(video_name, figures)``; of paths with one name the last stays."""
    figures = F.struct("video_path", "total_frames", "success", "skipped", "failed")
    return per_video.groupBy("video_name").agg(F.max_by(figures, "video_path").alias("figures"))
