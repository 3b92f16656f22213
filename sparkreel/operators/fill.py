"""Frames of a round in order, with missing ones carried forward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fill_frames(rounds: DataFrame, frames: DataFrame, default, image: str = "image") -> DataFrame:
    """``(sample_id, round_id, position, frame_index, image)``: one row per place of a round.

    ``rounds``: sample_id, video_path, round_id, frame_indices; ``frames``: video_path, frame_index
    and ``image``. A frame that is missing takes the image of the place before it, filled or not;
    at the head of a round it takes ``default``.
    """
    places = rounds.select("sample_id", "video_path", "round_id", F.posexplode("frame_indices").alias("position", "frame_index"))
    found = places.join(frames.select("video_path", "frame_index", image), ["video_path", "frame_index"], "left")
    before = W.partitionBy("sample_id", "round_id").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = F.coalesce(F.last(image, ignorenulls=True).over(before), F.lit(default))
    return found.select("sample_id", "round_id", "position", "frame_index", filled.alias(image))
