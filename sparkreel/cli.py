"""Command line: extract the frames that records refer to."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .plans.extraction import run_extraction, save_summary
from .sources.frames import Decode


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkreel", description="Extract the frames that JSON Lines records refer to.")
    p.add_argument("--jsonl", required=True, help="records file")
    p.add_argument("--output", default="./frames", help="folder for frames")
    p.add_argument("--quality", type=int, default=95, help="JPEG quality, 0 to 100")
    p.add_argument("--digits", type=int, default=6, help="least digits of a file name, 1 to 10")
    p.add_argument("--workers", type=int, default=None, help="local cores; all if left out")
    p.add_argument("--temporal-dilation", type=int, default=0, help="neighbours on each side of a frame")
    return p


def problems(args: argparse.Namespace) -> list[str]:
    found = []
    if not os.path.exists(args.jsonl):
        found.append(f"no such file: {args.jsonl}")
    if not 0 <= args.quality <= 100:
        found.append("quality must be from 0 to 100")
    if not 1 <= args.digits <= 10:
        found.append("digits must be from 1 to 10")
    if args.temporal_dilation < 0:
        found.append("temporal dilation must not be negative")
    return found


def opencv_decode(quality: int) -> Decode:
    """Decode with OpenCV, where it is installed."""

    def decode(path: str, frames: list[int]):
        import cv2

        video = cv2.VideoCapture(path)
        if not video.isOpened():
            raise OSError(f"can't open {path}")
        for frame in frames:
            video.set(cv2.CAP_PROP_POS_FRAMES, frame)
            read, image = video.read()
            if read:
                coded, data = cv2.imencode(".jpg", image, [cv2.IMWRITE_JPEG_QUALITY, quality])
                if coded:
                    yield frame, data.tobytes()
        video.release()

    return decode


def elapsed(seconds: float) -> str:
    return f"{int(seconds // 60)} min {int(seconds % 60)} s"


def main(argv: list[str] | None = None, decode: Decode | None = None, spark: SparkSession | None = None) -> int:
    """0 if every frame was written or there already, else 1."""
    args = parser().parse_args(argv)
    if found := problems(args):
        print("\n".join(f"Error: {x}" for x in found), file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.master(f"local[{args.workers or '*'}]").appName("frames").getOrCreate()
    summary = run_extraction(spark, args.jsonl, args.output, decode or opencv_decode(args.quality), args.temporal_dilation, args.digits, workers=args.workers)
    save_summary(summary, os.path.join(args.output, "extraction_summary.json"))
    s = summary["statistics"]
    print(f"videos {s['total_videos']}, frames {s['total_frames']}, extracted {s['extracted_frames']}, skipped {s['skipped_frames']}, failed {s['failed_frames']}, {elapsed(s['processing_time_seconds'])}")
    return 1 if s["failed_frames"] else 0


if __name__ == "__main__":
    sys.exit(main())
