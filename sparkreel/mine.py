"""Command line: mine question files with a predictor, and take a stopped run up again.

    python -m sparkreel.mine --json-dir questions --video-dir videos --frame-counts counts.parquet \\
        --predictor package.module:make --output runs --experiment first [--resume | --clear-checkpoint]
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from .config import MiningConfig
from .plans.progress import progress
from .plans.run import mine_run
from .sources.annotations import build_samples, read_annotations


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkreel.mine", description="Mine contrastive rounds of frames.")
    p.add_argument("--json-dir", required=True, help="folder of question files")
    p.add_argument("--video-dir", required=True, help="folder of videos, by task")
    p.add_argument("--frame-counts", required=True, help="Parquet table with video_path and total_frames")
    p.add_argument("--predictor", required=True, help="module:function that makes a predictor")
    p.add_argument("--output", default="./output", help="folder of runs")
    p.add_argument("--experiment", default="run", help="name of this run")
    p.add_argument("--tasks", nargs="*", default=None, help="task names; the multiple-choice tasks if left out")
    p.add_argument("--batch-size", type=int, default=None, help="rounds asked at a time")
    p.add_argument("--max-samples", type=int, default=None, help="mine so many samples at the most")
    p.add_argument("--sample-index", type=int, default=None, help="mine this sample alone")
    p.add_argument("--resume", action="store_true", help="leave out samples that are done")
    p.add_argument("--clear-checkpoint", action="store_true", help="forget what is done and start anew")
    p.add_argument("--full-extraction", action="store_true", help="no limit on rounds")
    return p


def load_predictor(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, make: Callable | None = None, config: MiningConfig | None = None) -> int:
    """0 if the run went through, 1 if its arguments or its earlier commits don't allow it."""
    args = parser().parse_args(argv)
    if args.resume and args.clear_checkpoint:
        print("Error: resume or clear, not both", file=sys.stderr)
        return 1
    if args.max_samples is not None and args.max_samples < 0 or args.sample_index is not None and args.sample_index < 0:
        print("Error: --max-samples and --sample-index must not be negative", file=sys.stderr)
        return 1
    config = config or MiningConfig()
    changes = {"batch_size": args.batch_size, "mcq_tasks": tuple(args.tasks) if args.tasks else None, "full_extraction": args.full_extraction or None}
    config = dataclasses.replace(config, json_dir=args.json_dir, video_dir=args.video_dir, output_dir=args.output, **{k: v for k, v in changes.items() if v is not None})
    spark = spark or SparkSession.builder.appName("mining").getOrCreate()
    samples = build_samples(read_annotations(spark, args.json_dir, config.mcq_tasks), args.video_dir, spark.read.parquet(args.frame_counts))
    told = lambda done, known: print(f"\rtasks {done} of {known}", end="", file=sys.stderr)
    try:
        with progress(spark, told):
            counts = mine_run(samples, make or load_predictor(args.predictor), config, f"{args.output.rstrip('/')}/{args.experiment}", args.resume, args.clear_checkpoint, args.max_samples, args.sample_index, args.video_dir)
    except ValueError as e:
        print(f"\nError: {e}", file=sys.stderr)
        return 1
    print(f"\nsamples done before {counts['already_done']}, now {counts['done_now']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
