"""How far a running job is, told while it runs."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession


@contextlib.contextmanager
def progress(spark: SparkSession, report: Callable[[int, int], None], seconds: float = 1.0) -> Iterator[None]:
    """While the block runs, ``report(tasks done, tasks known)`` of Spark's active stages is called now and then, and once at the end.

    Stages that are done no longer count as active, so what they did is kept.
    """
    tracker, over = spark.sparkContext.statusTracker(), threading.Event()
    seen: dict[int, tuple[int, int]] = {}

    def look() -> None:
        for stage in tracker.getActiveStageIds():
            info = tracker.getStageInfo(stage)
            if info:
                seen[stage] = (info.numCompletedTasks, info.numTasks)
        for stage in list(seen):
            info = tracker.getStageInfo(stage)
            if info:
                seen[stage] = (info.numCompletedTasks, info.numTasks)
        report(sum(d for d, _ in seen.values()), sum(n for _, n in seen.values()))

    def watch() -> None:
        while not over.wait(seconds):
            look()

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        look()
