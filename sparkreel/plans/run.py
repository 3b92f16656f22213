"""A mining run that can be stopped and taken up again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MiningConfig
from ..operators.buckets import build_buckets, judge
from ..operators.ordering import at_index
from ..operators.stopping import ask_lazily
from ..sources.commits import CommitLog, in_commits
from ..sources.records import mined_records


def mine_lazily(samples: DataFrame, make: Callable[[], Callable], config: MiningConfig, flush_tail: bool = True, match: str = "exact") -> DataFrame:
    """Mined samples: rounds are drawn and asked batch by batch until a sample has enough; a failed sample keeps its error."""
    narrow = samples.select("sample_id", "sample_index", "total_frames", "formatted_answer", "question", "candidates", "video_path")
    asked = ask_lazily(narrow, None, config, flush_tail, match, make)
    truth = samples.select("sample_index", "formatted_answer")
    fine = asked.where("error is null").select("sample_index", "round_id", "frame_indices", "prediction")
    mined = build_buckets(judge(fine.join(truth, "sample_index")), samples).withColumn("ground_truth", F.col("formatted_answer"))
    notes = asked.groupBy("sample_index").agg(F.coalesce(F.max("num_rounds"), F.lit(0)).alias("num_rounds"), F.max("error").alias("error"), F.max("traceback").alias("traceback"))
    out = mined.join(notes, "sample_index", "left").fillna(0, ["num_rounds"])
    return out.withColumn("mining_result", F.when(F.col("error").isNull(), F.col("mining_result")))


def mine_run(
    samples: DataFrame, make: Callable[[], Callable], config: MiningConfig, folder: str, resume: bool = False, clear: bool = False,
    most: int | None = None, sample_index: int | None = None, base_dir: str | None = None, only_both: bool = False,
) -> dict:
    """Mine what no earlier run has committed, in slices, and return counts.

    Records go to ``folder/records/slice=<name>`` as JSON Lines, failures to ``folder/failures``. A
    slice that is written again replaces what it left. Without ``resume`` earlier commits must not
    exist (``clear`` removes them and the records); with it the settings must be those of the
    commits. ``most``: at most so many samples; ``sample_index``: that one alone.
    """
    spark = samples.sparkSession
    log = CommitLog(spark, f"{folder.rstrip('/')}/commits")
    if clear:
        log.clear()
        for name in ("records", "failures"):
            CommitLog(spark, f"{folder.rstrip('/')}/{name}").clear()
    before = log.progress()["processed_count"]
    if before and not resume:
        raise ValueError(f"{before} samples are done in {folder}; resume or clear")
    if not log.matches(config):
        raise ValueError("the settings are not those of the earlier commits")
    if sample_index is not None:
        samples = at_index(samples, sample_index)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")

    def write(mined: DataFrame, name: str) -> None:
        mined = mined.persist()
        try:
            mined_records(mined, base_dir, only_both).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/records/slice={name}")
            mined.where("error is not null").select("sample_id", "task_type", "error", "traceback").write.mode("overwrite").json(f"{folder}/failures/slice={name}")
        finally:
            mined.unpersist()

    done = in_commits(samples, log, config, f"{folder}/records", lambda part: mine_lazily(part, make, config), write, most)
    log.compact()
    return {"already_done": before, "done_now": done, "processed_count": before + done}
