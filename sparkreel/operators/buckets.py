"""Positive and negative buckets, their classes and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answer_matches, hit_rate
from ..schemas import MINING_RESULT


def judge(results: DataFrame, truth: str = "formatted_answer") -> DataFrame:
    """Results without an error, with ``is_correct``; an error round keeps its round_id to itself."""
    fine = results.where(F.col("error").isNull()) if "error" in results.columns else results
    return fine.withColumn("is_correct", answer_matches(F.col("prediction"), F.col(truth)))


def build_buckets(judged: DataFrame, samples: DataFrame) -> DataFrame:
    """``samples`` with ``mining_result`` and the counts, one row per sample.

    Buckets are in round order. A sample without results has two empty buckets.
    """
    entry = F.struct("round_id", "frame_indices", "prediction")
    side = lambda ok: F.array_sort(F.collect_list(F.when(ok, entry)))
    grouped = judged.groupBy("sample_index").agg(
        F.struct(side(F.col("is_correct")).alias("pos_bucket"), side(~F.col("is_correct")).alias("neg_bucket")).alias("mining_result"),
        F.count_if("is_correct").alias("pos_count"),
        F.count_if(~F.col("is_correct")).alias("neg_count"),
    )
    empty = F.struct(F.array().alias("pos_bucket"), F.array().alias("neg_bucket")).cast(MINING_RESULT)
    out = samples.join(grouped, "sample_index", "left")
    return out.withColumns({
        "mining_result": F.coalesce(F.col("mining_result").cast(MINING_RESULT), empty),
        "pos_count": F.coalesce("pos_count", F.lit(0)).cast("long"),
        "neg_count": F.coalesce("neg_count", F.lit(0)).cast("long"),
    })


def count_buckets(judged: DataFrame, samples: DataFrame) -> DataFrame:
    """``samples`` with pos_count and neg_count only: no lists are gathered."""
    counts = judged.groupBy("sample_index").agg(F.count_if("is_correct").alias("pos_count"), F.count_if(~F.col("is_correct")).alias("neg_count"))
    return samples.join(counts, "sample_index", "left").fillna(0, ["pos_count", "neg_count"])


def sample_class(pos: Column, neg: Column) -> Column:
    """has_both, all_correct, all_incorrect or no_valid_results."""
    return F.when((pos > 0) & (neg > 0), "has_both").when(pos > 0, "all_correct").when(neg > 0, "all_incorrect").otherwise("no_valid_results")


def with_stats(mined: DataFrame) -> DataFrame:
    """Counts, hit rate and class of each sample as columns."""
    pos, neg = F.col("pos_count"), F.col("neg_count")
    return mined.withColumns({"total_rounds": pos + neg, "hit_rate": hit_rate(pos, neg), "sample_class": sample_class(pos, neg)})


def keep_contrastive(mined: DataFrame) -> DataFrame:
    """Samples with rounds in both buckets."""
    return mined.where("pos_count > 0 and neg_count > 0")


CLASSES = ("has_both", "all_correct", "all_incorrect", "no_valid_results")


def _class_counts() -> list[Column]:
    kind = sample_class(F.col("pos_count"), F.col("neg_count"))
    return [F.count_if(kind == c).alias(c) for c in CLASSES]


def classification_stats(mined: DataFrame) -> DataFrame:
    """One row: samples in all and by class."""
    return mined.agg(F.count("*").alias("total"), *_class_counts())


def per_task_stats(mined: DataFrame, with_total: bool = False) -> DataFrame:
    """A row per task (null: unknown) with class and round counts; ``with_total`` adds a row with a null task.

    Rows whose ``mining_result`` is null, where there is one, don't count.
    """
    if "mining_result" in mined.columns:
        mined = mined.where(F.col("mining_result").isNotNull())
    task = F.coalesce("task_type", F.lit("unknown")).alias("task_type")
    grouped = mined.select(task, "pos_count", "neg_count")
    grouped = grouped.rollup("task_type") if with_total else grouped.groupBy("task_type")
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    return grouped.agg(
        F.count("*").alias("total_samples"), *_class_counts(),
        total(F.col("pos_count") + F.col("neg_count"), "total_rounds"), total("pos_count", "total_pos"), total("neg_count", "total_neg"),
    )


def task_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("task_type").agg(F.count("*").alias("n"))
