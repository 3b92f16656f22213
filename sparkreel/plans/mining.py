"""Samples to buckets, with or without a live model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MiningConfig
from ..operators.buckets import build_buckets, judge
from ..operators.inference import predict_rounds
from ..operators.ordering import pick
from ..operators.sampling import generate_rounds, seeded_rounds
from ..operators.stopping import ask_until_enough, stop_early


def _finished(kept: DataFrame, samples: DataFrame) -> DataFrame:
    truth = samples.select("sample_index", "formatted_answer")
    judged = judge(kept.join(truth, "sample_index"))
    mined = build_buckets(judged, samples)
    counts = kept.groupBy("sample_index").agg(F.max("num_rounds").alias("num_rounds"))
    out = mined.join(counts, "sample_index", "left").fillna(0, ["num_rounds"]).withColumn("ground_truth", F.col("formatted_answer"))
    return out.withColumns({"error": F.lit(None).cast("string"), "traceback": F.lit(None).cast("string")})


def mine_table(samples: DataFrame, results: DataFrame, config: MiningConfig, flush_tail: bool = True, match: str = "exact", sample_error: bool = False) -> DataFrame:
    """Mined samples from results that exist already (sample_index, round_id, frame_indices, prediction[, error]).

    Error rounds are skipped; with ``sample_error`` one makes its whole sample an error row with no
    mining result.
    """
    kept = stop_early(results, samples, config, flush_tail, match)
    mined = _finished(kept, samples)
    if sample_error and "error" in results.columns:
        bad = kept.where(F.col("error").isNotNull()).groupBy("sample_index").agg(F.min("error").alias("first_error"))
        mined = mined.join(bad, "sample_index", "left").withColumns({
            "mining_result": F.when(F.col("first_error").isNull(), F.col("mining_result")),
            "error": F.col("first_error"),
        }).drop("first_error")
    return mined


def mine_all(samples: DataFrame, make: Callable, config: MiningConfig, rng: str = "hash", indices=None) -> DataFrame:
    """Mined samples, every round asked in batches, stopping applied afterwards."""
    samples = pick(samples, indices)
    rounds = (seeded_rounds if rng == "mt19937" else generate_rounds)(samples, config)
    results = predict_rounds(rounds, samples, make, config.batch_size)
    results = results.join(samples.select("sample_id", "sample_index"), "sample_id")
    return mine_table(samples, results, config)


def mine_live(samples: DataFrame, predict: Callable, config: MiningConfig, rng: str = "hash", indices=None) -> DataFrame:
    """Mined samples, no round asked after a sample has enough; a failed sample keeps its error."""
    samples = pick(samples, indices)
    rounds = (seeded_rounds if rng == "mt19937" else generate_rounds)(samples, config)
    asked = ask_until_enough(rounds, samples, predict, config)
    mined = _finished(asked.where("error is null").drop("error", "traceback"), samples).drop("error", "traceback")
    failed = asked.where("error is not null").groupBy("sample_index").agg(F.first("error").alias("error"), F.first("traceback").alias("traceback"))
    out = mined.join(failed, "sample_index", "left")
    return out.withColumn("mining_result", F.when(F.col("error").isNull(), F.col("mining_result")))


def score_results(samples: DataFrame, results: DataFrame) -> DataFrame:
    """Buckets of finished results, without stopping: samples with their mining_result."""
    truth = samples.select("sample_index", "formatted_answer")
    return build_buckets(judge(results.join(truth, "sample_index")), samples).withColumn("ground_truth", F.col("formatted_answer"))
