"""Batches of rounds whose padded size fits a budget."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RESULTS
from .inference import Predict, answered, once_a_process, results_frame, rounds_of
from .ordering import numbered

#: Lengths of a class differ by an eighth of the shortest at the most, and so does the padding.
STEPS = 8


def length_class(tokens: Column) -> Column:
    """The greatest length of the class that ``tokens`` (1 or more) is in: eight classes for each power of two."""
    power = F.floor(F.log2(tokens.cast("double") + 0.5)).cast("int")  # the half keeps whole powers clear of rounding
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), power) / STEPS).cast("long")
    return (F.ceil(tokens / step) * step).cast("long")


def token_batches(df: DataFrame, tokens: Column, budget: int, *order: str) -> DataFrame:
    """``df`` with ``tokens``, ``padded`` (the greatest length of its class) and ``batch``: rows of one batch times ``padded`` never exceed ``budget``.

    Rows are sorted by length (then ``order``) and each class is cut into batches as large as the
    budget lets them be. Only places in the order are counted, by ranges of lengths, so no task sees
    a whole class. A row longer than the budget is a batch by itself; a null or zero length counts
    as 1. Batches don't depend on partitions where ``order`` tells rows apart.
    """
    length = F.greatest(F.coalesce(tokens.cast("long"), F.lit(1)), F.lit(1))
    sized = df.withColumn("tokens", length).withColumn("padded", length_class(F.col("tokens")))
    placed = numbered(sized, "padded", "tokens", *order, name="_place")
    firsts = placed.groupBy("padded").agg(F.min("_place").alias("_first"))  # eight rows for each power of two
    most = F.greatest(F.floor(F.lit(budget) / F.col("padded")), F.lit(1)).cast("long")
    number = F.floor((F.col("_place") - F.col("_first")) / most)
    return placed.join(F.broadcast(firsts), "padded").withColumn("batch", F.concat_ws("-", "padded", number)).drop("_place", "_first").select(*df.columns, "tokens", "padded", "batch")


def predict_batches(rounds: DataFrame, samples: DataFrame, make: Callable[[], Predict], tokens: Column, budget: int, token_count: Callable[[str], int] | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """The results of ``predict_rounds``, asked in batches by padded tokens instead of a number of rounds.

    ``tokens`` is an expression over the columns of ``samples`` and ``rounds``. A batch's rows come to
    one task in a row, and a batch is gathered across Arrow batches before it is asked.
    """
    make = once_a_process(make)
    joined = rounds.select("sample_index", "sample_id", "round_id", "frame_indices").join(samples.drop("sample_id"), "sample_index")
    batched = token_batches(joined.select("sample_index", "sample_id", "round_id", "frame_indices", "question", "candidates", tokens.alias("_tokens")), F.col("_tokens"), budget, "sample_index", "round_id")

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        predict, count, waiting = make(), token_count or (lambda s: len(s.split())), None
        for part in parts:
            waiting = part if waiting is None else pd.concat([waiting, part])
            last = waiting["batch"].iloc[-1] if len(waiting) else None
            ready = waiting[waiting["batch"] != last]
            waiting = waiting[waiting["batch"] == last]
            for _, own in ready.groupby("batch", sort=False):
                yield results_frame(list(answered(predict, count, rounds_of(own))))
        if waiting is not None and len(waiting):
            yield results_frame(list(answered(predict, count, rounds_of(waiting))))

    dealt = batched.repartition("batch").sortWithinPartitions("batch", "sample_index", "round_id")
    return dealt.select("batch", "sample_id", "round_id", "frame_indices", "question", "candidates").mapInPandas(run, RESULTS, profile=profile)
