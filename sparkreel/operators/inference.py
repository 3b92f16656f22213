"""Predictions of rounds by a pluggable model.

A predictor is a function made once in each Python worker by ``make()``; it takes a list of
(question, candidates, frames) and returns a list of answers, in order.
"""

from __future__ import annotations

import hashlib
import traceback
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RESULTS

Predict = Callable[[list[dict]], list[str]]
NAMES = ["sample_id", "round_id", "frame_indices", "prediction", "input_tokens", "output_tokens", "num_frames", "error"]


class OutOfMemory(RuntimeError):
    """What a predictor raises if a batch doesn't fit."""


_MADE: dict[str, object] = {}


def once_a_process(make: Callable[[], object]) -> Callable[[], object]:
    """``make`` so that a Python worker process calls it once, however many tasks it runs."""
    key = hashlib.md5(cloudpickle.dumps(make)).hexdigest()

    def get():
        from sparkreel.operators import inference

        if key not in inference._MADE:
            inference._MADE[key] = make()
        return inference._MADE[key]

    return get


def degrade(predict: Predict, items: list[dict]) -> list[str]:
    """Answers in order; a batch that doesn't fit is halved, down to single items."""
    try:
        return list(predict(items))
    except (OutOfMemory, MemoryError):
        if len(items) == 1:
            raise
        middle = len(items) // 2
        return degrade(predict, items[:middle]) + degrade(predict, items[middle:])


def _answers(predict: Predict, items: list[dict]) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each item; if a batch fails, its items are asked one by one."""
    try:
        return [(str(a).strip(), None) for a in degrade(predict, items)]
    except Exception as e:  # an item's failure is its row's error
        if len(items) == 1:
            return [(None, "".join(traceback.format_exception_only(e)).strip().splitlines()[-1])]
        return [_answers(predict, [i])[0] for i in items]


def rounds_of(part) -> list[tuple]:
    """The rounds of a pandas frame: (sample_id, round_id, frame_indices, question, candidates)."""
    return list(zip(part["sample_id"], part["round_id"], part["frame_indices"], part["question"], part["candidates"]))


def results_frame(rows: list[tuple]):
    import pandas as pd

    return pd.DataFrame(rows, columns=NAMES, dtype=object).astype({"round_id": "int32", "input_tokens": "Int32", "output_tokens": "Int32", "num_frames": "Int32"})


def answered(predict: Predict, count: Callable[[str], int], part: list[tuple]) -> Iterator[tuple]:
    """The results of one batch of rounds (sample_id, round_id, frame_indices, question, candidates)."""
    items = [{"question": q, "candidates": list(c) if c is not None else [], "frame_indices": f.tolist()} for _, _, f, q, c in part]
    padded = max(count(i["question"] or "") for i in items)
    for (sample, number, *_), item, (answer, error) in zip(part, items, _answers(predict, items)):
        frames = item["frame_indices"]
        yield (sample, number, frames, answer, None, None, None, error) if error else (sample, number, frames, answer, padded, count(answer), len(frames), None)


def predict_rounds(rounds: DataFrame, samples: DataFrame, make: Callable[[], Predict], batch_size: int = 16, token_count: Callable[[str], int] | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """Results of every round: prediction or error, and token counts.

    ``input_tokens`` is the longest of the batch, as a padded batch is what the model reads.
    ``make`` runs once in each Python worker process. ``profile``: the resources of the asking tasks (a
    GPU each, say), where the cluster can schedule them by stage.
    """
    make = once_a_process(make)

    def run(batches: Iterator):
        predict, count = make(), token_count or (lambda s: len(s.split()))
        for batch in batches:
            asked, rows = rounds_of(batch), []
            for at in range(0, len(asked), batch_size):
                rows += answered(predict, count, asked[at : at + batch_size])
            if rows:
                yield results_frame(rows)

    asked = rounds.select("sample_index", "sample_id", "round_id", "frame_indices").join(samples.select("sample_index", "question", "candidates"), "sample_index")
    ordered = asked.repartition("sample_index").sortWithinPartitions("sample_index", "round_id")
    return ordered.select("sample_id", "round_id", "frame_indices", "question", "candidates").mapInPandas(run, RESULTS, profile=profile)


def from_table(rounds: DataFrame, predictions: DataFrame) -> DataFrame:
    """Results looked up in ``predictions(sample_id, round_id, prediction[, error])``."""
    extra = ["error"] if "error" in predictions.columns else []
    found = rounds.join(predictions.select("sample_id", "round_id", "prediction", *extra), ["sample_id", "round_id"])
    return found if extra else found.withColumn("error", F.lit(None).cast("string"))
