"""Batched early stopping."""

from __future__ import annotations

import re
import traceback
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import MiningConfig
from ..functions import answer_matches
from ..functions.answers import LETTER_PATTERNS
from .inference import once_a_process
from .permutation import permuted_numbers


def enough(hits: Column, misses: Column, config: MiningConfig) -> Column:
    """Whether both minima are reached; one of zero or less is no constraint."""
    out = F.lit(True)
    for count, least in ((hits, config.min_pos_samples), (misses, config.min_neg_samples)):
        if least > 0:
            out = out & (count >= least)
    return out


def stop_early(results: DataFrame, samples: DataFrame, config: MiningConfig, flush_tail: bool = True, match: str = "exact") -> DataFrame:
    """The results up to and including the batch at which a sample has enough, with ``num_rounds``.

    ``results`` has sample_index, round_id and prediction for every round that could be asked;
    ``samples`` has sample_index, formatted_answer and total_frames. Rounds are judged in batches of
    ``batch_size``. With ``flush_tail`` a last partial batch is judged too; without, only if the
    rounds generated reach the expected number, which a stride above one mostly prevents.
    ``match``: 'exact' compares texts, 'letter' option letters. ``num_rounds`` counts rounds
    generated. One shuffle by sample serves all windows.
    """
    if match not in ("exact", "letter"):
        raise ValueError("match is 'exact' or 'letter'")
    b = config.batch_size
    truth = samples.select("sample_index", "formatted_answer", "total_frames")
    hit = answer_matches(F.col("prediction"), F.col("formatted_answer")) if match == "letter" else F.coalesce(F.col("prediction") == F.col("formatted_answer"), F.lit(False))
    by = W.partitionBy("sample_index")
    upto = by.orderBy("batch").rangeBetween(W.unboundedPreceding, W.currentRow)
    expected = F.expr(f"total_frames div {config.budget_k}")
    if config.round_limit is not None:
        expected = F.least(expected, F.lit(config.round_limit).cast("long"))
    rows = (
        results.join(truth, "sample_index")
        .withColumn("hit", hit)
        .withColumn("batch", F.expr(f"round_id div {b}"))
        .withColumn("generated", F.count("*").over(by))
        .withColumn("judged", ((F.col("batch") + 1) * b <= F.col("generated")) | (F.lit(True) if flush_tail else F.col("generated") >= expected))
        .withColumn("hits", F.count_if(F.col("hit") & F.col("judged")).over(upto))
        .withColumn("misses", F.count_if(~F.col("hit") & F.col("judged")).over(upto))
        .withColumn("stop", F.min(F.when(F.col("judged") & enough(F.col("hits"), F.col("misses"), config), F.col("batch"))).over(by))
    )
    num = F.when(F.col("stop").isNull(), F.col("generated")).otherwise(F.least((F.col("stop") + 1) * b, F.col("generated")))
    kept = F.col("judged") & (F.col("stop").isNull() | (F.col("batch") <= F.col("stop")))
    return rows.where(kept).select(*results.columns, num.alias("num_rounds"))


def ask_until_enough(
    rounds: DataFrame,
    samples: DataFrame,
    predict: Callable[[dict, list[tuple[int, list[int]]]], list[str | None]] | None,
    config: MiningConfig,
    flush_tail: bool = True,
    match: str = "exact",
    make: Callable[[], Callable] | None = None,
) -> DataFrame:
    """The same rows, for a predictor that costs: a sample's batches are asked in turn until it has enough.

    ``predict(sample, [(round_id, frames), ..])`` runs in the task; with ``make`` instead it is made
    once in each Python worker process. A sample is one group: its rounds
    are bounded by ``max_iterations``. An exception makes one row with ``error`` and no prediction.
    """
    b, get = config.batch_size, once_a_process(make) if make else lambda: predict

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("round_id")
        batches = ([(int(r), list(f)) for r, f in zip(part["round_id"], part["frame_indices"])] for part in (pdf.iloc[at : at + b] for at in range(0, len(pdf), b)))
        return pd.DataFrame(_asked(pdf.iloc[0].to_dict(), len(pdf), batches, get, config, flush_tail, match), columns=ASKED_NAMES)

    joined = rounds.select("sample_index", "round_id", "frame_indices").join(samples, "sample_index")
    return joined.groupBy("sample_index").applyInPandas(run, ASKED)


ASKED = "sample_id string, sample_index long, round_id int, frame_indices array<long>, prediction string, error string, traceback string, num_rounds long"
ASKED_NAMES = [c.split()[0] for c in ASKED.split(", ")]


def _letter(text: str | None) -> str | None:
    found = (re.search(p, (text or "").strip()) for p in LETTER_PATTERNS)
    return next((m.group(1).upper() for m in found if m), None)


def _asked(sample: dict, generated: int, batches: Iterator[list[tuple[int, list[int]]]], get: Callable, config: MiningConfig, flush_tail: bool, match: str) -> list[tuple]:
    """Rows of one sample: batches are taken and asked in turn until it has enough. A failure is one row with its error."""
    least_pos, least_neg, limit, truth = config.min_pos_samples, config.min_neg_samples, config.round_limit, sample["formatted_answer"]
    expected = sample["total_frames"] // config.budget_k
    expected = expected if limit is None else min(expected, limit)
    hits, misses, asked, rows = 0, 0, 0, []
    try:
        while asked < generated:
            size = min(config.batch_size, generated - asked)
            asked += size
            if size < config.batch_size and not flush_tail and generated < expected:
                break
            part = next(batches)
            answers = get()(sample, part)
            rows += [(r, f, a) for (r, f), a in zip(part, answers)]
            for a in answers:
                hit = (_letter(a) is not None and _letter(a) == _letter(truth)) if match == "letter" else a is not None and a == truth
                hits, misses = hits + hit, misses + (not hit)
            if (least_pos <= 0 or hits >= least_pos) and (least_neg <= 0 or misses >= least_neg):
                break
    except Exception as e:  # one sample's failure is a row, not the job's end
        return [(sample["sample_id"], sample["sample_index"], None, None, None, str(e), traceback.format_exc(), None)]
    return [(sample["sample_id"], sample["sample_index"], r, f, p, None, None, asked) for r, f, p in rows]


def ask_lazily(
    samples: DataFrame,
    predict: Callable[[dict, list[tuple[int, list[int]]]], list[str | None]] | None,
    config: MiningConfig,
    flush_tail: bool = True,
    match: str = "exact",
    make: Callable[[], Callable] | None = None,
    note: Callable[[int], None] | None = None,
) -> DataFrame:
    """The rows of ``ask_until_enough`` over ``lazy_rounds``, but no round is drawn before its batch is asked.

    A table function takes each sample in turn, draws a batch of rounds by random access, asks, and
    ends the sample by itself; no table of rounds exists, and a row with the sample's own columns is
    all that is shuffled. ``note(rounds)`` is called with the size of each batch drawn.
    """
    from pyspark.sql.functions import udtf

    get = once_a_process(make) if make else lambda: predict

    class Ask:
        def eval(self, row):
            sample = row.asDict()
            total = sample["total_frames"] or 0
            n = -(-total // config.frame_stride) if total > 0 else 0
            generated = n // config.budget_k
            generated = generated if config.round_limit is None else min(generated, config.round_limit)

            def draw():
                for at in range(0, generated, config.batch_size):
                    numbers = range(at, min(at + config.batch_size, generated))
                    places = np.arange(at * config.budget_k, numbers.stop * config.budget_k)
                    frames = np.sort(permuted_numbers(places, n, config.random_seed + sample["sample_index"]).reshape(-1, config.budget_k) * config.frame_stride, axis=1)
                    if note:
                        note(len(numbers))
                    yield list(zip(numbers, frames.tolist()))

            yield from _asked(sample, generated, draw(), get, config, flush_tail, match)

    return udtf(Ask, returnType=ASKED)(samples.asTable().partitionBy("sample_index").orderBy("sample_id"))
