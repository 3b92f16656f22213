"""Disjoint random rounds of frames.

Drawing K frames at a time without replacement until too few are left is one random permutation of
the pool cut into pieces of K. The permutation orders the pool by a hash of seed and frame, so it is
the same for any partitioning, and no state passes from round to round.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import MiningConfig
from ..schemas import ROUNDS
from .permutation import pass_numbers, permute


ROUND_NAMES = ["sample_id", "sample_index", "round_id", "frame_indices", "remaining_pool_size"]
#: Places that random access permutes at a time.
DRAWN_AT_ONCE = 1 << 16
#: Frames of a pool that are put in order within one row.
ARRAY_FRAMES = 1 << 18


def pool_size(stride: int, total: str = "total_frames") -> Column:
    """How many of 0, stride, 2 * stride .. lie below column ``total``."""
    return F.expr(f"if({total} > 0, ({total} + {stride - 1}) div {stride}, 0L)")


def expected_rounds(config: MiningConfig, total: str = "total_frames") -> Column:
    """Rounds by frame count alone; the stride doesn't enter."""
    most = F.expr(f"{total} div {config.budget_k}")
    return most if config.round_limit is None else F.least(most, F.lit(config.round_limit).cast("long"))


def actual_rounds(config: MiningConfig, total: str = "total_frames") -> Column:
    """Rounds that the strided pool yields."""
    most = F.expr(f"if({total} > 0, ({total} + {config.frame_stride - 1}) div {config.frame_stride}, 0L) div {config.budget_k}")
    return most if config.round_limit is None else F.least(most, F.lit(config.round_limit).cast("long"))


def generate_rounds(samples: DataFrame, config: MiningConfig, fast: bool = False) -> DataFrame:
    """``(sample_id, sample_index, round_id, frame_indices, remaining_pool_size)``.

    ``samples`` needs sample_id, sample_index and total_frames; repeated rows are one pool that holds each
    frame as often. The order hash is md5, which other engines compute alike; ``fast`` takes xxhash64.
    Samples are dealt out by sample_index before their frames exist, and a pool is put in order within its
    sample's row, so no frame is shuffled or spilled and what joins by sample_index afterwards need not move
    the rounds. Pools of more than ``ARRAY_FRAMES`` frames are sorted as rows of Spark instead.
    """
    k, stride, keys = config.budget_k, config.frame_stride, ["sample_index", "sample_id", "total_frames"]
    seed = F.lit(config.random_seed) + F.col("sample_index")

    def order(frame: Column) -> Column:
        return F.xxhash64(seed, frame) if fast else F.md5(F.concat_ws(":", seed.cast("string"), frame.cast("string")).cast("binary"))

    parts = max(1, int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = samples.where("total_frames > 0").select(*keys).repartition(parts, "sample_index").groupBy(*keys).agg(F.count("*").alias("copies"))
    frames = F.sequence(F.lit(0).cast("long"), F.col("total_frames") - 1, F.lit(stride).cast("long"))
    short = pool_size(stride) * F.col("copies") <= ARRAY_FRAMES

    ordered = F.transform(F.sort_array(F.transform(frames, lambda f: F.struct(order(f).alias("hash"), f.alias("frame")))), lambda x: x["frame"])
    pool = F.when(F.col("copies") == 1, ordered).otherwise(F.flatten(F.transform(ordered, lambda f: F.array_repeat(f, F.col("copies").cast("int")))))
    last = actual_rounds(config).cast("int") - 1
    cut = lambda p: F.transform(F.sequence(F.lit(0), last), lambda r: F.struct(r.alias("round_id"), F.sort_array(F.slice(p, r * k + 1, F.lit(k))).alias("frame_indices")))
    # The pool is an argument of the outer function, so it is computed once and not again for each round.
    rounds = dealt.where(short & (last >= 0)).select(*keys, F.explode(F.transform(F.array(pool), cut)[0]).alias("round")).select(*keys, "round.*")

    rows = dealt.where(~short).withColumn("frame_index", F.explode(frames)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(order(F.col("frame_index")), "frame_index")))
    if config.round_limit is not None:
        ranked = ranked.where(F.col("rank") <= config.round_limit * k)
    ranked = ranked.withColumn("round_id", F.expr(f"cast((rank - 1) div {k} as int)")).where(F.col("round_id") < actual_rounds(config))
    rounds = rounds.union(ranked.groupBy(*keys, "round_id").agg(F.sort_array(F.collect_list("frame_index")).alias("frame_indices")))
    return rounds.select(
        "sample_id",
        "sample_index",
        "round_id",
        "frame_indices",
        (pool_size(stride) - (F.col("round_id") + 1) * k).cast("long").alias("remaining_pool_size"),
    )


def lazy_rounds(samples: DataFrame, config: MiningConfig, rounds: Column | None = None) -> DataFrame:
    """The columns of ``generate_rounds``, each round computed from its number: nothing is sorted, shuffled or windowed.

    The permutation of ``permutation.permuted`` is computed in batches of places.
    ``rounds``: an array of the numbers wanted of each sample (null: none), all if left out; numbers
    that the pool has no frames for are left out. The permutation is another one than that of
    ``generate_rounds``; rounds are as disjoint and as complete.
    """
    last = actual_rounds(config).cast("int") - 1
    every = F.when(last >= 0, F.sequence(F.lit(0), last))
    wanted = every if rounds is None else F.when(last >= 0, F.filter(rounds, lambda r: (r >= 0) & (r <= last)))
    n, k = pool_size(config.frame_stride).cast("long"), config.budget_k
    pools = samples.where("total_frames > 0").select(F.col("sample_id").cast("string"), F.col("sample_index").cast("long"), n.alias("n"), wanted.cast("array<int>").alias("wanted"))
    numbered = pools.select("sample_id", "sample_index", "n", F.explode("wanted").alias("round_id"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, DRAWN_AT_ONCE // k)):
                part = batch.slice(at, max(1, DRAWN_AT_ONCE // k))
                index, size, number = part.column(1).to_pylist(), part.column(2).to_numpy(), part.column(3).to_numpy().astype(np.int64)
                # A sample's rounds come in a row: its keys are made once.
                starts = [i for i in range(len(index)) if i == 0 or index[i] != index[i - 1] or size[i] != size[i - 1]]
                keys = np.array([pass_numbers(int(size[i]), None if index[i] is None else config.random_seed + index[i]) for i in starts], np.int64)
                run = np.repeat(np.arange(len(starts)), np.diff([*starts, len(index)]))
                passes = ((keys[run, i, j, None] for j in range(3)) for i in range(keys.shape[1]))
                frames = np.sort(permute(number[:, None] * k + np.arange(k), size[:, None], passes), axis=1) * config.frame_stride
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(index) + 1) * k, pa.int32()), pa.array(frames.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), lists, pa.array(size - (number + 1) * k)], ROUND_NAMES)

    return numbered.mapInArrow(draw, ROUNDS)


def seeded_rounds(samples: DataFrame, config: MiningConfig) -> DataFrame:
    """The same columns, drawn by Python's Mersenne Twister from a seed per sample.

    For runs that must repeat an earlier Python sampler draw by draw; results depend on the Python
    version. Each sample stands alone, so nothing is shuffled.
    """
    k, stride, limit, first = config.budget_k, config.frame_stride, config.round_limit, config.random_seed

    def draw(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for sample, index, total in zip(batch["sample_id"], batch["sample_index"], batch["total_frames"]):
                rng, pool, number = random.Random(first + int(index)), set(range(0, int(total), stride)), 0
                while len(pool) >= k and (limit is None or number < limit):
                    picked = sorted(rng.sample(list(pool), k))
                    pool.difference_update(picked)
                    rows.append((sample, int(index), number, picked, len(pool)))
                    number += 1
            yield pd.DataFrame(rows, columns=["sample_id", "sample_index", "round_id", "frame_indices", "remaining_pool_size"])

    schema = "sample_id string, sample_index long, round_id int, frame_indices array<long>, remaining_pool_size long"
    return samples.where("total_frames > 0").select("sample_id", "sample_index", "total_frames").mapInPandas(draw, schema)


def validate_rounds(rounds: DataFrame, samples: DataFrame, budget_k: int) -> DataFrame:
    """``(sample_id, sample_index, valid)``: exact size, ascending, inside the video, no frame twice or null.

    A round whose list is empty or null makes its sample invalid.
    """
    f = F.col("frame_indices")
    checked = rounds.join(samples.select("sample_index", "total_frames"), "sample_index").withColumn(
        "fine", F.coalesce((F.size(f) == budget_k) & (f == F.sort_array(f)) & F.forall(f, lambda x: (x >= 0) & (x < F.col("total_frames"))), F.lit(False))
    )
    # All fine rounds hold budget_k frames, so none is drawn twice if as many are distinct; a sample's rounds are one row, its frames no rows.
    grouped = checked.groupBy("sample_id", "sample_index").agg(F.bool_and("fine").alias("fine"), F.collect_list(F.when(F.col("fine"), f)).alias("drawn"))
    distinct = F.size(F.array_distinct(F.flatten("drawn"))) == budget_k * F.size("drawn")
    return grouped.select("sample_id", "sample_index", (F.col("fine") & distinct).alias("valid"))
