"""Positions, contiguous shares and the order of results."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import written

#: ``monotonically_increasing_id`` keeps the row's number within its partition in so many low bits.
ROW_BITS = 33


def worker_of(position: str, count: int, workers: int) -> Column:
    """The worker of a position when ``count`` positions are cut into equal runs; the last takes the rest."""
    share = count // workers
    if share == 0:
        return F.lit(workers - 1).cast("long")
    return F.least(F.expr(f"cast({position} as bigint) div {share}"), F.lit(workers - 1).cast("long"))


def by_sample_id(results: DataFrame) -> DataFrame:
    """Ordered by sample_id as text."""
    return results.orderBy("sample_id")


def tasks_by_name(samples: DataFrame) -> DataFrame:
    """``(task_type, samples, frames)`` in order of the names."""
    return samples.groupBy("task_type").agg(F.count("*").alias("samples"), F.sum("total_frames").alias("frames")).orderBy("task_type")


def at_index(samples: DataFrame, index: int) -> DataFrame:
    return samples.where(F.col("sample_index") == index)


def by_id(samples: DataFrame, sample_id: str) -> DataFrame:
    """The first sample with that id, or no row."""
    return samples.where(F.col("sample_id") == sample_id).orderBy("sample_index").limit(1)


def pick(samples: DataFrame, indices: list[int] | DataFrame | None) -> DataFrame:
    """A subset by position: a short list, or a DataFrame with ``sample_index`` of any length; None: all."""
    if indices is None:
        return samples
    if isinstance(indices, DataFrame):
        return samples.join(indices.select("sample_index").distinct(), "sample_index", "left_semi")
    return samples.where(F.col("sample_index").isin(list(indices)))


def numbered(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """``df`` with its place (from 0) in the order of ``order``, over all rows, without one window.

    Rows are dealt out by ranges of ``order``, sorted and numbered within each range, and written;
    a range's first place is the sum of the counts before it, one number a range. Ties are numbered
    in any order, nulls as Spark sorts them; only rows that tie in all of ``order`` must share a range.
    An empty table stays empty.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = written(ranged.withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(name, ROW_BITS)
    counts: dict[int, int] = defaultdict(int, table.groupBy(part.alias("part")).count().collect())
    firsts, total = [], 0
    for at in range(max(counts, default=0) + 1):
        firsts.append(F.lit(total).cast("long"))
        total += counts[at]
    row = F.col(name).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return table.withColumn(name, F.element_at(F.array(*firsts), (part + 1).cast("int")) + row)
