"""Hit rates and the shape of output records."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MiningConfig
from .paths import ID_PREFIX, relative_path, unique_id


def hit_rate(pos: Column, neg: Column) -> Column:
    """pos / (pos + neg), zero where there are no rounds."""
    total = pos + neg
    return F.when(total == 0, F.lit(0.0)).otherwise(pos / F.nullif(total, F.lit(0)))


def rounded_rate(pos: Column, neg: Column) -> Column:
    """The hit rate to four places, as exact as Python's ``round``: by the binary fraction that the double is, half to even.

    A rate of 2**-10 or more is a whole number of 2**-62, one of 2**-20 or more of 2**-72; smaller
    ones round to zero. In these units 10,000 times the rate is a whole number of 25 digits, and
    quotient and rest decide.
    """
    rate = hit_rate(pos, neg)

    def exact(bits: int) -> Column:
        unit = F.lit(Decimal(2**bits)).cast("decimal(22,0)")
        number = (rate * float(2**bits)).cast("long").cast("decimal(19,0)") * F.lit(Decimal(10_000)).cast("decimal(5,0)")
        rest = number % unit
        quotient = ((number - rest) / unit).cast("long")
        up = (rest * 2 > unit) | ((rest * 2 == unit) & (quotient % 2 == 1))
        return (quotient + F.when(up, 1).otherwise(0)).cast("double") / 10_000.0

    return F.when(rate >= 2.0**-10, exact(62)).when(rate >= 2.0**-20, exact(72)).otherwise(F.lit(0.0))


def bucket_json(bucket: Column) -> Column:
    """A bucket as it is written: round, frames and prediction."""
    return F.transform(
        bucket,
        lambda r: F.struct(r["round_id"].alias("round_id"), r["frame_indices"].alias("frame_indices"), r["prediction"].alias("prediction")),
    )


def stats_struct(pos: Column, neg: Column) -> Column:
    pos, neg = pos.cast("long"), neg.cast("long")
    return F.struct((pos + neg).alias("total_rounds"), rounded_rate(pos, neg).alias("hit_rate"), pos.alias("pos_count"), neg.alias("neg_count"))


def output_record(base_dir: str | None = None, prefix: str = ID_PREFIX) -> list[Column]:
    """The columns of a record, in the order of the file format, over mined samples."""
    pos, neg = F.col("mining_result.pos_bucket"), F.col("mining_result.neg_bucket")
    path = relative_path(F.col("video_path"), base_dir) if base_dir is not None else F.col("video_path")
    return [
        unique_id(F.col("sample_id"), prefix).alias("unique_id"),
        path.alias("video_path"),
        F.col("question"),
        F.col("ground_truth"),
        F.col("total_frames"),
        F.struct(bucket_json(pos).alias("pos_bucket"), bucket_json(neg).alias("neg_bucket")).alias("mining_result"),
        stats_struct(F.size(pos), F.size(neg)).alias("stats"),
    ]


def config_digest(config: MiningConfig, field: str, value: Column) -> Column:
    """``config.digest()`` with ``field`` taken from a column, whose text is its JSON."""
    mark = "\x00"
    before, after = json.dumps(config.to_dict() | {field: mark}, sort_keys=True).split(json.dumps(mark))
    return F.substring(F.md5(F.concat(F.lit(before), value.cast("string"), F.lit(after)).cast("binary")), 1, 16)
