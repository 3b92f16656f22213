"""JSON Lines records: read, append, overwrite, count."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import output_record
from ..functions.paths import ID_PREFIX
from ..schemas import FRAME_INPUT, RECORDS


def read_records(spark: SparkSession, path: str, schema: str = RECORDS) -> DataFrame:
    """Records of a file or folder; blank lines are skipped, a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_frame_input(spark: SparkSession, path: str) -> DataFrame:
    """What frame collection needs, with ``line_no``: ascending within a file, and over files by path.

    A text scan numbers the lines, since JSON rows carry none: the partition of a line comes first
    and partitions of a file follow its offsets.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    parsed = lines.where(F.trim("value") != "").select("file", "block", "row", F.from_json("value", FRAME_INPUT, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*", F.struct("file", "block", "row").alias("line_no"))


def count_records(spark: SparkSession, path: str) -> int:
    """Lines, blank ones included; 0 where there is no file."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.text(path).count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def write_records(records: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write records as JSON Lines and return how many, counted while writing. Nulls are written."""
    seen = Observation(f"records-{uuid.uuid4().hex}")
    records.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return int(seen.get["n"])


def append_records(records: DataFrame, path: str) -> int:
    return write_records(records, path, "append")


def clear_records(spark: SparkSession, path: str, schema: str = RECORDS) -> None:
    """Leave an empty output."""
    spark.createDataFrame([], schema).write.mode("overwrite").json(path)


def mined_records(mined: DataFrame, base_dir: str | None = None, only_both: bool = False, prefix: str = ID_PREFIX) -> DataFrame:
    """Output records of mined samples that have a result; ``only_both``: and both buckets."""
    kept = mined.where(F.col("mining_result").isNotNull())
    if only_both:
        kept = kept.where((F.size("mining_result.pos_bucket") > 0) & (F.size("mining_result.neg_bucket") > 0))
    return kept.select(*output_record(base_dir, prefix))


def write_results(mined: DataFrame, path: str, base_dir: str | None = None, only_both: bool = False) -> int:
    return write_records(mined_records(mined, base_dir, only_both), path)
