"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder on a local master and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="sparkreel-")
        base = _OWN_DIRS[app]
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder: computed once, and not again when an executor is lost."""
    path = fresh(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with or without a scheme, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))
