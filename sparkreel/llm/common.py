"""Helpers shared by the operators: shared storage, tables written between steps, byte packing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_OWN_DIRS: dict[str, str] = {}
#: The setting that bounds the bytes of rows that go to a Python worker at a time, and its value where the session has none.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, a local master (tests on one machine) gets a temporary folder; on
    a cluster that would be another folder on each machine, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        base = _OWN_DIRS.setdefault(app, "")
        if not base:
            base = _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="sparkreel-")
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/sparkreel-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the written table, so a lost executor repeats little work, and a
    nondeterministic or costly step runs once.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Remove a table that ``materialise`` wrote, once nothing reads it any more."""
    for uri in {os.path.dirname(f) for f in df.inputFiles()}:
        files, path = filesystem(uri)
        files.delete_dir(path)


def partitions(spark: SparkSession) -> int:
    """How many parts a hash of the input is dealt into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` over batches bounded by bytes too: 10,000 long texts at a time would not fit."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def column(name: str) -> Column:
    """A column by its name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_rows(docs: DataFrame, names: list[str] | None = None) -> Column:
    """Columns ``names`` (all if None) as one struct ``row``."""
    return F.struct(*[column(c) for c in docs.columns if names is None or c in names]).alias("row")


def row_schema(rows: DataFrame, more: str) -> StructType:
    """The struct ``row`` of ``rows`` followed by the fields of ``more``, for names that no schema text could hold."""
    return StructType([StructField("row", rows.schema["row"].dataType), *StructType.fromDDL(more).fields])


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a path with or without a scheme, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or os.path.isabs(uri) else os.path.abspath(uri))


def publish(uri: str, write: Callable[[pa.NativeFile], None]) -> None:
    """Write a file under a temporary name and rename it, so that a killed task leaves no half file."""
    files, path = filesystem(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part, compression=None) as out:
        write(out)
    files.move(part, path)


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose strings in ``column`` take about ``size`` bytes, one row at least."""
    strings = batch.column(column)
    if not batch.num_rows:
        return
    ends = np.cumsum(np.asarray(pc.binary_length(strings).fill_null(0), np.int64))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        upto = max(upto, at + 1)
        yield batch.slice(at, upto - at)
        at = upto


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words between ASCII white space of all texts, without a Python loop.

    Returns where each text's words start (and the end of the last), the words as numbers, and the
    distinct words in order of their numbers. A null text has no words; ``lower`` lowers A to Z.
    """
    texts = texts.fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    codes, distinct = coded.indices.to_numpy(), coded.dictionary
    blank = pc.index(distinct, "").as_py() if len(distinct) else -1
    bounds = bounds - bounds[0]
    if blank >= 0:  # what leading and trailing white space leaves
        real = codes != blank
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
        codes = codes[real]
    return bounds, codes, distinct


class Memory(dict):
    """About ``size`` values that were used last: when half of them are new, the older half goes."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size
        self.old: dict = {}

    def make_room(self) -> None:
        if len(self) > self.size // 2:
            self.old = dict(self)
            self.clear()

    def has(self, key) -> bool:
        """Whether there is a value; one of the older half counts as used."""
        if key in self:
            return True
        value = self.old.get(key)
        if value is None:
            return False
        self[key] = value
        return True
