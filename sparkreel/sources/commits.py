"""Which samples are done, as an append-only log on shared storage.

A commit is a folder of Parquet files with the ids of one slice, written aside and renamed into
place, so it is there whole or not at all, and writers don't meet. Compaction writes the ids of all
commits so far as one base and names the commits that it covers; a reader takes the newest base
and the commits that it doesn't cover. The ids never pass through the driver.

Layout: ``commits/<name>/``, ``bases/<generation>-<name>/`` with ``ids/`` and ``covers.json``,
``meta/<name>.json`` with time, settings and output of a commit, and ``aside/`` for what is being written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MiningConfig
from ..storage import opened, written

IDS = "sample_id string, commit string"


class CommitLog:
    """The log below ``folder``, on any storage that both Spark and pyarrow open."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.files, self.path = opened(self.folder)

    def _names(self, kind: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/{kind}", allow_not_found=True))
        return sorted(f.base_name for f in found)

    def _json(self, path: str) -> dict:
        with self.files.open_input_stream(f"{self.path}/{path}", compression=None) as f:
            return json.loads(f.read())

    def _put_json(self, path: str, value: dict) -> None:
        self.files.create_dir(f"{self.path}/{path}".rsplit("/", 1)[0], recursive=True)
        with self.files.open_output_stream(f"{self.path}/{path}", compression=None) as f:
            f.write(json.dumps(value).encode())

    def _place(self, aside: str, target: str) -> None:
        self.files.create_dir(f"{self.path}/{target}".rsplit("/", 1)[0], recursive=True)
        self.files.move(f"{self.path}/{aside}", f"{self.path}/{target}")

    def commit(self, ids: DataFrame, config: MiningConfig, output: str, name: str | None = None) -> str:
        """Add the ``sample_id`` of ``ids`` as one commit and return its name; a name that is there already adds nothing."""
        name = name or f"{datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex}"
        if name in self._names("commits") or any(name in covered for covered in self._bases().values()):
            return name
        aside = f"aside/{uuid.uuid4().hex}"
        ids.select(F.col("sample_id").cast("string")).write.parquet(f"{self.folder}/{aside}")
        self._put_json(f"meta/{name}.json", {"last_updated": datetime.now().isoformat(), "config_hash": config.digest(), "output_file": output})
        self._place(aside, f"commits/{name}")
        return name

    def _bases(self) -> dict[str, set[str]]:
        return {b: set(self._json(f"bases/{b}/covers.json")["commits"]) for b in self._names("bases")}

    def done(self) -> DataFrame:
        """``(sample_id, commit)`` of all commits; an id that was committed twice shows twice, the commit of compacted ones is ''."""
        bases = self._bases()
        out, read = self.spark.createDataFrame([], IDS), self.spark.read.schema("sample_id string")
        if bases:
            out = out.unionByName(read.parquet(*[f"{self.folder}/bases/{b}/ids" for b in bases]).withColumn("commit", F.lit("")))
        if rest := [c for c in self._names("commits") if not any(c in covered for covered in bases.values())]:
            rows = read.parquet(*[f"{self.folder}/commits/{c}" for c in rest])
            out = out.unionByName(rows.withColumn("commit", F.element_at(F.split(F.input_file_name(), "/"), -2)))
        return out

    def compact(self) -> None:
        """Write all commits so far as one base of the next generation; nothing is removed, so readers and writers go on."""
        names, bases = set(self._names("commits")), self._bases()
        covered = set().union(*bases.values())
        if not names - covered:
            return
        aside = f"aside/{uuid.uuid4().hex}"
        self.done().select("sample_id").distinct().write.parquet(f"{self.folder}/{aside}/ids")
        self._put_json(f"{aside}/covers.json", {"commits": sorted(covered | names)})
        generation = 1 + max((int(b.split("-")[0]) for b in bases), default=0)
        self._place(aside, f"bases/{generation:08d}-{uuid.uuid4().hex}")

    def vacuum(self) -> None:
        """Remove commits that a base covers, bases whose commits a larger one covers, and what was left aside. No reader or writer may be at work."""
        bases = self._bases()
        for name in self._names("commits"):
            if any(name in covered for covered in bases.values()):
                self.files.delete_dir(f"{self.path}/commits/{name}")
        for base, covered in bases.items():
            if any(covered < other or (covered == other and base < b) for b, other in bases.items()):
                self.files.delete_dir(f"{self.path}/bases/{base}")
        for name in self._names("aside"):
            self.files.delete_dir(f"{self.path}/aside/{name}")

    def progress(self) -> dict:
        """How many ids are done, and time and output of the last commit."""
        meta = self._names("meta")
        last = self._json(f"meta/{meta[-1]}") if meta else {}
        return {"processed_count": self.done().select("sample_id").distinct().count(), "last_updated": last.get("last_updated"), "output_file": last.get("output_file")}

    def matches(self, config: MiningConfig) -> bool:
        """Whether every commit was made under these settings; true without commits."""
        return all(self._json(f"meta/{m}")["config_hash"] == config.digest() for m in self._names("meta"))

    def is_processed(self, sample_id: str) -> bool:
        return not self.done().where(F.col("sample_id") == sample_id).isEmpty()

    def clear(self) -> None:
        if self.files.get_file_info(self.path).type != fs.FileType.NotFound:
            self.files.delete_dir(self.path)

    def document(self) -> DataFrame:
        """The log as one row in the shape of a checkpoint document, to be written as JSON; ids as an array, so for runs of moderate size."""
        ids = self.done().agg(F.array_sort(F.collect_set("sample_id")).alias("processed_sample_ids"))
        meta = self._names("meta")
        last = self._json(f"meta/{meta[-1]}") if meta else {"last_updated": "", "config_hash": "", "output_file": ""}
        named = [F.lit(last[k]).alias(k) for k in ("last_updated", "config_hash", "output_file")]
        return ids.select("processed_sample_ids", F.size("processed_sample_ids").alias("total_processed"), *named)


def remaining(samples: DataFrame, log: CommitLog) -> DataFrame:
    """Samples that no commit holds; Spark picks the join by size."""
    return samples.join(log.done().select("sample_id"), "sample_id", "left_anti").select(*samples.columns)


def in_commits(samples: DataFrame, log: CommitLog, config: MiningConfig, output: str, work: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str], None], most: int | None = None) -> int:
    """Work off what is left in slices of ``samples_per_checkpoint``, in order of sample_index: write each, then commit its ids.

    ``write(rows, name)`` gets the slice's name; the name is made from the slice's ids, so a run that
    was stopped between write and commit writes the same slice under the same name again, and a writer
    that overwrites by name leaves no row twice. Returns how many samples were done, ``most`` at the most.
    """
    count = 0
    while most is None or count < most:
        size = config.samples_per_checkpoint if most is None else min(config.samples_per_checkpoint, most - count)
        part = written(remaining(samples, log).orderBy("sample_index").limit(size), "slice")
        n, first, last = part.agg(F.count("*"), F.min("sample_index"), F.max("sample_index")).first()
        if not n:
            break
        name = f"{first:012d}-{last:012d}"
        write(work(part), name)
        log.commit(part, config, output, name)
        count += n
    return count
