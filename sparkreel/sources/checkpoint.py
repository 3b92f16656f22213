"""Which samples are done, as one small JSON document."""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MiningConfig


@dataclass
class Checkpoint:
    processed_sample_ids: list[str] = field(default_factory=list)
    total_processed: int = 0
    last_updated: str = ""
    config_hash: str = ""
    output_file: str = ""


class CheckpointStore:
    """Reads and writes a checkpoint; the set of done ids stays in memory between saves."""

    def __init__(self, path: str):
        self.path = path
        self.state: Checkpoint | None = None
        self.processed: set[str] = set()
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)

    def load(self) -> Checkpoint | None:
        """The stored state, or None where there is none or it can't be read (with a warning)."""
        if not os.path.exists(self.path):
            return None
        try:
            with open(self.path, encoding="utf-8") as file:
                data = json.load(file)
            self.state = Checkpoint(**{k: data[k] for k in Checkpoint.__dataclass_fields__ if k in data})
        except (OSError, ValueError, TypeError) as e:
            warnings.warn(f"checkpoint can't be read: {e}", stacklevel=2)
            return None
        self.processed = set(self.state.processed_sample_ids)
        return self.state

    def save(self, ids: Iterable[str], config: MiningConfig, output_file: str) -> None:
        """Write the state; a crash leaves the old file."""
        ids = list(ids)
        self.state = Checkpoint(ids, len(ids), datetime.now().isoformat(), config.digest(), output_file)
        part = f"{self.path}.part"
        with open(part, "w", encoding="utf-8") as file:
            json.dump(asdict(self.state), file, indent=2)
        os.replace(part, self.path)
        self.processed = set(ids)

    def add(self, sample_id: str, config: MiningConfig, output_file: str, auto_save: bool = True, interval: int = 50) -> None:
        """Note a sample as done; every ``interval`` ids the state is saved."""
        self.processed.add(sample_id)
        if auto_save and len(self.processed) % interval == 0:
            self.save(self.processed, config, output_file)

    def is_processed(self, sample_id: str) -> bool:
        return sample_id in self.processed

    def matches(self, config: MiningConfig) -> bool:
        """Whether the state was saved under these settings; true without a state."""
        return self.state is None or self.state.config_hash == config.digest()

    def progress(self) -> dict:
        return {"processed_count": len(self.processed), "last_updated": self.state.last_updated if self.state else None, "output_file": self.state.output_file if self.state else None}

    def clear(self) -> None:
        if os.path.exists(self.path):
            os.remove(self.path)
        self.state, self.processed = None, set()


def unprocessed(samples: DataFrame, done: DataFrame) -> DataFrame:
    """Samples whose id isn't in ``done(sample_id)``; Spark picks the join by size."""
    return samples.join(done.select("sample_id"), "sample_id", "left_anti").select(*samples.columns)


def in_slices(samples: DataFrame, store: CheckpointStore, config: MiningConfig, output_file: str, work: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> int:
    """Work off what is left in slices of ``samples_per_checkpoint``: write each, then commit its ids.

    Returns how many samples were done. A crash repeats one slice at most.
    """
    spark, count = samples.sparkSession, 0
    while True:
        done = spark.createDataFrame([(i,) for i in sorted(store.processed)], "sample_id string")
        part = unprocessed(samples, done).orderBy("sample_index").limit(config.samples_per_checkpoint)
        ids = [r[0] for r in part.select("sample_id").collect()]  # one slice
        if not ids:
            return count
        write(work(samples.where(F.col("sample_id").isin(ids))))
        store.save([*store.processed, *ids], config, output_file)
        count += len(ids)
