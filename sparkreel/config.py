"""Run settings, validated on the driver."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
from dataclasses import dataclass
from typing import Any

#: The multiple-choice task files, in reading order.
MCQ_TASKS = ("1_plotQA", "2_needle", "3_ego", "4_count", "5_order", "6_anomaly_reco", "7_topic_reasoning")


@dataclass(frozen=True)
class MiningConfig:
    """Sampling, early stopping, model and path settings.

    ``min_remaining_frames`` and ``workers_per_gpu`` are accepted and have no effect.
    ``max_iterations`` of zero, or ``full_extraction``, lifts the limit on rounds.
    """

    budget_k: int = 16
    max_iterations: int = 50
    min_remaining_frames: int = 16
    random_seed: int = 42
    frame_stride: int = 10
    min_pos_samples: int = 5
    min_neg_samples: int = 0
    full_extraction: bool = False
    model_name: str = ""
    dtype: str = "bfloat16"
    max_new_tokens: int = 64
    num_gpus: int = 2
    workers_per_gpu: int = 1
    batch_size: int = 16
    prefetch_frames: bool = True
    samples_per_checkpoint: int = 50
    json_dir: str = ""
    video_dir: str = ""
    mcq_tasks: tuple[str, ...] = MCQ_TASKS
    output_dir: str = "./output"
    checkpoint_dir: str = "./checkpoints"
    output_filename: str = "bucket_dataset.jsonl"

    def __post_init__(self) -> None:
        for name, least in (("budget_k", 1), ("max_iterations", 0), ("min_remaining_frames", 0), ("num_gpus", 1), ("batch_size", 1)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be at least {least}")

    def to_dict(self) -> dict[str, Any]:
        return dataclasses.asdict(self)

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> MiningConfig:
        """Settings from a dictionary; unknown keys are ignored.

        A missing ``min_neg_samples`` means 5 here, though 0 for the class itself.
        """
        known = {f.name for f in dataclasses.fields(cls)}
        given = {"min_neg_samples": 5} | {k: v for k, v in values.items() if k in known}
        if "mcq_tasks" in given:
            given["mcq_tasks"] = tuple(given["mcq_tasks"])
        return cls(**given)

    @property
    def round_limit(self) -> int | None:
        """The most rounds per sample, or None for no limit."""
        return None if self.full_extraction or self.max_iterations == 0 else self.max_iterations

    def max_rounds(self, total_frames: int) -> int:
        """Expected rounds; the stride doesn't enter."""
        most = total_frames // self.budget_k
        return most if self.round_limit is None else min(most, self.round_limit)

    def digest(self) -> str:
        """16 hex digits that change with any setting."""
        return hashlib.md5(json.dumps(self.to_dict(), sort_keys=True).encode()).hexdigest()[:16]

    def output_path(self, experiment: str | None = None) -> str:
        return self._path(self.output_dir, experiment, "results.jsonl", self.output_filename)

    def checkpoint_path(self, experiment: str | None = None) -> str:
        return self._path(self.checkpoint_dir, experiment, "checkpoint.json", "checkpoint.json")

    @staticmethod
    def _path(folder: str, experiment: str | None, own: str, common: str) -> str:
        if not experiment:
            return os.path.join(folder, common)
        os.makedirs(os.path.join(folder, experiment), exist_ok=True)
        return os.path.join(folder, experiment, own)

    def ensure_dirs(self) -> None:
        os.makedirs(self.output_dir, exist_ok=True)
        os.makedirs(self.checkpoint_dir, exist_ok=True)
