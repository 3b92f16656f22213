"""Frame files as a Spark data source: ``spark.read.format("frame_files")`` and ``df.write.format("frame_files")``.

A row is a file ``{path}/{video_name}/{frame_index}.jpg``: ``video_name, frame_index, image``. Register it
with ``spark.dataSource.register(FrameFiles)``. Options: ``digits`` (least digits of a file name, 6).

Reading is dealt out by video and ``run`` frames; comparisons of frame_index and video_name with
numbers and texts are taken over by the reader, so files that they leave out are never opened.
Writing goes to a folder aside; only the commit renames files into place, and an abort removes them,
so a failed job leaves nothing, and a task that ran twice counts once.
"""

from __future__ import annotations

import operator
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import Row, StructType

from ..storage import opened

SCHEMA = "video_name string, frame_index bigint, image binary"
_TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


class FrameFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FrameReader:
        return FrameReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> FrameWriter:
        return FrameWriter(self.options, schema.names, overwrite)


@dataclass
class Files(InputPartition):
    """Some frames of one video, each with its file's name."""

    video: str
    frames: list[tuple[int, str]]

    def __hash__(self) -> int:
        return hash((self.video, len(self.frames)))


class FrameReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.run = options["path"].rstrip("/"), int(options.get("run", 2048))
        self.tests: list[tuple[str, object, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over comparisons with the columns that are in a file's path; yields the rest."""
        for f in filters:
            if isinstance(f, (*_TESTS, In)) and f.attribute in (("video_name",), ("frame_index",)) and f.value is not None:
                self.tests.append((f.attribute[0], (lambda a, b: a in b) if isinstance(f, In) else _TESTS[type(f)], f.value))
            else:
                yield f

    def _wanted(self, column: str, value: object) -> bool:
        return all(test(value, other) for name, test, other in self.tests if name == column)

    def partitions(self) -> list[Files]:
        files, base = opened(self.path)
        out = []
        for folder in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if folder.type != fs.FileType.Directory or folder.base_name.startswith((".", "_")) or not self._wanted("video_name", folder.base_name):
                continue
            names = (f.base_name for f in files.get_file_info(fs.FileSelector(folder.path)))
            frames = sorted((int(m[1]), m[0]) for m in map(re.compile(r"(\d+)\.jpg").fullmatch, names) if m)
            frames = [f for f in frames if self._wanted("frame_index", f[0])]
            out += [Files(folder.base_name, frames[at : at + self.run]) for at in range(0, len(frames), self.run)]
        return out

    def read(self, partition: Files) -> Iterator[tuple]:
        files, base = opened(self.path)
        for frame, name in partition.frames if partition else []:
            with files.open_input_stream(f"{base}/{partition.video}/{name}", compression=None) as f:
                yield partition.video, frame, f.read()


@dataclass
class Staged(WriterCommitMessage):
    """What a task wrote aside: names as they are to be."""

    folder: str
    names: list[str]


class FrameWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.path, self.digits, self.overwrite = options["path"].rstrip("/"), int(options.get("digits", 6)), overwrite
        self.at = [columns.index(c) for c in ("video_name", "frame_index", "image")]
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Staged:
        files, base = opened(self.path)
        folder, names = f"{base}/_aside-{self.job}/{uuid.uuid4().hex}", []
        for row in iterator:
            video, frame, image = (row[i] for i in self.at)
            if not video or "/" in video or frame is None or frame < 0 or image is None:
                raise ValueError(f"no frame file can be named {video!r}/{frame!r}")
            names.append(f"{video}/{frame:0{self.digits}d}.jpg")
            files.create_dir(f"{folder}/{video}", recursive=True)
            with files.open_output_stream(f"{folder}/{names[-1]}", compression=None) as f:
                f.write(image)
        return Staged(folder, names)

    def _clean(self) -> None:
        files, base = opened(self.path)
        if files.get_file_info(f"{base}/_aside-{self.job}").type == fs.FileType.Directory:
            files.delete_dir(f"{base}/_aside-{self.job}")

    def commit(self, messages: list[Staged | None]) -> None:
        files, base = opened(self.path)
        if self.overwrite:
            for folder in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if folder.type == fs.FileType.Directory and not folder.base_name.startswith("_aside-"):
                    files.delete_dir(folder.path)
        made = set()
        for message in messages:
            for name in message.names if message else []:
                video = name.rsplit("/", 1)[0]
                if video not in made:
                    files.create_dir(f"{base}/{video}", recursive=True)
                    made.add(video)
                files.move(f"{message.folder}/{name}", f"{base}/{name}")
        self._clean()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clean()
