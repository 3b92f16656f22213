"""Paths, stems, file names and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what a record's id starts with.
ID_PREFIX = "mlvu_dev_"


def relative_path(path: Column, base: str) -> Column:
    """``path`` without a leading ``base`` (a plain string prefix) and the slashes after it."""
    if not base:
        return F.regexp_replace(path, "^/+", "")
    rest = F.regexp_replace(F.substring(path, F.lit(len(base) + 1), F.length(path)), "^/+", "")
    return F.when(F.startswith(path, F.lit(base)), rest).otherwise(path)


def stem(path: Column) -> Column:
    """The last name of a path without its last suffix; a dotfile keeps its name."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?/*$", 1)


def frame_filename(frame: Column, digits: int = 6) -> Column:
    """``000123.jpg``; a longer number keeps all its digits."""
    return F.format_string(f"%0{digits}d.jpg", frame)


def unique_id(sample: Column, prefix: str = ID_PREFIX) -> Column:
    return F.concat(F.lit(prefix), sample)


def sample_id(task: Column, position: Column) -> Column:
    """``task_position``, by the item's place in its file."""
    return F.concat_ws("_", task, position.cast("string"))


def join_path(*parts: Column) -> Column:
    """Parts joined by slashes; an absolute part discards what precedes it."""
    out = parts[0]
    for part in parts[1:]:
        joined = F.when(F.endswith(out, F.lit("/")) | (out == ""), F.concat(out, part)).otherwise(F.concat_ws("/", out, part))
        out = F.when(F.startswith(part, F.lit("/")), part).otherwise(joined)
    return out
