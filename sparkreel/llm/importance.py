"""Importance resampling: documents drawn so that their words look like a target's.

Each document's hashed n-gram counts are a row of a sparse matrix, kept as compressed sparse rows
in blocks and written once. The matrix's column sums give the corpus distribution, those of the
target's texts its own; a bucket's gain is the log ratio of the two, smoothed by one count a
bucket. A document's weight is its row times the gains, over its number of features. Gumbel noise
from a hash of the id turns the greatest sums into a draw without replacement.

Nothing but counts by bucket, by score and by partition reaches the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import map_rows, materialise, slices, split_words

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Bytes of text that become a block of the matrix, about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
_BLOCK = "block long, ids array<long>, tags array<long>, n_words binary, row_starts binary, buckets binary, counts binary"
#: Letters, digits and all bytes beyond ASCII belong to words, in lower case; the rest parts them.
_WORD_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def feature_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Where each text's words start (and the end of the last), the words as numbers, and the distinct words."""
    texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(_WORD_BYTES[raw]))
    bounds, codes, distinct = split_words(plain)
    return bounds, codes, distinct.cast(pa.binary()).to_pylist()


def feature_rows(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the sparse rows of its features: row starts, buckets, counts."""
    bounds, codes, words = feature_words(texts)
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    keys = [of * buckets + np.array([zlib.crc32(w) % buckets for w in words], np.int64)[codes]] if len(words) else []
    for n in range(2, longest + 1):
        at = np.flatnonzero(of[n - 1 :] == of[: len(of) - n + 1]) if len(of) >= n else np.empty(0, np.int64)
        if len(at):
            runs, place = np.unique(codes[at[:, None] + np.arange(n)], axis=0, return_inverse=True)
            hashed = np.array([zlib.crc32(b" ".join(words[c] for c in run)) % buckets for run in runs.tolist()], np.int64)
            keys.append(of[at] * buckets + hashed[place.ravel()])
    cells, counts = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(texts) + 1) * buckets)
    return np.diff(bounds), starts, cells % buckets, counts


def csr_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The document-by-bucket matrix, a row for each block of documents; nothing is shuffled.

    ``tags``: the first 32 bits of sha256 of 'seed:id'; a null id is the empty text there.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    tag = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), tag.alias("tag"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, 2, BLOCK_BYTES):
                n_words, starts, cells, counts = feature_rows(part.column(2), longest, buckets)
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(i)) for i in (0, 1)]
                packed = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in ((n_words, "<i8"), (starts, "<i8"), (cells, "<u4"), (counts, "<u4"))]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, *packed], [c.split()[0] for c in _BLOCK.split(", ")])

    return map_rows(rows, _BLOCK, run)


def column_sums(blocks: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """How many features fall into each bucket; a task sums its blocks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cells, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += np.bincount(np.frombuffer(cells, "<u4"), np.frombuffer(counts, "<u4"), buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    sums = [0] * buckets
    for bucket, n in map_rows(blocks.select("buckets", "counts"), "bucket long, n long", run).groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        sums[bucket] = n
    return sums


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of each bucket's share in the target over that in the corpus, one count added to each."""
    here, there, more = sum(corpus), sum(target), len(corpus)
    return [math.floor(1000 * math.log((float(t + 1) * float(here + more)) / (float(s + 1) * float(there + more)))) for s, t in zip(corpus, target)]


def weigh(blocks: DataFrame, gain: list[int]) -> DataFrame:
    """``(id, n_features, n_words, weight, score, block, at)``: each row of the matrix times the gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = np.array(gain, np.int64)
        for batch in batches:
            for block, ids, tags, words, starts, cells, counts in zip(*(c.to_pylist() for c in batch.columns)):
                starts = np.frombuffer(starts, "<i8")
                counts = np.frombuffer(counts, "<u4").astype(np.int64)
                sums = np.append(0, np.cumsum(by[np.frombuffer(cells, "<u4")] * counts))[starts]
                features = np.append(0, np.cumsum(counts))[starts]
                n = np.diff(features)
                weight = np.diff(sums) // np.maximum(n, 1)
                noise = [math.floor(-1000 * math.log(-math.log((t + 0.5) / 4294967296))) for t in tags]
                out = [pa.array(ids, pa.int64()), pa.array(n), pa.array(np.frombuffer(words, "<i8")), pa.array(weight), pa.array(weight + np.array(noise, np.int64)), pa.array([block] * len(ids)), pa.array(range(len(ids)))]
                yield pa.RecordBatch.from_arrays(out, ["id", "n_features", "n_words", "weight", "score", "block", "at"])

    return map_rows(blocks, "id long, n_features long, n_words long, weight long, score long, block long, at long", run)


def draw(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``weighed`` with rank: 1, 2, .. of the greatest scores among long enough documents, null for those not drawn.

    Scores are whole numbers, so their exact counts (some ten thousand numbers) say which scores can
    be drawn at all; only those documents are dealt out by range and numbered.
    """
    long_enough = F.col("n_words") >= min_words
    counts = sorted(weighed.where(long_enough).groupBy("score").count().collect(), reverse=True)
    take = percent * sum(n for _, n in counts) // 100
    left, least = take, None
    for score, n in counts:
        if left <= 0:
            break
        left, least = left - n, score
    if least is None:
        return weighed.withColumn("rank", F.lit(None).cast("long"))
    inside = long_enough & (F.col("score") >= least)
    placed = numbered(weighed.where(inside), F.desc("score"), F.asc_nulls_last("id"), "block", "at", name="rank")
    rank = F.when(F.col("rank") < take, F.col("rank") + 1)
    return placed.withColumn("rank", rank).unionByName(weighed.where(~inside).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", longest: int = 1,
    buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, one row per document.

    Features are runs of 1 to ``longest`` words, repeats counted. Null and empty texts have none and
    weight 0; a null id is drawn last among equal scores; repeated rows repeat, each with a rank of
    its own; rows that tie otherwise are ranked by their place in the table. An empty table gives no
    rows, an empty target a flat distribution. Extra columns are ignored.
    """
    blocks = materialise(csr_blocks(docs, id_col, text_col, longest, buckets, seed), "csr")
    aims = csr_blocks(target.select(F.lit(0).alias("id"), F.col(f"`{target_text_col}`").alias("text")), "id", "text", longest, buckets, seed)
    gain = gains(column_sums(blocks, buckets), column_sums(aims, buckets))
    drawn = draw(materialise(weigh(blocks, gain), "weights"), percent, min_words)
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
