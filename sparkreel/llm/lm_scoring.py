"""Text scores under an n-gram model with deleted interpolation.

Maximum-likelihood estimates of a word after its ``order - 1`` predecessors, after fewer of them and
alone, and a uniform share are mixed from the longest history down, with weights that depend on how
often the history occurs (buckets of powers of two). Expectation maximisation learns the weights on
counts deleted from the training documents (a twentieth of them), so that the estimates are judged
on text they have not seen.

The counts grow with the corpus and are never broadcast. Each task cuts its documents into blocks,
which are written once. A block sends its distinct n-grams as sorted runs of 64-bit hashes with
partial counts, one run for each range of hashes, through a shuffle by range; a range adds them up
and its totals go back, through a shuffle by block, in the order in which they were asked for. There
are as many ranges as blocks, so neither a run nor a range grows with the corpus, and a frequent n-gram is one entry
a block. A block then scores its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise, partitions, slices, split_words

ORDER = 3
#: Training documents whose counts are deleted while the weights are learnt: one in so many.
DELETED_ONE_IN = 20
#: Buckets of a history's count: 0, then one for each power of two of a 63-bit count.
BUCKETS = 64
#: Bytes of text in a block, about; a longer document is a block of its own.
BLOCK_BYTES = 12 << 20
#: EM stops when no weight moves by more than this, or after so many rounds.
TOLERANCE, ROUNDS = 1e-3, 60


def pack_ints(x: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest takes, lowest bytes of all first."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the first and the steps."""
    return int(x[0]).to_bytes(8, "little") + pack_ints(np.diff(x)) if len(x) else b""


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    return np.cumsum(np.append(np.frombuffer(data[:8], "<u8"), unpack_ints(data[8:])), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cut_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(block, deleted, docs)``: documents in compressed Arrow, deleted ones in blocks of their own. Nothing is shuffled."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        (crc % 5 == 1).alias("held_out"),
        ((crc % 5 != 1) & (F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(DELETED_ONE_IN)) == 0)).alias("deleted"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def out(kind: bool) -> pa.RecordBatch:
            nonlocal number
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, waiting[kind][0].schema) as stream:
                for batch in waiting[kind]:
                    stream.write_batch(batch)
            number += 1
            waiting[kind], size[kind] = [], 0
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([kind]), pa.array([squeeze.compress(sink.getvalue().to_pybytes())], pa.binary())], ["block", "deleted", "docs"])

        for batch in batches:
            for part in slices(batch, 1, BLOCK_BYTES // 8):
                for kind in (False, True):
                    own = part.filter(pc.equal(part.column(3), kind)).select([0, 1, 2])
                    if own.num_rows:
                        waiting[kind].append(own)
                        size[kind] += own.column(1).nbytes
                        if size[kind] >= BLOCK_BYTES:
                            yield out(kind)
        for kind in (False, True):
            if waiting[kind]:
                yield out(kind)

    return map_rows(rows, "block long, deleted boolean, docs binary", run)


class Block:
    """A block's documents as numbers: for each order the distinct n-grams and each token's place among them."""

    def __init__(self, data: bytes, order: int):
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)) as stream:
            table = stream.read_all().combine_chunks()
        self.ids, self.held = table.column("doc_id").combine_chunks(), table.column("held_out").to_numpy()
        bounds, codes, distinct = split_words(table.column("text").combine_chunks(), lower=True)
        names = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()] + [xxhash.xxh64_intdigest(b"")], np.uint64)
        self.sizes = np.diff(bounds) + 1
        self.ends = np.cumsum(self.sizes) - 1  # the last token of a document is its end, which also stands for what precedes the first
        self.starts = self.ends - self.sizes + 1
        word = np.empty(int(self.sizes.sum()), np.uint64)
        word[self.ends] = names[-1]
        inside = np.ones(len(word), bool)
        inside[self.ends] = False
        word[inside] = names[codes]
        self.kinds, gram = [], np.zeros(len(word), np.uint64)
        for k in range(1, order + 1):
            before = np.concatenate((np.zeros(1, np.uint64), gram[:-1]))[: len(word)]
            before[self.starts] = np.uint64(k)  # no other history looks like the one before a document
            gram = _mix(word + np.uint64(1)) if k == 1 else _mix(_mix(before + np.uint64(k)) + word)
            hashes, place = np.unique(gram, return_inverse=True)
            self.kinds.append((hashes, place.astype(np.int32)))

    def trained(self, kind: int) -> np.ndarray:
        """How often each n-gram occurs in training documents."""
        hashes, place = self.kinds[kind]
        return np.bincount(place, np.repeat(~self.held, self.sizes), len(hashes)).astype(np.int64)

    def estimates(self, counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Each token's count and the count of its history, from order 1 up; order 1 has no history."""
        own = [c[place] for c, (_, place) in zip(counts, self.kinds)]
        histories = []
        for lower in own[:-1]:
            before = np.concatenate(([0], lower[:-1]))[: len(lower)]
            before[self.starts] = own[0][self.ends]  # as many documents begin as end
            histories.append(before)
        return own, histories


def _range_cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    at = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64))


def _ask(ranges: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, deleted, data in zip(*(c.to_pylist() for c in batch.columns)):
                block = Block(data, order)
                for kind, (hashes, _) in enumerate(block.kinds):
                    trained, cuts = block.trained(kind), _range_cuts(hashes, ranges).tolist()
                    rows = [(s, number, kind, deleted, pack_sorted(hashes[a:b]), pack_ints(trained[a:b])) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                    types = (pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["range", "block", "kind", "deleted", "hashes", "trained"])

    return run


_ANSWER = "block long, range int, kind int, counts binary, kept binary, n_all long, v_all long, n_kept long, v_kept long"


def _answer(table: pa.Table) -> pa.Table:
    """Totals of a range, for each block in the order in which it asked; without the deleted documents too for their blocks."""
    rows, number = [], table.column("range")[0].as_py()
    kinds, gone = table.column("kind").to_numpy(), table.column("deleted").to_pylist()
    for kind in np.unique(kinds).tolist():
        at = np.flatnonzero(kinds == kind).tolist()
        asked = [unpack_sorted(table.column("hashes")[i].as_py()) for i in at]
        trained = [unpack_ints(table.column("trained")[i].as_py()).astype(np.int64) for i in at]
        every, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, np.concatenate(trained), len(every)).astype(np.int64)
        minus = np.concatenate([t * gone[i] for t, i in zip(trained, at)])
        kept = total - np.bincount(place, minus, len(every)).astype(np.int64)
        start = 0
        for i, hashes in zip(at, asked):
            own = place[start : start + len(hashes)]
            start += len(hashes)
            rows.append((table.column("block")[i].as_py(), number, kind, pack_ints(total[own]), pack_ints(kept[own]) if gone[i] else b"", 0, 0, 0, 0))
        if kind == 0:
            rows.append((-1, number, kind, b"", b"", int(total.sum()), int(np.count_nonzero(total)), int(kept.sum()), int(np.count_nonzero(kept))))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in _ANSWER.split(", ")])


def _answers(block: Block, table: pa.Table, column: str) -> list[np.ndarray]:
    """The answered counts of a block's n-grams, order by order."""
    kinds, ranges, out = table.column("kind").to_numpy(), table.column("range").to_numpy(), []
    for kind, (hashes, _) in enumerate(block.kinds):
        at = np.flatnonzero(kinds == kind)
        at = at[np.argsort(ranges[at])].tolist()
        out.append(np.concatenate([np.empty(0, np.int64)] + [unpack_ints(table.column(column)[i].as_py()).astype(np.int64) for i in at]))
        if len(out[-1]) != len(hashes):
            raise RuntimeError("a block has other n-grams than when it asked")
    return out


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for a history not seen, else one for each power of two."""
    return np.where(count > 0, np.frexp(np.maximum(count, 1).astype(np.float64))[1], 0).astype(np.int64)


def mixed(own: list[np.ndarray], histories: list[np.ndarray], weights: np.ndarray, n: int, v: int) -> np.ndarray:
    """Each token's probability; ``weights``: of an order's own estimate, by (order - 1, bucket)."""
    p = np.full(len(own[0]), 1 / (v + 1))
    if n:
        p = weights[0, 0] * own[0] / n + (1 - weights[0, 0]) * p
        for k, (count, history) in enumerate(zip(own[1:], histories), 1):
            w = weights[k, bucket(history)]
            p = w * count / np.maximum(history, 1) + (1 - w) * p
    return p


def _deleted_tokens(order: int):
    """How many held-out tokens have which counts, the token's and its history's at each order."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for data in left.column("docs"):
            block = Block(data.as_py(), order)
            own, histories = block.estimates(_answers(block, right, "kept"))
            found.append(np.stack((*own, *histories), axis=1))
        rows, times = np.unique(np.concatenate(found), axis=0, return_counts=True) if found else (np.empty((0, 2 * order - 1), np.int64), np.empty(0, np.int64))
        return pa.table([pa.array(c) for c in rows.T] + [pa.array(times)], [*(f"c{k}" for k in range(order)), *(f"h{k}" for k in range(1, order)), "n"])

    return run


def fit_weights(tokens: DataFrame, order: int, n: int, v: int) -> np.ndarray:
    """Weights by (order - 1, bucket) from ``tokens(c0.., h1.., n)``, by EM; every round is one aggregate over equal counts.

    A token is made by the estimate of its longest history with that history's weight, or else
    handed down to the next shorter one. Histories that were never seen hand everything down; a
    bucket without tokens takes its nearest neighbour's weight.
    """
    weights = np.full((order, BUCKETS), 0.5)
    seen: list[set[int]] = [set() for _ in range(order)]
    counts = [f"{c}{k}" for c in "ch" for k in range(order) if c == "c" or k]
    rows = materialise(tokens.groupBy(counts).agg(F.sum("n").alias("n")), "tokens")

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many tokens reach each order's bucket, and how many are made there, under the weights so far."""
        made, reached = np.zeros((2, order * BUCKETS))
        for batch in batches:
            own = [batch.column(k).to_numpy() for k in range(order)]
            histories = [batch.column(order + k).to_numpy() for k in range(order - 1)]
            at, share, p = [], [], [np.full(batch.num_rows, 1 / (v + 1))]
            for k in range(order):
                history = histories[k - 1] if k else np.full(batch.num_rows, n)
                at.append(k * BUCKETS + (bucket(history) if k else 0))
                w = weights.ravel()[at[k]]
                share.append(w * own[k] / np.maximum(history, 1))
                p.append(share[k] + (1 - w) * p[-1])
            reach = batch.column(2 * order - 1).to_numpy().astype(np.float64)
            for k in reversed(range(order)):
                here = reach * share[k] / p[k + 1]
                for total, x in ((made, here), (reached, reach)):
                    total += np.bincount(at[k] + np.zeros(len(x), np.int64), x, order * BUCKETS)
                reach = reach - here
        some = np.flatnonzero(reached)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(made[some]), pa.array(reached[some])], ["at", "made", "reached"])

    weights[1:, 0] = 0.0
    for _ in range(ROUNDS):
        # A new closure a round carries the weights, so that Spark has no expression to compile anew.
        sums = map_rows(rows, "at long, made double, reached double", expect).groupBy("at").agg(F.sum("made"), F.sum("reached")).collect()  # order * BUCKETS rows
        last = weights.copy()
        for at, made, reached in sums:
            k, b = divmod(at, BUCKETS)
            if k == 0 or b:
                weights[k, b] = (made + 0.5) / (reached + 1)  # one token spread evenly keeps both ways open
                seen[k].add(b)
        if np.abs(weights - last).max() < TOLERANCE:
            break
    for k in range(order):
        known = np.array(sorted(seen[k]))
        for b in range(1 if k else 0, BUCKETS):
            if len(known) and b not in seen[k]:
                weights[k, b] = weights[k, known[np.abs(known - b).argmin()]]
    return weights.round(9)  # so that the order of sums doesn't show


def _score(n: int, v: int, weights: np.ndarray, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for data in left.column("docs"):
            block = Block(data.as_py(), order)
            own, histories = block.estimates(_answers(block, right, "counts"))
            add = lambda x: np.add.reduceat(x, block.starts)  # noqa: E731, B023
            p = mixed(own, histories, weights, n, v)
            out.append(pa.table({
                "doc_id": block.ids, "held_out": pa.array(block.held, pa.bool_()), "n_tokens": block.sizes,
                "n_known": add((own[0] > 0).astype(np.int64)), "train_tokens": np.full(len(block.sizes), n, np.int64),
                "base_score": add(np.log10((own[0] + 0.5) / (n + 0.5 * (v + 1)))), "score": add(np.log10(p)),
            }))
        return pa.concat_tables(out)

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per document.

    Documents with crc32(doc_id as text) mod 5 = 1 are held out: scored, never learnt from; a null
    doc_id counts as the empty text. A null or empty text has the end token alone. Repeated rows
    repeat, and count as often. Without training documents the score is that of the uniform share.
    An empty table gives no rows; extra columns are ignored. Log10 probabilities.
    """
    blocks = materialise(cut_blocks(docs, id_col, text_col), "blocks")
    ranges = max(partitions(docs.sparkSession), blocks.count())
    asked = map_rows(blocks, "range int, block long, kind int, deleted boolean, hashes binary, trained binary", _ask(ranges, order))
    answers = materialise(asked.repartition(ranges, "range").groupBy("range").applyInArrow(_answer, _ANSWER), "answers")
    n, v, n_kept, v_kept = (int(x) for x in answers.where("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_all", "v_all", "n_kept", "v_kept")]).first())
    by_block = lambda df: df.repartition(ranges, "block").groupBy("block")
    kept = answers.where("length(kept) > 0").select("block", "range", "kind", "kept")
    schema = ", ".join([*(f"c{k} long" for k in range(order)), *(f"h{k} long" for k in range(1, order)), "n long"])
    tokens = by_block(blocks.where("deleted").select("block", "docs")).cogroup(by_block(kept)).applyInArrow(_deleted_tokens(order), schema)
    weights = fit_weights(tokens, order, n_kept, v_kept)
    every = answers.where("block >= 0").select("block", "range", "kind", "counts")
    return by_block(blocks.select("block", "docs")).cogroup(by_block(every)).applyInArrow(
        _score(n, v, weights, order), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
