"""Byte-level BPE by DuckDB queries inside each Spark partition.

Texts are cut by the vocabulary's pattern; the distinct pieces of a batch that are not remembered
yet go through one recursive query: rows (piece, position, token) join the merge table, and each
piece contracts its pairs of least rank from the left, until no pair is left. Decoding joins the ids
with the vocabulary and concatenates the bytes by an ordered aggregate.

Two things keep very long pieces (a run of letters without a break) within bounds, with the same ids:

* A piece is cut where no entry of the vocabulary that occurs there reaches across: nothing can ever
  merge over such a place.
* A step contracts all occurrences of the least rank that don't overlap, not one, so the number of
  steps is that of the ranks met. If a contraction makes a pair of still lower rank, that one comes
  next, so the step ends with it.

Only one row a symbol is kept (``USING KEY``), and pieces that are done leave the recursion.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import tempfile
from collections.abc import Iterator

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, map_rows

#: Distinct pieces, and distinct parts between blanks, that a worker remembers.
CACHE_PIECES, CACHE_PARTS = 600_000, 600_000
#: Characters of text handled by one pair of queries.
BATCH_CHARS = 2 << 20
#: Symbols in one recursive query (a longer piece that can't be cut is alone), and ids in one decoding query.
ENCODE_SYMBOLS, DECODE_IDS = 1 << 18, 1 << 18
#: Pieces longer than this many bytes are cut where no token reaches across; longer ones aren't remembered.
CUT_BYTES = 64

#: Steps of the recursion. A row is a symbol: its piece, position and token, -1 once it is
#: gone; a piece without a pair has no rows in the next step. ``step`` makes every row of a step a new one. ``mark`` numbers the occurrences in an unbroken run of them: every
#: other one is contracted, from the left. ``early`` holds the pairs of lower rank than a part of theirs.
_CONTRACT = """
WITH RECURSIVE state(piece, pos, token, step) USING KEY (piece, pos) AS (
  SELECT piece, pos, token, 0 FROM symbols
  UNION
  SELECT piece, pos, token, step FROM (
    WITH live AS (
      SELECT piece, pos, token, step, lead(token) OVER next AS right_token, row_number() OVER next AS place
      FROM state WHERE token >= 0 WINDOW next AS (PARTITION BY piece ORDER BY pos)
    ), paired AS (
      SELECT piece, pos, place, rank FROM live JOIN merges ON token = left_id AND right_token = right_id
    ), least AS (
      SELECT piece, min(rank) AS least FROM paired GROUP BY piece
    ), hit AS (
      SELECT piece, pos, place, least, place - row_number() OVER (PARTITION BY piece ORDER BY pos) AS run
      FROM paired JOIN least USING (piece) WHERE rank = least
    ), chosen AS (
      SELECT piece, pos, place, least FROM (SELECT *, row_number() OVER (PARTITION BY piece, run ORDER BY pos) AS mark FROM hit) WHERE mark % 2 = 1
    ), around AS (
      SELECT c.piece, c.pos, c.least, r.token AS right_token, coalesce(p.least, l.token) AS left_token
      FROM chosen c LEFT JOIN live r ON r.piece = c.piece AND r.place = c.place + 2
      LEFT JOIN live l ON l.piece = c.piece AND l.place = c.place - 1
      LEFT JOIN chosen p ON p.piece = c.piece AND p.place = c.place - 2
      WHERE c.least IN (FROM early_parts)
    ), stop AS (
      SELECT piece, min(pos) AS stop FROM around JOIN early ON (left_id = least AND right_id = right_token OR left_id = left_token AND right_id = least)
      WHERE rank < least GROUP BY piece
    ), done AS (
      SELECT piece, pos, place, least FROM chosen LEFT JOIN stop USING (piece) WHERE stop IS NULL OR pos <= stop
    )
    SELECT live.piece, live.pos, CASE WHEN d.least IS NOT NULL THEN d.least WHEN g.least IS NOT NULL THEN -1 ELSE live.token END AS token, step + 1 AS step
    FROM live SEMI JOIN least USING (piece)
    LEFT JOIN done d ON d.piece = live.piece AND d.place = live.place
    LEFT JOIN done g ON g.piece = live.piece AND g.place = live.place - 1
  )
)
SELECT piece, list(token ORDER BY pos) AS ids FROM state WHERE token >= 0 GROUP BY piece
"""
#: The same for short pieces, where one contraction a step takes less time.
_CONTRACT_SHORT = """
WITH RECURSIVE state(piece, pos, token, step) USING KEY (piece, pos) AS (
  SELECT piece, pos, token, 0 FROM symbols
  UNION
  SELECT piece, pos, token, step FROM (
    WITH live AS (
      SELECT piece, pos, token, step, lead(token) OVER next AS right_token, lead(pos) OVER next AS right_pos
      FROM state WHERE token >= 0 WINDOW next AS (PARTITION BY piece ORDER BY pos)
    ), least AS (
      SELECT piece, min(rank * 4294967296 + pos) AS first, arg_min(right_pos, rank * 4294967296 + pos) AS gone
      FROM live JOIN merges ON token = left_id AND right_token = right_id GROUP BY piece
    )
    SELECT live.piece, live.pos, CASE WHEN live.pos = first % 4294967296 THEN first // 4294967296 WHEN live.pos = gone THEN -1 ELSE token END AS token, step + 1 AS step
    FROM live JOIN least USING (piece)
  )
)
SELECT piece, list(token ORDER BY pos) AS ids FROM state WHERE token >= 0 GROUP BY piece
"""
_DECODE = """
SELECT doc, string_agg(shown, '' ORDER BY pos) AS shown FROM ids JOIN vocabulary USING (token) GROUP BY doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class DuckBpe:
    """Encoder and decoder of one vocabulary, on an in-memory DuckDB connection with one thread."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = load_ranks(path), regex.compile(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"duckdb-{os.getpid()}")})
        self.cache, self.first, self.after = Memory(CACHE_PIECES), Memory(CACHE_PARTS // 8), Memory(CACHE_PARTS)
        # A blank with white space before it and white space or nothing after it.
        self.blanks = re.compile(r"\s (?:\s|\Z)")
        self.cuts_at_blanks = pattern == PATTERN  # shown for this pattern alone
        token = pa.array(list(self.ranks.values()), pa.int64())
        self.db.register("_v", pa.table({"token": token, "shown": [b.hex() for b in self.ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM _v")
        merges = [(self.ranks[b[:i]], self.ranks[b[i:]], r) for b, r in self.ranks.items() for i in range(1, len(b)) if b[:i] in self.ranks and b[i:] in self.ranks]
        left, right, rank = zip(*merges) if merges else ((), (), ())
        self.db.register("_m", pa.table({"left_id": pa.array(left, pa.int64()), "right_id": pa.array(right, pa.int64()), "rank": pa.array(rank, pa.int64())}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM _m")
        self.db.execute("CREATE TABLE early AS SELECT * FROM merges WHERE rank < greatest(left_id, right_id)")
        self.db.execute("CREATE TABLE early_parts AS SELECT left_id AS token FROM early WHERE rank < left_id UNION SELECT right_id FROM early WHERE rank < right_id")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.tokens = ahocorasick.Automaton()
        for b in self.ranks:
            if len(b) > 1:
                self.tokens.add_word(b.decode("latin-1"), len(b))
        if len(self.tokens):
            self.tokens.make_automaton()

    def _cuts(self, raw: bytes) -> list[bytes]:
        """``raw`` cut where no token that occurs in it reaches across."""
        crossed = np.zeros(len(raw) + 1, np.int64)  # the steps of how many tokens cover a boundary
        if len(self.tokens):
            found = list(self.tokens.iter(raw.decode("latin-1")))
            end, size = (np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
            np.add.at(crossed, end - size + 2, 1)
            np.add.at(crossed, end + 1, -1)
        free = (np.flatnonzero(np.cumsum(crossed[1:-1]) == 0) + 1).tolist()
        return [raw[a:b] for a, b in zip([0, *free], [*free, len(raw)])]

    def _contract(self, raw: list[bytes]) -> list[bytes]:
        """Ids of byte strings, in queries of about ``ENCODE_SYMBOLS`` rows."""
        out, at = [b""] * len(raw), 0
        while at < len(raw):
            size, end = 0, at
            while end < len(raw) and (size == 0 or size + len(raw[end]) <= ENCODE_SYMBOLS):
                size += len(raw[end])
                end += 1
            part = raw[at:end]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            token = self.byte_ids[np.frombuffer(b"".join(part), np.uint8)]
            pos = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            self.db.register("symbols", pa.table({"piece": np.repeat(np.arange(len(part)), lengths), "pos": pos, "token": token}))
            found = self.db.sql(_CONTRACT_SHORT if lengths[-1] <= CUT_BYTES else _CONTRACT).to_arrow_table()
            self.db.unregister("symbols")
            ids = found.column("ids").combine_chunks()
            flat, bounds = ids.flatten().to_numpy().astype("<u4").tobytes(), ids.offsets.to_numpy() * 4
            for i, a, b in zip(found.column("piece").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                out[at + i] = flat[a:b]
            at = end
        return out

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Encode distinct pieces into the cache, but for the long ones, which are returned.

        A piece that is a token itself needs no merges; equal parts are contracted once.
        """
        open_, long = {}, {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is None:
                open_[piece] = [raw] if len(raw) <= CUT_BYTES else self._cuts(raw)
            else:
                self.cache[piece] = rank.to_bytes(4, "little")
        parts = {r for raws in open_.values() for r in raws}
        ids = {r: self.ranks[r].to_bytes(4, "little") for r in parts if len(r) == 1}
        parts = sorted(parts - ids.keys(), key=len)  # like lengths in one query, as they take like numbers of steps
        ids.update(zip(parts, self._contract(parts)))
        for piece, raws in open_.items():
            (self.cache if len(piece) <= CUT_BYTES else long)[piece] = b"".join(map(ids.__getitem__, raws))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as 32-bit little-endian bytes.

        The pattern never matches across a blank that follows a non-blank or precedes one, but lets
        the blank lead what follows; so a text is cut at its blanks and each distinct part is cut by
        the pattern once. Texts with longer runs of white space, and all texts under another pattern
        than ``public_tokenizers.PATTERN``, are cut by the pattern as a whole.
        """
        for memory in (self.cache, self.first, self.after):
            memory.make_room()
        split, whole, first, after = [], {}, set(), set()
        for text in texts:
            if not self.cuts_at_blanks or self.blanks.search(text):
                whole[len(split)] = self.pattern.findall(text)
                split.append([])
                continue
            parts = text.split(" ")
            split.append(parts)
            known = self.first
            if parts[0] not in known:
                first.add(parts[0])
            known = self.after
            after.update([p for p in set(parts[1:]) if p not in known])
        cuts_first = {p: self.pattern.findall(p) for p in first if not self.first.has(p)}
        cuts_after = {p: self.pattern.findall(" " + p) for p in after if not self.after.has(p)}
        used = {x for cuts in (cuts_first, cuts_after, whole) for pieces in cuts.values() for x in pieces}
        long = self._learn([x for x in used if not self.cache.has(x)])
        get = (lambda x: long[x] if x in long else self.cache[x]) if long else self.cache.__getitem__
        # What holds a long piece serves this batch alone.
        first = {p: b"".join(map(get, pieces)) for p, pieces in cuts_first.items()}
        after = {p: b"".join(map(get, pieces)) for p, pieces in cuts_after.items()}
        for memory, new in ((self.first, first), (self.after, after)):
            memory.update((p, ids) for p, ids in new.items() if len(p) <= CUT_BYTES)
        start = lambda p: first[p] if p in first else self.first[p]
        known = {p: after[p] for p in after if len(p) > CUT_BYTES}
        rest = (lambda p: known[p] if p in known else self.after[p]) if known else self.after.__getitem__
        out = []
        for i, parts in enumerate(split):
            if i in whole:
                out.append(b"".join(map(get, whole[i])))
            else:
                out.append(start(parts[0]) + b"".join(map(rest, parts[1:])))
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence, whatever its length: long ones in parts of ``DECODE_IDS``."""
        parts: list[list[bytes]] = [[] for _ in ids]
        batch: list[tuple[int, np.ndarray]] = []
        size = 0

        def run() -> None:
            nonlocal size, batch
            if batch:
                lengths = np.array([len(x) for _, x in batch])
                token = np.concatenate([x for _, x in batch]).astype(np.int64)
                self.db.register("ids", pa.table({"doc": np.repeat(np.arange(len(batch), dtype=np.int32), lengths), "pos": np.arange(len(token), dtype=np.int32), "token": token}))
                got = self.db.sql(_DECODE).to_arrow_table()
                self.db.unregister("ids")
                shown = dict(zip(got.column("doc").to_pylist(), got.column("shown").to_pylist()))
                for i, (at, _) in enumerate(batch):
                    parts[at].append(bytes.fromhex(shown[i]))
            size, batch = 0, []

        for at, data in enumerate(ids):
            row = np.frombuffer(data, "<u4")
            while len(row):
                take = row[: DECODE_IDS - size]
                batch.append((at, take))
                row, size = row[len(take) :], size + len(take)
                if size >= DECODE_IDS:
                    run()
        run()
        return [b"".join(p) for p in parts]


_CODERS: dict[tuple[str, str], DuckBpe] = {}


def coder(path: str, pattern: str) -> DuckBpe:
    """One coder a worker process, with its connection and what it remembers."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = DuckBpe(path, pattern)
    return _CODERS[path, pattern]


def _batches(flow: Iterator[tuple[int | None, str]]) -> Iterator[list[tuple[int | None, str]]]:
    rows, size = [], 0
    for row in flow:
        rows.append(row)
        size += len(row[1])
        if size >= BATCH_CHARS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: ids as 32-bit little-endian bytes; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for rows in _batches((d.as_py(), t.as_py() or "") for b in batches for d, t in zip(b.column(0), b.column(1))):
            ids = bpe.encode([r[1] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id long, ids binary", run)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(doc_id, ids, text)`` with text as bytes, since ids may end inside a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = bpe.decode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "text"])

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, ids binary, text binary", run)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per document.

    Null and empty texts have no ids. A null doc_id keeps its row, repeated rows repeat, an empty
    table gives no rows, and other columns are ignored. Encoding and decoding share one worker, so
    a task holds one connection and one batch of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = coder(ranks, pattern), lambda b: hashlib.sha256(b).hexdigest()
        for rows in _batches((d.as_py(), t.as_py() or "") for b in batches for d, t in zip(b.column(0), b.column(1))):
            ids = bpe.encode([r[1] for r in rows])
            back = [sha(x) for x in bpe.decode(ids)]
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
