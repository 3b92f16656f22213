"""Fast whole-text encoding with a public ``tokenizers`` vocabulary that drops white space."""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .common import Memory, split_words

#: Distinct words, and distinct pieces of them, that a worker remembers.
CACHE_WORDS, CACHE_PIECES = 800_000, 400_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of whole texts, the same as ``Tokenizer.encode`` gives.

    White space separates words and is dropped, so a text's ids are those of its words in turn;
    each distinct word is encoded once while it is remembered. This holds for the pipeline "NFC,
    white space to one blank, lower case; split by a pattern, the rest removed; byte level"; for
    any other the whole text goes through ``encode``.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cache = Memory(CACHE_WORDS)
        self.pieces = Memory(CACHE_PIECES)
        self.letters = _byte_letters()
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["invert"]
            and cuts[0]["behavior"] == "Removed"
            and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"]
            and not any(set(s) & set(" \t\n\r\x0b\x0c") for s in self.special)
        )
        if self.by_word:
            self.pattern = regex.compile(cuts[0]["pattern"]["Regex"])

    def _word(self, text: str) -> bytes:
        if any(s in text for s in self.special) or not text.isascii():
            if self._odd(text):
                return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            text = unicodedata.normalize("NFC", text)
        return self._split(text)

    def _odd(self, text: str) -> bool:
        """Whether case or composition could differ between this library's Unicode tables and Python's."""
        return any(s in text for s in self.special) or not all(ord(c) < 0x180 for c in text)

    def _split(self, text: str) -> bytes:
        out = []
        for piece in self.pattern.findall(text.lower()):
            if not self.pieces.has(piece):
                shown = "".join(map(self.letters.__getitem__, piece.encode()))
                self.pieces.make_room()
                self.pieces[piece] = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
            out.append(self.pieces[piece])
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[1].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each text start (and the end of the last), and the ids of all texts.

        Each distinct word of the texts is looked up once; the rest is array work.
        """
        if not self.by_word:
            ids = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4") if t else np.empty(0, "<u4") for t in texts.to_pylist()]
            return np.cumsum([0, *map(len, ids)]), np.concatenate([np.empty(0, "<u4"), *ids])
        bounds, codes, distinct = split_words(texts)
        self.cache.make_room()
        words, cache, own = distinct.to_pylist(), self.cache, self._word
        found = []
        for word in words:
            if not cache.has(word):
                cache[word] = own(word)
            found.append(cache[word])
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        return ends[bounds], flat[np.repeat(starts[codes] - ends[:-1], n) + np.arange(ends[-1])]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process, with what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
