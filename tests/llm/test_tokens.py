import base64
import functools
import hashlib
import random
import string
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import DOCS, odd_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkreel.llm import bpe, packing, sstable
from sparkreel.llm.common import new_path
from sparkreel.llm.wordpieces import WordEncoder

WORDS, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "a  b", "a   b c", "<|endoftext|>a b", "It's DON'T İstanbul Straße é ﬁ 日本語 ΑΣ Σ", "a b\x1cc\x85d", "1234 a1b2 ''s", "😀 x﻿y", "x\n  y\n\n z \n", "a \n b", " a", "a ", "a  ", "abc" * 900]


@functools.cache
def tokenizer():
    return Tokenizer.from_file(WORDS)


def plain_ids(text):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids, "<u4")


def library():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_word_encoder_equals_library(spark):
    enc, plain = WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ODD + [r["text"] for r in documents(spark).select("text").collect()]
    assert enc.by_word
    for text in texts:
        assert enc.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_shard_lookup_and_scan(tmp_path):
    rng = np.random.default_rng(0)
    docs = [(None, np.array([5], "<u4"))] + [(int(i), rng.integers(0, 49408, rng.integers(0, 300)).astype("<u4")) for i in np.unique(np.append(rng.integers(-(2**63), 2**63 - 1, 3000), [-1, 0, 1]))]
    path = tmp_path / "a.sst"
    with open(path, "wb") as out:
        writer = sstable.ShardWriter(out, 2)
        for doc_id, ids in docs:
            writer.add(doc_id, ids.astype("<u2").tobytes())
        writer.finish()
    shard = sstable.Shard(str(path))
    assert len(shard.blocks) > 5 and shard.entries == len(docs)
    start = 0
    for (doc_id, ids), (got, at, read) in zip(docs, shard.scan(), strict=True):
        assert got == doc_id and at == start and (read == ids).all()
        start += len(ids)
    for doc_id, ids in docs[::50]:
        assert (shard.get(doc_id) == ids).all()
    missing = [i for i in range(2, 3000)]
    assert all(shard.get(i) is None for i in missing[:100]) and sum(map(shard.may_hold, missing)) < 0.03 * len(missing)
    path.write_bytes(path.read_bytes()[:-1] + b"x")
    with pytest.raises(ValueError, match="no token shard"):
        sstable.Shard(str(path))


@pytest.mark.parametrize("shard_bytes", [1 << 28, 1000])
def test_token_table(spark, shard_bytes):
    docs = documents(spark)
    manifest = sstable.write_shards(docs, WORDS, new_path(spark, "t"), shard_bytes=shard_bytes)
    got = sorted(map(tuple, sstable.read_shards(manifest).collect()))
    start, want = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = np.append(plain_ids(r["text"]), 2).astype("<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want and (manifest.count() > 10) == (shard_bytes == 1000)
    asked = [5, 7, 7, 10**9, -3, None, *range(100, 140)]
    found = {r["doc_id"]: r["ids"] for r in sstable.lookup(manifest, spark.createDataFrame([(i,) for i in asked], "doc_id long")).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found == {i: np.append(plain_ids(texts[i]), 2).astype("<u4").tobytes() for i in asked if i in texts}


@pytest.mark.parametrize("shard_bytes", [1 << 28, 100])
def test_lookup_finds_all_rows_of_an_id(spark, shard_bytes):
    odd = odd_documents(spark)
    manifest = sstable.write_shards(odd, WORDS, new_path(spark, "t"), shard_bytes=shard_bytes)
    found = [r["doc_id"] for r in sstable.lookup(manifest, odd.select("doc_id").union(spark.createDataFrame([(99,)], "doc_id long"))).collect()]
    assert sorted(map(str, found)) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert sstable.lookup(sstable.write_shards(odd.limit(0), WORDS, new_path(spark, "t")), odd).count() == 0


def test_token_table_odd_rows(spark):
    rows = sorted(map(tuple, sstable.token_table(odd_documents(spark), WORDS).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, 1, 2, 3, 4, 4, 5, 6] and sum(r[2] == 1 for r in rows) == 4
    assert [r[1] for r in rows] == list(np.cumsum([0] + [r[2] for r in rows])[:-1])
    assert sstable.token_table(spark.createDataFrame([], DOCS), WORDS).count() == 0


def test_best_fit_equals_one_at_a_time():
    rng = np.random.default_rng(2)
    for cap in (10, 64):
        lengths = rng.integers(1, cap + 1, 400)
        room, bins = [], 0
        for n in sorted(lengths, reverse=True):
            fits = [(r, i) for i, r in enumerate(room) if r >= n]
            if fits:
                room[min(fits)[1]] -= n
            else:
                room.append(cap - n)
        places = packing.best_fit_decreasing({int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}, cap)
        bins = max(b + n for _, _, n, b, _ in places)
        assert bins == len(room)
        assert sorted(cap - sum(l for l, _, n, b, _ in places if b <= i < b + n) for i in range(bins)) == sorted(room)
    assert packing.best_fit_decreasing({}) == []


def check_packing(rows, docs, cap):
    ids = {d: np.append(plain_ids(t), 0).astype("<u4") for d, t in docs}
    by_sequence, seen = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= cap
    for d, parts in seen.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(-(-len(ids[d]) // cap))) and all(p[2] == cap for p in parts[:-1])
    return by_sequence


def test_packing(spark):
    docs = documents(spark)
    rows = packing.pack(docs, WORDS).collect()
    sequences = check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 2048) + 1
    packed = packing.packed_sequences(docs, WORDS)
    assert packed.count() == len(sequences) and packed.agg(F.sum(F.length("ids"))).first()[0] == 4 * sum(r["length"] for r in rows)


def test_packing_odd_rows(spark):
    rows = packing.pack(odd_documents(spark), WORDS, 512).collect()
    assert sum(r["doc_id"] is None for r in rows) == 2 and sum(r["length"] == 1 for r in rows) >= 4
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert len(places) == len(set(places)) and sum(r["doc_id"] == 4 for r in rows) % 2 == 0
    assert packing.pack(spark.createDataFrame([], DOCS), WORDS).count() == 0


def test_bpe_equals_library(spark):
    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    texts = ODD + ["<|endoftext|>", "ab" * 4000] + [r["text"] for r in documents(spark).select("text").collect()]
    ids = coder.encode(texts)
    assert ids == [np.array(plain.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert coder.decode(ids) == [t.encode() for t in texts]


@pytest.mark.parametrize("pattern", [r"\S+ ?|\s+", r"\p{L}+|[^\p{L}]+", r"(?s).{1,7}"])
def test_bpe_under_other_patterns(pattern):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(ranks), special_tokens={})
    texts = ["", "the cat sat on the mat", " a  b   c ", "don't stop\n\n now 12 345 é 日本", "x" * 40 + " y"]
    got = bpe.DuckBpe(ranks, pattern).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain.encode_ordinary(t) for t in texts]


def test_bpe_forgets_and_still_encodes(monkeypatch):
    want = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN).encode(ODD)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHE_PARTS", 8)
    monkeypatch.setattr(bpe, "DECODE_IDS", 7)
    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    assert [coder.encode([t])[0] for t in ODD * 2] == want * 2 and coder.decode(want) == [t.encode() for t in ODD]


@pytest.mark.parametrize("make", [
    lambda r, n: "".join(r.choices(string.ascii_letters, k=n)), lambda r, n: "a" * n, lambda r, n: "".join(r.choices("ab", k=n)),
    lambda r, n: "".join(chr(r.randrange(0x20, 0x3000)) for _ in range(n // 4)), lambda r, n: "".join(r.choices("etaoinshr", k=n // 4)),
])
def test_bpe_ends_on_a_long_piece(make):
    """A million letters, or as many bytes, without a break, within a minute."""
    text = make(random.Random(1), 1_000_000)
    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    began = time.time()
    ids = coder.encode([text])[0]
    assert coder.decode([ids]) == [text.encode()] and time.time() - began < 60
    if set(text) != {"a"}:  # the library takes quadratic time there
        assert np.frombuffer(ids, "<u4").tolist() == library().encode_ordinary(text)


def test_bpe_with_ranks_in_any_order(tmp_path, monkeypatch):
    """Vocabularies in which a pair can rank below its parts, against merging one pair at a time."""
    def slow(ranks, raw):
        parts = [bytes([b]) for b in raw]
        while raw not in ranks:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[raw]]

    rnd = random.Random(5)
    for trial in range(6):
        monkeypatch.setattr(bpe, "CUT_BYTES", 64 if trial % 2 else 4)
        tokens = [b"a", b"b", b"c"]
        while len(set(tokens)) < 40:
            tokens.append(rnd.choice(tokens) + rnd.choice(tokens))
        long = sorted(set(tokens) - {b"a", b"b", b"c"})
        rnd.shuffle(long)
        ranks = {t: i for i, t in enumerate([bytes([b]) for b in range(256)] + long)}
        path = tmp_path / f"{trial}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
        texts = ["".join(rnd.choices("abc", k=rnd.choice((3, 10, 50, 200)))) for _ in range(40)]
        got = bpe.DuckBpe(str(path), r"\S+|\s+").encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [slow(ranks, t.encode()) for t in texts]


def test_bpe_rows(spark):
    rows = bpe.round_trip(odd_documents(spark), RANKS, public_tokenizers.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 9 and sum(r["n_tokens"] == 0 and r["ids_sha256"] == r["decoded_sha256"] == empty for r in rows) == 3
    texts = {r["doc_id"]: r["text"] for r in odd_documents(spark).collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() for r in rows if r["doc_id"])
    assert bpe.round_trip(spark.createDataFrame([], DOCS), RANKS, public_tokenizers.PATTERN).count() == 0
    decoded = bpe.decode_documents(bpe.encode_documents(documents(spark), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["text"]).decode() for r in decoded.collect()} == {r["doc_id"]: r["text"] for r in documents(spark).collect()}
