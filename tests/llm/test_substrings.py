"""Operator 12: suffix order by induced sorting, and removal of repeated strings."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest
from helpers import odd_documents

from sparkreel.llm import induced, queries, substrings

SF = "/root/testdata/sf0.001"


def plain_removal(rows, window=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[p : p + window] for _, d in texts for p in range(len(d) - window + 1))
    out = []
    for i, d in texts:
        gone = [False] * len(d)
        for p in range(len(d) - window + 1):
            if seen[d[p : p + window]] > 1:
                gone[p : p + window] = [True] * window
        edges = [k for k in range(len(d) + 1) if (gone[k] if k < len(d) else False) != (gone[k - 1] if k else False)]
        out.append((i, len(d), list(zip(edges[::2], edges[1::2])), bytes(x for x, g in zip(d, gone) if not g)))
    return out


def random_bytes(rng):
    n, kinds = rng.randint(1, 90), rng.choice([1, 2, 3, 256])
    b = bytes(rng.randrange(kinds) for _ in range(n))
    return (b[: rng.randint(1, 9)] * 90)[:n] if rng.random() < 0.4 else b


@pytest.mark.parametrize("memory,limit", [(1 << 22, 1 << 30), (2, 1 << 30), (2, 64)])
def test_suffix_order_equals_sorting(tmp_path, memory, limit):
    rng = random.Random(11)
    for _ in range(250):
        b = random_bytes(rng)
        order = sorted(range(len(b)), key=lambda i: b[i:])
        shared = [0] + [len(os.path.commonprefix([b[x:], b[y:]])) for x, y in zip(order, order[1:])]
        blocks = list(induced.suffix_order(np.frombuffer(b, np.uint8), 256, str(tmp_path), 400, memory, limit))
        assert np.concatenate([x for x, _ in blocks]).tolist() == order
        assert np.concatenate([x for _, x in blocks]).tolist() == shared
    assert not os.listdir(tmp_path)


def test_stretches_where_one_begins_another():
    rng = random.Random(4)
    for _ in range(3000):
        s = np.array([rng.randrange(3) for _ in range(rng.randint(4, 60))])
        seeds = np.flatnonzero((t := induced.suffix_types(s)[0])[1:] & ~t[:-1]) + 1
        ends = [*(seeds[1:] + 1).tolist(), None]
        for kinds in (3, 1 << 20, 1 << 31):  # 21, 3 and 1 symbols at a time
            rank = induced.name_stretches(s, seeds, kinds).tolist()
            text = [tuple(s[a:z].tolist()) + ((kinds + 1,) if z else (-1,)) for a, z in zip(seeds.tolist(), ends)]
            assert rank == [sum(x < y for x in text) for y in text]


def test_queues_keep_their_order_on_disk(tmp_path):
    rng, queues, want = random.Random(5), induced.Queues(str(tmp_path), 200), collections.defaultdict(list)
    for _ in range(300):
        symbol, part = rng.randrange(4), [rng.randrange(1000) for _ in range(rng.randint(1, 9))]
        queues.put(symbol, np.array(part), np.array(part, np.int32))
        want[symbol] += part
        if rng.random() < 0.05:
            got = queues.take(symbol)
            assert got[0].tolist() == got[1].tolist() == want.pop(symbol)
    assert queues.spilled > 10
    for symbol, part in want.items():
        assert queues.take(symbol)[0].tolist() == part
    assert queues.take(0) is None and queues.held == 0 and not os.listdir(tmp_path)


def test_equal_windows_have_equal_anchors(monkeypatch):
    rng, window, width = random.Random(2), 20, 6
    sizes = [rng.randint(0, 150) for _ in range(30)]
    data = np.frombuffer(bytes(rng.randrange(2) for _ in range(sum(sizes))), np.uint8)
    whole = substrings.segments(data, np.array(sizes), window, width)
    of = {}
    for first, upto, anchor in zip(*(c.tolist() for c in whole)):
        for p in range(first, upto):
            assert p not in of
            of[p] = anchor
    ends = np.cumsum(sizes)
    assert sorted(of) == [p for p in range(len(data)) if p + window <= ends[np.searchsorted(ends, p, "right")]]
    by_bytes = {}
    for p, anchor in of.items():
        assert by_bytes.setdefault(data[p : p + window].tobytes(), anchor) == anchor
    monkeypatch.setattr(substrings, "CHUNK", 64)
    cut = substrings.segments(data, np.array(sizes), window, width)
    assert {p: a for f, u, a in zip(*(c.tolist() for c in cut)) for p in range(f, u)} == of


def test_starts_shared_in_a_shard():
    rng = random.Random(9)
    for _ in range(200):
        window = rng.randint(1, 6)
        data = [bytes(rng.randrange(2) for _ in range(rng.randint(window, 14))) for _ in range(rng.randint(1, 6))]
        owned = [rng.randint(1, len(d) - window + 1) for d in data]
        seen = collections.Counter(d[p : p + window] for d, n in zip(data, owned) for p in range(n))
        got = substrings.repeated_starts(data, owned, window, None)
        assert [g.tolist() for g in got] == [[seen[d[p : p + window]] > 1 for p in range(n)] for d, n in zip(data, owned)]


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in plain_removal(rows)]
    got = sorted(map(tuple, queries.op12_substrings(spark, SF).collect()))
    assert got == sorted(want) and sum(r[2] for r in got)


@pytest.mark.parametrize("window", [9, 70])
def test_spans_and_texts_of_made_documents(spark, window):
    rng = random.Random(window)
    passage = "".join(rng.choice("abcdé ") for _ in range(150))
    texts = []
    for i in range(60):
        own = "".join(rng.choice("abcdefghé ") for _ in range(rng.randint(0, 120)))
        a, n = rng.randrange(100), rng.randint(0, 90)
        texts.append((i, rng.choice([own, own + passage[a : a + n], passage[a : a + n] + own, passage, "x" * rng.randint(0, 200)])))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in substrings.remove_repeats(docs, window=window).collect()]
    assert sorted(got) == sorted(plain_removal(texts, window))


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "1 as `sp ace`", "2 as `x.y`", "3 as spans", "4 as `a``b`")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in substrings.remove_repeats(docs).collect()]
    long = max(len(t or "") for _, t in rows)
    want = [(i, len((t or "").encode()), b"" if len(t or "") == long else (t or "").encode()) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
