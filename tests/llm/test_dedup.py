import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import DOCS, components, odd_documents

from sparkreel.llm import embeddings, simhash
from sparkreel.llm.components import connected_components, join_further


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    split, word = [], ""
    for c in words + " ":
        if c in " \t\n\x0b\x0c\r":
            split += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(split[i : i + 3]) for i in range(len(split) - 2)] if len(split) >= 3 else [" ".join(split)] if split else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("text", ["", None, "  ", "One", "A b", "A B c", "É x\x1cy z A", "a b c " * 500, "mixed Case\tand\x0bother　blanks\r\nhere"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_group_links_equal_brute_force():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for b in base for i, j in rng.integers(0, 64, (20, 2))]
    x = np.unique(np.concatenate((base, np.array(near, np.uint64))))
    x = x[np.argsort(simhash.gray_rank(x))]
    want = components(range(len(x)), [(i, j) for i, j in itertools.combinations(range(len(x)), 2) if bin(int(x[i] ^ x[j])).count("1") <= 2])
    for batch in (7, 2048):
        a, b = simhash.group_links(x, 2, batch)
        assert components(range(len(x)), zip(a.tolist(), b.tolist())) == want


def test_near_documents_meet_across_groups(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(15)} | set(seeds)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = [tuple(r) for r in simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()]
    mask = (1 << 64) - 1
    brute = [(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & mask).count("1") <= 2]
    assert all(bin((a ^ b) & mask).count("1") <= 2 * len(fps) for a, b in links)
    assert components(signed, links) == components(signed, brute)


def test_simhash_results_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(docs)).collect()}
    fp = {d["doc_id"]: slow_fingerprint(d["text"]) for d in docs}
    want = components(fp, [(a, b) for a, b in itertools.combinations(fp, 2) if bin(fp[a] ^ fp[b]).count("1") <= 2])
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fp[i]:016x}", want[i]) for i in fp}


def test_simhash_odd_rows(spark):
    rows = simhash.near_duplicates(odd_documents(spark)).collect()
    assert len(rows) == 9 and sorted((r["doc_id"] is not None and r["doc_id"]) for r in rows if r["fingerprint"] == "0" * 16) == [False, 1, 2, 3]
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] == 6] == [5]
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).columns == empty.columns
    kept = simhash.keep_one(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 4, 4, 5]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200, 260)]
    star = [(1, i) for i in range(300, 500)]
    links = path + star + [(7, 7), (8, 9)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == components({n for e in links if e[0] != e[1] for n in e}, [e for e in links if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    salted = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), hub=20).collect()}
    assert salted == got


def brute_vectors(rows):
    good = {}
    for place, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[place] = np.array(v, float)
    links = [(a, b) for a, b in itertools.combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] / math.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.9]
    return links


@pytest.mark.parametrize("tile", [64, 8192])
def test_vectors_equal_brute_force(spark, tile):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    x = np.vstack([c + rng.normal(scale=0.32, size=(30, 24)) for c in centres])
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[5][1]) for i in range(20)] + [(2000, [2 * v for v in rows[7][1]])]
    got = {r["vec_id"]: r for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile_rows=tile).collect()}
    links = brute_vectors(rows)
    ids = [r[0] for r in rows]
    pairs = [(ids[a], ids[b]) for a, b in links]
    want = components(ids, pairs)
    degree = dict.fromkeys(ids, 0)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (degree[i], want[i], want[i] == i) for i in ids}


def test_tile_keeps_links_of_earlier_blocks(monkeypatch):
    toy = [(64, 100), (65, 100), (2, 130), (2, 66), (1, 131), (3, 132), (3, 67), (0, 133), (64, 130), (66, 131), (65, 132), (67, 133)]
    place = lambda i: i // 16 * 512 + i % 16  # noqa: E731  blocks of 16 by 64 to those of 512 by 2048
    links, n = {(place(a), place(b)) for a, b in toy}, 4608

    def near(x, y, raw_x, raw_y, threshold):
        found = [(i - int(raw_x[0, 0]), j - int(raw_y[0, 0])) for i, j in sorted(links) if raw_x[0, 0] <= i <= raw_x[-1, 0] and raw_y[0, 0] <= j <= raw_y[-1, 0]]
        return tuple(np.array(v, np.int64) for v in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    monkeypatch.setattr(embeddings, "_near", near)
    rows = pa.table({"visits": [False] * n, "first": [True] * n, "id": list(range(n)), "n": [1] * n, "embedding": [[float(i), 1.0] for i in range(n)]})
    out = embeddings._tile(np.eye(2), 0.9)(rows).to_pydict()
    assert set(out["id"]) == {i for pair in links for i in pair} and set(out["root"]) == {0}


@pytest.mark.parametrize("tile", [4, 30])
def test_visits_meet_every_pair_once(spark, monkeypatch, tile):
    """Many leaves with several tiles and chunks each, clusters across their borders, and coordinates at the cuts."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 6)) * (rng.random((12, 6)) < 0.7)
    rows = [(i, (centres[rng.integers(12)] + rng.normal(scale=0.15, size=6) * rng.integers(0, 2)).tolist()) for i in range(260)]
    monkeypatch.setattr(embeddings, "MAX_LEAVES", 8)
    monkeypatch.setattr(embeddings, "VISITORS", 1)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), tile_rows=tile).collect()}
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if any(x) and any(y) and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9]
    want, degree = components(range(260), links), [sum(i in e for e in links) for i in range(260)]
    assert got == {i: (degree[i], want[i]) for i in range(260)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [3e38, 1.0])]
    df = spark.createDataFrame([(*r, 0, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, leaf int, id string")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicate_vectors(df).collect()))
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10)]
    assert got == sorted([*alone, (7, 4, 7, True), (8, 4, 7, False), (8, 4, 7, False), (0, 4, 7, False), (11, 4, 7, False)])
    assert embeddings.near_duplicate_vectors(df.limit(0)).count() == 0


def test_components_joined_further(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    roots = connected_components(spark.createDataFrame(links[:110], "a long, b long"))
    more = spark.createDataFrame([*links[110:], (None, 3), (7, 7)], "a long, b long")
    want = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {r["node"]: r["component"] for r in join_further(roots, more).collect()} == want
    none = spark.createDataFrame([], "a long, b long")
    assert {(r["node"], r["component"]) for r in join_further(roots, none).collect()} == {(r["node"], r["component"]) for r in roots.collect()}
    assert join_further(connected_components(none), none).count() == 0
