"""Operators 11 and 13."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from helpers import odd_documents

from sparkreel.llm import importance, queries, tandem

SF = "/root/testdata/sf0.001"


def plain_runs(s, min_length=6, min_exponent=4):
    """Every stretch with equal words q apart that no neighbour extends, where q is its least period."""
    out = []
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            part = s[i : j + q]
            if j > i and len(part) >= max(min_length, min_exponent * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((i, len(part), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    row = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *row, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(400):
        n, kinds = rng.randint(0, 70), rng.choice([1, 2, 3, 6])
        s = [rng.randrange(kinds) for _ in range(n)]
        if n > 8 and rng.random() < 0.6:
            a, p = rng.randrange(n - 4), rng.randint(1, 9)
            s = [s[i] if i < a else s[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(n)]
        for limits in ((2, 2), (3, 3), (6, 4)):
            assert tandem.find_runs(s, *limits) == plain_runs(s, *limits)
        codes, found = np.array(s, np.int64), []
        for a, z in tandem.stretches(np.zeros(n, np.int64), codes, 6, 4):
            part = np.unique(codes[a:z], return_inverse=True)[1].tolist()
            found += [(a + x, length, q) for x, length, q in tandem.find_runs(part)]
        assert sorted(found, key=lambda r: (r[0], r[2])) == plain_runs(s)


def test_tree_holds_every_square():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        tree = tandem.SuffixTree([*s, 2])
        got = {(length, tuple(s[tree.first[v] : tree.first[v] + length])) for length, v in tandem.squares(tree)}
        want = {(2 * k, tuple(s[i : i + 2 * k])) for k in range(1, 21) for i in range(len(s) - 2 * k + 1) if s[i : i + k] == s[i + k : i + 2 * k]}
        assert got == want


def test_runs_query_equals_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op11_runs(spark, SF).collect()]
    want = [plain_digest(*r) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[1] for r in got)


def test_runs_of_odd_rows(spark):
    long = " ".join(["again and again"] * 30_000)
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, long), (4, long), (None, "x " * 12), (6, "x\x0by\x0c" * 6)], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as `sp ace`", "2 as `x.y`", "3 as `runs`", "4 as `a``b`")
    got = tandem.digests(tandem.mark_runs(docs, rewrite=queries.periodic_part)).collect()
    assert len(got) == 7
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 4}
    for i, text in ((1, None), (2, ""), (3, " \n"), (None, "x " * 12), (6, "x\x0by\x0c" * 6)):
        assert tuple(by[i]) == plain_digest(i, text)
    marked = tandem.mark_runs(docs).where("doc_id = 4").collect()
    assert [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in marked] == [(90_000, [(0, 90_000, 3)], "again and again")] * 2
    assert tandem.mark_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tandem.mark_runs(docs, min_exponent=1)


def plain_resample(docs, target, longest, buckets, percent, min_words):
    def features(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), collections.Counter(zlib.crc32(r.encode()) % buckets for r in runs)

    def total(texts):
        out = collections.Counter()
        for t in texts:
            out += features(t)[1]
        return out

    here, there = total(t for _, t in docs), total(target)
    s_all, t_all = sum(here.values()), sum(there.values())
    gain = [math.floor(1000 * math.log((there[b] + 1) * (s_all + buckets) / ((here[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for i, text in docs:
        n_words, f = features(text)
        n = sum(f.values())
        weight = sum(gain[b] * c for b, c in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n_words >= min_words:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("longest,buckets,percent,min_words", [(1, 10_000, 10, 20), (3, 500, 37, 5), (2, 64, 100, 0)])
def test_resampling_equals_plain_version(spark, longest, buckets, percent, min_words):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = importance.resample(docs, target, longest=longest, buckets=buckets, percent=percent, min_words=min_words).collect()
    want = plain_resample([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()], longest, buckets, percent, min_words)
    assert sorted(map(tuple, got), key=repr) == want


def test_resampling_query_equals_sql(spark):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.sql(queries.oracle_sql()["op13_importance"])
    got = queries.op13_importance(spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


def test_resampling_of_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "1 as `sp ace`", "2 as `x.y`", "3 as rank", "4 as `a``b`")
    target = spark.createDataFrame([("word1 of the",), (None,)], "text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for aim in (target, target.limit(0)):
        got = importance.resample(docs, aim, min_words=1, percent=60).collect()
        want = plain_resample(rows, [r["text"] for r in aim.collect()], 1, 10_000, 60, 1)
        assert sorted(tuple(r)[:4] for r in got if r["doc_id"] is not None) == sorted(w[:4] for w in want if w[0] is not None)
        assert sorted(r["rank"] for r in got if r["rank"]) == sorted(w[4] for w in want if w[4])
    assert importance.resample(docs.limit(0), target).count() == 0


def test_draws_follow_the_target(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "if(id % 4 = 0, repeat('apple pear plum ', 10), repeat('iron steel zinc ', 10)) as text")
    target = spark.range(500).selectExpr("'apple pear plum cherry' as text")  # few words would drown in the smoothing
    drawn = [r["doc_id"] for r in importance.resample(docs, target).where("rank is not null").collect()]
    assert len(drawn) == 40 and sum(i % 4 == 0 for i in drawn) > 32
