"""Rounds by random access, asking while drawing, exact rates, and positions without one window."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import make_samples

from sparkreel.config import MiningConfig
from sparkreel.functions.records import rounded_rate
from sparkreel.operators import ordering, permutation, sampling, stopping


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 16, 97, 1000])
def test_places_are_permuted(spark, n):
    df = spark.range(n).withColumn("keys", permutation.pass_keys(F.lit(5), F.lit(n).cast("long")))
    got = [r[0] for r in df.orderBy("id").select(permutation.permuted(F.col("id"), F.lit(n).cast("long"), F.col("keys"))).collect()]
    assert sorted(got) == list(range(n)) and got == permutation.permuted_numbers(np.arange(n), n, 5).tolist()


def test_permutations_are_uniform():
    """Chi-square of place against value, and of pairs of neighbours, over many seeds."""
    n, seeds = 12, 6000
    all_ = np.array([permutation.permuted_numbers(np.arange(n), n, seed) for seed in range(seeds)])
    table = np.array([np.bincount(all_[:, j], minlength=n) for j in range(n)])
    chi = ((table - seeds / n) ** 2 / (seeds / n)).sum()
    free = (n - 1) ** 2
    assert abs(chi - free) < 5 * (2 * free) ** 0.5
    pairs = np.bincount((all_[:, 0] * n + all_[:, 1]), minlength=n * n).reshape(n, n)
    assert (np.diag(pairs) == 0).all()
    off, want = pairs[~np.eye(n, dtype=bool)], seeds / (n * (n - 1))
    chi, free = ((off - want) ** 2 / want).sum(), n * (n - 1) - 1
    assert abs(chi - free) < 5 * (2 * free) ** 0.5


@pytest.mark.parametrize(("k", "stride", "limit"), [(16, 10, 50), (4, 1, 3), (3, 7, 0)])
def test_lazy_rounds_are_disjoint_complete_and_unshuffled(spark, k, stride, limit):
    totals = [0, 1, 159, 160, 997, 5000, None]
    config, s = MiningConfig(budget_k=k, frame_stride=stride, max_iterations=limit), make_samples(spark, totals)
    lazy = sampling.lazy_rounds(s, config)
    assert not any(x in plan(lazy) for x in ("Exchange", "Sort ", "Window"))
    rows = lazy.collect()
    old = {(r["sample_index"], r["round_id"]): r["remaining_pool_size"] for r in sampling.generate_rounds(s, config).collect()}
    assert {(r["sample_index"], r["round_id"]): r["remaining_pool_size"] for r in rows} == old and len(rows) == len(old)
    assert all(r["valid"] for r in sampling.validate_rounds(lazy, s, k).collect())
    assert all(x % stride == 0 for r in rows for x in r["frame_indices"])
    some = sampling.lazy_rounds(s, config, F.array(F.lit(2), F.lit(999), F.lit(-1))).collect()
    assert sorted(map(repr, some)) == sorted(repr(r) for r in rows if r["round_id"] in (2, 999))
    none = sampling.lazy_rounds(s, config, F.lit(None).cast("array<int>")).count()
    assert none == 0 and sampling.lazy_rounds(s.limit(0), config).count() == 0


@pytest.mark.parametrize(("flush", "match", "pos", "neg"), [(True, "exact", 5, 0), (False, "exact", 2, 1), (True, "letter", 999, 999), (True, "exact", 0, 0)])
def test_asking_lazily_draws_no_round_in_vain(spark, flush, match, pos, neg):
    config = MiningConfig(budget_k=4, frame_stride=1, batch_size=4, min_pos_samples=pos, min_neg_samples=neg)
    s = make_samples(spark, [0, 3, 17, 64, 300, 1000, 75])

    def predict(sample, rounds):
        if sample["sample_index"] == 6:
            raise ValueError("no such video")
        return [("(A) Red", "A", "zzz", None)[(sample["sample_index"] + r + f[0]) % 4] for r, f in rounds]

    drawn = spark.sparkContext.accumulator(0)
    got = stopping.ask_lazily(s, predict, config, flush, match, note=drawn.add).collect()
    total = drawn.value
    want = stopping.ask_until_enough(sampling.lazy_rounds(s, config), s, predict, config, flush, match).collect()
    key = lambda r: (r["sample_index"], r["round_id"] or 0)
    keep = lambda rows: [tuple(x for n, x in r.asDict().items() if n != "traceback") for r in sorted(rows, key=key)]
    assert keep(got) == keep(want)
    judged = sum(r["error"] is None for r in got)
    assert judged <= total <= judged + 4 and (pos > 5 or total < sampling.lazy_rounds(s, config).count())


def test_rates_equal_pythons_rounding(spark):
    totals = spark.range(1, 2001).withColumnRenamed("id", "total").withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), "total")))
    rates = totals.select("pos", "total", rounded_rate(F.col("pos"), F.col("total") - F.col("pos")).alias("rate")).toPandas()
    wrong = [(p, t, r) for p, t, r in zip(rates["pos"], rates["total"], rates["rate"]) if round(int(p) / int(t), 4) != r]
    assert not wrong, wrong[:5]
    rng = random.Random(1)
    pairs = [(rng.randrange(10 ** rng.randint(1, 9)), rng.randrange(10**9)) for _ in range(3000)] + [(0, 0), (1, 10**9), (1, 2**20), (10**9, 0)]
    got = spark.createDataFrame([(a, b) for a, b in pairs], "pos long, neg long").select("pos", "neg", rounded_rate(F.col("pos"), F.col("neg"))).collect()
    assert all(r[2] == (round(r[0] / (r[0] + r[1]), 4) if r[0] + r[1] else 0.0) for r in got)


def test_positions_span_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.randrange(50), i) for i in range(500)] + [(None, 1, 500)]
    df = spark.createDataFrame(rows, "k string, v long, i long").repartition(7)
    got = ordering.numbered(df, "k", F.desc("v"), "i").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(501))
    assert ordering.numbered(df.limit(0), "k").count() == 0
    assert "Window" not in plan(ordering.numbered(df, "k", "v"))


def test_empty_and_null_rounds_are_invalid(spark):
    s = make_samples(spark, [100] * 4)
    rows = [("t_0", 0, 0, [0, 10]), ("t_0", 0, 1, []), ("t_1", 1, 0, []), ("t_2", 2, 0, None), ("t_3", 3, 0, [0, 10])]
    bad = spark.createDataFrame(rows, "sample_id string, sample_index long, round_id int, frame_indices array<long>")
    assert {r["sample_index"]: r["valid"] for r in sampling.validate_rounds(bad, s, 2).collect()} == {0: False, 1: False, 2: False, 3: True}


def test_rounds_by_random_access_are_drawn_in_batches(spark):
    """The numbers of Catalyst's fold, drawn by arrays of places: no expression is interpreted for each frame."""
    config = MiningConfig(budget_k=3, frame_stride=4, max_iterations=0)
    s = spark.createDataFrame([("a", 0, 90), ("b", 1, 41), ("c", None, 30), ("d", 3, 5), ("e", 4, None), ("f", 1, 41)], "sample_id string, sample_index long, total_frames long")
    lazy = sampling.lazy_rounds(s, config)
    assert "lambdafunction" not in plan(lazy) and "MapInArrow" in plan(lazy)
    n, seed = sampling.pool_size(4), F.lit(config.random_seed) + F.col("sample_index")
    keyed = s.where("total_frames > 0").select("sample_id", n.alias("n"), permutation.pass_keys(seed, n).alias("keys")).withColumn("place", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)))
    places = collections.defaultdict(list)
    for r in keyed.select("sample_id", "place", permuted_place()).orderBy("sample_id", "place").collect():
        places[r[0]].append(4 * r[2])
    want = [(i, r, sorted(f[3 * r : 3 * r + 3]), len(f) - 3 * (r + 1)) for i, f in places.items() for r in range(len(f) // 3)]
    assert sorted((r["sample_id"], r["round_id"], r["frame_indices"], r["remaining_pool_size"]) for r in lazy.collect()) == sorted(want)


def permuted_place():
    return permutation.permuted(F.col("place"), F.col("n"), F.col("keys"))
