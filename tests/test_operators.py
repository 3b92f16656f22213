import collections
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from sparkreel import cli
from sparkreel.config import MiningConfig
from sparkreel.operators import buckets, fill, frames, inference, ordering, sampling, stopping
from sparkreel.plans import extraction, mining
from sparkreel.sources import annotations, checkpoint, frames as frame_files, records
from sparkreel.streaming.collect import append_frames

SAMPLE = "sample_id string, sample_index long, total_frames long, formatted_answer string, task_type string, video_path string, question string, candidates array<string>"


def make_samples(spark, totals):
    rows = [(f"t_{i}", i, t, "(A) Red", "t", f"/v/{i}.mp4", "Q", ["Red", "Green"]) for i, t in enumerate(totals)]
    return spark.createDataFrame(rows, SAMPLE)


@pytest.mark.parametrize(("k", "stride", "limit"), [(16, 10, 50), (4, 1, 3), (3, 7, 0)])
def test_rounds_are_disjoint_and_complete(spark, k, stride, limit):
    totals = [0, 1, 159, 160, 997, 5000]
    config, s = MiningConfig(budget_k=k, frame_stride=stride, max_iterations=limit), make_samples(spark, totals)
    rounds = sampling.generate_rounds(s, config)
    got: dict = {}
    for r in rounds.collect():
        f = list(r["frame_indices"])
        assert f == sorted(set(f)) and len(f) == k and all(x % stride == 0 for x in f)
        got.setdefault(r["sample_index"], []).append((r["round_id"], f, r["remaining_pool_size"]))
    for i, total in enumerate(totals):
        pool, own = len(range(0, total, stride)), sorted(got.get(i, []))
        assert len(own) == (min(pool // k, limit) if limit else pool // k)
        assert [r for r, _, _ in own] == list(range(len(own))) and [m for _, _, m in own] == [pool - (j + 1) * k for j in range(len(own))]
        used = [x for _, f, _ in own for x in f]
        assert len(used) == len(set(used)) and all(0 <= x < total for x in used)
    assert all(r["valid"] for r in sampling.validate_rounds(rounds, s, k).collect())
    again = sampling.generate_rounds(s.repartition(3), config)
    assert again.exceptAll(rounds).count() == rounds.exceptAll(again).count() == 0


def test_validation_sees_faults(spark):
    s = make_samples(spark, [100, 100, 100])
    bad = spark.createDataFrame([("t_0", 0, 0, [1, 2]), ("t_0", 0, 1, [2, 3]), ("t_1", 1, 0, [5, 4]), ("t_2", 2, 0, [99, 100])], "sample_id string, sample_index long, round_id int, frame_indices array<long>")
    assert {r["sample_index"]: r["valid"] for r in sampling.validate_rounds(bad, s, 2).collect()} == {0: False, 1: False, 2: False}


def test_seeded_rounds_follow_the_generator(spark):
    s = make_samples(spark, [0, 400])
    got = [list(r["frame_indices"]) for r in sampling.seeded_rounds(s, MiningConfig()).orderBy("round_id").collect()]
    rng, pool, want = random.Random(43), set(range(0, 400, 10)), []
    while len(pool) >= 16:
        picked = sorted(rng.sample(list(pool), 16))
        pool -= set(picked)
        want.append(picked)
    assert got == want


@pytest.mark.parametrize(("k", "b", "most", "pos", "neg", "stride"), [(16, 16, 50, 5, 0, 10), (4, 4, 50, 2, 1, 10), (4, 4, 0, 0, 0, 1), (3, 5, 20, 3, 3, 2), (16, 4, 50, 999, 999, 10)])
@pytest.mark.parametrize("flush", [True, False])
def test_early_stop_matches_a_loop(spark, k, b, most, pos, neg, stride, flush):
    rng = random.Random(k * b)
    config = MiningConfig(budget_k=k, batch_size=b, max_iterations=most, min_pos_samples=pos, min_neg_samples=neg, frame_stride=stride)
    totals = [rng.randrange(0, 900) for _ in range(12)]
    s, answers, want = make_samples(spark, totals), {}, set()
    for i, total in enumerate(totals):
        n = len(range(0, total, stride)) // k
        n = min(n, most) if most else n
        expected = total // k if not most else min(total // k, most)
        own = answers[i] = [rng.choice(["(A) Red", "A", "zzz", "B", "B"]) for _ in range(n)]
        at = hits = misses = 0
        kept, asked = [], n
        while at < n:
            part = own[at : at + b]
            if len(part) < b and not flush and n < expected:
                break
            kept += range(at, at + len(part))
            hits, misses, at = hits + part.count("(A) Red"), misses + len(part) - part.count("(A) Red"), at + len(part)
            if (pos <= 0 or hits >= pos) and (neg <= 0 or misses >= neg):
                asked = at
                break
        want |= {(i, r, asked) for r in kept}
    results = spark.createDataFrame([(i, r, p) for i, own in answers.items() for r, p in enumerate(own)] or [(0, 0, "")], "sample_index long, round_id int, prediction string")
    got = {tuple(r) for r in stopping.stop_early(results, s, config, flush).select("sample_index", "round_id", "num_rounds").collect()}
    assert got == want


def test_buckets_skip_errors_and_keep_numbers(spark):
    s = make_samples(spark, [100, 100])
    results = spark.createDataFrame(
        [("t_0", 0, 0, [1], "A", None), ("t_0", 0, 1, [2], None, "boom"), ("t_0", 0, 2, [3], "B", None), ("t_0", 0, 10, [4], "(a)", None)],
        "sample_id string, sample_index long, round_id int, frame_indices array<long>, prediction string, error string",
    )
    m = {r["sample_index"]: r for r in mining.score_results(s, results).collect()}
    assert [x["round_id"] for x in m[0]["mining_result"]["pos_bucket"]] == [0, 10] and [x["round_id"] for x in m[0]["mining_result"]["neg_bucket"]] == [2]
    assert m[1]["mining_result"]["pos_bucket"] == [] and (m[1]["pos_count"], m[1]["neg_count"]) == (0, 0)
    mined = mining.score_results(s, results)
    assert buckets.keep_contrastive(mined).count() == 1
    assert buckets.classification_stats(mined).first().asDict() == {"total": 2, "has_both": 1, "all_correct": 0, "all_incorrect": 0, "no_valid_results": 1}
    assert buckets.per_task_stats(mined, with_total=True).count() == 2
    assert buckets.classification_stats(mined.limit(0)).first()["total"] == 0


def test_live_model_and_failures(spark):
    s = make_samples(spark, [700, 700, 10])

    def answer(sample, rounds):
        if sample["sample_index"] == 1:
            raise ValueError("no video")
        return ["(A) Red" if frames_[0] % 20 else "B" for _, frames_ in rounds]

    config = MiningConfig(budget_k=4, batch_size=4, min_pos_samples=1)
    m = {r["sample_index"]: r for r in mining.mine_live(s, answer, config).collect()}
    assert m[0]["error"] is None and m[0]["num_rounds"] % 4 == 0 and m[0]["mining_result"] is not None
    assert m[1]["mining_result"] is None and "no video" in m[1]["error"] and "ValueError" in m[1]["traceback"]
    assert m[2]["mining_result"]["pos_bucket"] == [] and m[2]["num_rounds"] == 0
    assert {r["sample_index"] for r in mining.mine_live(s, answer, config, indices=[0]).collect()} == {0}


def test_batched_predictions_shrink_and_report(spark):
    s = make_samples(spark, [700])

    def make():
        def predict(items):
            if len(items) > 2:
                raise inference.OutOfMemory
            if any(i["frame_indices"][0] == 0 for i in items):
                raise ValueError("bad frame")
            return [" A " for _ in items]

        return predict

    rounds = sampling.generate_rounds(s, MiningConfig(budget_k=4))
    rows = inference.predict_rounds(rounds, s, make, 8).collect()
    assert len(rows) == 17 and sum(r["error"] is not None for r in rows) == sum(0 in r["frame_indices"] for r in rows) == 1
    assert {r["prediction"] for r in rows} == {"A", None} and [r["num_frames"] for r in rows if r["error"] is None] == [4] * 16
    mined = mining.mine_all(s, make, MiningConfig(budget_k=4))
    assert mined.first()["pos_count"] == 16


def test_fill_carries_forward(spark):
    rounds = spark.createDataFrame([("s", "v", 0, [1, 2, 3, 4])], "sample_id string, video_path string, round_id int, frame_indices array<long>")
    have = spark.createDataFrame([("v", 2, "two"), ("v", 4, "four")], "video_path string, frame_index long, image string")
    assert [r["image"] for r in fill.fill_frames(rounds, have, "black").orderBy("position").collect()] == ["black", "two", "two", "four"]


RECORD = {"video_path": "/v/x.mp4", "total_frames": 1000, "mining_result": {"pos_bucket": [{"round_id": 0, "frame_indices": [100, 200, 300], "prediction": "A"}], "neg_bucket": [{"round_id": 1, "frame_indices": [500], "prediction": "B"}]}}


def record(path, total, indices):
    return {"video_path": path, "total_frames": total, "mining_result": {"pos_bucket": [{"frame_indices": indices}], "neg_bucket": []}}


def collected(spark, tmp_path, rows, dilation):
    (tmp_path / "r.jsonl").write_text("\n \n".join(json.dumps(r) for r in rows) + "\n\n")
    got = frames.collect_frames(records.read_frame_input(spark, str(tmp_path / "r.jsonl")), dilation).collect()
    return sorted(r["frame_index"] for r in got)


@pytest.mark.parametrize(
    ("rows", "dilation", "want"),
    [
        ([RECORD], 0, [100, 200, 300, 500]),
        ([RECORD], 2, [x + d for x in (100, 200, 300, 500) for d in range(-2, 3)]),
        ([record("/v/a.mp4", 100, [0, 1, 2])], 2, [0, 1, 2, 3, 4]),
        ([record("/v/a.mp4", 1000, [100, 102])], 2, list(range(98, 105))),
        ([record("/v/a.mp4", 1000, [1])], 2, [0, 1, 2, 3]),
        ([record("/v/a.mp4", 1000, [999])], 2, [997, 998, 999]),
        ([record("/v/a.mp4", 10, [50])], 0, [50]),
        ([record("/v/a.mp4", 100, [99]), record("/v/a.mp4", 200, [99])], 1, [98, 99]),
        ([{k: v for k, v in record("/v/a.mp4", 0, [99]).items() if k != "total_frames"}, record("/v/a.mp4", 50, [99])], 1, [98, 99, 100]),
    ],
)
def test_collection_and_dilation(spark, tmp_path, rows, dilation, want):
    assert collected(spark, tmp_path, rows, dilation) == want


def test_malformed_line_is_an_error(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"video_path": "a"}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        records.read_frame_input(spark, str(tmp_path / "bad.jsonl")).collect()


def test_same_stem_shares_a_name(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps(record(p, 10, [1])) for p in ("/a/x.mp4", "/b/x.mp4", "/b/y.mp4")))
    got = {r["video_path"]: r for r in frames.videos(records.read_frame_input(spark, str(tmp_path / "r.jsonl"))).collect()}
    assert got["/a/x.mp4"]["stem_collision"] and not got["/b/y.mp4"]["stem_collision"] and got["/b/x.mp4"]["video_name"] == "x"


def test_extraction_skips_what_is_there(spark, tmp_path):
    jsonl, out = tmp_path / "r.jsonl", tmp_path / "frames"
    jsonl.write_text(json.dumps(record("/v/x.mp4", 1000, [98, 99, 100, 101, 102])) + "\n" + json.dumps(record("/v/gone.mp4", 10, [1, 2])))
    (out / "x").mkdir(parents=True)
    for name in ("000098.jpg", "000100.jpg", "000007.jpg", "cover.jpg"):
        (out / "x" / name).write_bytes(b"old")

    def decode(path, wanted):
        if "gone" in path:
            raise OSError("can't open")
        yield from ((f, b"jpeg%d" % f) for f in wanted if f != 101)

    code = cli.main(["--jsonl", str(jsonl), "--output", str(out)], decode, spark)
    summary = json.loads((out / "extraction_summary.json").read_text())
    assert code == 1 and summary["statistics"] | {"processing_time_seconds": 0} == {"total_videos": 2, "total_frames": 7, "extracted_frames": 2, "skipped_frames": 3, "failed_frames": 3, "processing_time_seconds": 0}
    assert summary["per_video"]["x"] == {"video_path": "/v/x.mp4", "total_frames": 5, "success": 2, "skipped": 3, "failed": 1}
    assert (out / "x/000099.jpg").read_bytes() == b"jpeg99" and (out / "x/000098.jpg").read_bytes() == b"old"
    with pytest.warns(UserWarning):
        extraction.save_summary(None, str(tmp_path / "none.json"))


def test_cli_rejects_bad_arguments(tmp_path, capsys):
    assert cli.main(["--jsonl", str(tmp_path / "no"), "--quality", "101", "--digits", "0", "--temporal-dilation", "-1"]) == 1
    assert capsys.readouterr().err.count("Error") == 4
    assert cli.elapsed(125.9) == "2 min 5 s"


def test_decoding_in_order(spark):
    seen = frame_files.whole_videos(spark.createDataFrame([("v", 5), ("w", 0)], "video_path string, total_frames long"), lambda p, fs: ((f, b"%d" % f) for f in fs if f != 1), 3)
    assert sorted((r["frame_index"], bytes(r["image"])) for r in seen.collect()) == [(0, b"0"), (2, b"2")]


def test_annotations_to_samples(spark, tmp_path):
    item = {"video": "a.mp4", "question": "Q", "candidates": ["x", "y"], "answer": "y"}
    (tmp_path / "1_plotQA.json").write_text(json.dumps([item, item | {"video": "no.mp4"}, item | {"video": "b.mp4", "question_type": "own", "duration": 2.5}]))
    (tmp_path / "3_ego.json").write_text(json.dumps([item]))
    items = annotations.read_annotations(spark, str(tmp_path), MiningConfig().mcq_tasks)
    assert items.count() == 4
    paths = ["/v/1_plotQA/a.mp4", "/v/1_plotQA/b.mp4", "/v/1_plotQA/no.mp4", "/v/3_ego/a.mp4"]
    meta = annotations.probe_frame_counts(spark.createDataFrame([(p,) for p in paths], "video_path string"), lambda p: {"/v/1_plotQA/no.mp4": 0}.get(p, 100))
    s = annotations.build_samples(items, "/v", meta).orderBy("sample_index").collect()
    assert [(r["sample_id"], r["sample_index"], r["task_type"], r["duration"], r["formatted_answer"]) for r in s] == [("1_plotQA_0", 0, "1_plotQA", 0.0, "(B) y"), ("1_plotQA_2", 1, "own", 2.5, "(B) y"), ("3_ego_0", 2, "3_ego", 0.0, "(B) y")]
    df = annotations.build_samples(items, "/v", meta)
    assert ordering.by_id(df, "3_ego_0").first()["sample_index"] == 2 and ordering.at_index(df, 1).count() == 1
    assert annotations.existing_videos(df, spark.createDataFrame([("/v/3_ego/a.mp4",)], "video_path string")).count() == 1
    assert annotations.read_annotations(spark, str(tmp_path / "none"), ["1_plotQA"]).count() == 0


def test_records_round_trip(spark, tmp_path):
    s = make_samples(spark, [100, 100]).withColumn("question", F.lit("Où ?"))
    results = spark.createDataFrame([("t_0", 0, 0, [1], "A"), ("t_0", 0, 1, [2], "B")], "sample_id string, sample_index long, round_id int, frame_indices array<long>, prediction string")
    mined = mining.score_results(s, results)
    path = str(tmp_path / "out")
    assert records.write_results(mined, path, "/v") == 2 and records.write_results(mined, path, "/v", only_both=True) == 1
    row = records.read_records(spark, path).first()
    assert row["unique_id"] == "mlvu_dev_t_0" and row["video_path"] == "0.mp4" and row["question"] == "Où ?" and row["stats"]["hit_rate"] == 0.5
    assert records.append_records(records.mined_records(mined), path) == 2 and records.count_records(spark, path) == 3
    assert any("Où" in f.read_text() for f in (tmp_path / "out").glob("part*"))
    records.clear_records(spark, path)
    assert records.count_records(spark, path) == 0 and records.count_records(spark, str(tmp_path / "none")) == 0


def test_checkpoint_and_resume(spark, tmp_path):
    config, store = MiningConfig(samples_per_checkpoint=2), checkpoint.CheckpointStore(str(tmp_path / "c/checkpoint.json"))
    assert store.load() is None and store.matches(config)
    store.save(["t_1"], config, "out")
    again = checkpoint.CheckpointStore(store.path)
    assert again.load().total_processed == 1 and again.is_processed("t_1") and again.matches(config) and not again.matches(MiningConfig(budget_k=3))
    s, seen = make_samples(spark, [1] * 6), []
    n = checkpoint.in_slices(s, again, config, "out", lambda part: part, lambda part: seen.extend(r[0] for r in part.select("sample_id").collect()))
    assert n == 5 and sorted(seen) == ["t_0", "t_2", "t_3", "t_4", "t_5"] and again.progress()["processed_count"] == 6
    (tmp_path / "c/checkpoint.json").write_text("{")
    with pytest.warns(UserWarning):
        assert again.load() is None and again.processed
    again.clear()
    again.add("x", config, "out", interval=1)
    assert again.load().processed_sample_ids == ["x"]


def test_config():
    assert MiningConfig.from_dict({}).min_neg_samples == 5 and MiningConfig().min_neg_samples == 0
    assert MiningConfig().max_rounds(6150) == 50 and MiningConfig(full_extraction=True).max_rounds(6150) == 384
    assert MiningConfig.from_dict(MiningConfig().to_dict()) == MiningConfig() and MiningConfig().digest() != MiningConfig(num_gpus=1).digest()
    for bad in ({"budget_k": 0}, {"max_iterations": -1}, {"num_gpus": 0}, {"batch_size": 0}, {"min_remaining_frames": -1}):
        with pytest.raises(ValueError, match="at least"):
            MiningConfig(**bad)


def test_paths(tmp_path):
    config = MiningConfig(output_dir=str(tmp_path / "o"), checkpoint_dir=str(tmp_path / "c"))
    config.ensure_dirs()
    assert config.output_path().endswith("o/bucket_dataset.jsonl") and config.output_path("e").endswith("o/e/results.jsonl")
    assert config.checkpoint_path("e").endswith("c/e/checkpoint.json") and (tmp_path / "c/e").is_dir()


def test_worker_shares(spark):
    s = make_samples(spark, [1] * 10)
    assert [r[0] for r in s.orderBy("sample_index").select(ordering.worker_of("sample_index", 10, 3)).collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]
    assert {r[0] for r in s.select(ordering.worker_of("sample_index", 2, 3)).collect()} == {2}
    assert [r[0] for r in ordering.by_sample_id(spark.createDataFrame([("t_2",), ("t_10",)], "sample_id string")).collect()] == ["t_10", "t_2"]


def test_stream_appends_new_frames(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for number, rows in enumerate(([record("/v/a.mp4", 9, [1, 2])], [record("/v/a.mp4", 9, [2, 3])])):
        (folder / f"{number}.json").write_text("\n".join(json.dumps(r) for r in rows))
        append_frames(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert sorted(r["frame_index"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_a_model_is_made_once_a_process(spark, tmp_path):
    from sparkreel.operators.inference import once_a_process

    log = str(tmp_path / "made")

    def make():
        import os

        with open(log, "a") as file:
            file.write(f"{os.getpid()}\n")
        return lambda x: x + 1

    get = once_a_process(make)

    def run(batches):
        for batch in batches:
            yield batch.assign(id=[get()(x) for x in batch["id"]])

    for _ in range(2):
        got = spark.range(0, 40, 1, 20).mapInPandas(run, "id long").collect()
        assert sorted(r["id"] for r in got) == list(range(1, 41))
    made = open(log).read().split()
    assert made and len(made) == len(set(made))


def test_pools_are_ordered_without_moving_frames(spark, monkeypatch):
    """No frame is sorted or shuffled as a row of Spark; repeated samples, and pools too long for one row, give the rounds they always gave."""
    config = MiningConfig(budget_k=3, frame_stride=2, max_iterations=4)
    rows = [("a", 0, 40), ("b", 1, 7), ("b", 1, 7), ("c", 2, 5), ("d", 3, 0), ("e", 4, None), ("f", None, 30), ("a", 0, 12)]
    s = spark.createDataFrame(rows, "sample_id string, sample_index long, total_frames long")
    want = []
    for (name, index, total), copies in collections.Counter(rows).items():
        pool = [f for f in range(0, total or 0, 2) for _ in range(copies)]
        text = lambda f: ":".join([*([str(42 + index)] if index is not None else []), str(f)])  # noqa: B023, E731
        pool.sort(key=lambda f: (hashlib.md5(text(f).encode()).hexdigest(), f))
        n = min(-(-(total or 0) // 2) // 3, 4)
        want += [(name, index, r, sorted(pool[3 * r : 3 * r + 3]), -(-total // 2) - 3 * (r + 1)) for r in range(n)]
    got = lambda: sorted((tuple(r) for r in sampling.generate_rounds(s, config).collect()), key=repr)
    assert got() == sorted(want, key=repr)
    frames = sampling.generate_rounds(s, config)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(sample_index" in frames and "Exchange hashpartitioning(sample_index#0L, sample_id" not in frames
    assert "ENSURE_REQUIREMENTS" not in frames  # samples alone are dealt out
    monkeypatch.setattr(sampling, "ARRAY_FRAMES", 6)
    assert got() == sorted(want, key=repr)


def test_validation_moves_no_frames(spark):
    config = MiningConfig(budget_k=4, frame_stride=1)
    s = spark.createDataFrame([(f"s{i}", i, 40) for i in range(3)], "sample_id string, sample_index long, total_frames long")
    valid = sampling.validate_rounds(sampling.generate_rounds(s, config), s, 4)
    assert "explode_outer" not in valid._jdf.queryExecution().analyzed().toString().lower()
    assert {tuple(r) for r in valid.collect()} == {(f"s{i}", i, True) for i in range(3)}
    twice = sampling.generate_rounds(s, config).where("round_id = 0").union(sampling.generate_rounds(s.where("sample_index = 1"), config).where("round_id = 0"))
    assert {r["sample_index"]: r["valid"] for r in sampling.validate_rounds(twice, s, 4).collect()} == {0: True, 1: False, 2: True}


def test_a_frame_of_results_for_each_arrow_batch(spark, monkeypatch):
    """Asked batches are gathered as plain rows; one pandas frame holds all of them."""
    class Array(list):
        tolist = lambda self: [int(x) for x in self]

    part = [("a", 0, Array([1, 2]), "two words", ["x"]), ("a", 1, Array([3]), None, None), ("b", 0, Array([9]), "q", [])]

    def predict(items):
        if any(9 in i["frame_indices"] for i in items):
            raise ValueError("no\nmore")
        return [" yes it is " for _ in items]

    rows = list(inference.answered(predict, lambda s: len(s.split()), part))
    assert rows == [("a", 0, [1, 2], "yes it is", 2, 3, 2, None), ("a", 1, [3], "yes it is", 2, 3, 1, None), ("b", 0, [9], None, None, None, None, "more")]
