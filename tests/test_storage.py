"""Bitmaps, the commit log, the data source, the stream, batches by tokens, the resumable run, and the extraction's recovery."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_operators import make_samples, record

from sparkreel import mine
from sparkreel.config import MiningConfig
from sparkreel.functions.answers import conversation, with_frames
from sparkreel.operators import batching, bitmaps, frames, inference, sampling
from sparkreel.plans.progress import progress
from sparkreel.plans.run import mine_lazily, mine_run
from sparkreel.sources import commits
from sparkreel.sources.frame_source import FrameFiles
from sparkreel.streaming.collect import FrameTable, collect_stream

RECORDS = "video_path string, total_frames long, line_no long, mining_result struct<pos_bucket: array<struct<frame_indices: array<bigint>>>, neg_bucket: array<struct<frame_indices: array<bigint>>>>"


def make_records(spark, rng, far=100_000):
    rows = []
    for i in range(60):
        side = lambda: [([rng.choice([rng.randrange(40), 32_760 + rng.randrange(20), rng.randrange(far)]) for _ in range(rng.randrange(4))],) for _ in range(2)]  # noqa: E731, B023
        rows.append((f"/v/{rng.randrange(4)}.mp4", rng.choice([50, 32_770, far, None]), i, (side(), None if i % 9 == 0 else side())))
    return spark.createDataFrame(rows, RECORDS)


@pytest.mark.parametrize("n", [0, 1, 3, 100, 32_767])
def test_bitmaps_equal_frame_rows(spark, n):
    r = make_records(spark, random.Random(n))
    bounds = frames.videos(r).select("video_path", "total_frames")
    wide = bitmaps.dilate(bitmaps.collect_bitmaps(r), n, bounds)
    got = bitmaps.list_bits(bitmaps.named(wide)).select("video_path", "video_name", "frame_index")
    want = frames.collect_frames(r, n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    counts = {x["video_path"]: x["n"] for x in bitmaps.count_frames(wide, "video_path").collect()}
    assert counts == {x["video_path"]: x["count"] for x in want.groupBy("video_path").count().collect()}
    assert wide.groupBy("video_path", "bucket").count().where("count > 1").isEmpty()


def test_bitmap_difference_and_edges(spark):
    r = make_records(spark, random.Random(5))
    wanted = bitmaps.named(bitmaps.collect_bitmaps(r))
    rows = bitmaps.list_bits(wanted)
    existing = rows.where("frame_index % 3 = 0").select("video_name", "frame_index").unionByName(spark.createDataFrame([("nobody", 5)], "video_name string, frame_index long"))
    got = bitmaps.list_bits(bitmaps.difference(wanted, bitmaps.from_frames(existing, "video_name"), "video_name")).select("video_path", "video_name", "frame_index")
    want = frames.frames_to_extract(rows, existing)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count()
    negative = spark.createDataFrame([("a", -1), ("a", -32_769), ("a", 0), ("a", 0)], "k string, frame_index long")
    assert sorted(x["frame_index"] for x in bitmaps.list_bits(bitmaps.from_frames(negative, "k")).collect()) == [-32_769, -1, 0]
    assert bitmaps.list_bits(bitmaps.dilate(bitmaps.collect_bitmaps(r.limit(0)), 2)).count() == 0
    with pytest.raises(ValueError):
        bitmaps.dilate(wanted, 32_768)


def ids(log):
    return sorted(r["sample_id"] for r in log.done().select("sample_id").distinct().collect())


def test_commit_log(spark, tmp_path):
    config, s = MiningConfig(samples_per_checkpoint=2), make_samples(spark, [1] * 7)
    log, other = (commits.CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert ids(log) == [] and log.matches(config) and log.progress() == {"processed_count": 0, "last_updated": None, "output_file": None}
    log.compact()
    a = log.commit(s.where("sample_index < 2"), config, "out")
    b = other.commit(s.where("sample_index in (1, 2)"), config, "out")  # two writers
    assert ids(log) == ids(other) == ["t_0", "t_1", "t_2"] and {r["commit"] for r in log.done().collect()} == {a, b}
    assert log.matches(config) and not log.matches(MiningConfig(budget_k=3)) and log.is_processed("t_2") and not log.is_processed("t_3")
    log.compact()
    log.commit(s.where("sample_index = 3"), config, "out2")
    other.compact()
    log.commit(s.where("sample_index = 4"), config, "out2", "name")
    log.commit(s.where("sample_index = 5"), config, "out2", "name")  # that name is taken
    assert ids(log) == ["t_0", "t_1", "t_2", "t_3", "t_4"] and log.progress()["processed_count"] == 5 and log.progress()["output_file"] == "out2"
    log.compact()
    log.vacuum()
    assert ids(log) == ["t_0", "t_1", "t_2", "t_3", "t_4"] and len(os.listdir(tmp_path / "log/bases")) == 1 and not os.listdir(tmp_path / "log/commits")
    log.commit(s.where("sample_index = 5"), config, "out2", "name")  # taken still, in a base
    assert [r["sample_id"] for r in commits.remaining(s, log).orderBy("sample_index").collect()] == ["t_5", "t_6"]
    assert log.document().first().asDict()["total_processed"] == 5
    log.clear()
    assert ids(log) == []


def test_compactions_at_one_time_lose_nothing(spark, tmp_path, monkeypatch):
    config, s = MiningConfig(), make_samples(spark, [1] * 4)
    log, other = (commits.CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    log.commit(s.where("sample_index = 0"), config, "out")
    place = log._place

    def late(aside, target):  # while one compaction is about to end, another commit and compaction go by
        if target.startswith("bases/"):
            other.commit(s.where("sample_index = 1"), config, "out")
            other.compact()
            other.vacuum()
        place(aside, target)

    monkeypatch.setattr(log, "_place", late)
    monkeypatch.setattr(other, "vacuum", lambda: None)  # it may not run beside a writer
    log.compact()
    monkeypatch.undo()
    assert ids(log) == ["t_0", "t_1"]
    log.commit(s.where("sample_index = 2"), config, "out")
    log.compact()
    log.vacuum()
    assert ids(log) == ["t_0", "t_1", "t_2"]


def test_run_stopped_between_write_and_commit(spark, tmp_path, monkeypatch):
    config, s = MiningConfig(samples_per_checkpoint=3), make_samples(spark, [1] * 8)
    log, out = commits.CommitLog(spark, str(tmp_path / "log")), str(tmp_path / "out")
    write = lambda rows, name: rows.select("sample_id").write.mode("overwrite").parquet(f"{out}/slice={name}")
    commit, calls = log.commit, []

    def stop(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return commit(*args)

    monkeypatch.setattr(log, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        commits.in_commits(s, log, config, out, lambda part: part, write)
    monkeypatch.undo()
    assert len(ids(log)) == 3 and spark.read.parquet(out).count() == 6
    assert commits.in_commits(s, log, config, out, lambda part: part, write, most=4) == 4
    assert commits.in_commits(s, log, config, out, lambda part: part, write) == 1
    assert sorted(r["sample_id"] for r in spark.read.parquet(out).collect()) == ids(log) == [f"t_{i}" for i in range(8)]
    assert commits.in_commits(s, log, config, out, lambda part: part, write) == 0


def test_frame_files_read_and_write(spark, tmp_path):
    spark.dataSource.register(FrameFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    path = str(tmp_path / "frames")
    rows = [(v, i, f"{v}{i}".encode()) for v in ("a b", "c+%") for i in (0, 5, 12, 1234567)]
    df = spark.createDataFrame(rows, "video_name string, frame_index long, image binary")
    df.select("image", "frame_index", "video_name").repartition(3).write.format("frame_files").mode("append").save(path)
    (tmp_path / "frames/c+%/cover.jpg").write_bytes(b"no number")
    read = spark.read.format("frame_files").load(path)
    assert sorted((r[0], r[1], bytes(r[2])) for r in read.collect()) == sorted(rows)
    assert sorted(os.listdir(path)) == ["a b", "c+%"] and (tmp_path / "frames/a b/000012.jpg").exists()
    some = read.where("frame_index > 4 and frame_index <= 12 and video_name = 'a b' and length(image) > 3")
    assert sorted(r["frame_index"] for r in some.collect()) == [5, 12]
    (tmp_path / "frames/a b/000000.jpg").unlink()
    (tmp_path / "frames/a b/000000.jpg").mkdir()  # would fail if it were opened
    assert sorted(r["frame_index"] for r in read.where("frame_index in (5, 12)").collect()) == [5, 5, 12, 12]
    df.where("frame_index = 5").write.format("frame_files").mode("overwrite").option("digits", "2").save(str(tmp_path / "other"))
    df.where("frame_index = 0").write.format("frame_files").mode("overwrite").option("digits", "2").save(str(tmp_path / "other"))
    assert sorted(str(p.relative_to(tmp_path / "other")) for p in (tmp_path / "other").rglob("*.jpg")) == ["a b/00.jpg", "c+%/00.jpg"]
    assert spark.read.format("frame_files").load(str(tmp_path / "none")).count() == 0


def test_failed_write_of_frames_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(FrameFiles)
    bad = spark.createDataFrame([("a", i, b"x" if i != 7 else None) for i in range(10)], "video_name string, frame_index long, image binary").repartition(4)
    with pytest.raises(Exception, match="no frame file can be named"):
        bad.write.format("frame_files").mode("append").save(str(tmp_path / "f"))
    assert not list((tmp_path / "f").rglob("*.jpg"))


def test_stream_merges_once(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    table = FrameTable(spark, str(tmp_path / "table"))
    merge, left = table.merge, [1]

    def stop(rows, batch):
        if batch == 2 and left:
            left.clear()
            bitmaps.union(table.read(batch), bitmaps.collect_bitmaps(rows)).write.mode("overwrite").parquet(f"{table.folder}/version={batch}")
            raise RuntimeError("stopped before the batch was done")
        merge(rows, batch)

    monkeypatch.setattr(table, "merge", stop)
    for number in range(6):
        rows = [record(f"/v/{number % 2}.mp4", 99_999, [number, 7, 40_000 + number]), record("/v/x.mp4", None, [number])]
        (folder / f"{number}.json").write_text("\n".join(json.dumps(r) for r in rows))
    with pytest.raises(Exception, match="stopped before"):
        collect_stream(spark, str(folder), table, str(tmp_path / "state"), 1).awaitTermination(120)
    assert table.versions() == [0, 1]
    collect_stream(spark, str(folder), table, str(tmp_path / "state"), 1).awaitTermination(120)
    want = {(f"/v/{n % 2}.mp4", f) for n in range(6) for f in (n, 7, 40_000 + n)} | {("/v/x.mp4", n) for n in range(6)}
    assert {(r["video_path"], r["frame_index"]) for r in table.frames().collect()} == want and table.frames().count() == len(want)
    assert table.read().count() == 5 and len(table.versions()) <= 3  # two videos with two buckets, one with one


def test_batches_fit_their_budget(spark):
    rng = random.Random(8)
    lengths = [int(2 ** rng.uniform(0, 12)) for _ in range(3000)] + [0, None, 99_999]
    df = spark.createDataFrame(list(enumerate(lengths)), "i long, n long").repartition(5)
    rows = batching.token_batches(df, F.col("n"), 4096, "i").collect()
    assert sorted(r["i"] for r in rows) == list(range(len(lengths)))
    by: dict = {}
    for r in rows:
        assert r["tokens"] == max(lengths[r["i"]] or 1, 1) <= r["padded"] <= max(r["tokens"] * 9 / 8, r["tokens"] + 1)
        by.setdefault(r["batch"], []).append(r)
    cost = lambda b: max(r["tokens"] for r in b) * len(b)
    assert all(cost(b) <= 4096 or len(b) == 1 for b in by.values()) and all(b[0]["padded"] * len(b) <= 4096 or len(b) == 1 for b in by.values())
    padded = sum(cost(b) for b in by.values()) - sum(r["tokens"] for r in rows)
    arrival, at = 0, []
    for n in (max(x or 1, 1) for x in lengths):  # the same budget in order of arrival
        if at and max(*at, n) * (len(at) + 1) > 4096:
            arrival += max(at) * len(at) - sum(at)
            at = []
        at.append(n)
    assert padded * 4 < arrival
    again = batching.token_batches(df.repartition(2), F.col("n"), 4096, "i").collect()
    assert {r["i"]: r["batch"] for r in again} == {r["i"]: r["batch"] for r in rows}
    assert batching.token_batches(df.limit(0), F.col("n"), 10, "i").count() == 0


def test_predictions_by_budget_equal_predictions_by_number(spark, monkeypatch):
    s = make_samples(spark, [500, 900, 40]).withColumn("question", F.concat_ws(" ", F.lit("Q"), F.array_repeat(F.lit("w"), F.col("sample_index").cast("int") * 3)))
    rounds = sampling.lazy_rounds(s, MiningConfig(budget_k=2, frame_stride=1))

    def make():
        return lambda items: [f"{i['question'][:2]} {sum(i['frame_indices'])} of {len(items)}" if len(items) <= 8 else 1 / 0 for i in items]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = batching.predict_batches(rounds, s, make, F.size(F.split("question", " ")), 8).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = inference.predict_rounds(rounds, s, make, 1).collect()
    cut = lambda rows: sorted((r["sample_id"], r["round_id"], r["prediction"].split(" of ")[0], tuple(r["frame_indices"]), r["num_frames"]) for r in rows)
    assert cut(got) == cut(want)
    assert {int(r["prediction"].split(" of ")[1]) for r in got if r["sample_id"] == "t_0"} == {2, 8}  # 50 rounds: six batches of 8, one of 2
    assert all(r["input_tokens"] * int(r["prediction"].split(" of ")[1]) <= 8 for r in got)


def test_given_conversation_takes_frames(spark):
    df = spark.range(1).select(conversation(F.lit("Q"), F.array(F.lit("x"))).alias("c"))
    out = df.select(with_frames(F.col("c"), F.array(F.lit(4), F.lit(9))).alias("c"), F.col("c").alias("before")).first()
    assert list(out["c"][1]["content"][0]["video"]) == [4, 9] and out["before"][1]["content"][0]["video"] is None
    assert out["c"][0] == out["before"][0] and out["c"][1]["content"][1] == out["before"][1]["content"][1]


def predictor():
    """A function that makes a predictor, by value: workers can't import this module."""

    def predict(sample, rounds):
        if sample["sample_index"] == 2:
            raise ValueError("can't read")
        return ["(A) Red" if number % 2 else "(B) Green" for number, _ in rounds]

    return lambda: predict


def test_mining_run_resumes(spark, tmp_path):
    config, s = MiningConfig(samples_per_checkpoint=2, budget_k=2, frame_stride=1, batch_size=4), make_samples(spark, [40, 80, 9, 3, 25])
    out = str(tmp_path / "run")
    assert mine_run(s, predictor(), config, out, most=3)["done_now"] == 3
    with pytest.raises(ValueError, match="resume or clear"):
        mine_run(s, predictor(), config, out)
    with pytest.raises(ValueError, match="settings"):
        mine_run(s, predictor(), MiningConfig(), out, resume=True)
    assert mine_run(s, predictor(), config, out, resume=True) == {"already_done": 3, "done_now": 2, "processed_count": 5}
    lines = [json.loads(x["value"]) for x in spark.read.text(f"{out}/records/*").collect()]
    assert sorted(x["unique_id"] for x in lines) == [f"mlvu_dev_t_{i}" for i in (0, 1, 3, 4)]
    failed = spark.read.json(f"{out}/failures").select("sample_id", "error").collect()
    assert [tuple(r) for r in failed] == [("t_2", "can't read")]
    assert mine_run(s, predictor(), config, out, clear=True, sample_index=1)["processed_count"] == 1
    whole = {r["sample_id"]: r for r in mine_lazily(s, predictor(), config).collect()}
    assert whole["t_2"]["mining_result"] is None and "can't read" in whole["t_2"]["traceback"] and whole["t_3"]["num_rounds"] == 1
    assert whole["t_1"]["pos_count"] + whole["t_1"]["neg_count"] == whole["t_1"]["num_rounds"] == 12


def test_mining_command(spark, tmp_path, capsys):
    item = {"video": "a.mp4", "question": "Q", "candidates": ["Red", "Green"], "answer": "Red"}
    (tmp_path / "t 1.json").write_text(json.dumps([item, item, item]))
    spark.createDataFrame([("/v/t 1/a.mp4", 400)], "video_path string, total_frames long").write.parquet(str(tmp_path / "counts"))
    base = ["--json-dir", str(tmp_path), "--video-dir", "/v", "--frame-counts", str(tmp_path / "counts"), "--predictor", "x:y", "--output", str(tmp_path), "--experiment", "e", "--tasks", "t 1"]
    assert mine.main([*base, "--max-samples", "1"], spark, predictor()) == 0
    assert mine.main(base, spark, predictor()) == 1 and "resume or clear" in capsys.readouterr().err
    assert mine.main([*base, "--resume"], spark, predictor()) == 0 and "done before 1, now 2" in capsys.readouterr().out
    assert mine.main([*base, "--resume", "--clear-checkpoint"], spark) == mine.main([*base, "--max-samples", "-1"], spark) == 1
    assert mine.load_predictor("json:dumps") is json.dumps


def test_progress_is_told(spark):
    told = []
    with progress(spark, lambda done, known: told.append((done, known)), 0.05):
        spark.range(0, 1000, 1, 6).selectExpr("id % 3 as k", "id").groupBy("k").count().collect()
    assert told and told[-1][0] == told[-1][1]


def test_resources_reach_the_map(spark):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("accelerator", 1)).build
    s = make_samples(spark, [400])
    rounds = sampling.lazy_rounds(s, MiningConfig())
    plan = lambda p: inference.predict_rounds(rounds, s, lambda: list, profile=p)._jdf.queryExecution().logical().profile()
    assert plan(profile).get().id() == profile.id and not plan(None).isDefined()


def test_written_tables_outlive_new_files(spark, tmp_path):
    """Frames written by a run don't turn up among those that were there before, whatever is computed again."""
    from sparkreel.plans.extraction import run_extraction

    (tmp_path / "r.jsonl").write_text(json.dumps(record("/v/x.mp4", 100, [1, 2, 3])))
    out = tmp_path / "frames"
    first = run_extraction(spark, str(tmp_path / "r.jsonl"), str(out), lambda path, wanted: ((f, b"x") for f in wanted if f != 2))
    assert first["statistics"]["extracted_frames"] == 2 and first["statistics"]["skipped_frames"] == 0 and first["statistics"]["failed_frames"] == 1
    assert dict(first["per_video"].items()) == {"x": {"video_path": "/v/x.mp4", "total_frames": 3, "success": 2, "skipped": 0, "failed": 1}} and len(first["per_video"]) == 1
    assert first["per_video"]["x"]["success"] == 2
    with pytest.raises(KeyError):
        first["per_video"]["y"]
    second = run_extraction(spark, str(tmp_path / "r.jsonl"), str(out), lambda path, wanted: ((f, b"x") for f in wanted))
    assert second["statistics"]["extracted_frames"] == 1 and second["statistics"]["skipped_frames"] == 2
