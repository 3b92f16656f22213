"""The query catalogue over the shared test tables, with DuckDB twins.

The tables hold no videos, so documents stand in for samples (characters for frames) and a fixed
rule for a model's answers. Arrays are shown as comma-joined text so that values compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import MiningConfig
from .functions import (
    answer_matches, format_answer, format_question, frame_filename, join_path, option_letter, relative_path, rounded_rate, hit_rate, sample_id, stem, unique_id,
)
from .functions.records import config_digest as _config_digest_column
from .operators import batching, bitmaps, buckets, fill, frames, ordering, sampling, stopping
from .plans import mining
from .sources.checkpoint import unprocessed
from .storage import fresh

CONFIG = MiningConfig()
BASE = "/data/media/"
COLOURS = ("Red", "Green", "Blue", "Yellow")
Query = Callable[[SparkSession, str], DataFrame]


def joined(array: str | Column) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


# Inputs


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    answer = F.element_at(F.array(*map(F.lit, (*COLOURS, "None of these"))), (F.col("doc_id") % 5 + 1).cast("int"))
    out = docs.select(
        F.concat(F.lit("t_"), "lang", F.lit("_"), F.col("doc_id").cast("string")).alias("sample_id"),
        F.col("doc_id").alias("sample_index"),
        F.concat(F.lit("t_"), "lang").alias("task_type"),
        F.concat(F.lit(BASE + "video/"), "lang", F.lit("/"), "source", F.lit(".mp4")).alias("video_path"),
        F.concat("source", F.lit(".mp4")).alias("video_filename"),
        F.concat(F.lit("Which colour has "), "source", F.lit("?")).alias("question"),
        F.array(*map(F.lit, COLOURS)).alias("candidates"),
        answer.alias("answer"),
        F.col("n_chars").alias("total_frames"),
    )
    return out.withColumn("formatted_answer", format_answer(F.col("answer"), F.col("candidates")))


#: What the stand-in model answers, by (31 * sample + 17 * round) mod 11; 10 is an error.
ANSWERS = ("(A) Red", "(B) Green", "(C) Blue", "(D) Yellow", "A", "The answer is C", "Best Option: (D)", "Option B", "zzz", "")


def _answer(with_error: bool = True) -> list[Column]:
    kind = (F.col("sample_index") * 31 + F.col("round_id") * 17) % 11
    text = F.when(kind < 10, F.element_at(F.array(*map(F.lit, ANSWERS)), (F.least(kind, F.lit(9)) + 1).cast("int")))
    return [text.alias("prediction"), F.when(kind == 10, "failed").alias("error")] if with_error else [text.alias("prediction")]


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for every round of every sample, without its frames."""
    s = samples(spark, sf_dir).select("sample_index", "sample_id", "formatted_answer", "total_frames", sampling.actual_rounds(CONFIG).alias("n"))
    rounds = s.where("n > 0").withColumn("round_id", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)))
    return rounds.select("sample_index", "sample_id", "round_id", "formatted_answer", *_answer())


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the frames of each round."""
    return sampling.generate_rounds(samples(spark, sf_dir), CONFIG).select("sample_index", "sample_id", "round_id", "frame_indices", *_answer())


def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.count_buckets(buckets.judge(predictions(spark, sf_dir)), samples(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.score_results(samples(spark, sf_dir), results(spark, sf_dir)).withColumn("line_no", F.col("sample_index"))


_SAMPLES = """samples AS (
  SELECT concat('t_', lang, '_', cast(doc_id AS varchar)) AS sample_id, doc_id AS sample_index, concat('t_', lang) AS task_type,
    concat('/data/media/video/', lang, '/', source, '.mp4') AS video_path, source, n_chars AS total_frames,
    concat('Which colour has ', source, '?') AS question,
    CASE doc_id % 5 WHEN 0 THEN 'Red' WHEN 1 THEN 'Green' WHEN 2 THEN 'Blue' WHEN 3 THEN 'Yellow' ELSE 'None of these' END AS answer,
    CASE doc_id % 5 WHEN 0 THEN '(A) Red' WHEN 1 THEN '(B) Green' WHEN 2 THEN '(C) Blue' WHEN 3 THEN '(D) Yellow' ELSE 'None of these' END AS formatted_answer
  FROM documents)"""
_ANSWER = """CASE (sample_index * 31 + round_id * 17) % 11 WHEN 0 THEN '(A) Red' WHEN 1 THEN '(B) Green' WHEN 2 THEN '(C) Blue'
    WHEN 3 THEN '(D) Yellow' WHEN 4 THEN 'A' WHEN 5 THEN 'The answer is C' WHEN 6 THEN 'Best Option: (D)' WHEN 7 THEN 'Option B'
    WHEN 8 THEN 'zzz' WHEN 9 THEN '' END AS prediction, (sample_index * 31 + round_id * 17) % 11 = 10 AS is_error"""
_PREDICTIONS = f"""{_SAMPLES}, numbered AS (
  SELECT *, unnest(range(0, least(((total_frames + 9) // 10) // 16, 50))) AS round_id FROM samples
), predictions AS (SELECT *, {_ANSWER} FROM numbered)"""
_ROUNDS = f"""{_SAMPLES}, pool AS (
  SELECT sample_id, sample_index, total_frames, unnest(range(0, total_frames, 10)) AS frame_index FROM samples
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sample_index ORDER BY
    md5(concat_ws(':', cast(42 + sample_index AS varchar), cast(frame_index AS varchar))), frame_index) AS rk FROM pool
), rounds AS (
  SELECT sample_id, sample_index, total_frames, (rk - 1) // 16 AS round_id, list_sort(list(frame_index)) AS frames FROM ranked
  WHERE (rk - 1) // 16 < least(((total_frames + 9) // 10) // 16, 50) GROUP BY ALL)"""


def _letter(x: str) -> str:
    bare = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    parts = (r"\(([A-Za-z])\)", r"^([A-Ha-h])", r"(?i)(?:answer|option)\s*(?:is\s*)?([A-Za-z])")
    return "coalesce(" + ", ".join(f"nullif(upper(regexp_extract({bare}, '{p}', 1)), '')" for p in parts) + ")"


_MATCH = f"coalesce({_letter('prediction')} = {_letter('formatted_answer')}, false)"
_JUDGED = f"""{_PREDICTIONS}, judged AS (SELECT *, {_MATCH} AS ok FROM predictions WHERE NOT is_error),
mined AS (
  SELECT s.sample_id, s.sample_index, s.task_type, s.video_path, count(*) FILTER (ok) AS pos_count, count(*) FILTER (NOT ok) AS neg_count
  FROM samples s LEFT JOIN judged j USING (sample_index) GROUP BY ALL)"""
_RESULTS = f"""{_ROUNDS}, results AS (
  SELECT r.*, formatted_answer, video_path, question, {_ANSWER} FROM rounds r JOIN samples s USING (sample_index)
), judged AS (SELECT *, {_MATCH} AS ok FROM results WHERE NOT is_error)"""

# Queries


def _simple(*columns: Callable[[], Column]) -> Query:
    return lambda spark, sf_dir: samples(spark, sf_dir).select("sample_index", *[c() for c in columns])


def sample_rounds_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.generate_rounds(samples(spark, sf_dir), CONFIG).select("sample_index", "round_id", joined("frame_indices").alias("frames"), "remaining_pool_size")


def sample_rounds_mt19937(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.seeded_rounds(samples(spark, sf_dir), CONFIG).select("sample_index", "round_id", joined("frame_indices").alias("frames"), "remaining_pool_size")


def validate_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return sampling.validate_rounds(sampling.generate_rounds(s, CONFIG), s, CONFIG.budget_k).select("sample_index", "valid")


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select("sample_index", "round_id", option_letter(F.col("prediction")).alias("letter"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select("sample_index", "round_id", answer_matches(F.col("prediction"), F.col("formatted_answer")).alias("ok"))


def sample_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        F.col("doc_id").alias("sample_index"),
        sample_id(F.col("lang"), F.col("doc_id")).alias("sample_id"),
        F.coalesce(F.when(F.col("doc_id") % 3 == 0, F.col("source")), "lang").alias("task_type"),
        join_path(F.lit("/data"), F.col("lang"), F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("/abs/"), "source")).otherwise(F.col("source"))).alias("video_path"),
    )


def build_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mining.score_results(samples(spark, sf_dir), results(spark, sf_dir))
    side = lambda b: F.array_join(F.transform(F.col(f"mining_result.{b}_bucket"), lambda r: F.concat_ws("/", r["round_id"].cast("string"), joined(r["frame_indices"]), r["prediction"])), ";").alias(b)
    return m.select("sample_index", side("pos"), side("neg"))


def bucket_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos, neg = F.col("pos_count"), F.col("neg_count")
    return mined(spark, sf_dir).select("sample_index", "pos_count", "neg_count", (pos + neg).alias("total_rounds"), hit_rate(pos, neg).alias("hit_rate"), rounded_rate(pos, neg).alias("rounded"), buckets.sample_class(pos, neg).alias("sample_class"))


def classification_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.classification_stats(mined(spark, sf_dir))


def per_task_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.per_task_stats(mined(spark, sf_dir))


def task_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.task_counts(samples(spark, sf_dir))


def keep_contrastive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.keep_contrastive(mined(spark, sf_dir)).select("sample_index", "pos_count", "neg_count")


def _early(flush: bool, match: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = predictions(spark, sf_dir).select("sample_index", "round_id", "prediction")
        return stopping.stop_early(rows, samples(spark, sf_dir), CONFIG, flush, match).select("sample_index", "round_id", "num_rounds")

    return run


def _early_sql(flush: bool, match: str) -> str:
    hit = _MATCH if match == "letter" else "coalesce(prediction = formatted_answer, false)"
    judged = "true" if flush else "generated >= least(total_frames // 16, 50)"
    return f"""WITH {_PREDICTIONS}, r AS (
      SELECT sample_index, round_id, round_id // 16 AS batch, total_frames, {hit} AS hit, count(*) OVER (PARTITION BY sample_index) AS generated FROM predictions
    ), j AS (SELECT *, ((batch + 1) * 16 <= generated OR {judged}) AS judged FROM r),
    c AS (SELECT *, count_if(hit AND judged) OVER (PARTITION BY sample_index ORDER BY batch) AS hits FROM j),
    s AS (SELECT *, min(CASE WHEN judged AND hits >= 5 THEN batch END) OVER (PARTITION BY sample_index) AS stop FROM c)
    SELECT sample_index, cast(round_id AS integer) AS round_id, cast(CASE WHEN stop IS NULL THEN generated ELSE least((stop + 1) * 16, generated) END AS bigint) AS num_rounds
    FROM s WHERE judged AND (stop IS NULL OR batch <= stop)"""


def live_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    def answer(sample: dict, rounds: list[tuple[int, list[int]]]) -> list[str | None]:
        kinds = [(sample["sample_index"] * 31 + number * 17) % 11 for number, _ in rounds]
        return [known[k] if k < 10 else None for k in kinds]

    known, s = ANSWERS, samples(spark, sf_dir).select("sample_id", "sample_index", "total_frames", "formatted_answer")
    return stopping.ask_lazily(s, answer, CONFIG).select("sample_index", "round_id", "num_rounds")


def lazy_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rounds by random access: each from its number, the seed and the size of the pool."""
    return sampling.lazy_rounds(samples(spark, sf_dir), CONFIG).select("sample_index", "round_id", joined("frame_indices").alias("frames"), "remaining_pool_size")


_LAZY_SQL = f"""WITH {_SAMPLES}, pools AS (
  SELECT sample_index, (total_frames + 9) // 10 AS n FROM samples WHERE total_frames > 0
), digests AS (
  SELECT sample_index, n, i, md5(concat(42 + sample_index, ':', i)) AS d FROM pools, range(0, 48) AS t(i)
), keys AS (
  SELECT sample_index, n, list({{'k': ('0x' || substr(d, 1, 15))::BIGINT % n, 'a': ('0x' || substr(d, 16, 7))::BIGINT + 1, 'b': ('0x' || substr(d, 23, 7))::BIGINT}} ORDER BY i) AS keys
  FROM digests GROUP BY ALL
), places AS (
  SELECT *, unnest(range(0, 16 * least(n // 16, 50))) AS place FROM keys
), steps AS (
  SELECT sample_index, n, place, list_reduce(keys, lambda x, key: {{
    'k': CASE WHEN ((((key.a * greatest(x.k, (key.k + n - x.k) % n) + key.b) % 2147483647) * ((key.a * greatest(x.k, (key.k + n - x.k) % n) + key.b) % 2147483647)) % 2147483647 >> 15) % 2 = 1
      THEN (key.k + n - x.k) % n ELSE x.k END, 'a': 0::BIGINT, 'b': 0::BIGINT}}, {{'k': place, 'a': 0::BIGINT, 'b': 0::BIGINT}}).k AS x
  FROM places
)
SELECT sample_index, cast(place // 16 AS integer) AS round_id, string_agg(cast(x * 10 AS varchar), ',' ORDER BY x) AS frames, cast(n - (place // 16 + 1) * 16 AS bigint) AS remaining_pool_size
FROM steps GROUP BY sample_index, n, place // 16"""


def exact_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates to four places over all documents: of n_chars rounds, 7919 * doc_id mod (n_chars + 1) hit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars > 0")
    pos = (F.col("doc_id") * 7919) % (F.col("n_chars") + 1)
    return docs.select("doc_id", rounded_rate(pos, F.col("n_chars") - pos).alias("rate"))


_EXACT_SQL = """WITH x AS (SELECT doc_id, ((doc_id * 7919) % (n_chars + 1))::DOUBLE / n_chars AS r FROM documents WHERE n_chars > 0),
u AS (SELECT doc_id, r, CASE WHEN r >= 0.0009765625 THEN 4611686018427387904::HUGEINT ELSE 4722366482869645213696::HUGEINT END AS unit FROM x),
v AS (SELECT doc_id, r, unit, CAST(r * CAST(unit AS DOUBLE) AS HUGEINT) * 10000 AS number FROM u),
q AS (SELECT doc_id, r, unit, number // unit AS quotient, number % unit AS rest FROM v)
SELECT doc_id, CASE WHEN r < 9.5367431640625e-07 THEN 0.0::DOUBLE
  ELSE CAST(quotient + CASE WHEN rest * 2 > unit OR (rest * 2 = unit AND quotient % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10000.0::DOUBLE END AS rate FROM q"""


def output_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.records import mined_records

    r = mined_records(records(spark, sf_dir), BASE)
    return r.select("unique_id", "video_path", "question", "ground_truth", "total_frames", "stats.*", joined("mining_result.pos_bucket.round_id").alias("pos_rounds"), joined("mining_result.neg_bucket.round_id").alias("neg_rounds"))


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, written as JSON Lines and read back."""
    import uuid

    from .sources.records import mined_records, read_records, write_records

    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = f"{base}/records-{uuid.uuid4().hex}"
    write_records(mined_records(records(spark, sf_dir), BASE), path)
    r = read_records(spark, path)
    return r.select("unique_id", "video_path", "question", "ground_truth", "total_frames", "stats.*", joined("mining_result.pos_bucket.round_id").alias("pos_rounds"), joined("mining_result.neg_bucket.round_id").alias("neg_rounds"))


_RECORDS_SQL = f"""WITH {_RESULTS}, g AS (
  SELECT sample_index, string_agg(CASE WHEN ok THEN cast(round_id AS varchar) END, ',' ORDER BY round_id) AS pos_rounds,
    string_agg(CASE WHEN NOT ok THEN cast(round_id AS varchar) END, ',' ORDER BY round_id) AS neg_rounds,
    count_if(ok) AS pos, count_if(NOT ok) AS neg FROM judged GROUP BY 1)
SELECT concat('mlvu_dev_', sample_id) AS unique_id, regexp_replace(substr(video_path, 13), '^/+', '') AS video_path, question,
  formatted_answer AS ground_truth, total_frames, cast(coalesce(pos + neg, 0) AS bigint) AS total_rounds,
  CASE WHEN coalesce(pos + neg, 0) = 0 THEN 0.0::double ELSE round_even(pos::double / (pos + neg), 4) END AS hit_rate,
  cast(coalesce(pos, 0) AS bigint) AS pos_count, cast(coalesce(neg, 0) AS bigint) AS neg_count,
  coalesce(pos_rounds, '') AS pos_rounds, coalesce(neg_rounds, '') AS neg_rounds
FROM samples LEFT JOIN g USING (sample_index)"""


def _frames(dilation: int) -> Query:
    return lambda spark, sf_dir: frames.collect_frames(records(spark, sf_dir), dilation)


_WANTED = f"""{_RESULTS}, selected AS (
  SELECT DISTINCT video_path, unnest(frames) AS frame_index FROM judged
), firsts AS (
  SELECT video_path, arg_min(total_frames, sample_index) AS bound FROM samples GROUP BY 1)"""


def _frames_sql(dilation: int) -> str:
    if not dilation:
        rows = "SELECT video_path, frame_index FROM selected"
    else:
        rows = f"""SELECT DISTINCT video_path, f AS frame_index FROM (
          SELECT video_path, unnest(range(frame_index - {dilation}, frame_index + {dilation} + 1)) AS f FROM selected) JOIN firsts USING (video_path)
          WHERE f >= 0 AND f < bound"""
    return f"WITH {_WANTED}, w AS ({rows}) SELECT video_path, regexp_extract(video_path, '([^/]+?)(\\.[^./]+)?/*$', 1) AS video_name, frame_index FROM w"


def _existing(wanted: DataFrame) -> DataFrame:
    """A quarter of the wanted frames, and one per video that nobody asked for."""
    return wanted.where("frame_index % 4 = 0").select("video_name", "frame_index").unionByName(wanted.select("video_name", F.lit(-7).cast("long").alias("frame_index"))).distinct()


_EXISTING = """w AS (SELECT video_path, regexp_extract(video_path, '([^/]+?)(\\.[^./]+)?/*$', 1) AS video_name, frame_index FROM selected),
existing AS (SELECT DISTINCT video_name, frame_index FROM w WHERE frame_index % 4 = 0 UNION SELECT DISTINCT video_name, -7 FROM w)"""


def frames_to_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = frames.collect_frames(records(spark, sf_dir))
    return frames.frames_to_extract(wanted, _existing(wanted))


def extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each video from one pass over its wanted frames."""
    wanted = frames.collect_frames(records(spark, sf_dir))
    existing = _existing(wanted)
    status = F.when(F.col("there"), "present").when(F.col("frame_index") % 7 == 0, "failed").otherwise("success")
    return frames.summarise(frames.flag_existing(wanted, existing).withColumn("status", status), existing)


def tried_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures from wanted frames and the status of those that were tried."""
    wanted = frames.collect_frames(records(spark, sf_dir))
    existing = _existing(wanted)
    status = frames.frames_to_extract(wanted, existing).withColumn("status", F.when(F.col("frame_index") % 7 == 0, "failed").otherwise("success"))
    return frames.per_video_summary(wanted, existing, status)


def token_budget_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in batches of at most 16,384 padded characters, a longer one by itself."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars")
    return batching.token_batches(docs, F.col("n_chars"), 16_384, "doc_id").select("doc_id", "tokens", "padded", "batch")


_BATCHES_SQL = """WITH t AS (SELECT doc_id, greatest(coalesce(n_chars, 1), 1) AS tokens FROM documents),
p AS (SELECT *, greatest(1, (1::BIGINT << cast(floor(log2(tokens + 0.5)) AS integer)) // 8) AS step FROM t),
c AS (SELECT doc_id, tokens, cast(ceil(tokens / step) * step AS bigint) AS padded FROM p),
n AS (SELECT *, row_number() OVER (PARTITION BY padded ORDER BY tokens, doc_id) - 1 AS place FROM c)
SELECT doc_id, cast(tokens AS bigint) AS tokens, padded, concat(padded, '-', place // greatest(16384 // padded, 1)) AS batch FROM n"""


def given_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames put into conversations that were built without them; the first round of each sample that has one."""
    from .functions.answers import conversation, with_frames

    s = samples(spark, sf_dir)
    first = sampling.lazy_rounds(s, CONFIG, F.array(F.lit(0))).select("sample_index", "frame_indices")
    given = s.select("sample_index", conversation(F.col("question"), F.col("candidates"), False).alias("chat")).join(first, "sample_index")
    filled = with_frames(F.col("chat"), F.col("frame_indices"))
    return given.select("sample_index", joined(filled[0]["content"][0]["video"]).alias("frames"), filled[0]["content"][1]["text"].alias("text"))


_GIVEN_SQL = f"""WITH rounds AS ({_LAZY_SQL}), {_SAMPLES} SELECT sample_index, frames,
  concat('Question: ', question, chr(10), 'Options:', chr(10), '(A) Red', chr(10), '(B) Green', chr(10), '(C) Blue', chr(10), '(D) Yellow', chr(10), 'Only give the best option.') AS text
  FROM rounds JOIN samples USING (sample_index) WHERE round_id = 0"""


def unprocessed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return unprocessed(s, s.where("sample_index % 3 = 0")).select("sample_id", "sample_index")


def frame_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rounds of each sample, frames that can't be read taken from the one before."""
    s = samples(spark, sf_dir)
    rounds = sampling.generate_rounds(s, CONFIG).join(s.select("sample_index", "video_path"), "sample_index")
    frames_ = rounds.select("video_path", F.explode("frame_indices").alias("frame_index")).distinct().where("frame_index % 7 <> 0").withColumn("image", F.concat(F.lit("i"), F.col("frame_index").cast("string")))
    return fill.fill_frames(rounds, frames_, "black").select("sample_id", "round_id", F.col("position").cast("long").alias("position"), "frame_index", "image")


frame_fill_all = frame_fill


def _bitmap_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.videos(records(spark, sf_dir)).select("video_path", "total_frames")


def collect_frames_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted frames over bitmaps: what is shuffled is a bitmap for each video and task, not a row for each frame."""
    return bitmaps.list_bits(bitmaps.named(bitmaps.collect_bitmaps(records(spark, sf_dir)))).select("video_path", "video_name", "frame_index")


def dilate_frames_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = bitmaps.dilate(bitmaps.collect_bitmaps(records(spark, sf_dir)), 2, _bitmap_bounds(spark, sf_dir))
    return bitmaps.list_bits(bitmaps.named(wide)).select("video_path", "video_name", "frame_index")


def frames_to_extract_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = bitmaps.named(bitmaps.collect_bitmaps(records(spark, sf_dir)))
    existing = bitmaps.from_frames(_existing(bitmaps.list_bits(wanted)), "video_name")
    return bitmaps.list_bits(bitmaps.difference(wanted, existing, "video_name")).select("video_path", "video_name", "frame_index")


def video_frame_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct frames of each video, counted in the bitmaps."""
    return bitmaps.count_frames(bitmaps.collect_bitmaps(records(spark, sf_dir)), "video_path")


def frame_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each document, written and read back by the data source; the bound on frame_index is the reader's."""
    from .sources.frame_source import FrameFiles

    spark.dataSource.register(FrameFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    path = fresh(spark, "store")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.coalesce("source", F.lit("none")).alias("video_name"), F.col("doc_id").alias("frame_index"), F.coalesce("text", F.lit("")).cast("binary").alias("image"))
    rows.write.format("frame_files").mode("append").save(path)
    back = spark.read.format("frame_files").load(path).where("frame_index >= 100")
    return back.select("video_name", "frame_index", F.md5("image").alias("digest"))


def stream_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wanted frames by a stream over record files, stopped and started again in between."""
    from .streaming.collect import FrameTable, collect_stream

    base = fresh(spark, "stream")
    rows = records(spark, sf_dir).select("video_path", "total_frames", "mining_result")
    table = FrameTable(spark, f"{base}/table")
    for part in (0, 1):
        written_ = rows.where(F.pmod(F.xxhash64("video_path", "total_frames"), F.lit(2)) == part)
        written_.repartition(3).write.mode("append").json(f"{base}/in")
        collect_stream(spark, f"{base}/in", table, f"{base}/state", 1).awaitTermination()
    return table.frames()


def committed_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples worked off in slices of 300, with a compaction on the way: which are done, and what is left (none)."""
    from .sources.commits import CommitLog, in_commits, remaining

    base, s = fresh(spark, "run"), samples(spark, sf_dir).select("sample_id", "sample_index")
    log, config = CommitLog(spark, f"{base}/log"), MiningConfig(samples_per_checkpoint=max(300, -(-s.count() // 4)))
    write = lambda rows, name: rows.write.mode("overwrite").parquet(f"{base}/out/slice={name}")
    in_commits(s, log, config, base, lambda part: part, write, most=2 * config.samples_per_checkpoint)
    log.compact()
    in_commits(s, log, config, base, lambda part: part, write)
    rows = spark.read.parquet(f"{base}/out").groupBy("sample_id").agg(F.count("*").alias("times"))
    left = remaining(s, log).select("sample_id", F.lit(-1).cast("long").alias("times"))
    return log.done().select("sample_id").distinct().join(rows, "sample_id", "left").select("sample_id", "times").unionByName(left)


def resumed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after commits of every third sample, by an anti-join with the log."""
    from .sources.commits import CommitLog, remaining

    s = samples(spark, sf_dir)
    log = CommitLog(spark, fresh(spark, "log"))
    for part in range(3):
        log.commit(s.where(f"sample_index % 9 = {3 * part}"), CONFIG, "out")
        if part == 1:
            log.compact()
    return remaining(s, log).select("sample_id", "sample_index")


def worker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return s.select("sample_index", ordering.worker_of("sample_index", s.count(), 7).alias("worker"))


def results_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sample stands in the order of its task's ids as text: its place among all, less the task's first."""
    placed = ordering.numbered(samples(spark, sf_dir).select("task_type", "sample_id"), "task_type", "sample_id")
    firsts = placed.groupBy("task_type").agg(F.min("position").alias("first"))
    return placed.join(firsts, "task_type").select("task_type", "sample_id", (F.col("position") - F.col("first") + 1).alias("place"))


def config_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct(F.col("r_regionkey").alias("budget_k"), F.col("r_name").alias("model_name")))
    return spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", F.substring(F.md5(text.cast("binary")), 1, 16).alias("config_hash"))


def mining_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples to rounds, answers, early stop, buckets and statistics by task."""
    m = mining.mine_table(samples(spark, sf_dir), results(spark, sf_dir), CONFIG)
    return buckets.per_task_stats(m)


def _shared(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share."""
    import uuid

    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as videos whose names hold what paths and URLs treat apart."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_regionkey", "n_name")
    name = F.concat("n_name", F.element_at(F.array(*map(F.lit, ODD_NAMES)), (F.col("n_nationkey") % 5 + 1).cast("int")))
    return n.withColumns({"video_name": name, "video_path": F.concat(F.lit("/v/"), name, F.lit(".mp4")), "total_frames": (F.col("n_nationkey") % 4).cast("long")})


ODD_NAMES = ("", " a+b", " 50%off", "#1", " é日")
_NATIONS = """n AS (SELECT *, concat('/v/', video_name, '.mp4') AS video_path FROM (
  SELECT cast(n_nationkey AS bigint) AS k, cast(n_regionkey AS bigint) AS r, concat(n_name, ['', ' a+b', ' 50%off', '#1', ' é日'][n_nationkey % 5 + 1]) AS video_name, cast(n_nationkey % 4 AS bigint) AS total_frames FROM nation))"""


def _image(path: str, frames_: list[int]):
    """Stands for a video decoder; frame 2 of a video can't be read."""
    for f in frames_:
        if f != 2:
            yield f, f"{path}:{f}".encode()


def list_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of all videos written to files, and the files listed."""
    from .sources.frames import extract_frames, list_frames

    folder, v = _shared(spark, "frames"), _nations(spark, sf_dir)
    wanted = v.where("total_frames > 0").select("video_path", "video_name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total_frames") - 1)).alias("frame_index"))
    extract_frames(wanted, _image, folder).write.format("noop").mode("overwrite").save()
    return list_frames(spark, folder)


def extract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each frame in a second run, after the first wrote all that can be read."""
    from .sources.frames import extract_frames, list_frames

    folder, v = _shared(spark, "frames"), _nations(spark, sf_dir)
    wanted = v.where("total_frames > 0").select("video_path", "video_name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total_frames") - 1)).alias("frame_index"))
    extract_frames(wanted.where("frame_index = 0"), _image, folder).write.format("noop").mode("overwrite").save()
    return extract_frames(frames.frames_to_extract(wanted, list_frames(spark, folder)), _image, folder)


def decode_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.frames import whole_videos

    return whole_videos(_nations(spark, sf_dir).select("video_path", "total_frames"), _image).withColumn("image", F.col("image").cast("string"))


def decode_at_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.frames import decode_frames

    wanted = _nations(spark, sf_dir).select("video_path", F.explode(F.array(F.lit(2).cast("long"), F.col("n_nationkey").cast("long"), F.lit(99).cast("long"))).alias("frame_index")).distinct()
    return decode_frames(wanted, _image, 20).withColumn("image", F.col("image").cast("string"))


def probe_frame_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame counts by a probe that fails for some videos."""
    from .sources.annotations import probe_frame_counts

    def probe(path: str) -> int:
        if "#" in path:
            raise OSError(path)
        return len(path)

    return probe_frame_counts(_nations(spark, sf_dir).select("video_path"), probe)


def annotation_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question files (one a region, one more missing) to samples of videos that have frames."""
    import json

    from .sources.annotations import build_samples, read_annotations
    from pyarrow import fs

    folder = _shared(spark, "questions")
    files, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    files.create_dir(path, recursive=True)
    rows = _nations(spark, sf_dir).orderBy("n_nationkey").collect()  # 25 nations
    tasks = [f"{r} t+{r}%" for r in range(5)]
    for r, task in enumerate(tasks):
        items = [{"video": x["video_name"] + ".mp4", "question": f"Q{x['n_nationkey']}?", "candidates": ["Red", x["n_name"]], "answer": x["n_name"]} | ({"question_type": "own", "duration": 1.5} if x["n_nationkey"] % 3 == 0 else {}) for x in rows if x["n_regionkey"] == r]
        with files.open_output_stream(f"{path}/{task}.json") as out:
            out.write(json.dumps(items).encode())
    items = read_annotations(spark, folder, [*tasks, "missing"])
    counts = _nations(spark, sf_dir).select(F.concat(F.lit("/v/"), F.concat(F.col("n_regionkey").cast("string"), F.lit(" t+"), F.col("n_regionkey").cast("string"), F.lit("%/")), "video_name", F.lit(".mp4")).alias("video_path"), "total_frames")
    return build_samples(items, "/v", counts).withColumn("candidates", F.array_join("candidates", ","))


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.videos(records(spark, sf_dir))


def extraction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.extraction_totals(extraction_summary(spark, sf_dir))


def record_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a record file after it is written, appended to and cleared."""
    from .sources.records import append_records, clear_records, count_records, mined_records, write_records

    path, r = _shared(spark, "records"), mined_records(records(spark, sf_dir), BASE)
    absent, written = count_records(spark, path), write_records(r, path)
    appended = append_records(r, path)
    lines = count_records(spark, path)
    clear_records(spark, path)
    return spark.createDataFrame([(absent, written, appended, lines, count_records(spark, path))], "absent long, written long, appended long, lines long, cleared long")


def conversations_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of each sample as JSON, with three frames put in."""
    from .functions import conversation

    chat = conversation(F.col("question"), F.col("candidates"), True, F.array(*[F.lit(x).cast("long") for x in (1, 2, 3)]))
    return samples(spark, sf_dir).select("sample_index", F.to_json(chat).alias("messages"))


def config_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of a whole configuration, for several seeds."""
    seed = F.col("r_regionkey").cast("long")
    return spark.read.parquet(f"{sf_dir}/region.parquet").select(seed.alias("seed"), _config_digest_column(CONFIG, "random_seed", seed).alias("config_hash"))


def _config_digest_sql() -> str:
    import json

    before, after = json.dumps(CONFIG.to_dict(), sort_keys=True).split('"random_seed": 42')
    return f"SELECT cast(r_regionkey AS bigint) AS seed, substr(md5(concat('{before}\"random_seed\": ', r_regionkey, '{after}')), 1, 16) AS config_hash FROM region"


def predict_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is made once, takes three rounds at a time at most, and fails on some."""
    from .operators.inference import OutOfMemory, predict_rounds

    known = ANSWERS

    def make():
        def answer(items: list[dict]) -> list[str]:
            if len(items) > 3:
                raise OutOfMemory
            kinds = [sum(i["frame_indices"]) % 11 for i in items]
            if 10 in kinds:
                raise RuntimeError("failed")
            return [f" {known[k]} " for k in kinds]

        return answer

    s = samples(spark, sf_dir)
    out = predict_rounds(sampling.generate_rounds(s, CONFIG), s, make, CONFIG.batch_size)
    return out.select("sample_id", "round_id", "prediction", "input_tokens", "output_tokens", "num_frames", "error")


def sample_at_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.at_index(samples(spark, sf_dir), 17).select("sample_id", "sample_index", "total_frames")


def sample_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return ordering.by_id(s.withColumn("sample_id", F.col("task_type")), "t_en").select("sample_id", "sample_index")


def picked_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return ordering.pick(s, s.where("total_frames % 3 = 0").select("sample_index")).select("sample_id", "sample_index")


def samples_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.by_sample_id(samples(spark, sf_dir).select("sample_id", "sample_index"))


def tasks_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.tasks_by_name(samples(spark, sf_dir))


def invalid_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of which some are out of order, of another size, outside the video, drawn twice, empty or null."""
    s = samples(spark, sf_dir)
    f, kind = F.col("frame_indices"), F.col("sample_index") % 8
    spoilt = F.when(kind == 1, F.reverse(f)).when(kind == 2, F.slice(f, 1, 3)).when(kind == 3, F.transform(f, lambda x: x + 1_000_000_000)).when(kind == 4, F.array_repeat(f[0], 16)).when(kind == 5, F.concat(F.slice(f, 1, 15), F.array(F.lit(None).cast("long")))).when(kind == 6, F.array().cast("array<bigint>")).when(kind < 6, f)
    rounds = sampling.generate_rounds(s, CONFIG).withColumn("frame_indices", spoilt)
    return sampling.validate_rounds(rounds, s, CONFIG.budget_k).select("sample_index", "valid")


_TASKS = """SELECT task_type, cast(count(*) AS bigint) AS total_samples,
  cast(count_if(pos_count > 0 AND neg_count > 0) AS bigint) AS has_both, cast(count_if(pos_count > 0 AND neg_count = 0) AS bigint) AS all_correct,
  cast(count_if(pos_count = 0 AND neg_count > 0) AS bigint) AS all_incorrect, cast(count_if(pos_count + neg_count = 0) AS bigint) AS no_valid_results,
  cast(sum(pos_count + neg_count) AS bigint) AS total_rounds, cast(sum(pos_count) AS bigint) AS total_pos, cast(sum(neg_count) AS bigint) AS total_neg
FROM mined GROUP BY 1"""
_END_TO_END = f"""WITH {_PREDICTIONS}, r AS (
  SELECT sample_index, round_id, round_id // 16 AS batch, is_error, {_MATCH} AS ok, coalesce(prediction = formatted_answer, false) AS hit FROM predictions
), c AS (SELECT *, count_if(hit) OVER (PARTITION BY sample_index ORDER BY batch) AS hits FROM r),
s AS (SELECT *, min(CASE WHEN hits >= 5 THEN batch END) OVER (PARTITION BY sample_index) AS stop FROM c),
kept AS (SELECT * FROM s WHERE (stop IS NULL OR batch <= stop) AND NOT is_error),
mined AS (SELECT x.sample_index, x.task_type, count(*) FILTER (ok) AS pos_count, count(*) FILTER (NOT ok) AS neg_count FROM samples x LEFT JOIN kept USING (sample_index) GROUP BY ALL)
{_TASKS}"""


_FILL_SQL = f"""WITH {_ROUNDS}, places AS (
              SELECT sample_id, cast(round_id AS integer) AS round_id, unnest(frames) AS frame_index, unnest(range(0, 16)) AS position FROM rounds
            ) SELECT sample_id, round_id, cast(position AS bigint) AS position, frame_index,
              coalesce(last_value(CASE WHEN frame_index % 7 <> 0 THEN concat('i', frame_index) END IGNORE NULLS) OVER (PARTITION BY sample_id, round_id ORDER BY position ROWS UNBOUNDED PRECEDING), 'black') AS image FROM places"""


_SUMMARY_SQL = f"""WITH {_WANTED}, {_EXISTING}, todo AS (SELECT * FROM w ANTI JOIN existing USING (video_name, frame_index)),
            have AS (SELECT video_name, count(*) AS n FROM existing GROUP BY 1),
            both_ AS (SELECT video_path, count(*) AS n FROM w SEMI JOIN existing USING (video_name, frame_index) GROUP BY 1),
            done AS (SELECT video_path, count_if(frame_index % 7 <> 0) AS ok, count_if(frame_index % 7 = 0) AS bad FROM todo GROUP BY 1)
            SELECT video_path, w.video_name, cast(count(*) AS bigint) AS total_frames, cast(coalesce(any_value(ok), 0) AS bigint) AS success,
              cast(coalesce(any_value(have.n), 0) AS bigint) AS skipped, cast(coalesce(any_value(both_.n), 0) AS bigint) AS skipped_requested, cast(coalesce(any_value(bad), 0) AS bigint) AS failed
            FROM w LEFT JOIN have USING (video_name) LEFT JOIN both_ USING (video_path) LEFT JOIN done USING (video_path) GROUP BY 1, 2"""


def queries() -> dict[str, Query]:
    return {
        "frame_pool_size": _simple(lambda: sampling.pool_size(CONFIG.frame_stride).alias("pool_size")),
        "expected_rounds": _simple(lambda: sampling.expected_rounds(CONFIG).alias("rounds")),
        "actual_rounds": _simple(lambda: sampling.actual_rounds(CONFIG).alias("rounds")),
        "sample_rounds_hash": sample_rounds_hash,
        "sample_rounds_mt19937": sample_rounds_mt19937,
        "lazy_rounds": lazy_rounds,
        "exact_rates": exact_rates,
        "validate_rounds": validate_rounds,
        "option_letter": letters,
        "mcq_match": matches,
        "format_answer": _simple(lambda: format_answer(F.col("answer"), F.col("candidates")).alias("formatted")),
        "format_question": _simple(lambda: format_question(F.col("question"), F.col("candidates")).alias("prompt")),
        "video_path_relative": _simple(lambda: relative_path(F.col("video_path"), BASE).alias("path")),
        "video_stem": _simple(lambda: stem(F.col("video_path")).alias("name")),
        "frame_filename": _simple(lambda: frame_filename(F.col("total_frames") * 100).alias("name")),
        "unique_id": _simple(lambda: unique_id(F.col("sample_id")).alias("id")),
        "sample_identity": sample_identity,
        "build_buckets": build_buckets,
        "bucket_stats": bucket_stats,
        "classification_stats": classification_stats,
        "per_task_stats": per_task_stats,
        "task_counts": task_counts,
        "keep_contrastive": keep_contrastive,
        "early_stop_compat": _early(False, "exact"),
        "early_stop_flush": _early(True, "exact"),
        "early_stop_letter": _early(True, "letter"),
        "live_early_stop": live_early_stop,
        "output_records": output_records,
        "jsonl_round_trip": jsonl_round_trip,
        "collect_frames": _frames(0),
        "dilate_frames_1": _frames(1),
        "dilate_frames_2": _frames(2),
        "frames_to_extract": frames_to_extract,
        "extraction_summary": extraction_summary,
        "tried_summary": tried_summary,
        "token_budget_batches": token_budget_batches,
        "given_conversations": given_conversations,
        "unprocessed_samples": unprocessed_samples,
        "resumed_samples": resumed_samples,
        "committed_slices": committed_slices,
        "collect_frames_bitmap": collect_frames_bitmap,
        "dilate_frames_bitmap": dilate_frames_bitmap,
        "frames_to_extract_bitmap": frames_to_extract_bitmap,
        "video_frame_counts": video_frame_counts,
        "frame_store": frame_store,
        "stream_collect": stream_collect,
        "frame_fill": frame_fill,
        "frame_fill_all": frame_fill,
        "worker_split": worker_split,
        "results_sorted": results_sorted,
        "config_hash": config_hash,
        "mining_end_to_end": mining_end_to_end,
        "list_frames": list_frames,
        "extract_status": extract_status,
        "decode_whole": decode_whole,
        "decode_at_indices": decode_at_indices,
        "probe_frame_counts": probe_frame_counts,
        "annotation_samples": annotation_samples,
        "videos": videos,
        "extraction_totals": extraction_totals,
        "record_file_counts": record_file_counts,
        "conversation": conversations_,
        "config_digest": config_digest,
        "predict_rounds": predict_rounds,
        "sample_at_index": sample_at_index,
        "sample_by_id": sample_by_id,
        "picked_samples": picked_samples,
        "samples_in_order": samples_in_order,
        "tasks_by_name": tasks_by_name,
        "invalid_rounds": invalid_rounds,
    }


def oracle_sql() -> dict[str, str]:
    simple = lambda c: f"WITH {_SAMPLES} SELECT sample_index, {c} FROM samples"
    return {
        "frame_pool_size": simple("cast((total_frames + 9) // 10 AS bigint) AS pool_size"),
        "expected_rounds": simple("cast(least(total_frames // 16, 50) AS bigint) AS rounds"),
        "actual_rounds": simple("cast(least(((total_frames + 9) // 10) // 16, 50) AS bigint) AS rounds"),
        "sample_rounds_hash": f"WITH {_ROUNDS} SELECT sample_index, cast(round_id AS integer) AS round_id, array_to_string(frames, ',') AS frames, cast((total_frames + 9) // 10 - (round_id + 1) * 16 AS bigint) AS remaining_pool_size FROM rounds",
        "lazy_rounds": _LAZY_SQL,
        "exact_rates": _EXACT_SQL,
        "validate_rounds": f"WITH {_ROUNDS} SELECT DISTINCT sample_index, true AS valid FROM rounds",
        "option_letter": f"WITH {_PREDICTIONS} SELECT sample_index, cast(round_id AS integer) AS round_id, {_letter('prediction')} AS letter FROM predictions",
        "mcq_match": f"WITH {_PREDICTIONS} SELECT sample_index, cast(round_id AS integer) AS round_id, {_MATCH} AS ok FROM predictions",
        "format_answer": simple("formatted_answer AS formatted"),
        "format_question": simple("concat('Question: ', question, chr(10), 'Options:', chr(10), '(A) Red', chr(10), '(B) Green', chr(10), '(C) Blue', chr(10), '(D) Yellow') AS prompt"),
        "video_path_relative": simple("regexp_replace(substr(video_path, 13), '^/+', '') AS path"),
        "video_stem": simple("regexp_extract(video_path, '([^/]+?)(\\.[^./]+)?/*$', 1) AS name"),
        "frame_filename": simple("printf('%06d.jpg', total_frames * 100) AS name"),
        "unique_id": simple("concat('mlvu_dev_', sample_id) AS id"),
        "sample_identity": "SELECT doc_id AS sample_index, concat(lang, '_', doc_id) AS sample_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS task_type, CASE WHEN doc_id % 7 = 0 THEN concat('/abs/', source) ELSE concat('/data/', lang, '/', source) END AS video_path FROM documents",
        "build_buckets": f"""WITH {_RESULTS}, g AS (SELECT sample_index,
            string_agg(CASE WHEN ok THEN concat(round_id, '/', array_to_string(frames, ','), '/', prediction) END, ';' ORDER BY round_id) AS pos,
            string_agg(CASE WHEN NOT ok THEN concat(round_id, '/', array_to_string(frames, ','), '/', prediction) END, ';' ORDER BY round_id) AS neg FROM judged GROUP BY 1)
            SELECT sample_index, coalesce(pos, '') AS pos, coalesce(neg, '') AS neg FROM samples LEFT JOIN g USING (sample_index)""",
        "bucket_stats": f"""WITH {_JUDGED} SELECT sample_index, pos_count, neg_count, pos_count + neg_count AS total_rounds,
            CASE WHEN pos_count + neg_count = 0 THEN 0.0::double ELSE pos_count::double / (pos_count + neg_count) END AS hit_rate,
            CASE WHEN pos_count + neg_count = 0 THEN 0.0::double ELSE round_even(pos_count::double / (pos_count + neg_count), 4) END AS rounded,
            CASE WHEN pos_count > 0 AND neg_count > 0 THEN 'has_both' WHEN pos_count > 0 THEN 'all_correct' WHEN neg_count > 0 THEN 'all_incorrect' ELSE 'no_valid_results' END AS sample_class FROM mined""",
        "classification_stats": f"""WITH {_JUDGED} SELECT cast(count(*) AS bigint) AS total, cast(count_if(pos_count > 0 AND neg_count > 0) AS bigint) AS has_both,
            cast(count_if(pos_count > 0 AND neg_count = 0) AS bigint) AS all_correct, cast(count_if(pos_count = 0 AND neg_count > 0) AS bigint) AS all_incorrect,
            cast(count_if(pos_count + neg_count = 0) AS bigint) AS no_valid_results FROM mined""",
        "per_task_stats": f"WITH {_JUDGED} {_TASKS}",
        "task_counts": f"WITH {_SAMPLES} SELECT task_type, cast(count(*) AS bigint) AS n FROM samples GROUP BY 1",
        "keep_contrastive": f"WITH {_JUDGED} SELECT sample_index, pos_count, neg_count FROM mined WHERE pos_count > 0 AND neg_count > 0",
        "early_stop_compat": _early_sql(False, "exact"),
        "early_stop_flush": _early_sql(True, "exact"),
        "early_stop_letter": _early_sql(True, "letter"),
        "live_early_stop": _early_sql(True, "exact"),
        "output_records": _RECORDS_SQL,
        "jsonl_round_trip": _RECORDS_SQL,
        "collect_frames": _frames_sql(0),
        "dilate_frames_1": _frames_sql(1),
        "dilate_frames_2": _frames_sql(2),
        "frames_to_extract": f"WITH {_WANTED}, {_EXISTING} SELECT video_path, video_name, frame_index FROM w ANTI JOIN existing USING (video_name, frame_index)",
        "extraction_summary": _SUMMARY_SQL,
        "tried_summary": _SUMMARY_SQL,
        "token_budget_batches": _BATCHES_SQL,
        "given_conversations": _GIVEN_SQL,
        "resumed_samples": f"WITH {_SAMPLES} SELECT sample_id, sample_index FROM samples WHERE sample_index % 3 <> 0",
        "committed_slices": f"WITH {_SAMPLES} SELECT sample_id, count(*) AS times FROM samples GROUP BY 1",
        "collect_frames_bitmap": _frames_sql(0),
        "dilate_frames_bitmap": _frames_sql(2),
        "frames_to_extract_bitmap": f"WITH {_WANTED}, {_EXISTING} SELECT video_path, video_name, frame_index FROM w ANTI JOIN existing USING (video_name, frame_index)",
        "video_frame_counts": f"WITH {_WANTED} SELECT video_path, count(*) AS n FROM selected GROUP BY 1",
        "frame_store": "SELECT coalesce(source, 'none') AS video_name, doc_id AS frame_index, md5(coalesce(text, '')) AS digest FROM documents WHERE doc_id >= 100",
        "stream_collect": _frames_sql(0),
        "unprocessed_samples": f"WITH {_SAMPLES} SELECT sample_id, sample_index FROM samples WHERE sample_index % 3 <> 0",
        "frame_fill": _FILL_SQL,
        "frame_fill_all": _FILL_SQL,
        "worker_split": f"WITH {_SAMPLES} SELECT sample_index, cast(least(sample_index // ((SELECT count(*) FROM samples) // 7), 6) AS bigint) AS worker FROM samples",
        "results_sorted": f"WITH {_SAMPLES} SELECT task_type, sample_id, row_number() OVER (PARTITION BY task_type ORDER BY sample_id) AS place FROM samples",
        "config_hash": "SELECT r_regionkey, substr(md5(concat('{\"budget_k\":', r_regionkey, ',\"model_name\":\"', r_name, '\"}')), 1, 16) AS config_hash FROM region",
        "mining_end_to_end": _END_TO_END,
        "list_frames": f"WITH {_NATIONS} SELECT video_name, f AS frame_index FROM (SELECT video_name, unnest(range(0, total_frames)) AS f FROM n) WHERE f <> 2",
        "extract_status": f"WITH {_NATIONS} SELECT video_path, video_name, f AS frame_index, CASE f WHEN 2 THEN 'failed' ELSE 'success' END AS status FROM (SELECT *, unnest(range(0, total_frames)) AS f FROM n) WHERE f <> 0",
        "decode_whole": f"WITH {_NATIONS} SELECT video_path, f AS frame_index, concat(video_path, ':', f) AS image FROM (SELECT *, unnest(range(0, total_frames)) AS f FROM n) WHERE f <> 2",
        "decode_at_indices": f"WITH {_NATIONS} SELECT video_path, k AS frame_index, concat(video_path, ':', k) AS image FROM n WHERE k <> 2 AND k < 20",
        "probe_frame_counts": f"WITH {_NATIONS} SELECT video_path, cast(CASE WHEN contains(video_path, '#') THEN -1 ELSE length(video_path) END AS bigint) AS total_frames FROM n",
        "annotation_samples": f"""WITH {_NATIONS}, i AS (SELECT *, concat(r, ' t+', r, '%') AS task, row_number() OVER (PARTITION BY r ORDER BY k) - 1 AS position FROM n)
            SELECT concat(task, '_', position) AS sample_id, cast(row_number() OVER (ORDER BY r, position) - 1 AS bigint) AS sample_index,
              CASE WHEN k % 3 = 0 THEN 'own' ELSE task END AS task_type, concat('/v/', task, '/', video_name, '.mp4') AS video_path, concat(video_name, '.mp4') AS video_filename,
              concat('Q', k, '?') AS question, concat('Red,', n_name) AS candidates, n_name AS answer, concat('(B) ', n_name) AS formatted_answer,
              CASE WHEN k % 3 = 0 THEN 1.5::double ELSE 0.0::double END AS duration, total_frames
            FROM i JOIN nation ON n_nationkey = k WHERE total_frames > 0""",
        "videos": f"""WITH {_SAMPLES}, v AS (SELECT video_path, regexp_extract(video_path, '([^/]+?)(\\.[^./]+)?/*$', 1) AS video_name, count(*) AS sample_count, arg_min(total_frames, sample_index) AS total_frames FROM samples GROUP BY 1)
            SELECT video_path, video_name, cast(sample_count AS bigint) AS sample_count, total_frames, count(*) OVER (PARTITION BY video_name) > 1 AS stem_collision FROM v""",
        "extraction_totals": f"""WITH {_WANTED}, {_EXISTING}, todo AS (SELECT * FROM w ANTI JOIN existing USING (video_name, frame_index)),
            v AS (SELECT DISTINCT video_path, video_name FROM w), have AS (SELECT video_name, count(*) AS n FROM existing GROUP BY 1)
            SELECT cast((SELECT count(*) FROM v) AS bigint) AS total_videos, cast((SELECT count(*) FROM w) AS bigint) AS total_frames,
              cast((SELECT count_if(frame_index % 7 <> 0) FROM todo) AS bigint) AS extracted_frames, cast((SELECT sum(n) FROM v JOIN have USING (video_name)) AS bigint) AS skipped_frames,
              cast((SELECT count_if(frame_index % 7 = 0) FROM todo) AS bigint) AS failed_frames""",
        "record_file_counts": "SELECT cast(0 AS bigint) AS absent, count(*) AS written, count(*) AS appended, 2 * count(*) AS lines, cast(0 AS bigint) AS cleared FROM documents",
        "conversation": simple("""concat('[{"role":"system","text":"', 'Carefully watch this video and pay attention to every detail. Based on your observations, select the best option that accurately addresses the question.',
            '"},{"role":"user","content":[{"type":"video","video":[1,2,3]},{"type":"text","text":"Question: ', question, '\\nOptions:\\n(A) Red\\n(B) Green\\n(C) Blue\\n(D) Yellow\\nOnly give the best option."}]}]') AS messages"""),
        "config_digest": _config_digest_sql(),
        "predict_rounds": f"""WITH {_ROUNDS}, k AS (SELECT *, cast(list_sum(frames) % 11 AS bigint) AS kind FROM rounds)
            SELECT sample_id, cast(round_id AS integer) AS round_id, a AS prediction, CASE WHEN kind < 10 THEN cast(4 AS integer) END AS input_tokens,
              CASE WHEN kind < 10 THEN cast(len(list_filter(string_split(a, ' '), lambda x: x <> '')) AS integer) END AS output_tokens, CASE WHEN kind < 10 THEN cast(16 AS integer) END AS num_frames,
              CASE WHEN kind = 10 THEN 'RuntimeError: failed' END AS error
            FROM (SELECT *, ['(A) Red', '(B) Green', '(C) Blue', '(D) Yellow', 'A', 'The answer is C', 'Best Option: (D)', 'Option B', 'zzz', '', NULL][kind + 1] AS a FROM k)""",
        "sample_at_index": f"WITH {_SAMPLES} SELECT sample_id, sample_index, total_frames FROM samples WHERE sample_index = 17",
        "sample_by_id": f"WITH {_SAMPLES} SELECT task_type AS sample_id, min(sample_index) AS sample_index FROM samples WHERE task_type = 't_en' GROUP BY 1",
        "picked_samples": f"WITH {_SAMPLES} SELECT sample_id, sample_index FROM samples WHERE total_frames % 3 = 0",
        "samples_in_order": f"WITH {_SAMPLES} SELECT sample_id, sample_index FROM samples ORDER BY 1",
        "tasks_by_name": f"WITH {_SAMPLES} SELECT task_type, count(*) AS samples, cast(sum(total_frames) AS bigint) AS frames FROM samples GROUP BY 1 ORDER BY 1",
        "invalid_rounds": f"WITH {_ROUNDS} SELECT DISTINCT sample_index, sample_index % 8 = 0 AS valid FROM rounds",
    }
