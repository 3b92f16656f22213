"""One schema per entity, so that no reader infers."""

from __future__ import annotations

ANNOTATIONS = "array<struct<video: string, question: string, candidates: array<string>, answer: string, question_type: string, duration: double>>"
SAMPLES = (
    "sample_id string, sample_index bigint, task_type string, video_path string, video_filename string, question string, "
    "candidates array<string>, answer string, formatted_answer string, duration double, total_frames bigint"
)
ROUNDS = "sample_id string, sample_index bigint, round_id int, frame_indices array<bigint>, remaining_pool_size bigint"
RESULTS = "sample_id string, round_id int, frame_indices array<bigint>, prediction string, input_tokens int, output_tokens int, num_frames int, error string"
BUCKET = "array<struct<round_id: int, frame_indices: array<bigint>, prediction: string>>"
MINING_RESULT = f"struct<pos_bucket: {BUCKET}, neg_bucket: {BUCKET}>"
STATS = "struct<total_rounds: bigint, hit_rate: double, pos_count: bigint, neg_count: bigint>"
RECORDS = f"unique_id string, video_path string, question string, ground_truth string, total_frames bigint, mining_result {MINING_RESULT}, stats {STATS}"
#: What frame collection reads of a record: a JSON scan can't prune inside a struct, so ask for less.
FRAME_INPUT = (
    "video_path string, total_frames bigint, mining_result struct<pos_bucket: array<struct<frame_indices: array<bigint>>>, "
    "neg_bucket: array<struct<frame_indices: array<bigint>>>>"
)
CHECKPOINT = "processed_sample_ids array<string>, total_processed int, last_updated string, config_hash string, output_file string"
EXISTING_FRAMES = "video_name string, frame_index bigint"
FRAME_STATUS = "video_path string, video_name string, frame_index bigint, status string"
