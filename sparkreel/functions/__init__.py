"""Column functions: answers, paths and names, and the shape of records."""

from .answers import answer_matches, conversation, format_answer, format_question, option_letter, strip
from .paths import frame_filename, join_path, relative_path, sample_id, stem, unique_id
from .records import bucket_json, hit_rate, output_record, rounded_rate, stats_struct

__all__ = [
    "answer_matches", "bucket_json", "conversation", "format_answer", "format_question", "frame_filename", "hit_rate", "join_path",
    "option_letter", "output_record", "relative_path", "rounded_rate", "sample_id", "stats_struct", "stem", "strip", "unique_id",
]
