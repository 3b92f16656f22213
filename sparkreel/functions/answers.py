"""Option letters, answer matching and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a letter may stand, in order of precedence.
LETTER_PATTERNS = (r"\(([A-Za-z])\)", r"^([A-Ha-h])", r"(?i)(?:answer|option)\s*(?:is\s*)?([A-Za-z])")
#: The prompt.
SYSTEM_PROMPT = (
    "Carefully watch this video and pay attention to every detail. Based on your observations, "
    "select the best option that accurately addresses the question."
)
ASK = "Only give the best option."


def strip(text: Column) -> Column:
    """Without white space at either end, Unicode white space and the ASCII separators included."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def option_letter(text: Column) -> Column:
    """The option letter of an answer, upper case, or null.

    A letter in brackets anywhere wins, then a first character A to H, then the letter after
    "answer" or "option" (with or without "is").
    """
    bare = strip(text)
    found = [F.nullif(F.upper(F.regexp_extract(bare, p, 1)), F.lit("")) for p in LETTER_PATTERNS]
    return F.coalesce(*found)


def answer_matches(prediction: Column, truth: Column) -> Column:
    """Both have a letter and it is the same; never null."""
    return F.coalesce(option_letter(prediction) == option_letter(truth), F.lit(False))


def _letter(position: Column) -> Column:
    return F.chr(position + 64)


def format_answer(answer: Column, candidates: Column) -> Column:
    """``(B) text`` for the first candidate equal to the answer, else the answer as it is."""
    at = F.array_position(candidates, answer)
    return F.when(at > 0, F.concat(F.lit("("), _letter(at), F.lit(") "), answer)).otherwise(answer)


def format_question(question: Column, candidates: Column) -> Column:
    """The question and its lettered options, a line each; a null question or option is an empty one."""
    options = F.transform(candidates, lambda c, i: F.concat(F.lit("("), _letter(i + 1), F.lit(") "), F.coalesce(c, F.lit(""))))
    return strip(F.concat_ws("\n", F.concat(F.lit("Question: "), F.coalesce(question, F.lit(""))), F.lit("Options:"), options))


def conversation(question: Column, candidates: Column, include_system: bool = True, frames: Column | None = None) -> Column:
    """Messages as array<struct<role, text, content>>: a system message has text, a user's has parts.

    ``frames`` fills the video part; without it the part is a placeholder.
    """
    part = "struct<type:string,text:string,video:array<bigint>>"
    user = F.array(
        F.struct(F.lit("video").alias("type"), F.lit(None).cast("string").alias("text"), (F.lit(None) if frames is None else frames).cast("array<bigint>").alias("video")),
        F.struct(F.lit("text").alias("type"), F.concat_ws("\n", format_question(question, candidates), F.lit(ASK)).alias("text"), F.lit(None).cast("array<bigint>").alias("video")),
    ).cast(f"array<{part}>")
    message = f"struct<role:string,text:string,content:array<{part}>>"
    ask = F.struct(F.lit("user").alias("role"), F.lit(None).cast("string").alias("text"), user.alias("content")).cast(message)
    system = F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_PROMPT).alias("text"), F.lit(None).cast(f"array<{part}>").alias("content")).cast(message)
    return F.array(system, ask) if include_system else F.array(ask)


def with_frames(messages: Column, frames: Column) -> Column:
    """A given conversation with ``frames`` put into every video part of its user messages; the rest stays."""
    filled = lambda p: F.when(p["type"] == "video", F.struct(p["type"].alias("type"), p["text"].alias("text"), frames.cast("array<bigint>").alias("video"))).otherwise(p)
    return F.transform(messages, lambda m: F.when(m["role"] == "user", F.struct(m["role"].alias("role"), m["text"].alias("text"), F.transform(m["content"], filled).alias("content"))).otherwise(m))
