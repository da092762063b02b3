"""Requests to models and what is taken from their answers. The prompts themselves are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_SET

#: What a question to the retrieval service and its answer are cut to, and how an answer's list of sources begins.
# The wording of the question, around the domain.
QUESTION = ("Đây là transcript ASR tiếng Việt ", " bị lỗi chính tả và thuật ngữ. Hãy sửa lại các thuật ngữ chuyên ngành cho đúng:\n\n")
SUBJECT_DOMAIN, GENERAL_DOMAIN = "môn ", "học thuật"
QUESTION_CHARS, ANSWER_CHARS, SOURCES_MARK = 300, 400, "📚"


def node_prompt(template: Column, chunk: Column, suffix: Column | None = None) -> Column:
    """The template with the chunk in place of {CHUNK_TEXT}, and a suffix where several nodes are asked for."""
    filled = F.replace(template, F.lit("{CHUNK_TEXT}"), chunk)
    return filled if suffix is None else F.concat(filled, suffix)


def refine_items(segments: Column) -> Column:
    """JSON of a batch of struct(id, text), as a refining model reads it."""
    return F.to_json(segments)


def retrieval_question(context: Column, subject: Column) -> Column:
    """What the retrieval service is asked: to correct the terms of the context's first characters; '' for a blank context."""
    domain = F.when(F.coalesce(subject, F.lit("")) == "", F.lit(GENERAL_DOMAIN)).otherwise(F.concat(F.lit(SUBJECT_DOMAIN), subject))
    asked = F.concat(F.lit(QUESTION[0]), domain, F.lit(QUESTION[1]), F.substring(context, 1, QUESTION_CHARS))
    return F.when(F.btrim(F.coalesce(context, F.lit("")), F.lit(WS_SET)) == "", "").otherwise(asked)


def retrieval_answer(answer: Column) -> Column:
    """An answer without its list of sources, cut; '' where nothing is left."""
    bare = F.btrim(F.regexp_replace(F.coalesce(answer, F.lit("")), f"(?s)\n\n{SOURCES_MARK}.*$", ""), F.lit(WS_SET))
    return F.btrim(F.substring(bare, 1, ANSWER_CHARS), F.lit(WS_SET))
