"""Rules that keep or drop a node's text, and the gate against its source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import passages
from ..functions.arrow import per_row


def drop_reason(text: Column) -> Column:
    """Why a text is dropped, the first rule that holds; 'keep' if none does. Null counts as empty."""
    return per_row("string", passages.drop_reason, F.coalesce(text, F.lit("")))


def gate(text: Column, source: Column, min_words: int = 28, max_words: int = 500, min_overlap: float = 0.52, min_unique: float = 0.30) -> Column:
    """Whether a text has a fitting length, enough different words, and enough of them in its source. Null texts don't pass."""

    def judge(t: str, s: str | None) -> bool:
        return passages.gate(t, passages.match_form(t), set(passages.match_form(s or "").split()), min_words, max_words, min_overlap, min_unique)

    return F.coalesce(per_row("boolean", judge, text, source), F.lit(False))


def coverage(text: Column, source: Column) -> Column:
    """Share of a text's different words that are in its source; null for a null text."""
    return per_row("double", lambda t, s: passages.containment(set(passages.match_form(t).split()), set(passages.match_form(s or "").split())), text, source)


def valid_keyword(keyword: Column) -> Column:
    """Not only stop words, and not only noise; a single word must be clean. Null isn't valid."""
    return F.coalesce(per_row("boolean", passages.valid_keyword, keyword), F.lit(False))


def is_low_info(text: Column) -> Column:
    """Whether a text is empty or filler in its match form. Null counts as empty."""
    return per_row("boolean", lambda t: passages.low_info(passages.match_form(t)), F.coalesce(text, F.lit("")))
